"""Operators as filters of whole document tables: what the corpus pipeline applies one after the other.

Each takes documents (doc_id, text, source, and any other columns) and returns the rows that stay, with their columns.
Repeated and null ids are allowed: a row is told from others with its id by the digest of its text.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import decontamination, line_dedup, near_duplicates, packing, quality_rules
from .key_bitmap import key_bitmap, split_by
from .staging import staged


def _digest(text: str) -> Column:
    return F.unhex(F.md5(text)).alias("digest")


def named(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with the id and the text's digest as one id, so that rows which repeat an id are told apart."""
    return docs.select(F.struct("doc_id", _digest("text")).alias("doc_id"), "text")


def _same(docs: DataFrame, other: DataFrame):
    return docs["doc_id"].eqNullSafe(other["other_id"]) & F.unhex(F.md5(docs["text"])).eqNullSafe(other["other_digest"])


def _keys(names: DataFrame) -> DataFrame:
    return names.select(F.col("doc_id.doc_id").alias("other_id"), F.col("doc_id.digest").alias("other_digest"))


def without(docs: DataFrame, names: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id and text are not among ``names``, ids as ``named`` makes them; nulls count as values.

    Only rows whose id may be among them, by a bitmap of fixed size, are joined and have their texts shuffled.
    """
    gone = _keys(names)
    maybe, stay = split_by(docs, "doc_id", key_bitmap(gone, "other_id"))
    return stay.unionByName(maybe.join(gone, _same(maybe, gone), "left_anti"))


def repeated(docs: DataFrame) -> DataFrame:
    """Ids and digests that stand in several rows, counted without moving a text."""
    return staged(_keys(named(docs).groupBy("doc_id").count().where("count > 1")))


def one_of_each(docs: DataFrame, repeats: DataFrame) -> DataFrame:
    """One row of those alike in id and text, of which ``repeats`` has all.

    Texts are moved only for the rows that do repeat, and not at all where none does; repeats are made one in their
    task before they are moved.
    """
    if repeats.isEmpty():
        return docs
    again = docs.join(repeats, _same(docs, repeats), "left_semi").withColumn("_digest", _digest("text"))
    return docs.join(repeats, _same(docs, repeats), "left_anti").unionByName(
        again.dropDuplicates(["doc_id", "_digest"]).select(docs.columns))


def keep_good(docs: DataFrame) -> DataFrame:
    """Documents that the quality rules and the verdict on their host keep; null texts fail. See ``quality_rules``."""
    return quality_rules.good_documents(docs)


def drop_boilerplate(docs: DataFrame) -> DataFrame:
    """All documents, their texts without boilerplate lines; n_chars follows the text.

    Null texts stay null, null hosts are one host, repeated rows count as one page and all stay. A page of nothing
    but boilerplate keeps its text. See ``line_dedup``.
    """
    cleaned = line_dedup.line_dedup(docs).select("row.*", F.col("clean_text").alias("_clean_text"))
    changed = {"text": F.col("_clean_text"), "n_chars": F.length("_clean_text").cast("bigint")}
    return cleaned.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in docs.columns])


def keep_one_of_near_copies(docs: DataFrame) -> DataFrame:
    """One document of each group with five-word shingles alike to 0.8; a pair at 0.8 is missed with a chance of 6e-7.

    Of documents that share an id only those go whose own text has a copy; of rows alike in id and text one stays.
    Null and blank texts are no copies of anything, but of rows alike in id and such a text one stays, too.
    """
    labels = near_duplicates.near_duplicates(named(docs), size=5, percent=80, rows=5, bands=36)
    left = without(docs, staged(labels.where("not kept").select("doc_id").distinct()))
    return one_of_each(left, repeated(docs))


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without benchmark passages; of documents that share an id only those with a leak in their own text go."""
    return without(docs, staged(decontamination.find_leaks(named(docs), benchmark).select("doc_id")))


def pack(docs: DataFrame) -> DataFrame:
    """Pieces of the documents and the bins they lie in. Null and blank texts have no piece. See ``packing``."""
    return packing.pack(docs)
