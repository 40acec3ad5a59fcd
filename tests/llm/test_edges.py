"""Nulls, empty and very long texts, repeated rows, empty tables and clashing columns, for all operators."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ratinglens.llm import (
    decontamination,
    language_id,
    line_dedup,
    near_duplicates,
    packing,
    personal_data,
    quality_classifier,
    quality_rules,
    secret_scan,
)

from .conftest import ODD, ids

ALL = sorted((r[0] for r in ODD), key=lambda x: (x is not None, x or 0))


def _classified(docs):
    labels = docs.select("doc_id", (F.coalesce(F.col("doc_id"), F.lit(0)) % 2).cast("int").alias("quality"))
    return quality_classifier.score(docs, quality_classifier.train(docs, labels))


PER_ROW = {
    "secrets": lambda d: secret_scan.find_secrets(d).select("row.doc_id", "spans"),
    "lines": lambda d: line_dedup.line_dedup(d).select("row.doc_id", "clean_text", "n_lines"),
    "near": lambda d: near_duplicates.near_duplicates(d),
    "quality": _classified,
    "language": lambda d: language_id.identify(d, language_id.train(d)),
    "personal": lambda d: personal_data.find_personal_data(d, personal_data.train(d), mask=True),
    "rules": lambda d: quality_rules.quality_rules(d).select("row.doc_id", "n_words", "kept"),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_each_row_is_returned(odd, name):
    assert ids(PER_ROW[name](odd)) == ALL


@pytest.mark.parametrize("name", PER_ROW)
def test_empty_table(odd, name):
    assert PER_ROW[name](odd.where("false")).count() == 0


def test_near_duplicates_of_odd_rows(odd):
    found = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in near_duplicates.near_duplicates(odd, 3, 85).collect()}
    assert found[4, 1] == (4, True) and found[5, 1] == (4, False)
    assert found[1, 0] == (1, True) and found[3, 0] == (3, True) and found[2, 0] == (2, True)
    assert found[7, 1] == (7, True)


def test_personal_data_of_odd_rows(odd):
    row, = personal_data.find_personal_data(odd.where("doc_id = 10"), {}, mask=True).collect()
    assert row.masked == "call [phone] or [email], 10.0.0.256 and [ip], [card]"


def test_personal_data_without_candidates(spark):
    df = spark.createDataFrame([(1, "room 5"), (2, "7 rooms")], "doc_id bigint, text string")
    model = personal_data.train(df)
    assert model == {} and all(r.spans == [] for r in personal_data.find_personal_data(df, model).collect())


def test_language_without_letters(odd):
    found = {r.doc_id: r for r in language_id.identify(odd, language_id.train(odd)).collect() if r.doc_id in (1, 2, 3)}
    assert all(r.lang_pred == "und" and r.score == 0 for r in found.values())


def test_leaks_and_packing(spark, odd):
    items = spark.createDataFrame([(1, None), (2, ""), (None, "word " * 20), (3, "word " * 20), (3, "word " * 20)], "item_id bigint, text string")
    assert [(r.doc_id, r["items"]) for r in decontamination.find_leaks(odd, items).collect()] == [(7, [3])]
    assert decontamination.find_leaks(odd, items.where("false")).count() == 0
    assert decontamination.find_leaks(odd.where("false"), items).count() == 0
    assert packing.pack(odd.where("false")).count() == 0
    assert set(ids(packing.pack(odd))) == {None, 4, 5, 6, 7, 8, 9, 10}


def test_stages_keep_the_columns(spark, odd):
    benchmark_folder = "/root/testdata/sf0.001"
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, benchmark_folder).dtypes == odd.dtypes
        assert stage(spark, odd.where("false"), benchmark_folder).count() == 0


def test_boilerplate_below_a_tenth_of_the_pages(spark):
    """A line on 9 of 100 pages goes from each of them; one on 2 of 100 stays."""
    texts = [f"own line {i}" + "\nshared footer" * (i < 9) + "\nquoted twice" * (i in (20, 30)) for i in range(100)]
    df = spark.createDataFrame([(i, t, "a") for i, t in enumerate(texts)], "doc_id bigint, text string, source string")
    left = {r.doc_id: r.text for r in corpus_pipeline.drop_boilerplate(spark, df.withColumn("n_chars", F.lit(0)), "").collect()}
    assert left == {i: t.replace("\nshared footer", "") for i, t in enumerate(texts)}


def test_repeated_rows_are_near_copies(spark):
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (None, "h i j k l m"), (None, "h i j k l m"), (2, None), (2, None), (1, "n o p q r s")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    left = corpus_pipeline.keep_one_of_near_copies(spark, df, "").collect()
    assert len(left) == 4 and {(r.doc_id, r.text) for r in left} == set(rows)


def test_stages_tell_rows_with_one_id_apart(spark):
    """A copy or a leak among rows that repeat an id, a null one too, takes no other text of that id with it."""
    said = lambda word: " ".join(f"{word}{i}" for i in range(60))
    leak = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").orderBy(F.length("text").desc()).first()["text"]
    docs = spark.createDataFrame([(1, said("a")), (2, said("a")), (2, said("b")), (None, said("b")), (None, said("c")), (3, said("d")), (3, leak)],
                                 "doc_id bigint, text string")
    stage = dict(corpus_pipeline.STAGES)
    found = sorted(((r.doc_id or 0), r.text) for r in stage["near_duplicates"](spark, docs, "").collect())
    assert [(i, t[:2]) for i, t in found if t != leak] == [(0, "b0"), (0, "c0"), (1, "a0"), (3, "d0")] and (3, leak) in found
    left = stage["decontamination"](spark, docs, "/root/testdata/sf0.001")
    assert left.count() == 6 and left.where(F.col("text") == leak).isEmpty()
