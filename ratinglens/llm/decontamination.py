"""Operator 5: benchmark passages in training documents, found by spaced seeds that tolerate substituted words."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import checkpointed, staged, type_of
from .word_arrays import mix, text_slices, window_hashes, words_of

# Word places that a seed looks at, and the least and most words of the items that have seeds of it. The last three
# were chosen greedily until, of all patterns of substitutions that leave a leak in an item of 8 to 20 words, each holds
# a seed. A leak in a longer item has its first 13 equal words within 19, as each substituted word costs two.
MASKS = ((0, 1, 2, 3, 4, 5, 6, 7), (0, 1, 3, 4, 6, 7, 9), (0, 1, 2, 5, 6, 9, 10), (0, 2, 4, 9, 10), (0, 1, 2, 4, 5), (0, 1, 2, 4))
ITEM_WORDS = (*[(8, np.inf)] * 3, *[(13, np.inf)] * 2, (8, 12))
AROUND = 32                     # words compared on either side of a seed's first word and after its last
MIN_MATCHED = 13                # equal words in one stretch that make a leak
SHORT_PERCENT = 80              # ... or this share of an item with fewer words
MIN_ITEM = 8                    # items of fewer words cannot be told from chance
_SUBSTITUTED = -2               # what a substituted word costs a stretch, an equal one being worth 1
_SPAN = max(m[-1] for m in MASKS) + 1
_CONTEXT = 2 * AROUND + _SPAN
_FILTER_BITS = 24
_U64 = np.uint64


def _seeds(hashes: np.ndarray, first: np.ndarray, items: bool):
    """(seed, place) of every window of every mask that fits into its text; of items only for the masks of their length."""
    length = np.diff(first)
    for number, (mask, (least, most)) in enumerate(zip(MASKS, ITEM_WORDS, strict=True)):
        place = np.arange(len(hashes))
        fits = place + mask[-1] < np.repeat(first[1:], length)
        if items:
            fits &= np.repeat((length >= least) & (length <= most), length)
        place = place[fits]
        yield mix(window_hashes(hashes, place, mask) + _U64(number)), place


def _contexts(hashes: np.ndarray, first: np.ndarray, text: np.ndarray, place: np.ndarray) -> list[np.ndarray]:
    """32-bit hashes of the words around each place; 0 stands for what lies outside the text."""
    at = place[:, None] + np.arange(-AROUND, _CONTEXT - AROUND)
    inside = (at >= first[text][:, None]) & (at < first[text + 1][:, None])
    words = (hashes[np.clip(at, 0, len(hashes) - 1)] >> _U64(32)).astype(np.uint32) | np.uint32(1)
    return list(np.where(inside, words, 0).astype(np.uint32).view(np.int32))


def _seed_table(texts: DataFrame, id_type: str, wanted: np.ndarray | None) -> DataFrame:
    """(id, seed, around, n_words) of the seeds of items (id, text); with a filter, of documents, only of those that it holds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, data, offsets in text_slices(batch.column(1)):
                words = words_of(data, offsets)
                text_of = words.text_of()
                for seed, place in _seeds(words.hashes, words.first, wanted is None):
                    if wanted is not None:
                        low = (seed & _U64((1 << _FILTER_BITS) - 1)).astype(np.int64)
                        held = (wanted[low >> 3] >> (low & 7).astype(np.uint8)) & 1
                        seed, place = seed[held == 1], place[held == 1]
                    for some in range(0, len(seed), 4096):
                        part = slice(some, some + 4096)
                        text = text_of[place[part]]
                        yield pa.RecordBatch.from_arrays([
                            batch.column(0).take(pa.array(begin + text)), pa.array(seed[part].view(np.int64)),
                            pa.array(_contexts(words.hashes, words.first, text, place[part]), pa.list_(pa.int32())),
                            pa.array(np.diff(words.first)[text]), pa.array(place[part] - words.first[text]),
                        ], names=["id", "seed", "around", "n_words", "place"])

    return texts.mapInArrow(run, f"id {id_type}, seed bigint, around array<int>, n_words bigint, place bigint")


def _seed_filter(seeds: DataFrame) -> np.ndarray:
    """Bitmap of the low bits of the seeds. Its size is fixed, 2 MB, however large the benchmark is."""
    low = F.col("seed").bitwiseAND(F.lit((1 << _FILTER_BITS) - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), low.bitwiseAND(F.lit(63)).cast("int"))
    words = seeds.groupBy(F.shiftright(low, 6).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits"))
    held = np.zeros(1 << _FILTER_BITS - 6, np.int64)
    for row in words.toLocalIterator():
        held[row["word"]] = row["bits"]
    return held.view(np.uint8)


def longest_overlap(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal words of the best stretch of each aligned pair of rows; a substituted word costs a stretch two equal ones."""
    best, score, equal_words = (np.zeros(len(a), np.int64) for _ in range(3))
    result = np.zeros(len(a), np.int64)
    for place in range(a.shape[1]):
        both = (a[:, place] != 0) & (b[:, place] != 0)
        equal = both & (a[:, place] == b[:, place])
        score = np.where(both, score + np.where(equal, 1, _SUBSTITUTED), 0)
        equal_words = np.where(score > 0, equal_words + equal, 0)
        score = np.maximum(score, 0)
        better = score > best
        best, result = np.where(better, score, best), np.where(better, equal_words, result)
    return result


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id",
               item_text: str = "text") -> DataFrame:
    """(doc_id, items, n_matched) of each document id with a leak: the items it holds words of, and the most equal words.

    Words are compared as in all word operators (A-Z as a-z). Every window of every mask of both sides is hashed;
    windows of documents that no benchmark window can equal are dropped by a bitmap of fixed size before they leave
    their task, the others are joined with the benchmark's by hash. Around each hit the words of both sides are
    compared in place: a stretch with 13 equal words is a leak, substituted words inside being tolerated, as is
    80 percent of an item of 8 to 16 words. Every pattern of substituted words that this permits holds a seed; words
    put in or left out end a stretch. Shorter items are not looked for.

    What is compared around a hit is limited, n_matched is not: where a leak's document and item overlap beyond it,
    their whole overlap is compared once more, from the document's text and the item's words.

    Null texts and null ids of items hold nothing; a null doc_id is reported as null. Rows that repeat an id are
    reported once. Other columns are ignored. Without leaks, documents or items the result is empty.
    """
    items = benchmark.select(F.col(item_id).alias("id"), F.col(item_text).alias("text")).where("id is not null")
    seeds = checkpointed(_seed_table(items, type_of(benchmark, item_id), None).where(F.col("n_words") >= MIN_ITEM))
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    hits = _seed_table(texts, type_of(docs, doc_id), _seed_filter(seeds)).select(
        F.col("id").alias("doc_id"), "seed", F.col("around").alias("words"), F.col("n_words").alias("doc_words"), F.col("place").alias("doc_place"))
    # of the item's places those compared are from place - AROUND to place + _CONTEXT - AROUND
    shift = F.col("doc_place") - F.col("place")
    whole = (F.col("place") - AROUND <= F.greatest(-shift, F.lit(0))) & (
        F.col("place") + (_CONTEXT - AROUND) >= F.least("n_words", F.col("doc_words") - shift))
    pairs = hits.join(seeds.select(F.col("id").alias("item_id"), "seed", "around", "n_words", "place"), "seed").select(
        "doc_id", "item_id", "words", "around", "n_words", shift.alias("shift"), whole.alias("whole"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.stack(batch.column(i).to_numpy(zero_copy_only=False)) for i in (2, 3))
                matched = longest_overlap(a, b)
                needed = np.minimum(MIN_MATCHED, np.ceil(batch.column(4).to_numpy() * SHORT_PERCENT / 100)).astype(np.int64)
                leak = pa.array(matched >= needed)
                kept = [batch.column(i).filter(leak) for i in (0, 1, 5, 6)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(matched).filter(leak)], names=["doc_id", "item_id", "shift", "whole", "n_matched"])

    schema = f"doc_id {type_of(docs, doc_id)}, item_id {type_of(benchmark, item_id)}, shift bigint, whole boolean, n_matched bigint"
    found = staged(pairs.mapInArrow(verify, schema).groupBy("doc_id", "item_id", "shift").agg(
        F.max("n_matched").alias("n_matched"), F.max("whole").alias("whole")))
    cut = found.where("not whole")
    matched = found.select("doc_id", "item_id", "n_matched")
    if not cut.isEmpty():
        matched = matched.unionByName(_whole_overlaps(texts, items, cut))
    return matched.groupBy("doc_id").agg(F.sort_array(F.collect_set("item_id")).alias("items"), F.max("n_matched").alias("n_matched"))


def _word_marks(words) -> np.ndarray:
    """Words as in ``_contexts``."""
    return (words >> _U64(32)).astype(np.uint32) | np.uint32(1)


def _item_marks(items: DataFrame, id_type: str) -> DataFrame:
    """(item_id, marks): all words of each item; rows that repeat an id stay apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, data, offsets in text_slices(batch.column(1)):
                words = words_of(data, offsets)
                marks = np.split(_word_marks(words.hashes).view(np.int32), words.first[1:-1])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, len(marks)), pa.array(marks, pa.list_(pa.int32()))], names=["item_id", "marks"])

    return items.mapInArrow(run, f"item_id {id_type}, marks array<int>")


def _whole_overlaps(texts: DataFrame, items: DataFrame, cut: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_matched) of the alignments ``cut`` (doc_id, item_id, shift) over all words that overlap.

    Alignments come to a document in lists, so that its text is read once a list. A row that shares its id with the
    aligned one is compared, too: whatever is equal in it is equal.
    """
    id_type, item_type = type_of(cut, "doc_id"), type_of(cut, "item_id")
    wanted = cut.select("doc_id", "item_id", "shift").join(_item_marks(items, item_type), "item_id")
    part = F.pmod(F.xxhash64("item_id", "shift"), F.lit(8)).alias("part")
    lists = staged(wanted.groupBy(F.col("doc_id").alias("of_id"), part).agg(
        F.collect_list(F.struct("item_id", "shift", "marks")).alias("alignments")))
    chosen = texts.join(lists, texts["id"].eqNullSafe(lists["of_id"])).select("id", "text", "alignments")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, data, offsets in text_slices(batch.column(1)):
                words = words_of(data, offsets)
                for row, marks in enumerate(np.split(_word_marks(words.hashes), words.first[1:-1])):
                    alignments = batch.column(2)[begin + row].values
                    found = []
                    for shift, item in zip(alignments.field("shift").to_pylist(), alignments.field("marks"), strict=True):
                        item = item.values.to_numpy().view(np.uint32)
                        low, high = max(0, shift), min(len(marks), shift + len(item))
                        found.append(_best_stretch(marks[low:high] == item[low - shift:high - shift]) if high > low else 0)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array([begin + row] * len(found), pa.int64())), alignments.field("item_id"), pa.array(found, pa.int64())],
                        names=["doc_id", "item_id", "n_matched"])

    return chosen.mapInArrow(run, f"doc_id {id_type}, item_id {item_type}, n_matched bigint")


def _best_stretch(equal: np.ndarray) -> int:
    """``longest_overlap`` of one pair: equal words from where the running score was last at its least to where it is highest."""
    score = np.where(equal, 1, _SUBSTITUTED).cumsum()
    least = np.minimum(np.minimum.accumulate(np.append(0, score[:-1])), 0)
    best = score - least
    if not len(best) or best.max() <= 0:
        return 0
    end = int(best.argmax())
    start = end - int((np.append(0, score[:end])[::-1] == least[end]).argmax())
    return int(equal[start:end + 1].sum())
