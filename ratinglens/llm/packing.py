"""Operator 2: documents packed into training sequences of several permitted lengths by best fit."""

from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality_rules import word_list
from .staging import checkpointed

SHARD_TOKENS = 1 << 24          # tokens that one task packs, about
REPEATS = 1 << 16               # rows alike that are numbered at a time


@dataclass(frozen=True)
class Sizes:
    """Permitted lengths, and what a sequence costs: a fixed part, its length, and attention that grows with its square.

    With these costs a full sequence of 1,024 is the cheapest a token (1.146, against 1.271, 1.167 and 1.198), so that
    2,048 pays off only for longer pieces and where it is filled much better. 12,288 is six times a model width of 2,048.
    """
    lengths: tuple[int, ...] = (256, 512, 1024, 2048)
    fixed: float = 64.0
    attention: float = 12288.0

    def cost(self, length: int) -> float:
        return self.fixed + length * (1 + length / self.attention)

    def smallest(self, tokens: int) -> int:
        return self.lengths[bisect_left(self.lengths, tokens)]


def _filling(room: int, values: list[int], counts: list[int]) -> int:
    """Tokens that the pieces still to come put into a room, the longest that fits each time."""
    filled, at = 0, bisect_right(values, room) - 1
    while at >= 0:
        n = min(counts[at], (room - filled) // values[at])
        filled += n * values[at]
        at = min(at, bisect_right(values, room - filled)) - 1
    return filled


def open_size(sizes: Sizes, allowed: tuple[int, ...], length: int, values: list[int], counts: list[int]) -> int:
    """The length at least cost a token for a piece and what can be put behind it.

    Pieces still to come are given by their ascending lengths and counts. A piece above all of ``allowed`` takes the
    smallest permitted length that holds it.
    """
    fitting = [s for s in allowed if s >= length]
    if len(fitting) < 2:
        return fitting[0] if fitting else sizes.smallest(length)

    def cost(size):
        tokens = length + _filling(size - length, values, counts)
        return sizes.cost(sizes.smallest(tokens)) / tokens, size

    return min(fitting, key=cost)


def _packed(lengths: np.ndarray, sizes: Sizes, allowed: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """(bin, offset) of each piece, given longest first, and the tokens of each bin, with bins opened at ``allowed`` lengths."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    room, with_room, used = [], defaultdict(list), []
    values, counts = (x.tolist() for x in np.unique(lengths, return_counts=True))
    for piece, length in enumerate(lengths.tolist()):
        counts[-1] -= 1
        if not counts[-1]:
            values.pop()
            counts.pop()
        at = bisect_left(room, length)
        if at < len(room):
            free = room[at]
            target = with_room[free].pop()
            if not with_room[free]:
                room.pop(at)
        else:
            target, free = len(used), open_size(sizes, allowed, length, values, counts)
            used.append(0)
        bins[piece], offsets[piece] = target, used[target]
        used[target] += length
        if free > length:
            if not with_room[free - length]:
                insort(room, free - length)
            with_room[free - length].append(target)
    return bins, offsets, used


def best_fit(lengths: np.ndarray, sizes: Sizes) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """(bin, offset) of each piece, given longest first, and the length of each bin.

    A piece goes to the open bin that it leaves the least room in; if none has room, the bin of least cost is
    opened. In the end each bin takes the smallest length that holds its contents. Which lengths are opened at all is
    chosen by the cost of the whole: beginning with all of them, and with each alone, the length that it is cheapest to
    do without goes, as long as that lowers the cost.
    """
    cost = lambda packed: sum(map(sizes.cost, map(sizes.smallest, packed[2])))
    tried = {}

    def packing(allowed):
        if allowed not in tried:
            packed = _packed(lengths, sizes, allowed)
            tried[allowed] = cost(packed), packed
        return tried[allowed][0]

    for size in sizes.lengths:
        packing((size,))
    allowed = sizes.lengths
    while len(allowed) > 1:
        fewer = min((tuple(s for s in allowed if s != size) for size in allowed), key=packing)
        if packing(fewer) >= packing(allowed):
            break
        allowed = fewer
    bins, offsets, used = min(tried.values(), key=lambda t: t[0])[1]
    return bins, offsets, [sizes.smallest(u) for u in used]


def pieces(docs: DataFrame, tokens: Column, longest: int, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, piece, start, length): each document cut into pieces of at most ``longest`` tokens; none if it has none."""
    counted = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(tokens, F.lit(0)).cast("bigint").alias("tokens")).where("tokens > 0")
    numbers = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("tokens") - 1) / longest))
    return counted.select("doc_id", "tokens", F.explode(numbers).alias("piece")).select(
        "doc_id", "piece", (F.col("piece") * longest).alias("start"),
        F.least(F.lit(longest).cast("bigint"), F.col("tokens") - F.col("piece") * longest).alias("length"))


def pack(docs: DataFrame, sizes: Sizes = Sizes(), tokens: Column | None = None, text: str = "text", doc_id: str = "doc_id",
         shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """(doc_id, piece, start, length, bin_id, bin_size, offset): where each piece of each document goes.

    ``tokens`` counts a document's tokens; left out, its words count. A document longer than the largest permitted
    length is cut into pieces. Pieces, without their texts, are dealt by hash to shards of about ``shard_tokens``
    tokens, which are packed alone, largest first. Rows alike in id and length are counted, numbered and dealt out, too. The number of shards grows with the corpus, so a task's work
    does not; a shard wastes at most a few bins.

    The result is the same at every run and layout of the input. A null or blank text has no tokens and no piece.
    Null ids are packed like others; repeated rows are packed each. Other columns are ignored.
    """
    if list(sizes.lengths) != sorted(set(sizes.lengths)) or sizes.lengths[0] < 1:
        raise ValueError("permitted lengths must be positive and ascend")
    tokens = F.size(word_list(F.coalesce(F.col(text), F.lit("")))) if tokens is None else tokens
    cut = checkpointed(pieces(docs, tokens, sizes.lengths[-1], doc_id).groupBy("doc_id", "piece", "start", "length").agg(F.count("*").alias("n")))
    total = cut.agg(F.sum(F.col("length") * F.col("n"))).first()[0] or 0
    shards = max(1, -(-total // shard_tokens))
    kind = cut.schema["doc_id"].dataType.simpleString()

    def run(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        bins, offsets, lengths = best_fit(shard["length"].to_numpy(), sizes)
        number = int(shard["shard"].iloc[0])
        return shard.drop(columns="shard").assign(bin_id=(number << 32) + bins, bin_size=np.array(lengths)[bins], offset=offsets)

    # repeats in two steps, so that no array grows with them
    upto = lambda last: F.explode(F.sequence(F.lit(0).cast("bigint"), last))
    blocks = cut.select("*", upto(F.floor((F.col("n") - 1) / REPEATS)).alias("block"))
    each = blocks.select("doc_id", "piece", "start", "length", "block", upto(F.least(F.lit(REPEATS), F.col("n") - F.col("block") * REPEATS) - 1).alias("copy"))
    dealt = each.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "length", "block", "copy"), F.lit(shards))).drop("block", "copy")
    return dealt.groupBy("shard").applyInPandas(
        run, f"doc_id {kind}, piece bigint, start bigint, length bigint, bin_id bigint, bin_size bigint, offset bigint")
