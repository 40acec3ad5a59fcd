"""What the trained operators share: folds, bounded training samples and arrays in table cells."""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_PARTS = 1 << 40
SAMPLE_BYTES = 256 << 20        # bytes of text that one training task reads, at most
_LONGEST = 16                   # a text of more than a sixteenth of these is not learnt from


def fold(doc_id, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null ids are in fold 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts, F.lit(0))


def bounded_sample(df: DataFrame, keys: list[str], text: str, bound: int, stratum: str | None = None,
                   most_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """At most ``bound`` different rows of each stratum (one, if none is named), and at most ``most_bytes`` bytes of their texts.

    Rows are chosen by the hash of ``keys``, which name all that rows differ in; rows alike in them count once, so an id or
    text that holds many rows neither fills the sample nor keeps it empty. A first step thins the rows by an estimate of
    how many different ones there are; a second one finds, on hashes and lengths alone, the place up to which rows and
    bytes stay within their bounds. Only that place, one row a stratum, reaches the driver; strata must be few. A text
    of more than a sixteenth of ``most_bytes`` is never chosen.
    """
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")
    placed = df.where(size <= most_bytes // _LONGEST).select(
        "*", F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("_stratum") if stratum else F.lit("").alias("_stratum"),
        F.pmod(F.xxhash64(*[F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in keys], F.lit("sample")), F.lit(_PARTS)).alias("_place"))
    upto = lambda limits: F.coalesce(F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])[F.col("_stratum")], F.lit(-1))
    different = {r[0]: r[1] for r in placed.groupBy("_stratum").agg(F.approx_count_distinct("_place", 0.02)).collect()}
    if not different:
        return df.limit(0)
    # half as many again, for the error of the estimate and of the draw
    thin = placed.where(F.col("_place") <= upto({k: min(_PARTS, int(_PARTS * (1.5 * bound + 100) / n)) for k, n in different.items()}))
    sizes = thin.groupBy("_stratum", "_place").agg(F.max(size).alias("size"))
    by_place = Window.partitionBy("_stratum").orderBy("_place")
    within = sizes.select("*", F.row_number().over(by_place).alias("rows"), F.sum("size").over(by_place).alias("bytes")).where(
        (F.col("rows") <= bound) & (F.col("bytes") <= most_bytes))
    last = {r[0]: r[1] for r in within.groupBy("_stratum").agg(F.max("_place")).collect()}
    chosen = thin.where(F.col("_place") <= upto(last)) if last else thin.limit(0)
    return chosen.dropDuplicates(["_stratum", "_place"]).select(df.columns)


def train_in_one_task(sample: DataFrame, fit: Callable[[Iterator[pa.RecordBatch]], dict[str, np.ndarray]], order) -> dict[str, np.ndarray]:
    """The arrays that ``fit`` makes of a bounded sample, read in a fixed order by a single task."""
    def run(batches):
        arrays = fit(batches)
        yield pa.RecordBatch.from_arrays([
            pa.array(list(arrays)), pa.array([str(a.dtype) for a in arrays.values()]),
            pa.array([list(a.shape) for a in arrays.values()], pa.list_(pa.int64())),
            pa.array([np.ascontiguousarray(a).tobytes() for a in arrays.values()], pa.binary())], names=["name", "kind", "shape", "data"])

    rows = sample.repartition(1).sortWithinPartitions(*order).mapInArrow(
        run, "name string, kind string, shape array<bigint>, data binary").collect()
    return {r["name"]: np.frombuffer(bytes(r["data"]), r["kind"]).reshape(r["shape"]) for r in rows}


def sigmoid(values):
    return 1 / (1 + np.exp(-np.clip(values, -35, 35)))
