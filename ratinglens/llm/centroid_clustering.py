"""Operator 11: k-means on integer vectors with kept dot products, updated by what changes in the centroids."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import discard, staged, type_of

SCALE = 256
LARGEST = 1 << 27       # larger components count as this, so that squared distances of 64 components fit a long
_EXACT = 1 << 53


def is_vector(vector: str, size: int | None = None) -> Column:
    """Whether a vector has ``size`` components, or any at all, and none that is null or not finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    length = F.size(vector) > 0 if size is None else F.size(vector) == size
    return F.col(vector).isNotNull() & length & F.forall(vector, finite)


def integer_vector(vector: str, scale: int, largest: int, offset: int = 0) -> Column:
    """Components as floor(scale * component) + offset, the floor kept within plus or minus ``largest``."""
    scaled = lambda x: F.floor(F.least(F.greatest(x.cast("double") * scale, F.lit(float(-largest))), F.lit(float(largest)))) + offset
    return F.transform(vector, lambda x: scaled(x).cast("bigint"))


def rows_of(column: pa.Array, size: int) -> np.ndarray:
    """A column of lists of ``size`` numbers as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def lists_of(matrix: np.ndarray) -> pa.Array:
    offsets = np.arange(0, matrix.size + 1, matrix.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(matrix).reshape(-1)))


def add_products(dots: np.ndarray, x: np.ndarray, change: np.ndarray) -> None:
    """Adds to ``dots`` what the products with the centroids gain by a change of these, by changed components only."""
    largest = int(np.abs(x).max(initial=0))
    for k in np.flatnonzero(change.any(axis=1)):
        parts = np.flatnonzero(change[k])
        if largest * int(np.abs(change[k]).sum()) < _EXACT:      # whole numbers of that size are exact as doubles
            dots[:, k] += (x[:, parts].astype(np.float64) @ change[k, parts].astype(np.float64)).astype(np.int64)
        else:
            dots[:, k] += x[:, parts] @ change[k, parts]


def _assigned(state: DataFrame, change: np.ndarray, centroids: np.ndarray, dims: int) -> DataFrame:
    """(vec_id, x, dots, cluster, distance): dot products brought up to date, and the nearest centroid by them."""
    known, norms = "dots" in state.columns, (centroids ** 2).sum(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = rows_of(batch.column(1), dims)
            dots = rows_of(batch.column(2), len(norms)).copy() if known else np.zeros((len(x), len(norms)), np.int64)
            add_products(dots, x, change)
            apart = norms - 2 * dots
            cluster = apart.argmin(axis=1)                       # of equal ones the first
            distance = (x ** 2).sum(axis=1) + apart[np.arange(len(x)), cluster]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), lists_of(dots), pa.array(cluster.astype(np.int32)), pa.array(distance)],
                names=["vec_id", "x", "dots", "cluster", "distance"])

    columns = ["vec_id", "x", "dots"] if known else ["vec_id", "x"]
    return state.select(columns).mapInArrow(
        run, f"vec_id {type_of(state, 'vec_id')}, x array<bigint>, dots array<bigint>, cluster int, distance bigint")


def _moved(state: DataFrame, centroids: np.ndarray, dims: int) -> np.ndarray:
    """The floors of the means of the clusters; sums combine in the tasks, one row a cluster reaches the driver."""
    sums = [F.sum(F.get("x", F.lit(i))).alias(f"s{i}") for i in range(dims)]
    moved = centroids.copy()
    for row in state.groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect():
        moved[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(dims)]
    return moved


def cluster(embeddings: DataFrame, clusters: int = 40, rounds: int = 5, dims: int = 64, seed: str = "2",
            vector: str = "embedding", vec_id: str = "vec_id") -> tuple[DataFrame, np.ndarray]:
    """((vec_id, x, dots, cluster, distance) of each usable vector, centroids): k-means on x = floor(256 * component).

    Every vector keeps its integer dot product with each centroid, in a staged table. When centroids move, the
    products change by the vector's components times the changes of the centroid, so only components that changed
    are multiplied; the nearest centroid is then the least of |c|^2 - 2 x c. All of it is exact. If no centroid
    moves, the remaining rounds would change nothing and are left out. The table of one round replaces the last one's,
    so at most two lie in the shared folder.

    The first centroids are the vectors with the smallest sha256 of ``seed:vec_id``, of equal ones the smallest
    vectors; rows that repeat an id or a vector are vectors each. Of null ids none has a hash, they come last. With
    fewer vectors than ``clusters`` there are as many centroids as vectors. A centroid without vectors stays.

    Null vectors, vectors of another length and those with a null or non-finite component are left out. Components
    beyond 2^27 after scaling count as 2^27, so that distances fit a long. Other columns are ignored. Without usable
    vectors the result is empty. Only ``clusters`` rows ever reach the driver.
    """
    kept = embeddings.where(is_vector(vector, dims)).select(
        F.col(vec_id).alias("vec_id"), integer_vector(vector, SCALE, LARGEST).alias("x"))
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = kept.select(order.alias("order"), "x").orderBy(F.col("order").asc_nulls_last(), "x").limit(clusters).collect()
    if not first:
        empty = kept.select("vec_id", "x", F.col("x").alias("dots"), F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance"))
        return empty.where("false"), np.zeros((0, dims), np.int64)
    centroids = np.array([row["x"] for row in first], np.int64)
    state = staged(_assigned(kept, centroids, centroids, dims))
    for _ in range(rounds):
        moved = _moved(state, centroids, dims)
        change, centroids = moved - centroids, moved
        if not change.any():
            break
        before, state = state, staged(_assigned(state, change, centroids, dims))
        discard(before)
    return state, centroids


def inertia_by_cluster(state: DataFrame) -> dict[int, int]:
    """Distances summed by cluster; one row a cluster reaches the driver."""
    return {row["cluster"]: row["inertia"] for row in state.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
