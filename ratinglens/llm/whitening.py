"""Operator 12: whitening of embeddings by blockwise QR, a bidiagonal qd solver and twisted factorisations."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bidiagonal import right_singular_vectors
from .centroid_clustering import integer_vector, is_vector, rows_of
from .staging import type_of
from .tree_reduce import reduced

SCALE, OFFSET = 64, 1_000_000
LARGEST = 1 << 31           # larger components, scaled, count as this
_SLICE = 4096               # vectors worked on at a time
_LONG = 1 << 63


@dataclass
class Whitening:
    """The fit: number of vectors, sums and floors of the means by dimension, eigenvalues and eigenvectors (as columns)."""
    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def floors(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums.tolist()], np.int64)

    @property
    def rests(self) -> np.ndarray:
        return np.array([s % self.n for s in self.sums.tolist()], np.int64)

    def directions(self, components: int) -> np.ndarray:
        """Columns that take a centred vector to whitened components; zero where there is no variance but rounding."""
        values, size = self.values[:components], len(self.values)
        some = values > size * np.finfo(float).eps * self.values[0]
        return self.vectors[:, :components] * np.where(some, 1 / np.sqrt(np.where(some, values, 1)), 0)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """Rows less the mean; the whole part of the mean is taken off before anything is rounded."""
        return (x - self.floors) - self.rests / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)^2 of each row, exact; None where a long cannot hold it."""
        y, rests, n = x - self.floors, self.rests, self.n
        largest = int(np.abs(y).max(initial=0))
        if len(rests) * (n * (largest + 1)) ** 2 < _LONG:
            return ((n * y - rests) ** 2).sum(axis=1).tolist()
        if len(rests) * largest * max(n, largest) >= _LONG:
            y, rests = y.astype(object), rests.astype(object)
        constant = sum(r * r for r in self.rests.tolist())
        exact = [n * n * int(a) - 2 * n * int(b) + constant for a, b in zip((y * y).sum(axis=1), (y * rests).sum(axis=1), strict=True)]
        return [v if v < _LONG else None for v in exact]


def usable(embeddings: DataFrame, vector: str = "embedding", vec_id: str = "vec_id") -> tuple[DataFrame, int]:
    """((vec_id, x), length of the vectors): x = floor(64 * component) + 1000000.

    Left out are null and empty vectors, those with a null or non-finite component, and of the others those of another
    length than most have (of equally frequent lengths the smallest counts).
    """
    sizes = embeddings.where(is_vector(vector)).groupBy(F.size(vector).alias("size")).count().orderBy(F.desc("count"), "size").first()
    size = sizes["size"] if sizes else 0
    x = integer_vector(vector, SCALE, LARGEST, OFFSET)
    return embeddings.where(is_vector(vector, size)).select(F.col(vec_id).alias("vec_id"), x.alias("x")), size


def _slices(batches: Iterator[pa.RecordBatch], column: int, size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for begin in range(0, batch.num_rows, _SLICE):
            part = batch.slice(begin, _SLICE)
            yield part, rows_of(part.column(column), size)


def fit(vectors: DataFrame, size: int) -> Whitening | None:
    """The whitening of all ``vectors``; None if there are none.

    Sums and count combine in the tasks. Each task takes its centred rows block by block into one triangular R by QR,
    and the R of the tasks are taken into one in rounds, so nothing but matrices of ``size`` rows moves. The squared
    singular values of R over n are the eigenvalues of the covariance, its right singular vectors the components.
    """
    if not size:
        return None
    totals = vectors.agg(F.count("*").alias("n"), *[F.sum(F.get("x", F.lit(i))).alias(f"s{i}") for i in range(size)]).first()
    if not totals["n"]:
        return None
    whitening = Whitening(totals["n"], np.array([totals[f"s{i}"] for i in range(size)], np.int64), np.zeros(0), np.zeros((0, 0)), 0.0)

    def triangle(rows: np.ndarray) -> np.ndarray:
        r = np.zeros((size, size))
        top = np.linalg.qr(rows, mode="r")
        r[:len(top)] = top
        return r

    def fold(batches):
        r = None
        for _, x in _slices(batches, 0, size):
            rows = whitening.centred(x)
            r = triangle(rows if r is None else np.vstack([r, rows]))
        return None if r is None else r.reshape(-1)

    r = reduced(vectors.select("x"), fold, lambda parts: triangle(np.vstack([p.reshape(size, size) for p in parts])).reshape(-1)).reshape(size, size)
    values, whitening.vectors = right_singular_vectors(r)
    whitening.values, whitening.trace = values / whitening.n, float((r ** 2).sum()) / whitening.n
    return whitening


def identity_error(vectors: DataFrame, whitening: Whitening, components: int) -> float:
    """Largest entry, by size, of the covariance of the whitened vectors less the identity, over components with variance."""
    directions, size = whitening.directions(components), len(whitening.values)
    directions = directions[:, directions.any(axis=0)]

    def fold(batches):
        products = None
        for _, x in _slices(batches, 0, size):
            z = np.hstack([whitening.centred(x) @ directions, np.ones((len(x), 1))])
            products = z.T @ z if products is None else products + z.T @ z
        return None if products is None else products.reshape(-1)

    products = reduced(vectors.select("x"), fold, sum).reshape(directions.shape[1] + 1, -1) / whitening.n
    mean = products[-1, :-1]
    return float(np.abs(products[:-1, :-1] - np.outer(mean, mean) - np.eye(len(mean))).max(initial=0.0))


def whiten(embeddings: DataFrame, components: int = 32, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row for each vector and component.

    The fit is over all usable vectors (see ``usable``), the covariance has the divisor n. Components are numbered from 1 by
    falling eigenvalue, up to ``components`` or the length of the vectors; each one's largest entry is positive.
    deviation is the sum of (n x - S)^2 over the dimensions, exact, and null where it is beyond a long. Where a
    component has no variance but rounding, whitened is null and explained 0 or next to it.

    Rows that repeat an id or a vector count and come back each, null ids stay null, other columns are ignored,
    components beyond 2^31 after scaling count as 2^31. Without usable vectors the result is empty.
    """
    vectors, size = usable(embeddings, vector, vec_id)
    whitening = fit(vectors, size)
    schema = f"vec_id {type_of(vectors, 'vec_id')}, component int, n bigint, deviation bigint, whitened double, explained double"
    if whitening is None:
        return embeddings.sparkSession.createDataFrame([], schema + ", identity_error double")
    directions = whitening.directions(components)
    some, count = directions.any(axis=0), directions.shape[1]
    explained = whitening.values[:count] / whitening.trace if whitening.trace else np.zeros(count)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _slices(batches, 1, size):
            rows, whitened = len(x), whitening.centred(x) @ directions
            place = pa.array(np.repeat(np.arange(rows), count))
            yield pa.RecordBatch.from_arrays([
                part.column(0).take(place), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * count, whitening.n)), pa.array(whitening.deviations(x), pa.int64()).take(place),
                pa.array(whitened.reshape(-1), mask=np.tile(~some, rows)), pa.array(np.tile(explained, rows)),
            ], names=["vec_id", "component", "n", "deviation", "whitened", "explained"])

    error = identity_error(vectors, whitening, components) if some.any() else 0.0
    return vectors.mapInArrow(run, schema).withColumn("identity_error", F.lit(error))
