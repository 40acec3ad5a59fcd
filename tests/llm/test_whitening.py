from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratinglens.llm import tree_reduce, whitening
from ratinglens.llm.bidiagonal import bidiagonal, right_singular_vectors, squared_singular_values

SCHEMA = "vec_id bigint, embedding array<double>, x string, n int"
RANDOM = np.random.Generator(np.random.PCG64(1))


def rotated(values):
    q, w = (np.linalg.qr(RANDOM.standard_normal((len(values), len(values))))[0] for _ in range(2))
    return (q * values) @ w


MATRICES = {
    "one": np.array([[-3.0]]), "small": RANDOM.standard_normal((3, 3)), "gauss": RANDOM.standard_normal((64, 64)),
    "triangle": np.linalg.qr(RANDOM.standard_normal((200, 40)), mode="r"), "identity": np.eye(20), "orthogonal": rotated(np.ones(30)),
    "groups": rotated(np.repeat([4.0, 3, 2, 1], 8)), "deficient": rotated(np.append(np.ones(10), np.zeros(20))),
    "graded": rotated(10.0 ** -np.linspace(0, 10, 30)), "close": rotated(1 + 1e-9 * np.arange(30)), "closer": rotated(1 + 1e-14 * np.arange(30)),
    "zeros inside": np.triu(RANDOM.standard_normal((12, 12)), 1), "diagonal": np.diag([1.0, 0, 0, 2]), "single": np.eye(9)[::-1] * np.eye(9)[4],
    "huge": 1e120 * RANDOM.standard_normal((8, 8)), "little": 1e-120 * RANDOM.standard_normal((8, 8)),
}


@pytest.mark.parametrize("name", MATRICES)
def test_singular_vectors(name):
    m = MATRICES[name]
    values, vectors = right_singular_vectors(m)
    s = np.linalg.svd(m, compute_uv=False)
    n, top = len(m), s[0]
    assert np.allclose(np.sqrt(values) / top, s / top, atol=1e-13, rtol=0 if name in ("deficient", "zeros inside") else 1e-13) or np.allclose(
        values / top ** 2, (s / top) ** 2, atol=1e-13)
    assert np.abs(vectors.T @ vectors - np.eye(n)).max() < 1e-12
    assert np.abs((m / top).T @ ((m / top) @ vectors) - vectors * (values / top ** 2)).max() < 1e-13
    assert (np.diff(values) <= 0).all()


def test_zero_matrix():
    values, vectors = right_singular_vectors(np.zeros((4, 4)))
    assert (values == 0).all() and (vectors == np.eye(4)).all()


def test_bidiagonal_form():
    m = MATRICES["gauss"]
    a, b, v = bidiagonal(m)
    upper = np.diag(a) + np.diag(b, 1)
    assert np.allclose(upper.T @ upper, v.T @ m.T @ m @ v, atol=1e-11) and np.allclose(v.T @ v, np.eye(64), atol=1e-13)


def test_small_values_keep_their_digits():
    """A graded bidiagonal matrix whose least values are the product of the others' by an exact determinant."""
    a, b = 10.0 ** -np.arange(12.0), 0.5 * 10.0 ** -np.arange(11.0)
    values = squared_singular_values(a, b)
    product = Fraction(1)
    for x in a:
        product *= Fraction(float(x)) ** 2
    logs = np.log(values).sum()
    assert abs(logs - float(np.log(float(product)))) < 1e-10


def by_numpy(x, components):
    centred = x - x.sum(0) / len(x)
    values, vectors = np.linalg.eigh(centred.T @ centred / len(x))
    values, vectors = values[::-1], vectors[:, ::-1]
    return centred @ vectors[:, :components] / np.sqrt(values[:components]), values / values.sum()


def test_against_numpy(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    source = df.orderBy("vec_id").toPandas()
    x = np.floor(64 * np.stack(source.embedding).astype(float)).astype(np.int64) + whitening.OFFSET
    expected, explained = by_numpy(x, 32)
    rows = whitening.whiten(df.repartition(70)).toPandas()
    table = rows.pivot(index="vec_id", columns="component", values="whitened").sort_index().to_numpy()
    assert np.allclose(table, expected * np.sign((table * expected).sum(0)), atol=1e-9)
    assert np.allclose(rows.explained, explained[rows.component - 1], rtol=1e-9) and rows.identity_error.max() < 1e-9
    n, sums = len(x), x.sum(0)
    deviation = dict(zip(source.vec_id, ((n * x - sums) ** 2).sum(1).tolist(), strict=True))
    assert (rows.deviation == rows.vec_id.map(deviation)).all() and (rows.n == n).all() and len(rows) == 32 * n


def test_rows_that_do_not_count(spark):
    good = [(i, RANDOM.standard_normal(3).tolist()) for i in range(40)]
    rows = good + [good[3], (None, [1.0, 2.0, 3.0]), (50, None), (51, []), (52, [1.0, 2.0]), (53, [1.0, None, 1.0]), (54, [float("nan"), 0.0, 0.0]),
                   (55, [float("inf"), 0.0, 0.0])]
    df = spark.createDataFrame([(*r, "a", 1) for r in rows], SCHEMA)
    found = whitening.whiten(df).collect()
    assert len(found) == 42 * 3 and {r.n for r in found} == {42} and sum(r.vec_id is None for r in found) == 3
    assert sum(r.vec_id == 3 for r in found) == 6 and max(r.identity_error for r in found) < 1e-9
    assert whitening.whiten(df.where("vec_id >= 50")).where("vec_id = 52").count() == 2     # the only vectors left
    assert whitening.whiten(df.where("false")).count() == 0 and whitening.whiten(df.where("vec_id in (50, 51)")).count() == 0


def test_no_variance(spark):
    df = spark.createDataFrame([(i, [1.0, float(i % 2), 1.0], "a", 1) for i in range(9)], SCHEMA)
    found = whitening.whiten(df).collect()
    assert {r.component for r in found if r.whitened is None} == {2, 3} and {r.component for r in found} == {1, 2, 3}
    assert found[0].identity_error < 1e-9
    alone = whitening.whiten(df.limit(1)).collect()
    assert [(r.whitened, r.deviation, r.explained) for r in alone] == [(None, 0, 0.0)] * 3


def test_large_components(spark):
    rows = [(i, [1e300 if i == 3 else -1e300 if i == 4 else float(i), float(i * i)]) for i in range(12)]
    found = whitening.whiten(spark.createDataFrame([(*r, "a", 1) for r in rows], SCHEMA)).collect()
    assert len(found) == 24 and all(np.isfinite(r.whitened) for r in found) and max(r.identity_error for r in found) < 1e-6


@pytest.mark.parametrize("n, largest", [(7, 10), (10**6, 10), (10**7, 10**4), (10**9, 2**31)])
def test_deviations_are_exact_or_null(n, largest):
    x = RANDOM.integers(-largest, largest + 1, (50, 5))
    sums = RANDOM.integers(-n, n, 5)
    fit = whitening.Whitening(n, sums, np.zeros(5), np.zeros((5, 5)), 0.0)
    exact = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
    assert fit.deviations(x) == [v if v < 2**63 else None for v in exact]


def test_rounds_of_a_reduction(spark, monkeypatch):
    monkeypatch.setattr(tree_reduce, "FAN_IN", 3)
    def fold(batches):
        found = [batch.column(0).to_numpy() for batch in batches if batch.num_rows]
        return np.array([np.concatenate(found).sum(), len(np.concatenate(found))], float) if found else None
    df = spark.range(1000).repartition(40)
    assert tree_reduce.reduced(df, fold, sum).tolist() == [499500, 1000]
    assert tree_reduce.reduced(df.where(F.col("id") < 0), fold, sum) is None
