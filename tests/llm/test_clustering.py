import hashlib
import math

import numpy as np
import pytest

from ratinglens.llm import centroid_clustering as C
from ratinglens.llm import queries

SCHEMA = "vec_id bigint, embedding array<double>, cluster int, x string, dots int"


def brute_force(rows, clusters, rounds, dims):
    """(vec_id, x) -> (cluster, distance) in plain Python, and the centroids."""
    vectors = []
    for name, v in rows:
        if v is not None and len(v) == dims and all(c is not None and math.isfinite(c) for c in v):
            vectors.append((name, tuple(math.floor(max(min(c * 256, C.LARGEST), -C.LARGEST)) for c in v)))
    key = lambda v: (v[0] is None, hashlib.sha256(f"2:{v[0]}".encode()).hexdigest() if v[0] is not None else "", v[1])
    centroids = [v[1] for v in sorted(vectors, key=key)[:clusters]]
    apart = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c, strict=True))
    nearest = lambda x: min((apart(x, c), k) for k, c in enumerate(centroids))
    for _ in range(rounds):
        groups = {}
        for _, x in vectors:
            groups.setdefault(nearest(x)[1], []).append(x)
        for k, members in groups.items():
            centroids[k] = tuple(sum(c) // len(members) for c in zip(*members, strict=True))
    return sorted((str(n), x, *nearest(x)[::-1]) for n, x in vectors), centroids


def found(state, centroids):
    rows = state.select("vec_id", "x", "cluster", "distance").collect()
    return sorted((str(r.vec_id), tuple(r.x), r.cluster, r.distance) for r in rows), [tuple(c) for c in centroids.tolist()]


@pytest.mark.parametrize("clusters, rounds, dims", [(5, 4, 3), (1, 2, 3), (40, 5, 3), (7, 0, 3)])
def test_against_brute_force(spark, clusters, rounds, dims):
    random = np.random.Generator(np.random.PCG64(3))
    rows = [(i // 2, random.integers(-3, 4, dims).astype(float).tolist()) for i in range(120)]
    rows += [(None, [0.5] * dims), (None, [0.001, -0.001, -0.25]), (5, None), (6, []), (7, [1.0]), (8, [1.0] * 4), (9, [1.0, None, 2.0]),
             (10, [1.0, float("nan"), 2.0]), (11, [1.0, float("-inf"), 2.0]), (12, [1e300, -1e300, 0.0]), (-4, [-0.0, 0.0, 1e-9])]
    df = spark.createDataFrame([(*r, 1, "x", 1) for r in rows], SCHEMA).repartition(7)
    assert found(*C.cluster(df, clusters, rounds, dims)) == brute_force(rows, clusters, rounds, dims)


def test_production_parameters_on_the_test_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    state, centroids = C.cluster(df)
    assert found(state, centroids) == brute_force([(r.vec_id, r.embedding) for r in df.collect()], 40, 5, 64)
    inertia = C.inertia_by_cluster(state)
    rows = queries.op11_centroid_clustering(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == df.count() and {r.inertia for r in rows} == {sum(inertia.values())}
    assert all(r.cluster_inertia == inertia[r.cluster] for r in rows)


def test_equal_vectors_and_empty_clusters(spark):
    df = spark.createDataFrame([(i, [1.0, 1.0], 1, "x", 1) for i in range(50)], SCHEMA)
    state, centroids = C.cluster(df, 4, 3, 2)
    assert {(r.cluster, r.distance) for r in state.collect()} == {(0, 0)} and len(centroids) == 4


def test_nothing_usable(spark):
    for rows in ([], [(1, None, 1, "x", 1), (2, [1.0], 1, "x", 1)]):
        state, centroids = C.cluster(spark.createDataFrame(rows, SCHEMA))
        assert state.count() == 0 and len(centroids) == 0


@pytest.mark.parametrize("size", [10, 1 << 27])
def test_products_follow_the_centroids(size):
    random = np.random.Generator(np.random.PCG64(5))
    x, old, new = (random.integers(-size, size, shape) for shape in ((30, 64), (4, 64), (4, 64)))
    new[1] = old[1]
    new[2, 3:] = old[2, 3:]
    dots = (x.astype(object) @ old.T.astype(object)).astype(np.int64)
    C.add_products(dots, x, new - old)
    assert (dots == x.astype(object) @ new.T.astype(object)).all()
