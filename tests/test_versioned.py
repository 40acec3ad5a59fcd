"""Tables that change together: snapshots, buckets, compaction, and writers that fail."""

import os
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ratinglens.sources.versioned import DEAL, VersionedTables, bucket_of, dealt, touched_buckets

from .conftest import rows


@pytest.fixture
def store(spark, tmp_path):
    return VersionedTables(spark, str(tmp_path / "tables"))


def files(store, name):
    root = Path(store.root) / name
    return {str(p.relative_to(root)): os.stat(p).st_mtime_ns for p in root.rglob("*.parquet")}


def named_in(reader, name):
    return set(reader.read(name).inputFiles())


def numbers(spark, start, end):
    return spark.range(start, end).select(F.col("id").alias("key"), (F.col("id") * 10).alias("value"))


def test_a_failed_change_leaves_all_tables(spark, store):
    names = [f"t{i:02}" for i in range(13)]
    with store.change() as change:
        for name in names:
            change.replace(name, numbers(spark, 0, 5))
    before = store.current()
    with pytest.raises(ZeroDivisionError), store.change() as change:
        for number, name in enumerate(names):
            change.replace(name, numbers(spark, 0, 99))
            if number == 6:
                1 / 0
    assert store.current().number == before.number == 1
    assert all(store.read(name).count() == 5 for name in names)
    assert store.vacuum() == 7                                           # what the failed change had written
    assert all(store.read(name).count() == 5 for name in names)


def test_a_reader_keeps_its_version(spark, store):
    for n in (3, 4):
        with store.change() as change:
            change.replace("a", numbers(spark, 0, n))
            change.replace("b", numbers(spark, 0, n))
            assert change.read("b").count() == n                         # a change sees itself
        if n == 3:
            reader = store.current()
    assert [reader.read(x).count() for x in "ab"] == [3, 3] and [store.read(x).count() for x in "ab"] == [4, 4]
    store.vacuum()
    assert reader.read("a").count() == 3                                 # two versions are kept
    store.replace("a", numbers(spark, 0, 5))
    store.vacuum()
    assert store.versions() == [2, 3] and store.at(2).read("a").count() == 4 and store.read("b").count() == 4


def test_two_writers(spark, store):
    one, two = store.change(), store.change()
    for change, n in ((one, 1), (two, 2)):
        change.replace("a", numbers(spark, 0, n))
    one.__exit__(None, None, None)
    with pytest.raises(RuntimeError, match="another writer"):
        two.__exit__(None, None, None)
    assert store.read("a").count() == 1 and store.versions() == [1]


def test_unchanged_buckets_keep_their_files(spark, store):
    with store.change() as change:
        change.replace("a", numbers(spark, 0, 200).unionByName(spark.createDataFrame([(None, 1)], "key bigint, value bigint")), key="key", buckets=16)
    before, old = files(store, "a"), named_in(store.current(), "a")
    keys = spark.createDataFrame([(3,), (4,), (1000,), (None,)], "key bigint")
    touched = touched_buckets(keys, "key", 16)
    with store.change() as change:
        change.replace_keys("a", keys, spark.createDataFrame([(3, -3), (1000, -1), (None, -2)], "key bigint, value bigint"))
    assert {k: v for k, v in files(store, "a").items() if k in before} == before
    new = named_in(store.current(), "a")
    rewritten = {int(p.split("bucket_no=")[1].split("/")[0]) for p in new - old}
    assert rewritten <= set(touched) and 0 < len(touched) < 5
    assert all(int(p.split("bucket_no=")[1].split("/")[0]) in touched for p in old - new)
    expected = {i: i * 10 for i in range(200) if i not in (3, 4)} | {3: -3, 1000: -1, None: -2}
    assert {r["key"]: r["value"] for r in rows(store.read("a"))} == expected
    with store.change() as change:
        change.replace_keys("a", keys.where("false"), numbers(spark, 0, 0))
    assert store.current().number == 2                                   # nothing changed, so there is no new version


def test_keys_are_read_from_their_buckets(spark, store):
    with store.change() as change:
        change.replace("a", numbers(spark, 0, 1000), key="key", buckets=32)
    found = store.current().read_keys("a", spark.createDataFrame([(7,), (7,), (2000,)], "id bigint"))
    assert [r["key"] for r in rows(found)] == [7]
    assert len({p.split("bucket_no=")[1].split("/")[0] for p in found.inputFiles()}) <= 2
    assert store.read("a").where(bucket_of("key", 32) == 3).count() == store.current().read("a", [3]).count()


def test_compaction_bounds_the_parts(spark, store):
    """100 batches of sums leave few folders, and merged rows stay right throughout."""
    merge = lambda df: df.groupBy("key").agg(F.sum("value").alias("value"))
    for number in range(100):
        with store.change() as change:
            change.append("sums", spark.range(number % 7, number % 7 + 3).select(F.col("id").alias("key"), F.lit(1).cast("bigint").alias("value")), "key", 2)
            merged = change.compact("sums", 5, merge)
        if merged:
            store.vacuum()
    reader = store.current()
    assert len(reader.parts("sums")) <= 4 * 3 and len(store._names("sums")) <= 4 * 3 + 2 * 6
    assert rows(merge(reader.read("sums")).agg(F.sum("value").alias("n"))) == [{"n": 300}]
    counts = {k: sum(k in range(n % 7, n % 7 + 3) for n in range(100)) for k in range(9)}
    assert {r["key"]: r["value"] for r in rows(merge(reader.read("sums")))} == counts


def test_a_compaction_that_fails_changes_nothing(spark, store):
    for number in range(3):
        with store.change() as change:
            change.append("a", numbers(spark, number, number + 1), "key", 4)
    with pytest.raises(KeyError), store.change() as change:
        assert change.compact("a", 3)
        assert len(change.parts("a")) == 1
        raise KeyError
    assert len(store.current().parts("a")) == 3 and [r["key"] for r in rows(store.read("a"))] == [0, 1, 2]
    with store.change() as change:
        change.compact("a", 3)
    store.vacuum()
    assert len(store.current().parts("a")) == 1 and [r["key"] for r in rows(store.read("a"))] == [0, 1, 2]


def test_empty_and_new_tables(spark, store):
    with store.change() as change:
        change.append("a", numbers(spark, 0, 0), "key", 4)
        change.replace("b", numbers(spark, 0, 0), key="key", buckets=4)
    assert store.read("a").count() == store.read("b").count() == 0 and store.read("b").columns == ["key", "value"]
    with store.change() as change:
        change.replace_keys("b", numbers(spark, 1, 2).select("key"), numbers(spark, 1, 2))
    store.append("a", numbers(spark, 0, 2))
    store.register_views(["a"])
    assert spark.sql("select sum(value) as n from a").first().n == 10 and store.read("b").count() == 1
    assert store.current().tables() == ["a", "b"]


def test_dealt_rows_are_written_where_they_lie(spark, store):
    """Each partition holds rows of one bucket, so a write needs no shuffle and makes one file a partition at most."""
    parts = 3 * -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // 3)
    with_null = numbers(spark, 0, 300).unionByName(spark.createDataFrame([(None, 1)], "key bigint, value bigint"))
    rows_of = dealt(with_null, "key", 3)
    lies = rows_of.select(F.spark_partition_id().alias("p"), bucket_of("key", 3).alias("b"), F.pmod(F.xxhash64("key"), F.lit(parts)).alias("place"))
    assert lies.where("p <> place or p % 3 <> b").isEmpty() and rows_of.rdd.getNumPartitions() == parts
    assert rows_of.groupBy(DEAL, "key").count()._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    with store.change() as change:
        change.replace("a", rows_of.drop(DEAL), key="key", buckets=3, lies_dealt=True)
    assert len(named_in(store.current(), "a")) <= parts
    assert store.read("a").where(bucket_of("key", 3) == 1).count() == store.current().read("a", [1]).count()
    keys = numbers(spark, 5, 6).select("key")
    with store.change() as change:                                       # rows of other keys in the bucket stay
        change.replace_keys("a", keys, dealt(spark.createDataFrame([(5, -5)], "key bigint, value bigint"), "key", 3).drop(DEAL), lies_dealt=True)
    expected = {i: i * 10 for i in range(300)} | {5: -5, None: 1}
    assert {r["key"]: r["value"] for r in rows(store.read("a"))} == expected and store.read("a").count() == 301
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_pieces_of_a_key_lie_apart_in_its_bucket(spark):
    pieces = dealt(spark.range(40).select(F.lit(7).alias("key"), "id"), "key", 2, F.col("id") % 2)
    lies = rows(pieces.select(F.spark_partition_id().alias("p"), "id").groupBy("p").agg(F.count("*").alias("n")))
    assert [r["n"] for r in lies] == [20, 20] and len({r["p"] % 2 for r in lies}) == 1


def test_only_the_key_of_dealt_rows_has_ranges(spark, store):
    with store.change() as change:
        change.replace("a", dealt(numbers(spark, 0, 100), "key", 2).drop(DEAL), key="key", buckets=2, lies_dealt=True)
    group = pq.ParquetFile(next(Path(store.root, "a").rglob("*.parquet"))).metadata.row_group(0)
    known = {group.column(i).path_in_schema: bool(group.column(i).statistics and group.column(i).statistics.has_min_max) for i in range(2)}
    assert known == {"key": True, "value": False}
    assert store.read("a").where("key = 7 and value = 70").count() == 1
