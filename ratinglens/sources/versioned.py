"""Tables in one folder that change together: versions, buckets, parts and their compaction.

A version is a small JSON file that names the live files of all tables. A change writes new folders beside those in
use and adds the next version last, so a reader sees either all of a change or nothing of it, and a writer that
fails leaves every table as it was.

A table consists of parts. Appended parts hold one batch each; ``compact`` merges many small parts into one, in tiers,
so that each row is rewritten a number of times that grows with the logarithm of the number of batches. Merged parts
and those written by key are split into buckets by a hash of the key: a reader that knows its keys opens their
buckets only, and rewriting some keys leaves the files of all other buckets alone.

One writer at a time; readers need no lock. Files that no kept version names go with ``vacuum``.
"""

import json
import uuid
from collections.abc import Callable, Iterable
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEAL = "_deal"                # names the partition of a dealt row
_BUCKET = "bucket_no"
_VERSIONS = "_versions"
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
_MOST_OPEN = 8                # files that a task writes at once before it sorts its rows by bucket


def bucket_of(key: str, buckets: int) -> Column:
    """Bucket of a row; null keys have one, too."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def touched_buckets(keys: DataFrame, key: str, buckets: int) -> list[int]:
    """The buckets that some keys lie in: at most ``buckets`` numbers, made distinct before they reach the driver."""
    return sorted(r[0] for r in keys.select(bucket_of(key, buckets).alias("b")).distinct().collect())


def _ranges_of(key: str) -> dict[str, str]:
    """Parquet options: least and greatest values are kept of the key only. Each file has rows of all kinds, so the values of
    other columns leave out no file, and finding them takes a fifth of the time of a write of wide rows."""
    return {"parquet.column.statistics.enabled": "false", f"parquet.column.statistics.enabled#{key}": "true"}


@lru_cache(maxsize=None)
def _names_of_partitions(spark: SparkSession, partitions: int) -> tuple[int, ...]:
    """For each partition the least number that Spark's hash partitioning puts there."""
    number = F.col("id").cast("int")
    found = spark.range(32 * partitions).groupBy(F.pmod(F.hash(number), F.lit(partitions)).alias("place")).agg(F.min(number).alias("name"))
    names = {r["place"]: r["name"] for r in found.collect()}
    return tuple(names.get(place, place) for place in range(partitions))


def dealt(df: DataFrame, key: str, buckets: int, piece: Column | None = None) -> DataFrame:
    """Rows of a key in one partition, and in each partition rows of one bucket only, in a shuffle that adaptive execution leaves
    as it is. Steps that group by the added column ``DEAL`` and the key, and a write of ``dealt`` rows, need no other shuffle.

    ``piece`` (0, 1, ...) puts the pieces of a key with very many rows into different partitions.
    """
    partitions = buckets * -(-int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // buckets)
    place = F.pmod(F.xxhash64(key), F.lit(partitions))
    if piece is not None:
        place = F.pmod(place + piece * buckets, F.lit(partitions))
    names = F.lit(list(_names_of_partitions(df.sparkSession, partitions)))
    return df.withColumn(DEAL, F.element_at(names, (place + 1).cast("int"))).repartition(partitions, DEAL)


class Reader:
    """The tables of one version."""

    def __init__(self, store: "VersionedTables", content: dict):
        self.store, self.spark, self.content = store, store.spark, content
        self._looked_up = {}          # keys -> (keys, their buckets), as the same keys are looked up in many tables

    @property
    def number(self) -> int:
        return self.content["number"]

    @property
    def meta(self) -> dict:
        return self.content["meta"]

    def tables(self) -> list[str]:
        return sorted(self.content["tables"])

    def parts(self, name: str) -> list[dict]:
        return self.content["tables"][name]["parts"]

    def read(self, name: str, buckets: Iterable[int] | None = None) -> DataFrame:
        """A table, or of its bucketed parts only some buckets; parts without buckets are read as a whole."""
        table = self.content["tables"][name]
        return self._open(table["schema"], table["parts"], None if buckets is None else set(buckets))

    def read_keys(self, name: str, keys: DataFrame, whole: Iterable[int] = ()) -> DataFrame:
        """A table's rows with a key among ``keys`` (one column, nulls count as a key), from the buckets of those keys only.

        ``whole`` are buckets in which the table has no other key: their rows are taken without a join.
        """
        table = self.content["tables"][name]
        key, count = table["key"], table["buckets"]
        wanted = keys.select(F.col(keys.columns[0]).alias("_wanted")).distinct()
        touched = self._buckets_of(keys, count)
        whole = touched & set(whole)
        if len(whole) == count:
            return self.read(name)
        bucket = bucket_of(key, count)                     # parts without buckets are read as a whole
        rows = self.read(name, touched - whole)
        if whole:
            rows = rows.where(~bucket.isin(whole))
        found = rows.join(wanted, rows[key].eqNullSafe(wanted["_wanted"]), "left_semi")
        return found.unionByName(self.read(name, whole).where(bucket.isin(whole))) if whole else found

    def _buckets_of(self, keys: DataFrame, count: int) -> set[int]:
        if (id(keys), count) not in self._looked_up:
            self._looked_up[id(keys), count] = keys, set(touched_buckets(keys, keys.columns[0], count))
        return self._looked_up[id(keys), count][1]

    def _open(self, schema: str, parts: list[dict], wanted: set[int] | None = None) -> DataFrame:
        paths = []
        for part in parts:
            folder = f"{self.store.root}/{part['folder']}"
            if part["buckets"] is None:
                paths.append(folder)
            else:
                paths += [f"{folder}/{_BUCKET}={b}" for b in part["buckets"] if wanted is None or b in wanted]
        schema = T.StructType.fromJson(json.loads(schema))
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)


class Change(Reader):
    """A change in the making: reads see what it has written so far.

    As a context it commits at its end, if nothing failed and anything changed.
    """

    def __init__(self, store: "VersionedTables", content: dict):
        super().__init__(store, content)
        self._begun = json.loads(json.dumps(content))

    def __enter__(self) -> "Change":
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is None and self.content != self._begun:
            self.store._commit(self.content)

    def _write(self, name: str, df: DataFrame, key: str | None = None, buckets: int | None = None, sort=(), tier: int = 0,
               lies_dealt: bool = False) -> dict:
        """Writes a part; a bucketed one with the rows of each bucket in files of their own, a large bucket in several.

        Rows that lie ``dealt`` are written where they are.
        """
        folder = f"{name}/{uuid.uuid4().hex}"
        path = f"{self.store.root}/{folder}"
        if buckets is None:
            (df.sortWithinPartitions(*sort) if sort else df).write.parquet(path)
            return {"folder": folder, "tier": tier, "buckets": None}
        rows = df.withColumn(_BUCKET, bucket_of(key, buckets))
        if lies_dealt:
            with self._several_files():
                rows.write.options(**_ranges_of(key)).partitionBy(_BUCKET).parquet(path)
        else:
            rows.hint("rebalance", _BUCKET).sortWithinPartitions(_BUCKET, *(sort or [key])).write.partitionBy(_BUCKET).parquet(path)
        return {"folder": folder, "tier": tier, "buckets": self.store._buckets_in(path)}

    @contextmanager
    def _several_files(self):
        """Writes within do not sort their rows by bucket, as a task has rows of few."""
        before = self.spark.conf.get(_OPEN_FILES, None)
        self.spark.conf.set(_OPEN_FILES, str(_MOST_OPEN))
        try:
            yield
        finally:
            if before is None:
                self.spark.conf.unset(_OPEN_FILES)
            else:
                self.spark.conf.set(_OPEN_FILES, before)

    def _table(self, name: str, df: DataFrame, key: str | None, buckets: int | None) -> dict:
        known = self.content["tables"].get(name, {})
        return {"schema": json.dumps(_nullable(df.schema)), "key": key or known.get("key"), "buckets": buckets or known.get("buckets"), "parts": []}

    def append(self, name: str, df: DataFrame, key: str | None = None, buckets: int | None = None) -> None:
        """Adds rows as a part of their own; the key and the number of buckets are set with the first rows."""
        table = self.content["tables"].get(name) or self._table(name, df, key, buckets)
        columns = T.StructType.fromJson(json.loads(table["schema"])).names
        self.content["tables"][name] = table | {"parts": [*table["parts"], self._write(name, df.select(columns))]}

    def last_part(self, name: str) -> DataFrame:
        """The rows that were appended last."""
        table = self.content["tables"][name]
        return self._open(table["schema"], table["parts"][-1:])

    def drop_last_part(self, name: str) -> None:
        self.content["tables"][name] |= {"parts": self.content["tables"][name]["parts"][:-1]}

    def replace(self, name: str, df: DataFrame, order_by: dict | None = None, key: str | None = None, buckets: int | None = None,
                lies_dealt: bool = False) -> None:
        """Replaces a whole table. ``order_by`` (column -> ascending) range-sorts a table without buckets; rows that lie
        ``dealt`` are not dealt to their buckets once more."""
        table = self._table(name, df, key, buckets)
        if order_by and not table["buckets"]:
            df = df.orderBy(*order_by, ascending=list(order_by.values()))
        self.content["tables"][name] = table | {"parts": [self._write(name, df, table["key"], table["buckets"], lies_dealt=lies_dealt)]}

    def replace_keys(self, name: str, keys: DataFrame, rows: DataFrame, whole: Iterable[int] = (), lies_dealt: bool = False) -> None:
        """Puts ``rows`` in the place of all rows with a key among ``keys``; buckets without such a key keep their files.

        ``whole`` are buckets in which the table has no other key: their old rows are not read. ``rows`` that lie ``dealt`` are
        not dealt to their buckets once more.
        """
        table = self.content["tables"][name]
        key, count, columns = table["key"], table["buckets"], T.StructType.fromJson(json.loads(table["schema"])).names
        wanted = keys.select(F.col(keys.columns[0]).alias("_wanted")).distinct()
        touched = self._buckets_of(keys, count)
        if not touched:
            return
        rows = rows.select(columns)
        if touched - set(whole):
            old = self.read(name, touched - set(whole))
            old = old.join(wanted, old[key].eqNullSafe(wanted["_wanted"]), "left_anti")
            rows = (dealt(old, key, count).select(columns) if lies_dealt else old).unionByName(rows)
        part = self._write(name, rows, key, count, lies_dealt=lies_dealt)
        kept = [p | {"buckets": [b for b in p["buckets"] if b not in touched]} for p in table["parts"]]
        self.content["tables"][name] = table | {"parts": [*[p for p in kept if p["buckets"]], part]}

    def compact(self, name: str, fan_in: int, merge: Callable[[DataFrame], DataFrame] | None = None, sort=()) -> bool:
        """Merges ``fan_in`` parts of one tier into one of the next, as long as a tier has so many. True if any were merged.

        ``merge`` combines the rows of the merged parts, such as partial sums of one key; by default they stay as they are.
        """
        merged = False
        while True:
            table = self.content["tables"].get(name, {"parts": []})
            tiers = sorted({p["tier"] for p in table["parts"]})
            full = next((t for t in tiers if sum(p["tier"] == t for p in table["parts"]) >= fan_in), None)
            if full is None:
                return merged
            chosen = [p for p in table["parts"] if p["tier"] == full]
            df = self._open(table["schema"], chosen)
            part = self._write(name, merge(df) if merge else df, table["key"], table["buckets"], sort, full + 1)
            rest = [p for p in table["parts"] if p["tier"] != full]
            self.content["tables"][name] = table | {"parts": [part, *rest] if part["buckets"] != [] else rest}
            merged = True

    def drop(self, name: str) -> None:
        self.content["tables"].pop(name, None)


class VersionedTables:
    """Tables below one folder on shared storage; ``keep`` versions stay readable after ``vacuum``."""

    def __init__(self, spark: SparkSession, root: str, keep: int = 2):
        self.spark, self.root, self.keep = spark, root.rstrip("/"), keep

    def _path(self, name: str = ""):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _files(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        files, path = self._files(), self._path(folder)
        return [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []

    def _buckets_in(self, path: str) -> list[int]:
        names = self._names(path.removeprefix(f"{self.root}/"))
        return sorted(int(n.removeprefix(f"{_BUCKET}=")) for n in names if n.startswith(f"{_BUCKET}="))

    def versions(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self._names(_VERSIONS) if n.endswith(".json") and not n.startswith("."))

    def at(self, number: int) -> Reader:
        """The tables as they were at a version."""
        stream = self._files().open(self._path(f"{_VERSIONS}/{number}.json"))
        try:
            return Reader(self, json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        finally:
            stream.close()

    def current(self) -> Reader:
        numbers = self.versions()
        return self.at(numbers[-1]) if numbers else Reader(self, {"number": 0, "tables": {}, "meta": {}})

    def read(self, name: str) -> DataFrame:
        return self.current().read(name)

    def change(self) -> Change:
        return Change(self, json.loads(json.dumps(self.current().content)))

    def replace(self, name: str, df: DataFrame, order_by: dict | None = None) -> None:
        with self.change() as change:
            change.replace(name, df, order_by)

    def append(self, name: str, df: DataFrame) -> None:
        with self.change() as change:
            change.append(name, df)

    def _commit(self, content: dict) -> None:
        """Adds the next version: the file is written under another name first, so that it appears complete."""
        files, number = self._files(), content["number"] + 1
        written, final = self._path(f"{_VERSIONS}/.{uuid.uuid4().hex}"), self._path(f"{_VERSIONS}/{number}.json")
        stream = files.create(written, False)
        try:
            stream.write(bytearray(json.dumps(content | {"number": number}).encode()))
        finally:
            stream.close()
        if files.exists(final) or not files.rename(written, final):
            files.delete(written, False)
            raise RuntimeError(f"version {number} of {self.root} was written by another writer")

    def vacuum(self) -> int:
        """Removes all but the last ``keep`` versions and the folders that none of those names; returns how many folders went."""
        numbers = self.versions()
        live = {part["folder"] for n in numbers[-self.keep:] for t in self.at(n).content["tables"].values() for part in t["parts"]}
        files, gone = self._files(), 0
        for number in numbers[:-self.keep]:
            files.delete(self._path(f"{_VERSIONS}/{number}.json"), False)
        for name in self._names(""):
            if name != _VERSIONS:
                for folder in self._names(name):
                    if f"{name}/{folder}" not in live:
                        gone += bool(files.delete(self._path(f"{name}/{folder}"), True))
        return gone

    def register_views(self, names) -> None:
        """Temporary views over the tables of the current version, for ``spark.sql`` queries by name."""
        reader = self.current()
        for name in names:
            reader.read(name).createOrReplaceTempView(name)


def _nullable(schema: T.StructType) -> dict:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields]).jsonValue()
