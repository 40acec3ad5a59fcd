"""Stored reviews: one directory per ingested micro-batch, so a repeated batch replaces itself."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import REVIEW
from ..sources.files import MISSING

BATCH = "ingest_batch"
STORED_REVIEW = T.StructType(
    [*REVIEW.fields, T.StructField("reviewed_at", T.TimestampNTZType()), T.StructField(BATCH, T.LongType())])
REJECTED = T.StructType([T.StructField("value", T.StringType()), T.StructField(BATCH, T.LongType())])


class ReviewStore:
    """Reviews and rejected messages below one folder on shared storage."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _read(self, name: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException as error:
            if error.getCondition() not in MISSING:
                raise
            return self.spark.createDataFrame([], schema)

    def reviews(self) -> DataFrame:
        return self._read("reviews", STORED_REVIEW)

    def rejected(self) -> DataFrame:
        return self._read("rejected", REJECTED)

    def reviews_besides(self, batch_id: int) -> DataFrame:
        """Reviews of the other batches; the batch's own directory is pruned from the scan."""
        return self.reviews().filter(F.col(BATCH) != batch_id)

    def reviews_of(self, batch_ids) -> DataFrame:
        """Reviews of some batches; the other directories are pruned."""
        return self.reviews().filter(F.col(BATCH).isin(sorted(batch_ids)))

    def write_batch(self, new: DataFrame, rejected: DataFrame, batch_id: int) -> None:
        columns = [f.name for f in STORED_REVIEW if f.name != BATCH]
        new.select(columns).write.mode("overwrite").parquet(f"{self.root}/reviews/{BATCH}={batch_id}")
        rejected.select("value").write.mode("overwrite").parquet(f"{self.root}/rejected/{BATCH}={batch_id}")


class TableReviewStore:
    """Reviews and rejected messages as two tables that are appended to, with the interface of ``ReviewStore``.

    ``tables`` is a ``JdbcTables`` or ``TableFolder`` in which the tables ``review_table`` and ``rejected_table``
    exist. Rows of a table cannot be replaced by batch; instead a repeated batch adds what is missing: its reviews
    are compared with all stored ones, those that it stored itself included.
    """

    def __init__(self, tables):
        self.tables = tables

    def reviews(self) -> DataFrame:
        return self.tables.read("review_table")

    def rejected(self) -> DataFrame:
        return self.tables.read("rejected_table")

    def reviews_besides(self, batch_id: int) -> DataFrame:
        return self.reviews()

    def reviews_of(self, batch_ids) -> DataFrame:
        return self.reviews().filter(F.col(BATCH).isin(sorted(batch_ids)))

    def write_batch(self, new: DataFrame, rejected: DataFrame, batch_id: int) -> None:
        batch = F.lit(batch_id).cast("long").alias(BATCH)
        self.tables.append("review_table", new.select(*[f.name for f in STORED_REVIEW if f.name != BATCH], batch))
        stored = self.rejected().filter(F.col(BATCH) == batch_id).select(F.col("value").alias("_stored"))
        missing = rejected.join(stored, rejected["value"].eqNullSafe(stored["_stored"]), "left_anti")
        self.tables.append("rejected_table", missing.select("value", batch))
