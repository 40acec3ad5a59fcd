"""Review texts clustered by business, for looking up those of one business without a scan of all."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.serving import review_texts
from .versioned import VersionedTables, bucket_of

TABLE = "review_texts"


class TextLookup:
    """The non-empty texts in buckets by business, sorted by business within each file.

    A look-up opens the files of one bucket, and there the row groups whose range of ids holds the business, and parts
    that are not merged yet. A business with very many reviews fills several files of its bucket. Ids are kept
    as text; null businesses are kept, and found by None.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark, self.store, self.buckets = spark, VersionedTables(spark, root), buckets

    @staticmethod
    def _rows(reviews: DataFrame) -> DataFrame:
        return review_texts(reviews).select(F.col("business_id").cast("string"), "review_id", "text")

    def build(self, reviews: DataFrame) -> None:
        """Replaces the stored texts by those of some reviews."""
        with self.store.change() as change:
            change.replace(TABLE, self._rows(reviews), key="business_id", buckets=self.buckets)

    def add(self, reviews: DataFrame, fan_in: int = 8) -> None:
        """Adds the texts of new reviews as a part of their own; parts are merged into buckets in tiers."""
        with self.store.change() as change:
            change.append(TABLE, self._rows(reviews), "business_id", self.buckets)
            change.compact(TABLE, fan_in, sort=("business_id",))

    def texts(self, business_id: str | None) -> DataFrame:
        """(business_id, review_id, text) of one business."""
        reader = self.store.current()
        if TABLE not in reader.tables():
            return self.spark.createDataFrame([], "business_id string, review_id string, text string")
        one = self.spark.range(1).select(F.lit(business_id).cast("string").alias("k"))
        bucket = one.select(bucket_of("k", reader.content["tables"][TABLE]["buckets"])).first()[0]
        return reader.read(TABLE, [bucket]).where(F.col("business_id").eqNullSafe(F.lit(business_id)))
