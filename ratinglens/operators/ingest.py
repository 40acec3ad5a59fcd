"""Replay numbering, message parsing and merging of new reviews into the stored ones."""

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed_values as V
from ..functions.calendar import review_time
from ..schemas import REVIEW
from ..session import staging_path

REPLAY_ORDER = ["date", "review_id"]
PLACE_BITS = 33   # monotonically_increasing_id keeps the row's place in its partition in the low 33 bits


def number_by_date(reviews: DataFrame) -> DataFrame:
    """Adds ``id_date``: 1, 2, 3, ... over all reviews by (date, review id), undated ones first.

    The rows are range partitioned and sorted once and staged with their partition number and place; the running
    total of partition sizes then gives the global number. Staging makes the numbers final: they hold when
    executors are lost and however often the result is used. A date with very many reviews is split by review id.
    Runs one job, which writes the staged table.
    """
    spark = reviews.sparkSession
    staged_at = staging_path(spark, "numbered-reviews")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    (
        reviews.repartitionByRange(*REPLAY_ORDER).sortWithinPartitions(*REPLAY_ORDER)
        .select("*", F.spark_partition_id().alias("_part"), place.alias("_place"))
        .write.parquet(staged_at)
    )
    staged = spark.read.parquet(staged_at)
    earlier_parts = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    # one row per shuffle partition: neither the window nor the broadcast grows with the reviews
    offsets = (
        staged.groupBy("_part").agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier_parts), F.lit(0)).alias("_offset"))
    )
    return (
        staged.join(F.broadcast(offsets), "_part")
        .withColumn("id_date", F.col("_offset") + F.col("_place") + 1)
        .drop("_part", "_place", "_offset")
    )


def with_batch_id(numbered: DataFrame, batch_size: int = V.REPLAY_BATCH_SIZE) -> DataFrame:
    """Adds ``batch_id`` = 0, 1, 2, ... for every ``batch_size`` numbered reviews."""
    return numbered.withColumn("batch_id", F.floor((F.col("id_date") - 1) / batch_size).cast("long"))


def batch_count(batched: DataFrame) -> DataFrame:
    """One row: the number of batches."""
    return batched.agg(F.countDistinct("batch_id").alias("batches"))


def batch_slice(numbered: DataFrame, batch_id: int, batch_size: int = V.REPLAY_BATCH_SIZE) -> DataFrame:
    """The reviews of one batch."""
    first = batch_id * batch_size + 1
    return numbered.filter(F.col("id_date").between(first, first + batch_size - 1))


def batch_bounds(batched: DataFrame) -> DataFrame:
    """First and last number and the row count of every batch."""
    return batched.groupBy("batch_id").agg(
        F.min("id_date").alias("first_id"), F.max("id_date").alias("last_id"), F.count("*").alias("reviews"))


def unsent_batches(batched: DataFrame, last_sent: int = -1) -> DataFrame:
    """Reviews of the batches after the last one sent; -1 means that nothing was sent yet."""
    return batched.filter(F.col("batch_id") > last_sent)


def parse_messages(messages: DataFrame) -> DataFrame:
    """Message texts as review columns plus ``reviewed_at`` and the raw ``value``.

    A text that is no review object gives nulls. Works on batch and streaming frames.
    """
    parsed = messages.select(
        F.from_json(F.col("value").cast("string"), REVIEW).alias("data"), F.col("value").cast("string").alias("value"))
    return (
        parsed.select("data.*", "value")
        .withColumn("reviewed_at", F.col("date").try_cast("timestamp_ntz"))
    )


def accepted(parsed: DataFrame) -> DataFrame:
    """Parsed messages that carry a review id."""
    return parsed.filter(F.col("review_id").isNotNull()).drop("value")


def rejected(parsed: DataFrame) -> DataFrame:
    """Raw texts of the messages without a review id."""
    return parsed.filter(F.col("review_id").isNull()).select("value")


def with_review_time(reviews: DataFrame) -> DataFrame:
    """Adds the parsed ``reviewed_at`` where it is missing."""
    return reviews.withColumn("reviewed_at", review_time(reviews))


def one_per_review(reviews: DataFrame) -> DataFrame:
    """One row per review id: of several payloads the earliest date, then the smallest other values.

    A minimum combines on the map side, so an id with very many copies is no hot key. Rows without id are dropped.
    """
    rest = [c for c in reviews.columns if c not in ("review_id", "date")]
    return (
        reviews.filter(F.col("review_id").isNotNull())
        .groupBy("review_id").agg(F.min(F.struct("date", *rest)).alias("row"))
        .select(*[F.col("review_id") if c == "review_id" else F.col(f"row.{c}").alias(c) for c in reviews.columns])
    )


def new_reviews(incoming: DataFrame, stored: DataFrame, small_batch: bool = True) -> DataFrame:
    """Incoming reviews whose id is not stored yet, one row per id.

    The stored ids are first reduced to those that came in again. With a small batch against a large store Spark
    broadcasts the batch's ids (it checks their size) and the stored ids are scanned but not shuffled. A batch that is
    not small (``small_batch=False``) is read once and meets the stored ids where its rows were made distinct, so its
    ids are not shuffled a second time.
    """
    incoming = one_per_review(incoming)
    known = stored.select("review_id")
    if small_batch:
        known = known.join(incoming.select("review_id"), "review_id", "left_semi")
    return incoming.join(known, "review_id", "left_anti").select(incoming.columns)


def all_reviews(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Stored and new reviews together, matched by column name."""
    return stored.unionByName(new, allowMissingColumns=True)


def active_dimension(dimension: DataFrame, reviews: DataFrame, key: str) -> DataFrame:
    """Rows of a dimension that have at least one review.

    The keys are made distinct first, on the map side, so the join sees each key once.
    """
    return dimension.join(reviews.select(key).distinct(), key, "left_semi")


def active_business_ids(reviews: DataFrame, min_reviews: int = V.MIN_ACTIVE_REVIEWS) -> DataFrame:
    return (
        reviews.groupBy("business_id").agg(F.count("*").alias("reviews"))
        .filter(F.col("reviews") >= min_reviews).select("business_id")
    )


def active_business(business: DataFrame, reviews: DataFrame, min_reviews: int = V.MIN_ACTIVE_REVIEWS) -> DataFrame:
    """Businesses with categories and at least ``min_reviews`` reviews."""
    ids = active_business_ids(reviews, min_reviews)
    return business.filter(F.col("categories").isNotNull()).join(ids, "business_id", "left_semi")


def reviews_of_active(reviews: DataFrame, min_reviews: int = V.MIN_ACTIVE_REVIEWS) -> DataFrame:
    """Reviews of the businesses with at least ``min_reviews`` reviews."""
    return reviews.join(active_business_ids(reviews, min_reviews), "business_id", "left_semi")


def with_membership_time(users: DataFrame) -> DataFrame:
    """``yelping_since`` as a timestamp; unreadable text gives null."""
    if isinstance(users.schema["yelping_since"].dataType, T.StringType):
        since = F.try_to_timestamp("yelping_since", F.lit(V.DATE_TEXT_FORMAT))
    else:
        since = F.col("yelping_since").cast("timestamp")
    return users.withColumn("yelping_since", since)
