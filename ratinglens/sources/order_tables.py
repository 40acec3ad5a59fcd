"""Reviews, businesses and users derived from the order-schema test tables.

One order line is one review of the ordering customer by the supplier; customers are the businesses. Keys stay
integers, as the analyses do not depend on the key type.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import DATE_TEXT_FORMAT

AS_OF = "2001-08-01"


@dataclass(frozen=True)
class ReviewTables:
    reviews: DataFrame
    business: DataFrame
    users: DataFrame


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_reviews(spark: SparkSession, folder: str) -> DataFrame:
    line, number = _table(spark, folder, "lineitem"), F.col("l_linenumber")
    shipped = F.col("l_shipdate").cast("timestamp_ntz")
    return line.join(_table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat_ws(
            "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.date_format(shipped, "yyyyMMdd"),
            F.col("l_quantity").cast("int")).alias("review_id"),
        F.col("o_custkey").alias("business_id"),
        F.col("l_suppkey").alias("user_id"),
        F.ceil(F.col("l_quantity") / 10.0).cast("double").alias("stars"),
        number.alias("useful"),
        F.round(F.col("l_tax") * 100).cast("int").alias("funny"),
        F.when(number % 2 != 0, number).alias("cool"),
        F.date_format(shipped, DATE_TEXT_FORMAT).alias("date"),
        shipped.alias("reviewed_at"),
    )


def read_business(spark: SparkSession, folder: str) -> DataFrame:
    key, segment = F.col("c_custkey"), F.col("c_mktsegment")
    nation = _table(spark, folder, "nation").join(
        _table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return _table(spark, folder, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        key.alias("business_id"),
        F.col("c_name").alias("name"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.concat(F.lit("No "), key.cast("string")).alias("address"),
        (key % 180 - 90).cast("double").alias("latitude"),
        (key % 360 - 180).cast("double").alias("longitude"),
        F.when(key % 5 == 0, 0).otherwise(1).alias("is_open"),
        F.when(key % 17 == 0, F.lit(None))
        .when(key % 13 == 0, F.concat(F.lit("Niche"), (key % 4).cast("string"), F.lit(", "), segment))
        .otherwise(F.concat(segment, F.lit(", Services"))).alias("categories"),
    )


def read_users(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("s_suppkey")
    return _table(spark, folder, "supplier").select(
        key.alias("user_id"),
        F.col("s_name").alias("name"),
        F.floor(F.col("s_acctbal") / 100).cast("int").alias("fans"),
        F.when(key % 3 == 0, F.lit("2000,2001")).when(key % 3 == 1, F.lit("")).alias("elite"),
    )


def read_review_tables(spark: SparkSession, folder: str) -> ReviewTables:
    return ReviewTables(read_reviews(spark, folder), read_business(spark, folder), read_users(spark, folder))


def read_review_texts(spark: SparkSession, folder: str) -> DataFrame:
    """The document table as review texts, one business per document source."""
    return _table(spark, folder, "documents").select(
        F.col("doc_id").alias("review_id"), F.col("source").alias("business_id"), "text")
