"""Review messages: key = review id, value = the review as JSON text.

Kafka needs Spark's connector package on the class path. Message files (JSON lines of key and value) carry the same
rows where no broker is at hand.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MESSAGE = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])


def to_messages(reviews: DataFrame) -> DataFrame:
    """Reviews as messages; every column becomes a field of the JSON object."""
    return reviews.select(
        F.col("review_id").cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def message_text(messages: DataFrame) -> DataFrame:
    """Binary keys and values of a topic as text."""
    return messages.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")


def read_topic(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "earliest",
               max_offsets_per_trigger: int | None = None, options: dict | None = None) -> DataFrame:
    """Stream of a topic's messages, from the first one unless told otherwise."""
    reader = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic).option("startingOffsets", starting_offsets).options(**(options or {}))
    )
    if max_offsets_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return message_text(reader.load())


def publish(messages: DataFrame, servers: str, topic: str, options: dict | None = None) -> None:
    """Writes a batch of messages to a topic."""
    (
        messages.write.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("topic", topic).options(**(options or {})).save()
    )


def read_message_files(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of message files, oldest first."""
    reader = spark.readStream.schema(MESSAGE)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.json(folder)


def write_message_files(messages: DataFrame, folder: str) -> None:
    messages.write.mode("append").json(folder)
