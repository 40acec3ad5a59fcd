"""The replay of a dump of reviews: numbered by date, cut into batches, and sent in order with a marker to resume from.

The numbered reviews are staged once as messages, in folders of ``BLOCK`` batches each and sorted by number, so that a batch
is read from its own block, whose row groups are pruned by number; the dump is not filtered anew for each batch.
"""

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..operators.ingest import number_by_date
from ..sources.topics import publish, to_messages

BLOCK = 1000        # batches whose reviews lie in one folder
_SCHEMA = "key string, value string, id_date bigint, block bigint"


@dataclass
class Replay:
    """A replay below one folder on shared storage. ``block`` and ``batch_size`` have to stay as they were when it was staged."""

    spark: SparkSession
    folder: str
    batch_size: int = V.REPLAY_BATCH_SIZE
    block: int = BLOCK

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder.rstrip('/')}/{name}")

    def _number_in(self, name: str, missing: int) -> int:
        path = self._path(name)
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(path):
            return missing
        stream = files.open(path)
        try:
            return int(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _write_number(self, name: str, number: int) -> None:
        """The new number is complete under another name before the old one goes; a failure between the two leaves the new file
        under that name, from which ``_recovered`` takes it."""
        final, written = self._path(name), self._path(f"{name}.next")
        files = final.getFileSystem(self.spark._jsc.hadoopConfiguration())
        partial = self._path(f"{name}.part")
        stream = files.create(partial, True)
        try:
            stream.write(bytearray(str(number).encode()))
        finally:
            stream.close()
        files.delete(written, False)
        files.rename(partial, written)
        files.delete(final, False)
        files.rename(written, final)

    def _recovered(self, name: str, missing: int) -> int:
        return max(self._number_in(name, missing), self._number_in(f"{name}.next", missing))

    def stage(self, reviews: DataFrame) -> int:
        """Numbers the reviews and stores their messages by block; returns the number of batches. Done once: a staged dump stays."""
        if (batches := self._recovered("batches", -1)) >= 0:
            return batches
        numbered = number_by_date(reviews)
        block = F.floor((F.col("id_date") - 1) / (self.batch_size * self.block)).cast("long")
        messages = to_messages(numbered).select("key", "value", F.get_json_object("value", "$.id_date").cast("long").alias("id_date"))
        (
            messages.withColumn("block", block).repartitionByRange("block", "id_date").sortWithinPartitions("block", "id_date")
            .write.mode("overwrite").partitionBy("block").parquet(f"{self.folder.rstrip('/')}/messages")
        )
        last = self.messages().agg(F.max("id_date")).first()[0] or 0
        self._write_number("batches", -(-last // self.batch_size))
        return self._recovered("batches", -1)

    def messages(self) -> DataFrame:
        return self.spark.read.schema(_SCHEMA).parquet(f"{self.folder.rstrip('/')}/messages")

    def batch(self, number: int) -> DataFrame:
        """(key, value) of one batch in the order of their numbers, from the folder of its block."""
        first = number * self.batch_size + 1
        chosen = self.messages().where((F.col("block") == number // self.block) & F.col("id_date").between(first, first + self.batch_size - 1))
        return chosen.sort("id_date").select("key", "value")

    def last_sent(self) -> int:
        """Number of the last batch sent; -1 if none was."""
        return self._recovered("last_sent", -1)

    def run(self, send: Callable[[DataFrame, int], None], at_most: int | None = None, seconds: float = 0) -> int:
        """Sends the batches that were not sent yet, one after the other, with a pause between them; returns how many.

        The marker moves after a batch was sent, so a batch may be sent again after a failure but none is left out.
        """
        batches, first = self._recovered("batches", -1), self.last_sent() + 1
        if batches < 0:
            raise ValueError("stage the reviews first")
        end = batches if at_most is None else min(batches, first + at_most)
        for number in range(first, end):
            if number > first and seconds:
                time.sleep(seconds)
            send(self.batch(number), number)
            self._write_number("last_sent", number)
        return max(0, end - first)


def to_files(folder: str) -> Callable[[DataFrame, int], None]:
    """Sends a batch to message files in a folder of its own, which a repeated batch replaces."""
    return lambda messages, number: messages.write.mode("overwrite").json(f"{folder.rstrip('/')}/batch={number}")


def to_topic(servers: str, topic: str, options: dict | None = None) -> Callable[[DataFrame, int], None]:
    """Sends a batch to a topic, where a repeated batch appears twice; the ingest stores each review once."""
    return lambda messages, number: publish(messages, servers, topic, options)
