"""The streaming job: messages in, stored reviews and refreshed result tables out."""

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.ingest import accepted, active_dimension, new_reviews, parse_messages, rejected
from ..plans.analytics import run_all, run_touched, staged_run, write_all
from ..schemas import RESULT_TABLES
from ..sources.topics import to_messages
from .store import ReviewStore


@dataclass
class ReviewIngest:
    """Handler of micro-batches.

    ``results`` is a ``TableFolder`` or ``JdbcTables``. The result tables follow after every ``refresh_every``-th
    batch; 0 leaves refreshing to a separate job, which suits large stores. ``incremental`` recomputes only the
    businesses that got reviews and their markets, as long as the as-of day stays the same; the first refresh of a
    process is always full, as it cannot know what an earlier one left undone.
    """

    store: ReviewStore
    results: object
    business: DataFrame
    users: DataFrame
    asof: object = None
    min_reviews: int | None = None
    refresh_every: int = 1
    incremental: bool = False
    _batches: set = field(default_factory=set)      # with new reviews that the result tables do not show yet
    _fresh_on: object = None                        # as-of day of the result tables, once this process has made them

    def process(self, messages: DataFrame, batch_id: int) -> None:
        """Stores the new reviews of a batch. A repeated batch compares against all other batches and replaces
        its own output, so nothing is lost or stored twice. A refresh that is due follows an empty batch, too."""
        parsed = parse_messages(messages).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if not parsed.isEmpty():
                new = new_reviews(accepted(parsed), self.store.reviews_besides(batch_id))
                self.store.write_batch(new, rejected(parsed), batch_id)
                self._batches.add(batch_id)
        finally:
            parsed.unpersist()
        if self.refresh_every and (batch_id + 1) % self.refresh_every == 0:
            self.catch_up()

    def catch_up(self) -> dict[str, int]:
        """Refreshes if reviews came in since the last refresh, or may have before this process began."""
        unknown = self._fresh_on is None and not self.store.reviews().isEmpty()
        return self.refresh() if self._batches or unknown else {}

    def _write_dimensions(self, reviews: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The dimension tables, written first and read back, so that the result tables do not search the reviews
        for active keys again."""
        self.results.replace("business_table", active_dimension(self.business, reviews, "business_id"))
        self.results.replace("user_table", active_dimension(self.users, reviews, "user_id"))
        return self.results.read("business_table"), self.results.read("user_table")

    def refresh(self) -> dict[str, int]:
        """Brings all result tables and both dimension tables up to date; returns the row counts."""
        day = self.asof or self.business.sparkSession.range(1).select(F.current_date()).first()[0]
        if self.incremental and self.min_reviews is None and self._fresh_on == day:
            counts = self._refresh_touched(day)
        else:
            counts = self._refresh_all(day)
        self._batches, self._fresh_on = set(), day
        return counts

    def _refresh_all(self, day) -> dict[str, int]:
        reviews = self.store.reviews()
        run = run_all(*self._write_dimensions(reviews), reviews, day, self.min_reviews)
        try:
            return write_all(run, self.results)
        finally:
            run.release()

    def _refresh_touched(self, day) -> dict[str, int]:
        reviews = self.store.reviews()
        touched = self.store.reviews_of(self._batches).select("business_id")
        stored = {name: self.results.read(name) for name in RESULT_TABLES}
        run = run_touched(stored, touched, *self._write_dimensions(reviews), reviews, day)
        try:
            return write_all(staged_run(run, reviews.sparkSession), self.results)
        finally:
            run.release()


def _start(writer, checkpoint: str, available_now: bool, processing_time: str | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def start_review_stream(messages: DataFrame, ingest: ReviewIngest, checkpoint: str, available_now: bool = False,
                        processing_time: str | None = None) -> StreamingQuery:
    """Feeds a message stream to the ingest. The checkpoint remembers what was read, also across restarts."""
    writer = messages.writeStream.foreachBatch(ingest.process).outputMode("append")
    return _start(writer, checkpoint, available_now, processing_time)


def run_review_stream(messages: DataFrame, ingest: ReviewIngest, checkpoint: str) -> None:
    """Ingests what has arrived and brings the result tables up to date at the end, whatever ``refresh_every`` says."""
    start_review_stream(messages, ingest, checkpoint, available_now=True).awaitTermination()
    ingest.catch_up()


def start_file_replay(numbered: DataFrame, folder: str, checkpoint: str, available_now: bool = False,
                      processing_time: str | None = None) -> StreamingQuery:
    """Publishes a stream of numbered reviews as message files; the checkpoint is the resume marker."""
    writer = to_messages(numbered).writeStream.format("json").option("path", folder).outputMode("append")
    return _start(writer, checkpoint, available_now, processing_time)


def start_topic_replay(numbered: DataFrame, servers: str, topic: str, checkpoint: str, options: dict | None = None,
                       available_now: bool = False, processing_time: str | None = None) -> StreamingQuery:
    """Publishes a stream of numbered reviews to a topic; the checkpoint is the resume marker."""
    writer = (
        to_messages(numbered).writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("topic", topic).options(**(options or {})).outputMode("append")
    )
    return _start(writer, checkpoint, available_now, processing_time)


def without_repeats(parsed: DataFrame, delay: str) -> DataFrame:
    """Variant without a store lookup: drops repeats of a review id that arrive within ``delay`` of event time."""
    timed = parsed.withColumn("event_time", parsed["reviewed_at"].cast("timestamp")).withWatermark("event_time", delay)
    return timed.dropDuplicatesWithinWatermark(["review_id"]).drop("event_time")
