"""A stream in any number of batches ends with the tables of one batch run."""

from random import Random

import pytest
from pyspark.sql import functions as F

from ratinglens.operators import ingest as I
from ratinglens.plans.analytics import run_all, run_touched, write_all
from ratinglens.schemas import RESULT_TABLES, REVIEW
from ratinglens.sources.files import TableFolder
from ratinglens.sources.order_tables import AS_OF
from ratinglens.sources.topics import read_message_files, to_messages, write_message_files
from ratinglens.streaming.review_stream import (
    ReviewIngest,
    run_review_stream,
    start_file_replay,
    start_review_stream,
    without_repeats,
)
from ratinglens.streaming.store import REJECTED, STORED_REVIEW, ReviewStore, TableReviewStore

from .conftest import rows, same


@pytest.fixture
def text_keys(tables):
    """The test tables with text ids, as messages carry them."""
    def as_text(df, *keys):
        return df.select(*[F.col(c).cast("string").alias(c) if c in keys else F.col(c) for c in df.columns])
    return (as_text(tables.business, "business_id"), as_text(tables.users, "user_id"),
            as_text(tables.reviews, "business_id", "user_id").drop("reviewed_at"))


def test_stream_equals_batch(spark, text_keys, tmp_path):
    business, users, reviews = text_keys
    folder, results = str(tmp_path / "messages"), TableFolder(spark, str(tmp_path / "results"))
    ingest = ReviewIngest(ReviewStore(spark, str(tmp_path / "store")), results, business, users, AS_OF, refresh_every=0)
    parts = reviews.withColumn("part", F.pmod(F.xxhash64("review_id"), F.lit(3)))

    def publish(part):
        write_message_files(to_messages(parts.filter(F.col("part") == part).drop("part")).coalesce(1), folder)

    def run():
        query = start_review_stream(read_message_files(spark, folder, 1), ingest, str(tmp_path / "checkpoint"),
                                    available_now=True)
        query.awaitTermination()

    publish(2)
    publish(0)
    run()
    publish(1)
    publish(0)                                                          # repeats
    write_message_files(spark.createDataFrame([(None, "{broken")], "key string, value string"), folder)
    run()                                                               # restart from the checkpoint
    stored = ingest.store.reviews()
    assert same(reviews, stored.select(reviews.columns))
    assert [r["value"] for r in rows(ingest.store.rejected())] == ["{broken"]

    # a repeated batch replaces itself
    before = stored.groupBy("ingest_batch").count().collect()
    ingest.process(spark.read.json(folder, schema="key string, value string").filter("value like '{\"%'"), 0)
    assert ingest.store.reviews().count() == reviews.count()
    assert len(before) >= 3

    counts = ingest.refresh()
    assert set(counts) == set(RESULT_TABLES) and all(counts.values())
    one_run = run_all(business, users, I.with_review_time(reviews), AS_OF)
    for name, columns in RESULT_TABLES.items():
        table = results.read(name)
        assert table.columns == columns and table.count() == counts[name]
        exact = [c for c in columns if c not in ("early_avg", "recent_avg")]
        assert same(one_run.tables[name].select(exact), table.select(exact)), name
    one_run.release()
    assert results.read("business_table").count() == reviews.select("business_id").distinct().count()


@pytest.mark.parametrize("incremental", [False, True])
def test_refresh_after_batches(spark, make_reviews, make_business, tmp_path, incremental):
    users = spark.createDataFrame([("u", "Ann", "")], "user_id string, name string, elite string")
    results = TableFolder(spark, str(tmp_path / "results"))
    ingest = ReviewIngest(ReviewStore(spark, str(tmp_path / "store")), results, make_business({}, {}), users, "2020-02-01",
                          incremental=incremental)
    ingest.process(to_messages(make_reviews().limit(0)), 0)             # an empty batch does nothing
    assert ingest.store.reviews().isEmpty() and not (tmp_path / "results").exists()
    ingest.process(to_messages(make_reviews({"business_id": "b000"}, {"business_id": "b001"})), 1)
    assert results.read("business_overview").count() == 2
    # a late review changes history
    late = make_reviews({"review_id": "late", "business_id": "b000", "stars": 5.0, "date": "2010-01-01 00:00:00"})
    ingest.process(to_messages(late), 2)
    found = {r["business_id"]: r["average_rating"] for r in rows(results.read("business_overview"))}
    assert found == {"b000": 4.0, "b001": 3.0}


def test_due_refreshes_are_not_lost(spark, make_reviews, make_business, tmp_path):
    users = spark.createDataFrame([("u", "Ann", "")], "user_id string, name string, elite string")
    results = TableFolder(spark, str(tmp_path / "results"))
    ingest = ReviewIngest(ReviewStore(spark, str(tmp_path / "store")), results, make_business({}, {}), users, "2020-02-01",
                          refresh_every=2)
    ingest.process(to_messages(make_reviews({"business_id": "b000"})), 0)
    assert not (tmp_path / "results").exists()
    ingest.process(to_messages(make_reviews().limit(0)), 1)             # empty, but a refresh is due
    assert results.read("business_overview").count() == 1
    folder = str(tmp_path / "messages")
    write_message_files(to_messages(make_reviews({"review_id": "x", "business_id": "b001"})), folder)
    run_review_stream(read_message_files(spark, folder), ingest, str(tmp_path / "checkpoint"))   # batch 0 of its own
    assert results.read("business_overview").count() == 1 and ingest.catch_up() == {}


def test_store_in_tables(spark, make_reviews, tmp_path):
    """A repeated batch adds only what is missing."""
    tables = TableFolder(spark, str(tmp_path / "database"))
    tables.append("review_table", spark.createDataFrame([], STORED_REVIEW))
    tables.append("rejected_table", spark.createDataFrame([], REJECTED))
    ingest = ReviewIngest(TableReviewStore(tables), None, None, None, refresh_every=0)
    broken = spark.createDataFrame([(None, "{broken")], "key string, value string")
    ingest.process(to_messages(make_reviews({}, {})), 0)
    for _ in range(2):
        ingest.process(to_messages(make_reviews({}, {}, {})).unionByName(broken), 1)
    assert sorted((r["review_id"], r["ingest_batch"]) for r in ingest.store.reviews().collect()) == [("r0", 0), ("r1", 0), ("r2", 1)]
    assert [r["value"] for r in ingest.store.rejected().collect()] == ["{broken"]
    assert [r["review_id"] for r in ingest.store.reviews_of({1}).collect()] == ["r2"]


@pytest.mark.parametrize("seed", [1, 2])
def test_touched_businesses_alone_give_the_whole(spark, make_reviews, make_business, seed):
    """Any split in two, with late reviews and new businesses, brought up to date equals all at once."""
    random = Random(seed)
    users = spark.createDataFrame([(f"u{i}", "Ann", "2020" if i % 2 else None) for i in range(4)],
                                  "user_id string, name string, elite string")
    business = make_business(*[{"state": random.choice("stu"), "city": random.choice(["c", "d", None])} for _ in range(12)])
    reviews = make_reviews(*[{
        "business_id": f"b{random.randrange(12):03}", "user_id": f"u{random.randrange(5)}", "stars": float(random.randint(1, 5)),
        "date": f"20{random.randint(15, 20)}-{random.randint(1, 12):02}-11 10:00:00"} for _ in range(60)],
        {"review_id": "x", "business_id": None}, {"review_id": "r5x", "business_id": None})
    is_late = F.col("review_id").isin([f"r{i}" for i in random.sample(range(60), 4)] + ["r5x"])
    early, late = reviews.filter(~is_late), reviews.filter(is_late)
    first, whole = (run_all(business, users, r, "2020-12-31") for r in (early, reviews))
    found = run_touched(first.tables, late.select("business_id"), business, users, reviews, "2020-12-31")
    for name in RESULT_TABLES:
        assert same(found.tables[name], whole.tables[name]), name
    for run in (first, whole, found):
        run.release()


def test_replay_resumes_from_its_checkpoint(spark, make_reviews, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("numbered", "messages", "checkpoint"))
    reviews = make_reviews({"date": "2020-01-02"}, {"date": "2020-01-01"}, {"date": "2020-01-03"})
    numbered = I.number_by_date(reviews)
    stream = lambda: spark.readStream.schema(numbered.schema).parquet(source)
    for condition in ("id_date <= 2", "id_date = 3"):
        numbered.filter(condition).write.mode("append").parquet(source)
        start_file_replay(stream(), target, checkpoint, available_now=True).awaitTermination()
    sent = I.parse_messages(spark.read.json(target, schema="key string, value string"))
    assert sorted((r["id_date"], r["review_id"]) for r in sent.collect()) == [(1, "r1"), (2, "r0"), (3, "r2")]


def test_repeats_within_watermark(spark, make_reviews, tmp_path):
    folder = str(tmp_path / "messages")
    reviews = make_reviews({"review_id": "a"}, {"review_id": "a"}, {"review_id": "b"})
    write_message_files(to_messages(reviews), folder)
    stream = without_repeats(I.accepted(I.parse_messages(read_message_files(spark, folder))), "1 day")
    query = (stream.writeStream.format("memory").queryName("once").outputMode("append")
             .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    query.awaitTermination()
    assert sorted(r["review_id"] for r in spark.table("once").collect()) == ["a", "b"]


def test_activity_filter_is_optional(spark, make_reviews, make_business):
    users = spark.createDataFrame([("u", "Ann", "")], "user_id string, name string, elite string")
    reviews = make_reviews(*[{"business_id": b} for b in ["b000"] * 5 + ["b001"] * 5 + ["b002"]])
    business = make_business({}, {}, {})
    for minimum, expected in ((None, 3), (5, 2)):
        run = run_all(business, users, reviews, min_reviews=minimum)
        assert run.tables["business_profiles"].count() == expected
        assert run.tables["market_positioning"].count() == expected
        assert run.tables["business_overview"].count() == 3
        run.release()
