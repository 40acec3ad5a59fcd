import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratinglens.operators import ingest as I
from ratinglens.session import CHECKPOINT_SETTING, staging_path
from ratinglens.sources.topics import to_messages

from .conftest import rows, same


def test_numbers_follow_date_then_id(make_reviews):
    reviews = make_reviews(
        {"review_id": "c", "date": "2020-01-02"}, {"review_id": "b", "date": "2020-01-01"},
        {"review_id": "a", "date": "2020-01-02"}, {"review_id": "z", "date": None})
    found = {r["review_id"]: r["id_date"] for r in rows(I.number_by_date(reviews))}
    assert found == {"z": 1, "b": 2, "a": 3, "c": 4}


def test_numbers_are_dense_with_one_hot_date(spark):
    reviews = spark.range(20_000).select(
        F.format_string("r%05d", "id").alias("review_id"),
        F.when(F.col("id") % 3 > 0, "2020-06-01").otherwise(
            F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 300).cast("int")).cast("string")).alias("date"))
    numbered = I.number_by_date(reviews)
    expected = [r["review_id"] for r in reviews.orderBy("date", "review_id").collect()]
    assert [r["review_id"] for r in numbered.orderBy("id_date").collect()] == expected
    ends = numbered.agg(F.min("id_date"), F.max("id_date"), F.countDistinct("id_date")).first()
    assert tuple(ends) == (1, 20_000, 20_000)


def test_staging_uses_the_shared_folder(spark):
    assert staging_path(spark, "x").startswith(spark.conf.get(CHECKPOINT_SETTING))


def test_batches(spark):
    numbered = spark.range(1, 1202).select(F.col("id").alias("id_date"))
    batched = I.with_batch_id(numbered)
    assert rows(I.batch_count(batched)) == [{"batches": 3}]
    bounds = sorted(tuple(r.values()) for r in rows(I.batch_bounds(batched)))
    assert bounds == [(0, 1, 500, 500), (1, 501, 1000, 500), (2, 1001, 1201, 201)]
    assert [r["id_date"] for r in I.batch_slice(numbered, 2).collect()] == list(range(1001, 1202))
    assert I.unsent_batches(batched).count() == 1201
    assert I.unsent_batches(batched, last_sent=1).count() == 201
    assert same(I.batch_slice(numbered, 1), batched.filter("batch_id = 1").drop("batch_id"))


def test_messages_round_trip(make_reviews):
    reviews = make_reviews({"cool": 2, "text": 'quote " and\nnewline é'}, {"date": "never"})
    parsed = I.parse_messages(to_messages(reviews))
    assert same(reviews, parsed.select(reviews.columns))
    assert {r["date"]: r["reviewed_at"] is None for r in parsed.collect()} == {
        "2020-01-15 10:00:00": False, "never": True}


def test_malformed_messages_are_rejected(spark):
    texts = ["{broken", "[]", '{"stars": 3}', '{"review_id": "ok", "stars": 4.5}', "", '{"review_id": "x", "stars": "no"}']
    parsed = I.parse_messages(spark.createDataFrame([(None, t) for t in texts], "key string, value string"))
    assert [r["review_id"] for r in rows(I.accepted(parsed))] == ["ok", "x"]
    assert sorted(r["value"] for r in rows(I.rejected(parsed))) == sorted(["{broken", "[]", '{"stars": 3}', ""])


def test_one_row_per_id_is_deterministic(make_reviews):
    payloads = [{"review_id": "a", "date": "2020-01-02", "stars": 1.0}, {"review_id": "a", "date": "2020-01-01", "stars": 5.0},
                {"review_id": "a", "date": "2020-01-01", "stars": 4.0}, {"review_id": None}, {"review_id": "b"}, {"review_id": "b"}]
    for order in (payloads, payloads[::-1]):
        found = rows(I.one_per_review(make_reviews(*order).repartition(3)))
        assert [(r["review_id"], r["stars"]) for r in found] == [("a", 4.0), ("b", 3.0)]


def test_new_and_all_reviews(make_reviews):
    stored = make_reviews({"review_id": "old", "stars": 1.0})
    reordered = stored.select(*reversed(stored.columns))
    incoming = make_reviews({"review_id": "old", "stars": 5.0}, {"review_id": "new"}, {"review_id": "new"})
    new = I.new_reviews(incoming, reordered)
    assert [r["review_id"] for r in rows(new)] == ["new"]
    everything = rows(I.all_reviews(reordered, new))
    assert {(r["review_id"], r["user_id"], r["business_id"]) for r in everything} == {("old", "u", "b"), ("new", "u", "b")}


def test_active_dimensions(make_reviews, make_business):
    business = make_business({}, {}, {"categories": None})
    reviews = make_reviews(*[{"business_id": b} for b in ["b000"] * 5 + ["b001"] * 4 + ["b002"] * 6 + [None]])
    assert [r["business_id"] for r in rows(I.active_dimension(business, reviews.limit(5), "business_id"))] == ["b000"]
    assert [r["business_id"] for r in rows(I.active_business(business, reviews))] == ["b000"]
    assert I.reviews_of_active(reviews).count() == 11


def test_membership_time(spark):
    users = spark.createDataFrame([("2010-02-03 04:05:06",), ("unknown",), (None,)], "yelping_since string")
    found = I.with_membership_time(users)
    assert found.schema["yelping_since"].dataType == T.TimestampType()
    assert sorted(str(r[0]) for r in found.collect()) == ["2010-02-03 04:05:06", "None", "None"]
    assert same(found, I.with_membership_time(found))
