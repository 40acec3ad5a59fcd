"""Texts of one business, read from the files of its bucket."""

from pyspark.sql import functions as F

from ratinglens.operators.serving import review_texts
from ratinglens.sources.review_texts import TABLE, TextLookup

from .conftest import same


def test_look_up_equals_a_scan_and_opens_one_bucket(spark, tables, tmp_path):
    lookup = TextLookup(spark, str(tmp_path), buckets=16)
    assert lookup.texts("b").isEmpty()
    reviews = tables.reviews.withColumn("text", F.when(F.col("useful") > 1, F.concat(F.lit("said by "), "user_id")).otherwise(""))
    lookup.build(reviews)
    everything = len(lookup.store.read(TABLE).inputFiles())
    for row in tables.business.orderBy("business_id").limit(3).collect():
        found = lookup.texts(str(row.business_id))
        assert same(found, review_texts(reviews, row.business_id).select(found.columns).withColumn("business_id", F.col("business_id").cast("string")))
        assert len({f.rsplit("/", 2)[1] for f in found.inputFiles()}) <= 1 and len(found.inputFiles()) < everything / 4
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters: [EqualNullSafe(business_id" in plan or "PushedFilters: [IsNotNull(business_id), EqualTo(business_id" in plan
    assert lookup.texts("no such business").isEmpty()


def test_added_texts_are_found_before_and_after_they_are_merged(spark, make_reviews, tmp_path):
    lookup, every = TextLookup(spark, str(tmp_path), buckets=4), []
    for number in range(7):
        new = make_reviews(*[{"review_id": f"{number}-{i}", "business_id": b, "text": t} for i, (b, t) in enumerate(
            [("a", "x"), ("b", "y"), (None, "z"), ("a", ""), ("a", None)])])
        lookup.add(new, fan_in=3)
        every.append(new)
    assert len(lookup.store.current().parts(TABLE)) <= 3
    for business, text in (("a", "x"), ("b", "y"), (None, "z")):
        assert sorted((r.review_id, r.text) for r in lookup.texts(business).collect()) == [
            (f"{n}-{'xyz'.index(text)}", text) for n in range(7)]
