"""Plans that matter at scale: what is read, what is shuffled, what is cut before a shuffle."""

import re

import pytest
from pyspark.sql import functions as F

from ratinglens.functions.key_filter import may_be_among
from ratinglens.operators import business as B
from ratinglens.operators import competitive as C
from ratinglens.operators import ingest as I
from ratinglens.operators import serving as S
from ratinglens.plans import catalog
from ratinglens.plans.analytics import run_all, run_touched
from ratinglens.sources.order_tables import AS_OF, read_business, read_review_tables, read_review_texts

from .conftest import SMALL


@pytest.fixture
def stored(spark, tables, tmp_path):
    """Reviews as a stored table, read back from files."""
    tables.reviews.withColumn("text", F.lit("some text")).write.parquet(str(tmp_path / "reviews"))
    return spark.read.parquet(str(tmp_path / "reviews"))


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are at size."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def plain(spark):
    """Tables without a persist of their own."""
    return read_review_tables(spark, SMALL)


def plan(df, run=False):
    """The whole plan as it is before adaptive execution, or with ``run`` the final one of a query on files.

    Before the run nothing is cut off: Spark may put a table that another test persisted in place of a scan, and such
    a table prints both its own plans in the midst of this one.
    """
    if run:
        df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0] if run else text


def above(text, node):
    """The lines from a node upwards to the root, the node's own last; the plan is printed root first."""
    lines = text.splitlines()
    at = next(i for i, line in enumerate(lines) if node in line)
    depth, path = len(lines[at]), [lines[at]]
    place = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    depth = place(lines[at])
    for line in reversed(lines[:at]):
        if place(line) < depth:
            path.append(line)
            depth = place(line)
    return [line.strip(" :+-") for line in path]


def test_profiles_scan_once_and_only_their_columns(stored):
    text = plan(C.business_profiles(read_business(stored.sparkSession, SMALL), stored, AS_OF))
    reviews, = [columns for columns in re.findall(r"FileScan parquet \[([^\]]*)\]", text) if "stars" in columns]
    assert {c.split("#")[0] for c in reviews.split(",")} == {
        "business_id", "user_id", "stars", "useful", "funny", "cool", "reviewed_at"}
    assert "SortAggregate" not in text


def test_filters_reach_the_scan(stored):
    text = plan(S.review_texts(stored, 5).select("text"))
    assert re.search(r"PushedFilters: \[.*EqualTo\(business_id,5\)", text)
    assert "ReadSchema: struct<business_id:bigint,text:string>" in text


def test_top_k_is_cut_before_the_shuffle(stored, tables):
    text = plan(B.top_reviewers(tables.users, stored))
    assert re.search(r"WindowGroupLimit.*Partial", text) and re.search(r"WindowGroupLimit.*Final", text)


def test_pairs_are_not_shuffled(plain, no_broadcast):
    profiles = C.business_profiles(plain.business, plain.reviews, AS_OF)
    text = plan(C.competitive_analysis_from_business(plain.business, profiles))
    above_explode = text.split("Generate explode(rivals")[0]
    assert "Exchange" not in above_explode and "Window" not in above_explode


def test_positions_and_shares_explode_no_pairs(plain, no_broadcast):
    targets = C.rated_targets(plain.business, C.business_profiles(plain.business, plain.reviews, AS_OF))
    assert "Generate" not in plan(C.positioning_of_targets(targets))
    shares = plan(C.shares_of_targets(targets))
    exploded = shares.split("Generate explode(")[1:]                    # the members, for their totals and once more
    assert exploded and all(re.search(r"WindowGroupLimit \[.*row_number\(\), 2, Partial", part) for part in exploded)


def test_nothing_is_paired_without_a_key(plain, no_broadcast):
    text = plan(C.competitor_mappings(plain.business))
    assert text.count("Join") >= 2
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def _cut_before_the_shuffle(text, key):
    """Whether rows are cut in each task before the exchange by ``key`` that the window needs."""
    path = above(text, "Partial")
    exchange = next(i for i, line in enumerate(path) if line.startswith("Exchange"))
    assert f"hashpartitioning({key}" in path[exchange]
    return "WindowGroupLimit" in path[0] and any("Final" in line for line in path[exchange:])


def test_words_are_cut_before_their_business_meets(spark, no_broadcast):
    assert _cut_before_the_shuffle(plan(S.word_counts(read_review_texts(spark, SMALL))), "business_id")


def test_markets_are_cut_before_they_meet(plain, no_broadcast):
    profiles = C.business_profiles(plain.business, plain.reviews, AS_OF)
    shares = C.market_shares(C.competitive_analysis_from_business(plain.business, profiles))
    assert _cut_before_the_shuffle(plan(S.market_view(profiles, shares, same_category=True)), "target_city")


def test_texts_are_read_once(spark):
    text = plan(S.word_counts(read_review_texts(spark, SMALL)), run=True)
    assert text.count("FileScan") == 1


def test_known_ids_are_found_without_shuffling_the_store(stored, make_reviews):
    incoming = make_reviews({"review_id": "x"})
    known = stored.select("review_id").join(I.one_per_review(incoming).select("review_id"), "review_id", "left_semi")
    text = plan(known, run=True)
    assert "BroadcastHashJoin" in text
    below_join = text.split("BroadcastHashJoin")[1].split("BroadcastQueryStage")[0]
    assert "FileScan" in below_join


def test_periods_share_one_shuffle_of_the_months(plain, no_broadcast):
    """Quarters and years add up in the partitions of the months, which are neither exploded nor merged."""
    text = plan(B.temporal_analysis_all(B.period_totals(plain.reviews)), run=True)
    assert "Generate" not in text
    assert text.count("REPARTITION_BY_NUM") == 3 and text.count("ReusedExchange") == 2 and text.count("FileScan") == 2


def test_a_large_batch_is_shuffled_once(stored, no_broadcast):
    """The rows by id and the stored ids: no exchange of the batch's ids beside its rows."""
    text = plan(I.new_reviews(stored.drop("text"), stored, small_batch=False))
    assert text.count("Exchange hashpartitioning(review_id") == 2 and text.count("FileScan") == 2


@pytest.mark.parametrize("name", ["in08_new_reviews", "in08_bucketed_new_reviews", "in10_all_reviews"])
def test_order_lines_are_joined_once_for_new_reviews(spark, name):
    """A query that reads the reviews in several places does not join the tables below them in each."""
    spark.catalog.clearCache()
    text = plan(catalog.QUERIES[name](spark, SMALL))
    spark.catalog.clearCache()
    assert "InMemoryTableScan" in text


@pytest.mark.parametrize("name", ["in15_incremental_profiles", "in15_incremental_insights"])
def test_order_lines_are_joined_once_for_late_reviews(spark, name):
    """The tables before and after the late reviews are made of reviews that were staged, not of the order lines again."""
    spark.catalog.clearCache()
    text = plan(catalog.QUERIES[name](spark, SMALL))
    spark.catalog.clearCache()
    assert "stars" in text and "l_orderkey" not in text


def test_reviews_of_others_are_left_out_before_the_join_with_touched_ids(spark, plain, stored, no_broadcast):
    stored_tables = {name: df.limit(0) for name, df in run_all(plain.business, plain.users, stored, AS_OF).tables.items()}
    run = run_touched(stored_tables, stored.where("business_id = 1").select("business_id"), plain.business, plain.users, stored, AS_OF)
    text = plan(run.tables["rating_distribution"])
    path = above(text, "BroadcastHashJoin [shiftright(pmod")
    assert any(line.startswith("Exchange hashpartitioning(coalesce(business_id") for line in path)
    assert "FileScan" in text.split("BroadcastHashJoin [shiftright(pmod")[1].split("BroadcastExchange")[0]
    run.release()


def test_a_bitmap_keeps_all_keys_and_few_others(spark):
    numbers = spark.range(100000).select(F.when(F.col("id") > 0, F.col("id")).alias("business_id"))
    keys = numbers.where("business_id is null or business_id % 50 = 0")
    found = may_be_among(numbers, "business_id", keys)
    assert found.columns == ["business_id"] and keys.exceptAll(found).isEmpty() and found.count() < 2300
    assert may_be_among(numbers, "business_id", keys.where("false")).isEmpty()
