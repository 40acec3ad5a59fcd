"""Named queries over the order-schema tables, one per operator.

Arrays and maps are shown as text in fixed order, so that results compare across engines.
"""

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..operators import business as B
from ..operators import competitive as C
from ..operators import ingest as I
from ..operators import serving as S
from ..schemas import RESULT_TABLES
from ..sources.order_tables import AS_OF, ReviewTables, read_review_tables, read_review_texts, read_reviews
from ..session import staging_path
from ..sources.topics import to_messages
from ..sources.versioned import VersionedTables
from ..streaming.state_ingest import StateIngest, known_ids
from .analytics import run_all, run_touched, staged_table

STORED_BEFORE = "2000-01-01"   # reviews before that day count as stored already
SENT_BATCHES = 10              # batches that count as sent already
LATE_SINCE = "2001-10-20"      # reviews from that day on come in after the result tables were made
SLICED_BATCH = 3               # the batch that in04 returns
BATCHES = 3                    # batches in which reviews come in where statistics are merged
MEASURED = ["business_id", "user_id", "stars", "useful", "funny", "cool", "reviewed_at"]   # what result tables are made of
EARLIER_DAY = "2001-05-01"     # as-of day of the tables before the last of those batches

QUERIES = {}                   # name -> (spark, folder) -> DataFrame


def query(function):
    QUERIES[function.__name__] = function
    return function


def _tables(spark: SparkSession, folder: str) -> ReviewTables:
    return read_review_tables(spark, folder)


def _shared(df: DataFrame) -> DataFrame:
    """Computed once although several parts of a query read it; it may spill, and is rebuilt when lost."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def _profiles(t: ReviewTables) -> DataFrame:
    return _shared(C.business_profiles(t.business, t.reviews, AS_OF))


def _targets(t: ReviewTables) -> DataFrame:
    return C.rated_targets(t.business, _profiles(t))


def _analysis(t: ReviewTables) -> DataFrame:
    return C.analysis_of_targets(_targets(t))


def _market_shares(t: ReviewTables) -> DataFrame:
    return C.shares_of_targets(_targets(t))


def _positioning(t: ReviewTables) -> DataFrame:
    return C.positioning_of_targets(_targets(t))


def _comparisons(t: ReviewTables) -> DataFrame:
    return C.comparisons_of_targets(_targets(t))


def _numbered(spark: SparkSession, folder: str) -> DataFrame:
    return I.number_by_date(read_reviews(spark, folder))


def _list_text(column: str):
    return F.array_join(column, " | ")


# --- result tables -----------------------------------------------------------------------------------------

@query
def a01_business_overview(spark, folder):
    t = _tables(spark, folder)
    return B.business_overview(t.business, t.reviews, AS_OF)


@query
def a02_rating_distribution(spark, folder):
    return B.rating_distribution(_tables(spark, folder).reviews)


@query
def a03_temporal_month(spark, folder):
    return B.temporal_analysis(_tables(spark, folder).reviews, "month")


@query
def a03_temporal_quarter(spark, folder):
    return B.temporal_analysis(_tables(spark, folder).reviews, "quarter")


@query
def a03_temporal_year(spark, folder):
    return B.temporal_analysis(_tables(spark, folder).reviews, "year")


@query
def a03_temporal_all(spark, folder):
    return B.temporal_analysis_all(B.period_totals(_tables(spark, folder).reviews))


@query
def a04_trend_analysis(spark, folder):
    trend = B.trend_analysis(_tables(spark, folder).reviews)
    return (trend.withColumn("early_avg", F.round("early_avg", 6))
            .withColumn("recent_avg", F.round("recent_avg", 6)))


@query
def a05_business_user_stats(spark, folder):
    t = _tables(spark, folder)
    return B.business_user_stats(t.users, t.reviews)


@query
def a06_top_reviewers(spark, folder):
    t = _tables(spark, folder)
    return B.top_reviewers(t.users, t.reviews)


@query
def a07_business_profiles(spark, folder):
    t = _tables(spark, folder)
    return C.business_profiles(t.business, t.reviews, AS_OF)


@query
def a08_competitor_mappings(spark, folder):
    return C.competitor_mappings(_tables(spark, folder).business)


@query
def a09_competitive_analysis(spark, folder):
    return _analysis(_tables(spark, folder))


@query
def a09_analysis_of_mappings(spark, folder):
    t = _tables(spark, folder)
    return C.competitive_analysis(_profiles(t), C.competitor_mappings(t.business))


@query
def a10_market_positioning(spark, folder):
    return _positioning(_tables(spark, folder))


@query
def a11_detailed_comparisons(spark, folder):
    return _comparisons(_tables(spark, folder))


@query
def a12_market_shares(spark, folder):
    return _market_shares(_tables(spark, folder))


@query
def a13_competitive_insights(spark, folder):
    return C.competitive_insights(_positioning(_tables(spark, folder)))


# --- dashboard data ----------------------------------------------------------------------------------------

@query
def d01_store_counts(spark, folder):
    t = _tables(spark, folder)
    profiles = _profiles(t)
    return S.store_counts({
        "business_table": t.business,
        "review_table": t.reviews,
        "user_table": t.users,
        "business_profiles": profiles,
        "competitor_mappings": C.competitor_mappings(t.business),
        "competitive_insights": C.competitive_insights(_positioning(t)),
    })


@query
def d02_overview_by_reviews(spark, folder):
    return S.overview_by_reviews(a01_business_overview(spark, folder))


@query
def d03_business_directory(spark, folder):
    return S.business_directory(a01_business_overview(spark, folder))


@query
def d04_business_card(spark, folder):
    return S.business_card(a01_business_overview(spark, folder))


@query
def d05_rating_map(spark, folder):
    pairs = F.transform(
        F.map_entries("distribution"),
        lambda e: F.concat(e["key"].cast("string"), F.lit("="), e["value"].cast("string")))
    return S.rating_map(a02_rating_distribution(spark, folder)).select(
        "business_id", F.array_join(pairs, " ").alias("distribution"))


@query
def d06_period_trend(spark, folder):
    return S.period_trend(a03_temporal_all(spark, folder))


@query
def d07_trend_lookup(spark, folder):
    t = _tables(spark, folder)
    return S.trend_lookup(t.business, a04_trend_analysis(spark, folder))


@query
def d08_reviewer_panel(spark, folder):
    t = _tables(spark, folder)
    activity = _shared(B.reviewer_activity(t.users, t.reviews))
    panel = S.reviewer_panel(B.user_stats_from_activity(activity), B.top_reviewers_from_activity(activity))
    line = F.transform("top_reviewers", lambda r: F.concat_ws(
        "/", r["rn"].cast("string"), r["name"], r["avg_rating"].cast("decimal(10,2)").cast("string"),
        r["review_count"].cast("string"), r["useful_votes"].cast("string"), F.coalesce(r["elite"], F.lit("-"))))
    return panel.withColumn("top_reviewers", F.array_join(line, " | "))


@query
def d09_review_texts(spark, folder):
    return S.review_texts(read_review_texts(spark, folder))


@query
def d10_word_counts(spark, folder):
    return S.word_counts(read_review_texts(spark, folder))


@query
def d11_target_card(spark, folder):
    return S.target_card(a07_business_profiles(spark, folder))


@query
def d12_competitor_list(spark, folder):
    stars = F.concat_ws("/", *[F.col("rating_distribution")[s].cast("string") for s in (1, 2, 3, 4, 5)])
    return S.competitor_list(_comparisons(_tables(spark, folder))).withColumn("rating_distribution", stars)


@query
def d13_positioning_lookup(spark, folder):
    t = _tables(spark, folder)
    lookup = S.positioning_lookup(t.business, _positioning(t))
    return lookup.select(
        *[c for c in lookup.columns if not c.endswith("_list")],
        _list_text("strengths_list").alias("strengths_list"), _list_text("weaknesses_list").alias("weaknesses_list"))


@query
def d14_side_by_side(spark, folder):
    t = _tables(spark, folder)
    return S.side_by_side(_profiles(t), _shared(_comparisons(t)))


@query
def d14_top_competitor(spark, folder):
    return S.top_competitor(_comparisons(_tables(spark, folder)))


@query
def d15_insight_lookup(spark, folder):
    return S.insight_lookup(a13_competitive_insights(spark, folder))


@query
def d16_market_view(spark, folder):
    t = _tables(spark, folder)
    return S.market_view(_profiles(t), _market_shares(t))


@query
def d16_category_view(spark, folder):
    t = _tables(spark, folder)
    return S.market_view(_profiles(t), _market_shares(t), same_category=True)


@query
def d17_short_names(spark, folder):
    """Business names of the test tables are too short to be cut, so the label is the name with its city."""
    shares = a12_market_shares(spark, folder)
    labelled = shares.withColumn("label", F.concat_ws(", ", "target_name", "target_city"))
    return S.short_names(labelled, "label").select("target_business_id", "target_category", "label", "short_name")


@query
def d18_rating_series(spark, folder):
    return S.rating_series(d14_side_by_side(spark, folder))


@query
def d19_competitor_table(spark, folder):
    return S.competitor_table(_comparisons(_tables(spark, folder)))


@query
def d20_status_tiers(spark, folder):
    return S.status_tiers(_positioning(_tables(spark, folder)))


@query
def d21_action_plan(spark, folder):
    return S.action_plan(_positioning(_tables(spark, folder))).withColumn("actions", _list_text("actions"))


@query
def d22_leader_gap(spark, folder):
    return S.leader_gap(_positioning(_tables(spark, folder)))


# --- ingest ------------------------------------------------------------------------------------------------

@query
def in01_id_date(spark, folder):
    return _numbered(spark, folder).select("review_id", "date", "id_date")


@query
def in02_batch_id(spark, folder):
    return I.with_batch_id(_numbered(spark, folder)).select("review_id", "id_date", "batch_id")


@query
def in03_batch_count(spark, folder):
    return I.batch_count(I.with_batch_id(_numbered(spark, folder)))


@query
def in04_batch_slice(spark, folder):
    return I.batch_slice(_numbered(spark, folder), SLICED_BATCH).select("review_id", "date", "id_date")


@query
def in04_batch_bounds(spark, folder):
    return I.batch_bounds(I.with_batch_id(_numbered(spark, folder)))


@query
def in05_resume(spark, folder):
    batched = I.with_batch_id(_numbered(spark, folder))
    return I.unsent_batches(batched, SENT_BATCHES - 1).select("review_id", "id_date", "batch_id")


@query
def in06_parse_json(spark, folder):
    messages = to_messages(read_reviews(spark, folder).drop("reviewed_at"))
    return I.accepted(I.parse_messages(messages)).drop("id_date", "text")


def _stored(reviews: DataFrame) -> DataFrame:
    return reviews.filter(F.col("reviewed_at") < F.lit(STORED_BEFORE).cast("timestamp_ntz"))


@query
def in08_new_reviews(spark, folder):
    reviews = _shared(read_reviews(spark, folder))
    return I.new_reviews(reviews, _stored(reviews), small_batch=False).select(
        "review_id", "business_id", "user_id", "stars", "date")


@query
def in09_dedupe(spark, folder):
    """Every order line is offered as a review of its order, so most ids come with several payloads."""
    reviews = read_reviews(spark, folder)
    offered = reviews.withColumn("review_id", F.substring_index("review_id", "-", 1))
    return I.one_per_review(offered).select("review_id", "business_id", "user_id", "date", "stars", "useful", "funny")


@query
def in10_all_reviews(spark, folder):
    reviews = _shared(read_reviews(spark, folder))
    stored = _stored(reviews)
    return I.all_reviews(stored, I.new_reviews(reviews, stored, small_batch=False)).select(
        "review_id", "business_id", "user_id", "date")


@query
def in12_active_business(spark, folder):
    t = _tables(spark, folder)
    return I.active_dimension(t.business, t.reviews, "business_id")


@query
def in12_active_users(spark, folder):
    t = _tables(spark, folder)
    return I.active_dimension(t.users, t.reviews, "user_id")


def _late(reviews: DataFrame) -> DataFrame:
    return reviews.filter(F.col("reviewed_at") >= F.lit(LATE_SINCE).cast("timestamp_ntz"))


def _after_late_reviews(spark: SparkSession, folder: str) -> dict:
    """All result tables: those of the earlier reviews, brought up to date with the late ones."""
    t = _tables(spark, folder)
    # order lines are joined once; with the reviews of a business close together its sums are whole before a shuffle
    reviews = staged_table(t.reviews.select(MEASURED).hint("rebalance", "business_id"), "reviews")
    late = _late(reviews)
    earlier = run_all(t.business, t.users, reviews.filter(
        F.col("reviewed_at") < F.lit(LATE_SINCE).cast("timestamp_ntz")), AS_OF)
    return run_touched(earlier.tables, late.select("business_id"), t.business, t.users, reviews, AS_OF).tables


@query
def in15_incremental_profiles(spark, folder):
    return _after_late_reviews(spark, folder)["business_profiles"]


@query
def in15_incremental_insights(spark, folder):
    return _after_late_reviews(spark, folder)["competitive_insights"]


@query
def in15_incremental_comparisons(spark, folder):
    return _after_late_reviews(spark, folder)["detailed_comparisons"]


def _versioned(spark: SparkSession) -> VersionedTables:
    return VersionedTables(spark, staging_path(spark, "versioned"))


@query
def in08_bucketed_new_reviews(spark, folder):
    """The stored reviews lie in buckets by id, of which those of the incoming ids are opened."""
    reviews, store = _shared(read_reviews(spark, folder)), _versioned(spark)
    with store.change() as change:
        change.replace("reviews", _stored(reviews), key="review_id", buckets=16)
    return I.new_reviews(reviews, known_ids(store.current(), reviews), small_batch=False).select(
        "review_id", "business_id", "user_id", "stars", "date")


@query
def in13_membership_time(spark, folder):
    """A user's first review stands for the start of the membership; some texts cannot be read."""
    t = _tables(spark, folder)
    first = t.reviews.groupBy("user_id").agg(F.min("date").alias("first"))
    since = F.when(F.col("user_id") % 7 == 0, "unknown").otherwise(F.col("first")).alias("yelping_since")
    users = I.with_membership_time(t.users.join(first, "user_id").select("user_id", "name", since))
    return users.withColumn("yelping_since", F.date_format("yelping_since", V.DATE_TEXT_FORMAT))


def _from_merged_state(spark: SparkSession, folder: str) -> VersionedTables:
    """All reviews in three batches: the tables after two of them as of an earlier day, brought up to date with the third."""
    t, store, sent = _tables(spark, folder), _versioned(spark), _versioned(spark)
    with sent.change() as change:                # order lines are joined once; a batch is a bucket by review id
        change.replace("reviews", t.reviews, key="review_id", buckets=BATCHES, lies_dealt=True)
    ingest = StateIngest(store, t.business, t.users, EARLIER_DAY, buckets=8, refresh_every=0, small_batches=False)
    for number in range(BATCHES):
        if number == BATCHES - 1:
            ingest.refresh()
            ingest.asof = AS_OF
        ingest.add(sent.current().read("reviews", [number]), number)
    ingest.refresh()
    return store


@query
def in15_state_profiles(spark, folder):
    return _from_merged_state(spark, folder).read("business_profiles")


@query
def in15_state_insights(spark, folder):
    return _from_merged_state(spark, folder).read("competitive_insights")


@query
def in15_state_reviewers(spark, folder):
    return _from_merged_state(spark, folder).read("top_reviewers")


@query
def in14_active_business(spark, folder):
    t = _tables(spark, folder)
    return I.active_business(t.business, t.reviews)


@query
def in14_active_reviews(spark, folder):
    reviews = _tables(spark, folder).reviews
    return I.reviews_of_active(reviews).select("review_id", "business_id", "stars")
