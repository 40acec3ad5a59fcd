"""Per-business tables: overview, rating distribution, time series, trend, reviewers.

Every grouping here is combined on the map side first, so a business, user or month that holds a large part
of all reviews reaches the shuffle as one partial row per task.
"""

from functools import reduce

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.calendar import first_and_last_date, is_recent, period_key, review_time
from ..functions.rules import trend_label
from ..schemas import RESULT_TABLES

PERIOD_MEASURES = ["star_sum", "star_count", "review_count", "useful_total", "funny_total", "cool_total"]


def business_overview(business: DataFrame, reviews: DataFrame, asof=None) -> DataFrame:
    """One row per reviewed business: review count, mean rating, mean of the recent window, last review.

    Without a recent rating the (rounded) overall mean stands in.
    """
    recent = is_recent(review_time(reviews), asof)
    stats = reviews.groupBy("business_id").agg(
        F.count("*").alias("total_reviews"),
        F.round(F.avg("stars"), 2).alias("average_rating"),
        F.avg(F.when(recent, F.col("stars"))).alias("recent_average"),
        first_and_last_date(reviews)[1].alias("last_review_date"),
    )
    return (
        business.join(stats, "business_id")
        .withColumn("recent_average", F.round(F.coalesce("recent_average", "average_rating"), 2))
        .select(RESULT_TABLES["business_overview"])
    )


def rating_distribution(reviews: DataFrame) -> DataFrame:
    """Reviews per business and star value; half stars keep a row of their own under their whole rating."""
    return (
        reviews.groupBy("business_id", "stars").agg(F.count("*").alias("count"))
        .select("business_id", F.col("stars").cast("int").alias("rating"), "count")
    )


def _calendar_unit(period_type: str) -> str:
    return period_type if period_type in V.PERIOD_TYPES else "month"


def period_totals(reviews: DataFrame, period_type: str = "month") -> DataFrame:
    """Sums per business and calendar period, keyed by the first day of the period.

    The sums can be added up again, so coarser periods follow from finer ones without another scan.
    """
    start = F.trunc(review_time(reviews).cast("date"), _calendar_unit(period_type))
    return reviews.groupBy("business_id", start.alias("period_start")).agg(
        F.sum("stars").alias("star_sum"),
        F.count("stars").alias("star_count"),
        F.count("*").alias("review_count"),
        F.sum("useful").alias("useful_total"),
        F.sum("funny").alias("funny_total"),
        F.sum("cool").alias("cool_total"),
    )


def coarser_totals(totals: DataFrame, period_type: str, by=("business_id",)) -> DataFrame:
    """``period_totals`` of a coarser period from finer ones. ``by`` names the business's id and a column that tells where its
    rows lie, if they were dealt."""
    start = F.trunc("period_start", _calendar_unit(period_type))
    return totals.groupBy(*by, start.alias("period_start")).agg(
        *[F.sum(measure).alias(measure) for measure in PERIOD_MEASURES])


def _mean_rating():
    return F.col("star_sum") / F.nullif(F.col("star_count"), F.lit(0))


def temporal_table(totals: DataFrame, period_type: str) -> DataFrame:
    """``period_totals`` in the layout of the result table."""
    return totals.select(
        "business_id",
        period_key(F.col("period_start"), period_type).alias("period"),
        F.round(_mean_rating(), 2).alias("avg_rating"),
        "review_count", "useful_total", "funny_total", "cool_total",
        F.lit(period_type).alias("period_type"),
    )


def temporal_analysis(reviews: DataFrame, period_type: str = "month") -> DataFrame:
    """Ratings and votes per business and month, quarter or year.

    Reviews without a readable date form one null period. Any other period type is counted by month under
    its own name.
    """
    return temporal_table(period_totals(reviews, period_type), period_type)


def temporal_analysis_all(months: DataFrame) -> DataFrame:
    """Month, quarter and year rows from monthly ``period_totals``: the reviews are read once.

    The months are dealt by business once, which the three period types share, so quarters and years add up where they
    lie and nothing is shuffled three times. The number of partitions is given, so that adaptive execution does not
    merge them: months compress so well that merged ones would take gigabytes in a task. A business has one row a month
    at most, so none is a hot key.
    """
    partitions = int(months.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return temporal_analysis_of_dealt(months.repartition(partitions, "business_id"))


def temporal_analysis_of_dealt(months: DataFrame, by=("business_id",)) -> DataFrame:
    """``temporal_analysis_all`` of months that lie together by business."""
    return reduce(DataFrame.unionByName, [
        temporal_table(months if kind == "month" else coarser_totals(months, kind, by), kind) for kind in V.PERIOD_TYPES])


def trend_from_quarters(quarters: DataFrame, by=("business_id",)) -> DataFrame:
    """Trend per business from quarterly ``period_totals``.

    Compares the plain mean of the first three quarterly means with that of the last three (they overlap
    below six quarters). Undated reviews count as one quarter that comes first. The change is compared at nine
    decimals, so float noise cannot tip a change of exactly the step.
    """
    by_business = W.partitionBy(*by)
    quarter = period_key(F.col("period_start"), "quarter")
    ranked = quarters.select(
        *by,
        _mean_rating().alias("avg_rating"),
        F.row_number().over(by_business.orderBy(quarter.asc_nulls_first())).alias("rn"),
        F.count("*").over(by_business).alias("quarters"),
    )
    early = F.avg(F.when(F.col("rn") <= V.MIN_QUARTERS, F.col("avg_rating")))
    late = F.avg(F.when(F.col("rn") > F.col("quarters") - V.MIN_QUARTERS, F.col("avg_rating")))
    return (
        ranked.filter(F.col("quarters") >= V.MIN_QUARTERS)
        .groupBy(*by, "quarters")
        .agg(early.alias("early_avg"), late.alias("recent_avg"))
        .select(
            "business_id", "early_avg", "recent_avg",
            trend_label(F.round(F.col("recent_avg") - F.col("early_avg"), 9)).alias("trend"),
            F.col("quarters").cast("int").alias("total_quarters"),
        )
    )


def trend_analysis(reviews: DataFrame) -> DataFrame:
    """Long-term trend per business with at least three quarters of reviews."""
    return trend_from_quarters(period_totals(reviews, "quarter"))


def reviewer_activity(users: DataFrame, reviews: DataFrame) -> DataFrame:
    """One row per (business, known reviewer); reviewers without a user row drop out."""
    return activity_of_pairs(users, reviews.groupBy("business_id", "user_id").agg(
        F.round(F.avg("stars"), 2).alias("avg_rating"),
        F.count("*").alias("review_count"),
        F.sum("useful").alias("useful_votes"),
    ))


def activity_of_pairs(users: DataFrame, pairs: DataFrame) -> DataFrame:
    """``reviewer_activity`` from its measures by (business, user).

    The join runs on the pre-aggregated pairs. A user with a very large share of them is split by the
    adaptive skew join, since the user side is one row per key.
    """
    return pairs.join(one_row_each(users), "user_id")


def one_row_each(users: DataFrame) -> DataFrame:
    """Name and elite years of each user id, the smallest of several."""
    return users.groupBy("user_id").agg(F.min(F.struct("name", "elite")).alias("user")).select("user_id", "user.name", "user.elite")


def user_stats_from_activity(activity: DataFrame, blank_is_null: bool = False, by=("business_id",)) -> DataFrame:
    """``business_user_stats`` from ``reviewer_activity``.

    An empty ``elite`` text counts as elite, as only null means "never"; ``blank_is_null`` changes that.
    """
    elite = F.nullif(F.trim("elite"), F.lit("")) if blank_is_null else F.col("elite")
    return activity.groupBy(*by).agg(
        F.count("*").alias("unique_users"),
        F.round(F.avg("review_count"), 1).alias("avg_reviews_per_user"),
        F.count_if(elite.isNotNull()).alias("elite_users_count"),
        F.max("useful_votes").alias("max_useful_votes"),
    )


def top_reviewers_from_activity(activity: DataFrame, k: int = V.TOP_REVIEWERS, by=("business_id",)) -> DataFrame:
    """``top_reviewers`` from ``reviewer_activity``; each task keeps k rows per business before the shuffle."""
    by_votes = W.partitionBy(*by).orderBy(F.desc_nulls_last("useful_votes"), "user_id")
    return (
        activity.withColumn("rn", F.row_number().over(by_votes)).filter(F.col("rn") <= k)
        .select(RESULT_TABLES["top_reviewers"])
    )


def business_user_stats(users: DataFrame, reviews: DataFrame, blank_is_null: bool = False) -> DataFrame:
    """Reviewer statistics per business."""
    return user_stats_from_activity(reviewer_activity(users, reviews), blank_is_null)


def top_reviewers(users: DataFrame, reviews: DataFrame, k: int = V.TOP_REVIEWERS) -> DataFrame:
    """The k reviewers of a business with the most useful votes; ties go by user id."""
    return top_reviewers_from_activity(reviewer_activity(users, reviews), k)
