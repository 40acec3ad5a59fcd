"""What the dashboards show, for all businesses at once.

Each function returns one row (or one ranked list) per business; filter on the business id for a single one, the
filter reaches the stored table's scan.
"""

from functools import reduce

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.rules import first_match, label_list, tier, trend_label
from ..functions.words import stop_words, words

STAR_COLUMNS = [f"rating_{s}" for s in (1, 2, 3, 4, 5)]


# --- the business itself -------------------------------------------------------------------------------

def store_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of each given table."""
    counts = [df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
              for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def overview_by_reviews(overview: DataFrame) -> DataFrame:
    """The overview, most reviewed businesses first."""
    return overview.orderBy(F.desc("total_reviews"), "business_id")


def business_directory(table: DataFrame) -> DataFrame:
    """Names for a selection list, ``name (city, state)``; null when a part is missing."""
    return table.select(
        "business_id", "name", "city", "state", "categories",
        F.concat("name", F.lit(" ("), "city", F.lit(", "), "state", F.lit(")")).alias("display_name"))


def business_card(overview: DataFrame) -> DataFrame:
    """Headline figures with joined address, open flag and the change of the recent mean (null if none)."""
    average, recent = F.col("average_rating"), F.col("recent_average")
    is_open = F.col("is_open").cast("boolean")
    return overview.select(
        "business_id", "name",
        F.concat("address", F.lit(", "), "city", F.lit(", "), "state").alias("full_address"),
        "categories", "total_reviews", "average_rating", "recent_average",
        is_open.alias("is_open"),
        F.when(is_open, V.STATUS_OPEN).otherwise(V.STATUS_CLOSED).alias("status"),
        F.when(recent != average, F.round(recent - average, 2)).alias("recent_change"),
        "last_review_date",
    )


def rating_map(distribution: DataFrame) -> DataFrame:
    """Distribution per business as a map rating -> count; half stars add up under their whole rating."""
    per_rating = distribution.groupBy("business_id", "rating").agg(F.sum("count").alias("count"))
    entries = F.sort_array(F.collect_list(F.struct("rating", "count")))
    return (
        per_rating.filter(F.col("rating").isNotNull())
        .groupBy("business_id").agg(F.map_from_entries(entries).alias("distribution"))
    )


def period_trend(temporal: DataFrame) -> DataFrame:
    """Trend label per business and period type: mean of the last three period means against the first three.

    Works on the rounded means as stored, in whole hundredths, so a change of exactly the step stays flat.
    """
    per_series = W.partitionBy("business_id", "period_type")
    cents = F.round(F.col("avg_rating") * 100).cast("long")
    ranked = temporal.select(
        "business_id", "period_type", cents.alias("cents"),
        F.row_number().over(per_series.orderBy(F.asc_nulls_last("period"))).alias("rn"),
        F.count("*").over(per_series).alias("periods"),
    )
    first = F.when(F.col("rn") <= V.MIN_QUARTERS, F.col("cents"))
    last = F.when(F.col("rn") > F.col("periods") - V.MIN_QUARTERS, F.col("cents"))
    ends = ranked.groupBy("business_id", "period_type", "periods").agg(
        F.sum(first).alias("first_sum"), F.count(first).alias("first_n"),
        F.sum(last).alias("last_sum"), F.count(last).alias("last_n"))
    # last_sum/last_n - first_sum/first_n, over the common denominator
    change = F.col("last_sum") * F.col("first_n") - F.col("first_sum") * F.col("last_n")
    step = F.lit(round(V.TREND_STEP * 100)) * F.col("first_n") * F.col("last_n")
    enough = F.col("periods") >= V.MIN_QUARTERS
    return ends.select(
        "business_id", "period_type", "periods",
        first_match(
            [(enough & (change > step), V.TREND_UP), (enough & (change < -step), V.TREND_DOWN)],
            V.TREND_FLAT).alias("trend"),
    )


def trend_lookup(business_ids: DataFrame, trend: DataFrame) -> DataFrame:
    """Trend of every given business; flat where there are too few quarters."""
    return business_ids.select("business_id").distinct().join(trend, "business_id", "left").select(
        "business_id", F.coalesce("trend", F.lit(V.TREND_FLAT)).alias("trend"),
        "early_avg", "recent_avg", "total_quarters")


def reviewer_panel(stats: DataFrame, top: DataFrame) -> DataFrame:
    """Reviewer statistics with the (at most k) top reviewers as an array in rank order."""
    reviewer = F.struct("rn", "name", "avg_rating", "review_count", "useful_votes", "elite")
    ranked = top.groupBy("business_id").agg(F.sort_array(F.collect_list(reviewer)).alias("top_reviewers"))
    return stats.join(ranked, "business_id", "left").select(
        "business_id", "unique_users", "avg_reviews_per_user", "elite_users_count", "top_reviewers")


def review_texts(reviews: DataFrame, business_id=None) -> DataFrame:
    """Non-empty review texts, of one business or of all."""
    texts = reviews.filter(F.col("text") != "")
    return texts if business_id is None else texts.filter(F.col("business_id") == business_id)


def word_counts(reviews: DataFrame, k: int = V.TOP_WORDS, base_stop_words=None) -> DataFrame:
    """The k most used words per business, without stop words; ties go alphabetically.

    Words are counted on the map side, and the length of a business's cleaned text is added up from those counts, so
    no text is ever joined together. Businesses with hardly any text have no list. The words are ranked before the
    lengths are joined in: each task keeps k words per business before the shuffle, so a business's vocabulary is
    never gathered. Both uses of the counts are kept the same, so that Spark reuses their shuffle and the texts are
    read once: stop words are ranked last rather than filtered out early, and the length comes back by an inner join,
    as a semi join would move below the counting.
    """
    counts = (
        review_texts(reviews)
        .select("business_id", F.explode(words(F.col("text"))).alias("word"))
        .filter(F.col("word") != "")
        .groupBy("business_id", "word").agg(F.count("*").alias("uses"))
    )
    # all words joined by single spaces
    text_length = F.sum((F.length("word") + 1) * F.col("uses")) - 1
    lengths = counts.groupBy("business_id").agg(text_length.alias("chars"))
    listed = (F.length("word") >= V.MIN_WORD_LETTERS) & ~F.col("word").isin(stop_words(base_stop_words))
    by_use = W.partitionBy("business_id").orderBy(F.desc("listed"), F.desc("uses"), "word")
    ranked = (
        counts.withColumn("listed", listed)
        .withColumn("rank", F.row_number().over(by_use)).filter((F.col("rank") <= k) & F.col("listed"))
    )
    return (
        ranked.join(lengths.filter(F.col("chars") >= V.MIN_CLOUD_CHARS), "business_id")
        .select("business_id", "word", "uses", "rank")
    )


# --- the business among its competitors --------------------------------------------------------------------

def target_card(profiles: DataFrame) -> DataFrame:
    """Headline figures of the business that is compared."""
    return profiles.select(
        "business_id", "name", "city", "state", "categories", "total_reviews", "average_rating", "recent_average",
        "rating_stddev", "last_review_date")


def competitor_list(comparisons: DataFrame, n: int = V.DEFAULT_COMPETITOR_LIST) -> DataFrame:
    """The first n stored competitors per business, with the rating counts as a map."""
    stars = [pair for s in (1, 2, 3, 4, 5) for pair in (F.lit(s), F.col(f"competitor_rating_{s}"))]
    return comparisons.filter(F.col("competitor_rank") <= n).select(
        "target_business_id", "competitor_rank", "competitor_business_id", "competitor_name", "competitor_city",
        "competitor_state", "competitor_average_rating", "competitor_recent_average", "competitor_total_reviews",
        "is_same_city", F.create_map(*stars).alias("rating_distribution"))


def positioning_lookup(business_ids: DataFrame, positioning: DataFrame) -> DataFrame:
    """Position of every given business with label arrays, and defaults for those without competitors."""
    measures = ["rating_percentile", "popularity_percentile"]
    details = [
        "total_competitors", "same_city_competitors", "best_competitor_rating", "avg_competitor_rating",
        "avg_competitor_reviews"]
    known = positioning.withColumnRenamed("target_business_id", "business_id")
    return business_ids.select("business_id").distinct().join(known, "business_id", "left").select(
        "business_id",
        F.coalesce("market_position", F.lit(V.POSITION_UNKNOWN)).alias("market_position"),
        *[F.coalesce(m, F.lit(0.0)).alias(m) for m in measures], *details,
        label_list(F.col("strengths")).alias("strengths_list"),
        label_list(F.col("weaknesses")).alias("weaknesses_list"),
    )


def side_by_side(profiles: DataFrame, comparisons: DataFrame, k: int = V.SIDE_BY_SIDE) -> DataFrame:
    """Each compared business and its k best rated competitors; place 0 is the business itself.

    The stored rank already orders by rating, so the k best are the first k ranks.
    """
    competitors = comparisons.filter(F.col("competitor_rank") <= k).select(
        "target_business_id",
        F.col("competitor_rank").alias("place"),
        F.col("competitor_business_id").alias("business_id"),
        F.col("competitor_name").alias("name"),
        F.col("competitor_average_rating").alias("avg_rating"),
        F.col("competitor_total_reviews").alias("review_count"),
        *[F.col(f"competitor_{c}").alias(c) for c in STAR_COLUMNS],
        F.lit(False).alias("is_target"),
    )
    compared = comparisons.filter(F.col("competitor_rank") == 1).select(
        F.col("target_business_id").alias("business_id"))
    itself = profiles.join(compared, "business_id", "left_semi").select(
        F.col("business_id").alias("target_business_id"),
        F.lit(0).alias("place"),
        "business_id",
        F.concat("name", F.lit(V.TARGET_SUFFIX)).alias("name"),
        F.col("average_rating").alias("avg_rating"),
        F.col("total_reviews").alias("review_count"),
        *STAR_COLUMNS,
        F.lit(True).alias("is_target"),
    )
    return itself.unionByName(competitors)


def top_competitor(comparisons: DataFrame) -> DataFrame:
    """The best rated competitor per business."""
    return comparisons.filter(F.col("competitor_rank") == 1)


def insight_lookup(insights: DataFrame) -> DataFrame:
    """The three generated sentences per business."""
    return insights.select(
        F.col("target_business_id").alias("business_id"),
        "primary_insight", "recommended_action", "competitive_advantage")


def market_view(profiles: DataFrame, shares: DataFrame, rows: int = V.MARKET_VIEW_ROWS,
                same_category: bool = False) -> DataFrame:
    """Leading rows of the market shares in each business's city and state.

    The market of the view is the city, whatever the category, unless ``same_category`` is set. Rows come by category,
    largest share first, and the total is that of the first row. Each market is cut to ``rows`` before it is joined.
    Shares that were just joined with their market's total lie together by market; for the view by category they are
    dealt out by business first, so that each task cuts its part of a market before the market meets.
    """
    if same_category:
        shares = shares.repartition("target_business_id")
    market = ["target_city", "target_state"] + (["target_category"] if same_category else [])
    order = W.partitionBy(*market).orderBy(
        "target_category", F.desc("market_share_pct"), F.asc("target_business_id"))
    leading = (
        shares.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= rows)
        .withColumn("view_total_reviews",
                    F.max(F.when(F.col("place") == 1, F.col("total_market_reviews"))).over(W.partitionBy(*market)))
    )
    viewers = profiles.select(
        F.col("business_id"), F.col("city").alias("target_city"), F.col("state").alias("target_state"),
        F.trim(F.split("categories", ",")[0]).alias("target_category"))
    if not same_category:
        viewers = viewers.drop("target_category")
    return viewers.join(leading, market).select(
        "business_id", "place", "target_business_id", "target_name", "target_city", "target_state", "target_category",
        "target_total_reviews", "total_market_reviews", "market_share_pct", "view_total_reviews")


def short_names(table: DataFrame, column: str = "target_name") -> DataFrame:
    """Adds ``short_name``: names beyond 20 characters are cut and marked."""
    name = F.col(column)
    cut = F.concat(F.substring(name, 1, V.SHORT_NAME_LENGTH), F.lit(V.SHORT_NAME_SUFFIX))
    return table.withColumn("short_name", F.when(F.length(name) > V.SHORT_NAME_LENGTH, cut).otherwise(name))


def rating_series(comparison: DataFrame) -> DataFrame:
    """``side_by_side`` as one row per star value."""
    long = comparison.unpivot(
        ["target_business_id", "place", "business_id", "name"], STAR_COLUMNS, "star_column", "reviews")
    return long.select(
        "target_business_id", "place", "business_id", "name",
        F.substring("star_column", -1, 1).cast("int").alias("star"), "reviews")


def competitor_table(comparisons: DataFrame, n: int = V.DEFAULT_COMPETITOR_LIST) -> DataFrame:
    """The competitor list as displayed: translated headings and a symbol for the same city."""
    symbol = F.when(F.col("is_same_city"), V.FLAG_YES).otherwise(V.FLAG_NO)
    shown = comparisons.filter(F.col("competitor_rank") <= n).withColumn("is_same_city", symbol)
    return shown.select(
        "target_business_id", "competitor_rank",
        *[F.col(c).alias(heading) for c, heading in V.COMPETITOR_TABLE_HEADINGS.items()])


def status_tiers(positioning: DataFrame) -> DataFrame:
    """Rating and popularity tier with the percentages as displayed (ties round to even)."""
    rating, popularity = F.col("rating_percentile"), F.col("popularity_percentile")
    low = popularity < V.MIDDLE_PERCENTILE
    return positioning.select(
        F.col("target_business_id").alias("business_id"),
        tier(rating, V.RATING_TIERS, V.RATING_TIER_OTHERWISE).alias("rating_tier"),
        F.bround(rating, 0).cast("int").alias("rating_shown"),
        tier(popularity, V.POPULARITY_TIERS, V.POPULARITY_TIER_OTHERWISE).alias("popularity_tier"),
        F.bround(F.when(low, 100 - popularity).otherwise(popularity), 0).cast("int").alias("popularity_shown"),
    )


def _behind_leader():
    return F.col("best_competitor_rating") > F.col("target_average_rating") + V.RATING_EDGE


def action_plan(positioning: DataFrame) -> DataFrame:
    """Recommended actions per business, in order of urgency."""
    low_rating = F.col("rating_percentile") < V.MIDDLE_PERCENTILE
    low_popularity = F.col("popularity_percentile") < V.MIDDLE_PERCENTILE
    rules = [
        (low_rating, V.PLAN_QUALITY),
        (low_rating, V.PLAN_NEGATIVE),
        (low_popularity, V.PLAN_VISIBILITY),
        (low_popularity, V.PLAN_LOCAL_MARKETING),
        (F.col("same_city_competitors") < V.OPEN_LOCAL_MARKET, V.PLAN_GEOGRAPHY),
        (_behind_leader(), V.PLAN_LEADER),
    ]
    actions = F.array_compact(F.array(*[F.when(condition, F.lit(text)) for condition, text in rules]))
    return positioning.select(
        F.col("target_business_id").alias("business_id"),
        F.when(F.size(actions) == 0, F.array(F.lit(V.PLAN_OTHERWISE))).otherwise(actions).alias("actions"))


def leader_gap(positioning: DataFrame) -> DataFrame:
    """Distance to the best rated competitor and whether the business is behind or ahead."""
    gap = F.round(F.col("best_competitor_rating") - F.col("target_average_rating"), 2)
    return positioning.filter(F.col("best_competitor_rating") > 0).select(
        F.col("target_business_id").alias("business_id"),
        F.abs(gap).alias("gap"),
        F.when(gap > 0, V.GAP_BEHIND).otherwise(V.GAP_AHEAD).alias("gap_label"))
