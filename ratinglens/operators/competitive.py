"""Competitor tables: profiles, mappings, percentile positioning, comparisons, market shares, insights."""

from collections.abc import Callable

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.calendar import first_and_last_date, is_recent, review_time
from ..functions.rules import first_match, label_text, percent, sample_stddev, tier
from ..schemas import RESULT_TABLES

STARS = [1, 2, 3, 4, 5]
MARKET = ["main_category", "state"]
PROFILE_MEASURES = ["total_reviews", "average_rating", "recent_average", *[f"rating_{s}" for s in STARS]]


def business_profiles(business: DataFrame, reviews: DataFrame, asof=None) -> DataFrame:
    """Complete profile of every reviewed business, from one scan of the reviews."""
    recent = is_recent(review_time(reviews), asof)
    stars = F.col("stars")
    first_date, last_date = first_and_last_date(reviews)
    stats = reviews.groupBy("business_id").agg(
        F.count("*").alias("total_reviews"),
        F.round(F.avg("stars"), 2).alias("average_rating"),
        F.avg(F.when(recent, stars)).alias("recent_average"),
        F.round(F.coalesce(sample_stddev(stars), F.lit(0.0)), 2).alias("rating_stddev"),
        F.sum("useful").alias("total_useful"),
        F.sum("funny").alias("total_funny"),
        F.sum("cool").alias("total_cool"),
        F.count_if(recent).alias("recent_reviews"),
        # older reviews fold into one null user per business and task before the shuffle
        F.countDistinct(F.when(recent, F.col("user_id"))).alias("recent_unique_users"),
        *[F.count_if(stars == s).alias(f"rating_{s}") for s in STARS],
        last_date.alias("last_review_date"),
        first_date.alias("first_review_date"),
    )
    return (
        business.join(stats, "business_id")
        .withColumn("recent_average", F.round(F.coalesce("recent_average", "average_rating"), 2))
        .select(RESULT_TABLES["business_profiles"])
    )


def market_members(business: DataFrame) -> DataFrame:
    """Businesses that compete somewhere: they have a main category (the first listed) and a state."""
    main_category = F.trim(F.split("categories", ",")[0])
    return (
        business.withColumn("main_category", main_category)
        .filter((F.col("main_category") != "") & F.col("state").isNotNull())
        .select("business_id", "name", "city", "state", "main_category")
    )


def _same(df: DataFrame) -> DataFrame:
    return df


def rivals_by_target(members: DataFrame, payload: list[str], depth: int,
                     share: Callable[[DataFrame], DataFrame] = _same) -> DataFrame:
    """Each member with its closest rivals, as an array of at most ``depth`` structs in rank order.

    Rivals share main category and state; the same city comes first, then the name (nulls first), then the id.
    Pairing everybody within a market would grow with the square of its size. Only the first depth+1
    members of a city (c of them) and the first depth+1-c outsiders of its state can rank for anybody in that
    city, so they make one short list per city, and every member is joined to that list alone:

    * a member finds itself in the list at most once, so depth others remain whenever so many exist;
    * the first depth+1 members of a state hold at most c from that city, hence enough outsiders;
    * members without a city are nobody's neighbours: their list is the start of the state's list.

    The windows keep depth+1 rows per key and task before they shuffle. A market with a large part of all
    businesses is split by the adaptive skew join, as the list side is one row per key.

    ``share`` may persist the members and the lists for a result that is used several times. The result itself holds
    an array for each member, ``depth`` times as much, and is cheaper to join again than to keep.
    """
    members = share(members)
    return with_rivals(members, share(rival_lists(members, payload, depth)), depth)


def rival_lists(members: DataFrame, payload: list[str], depth: int) -> DataFrame:
    """The short list ``nearby`` of each (category, state, city), from which ``with_rivals`` takes a member's rivals."""
    keep = depth + 1
    rank = [F.asc_nulls_first("name"), F.asc("business_id")]
    rival = F.struct("name", "business_id", "city", *payload)   # this field order sorts like ``rank``

    city_front = (
        members.withColumn("place", F.row_number().over(W.partitionBy(*MARKET, "city").orderBy(*rank)))
        .filter(F.col("place") <= keep)
    )
    state_lists = (
        city_front.withColumn("place", F.row_number().over(W.partitionBy(*MARKET).orderBy(*rank)))
        .filter(F.col("place") <= keep)
        .groupBy(*MARKET).agg(F.sort_array(F.collect_list(rival)).alias("statewide"))
    )
    city_lists = city_front.groupBy(*MARKET, "city").agg(F.sort_array(F.collect_list(rival)).alias("locals"))

    def tagged(rivals, same_city: bool):
        return F.transform(rivals, lambda r: r.withField("is_same_city", F.lit(same_city)))

    neighbours = F.when(F.col("city").isNotNull(), F.col("locals")).otherwise(F.slice("locals", 1, 0))
    outsiders = F.filter("statewide", lambda r: ~F.coalesce(r["city"] == F.col("city"), F.lit(False)))
    return (
        city_lists.join(state_lists, MARKET)
        .withColumn("neighbours", neighbours)
        .select(
            *[F.col(key).alias(f"list_{key}") for key in [*MARKET, "city"]],
            F.concat(
                tagged(F.col("neighbours"), True),
                tagged(F.slice(outsiders, F.lit(1), F.lit(keep) - F.size("neighbours")), False),
            ).alias("nearby"),
        )
    )


def with_rivals(members: DataFrame, lists: DataFrame, depth: int) -> DataFrame:
    """Each member with the first ``depth`` others of its list."""
    same_market = (
        (F.col("main_category") == F.col("list_main_category"))
        & (F.col("state") == F.col("list_state"))
        & F.col("city").eqNullSafe(F.col("list_city"))
    )
    others = F.filter("nearby", lambda r: r["business_id"] != F.col("business_id"))
    return (
        members.join(lists, same_market)
        .select(*members.columns, F.slice(others, 1, depth).alias("rivals"))
    )


def _target_columns():
    return [
        F.col("business_id").alias("target_business_id"),
        F.col("name").alias("target_name"),
        F.col("city").alias("target_city"),
        F.col("state").alias("target_state"),
        F.col("main_category").alias("target_category"),
    ]


def _rival_columns():
    return [
        F.col("rival.business_id").alias("competitor_business_id"),
        F.col("rival.name").alias("competitor_name"),
        F.col("rival.city").alias("competitor_city"),
        F.col("target_state").alias("competitor_state"),
        F.col("rival.is_same_city").alias("is_same_city"),
    ]


def competitor_mappings(business: DataFrame, max_competitors: int = V.MAX_COMPETITORS) -> DataFrame:
    """Up to ``max_competitors`` rivals per business: same main category and state, same city first."""
    return mappings_of_ranked(rivals_by_target(market_members(business), [], max_competitors))


def mappings_of_ranked(ranked: DataFrame) -> DataFrame:
    """``competitor_mappings`` from members with their rivals."""
    return (
        ranked.select(*_target_columns(), F.explode("rivals").alias("rival"))
        .select(*[f"target_{c}" for c in ("business_id", "name", "city", "state", "category")], *_rival_columns())
    )


def _percentiles(frame: DataFrame) -> DataFrame:
    """Percentiles and position from the "better than" counts."""
    return (
        frame
        .withColumn("rating_percentile", percent(F.col("better_rating_count"), F.col("total_competitors_rating"), 1))
        .withColumn("popularity_percentile",
                    percent(F.col("better_popularity_count"), F.col("total_competitors_popularity"), 1))
        .withColumn("avg_percentile",
                    F.round((F.col("rating_percentile") + F.col("popularity_percentile")) / 2, 1))
        .withColumn("market_position", tier(F.col("avg_percentile"), V.POSITION_TIERS, V.POSITION_OTHERWISE))
    )


def competitive_analysis(profiles: DataFrame, mappings: DataFrame) -> DataFrame:
    """Every (business, competitor) pair of a mapping table with both profiles and the business's percentiles.

    The competitor join comes first and the target join second, so the windows reuse the partitioning by target.
    ``competitive_analysis_from_business`` gives the same table without shuffling the pairs.
    """
    def measures(side):
        return profiles.select(
            F.col("business_id").alias(f"{side}_business_id"),
            *[F.col(m).alias(f"{side}_{m}") for m in PROFILE_MEASURES])

    target = measures("target").drop(*[f"target_rating_{s}" for s in STARS])
    pairs = mappings.join(measures("competitor"), "competitor_business_id").join(target, "target_business_id")
    per_target = W.partitionBy("target_business_id")

    def beaten(measure):
        return F.count_if(F.col(f"target_{measure}") > F.col(f"competitor_{measure}")).over(per_target)

    compared = pairs.select(
        "*",
        beaten("average_rating").alias("better_rating_count"),
        F.count("*").over(per_target).alias("total_competitors_rating"),
        beaten("total_reviews").alias("better_popularity_count"),
    ).withColumn("total_competitors_popularity", F.col("total_competitors_rating"))
    return _percentiles(compared).select(RESULT_TABLES["competitive_analysis"])


def rated_targets(business: DataFrame, profiles: DataFrame, max_competitors: int = V.MAX_COMPETITORS,
                  share: Callable[[DataFrame], DataFrame] = _same) -> DataFrame:
    """One row per business with a profiled rival: its measures, percentiles, and the rivals as an array.

    The profile measures travel inside the rival lists, so everything that concerns a business and its rivals is an
    expression on one row: no shuffle carries pairs, and a rival listed by very many businesses is no join key. The
    limit applies before rivals without a profile are left out, as with a stored mapping table. ``share`` as in
    ``rivals_by_target``.
    """
    return targets_of_ranked(rivals_by_target(rated_members(business, profiles), PROFILE_MEASURES, max_competitors, share))


def rated_members(business: DataFrame, profiles: DataFrame) -> DataFrame:
    """Businesses that compete somewhere, with the measures of their profile if they have one."""
    return market_members(business).join(profiles.select("business_id", *PROFILE_MEASURES), "business_id", "left")


def targets_of_ranked(ranked: DataFrame) -> DataFrame:
    """``rated_targets`` from rated members with their rivals."""
    targets = (
        ranked.filter(F.col("total_reviews").isNotNull())
        .withColumn("rivals", F.filter("rivals", lambda r: r["total_reviews"].isNotNull()))
        .filter(F.size("rivals") > 0)
    )

    def beaten(measure):
        return F.size(F.filter("rivals", lambda r: r[measure] < F.col(measure))).cast("long")

    competitors = F.size("rivals").cast("long")
    return _percentiles(targets.select(
        *_target_columns(),
        *[F.col(m).alias(f"target_{m}") for m in ("total_reviews", "average_rating", "recent_average")],
        beaten("average_rating").alias("better_rating_count"),
        competitors.alias("total_competitors_rating"),
        beaten("total_reviews").alias("better_popularity_count"),
        competitors.alias("total_competitors_popularity"),
        "rivals",
    ))


def _with_rival(exploded: DataFrame) -> DataFrame:
    """The columns of a pair from a target row and its struct ``rival``."""
    return exploded.select(
        "*", *_rival_columns(), *[F.col(f"rival.{m}").alias(f"competitor_{m}") for m in PROFILE_MEASURES])


def analysis_of_targets(targets: DataFrame) -> DataFrame:
    """The pair table (up to 50 rows per business) of ``rated_targets``, exploded at the very end."""
    return _with_rival(targets.select("*", F.explode("rivals").alias("rival"))).select(
        RESULT_TABLES["competitive_analysis"])


def competitive_analysis_from_business(
        business: DataFrame, profiles: DataFrame, max_competitors: int = V.MAX_COMPETITORS) -> DataFrame:
    """``competitive_analysis`` of the whole business table, in one pass over it."""
    return analysis_of_targets(rated_targets(business, profiles, max_competitors))


def _with_labels(positions: DataFrame) -> DataFrame:
    """Strengths and weaknesses of each position."""
    rating, popularity = F.col("rating_percentile"), F.col("popularity_percentile")
    local = F.col("same_city_competitors")
    return positions.select(
        "*",
        label_text(
            (rating >= V.HIGH_PERCENTILE, V.STRENGTH_RATING),
            (popularity >= V.HIGH_PERCENTILE, V.STRENGTH_POPULARITY),
            (local < V.FEW_LOCAL_RIVALS, V.STRENGTH_LOCAL),
        ).alias("strengths"),
        label_text(
            (rating <= V.LOW_PERCENTILE, V.WEAKNESS_RATING),
            (popularity <= V.LOW_PERCENTILE, V.WEAKNESS_POPULARITY),
            (local > V.MANY_LOCAL_RIVALS, V.WEAKNESS_LOCAL),
        ).alias("weaknesses"),
    ).select(RESULT_TABLES["market_positioning"])


def market_positioning(analysis: DataFrame) -> DataFrame:
    """Position of each business against its competitors, from a table of pairs.

    Competitor ratings are averaged as decimals, so the result does not depend on the order of summation.
    ``positioning_of_targets`` gives the same table without pairs.
    """
    target = [
        "target_business_id", "target_name", "target_city", "target_state", "target_category",
        "target_total_reviews", "target_average_rating", "target_recent_average"]
    constant = ["rating_percentile", "popularity_percentile", "avg_percentile", "market_position"]
    exact_rating = F.col("competitor_average_rating").cast("decimal(10,2)")
    return _with_labels(analysis.groupBy(*target, *constant).agg(
        F.count("*").alias("total_competitors"),
        F.count_if("is_same_city").alias("same_city_competitors"),
        F.max("competitor_average_rating").alias("best_competitor_rating"),
        F.max("competitor_total_reviews").alias("most_popular_competitor_reviews"),
        F.round(F.avg(exact_rating), 2).cast("double").alias("avg_competitor_rating"),
        F.round(F.avg("competitor_total_reviews"), 0).alias("avg_competitor_reviews"),
    ))


def positioning_of_targets(targets: DataFrame) -> DataFrame:
    """Position of each business of ``rated_targets``, computed on its array of rivals without a shuffle."""
    ratings = F.filter(F.transform("rivals", lambda r: r["average_rating"]), lambda v: v.isNotNull())
    exact = F.aggregate(ratings, F.lit(0).cast("decimal(20,2)"),
                        lambda total, v: (total + v.cast("decimal(10,2)")).cast("decimal(20,2)"))
    mean_rating = F.try_divide(exact, F.size(ratings).cast("decimal(20,0)")).cast("decimal(14,6)")
    reviews = F.aggregate("rivals", F.lit(0).cast("long"), lambda total, r: total + r["total_reviews"])
    return _with_labels(targets.select(
        "*",
        F.col("total_competitors_rating").alias("total_competitors"),
        F.size(F.filter("rivals", lambda r: r["is_same_city"])).cast("long").alias("same_city_competitors"),
        F.array_max(ratings).alias("best_competitor_rating"),
        F.array_max(F.transform("rivals", lambda r: r["total_reviews"])).alias("most_popular_competitor_reviews"),
        F.round(mean_rating, 2).cast("double").alias("avg_competitor_rating"),
        F.round(reviews / F.size("rivals"), 0).alias("avg_competitor_reviews"),
    ))


def detailed_comparisons(analysis: DataFrame, k: int = V.COMPARED_COMPETITORS) -> DataFrame:
    """The k best rated competitors per business; ties go by review count, then by competitor id."""
    best = W.partitionBy("target_business_id").orderBy(
        F.desc("competitor_average_rating"), F.desc("competitor_total_reviews"), F.asc("competitor_business_id"))
    return (
        analysis.withColumn("competitor_rank", F.row_number().over(best))
        .filter(F.col("competitor_rank") <= k)
        .select(RESULT_TABLES["detailed_comparisons"])
    )


def comparisons_of_targets(targets: DataFrame, k: int = V.COMPARED_COMPETITORS) -> DataFrame:
    """``detailed_comparisons`` of ``rated_targets``: each array of rivals is ranked in place."""
    worst = F.lit(float("inf"))     # a rival without a rating comes last
    ranked = F.sort_array(F.transform("rivals", lambda r: F.struct(
        F.coalesce(-r["average_rating"], worst).alias("by_rating"), (-r["total_reviews"]).alias("by_reviews"),
        r["business_id"].alias("by_id"), r.alias("rival"))))
    best = targets.select("*", F.posexplode(F.slice(ranked, 1, k)).alias("place", "ranked"))
    return (
        _with_rival(best.withColumn("rival", F.col("ranked.rival")))
        .withColumn("competitor_rank", F.col("place") + 1)
        .select(RESULT_TABLES["detailed_comparisons"])
    )


MARKET_OF_TARGET = ["target_city", "target_state", "target_category"]


def _as_members(rivals: DataFrame) -> DataFrame:
    """The competitor of each pair as a member of its own market."""
    return rivals.select(
        F.col("competitor_city").alias("target_city"),
        F.col("competitor_state").alias("target_state"),
        "target_category",
        F.col("competitor_business_id").alias("target_business_id"),
        F.col("competitor_name").alias("target_name"),
        F.col("competitor_total_reviews").alias("target_total_reviews"),
    )


def _shares(as_target: DataFrame, as_competitor: DataFrame, min_market: int) -> DataFrame:
    """Shares of the distinct members. The totals are combined on the map side and joined back, so a market with a
    large part of all businesses is never gathered in one task, as a window over it would."""
    as_target = as_target.select(*MARKET_OF_TARGET, "target_business_id", "target_name", "target_total_reviews")
    members = as_target.unionByName(as_competitor).filter(F.col("target_city").isNotNull()).distinct()
    totals = (
        members.groupBy(*MARKET_OF_TARGET).agg(F.sum("target_total_reviews").alias("total_market_reviews"))
        .filter(F.col("total_market_reviews") >= min_market)
    )
    share = percent(F.col("target_total_reviews"), F.col("total_market_reviews"), 2)
    return (
        members.join(totals, MARKET_OF_TARGET).withColumn("market_share_pct", share)
        .select(RESULT_TABLES["market_shares"])
    )


def market_shares(analysis: DataFrame, min_market: int = V.MIN_MARKET_REVIEWS) -> DataFrame:
    """Share of reviews per business within its (city, state, category), for markets of some size.

    Works on a stored table of pairs, which is read once for each side of a pair. ``shares_of_targets`` gives the
    same table without pairs.
    """
    return _shares(analysis, _as_members(analysis), min_market)


def shares_of_targets(targets: DataFrame, min_market: int = V.MIN_MARKET_REVIEWS) -> DataFrame:
    """``market_shares`` of ``rated_targets``.

    The businesses of one (category, state, city) share one list of depth+1 rivals, each leaving itself out. So the
    rivals of the first two targets by rank hold everybody that any of them lists: a rival among the first depth
    places is listed by all but itself, hence by one of the two; the one after them only by targets that stand among
    the first depth places, and then the first target does. At most two rows a list are exploded.
    """
    two = _first_two(targets)
    return _shares(targets, _as_members(_with_rival(two.select("*", F.explode("rivals").alias("rival")))), min_market)


def _first_two(targets: DataFrame) -> DataFrame:
    by_rank = W.partitionBy(*MARKET_OF_TARGET).orderBy(F.asc_nulls_first("target_name"), F.asc("target_business_id"))
    return targets.withColumn("place", F.row_number().over(by_rank)).filter(F.col("place") <= 2)


def shares_of_positions(positioning: DataFrame, lists: DataFrame, min_market: int = V.MIN_MARKET_REVIEWS) -> DataFrame:
    """``shares_of_targets`` from the positions and the lists of rated rivals: only the first two targets of a list are
    joined to it, so no array of rivals is sorted."""
    two = _first_two(positioning).select(
        F.col("target_business_id").alias("business_id"), F.col("target_name").alias("name"), F.col("target_city").alias("city"),
        F.col("target_state").alias("state"), F.col("target_category").alias("main_category"))
    rivals = with_rivals(two, lists, V.MAX_COMPETITORS).select(*_target_columns(), F.explode("rivals").alias("rival"))
    rated = _with_rival(rivals.filter(F.col("rival.total_reviews").isNotNull()))
    return _shares(positioning, _as_members(rated), min_market)


def competitive_insights(positioning: DataFrame) -> DataFrame:
    """Positioning plus the main insight, the recommended action and the competitive advantage."""
    rating, popularity = F.col("rating_percentile"), F.col("popularity_percentile")
    local, total = F.col("same_city_competitors"), F.col("total_competitors")
    high, middle = V.HIGH_PERCENTILE, V.MIDDLE_PERCENTILE
    insight = first_match([
        ((rating >= high) & (popularity >= high), V.INSIGHT_LEADER),
        ((rating >= high) & (popularity < middle), V.INSIGHT_HIDDEN_QUALITY),
        ((rating < middle) & (popularity >= high), V.INSIGHT_VISIBLE_WEAK),
        (local < V.FEW_LOCAL_RIVALS, V.INSIGHT_LOCAL),
        (total > V.CROWDED_MARKET, V.INSIGHT_CROWDED),
    ], V.INSIGHT_OTHERWISE)
    action = first_match([
        (rating < middle, V.ACTION_QUALITY),
        (popularity < middle, V.ACTION_VISIBILITY),
        (local < V.OPEN_LOCAL_MARKET, V.ACTION_LOCAL),
    ], V.ACTION_OTHERWISE)
    advantage = first_match([
        (F.col("target_average_rating") > F.col("avg_competitor_rating") + V.RATING_EDGE, V.ADVANTAGE_QUALITY),
        (F.col("target_total_reviews") > F.col("avg_competitor_reviews") * V.POPULARITY_EDGE, V.ADVANTAGE_POPULARITY),
        (local <= total * V.LOCAL_SHARE_EDGE, V.ADVANTAGE_LOCAL),
    ], V.ADVANTAGE_OTHERWISE)
    return positioning.select(
        "*",
        insight.alias("primary_insight"),
        action.alias("recommended_action"),
        advantage.alias("competitive_advantage"),
    )
