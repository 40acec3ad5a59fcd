"""Input schemas and result-table columns.

Fixed values: the names, types and order below are the data contract with whoever writes dumps and reads tables.
"""

from pyspark.sql import types as T

REVIEW = T.StructType([
    T.StructField("review_id", T.StringType()),
    T.StructField("business_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("stars", T.DoubleType()),
    T.StructField("useful", T.IntegerType()),
    T.StructField("funny", T.IntegerType()),
    T.StructField("cool", T.IntegerType()),
    T.StructField("text", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("id_date", T.LongType()),
])

BUSINESS = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("business_id", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("address", T.StringType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("state", T.StringType()),
    T.StructField("is_open", T.IntegerType()),
    T.StructField("categories", T.StringType()),
])

USER = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("friends", T.StringType()),
    T.StructField("elite", T.StringType()),
    T.StructField("fans", T.IntegerType()),
    T.StructField("yelping_since", T.TimestampType()),
    T.StructField("name", T.StringType()),
])

BUSINESS_COLUMNS = ["business_id", "name", "city", "address", "latitude", "longitude", "state", "categories", "is_open"]
USER_COLUMNS = ["user_id", "name", "fans", "elite", "friends", "yelping_since"]

# result table -> columns, in output order
RESULT_TABLES = {
    "business_overview": """business_id name address city state categories is_open total_reviews average_rating
        recent_average last_review_date""".split(),
    "rating_distribution": "business_id rating count".split(),
    "temporal_analysis": """business_id period avg_rating review_count useful_total funny_total cool_total
        period_type""".split(),
    "trend_analysis": "business_id early_avg recent_avg trend total_quarters".split(),
    "business_user_stats": """business_id unique_users avg_reviews_per_user elite_users_count
        max_useful_votes""".split(),
    "top_reviewers": "business_id user_id name avg_rating review_count useful_votes elite rn".split(),
    "business_profiles": """business_id name address city state categories latitude longitude is_open total_reviews
        average_rating recent_average rating_stddev total_useful total_funny total_cool recent_reviews
        recent_unique_users rating_1 rating_2 rating_3 rating_4 rating_5 last_review_date
        first_review_date""".split(),
    "competitor_mappings": """target_business_id target_name target_city target_state target_category
        competitor_business_id competitor_name competitor_city competitor_state is_same_city""".split(),
    "competitive_analysis": """target_business_id target_name target_city target_state target_category
        target_total_reviews target_average_rating target_recent_average competitor_business_id competitor_name
        competitor_city competitor_state is_same_city competitor_total_reviews competitor_average_rating
        competitor_recent_average competitor_rating_1 competitor_rating_2 competitor_rating_3 competitor_rating_4
        competitor_rating_5 better_rating_count total_competitors_rating better_popularity_count
        total_competitors_popularity rating_percentile popularity_percentile avg_percentile
        market_position""".split(),
    "market_positioning": """target_business_id target_name target_city target_state target_category
        target_total_reviews target_average_rating target_recent_average rating_percentile popularity_percentile
        avg_percentile market_position total_competitors same_city_competitors best_competitor_rating
        most_popular_competitor_reviews avg_competitor_rating avg_competitor_reviews strengths weaknesses""".split(),
    "detailed_comparisons": """target_business_id target_name competitor_business_id competitor_name competitor_city
        competitor_state is_same_city competitor_rank competitor_total_reviews competitor_average_rating
        competitor_recent_average competitor_rating_1 competitor_rating_2 competitor_rating_3 competitor_rating_4
        competitor_rating_5""".split(),
    "market_shares": """target_city target_state target_category target_business_id target_name target_total_reviews
        total_market_reviews market_share_pct""".split(),
}
RESULT_TABLES["competitive_insights"] = RESULT_TABLES["market_positioning"] + [
    "primary_insight", "recommended_action", "competitive_advantage"]
