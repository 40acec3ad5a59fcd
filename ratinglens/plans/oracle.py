"""The catalog's queries as plain SQL for DuckDB, written independently of the Spark plans.

Notable differences between the engines: rounding goes through the decimal text of a double, as Spark does it; integer
sums are cast back to bigint; null order is always spelled out.
"""

import re

from .. import fixed_values as V
from ..functions.words import stop_words
from ..schemas import RESULT_TABLES
from ..sources.order_tables import AS_OF
from .catalog import SENT_BATCHES, SLICED_BATCH, STORED_BEFORE


def rounded(expression: str, digits: int) -> str:
    return f"cast(round(cast(cast({expression} as varchar) as decimal(38,18)), {digits}) as double)"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def first_match(rules, otherwise: str) -> str:
    whens = " ".join(f"when {condition} then {text(label)}" for condition, label in rules)
    return f"case {whens} else {text(otherwise)} end"


def flag(condition: str, label: str) -> str:
    return f"case when {condition} then {text(label)} else '' end"


def label_text(*flags) -> str:
    slots = ", ".join(flag(*f) for f in flags)
    return f"regexp_replace(concat_ws('{V.LABEL_SEPARATOR}', {slots}), '{V.LABEL_TRIM_PATTERN}', '', 'g')"


def columns(table: str) -> str:
    return ", ".join(RESULT_TABLES[table])


DATE_LAYOUT = "%Y-%m-%d %H:%M:%S"
STARS = (1, 2, 3, 4, 5)
RECENT = f"reviewed_at >= cast(DATE '{AS_OF}' - INTERVAL {V.RECENT_DAYS} DAY as timestamp)"
MONTH, QUARTER, YEAR = "strftime(reviewed_at, '%Y-%m')", "year(reviewed_at) || '-Q' || quarter(reviewed_at)", \
    "cast(year(reviewed_at) as varchar)"


# Ratings are whole or half numbers, so these sums are exact. stddev_samp carries float noise instead, and rounds a
# deviation of exactly 1.375 (one business at sf0.01) down or up depending on the order of the rows.
STDDEV = """coalesce(case when count(stars) > 1 then
                sqrt((count(stars) * sum(stars * stars) - sum(stars) * sum(stars))
                     / (count(stars) * (count(stars) - 1))) end, 0)"""


def temporal(key: str, period_type: str) -> str:
    return f"""
        select business_id, {key} as period, {rounded('avg(stars)', 2)} as avg_rating, count(*) as review_count,
               cast(sum(useful) as bigint) as useful_total, cast(sum(funny) as bigint) as funny_total,
               cast(sum(cool) as bigint) as cool_total, '{period_type}' as period_type
        from review group by 1, 2"""


TREND = first_match(
    [(f"round(recent_avg - early_avg, 9) > {V.TREND_STEP}", V.TREND_UP),
     (f"round(recent_avg - early_avg, 9) < -{V.TREND_STEP}", V.TREND_DOWN)], V.TREND_FLAT)

RATING, POPULARITY, LOCAL, TOTAL = (
    "rating_percentile", "popularity_percentile", "same_city_competitors", "total_competitors")

# building blocks; a query carries those it mentions
BLOCKS = {
    "review": f"""
        select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d'),
                         cast(l_quantity as int)) as review_id,
               o_custkey as business_id, l_suppkey as user_id, cast(ceil(l_quantity / 10.0) as double) as stars,
               l_linenumber as useful, cast(round(l_tax * 100) as int) as funny,
               case when l_linenumber % 2 = 0 then null else l_linenumber end as cool,
               strftime(l_shipdate, '{DATE_LAYOUT}') as date, l_shipdate as reviewed_at
        from lineitem join orders on l_orderkey = o_orderkey""",
    "business": """
        select c_custkey as business_id, c_name as name, n_name as city, r_name as state,
               concat('No ', c_custkey) as address, cast(c_custkey % 180 - 90 as double) as latitude,
               cast(c_custkey % 360 - 180 as double) as longitude,
               case when c_custkey % 5 = 0 then 0 else 1 end as is_open,
               case when c_custkey % 17 = 0 then null
                    when c_custkey % 13 = 0 then concat('Niche', c_custkey % 4, ', ', c_mktsegment)
                    else concat(c_mktsegment, ', Services') end as categories
        from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "users": """
        select s_suppkey as user_id, s_name as name, cast(floor(s_acctbal / 100) as int) as fans,
               case s_suppkey % 3 when 0 then '2000,2001' when 1 then '' else null end as elite
        from supplier""",
    "overview": f"""
        with stats as (
            select business_id, count(*) as total_reviews, {rounded('avg(stars)', 2)} as average_rating,
                   strftime(max(reviewed_at), '{DATE_LAYOUT}') as last_review_date
            from review group by 1),
        recent as (select business_id, avg(stars) as recent from review where {RECENT} group by 1)
        select b.business_id, name, address, city, state, categories, is_open, total_reviews, average_rating,
               {rounded('coalesce(recent, average_rating)', 2)} as recent_average, last_review_date
        from business b join stats using (business_id) left join recent using (business_id)""",
    "distribution": """
        select business_id, cast(stars as int) as rating, count(*) as count
        from review group by business_id, stars""",
    "periods": "\n        union all".join([
        temporal(MONTH, "month"), temporal(QUARTER, "quarter"), temporal(YEAR, "year")]),
    "trend": f"""
        with quarters as (
            select business_id, {QUARTER} as quarter, avg(stars) as avg_rating from review group by 1, 2),
        ranked as (
            select *, row_number() over (partition by business_id order by quarter nulls first) as rn,
                   count(*) over (partition by business_id) as n
            from quarters),
        ends as (
            select business_id, n, avg(avg_rating) filter (where rn <= {V.MIN_QUARTERS}) as early_avg,
                   avg(avg_rating) filter (where rn > n - {V.MIN_QUARTERS}) as recent_avg
            from ranked group by 1, 2)
        select business_id, {rounded('early_avg', 6)} as early_avg, {rounded('recent_avg', 6)} as recent_avg,
               {TREND} as trend, cast(n as int) as total_quarters
        from ends where n >= {V.MIN_QUARTERS}""",
    "activity": f"""
        select business_id, user_id, any_value(u.name) as name, any_value(u.elite) as elite,
               {rounded('avg(stars)', 2)} as avg_rating, count(*) as review_count,
               cast(sum(useful) as bigint) as useful_votes
        from review join users u using (user_id) group by 1, 2""",
    "user_stats": f"""
        select business_id, count(distinct user_id) as unique_users,
               {rounded('avg(review_count)', 1)} as avg_reviews_per_user,
               count(elite) as elite_users_count, max(useful_votes) as max_useful_votes
        from activity group by 1""",
    "reviewers": f"""
        select business_id, user_id, name, avg_rating, review_count, useful_votes, elite, rn
        from (select *, cast(row_number() over (
                  partition by business_id order by useful_votes desc nulls last, user_id) as int) as rn
              from activity)
        where rn <= {V.TOP_REVIEWERS}""",
    "profiles": f"""
        with stats as (
            select business_id, count(*) as total_reviews, {rounded('avg(stars)', 2)} as average_rating,
                   {rounded(STDDEV, 2)} as rating_stddev,
                   cast(sum(useful) as bigint) as total_useful, cast(sum(funny) as bigint) as total_funny,
                   cast(sum(cool) as bigint) as total_cool,
                   {', '.join(f'count(*) filter (where stars = {s}) as rating_{s}' for s in STARS)},
                   strftime(max(reviewed_at), '{DATE_LAYOUT}') as last_review_date,
                   strftime(min(reviewed_at), '{DATE_LAYOUT}') as first_review_date
            from review group by 1),
        recent as (
            select business_id, avg(stars) as recent, count(*) as n, count(distinct user_id) as n_users
            from review where {RECENT} group by 1)
        select b.business_id, name, address, city, state, categories, latitude, longitude, is_open, total_reviews,
               average_rating, {rounded('coalesce(recent, average_rating)', 2)} as recent_average, rating_stddev,
               total_useful, total_funny, total_cool, coalesce(n, 0) as recent_reviews,
               coalesce(n_users, 0) as recent_unique_users, {', '.join(f'rating_{s}' for s in STARS)},
               last_review_date, first_review_date
        from business b join stats using (business_id) left join recent using (business_id)""",
    "mappings": f"""
        with members as (
            select business_id, name, city, state, trim(split_part(categories, ',', 1)) as category
            from business where trim(split_part(categories, ',', 1)) <> ''),
        pairs as (
            select t.business_id as target_business_id, t.name as target_name, t.city as target_city,
                   t.state as target_state, t.category as target_category,
                   c.business_id as competitor_business_id, c.name as competitor_name, c.city as competitor_city,
                   c.state as competitor_state, coalesce(t.city = c.city, false) as is_same_city
            from members t join members c
              on t.category = c.category and t.state = c.state and t.business_id <> c.business_id)
        select * exclude (place)
        from (select *, row_number() over (
                  partition by target_business_id
                  order by is_same_city desc, competitor_name nulls first, competitor_business_id) as place
              from pairs)
        where place <= {V.MAX_COMPETITORS}""",
    "analysis": f"""
        with pairs as (
            select m.*, t.total_reviews as target_total_reviews, t.average_rating as target_average_rating,
                   t.recent_average as target_recent_average, c.total_reviews as competitor_total_reviews,
                   c.average_rating as competitor_average_rating, c.recent_average as competitor_recent_average,
                   {', '.join(f'c.rating_{s} as competitor_rating_{s}' for s in STARS)}
            from mappings m join profiles t on t.business_id = target_business_id
            join profiles c on c.business_id = competitor_business_id),
        counts as (
            select target_business_id,
                   count(*) filter (where target_average_rating > competitor_average_rating) as better_rating_count,
                   count(*) as total_competitors_rating,
                   count(*) filter (where target_total_reviews > competitor_total_reviews) as better_popularity_count,
                   count(*) as total_competitors_popularity
            from pairs group by 1),
        percentiles as (
            select *,
                   {rounded('cast(better_rating_count as double) / total_competitors_rating * 100', 1)}
                       as rating_percentile,
                   {rounded('cast(better_popularity_count as double) / total_competitors_popularity * 100', 1)}
                       as popularity_percentile
            from counts),
        averaged as (
            select *, {rounded('(rating_percentile + popularity_percentile) / 2', 1)} as avg_percentile
            from percentiles)
        select {columns('competitive_analysis').replace('target_business_id', 'pairs.target_business_id').replace(
            'market_position', first_match([(f'avg_percentile >= {bound}', label) for bound, label
                                            in V.POSITION_TIERS], V.POSITION_OTHERWISE) + ' as market_position')}
        from pairs join averaged on pairs.target_business_id = averaged.target_business_id""",
    # the mean of whole hundredths, rounded half up in integers
    "positioning": f"""
        with grouped as (
            select target_business_id, target_name, target_city, target_state, target_category, target_total_reviews,
                   target_average_rating, target_recent_average, rating_percentile, popularity_percentile,
                   avg_percentile, market_position, count(*) as total_competitors,
                   count(*) filter (where is_same_city) as same_city_competitors,
                   max(competitor_average_rating) as best_competitor_rating,
                   max(competitor_total_reviews) as most_popular_competitor_reviews,
                   cast((2 * sum(cast(round(competitor_average_rating * 100) as bigint))
                         + count(competitor_average_rating)) // (2 * count(competitor_average_rating)) as double) / 100
                       as avg_competitor_rating,
                   {rounded('avg(competitor_total_reviews)', 0)} as avg_competitor_reviews
            from analysis group by all)
        select *,
               {label_text((f'{RATING} >= {V.HIGH_PERCENTILE}', V.STRENGTH_RATING),
                           (f'{POPULARITY} >= {V.HIGH_PERCENTILE}', V.STRENGTH_POPULARITY),
                           (f'{LOCAL} < {V.FEW_LOCAL_RIVALS}', V.STRENGTH_LOCAL))} as strengths,
               {label_text((f'{RATING} <= {V.LOW_PERCENTILE}', V.WEAKNESS_RATING),
                           (f'{POPULARITY} <= {V.LOW_PERCENTILE}', V.WEAKNESS_POPULARITY),
                           (f'{LOCAL} > {V.MANY_LOCAL_RIVALS}', V.WEAKNESS_LOCAL))} as weaknesses
        from grouped""",
    "comparisons": f"""
        select {columns('detailed_comparisons')}
        from (select *, cast(row_number() over (
                  partition by target_business_id
                  order by competitor_average_rating desc nulls last, competitor_total_reviews desc,
                           competitor_business_id) as int) as competitor_rank
              from analysis)
        where competitor_rank <= {V.COMPARED_COMPETITORS}""",
    "shares": f"""
        with members as (
            select target_city, target_state, target_category, target_business_id, target_name, target_total_reviews
            from analysis
            union
            select competitor_city, competitor_state, target_category, competitor_business_id, competitor_name,
                   competitor_total_reviews
            from analysis),
        totals as (
            select *, cast(sum(target_total_reviews) over (
                partition by target_city, target_state, target_category) as bigint) as total_market_reviews
            from members where target_city is not null)
        select *, {rounded('cast(target_total_reviews as double) / total_market_reviews * 100', 2)}
                   as market_share_pct
        from totals where total_market_reviews >= {V.MIN_MARKET_REVIEWS}""",
    "insights": f"""
        select *,
               {first_match([
                   (f'{RATING} >= {V.HIGH_PERCENTILE} and {POPULARITY} >= {V.HIGH_PERCENTILE}', V.INSIGHT_LEADER),
                   (f'{RATING} >= {V.HIGH_PERCENTILE} and {POPULARITY} < {V.MIDDLE_PERCENTILE}',
                    V.INSIGHT_HIDDEN_QUALITY),
                   (f'{RATING} < {V.MIDDLE_PERCENTILE} and {POPULARITY} >= {V.HIGH_PERCENTILE}',
                    V.INSIGHT_VISIBLE_WEAK),
                   (f'{LOCAL} < {V.FEW_LOCAL_RIVALS}', V.INSIGHT_LOCAL),
                   (f'{TOTAL} > {V.CROWDED_MARKET}', V.INSIGHT_CROWDED)], V.INSIGHT_OTHERWISE)} as primary_insight,
               {first_match([
                   (f'{RATING} < {V.MIDDLE_PERCENTILE}', V.ACTION_QUALITY),
                   (f'{POPULARITY} < {V.MIDDLE_PERCENTILE}', V.ACTION_VISIBILITY),
                   (f'{LOCAL} < {V.OPEN_LOCAL_MARKET}', V.ACTION_LOCAL)], V.ACTION_OTHERWISE)}
                   as recommended_action,
               {first_match([
                   (f'target_average_rating > avg_competitor_rating + {V.RATING_EDGE}::double', V.ADVANTAGE_QUALITY),
                   (f'target_total_reviews > avg_competitor_reviews * {V.POPULARITY_EDGE}', V.ADVANTAGE_POPULARITY),
                   (f'{LOCAL} <= {TOTAL} * {V.LOCAL_SHARE_EDGE}::double', V.ADVANTAGE_LOCAL)], V.ADVANTAGE_OTHERWISE)}
                   as competitive_advantage
        from positioning""",
    "side_by_side": f"""
        select target_business_id, competitor_rank as place, competitor_business_id as business_id,
               competitor_name as name, competitor_average_rating as avg_rating,
               competitor_total_reviews as review_count,
               {', '.join(f'competitor_rating_{s} as rating_{s}' for s in STARS)}, false as is_target
        from comparisons where competitor_rank <= {V.SIDE_BY_SIDE}
        union all
        select business_id, cast(0 as int), business_id, name || {text(V.TARGET_SUFFIX)}, average_rating, total_reviews,
               {', '.join(f'rating_{s}' for s in STARS)}, true
        from profiles where business_id in (select target_business_id from comparisons)""",
    "numbered": "select *, row_number() over (order by date nulls first, review_id) as id_date from review",
    "batched": f"select *, (id_date - 1) // {V.REPLAY_BATCH_SIZE} as batch_id from numbered",
    "stored": f"select * from review where reviewed_at < TIMESTAMP '{STORED_BEFORE}'",
    "word": rf"""
        select source as business_id,
               unnest(string_split(trim(regexp_replace(regexp_replace(lower(text), '{V.NON_LETTER_OR_SPACE}', ' ', 'g'),
                                                       '\s+', ' ', 'g')), ' ')) as word
        from documents where text <> ''""",
}


def market_view(market: str) -> str:
    category = "trim(split_part(categories, ',', 1))"
    same_category = f"and l.target_category = {category}" if "category" in market else ""
    return f"""
        with ranked as (
            select *, cast(row_number() over (
                       partition by {market}
                       order by target_category, market_share_pct desc, target_business_id) as int) as place,
                   first(total_market_reviews) over (
                       partition by {market}
                       order by target_category, market_share_pct desc, target_business_id) as view_total_reviews
            from shares)
        select p.business_id, place, target_business_id, target_name, target_city, target_state, l.target_category,
               target_total_reviews, total_market_reviews, market_share_pct, view_total_reviews
        from profiles p join ranked l on p.city = target_city and p.state = target_state {same_category}
        where place <= {V.MARKET_VIEW_ROWS}"""


def tier(value: str, tiers, otherwise: str) -> str:
    return first_match([(f"{value} >= {bound}", label) for bound, label in tiers], otherwise)


def list_text(column: str) -> str:
    parts = f"list_filter(list_transform(string_split({column}, ','), lambda p: trim(p)), lambda p: p <> '')"
    return f"coalesce(array_to_string({parts}, ' | '), '')"


PLAN_RULES = [
    (f"{RATING} < {V.MIDDLE_PERCENTILE}", V.PLAN_QUALITY),
    (f"{RATING} < {V.MIDDLE_PERCENTILE}", V.PLAN_NEGATIVE),
    (f"{POPULARITY} < {V.MIDDLE_PERCENTILE}", V.PLAN_VISIBILITY),
    (f"{POPULARITY} < {V.MIDDLE_PERCENTILE}", V.PLAN_LOCAL_MARKETING),
    (f"{LOCAL} < {V.OPEN_LOCAL_MARKET}", V.PLAN_GEOGRAPHY),
    (f"best_competitor_rating > target_average_rating + {V.RATING_EDGE}::double", V.PLAN_LEADER),
]
PLAN_SLOTS = ", ".join(f"case when {condition} then {text(label)} end" for condition, label in PLAN_RULES)
STOP_WORD_LIST = ", ".join(text(w) for w in stop_words())
HEADINGS = V.COMPETITOR_TABLE_HEADINGS

SELECTS = {
    "a01_business_overview": f"select {columns('business_overview')} from overview",
    "a02_rating_distribution": "select * from distribution",
    "a03_temporal_month": temporal(MONTH, "month"),
    "a03_temporal_quarter": temporal(QUARTER, "quarter"),
    "a03_temporal_year": temporal(YEAR, "year"),
    "a03_temporal_all": "select * from periods",
    "a04_trend_analysis": "select * from trend",
    "a05_business_user_stats": "select * from user_stats",
    "a06_top_reviewers": "select * from reviewers",
    "a07_business_profiles": f"select {columns('business_profiles')} from profiles",
    "a08_competitor_mappings": f"select {columns('competitor_mappings')} from mappings",
    "a09_competitive_analysis": f"select {columns('competitive_analysis')} from analysis",
    "a09_analysis_of_mappings": f"select {columns('competitive_analysis')} from analysis",
    "a10_market_positioning": f"select {columns('market_positioning')} from positioning",
    "a11_detailed_comparisons": f"select {columns('detailed_comparisons')} from comparisons",
    "a12_market_shares": f"select {columns('market_shares')} from shares",
    "a13_competitive_insights": f"select {columns('competitive_insights')} from insights",
    "d01_store_counts": """
        select 'business_table' as table_name, count(*) as row_count from business
        union all select 'review_table', count(*) from review
        union all select 'user_table', count(*) from users
        union all select 'business_profiles', count(*) from profiles
        union all select 'competitor_mappings', count(*) from mappings
        union all select 'competitive_insights', count(*) from insights""",
    "d02_overview_by_reviews":
        f"select {columns('business_overview')} from overview order by total_reviews desc, business_id",
    "d03_business_directory": """
        select business_id, name, city, state, categories, name || ' (' || city || ', ' || state || ')' as display_name
        from overview""",
    "d04_business_card": f"""
        select business_id, name, address || ', ' || city || ', ' || state as full_address, categories, total_reviews,
               average_rating, recent_average, is_open <> 0 as is_open,
               case when is_open <> 0 then {text(V.STATUS_OPEN)} else {text(V.STATUS_CLOSED)} end as status,
               case when recent_average <> average_rating then {rounded('recent_average - average_rating', 2)} end
                   as recent_change,
               last_review_date
        from overview""",
    "d05_rating_map": """
        select business_id, string_agg(rating || '=' || n, ' ' order by rating) as distribution
        from (select business_id, rating, cast(sum(count) as bigint) as n from distribution group by 1, 2)
        group by 1""",
    "d06_period_trend": f"""
        with ranked as (
            select business_id, period_type, cast(round(avg_rating * 100) as bigint) as cents,
                   row_number() over (partition by business_id, period_type order by period nulls last) as rn,
                   count(*) over (partition by business_id, period_type) as periods
            from periods),
        ends as (
            select business_id, period_type, periods,
                   sum(cents) filter (where rn <= {V.MIN_QUARTERS}) as early,
                   sum(cents) filter (where rn > periods - {V.MIN_QUARTERS}) as late
            from ranked group by 1, 2, 3)
        select business_id, period_type, periods,
               {first_match([(f'periods >= {V.MIN_QUARTERS} and late - early > 60', V.TREND_UP),
                             (f'periods >= {V.MIN_QUARTERS} and late - early < -60', V.TREND_DOWN)],
                            V.TREND_FLAT)} as trend
        from ends""",
    "d07_trend_lookup": f"""
        select b.business_id, coalesce(trend, {text(V.TREND_FLAT)}) as trend, early_avg, recent_avg, total_quarters
        from business b left join trend t on b.business_id = t.business_id""",
    "d08_reviewer_panel": """
        select s.business_id, unique_users, avg_reviews_per_user, elite_users_count,
               string_agg(concat_ws('/', rn, name, cast(avg_rating as decimal(10,2)), review_count, useful_votes,
                                    coalesce(elite, '-')), ' | ' order by rn) as top_reviewers
        from user_stats s left join reviewers r on s.business_id = r.business_id group by 1, 2, 3, 4""",
    "d09_review_texts": """
        select doc_id as review_id, source as business_id, text from documents where text is not null and text <> ''""",
    "d10_word_counts": f"""
        with counts as (
            select business_id, word, count(*) as uses from word where word <> '' group by 1, 2),
        readable as (
            select business_id from counts group by 1
            having sum(length(word) * uses) + sum(uses) - 1 >= {V.MIN_CLOUD_CHARS})
        select business_id, word, uses, rank
        from (select business_id, word, uses, cast(row_number() over (
                  partition by business_id order by uses desc, word) as int) as rank
              from counts
              where length(word) >= {V.MIN_WORD_LETTERS} and word not in ({STOP_WORD_LIST})
                and business_id in (select business_id from readable))
        where rank <= {V.TOP_WORDS}""",
    "d11_target_card": """
        select business_id, name, city, state, categories, total_reviews, average_rating, recent_average, rating_stddev,
               last_review_date
        from profiles""",
    "d12_competitor_list": f"""
        select target_business_id, competitor_rank, competitor_business_id, competitor_name, competitor_city,
               competitor_state, competitor_average_rating, competitor_recent_average, competitor_total_reviews,
               is_same_city, concat_ws('/', {', '.join(f'competitor_rating_{s}' for s in STARS)}) as rating_distribution
        from comparisons where competitor_rank <= {V.DEFAULT_COMPETITOR_LIST}""",
    "d13_positioning_lookup": f"""
        select b.business_id, coalesce(market_position, {text(V.POSITION_UNKNOWN)}) as market_position,
               coalesce(rating_percentile, 0) as rating_percentile,
               coalesce(popularity_percentile, 0) as popularity_percentile,
               total_competitors, same_city_competitors, best_competitor_rating, avg_competitor_rating,
               avg_competitor_reviews, {list_text('strengths')} as strengths_list,
               {list_text('weaknesses')} as weaknesses_list
        from business b left join positioning on b.business_id = target_business_id""",
    "d14_side_by_side": "select * from side_by_side",
    "d14_top_competitor": "select * from comparisons where competitor_rank = 1",
    "d15_insight_lookup": """
        select target_business_id as business_id, primary_insight, recommended_action, competitive_advantage
        from insights""",
    "d16_market_view": market_view("target_city, target_state"),
    "d16_category_view": market_view("target_city, target_state, target_category"),
    "d17_short_names": f"""
        select target_business_id, target_category, label,
               case when length(label) > {V.SHORT_NAME_LENGTH}
                    then left(label, {V.SHORT_NAME_LENGTH}) || '{V.SHORT_NAME_SUFFIX}' else label end as short_name
        from (select *, concat_ws(', ', target_name, target_city) as label from shares)""",
    "d18_rating_series": " union all ".join(
        f"select target_business_id, place, business_id, name, {s} as star, rating_{s} as reviews from side_by_side"
        for s in STARS),
    "d19_competitor_table": f"""
        select target_business_id, competitor_rank, {', '.join(
            (f'case when {c} then {text(V.FLAG_YES)} else {text(V.FLAG_NO)} end' if c == 'is_same_city' else c)
            + f' as "{heading}"' for c, heading in HEADINGS.items())}
        from comparisons where competitor_rank <= {V.DEFAULT_COMPETITOR_LIST}""",
    "d20_status_tiers": f"""
        select target_business_id as business_id,
               {tier(RATING, V.RATING_TIERS, V.RATING_TIER_OTHERWISE)} as rating_tier,
               cast(round_even({RATING}, 0) as int) as rating_shown,
               {tier(POPULARITY, V.POPULARITY_TIERS, V.POPULARITY_TIER_OTHERWISE)} as popularity_tier,
               cast(round_even(case when {POPULARITY} < {V.MIDDLE_PERCENTILE} then 100 - {POPULARITY}
                                    else {POPULARITY} end, 0) as int) as popularity_shown
        from positioning""",
    "d21_action_plan": f"""
        select target_business_id as business_id,
               coalesce(nullif(concat_ws(' | ', {PLAN_SLOTS}), ''), {text(V.PLAN_OTHERWISE)}) as actions
        from positioning""",
    "d22_leader_gap": f"""
        select target_business_id as business_id, abs(gap) as gap,
               case when gap > 0 then {text(V.GAP_BEHIND)} else {text(V.GAP_AHEAD)} end as gap_label
        from (select target_business_id, {rounded('best_competitor_rating - target_average_rating', 2)} as gap
              from positioning where best_competitor_rating > 0)""",
    "in01_id_date": "select review_id, date, id_date from numbered",
    "in02_batch_id": "select review_id, id_date, batch_id from batched",
    "in03_batch_count": "select count(distinct batch_id) as batches from batched",
    "in04_batch_slice": f"select review_id, date, id_date from batched where batch_id = {SLICED_BATCH}",
    "in04_batch_bounds": """
        select batch_id, min(id_date) as first_id, max(id_date) as last_id, count(*) as reviews
        from batched group by 1""",
    "in05_resume": f"select review_id, id_date, batch_id from batched where batch_id >= {SENT_BATCHES}",
    "in06_parse_json": """
        select review_id, cast(business_id as varchar) as business_id, cast(user_id as varchar) as user_id, stars,
               useful, funny, cool, date, reviewed_at
        from review""",
    "in08_new_reviews": """
        select review_id, business_id, user_id, stars, date from review
        where review_id not in (select review_id from stored)""",
    "in08_bucketed_new_reviews": """
        select review_id, business_id, user_id, stars, date from review
        where review_id not in (select review_id from stored)""",
    "in09_dedupe": """
        select review_id, business_id, user_id, date, stars, useful, funny
        from (select split_part(review_id, '-', 1) as review_id, business_id, user_id, date, stars, useful, funny,
                     row_number() over (
                         partition by split_part(review_id, '-', 1)
                         order by date, business_id, user_id, stars, useful, funny, cool nulls first) as place
              from review)
        where place = 1""",
    "in10_all_reviews": "select review_id, business_id, user_id, date from review",
    "in12_active_business": "select * from business where business_id in (select business_id from review)",
    "in12_active_users": "select * from users where user_id in (select user_id from review)",
    "in15_incremental_profiles": f"select {columns('business_profiles')} from profiles",
    "in15_incremental_insights": f"select {columns('competitive_insights')} from insights",
    "in15_incremental_comparisons": f"select {columns('detailed_comparisons')} from comparisons",
    "in15_state_reviewers": "select * from reviewers",
    "in15_state_profiles": f"select {columns('business_profiles')} from profiles",
    "in15_state_insights": f"select {columns('competitive_insights')} from insights",
    "in13_membership_time": """
        select user_id, name, case when user_id % 7 <> 0 then min(date) end as yelping_since
        from review join users using (user_id) group by user_id, name""",
    "in14_active_business": f"""
        select * from business where categories is not null and business_id in (
            select business_id from review group by 1 having count(*) >= {V.MIN_ACTIVE_REVIEWS})""",
    "in14_active_reviews": f"""
        select review_id, business_id, stars from review where business_id in (
            select business_id from review group by 1 having count(*) >= {V.MIN_ACTIVE_REVIEWS})""",
}


def _with_blocks(select: str) -> str:
    """The select with the building blocks that it needs, directly or through others."""
    needed, pending = set(), [select]
    while pending:
        sql = pending.pop()
        for name in BLOCKS.keys() - needed:
            if re.search(rf"\b(from|join)\s+{name}\b", sql):
                needed.add(name)
                pending.append(BLOCKS[name])
    blocks = ",\n".join(f"{name} as ({BLOCKS[name]})" for name in BLOCKS if name in needed)
    return f"with {blocks}\nselect * from ({select})" if blocks else select


def oracle_sql() -> dict[str, str]:
    return {name: _with_blocks(select) for name, select in SELECTS.items()}
