"""The operators with production parameters over the whole test tables, by name, and SQL for those that it can express."""

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    centroid_clustering,
    chat_format,
    decontamination,
    html_extraction,
    language_id,
    line_dedup,
    models,
    near_duplicates,
    packing,
    personal_data,
    quality_classifier,
    quality_rules,
    secret_scan,
    whitening,
)

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _digest(spans):
    return F.sha2(secret_scan.spans_text(spans), 256)


def _count(kind: str):
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")


@query
def op1_secret_scan(spark, folder):
    kinds = [rule.kind for rule in secret_scan.BASE_RULES]
    found = secret_scan.find_secrets(_read(spark, folder, "documents"))
    base = found.select("row.doc_id", "spans", F.filter("spans", lambda s: s["kind"].isin(kinds)).alias("base"))
    return base.select("doc_id", *map(_count, kinds), _digest(F.col("base")).alias("base_sha256"),
                       secret_scan.spans_text(F.col("spans")).alias("spans"))


@query
def op2_best_fit_packing(spark, folder):
    return packing.pack(_read(spark, folder, "documents"))


@query
def op3_line_dedup(spark, folder):
    return line_dedup.line_dedup(_read(spark, folder, "documents")).select(
        "row.doc_id", "row.source", "n_lines", "n_dropped", F.col("clean_text").alias("text"))


@query
def op4_near_duplicates(spark, folder):
    return near_duplicates.near_duplicates(_read(spark, folder, "documents"), size=3, percent=85)


@query
def op5_decontamination(spark, folder):
    return decontamination.find_leaks(_read(spark, folder, "documents"), _read(spark, folder, "benchmark")).select(
        "doc_id", F.array_join(F.col("items").cast("array<string>"), ",").alias("items"), "n_matched")


@query
def op6_chat_format(spark, folder):
    return chat_format.format_chat(_read(spark, folder, "conversations"))


@query
def op7_quality_classifier(spark, folder):
    labels = _read(spark, folder, "labels")
    docs = _read(spark, folder, "documents")
    weights = quality_classifier.train(docs, labels.where(models.fold("doc_id", 3) != 1))
    scored = quality_classifier.score(docs, weights)
    return scored.select("doc_id", (models.fold("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


@query
def op8_language_id(spark, folder):
    docs = _read(spark, folder, "documents")
    model = language_id.train(docs.where(models.fold("doc_id", 4) != 2))
    found = language_id.identify(docs, model)
    return found.select("doc_id", (models.fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "ambiguous")


@query
def op9_personal_data(spark, folder):
    docs = _read(spark, folder, "documents")
    found = personal_data.find_personal_data(docs, personal_data.train(docs))
    base = found.withColumn("base", F.filter("spans", lambda s: s["base"]))
    return base.select("doc_id", *map(_count, personal_data.KINDS[:4]), _digest(F.col("base")).alias("base_sha256"),
                       secret_scan.spans_text(F.col("spans")).alias("spans"))


@query
def op10_quality_rules(spark, folder):
    judged = quality_rules.quality_rules(_read(spark, folder, "documents"), carried=["doc_id"])
    return judged.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op11_centroid_clustering(spark, folder):
    state, centroids = centroid_clustering.cluster(_read(spark, folder, "embeddings"))
    inertia = centroid_clustering.inertia_by_cluster(state)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    of_cluster = lambda values, kind: F.get(F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>"), F.col("cluster"))
    return state.select(
        "vec_id", "cluster", "distance", of_cluster([inertia.get(k, 0) for k in range(len(centroids))], "bigint").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("bigint").alias("inertia"), of_cluster(digests, "string").alias("centroid_sha256"))


@query
def op12_embedding_whitening(spark, folder):
    return whitening.whiten(_read(spark, folder, "embeddings"))


@query
def op13_html_extraction(spark, folder):
    found = html_extraction.main_text(_read(spark, folder, "pages"))
    return found.select("row.page_id", "row.url", F.col("main_text").alias("text"), F.length("main_text").cast("bigint").alias("n_chars"))


def _clustering_sql(clusters: int = 40, rounds: int = 5, dims: int = 64) -> str:
    """Each round as two tables: distances to all centroids and the nearest one, then floors of the means."""
    apart = "list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint"
    steps = [f"""v as materialized (select row_number() over (order by vec_id) as r, vec_id,
            list_transform(embedding, lambda y: floor({centroid_clustering.SCALE} * y::double)::bigint) as x
            from embeddings where len(embedding) = {dims} and len(list_filter(embedding, lambda y: y is null or not isfinite(y))) = 0)""",
        f"""c0 as materialized (select row_number() over (order by sha256('2:' || vec_id), x) - 1 as k, x as c
            from v qualify row_number() over (order by sha256('2:' || vec_id), x) <= {clusters})"""]
    for i in range(rounds + 1):
        steps.append(f"""a{i} as materialized (select r, any_value(vec_id) as vec_id, any_value(x) as x,
            min({{'d': {apart}, 'k': k}}) as best from v cross join c{i} group by r)""")
        if i < rounds:
            steps.append(f"""c{i + 1} as materialized (with parts as (select best.k as k, unnest(range(1, {dims + 1})) as i, unnest(x) as y from a{i}),
            sums as (select k, i, sum(y)::bigint as s, count(*) as n from parts group by k, i),
            means as (select k, list((s - ((s % n) + n) % n) // n order by i) as c from sums group by k)
            select k, coalesce(m.c, o.c) as c from c{i} o left join means m using (k))""")
    return f"""with {', '.join(steps)}
        select vec_id, best.k::int as cluster, best.d as distance, (sum(best.d) over (partition by best.k))::bigint as cluster_inertia,
            (sum(best.d) over ())::bigint as inertia, sha256(array_to_string(c, ',')) as centroid_sha256
        from a{rounds} join c{rounds} on best.k = k"""


def _secrets_sql() -> str:
    """Places of matches in SQL: the lengths of the pieces between matches and of the matches add up."""
    q = lambda text: "'" + text.replace("'", "''") + "'"
    one = lambda rule, order: f"""
        select doc_id, {order} as kind_order, {q(rule.kind)} as kind, start, start + long as stop from (
            select doc_id, counted[i] as counted, length(hits[i]) as long,
                list_sum(list_transform(gaps[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[:i - 1], lambda x: length(x))), 0) as start
            from (select doc_id, hits, gaps, counted, unnest(range(1, len(hits) + 1)) as i from (
                select doc_id, regexp_extract_all(text, {q(rule.pattern)}) as hits, string_split_regex(text, {q(rule.pattern)}) as gaps,
                    list_transform(regexp_extract_all(text, {q(rule.pattern)}, {rule.group}), lambda x: length(x)) as counted
                from docs where regexp_matches(text, {q(rule.pattern)})))) where counted >= {rule.min_length}"""
    spans = " union all ".join(one(rule, order) for order, rule in enumerate(secret_scan.RULES))
    base = len(secret_scan.BASE_RULES)
    listed = "coalesce(string_agg(kind || ':' || start::bigint || ':' || stop::bigint, ',' order by start, kind_order, stop) {}, '')"
    counts = ", ".join(f"count(*) filter (kind = {q(r.kind)}) as n_{r.kind}" for r in secret_scan.BASE_RULES)
    return f"""with docs as (select doc_id, coalesce(text, '') as text from documents), spans as ({spans})
        select d.doc_id, {counts}, sha256({listed.format(f"filter (kind_order < {base})")}) as base_sha256,
            {listed.format("filter (kind is not null)")} as spans
        from docs d left join spans s on d.doc_id = s.doc_id group by d.doc_id"""


# The pages of the test tables mark their article; for those the operator's result is the text of that element.
_PAGES_SQL = r"""with articles as (select page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*?)(?:</article>|$)', 1, 's') as html from pages),
    blocks as (select page_id, url, list_transform(string_split_regex(regexp_replace(regexp_replace(html, '</?b>', '', 'g'), '<br>', ' ', 'g'), '<[^>]*>'),
        lambda x: trim(regexp_replace(regexp_replace(replace(replace(replace(x, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) as blocks
        from articles),
    texts as (select page_id, url, array_to_string(list_filter(blocks, lambda x: x <> ''), chr(10)) as text from blocks)
    select page_id, url, text, length(text) as n_chars from texts"""

_SPACE = r"[\x20\x09-\x0D]+"

SQL = {
    "op11_centroid_clustering": _clustering_sql(),
    "op13_html_extraction": _PAGES_SQL,
    "op1_secret_scan": _secrets_sql(),
    "op3_line_dedup": r"""with pages as (select distinct source, text from documents where text is not null),
        totals as (select source, count(*) as host_pages from pages group by source),
        lines as (select distinct source, text, unnest(string_split(text, chr(10))) as line from pages),
        dropped as (select source, line from lines join totals using (source)
            where regexp_matches(line, '[^\x20\x09-\x0D]') group by source, line, host_pages having count(*) >= 5 and count(*) > host_pages * 0.02),
        lists as (select source, list(line) as dropped from dropped group by source),
        split as (select doc_id, d.source, text, string_split(text, chr(10)) as lines,
            list_filter(string_split(text, chr(10)), lambda x: not list_contains(coalesce(dropped, []), x)) as kept
            from documents d left join lists using (source)),
        judged as (select *, len(list_filter(kept, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) = 0 as whole from split)
        select doc_id, source, coalesce(len(lines), 0) as n_lines, case when whole or lines is null then 0 else len(lines) - len(kept) end as n_dropped,
            case when whole then text else array_to_string(kept, chr(10)) end as text from judged""",
    "op10_quality_rules": rf"""with docs as (select doc_id, source, coalesce(text, '') as text from documents),
        split as (select *, list_filter(string_split_regex(text, '{_SPACE}'), lambda x: x <> '') as words,
            list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from docs),
        windows as (select doc_id, i, list_slice(words, i, i + 2) as three from (
            select doc_id, words, unnest(range(1, len(words) - 1)) as i from split)),
        again as (select doc_id, i from windows qualify count(*) over (partition by doc_id, three) > 1),
        repeated as (select doc_id, count(distinct i + k) as n from again, (select unnest([0, 1, 2]) as k) group by doc_id),
        measured as (select s.doc_id, source, len(words) as n_words, length(regexp_replace(text, '{_SPACE}', '', 'g')) as word_chars,
            length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols,
            len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(n, 0) as n_repeat_words, len(lines) as n_lines
            from split s left join repeated using (doc_id)),
        judged as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
            100 * n_symbols > 20 * n_words or 100 * n_dup_lines > 30 * n_lines as soft,
            100 * n_symbols > 5 * n_words or 100 * n_dup_lines > 10 * n_lines as strict from measured),
        hosts as (select source, count(*) as n, count(*) filter (base_failed or soft) as bad from judged group by source),
        prior as (select avg(bad / n) as m, case when var_pop(bad / n) > 0
            then least(greatest(avg(bad / n) * (1 - avg(bad / n)) / var_pop(bad / n) - 1, 2), 1e6) else 1e6 end as s from hosts),
        rates as (select source, (bad + m * s) / (n + s) as rate from hosts, prior)
        select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
            not (base_failed or soft or (rate >= 0.5 and strict) or rate >= 0.9) as kept
        from judged j join rates r on j.source is not distinct from r.source""",
}
