"""Operator 1: secrets, found through an inverted index of the trigrams that the rules demand."""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import staged
from .trigram_queries import ANY, Query, rarest, trigram_query


@dataclass(frozen=True)
class Rule:
    """``pattern`` is read alike by Java, RE2 and Python; a match counts if ``group`` has ``min_length`` characters."""
    kind: str
    pattern: str
    group: int = 0
    min_length: int = 0

    @property
    def query(self) -> Query:
        return rarest(trigram_query(self.pattern))


# The base kinds, then those that the method adds
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
ADDED_RULES = (
    Rule("github", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN (RSA |EC |DSA |OPENSSH )?PRIVATE KEY-----"),
)
RULES = BASE_RULES + ADDED_RULES
WORD_BITS = 63                  # trigrams whose bits lie in one long
SPANS = "array<struct<start:bigint,order:int,end:bigint,kind:string>>"


def indexed_trigrams(rules: tuple[Rule, ...] = RULES) -> list[str]:
    return sorted({t for rule in rules for alternative in rule.query for t in alternative})


def trigram_index(docs: DataFrame, trigrams: list[str], text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(trigram, doc_id): the postings of the given trigrams in the lower-cased texts, each pair once a row."""
    lowered = docs.select(F.col(doc_id).alias("doc_id"), F.lower(text).alias("lowered"))
    found = F.array_compact(F.array(*[F.when(F.col("lowered").contains(t), F.lit(t)) for t in trigrams]))
    return lowered.select(F.explode(found).alias("trigram"), "doc_id")


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, kinds): the rules whose trigram query the postings of a document satisfy.

    All intersections are made in one grouping by document, in which a document's postings are combined into
    bitmaps of ``WORD_BITS`` trigrams each before the shuffle, as many as the rules' trigrams need. Rules that demand no
    trigram are not listed: they have to scan every text.
    """
    place = {t: divmod(i, WORD_BITS) for i, t in enumerate(indexed_trigrams(rules))}
    if not place:
        return index.select("doc_id", F.array().cast("array<string>").alias("kinds")).where("false")
    words = 1 + max(word for word, _ in place.values())

    def bits_of(word):
        bit = F.create_map(*[x for t, (w, i) in place.items() if w == word for x in (F.lit(t), F.lit(1 << i).cast("bigint"))])
        return F.bit_or(F.coalesce(bit[F.col("trigram")], F.lit(0))).alias(f"mask_{word}")

    def holds(alternative):
        masks = {}
        for word, i in map(place.get, alternative):
            masks[word] = masks.get(word, 0) | 1 << i
        return reduce(Column.__and__, [F.col(f"mask_{w}").bitwiseAND(F.lit(m)) == m for w, m in sorted(masks.items())])

    masks = index.groupBy("doc_id").agg(*map(bits_of, range(words)))
    kinds = []
    for rule in rules:
        if rule.query != ANY:
            satisfied = F.lit(False)
            for alternative in rule.query:
                satisfied = satisfied | holds(alternative)
            kinds.append(F.when(satisfied, F.lit(rule.kind)))
    return masks.select("doc_id", F.array_compact(F.array(*kinds)).alias("kinds")).where(F.size("kinds") > 0)


def matches(text: Column, rule: Rule, order: int) -> Column:
    """Array of (start, order, end, kind) of a rule's matches, in code points.

    The pieces between the matches and the matches themselves alternate, so their lengths add up to the places.
    """
    state = f"struct<place:bigint,spans:{SPANS}>"
    parts = F.arrays_zip(
        F.transform(F.split(text, rule.pattern, -1), lambda p: F.length(p)).alias("gap"),
        F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), lambda m: F.length(m)).alias("long"),
        F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)), lambda m: F.length(m)).alias("counted"))

    def add(sofar, part):
        start = sofar["place"] + part["gap"]
        end = start + F.coalesce(part["long"], F.lit(0))
        one = F.struct(start.alias("start"), F.lit(order).alias("order"), end.alias("end"), F.lit(rule.kind).alias("kind"))
        good = part["long"].isNotNull() & (part["counted"] >= rule.min_length)
        return F.struct(end.alias("place"), F.when(good, F.array_append(sofar["spans"], one)).otherwise(sofar["spans"]).alias("spans")).cast(state)

    start = F.struct(F.lit(0).cast("bigint").alias("place"), F.array().cast(SPANS).alias("spans")).cast(state)
    return F.when(text.rlike(rule.pattern), F.aggregate(parts, start, add)["spans"]).otherwise(F.array().cast(SPANS))


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Each row of ``docs`` as struct ``row``, with ``spans``: (start, order, end, kind) of all matches by place.

    Each rule's Boolean trigram query is derived from its pattern. Postings of the demanded trigrams are
    intersected into candidates (doc_id, kinds), which are staged and joined back; by the size of their files Spark
    broadcasts them, so that no text is shuffled, or sorts both sides. A rule's pattern only runs on its candidates. Rules without mandatory trigrams run on every text. Matches are leftmost and do not overlap within
    a kind; matches that are too short are dropped without another try.

    A null text has no spans. Null ids match null ids, and rows that repeat an id share their candidates, which are
    verified on each row's own text. Other columns, whatever their names, stay in ``row``.
    """
    found = staged(candidates(trigram_index(docs, indexed_trigrams(rules), text, doc_id), rules).withColumnRenamed("doc_id", "found_id"))
    rows = docs.select(F.struct("*").alias("row"))
    joined = rows.join(found, F.col(f"row.{doc_id}").eqNullSafe(F.col("found_id")), "left")
    body = F.coalesce(F.col(f"row.{text}"), F.lit(""))
    every = []
    for order, rule in enumerate(rules):
        spans = matches(body, rule, order)
        chosen = F.coalesce(F.array_contains("kinds", rule.kind), F.lit(False))
        every.append(spans if rule.query == ANY else F.when(chosen, spans).otherwise(F.array().cast(SPANS)))
    return joined.select("row", F.sort_array(F.flatten(F.array(*every))).alias("spans"))
