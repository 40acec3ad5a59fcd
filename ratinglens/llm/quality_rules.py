"""Operator 10: rules on single texts, and verdicts on hosts whose documents fail them too often."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import staged

WHITE_SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\f\r"
_PLACE_BITS = 26
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


@dataclass(frozen=True)
class Limits:
    """A document may have at most these shares, in percent; the strict ones hold on poor hosts."""
    min_words: int = 50
    repeat_words: int = 50
    symbols: int = 20
    dup_lines: int = 30
    strict_symbols: int = 5
    strict_dup_lines: int = 10
    poor_host: float = 0.5          # shrunk rate of failing documents from which a host is poor
    rejected_host: float = 0.9      # ... and from which all its documents go


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def word_list(text: Column) -> Column:
    return F.array_remove(F.split(text, WHITE_SPACE), "")


def repeated_words(words: Column) -> Column:
    """Words that stand in a window of three words found twice or more in the text.

    Windows are sorted by a hash with their place in the low bits, and neighbours with one hash are compared by their
    words. Should two different windows of a text share a hash, or a text have more words than the place has bits for,
    its windows are sorted by their words instead.
    """
    mask = F.lit((1 << _PLACE_BITS) - 1).cast("bigint")
    place = lambda v: v.bitwiseAND(mask).cast("int")
    hashed = lambda v: F.shiftright(v, _PLACE_BITS)
    three = lambda w, i: (F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    places = lambda w: F.sequence(F.lit(0), F.size(w) - 3)
    sure = lambda condition: F.coalesce(condition, F.lit(False))

    def same_words(w, i, j):
        x, y, z = (a == b for a, b in zip(three(w, i), three(w, j), strict=True))
        return x & y & z

    def covered(found):
        return F.size(F.array_distinct(F.flatten(F.transform(found, lambda i: F.array(i, i + 1, i + 2)))))

    def by_hash(w, p):
        equal = lambda a, b: sure((hashed(a) == hashed(b)) & same_words(w, place(a), place(b)))
        again = F.filter(p, lambda v, i: equal(v, F.get(p, i - 1)) | equal(v, F.get(p, i + 1)))
        return covered(F.transform(again, place))

    def by_words(w):
        equal = lambda a, b: sure(same_words(w, a["place"], b["place"]))
        rows = F.sort_array(F.transform(places(w), lambda i: F.struct(F.array(*three(w, i)).alias("words"), i.alias("place"))))
        return _let(rows, lambda r: covered(F.transform(
            F.filter(r, lambda v, i: equal(v, F.get(r, i - 1)) | equal(v, F.get(r, i + 1))), lambda v: v["place"])))

    def count(w):
        packed = F.sort_array(F.transform(
            places(w), lambda i: F.shiftleft(F.xxhash64(*three(w, i)), _PLACE_BITS).bitwiseOR(i.cast("bigint"))))
        clash = lambda a, b: sure((hashed(a) == hashed(b)) & ~same_words(w, place(a), place(b)))
        clashes = lambda p: F.size(F.filter(p, lambda v, i: clash(v, F.get(p, i + 1)))) > 0
        return _let(packed, lambda p: F.when((F.size(w) > 1 << _PLACE_BITS) | clashes(p), by_words(w)).otherwise(by_hash(w, p)))

    return F.when(F.size(words) >= 4, _let(words, count)).otherwise(0)


def measures(text: Column) -> dict[str, Column]:
    """The measures of a text as columns; a null text counts as empty."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    values = {
        "n_words": _let(word_list(text), lambda w: F.size(w)),
        "word_chars": F.length(F.translate(text, _SPACES, "")),
        "n_symbols": F.length(text) - F.length(F.translate(text, SYMBOLS, "")),
        "n_dup_lines": _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))),
        "n_repeat_words": _let(word_list(text), repeated_words),
        "n_lines": F.size(lines),
    }
    return {name: value.cast("bigint").alias(name) for name, value in values.items()}


def base_failed(limits: Limits) -> Column:
    return (F.col("n_words") < limits.min_words) | (100 * F.col("n_repeat_words") > limits.repeat_words * F.col("n_words"))


def _soft_failed(symbols: int, dup_lines: int) -> Column:
    return (100 * F.col("n_symbols") > symbols * F.col("n_words")) | (100 * F.col("n_dup_lines") > dup_lines * F.col("n_lines"))


def host_verdicts(measured: DataFrame, limits: Limits) -> DataFrame:
    """(host, n_docs, n_failed, rate, verdict): the rates are shrunk by a beta prior fitted to all hosts.

    The prior comes from the mean and the variance of the hosts' rates. Only that one row reaches the driver.
    """
    failed = base_failed(limits) | _soft_failed(limits.symbols, limits.dup_lines)
    hosts = staged(measured.groupBy("host").agg(
        F.count("*").alias("n_docs"), F.sum(failed.cast("bigint")).alias("n_failed")))
    rate = F.col("n_failed") / F.col("n_docs")
    mean, variance = hosts.agg(F.avg(rate), F.var_pop(rate)).first()
    mean = 0.5 if mean is None else mean
    strength = min(max(mean * (1 - mean) / variance - 1, 2.0), 1e6) if variance else 1e6
    shrunk = (F.col("n_failed") + mean * strength) / (F.col("n_docs") + strength)
    return hosts.withColumn("rate", shrunk).withColumn(
        "verdict", F.when(F.col("rate") >= limits.rejected_host, "rejected")
        .when(F.col("rate") >= limits.poor_host, "poor").otherwise("good"))


def kept(limits: Limits) -> Column:
    strict = (F.col("verdict") == "poor") & _soft_failed(limits.strict_symbols, limits.strict_dup_lines)
    return ~(base_failed(limits) | _soft_failed(limits.symbols, limits.dup_lines) | strict | (F.col("verdict") == "rejected"))


def _measured(rows: DataFrame, text: str, host: str) -> DataFrame:
    return rows.select("row", F.col(f"row.{host}").alias("host"), *measures(F.col(f"row.{text}")).values())


def _judged(measured: DataFrame, limits: Limits) -> DataFrame:
    """Measured rows with their host's rate and verdict; they are computed twice unless the caller has staged them."""
    hosts = staged(host_verdicts(measured.drop("row"), limits).select(F.col("host").alias("of_host"), "rate", "verdict"))
    return measured.join(hosts, measured["host"].eqNullSafe(hosts["of_host"]), "left")


def quality_rules(docs: DataFrame, limits: Limits = Limits(), text: str = "text", host: str = "source", carried=None) -> DataFrame:
    """Each row of ``docs`` as struct ``row``, with its measures, base_failed, host_rate, host_verdict and kept.

    A document fails if it has too few words, too many repeated ones, too many symbols or repeated lines. Failures
    are counted by host, each host's rate is shrunk towards the rate of all hosts, and the host's verdict is joined
    back: a good host changes nothing, documents of a poor host are held to the strict limits, a rejected host
    loses all its documents. Counting combines before the shuffle, and the verdicts have one row a host, so a host
    with a third of all rows is no burden; Spark broadcasts them where their files are small.

    The texts are measured once: rows and measures are staged before the hosts are counted. ``carried`` names the
    columns that ``row`` holds, all by default; a caller that does not need the texts leaves them out of the stage.

    Null texts count as empty and fail; null hosts are one host. Any other columns, whatever their names, stay in
    ``row``; repeated rows are judged each; an empty table gives an empty result.
    """
    measured = _measured(docs.select(F.struct("*").alias("row")), text, host)
    if carried is not None:
        measured = measured.withColumn("row", F.struct(*[F.col("row")[c].alias(c) for c in carried]))
    return _judged(staged(measured), limits).select(
        "row", *MEASURES, base_failed(limits).alias("base_failed"), F.col("rate").alias("host_rate"),
        F.col("verdict").alias("host_verdict"), kept(limits).alias("kept"))


def good_documents(docs: DataFrame, limits: Limits = Limits(), text: str = "text", host: str = "source") -> DataFrame:
    """The rows of ``docs`` that ``quality_rules`` keeps, with the columns of ``docs``.

    The texts are measured once for the counts of the hosts and once more for the rows that stay, as staging the rows
    with their texts in between takes almost as much disk as they have, and memory of the executors.
    """
    return _judged(_measured(docs.select(F.struct("*").alias("row")), text, host), limits).where(kept(limits)).select("row.*")
