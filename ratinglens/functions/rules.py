"""Label rules and rounding helpers."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as V


def first_match(rules: list[tuple[Column, str]], otherwise: str) -> Column:
    """Label of the first rule that holds."""
    (condition, label), *rest = rules
    chain = reduce(lambda when, rule: when.when(rule[0], F.lit(rule[1])), rest, F.when(condition, F.lit(label)))
    return chain.otherwise(F.lit(otherwise))


def tier(value: Column, tiers: list[tuple[int, str]], otherwise: str) -> Column:
    """Label of the first lower bound that ``value`` reaches."""
    return first_match([(value >= bound, label) for bound, label in tiers], otherwise)


def trend_label(change: Column) -> Column:
    """Up or down only beyond the step itself; exactly the step, or no value, is flat."""
    return first_match([(change > V.TREND_STEP, V.TREND_UP), (change < -V.TREND_STEP, V.TREND_DOWN)], V.TREND_FLAT)


def label_text(*flags: tuple[Column, str]) -> Column:
    """Labels as one text. Absent ones leave their (empty) place between the separators and a single
    separator is trimmed at either end, so the first label alone reads ``"A, "``; readers of the stored
    tables rely on that layout."""
    slots = [F.when(condition, F.lit(label)).otherwise(F.lit("")) for condition, label in flags]
    return F.regexp_replace(F.concat_ws(V.LABEL_SEPARATOR, *slots), V.LABEL_TRIM_PATTERN, "")


def label_list(text: Column) -> Column:
    """Labels of a ``label_text`` as a clean array."""
    parts = F.transform(F.split(text, ","), lambda part: F.trim(part))
    return F.coalesce(F.filter(parts, lambda part: part != ""), F.array().cast("array<string>"))


def percent(part: Column, whole: Column, digits: int) -> Column:
    return F.round(part.cast("double") / whole * 100, digits)


def stddev_of_sums(n: Column, total: Column, squares: Column) -> Column:
    """Sample standard deviation from count, sum and sum of squares; null for fewer than two values."""
    spread = F.greatest(n * squares - total * total, F.lit(0.0))
    return F.when(n > 1, F.sqrt(spread / (n * (n - 1))))


def sample_stddev(value: Column) -> Column:
    """Sample standard deviation from exact sums.

    Ratings come in halves, so count, sum and sum of squares are exact and the result does not depend on how
    rows are spread over partitions. Null for fewer than two values.
    """
    return stddev_of_sums(F.count(value), F.sum(value), F.sum(value * value))
