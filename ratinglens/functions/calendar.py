"""Review time, the recent window and calendar period keys."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed_values import DATE_TEXT_FORMAT, RECENT_DAYS


def review_time(reviews: DataFrame) -> Column:
    """Wall-clock time of a review; a date text that cannot be read gives null.

    Ingested reviews carry ``reviewed_at`` (parsed once, so filters on it reach the file scan); for other
    frames ``date`` is used, whatever its type.
    """
    if "reviewed_at" in reviews.columns:
        return F.col("reviewed_at")
    if isinstance(reviews.schema["date"].dataType, T.StringType):
        return F.col("date").try_cast("timestamp_ntz")
    return F.col("date").cast("timestamp_ntz")


def first_and_last_date(reviews: DataFrame) -> tuple[Column, Column]:
    """(min, max) aggregates of the review date, as text.

    With ``reviewed_at`` the extremes are taken on the fixed-width time, which keeps the aggregation hash
    based; extremes of a text column would force Spark to sort its input.
    """
    if "reviewed_at" in reviews.columns:
        return (F.date_format(F.min("reviewed_at"), DATE_TEXT_FORMAT),
                F.date_format(F.max("reviewed_at"), DATE_TEXT_FORMAT))
    return F.min("date"), F.max("date")


def as_of_date(asof=None) -> Column:
    return F.current_date() if asof is None else F.lit(str(asof)).cast("date")


def is_recent(time: Column, asof=None) -> Column:
    """True from 90 days before the as-of date on; there is no upper bound."""
    return time >= F.date_sub(as_of_date(asof), RECENT_DAYS).cast("timestamp_ntz")


def period_key(day: Column, period_type: str) -> Column:
    """``yyyy-MM``, ``yyyy-Qn`` or ``yyyy``; any other period type falls back to the month."""
    if period_type == "quarter":
        return F.concat(F.year(day).cast("string"), F.lit("-Q"), F.quarter(day).cast("string"))
    if period_type == "year":
        return F.year(day).cast("string")
    return F.date_format(day, "yyyy-MM")
