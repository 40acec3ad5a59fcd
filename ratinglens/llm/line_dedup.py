"""Operator 3: boilerplate lines, found by how many of a host's pages contain them."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality_rules import WORD
from .staging import staged


# Share of a host's pages from which a line is boilerplate. On sf0.1 the (host, line) pairs on 5 or more of about 500
# pages fill the shares from 1 to 4.6 % without a gap, and the main line has 8.7 to 13.2 %, so that a limit of 10 % would
# go through the latter. 2 % drops it on all hosts, and 167 of the 396 pairs.
SHARE = 0.02


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def boilerplate_lines(docs: DataFrame, ratio: float, min_pages: int, text: str = "text", host: str = "source") -> DataFrame:
    """(host, line_key, n_pages, host_pages): lines on more than ``ratio`` of a host's pages and at least ``min_pages``.

    Pages with one text count once, so that a group of copies does not make its own lines boilerplate. Both counts
    are distinct counts by (host, line, page), combined before the shuffle; no host or line is gathered anywhere.
    """
    pages = docs.select(F.col(host).alias("host"), F.md5(text).alias("page"), F.col(text).alias("text")).where("text is not null")
    totals = pages.groupBy("host").agg(F.countDistinct("page").alias("host_pages"))
    lines = pages.select("host", "page", F.explode(F.array_distinct(F.transform(
        F.filter(_lines(F.col("text")), lambda line: line.rlike(WORD)), lambda line: F.md5(line)))).alias("line_key"))
    counts = lines.groupBy("host", "line_key").agg(F.countDistinct("page").alias("n_pages")).where(F.col("n_pages") >= min_pages)
    return counts.join(totals.withColumnRenamed("host", "of_host"), F.col("host").eqNullSafe(F.col("of_host"))).where(
        F.col("n_pages") > F.col("host_pages") * ratio).select("host", "line_key", "n_pages", "host_pages")


def line_dedup(docs: DataFrame, ratio: float = SHARE, min_pages: int = 5, text: str = "text", host: str = "source") -> DataFrame:
    """Each row of ``docs`` as struct ``row``, with ``clean_text``, n_lines and n_dropped.

    Lines on more than ``ratio`` of the pages of their host are dropped. A page that holds nothing else stays as it
    is, since dropping it is not this operator's task. A host has at most (mean lines a page / ratio) such lines;
    they are put in one row a host and joined to its pages, so a large host's pages can be split over tasks.

    The limit is a share of the host's own pages, so a line that stands on few pages of each of many hosts stays, as
    does one on fewer than ``min_pages``. A page's keys are first reduced to those that are dropped on its host, with
    a hash set, so that a long list costs a page no more than its length and the page's lines.

    Lines without a word are never counted or dropped. Null texts stay null and count for nothing; null hosts are
    one host; repeated rows count as one page. Other columns, whatever their names, stay in ``row``.
    """
    found = staged(boilerplate_lines(docs, ratio, min_pages, text, host))
    lists = staged(found.groupBy(F.col("host").alias("of_host")).agg(F.collect_list("line_key").alias("dropped")))
    rows = docs.select(F.struct("*").alias("row"))
    joined = rows.join(lists, F.col(f"row.{host}").eqNullSafe(F.col("of_host")), "left")
    stays = lambda line: ~line.rlike(WORD) | ~F.array_contains("hits", F.md5(line))
    lines = joined.select("row", "dropped", _lines(F.col(f"row.{text}")).alias("lines"))
    met = lines.select("row", "lines", F.array_intersect(F.transform("lines", lambda line: F.md5(line)), "dropped").alias("hits"))
    left = met.select("row", "lines", F.when(F.size("hits") > 0, F.filter("lines", stays)).otherwise(F.col("lines")).alias("left"))
    whole = ~F.exists("left", lambda line: line.rlike(WORD))
    return left.select(
        "row",
        F.when(whole, F.col(f"row.{text}")).otherwise(F.array_join("left", "\n")).alias("clean_text"),
        F.coalesce(F.size("lines"), F.lit(0)).cast("bigint").alias("n_lines"),
        F.when(whole | F.col("lines").isNull(), 0).otherwise(F.size("lines") - F.size("left")).cast("bigint").alias("n_dropped"))
