"""Candidates of a scan: filters in order, early stops, and one row per URL.

Rows have an explicit position ``pos`` within their source; every
order-dependent step states its order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def take_until_old(df: DataFrame, group: list[str], pos: str, is_old: Column, inclusive: bool) -> DataFrame:
    """Rows of each group up to the first old one; ``inclusive`` keeps that one
    too.  Rows that earlier filters dropped cannot stop a scan, so filter
    first.  Groups are single sources or pages."""
    order = Window.partitionBy(*group).orderBy(pos)
    frame = order.rowsBetween(Window.unboundedPreceding, -1 if inclusive else 0)
    old = F.coalesce(is_old, F.lit(False)).cast("int")
    return df.withColumn("_fm_old", F.coalesce(F.max(old).over(frame), F.lit(0))).where("_fm_old = 0").drop("_fm_old")


def upsert(df: DataFrame, keys: list[str], pos: str = "pos", title: str = "title", date: str = "date") -> DataFrame:
    """One row for each URL: the longest title (the first of the longest; an
    empty title never replaces one), the first known date, the first position.
    The sums are partial, so copies fold before the shuffle."""
    size = F.length(F.coalesce(F.col(title), F.lit("")))
    return df.groupBy(*keys).agg(
        F.max_by(title, F.struct(size, -F.col(pos))).alias(title),
        F.min_by(F.col(date), F.when(F.col(date).isNotNull() & (F.col(date) != "unknown"), F.col(pos))).alias(date),
        F.min(pos).alias(pos),
    )


def by_host(df: DataFrame, host: Column) -> DataFrame:
    """Candidates for each host, most first."""
    return df.groupBy(host.alias("host")).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "host")


def dated_share(df: DataFrame, date: Column) -> DataFrame:
    """Whole percent of rows with a date."""
    return df.agg(F.expr("count(*)").alias("n"), F.count(date).alias("dated")).withColumn("percent", F.when(F.col("n") > 0, F.expr("dated * 100 div n")))


def dated_by_source(df: DataFrame, source: str, date: Column) -> DataFrame:
    """Of each source's candidates the number and the share with a date."""
    return df.groupBy(source).agg(F.count("*").alias("n"), F.avg(date.isNotNull().cast("int")).alias("share"))
