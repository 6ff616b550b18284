"""Listing pages: children of a page as items of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip


def child_key(page: Column, title: Column, date: Column) -> Column:
    mark = F.substring(F.sha2(F.concat(strip(title), F.lit("|"), date), 256), 1, 12)
    return F.concat(F.lit("listings:"), page, F.lit("#"), mark)


def is_valid(title: Column, date: Column, content: Column) -> Column:
    """Title of 5 to 500 characters, a date, and content that is empty or of at
    least 10 characters."""
    text = F.coalesce(content, F.lit(""))
    ok = F.length(strip(title)).between(5, 500) & (F.coalesce(date, F.lit("")) != "") & ((text == "") | (F.length(text) >= 10))
    return F.coalesce(ok, F.lit(False))


def explode_children(pages: DataFrame, page: str, articles: str) -> DataFrame:
    """A row for each article of a page: pos, title, date, content, url (the
    page's, if it has none), source_key and id."""
    rows = pages.select(F.col(page).alias("page_url"), F.posexplode(articles).alias("pos", "a"))
    out = rows.select("page_url", "pos", F.col("a.title").alias("title"), F.col("a.date").alias("date"), F.col("a.content").alias("content"), F.coalesce(F.when(F.col("a.url") != "", F.col("a.url")), F.col("page_url")).alias("url"))
    out = out.withColumn("source_key", child_key(F.col("page_url"), F.col("title"), F.col("date")))
    return out.withColumn("id", F.concat("source_key", F.lit("-extracted"))).withColumn("extraction_method", F.lit("listings_article"))


def parent_rollup(children: DataFrame, parent: str, passed: Column, reason: Column, pos: str = "pos") -> DataFrame:
    """Parents that had children of which none passed, with the first child's
    reason."""
    sums = children.groupBy(parent).agg(F.count_if(passed).alias("n_passed"), F.count("*").alias("n_children"), F.min_by(reason, F.when(~passed, F.col(pos))).alias("reason"))
    return sums.where("n_passed = 0").select(parent, "n_children", "reason")


def newest_first(df: DataFrame, date: str = "date", pos: str = "pos") -> DataFrame:
    return df.orderBy(F.col(date).desc(), pos)
