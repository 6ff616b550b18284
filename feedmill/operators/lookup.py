"""Lookups of sources, categories and schemas.  The dimension tables come from
the configuration; they are broadcast only up to a checked number of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import substrings

#: Rows up to which a dimension is broadcast; larger ones are left to the planner.
BROADCAST_ROWS = 100_000
#: Sources that are tested one by one against each URL.
FEW = 64


def small(dim: DataFrame) -> DataFrame:
    """``dim``, broadcast if it is small enough."""
    return F.broadcast(dim) if dim.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else dim


def page_of(key: Column) -> Column:
    """URL that a source key stands for; null for other kinds of keys."""
    web, child = F.regexp_extract(key, r"^web:(.*)$", 1), F.regexp_extract(key, r"^listings:([^#]*)", 1)
    return F.when(key.startswith("web:"), web).when(key.startswith("listings:"), child)


def source_by_url(items: DataFrame, sources: DataFrame, url: Column, contains: bool = False) -> DataFrame:
    """Adds ``source_url``, the source of each item, null if none.

    ``sources``: source_url, source_ord.  An exact match wins, closing slashes
    aside, of equal ones the last; else the first source in order whose URL the
    item's starts with, with ``contains`` also one that holds it.  Up to FEW sources
    are tested one by one; more are met by equality of beginnings, or by the parts
    that they hold, once for each distinct URL.
    """
    bare = lambda c: F.regexp_replace(c, "/+$", "")
    exact = sources.groupBy(bare(F.col("source_url")).alias("_fm_bare")).agg(F.max_by("source_url", "source_ord").alias("_fm_exact"))
    keyed = items.withColumn("_fm_url", url).withColumn("_fm_bare", bare(F.col("_fm_url")))
    keyed = keyed.join(small(exact), "_fm_bare", "left").drop("_fm_bare")
    if sources.limit(FEW + 1).count() <= FEW:
        ordered = F.array_sort(F.collect_list(F.struct("source_ord", "source_url")))
        every = sources.agg(ordered.alias("_fm_all"))  # one row of FEW sources at most
        hit = lambda s: F.col("_fm_url").startswith(s["source_url"]) | (F.contains(F.col("_fm_url"), s["source_url"]) if contains else F.lit(False))
        first = F.get(F.filter(F.col("_fm_all"), hit), 0)["source_url"]
        return keyed.join(F.broadcast(every)).withColumn("source_url", F.coalesce("_fm_exact", first)).drop("_fm_url", "_fm_exact", "_fm_all")
    first = sources.where("source_url is not null").groupBy(F.col("source_url").alias("word")).agg(F.min("source_ord").alias("source_ord"))
    left = keyed.where("_fm_exact is null").select("_fm_url")
    if contains:
        pairs = substrings.containing(left.where("_fm_url is not null").distinct(), first, "_fm_url", "_fm_url")
    else:
        pairs = substrings.prefixed(left, first, "_fm_url")
    best = pairs.join(small(first), "word").groupBy("_fm_url").agg(F.min_by("word", F.struct("source_ord", "word")).alias("_fm_first"))
    return keyed.join(best, "_fm_url", "left").withColumn("source_url", F.coalesce("_fm_exact", "_fm_first")).drop("_fm_url", "_fm_exact", "_fm_first")


def first_schema(categories: Column, schemas: dict[str, str]) -> Column:
    """Schema of the first category, in the item's order, that has one."""
    if not schemas:
        return F.lit(None).cast("string")
    known = F.create_map(*[F.lit(x) for kv in schemas.items() for x in kv])
    return F.get(F.filter(F.transform(categories, lambda c: F.element_at(known, c)), lambda s: s.isNotNull()), 0)


def keywords_of(categories: list[str], dimension: dict[str, list[str]]) -> list[str] | None:
    """Keywords of a source's categories, in the configuration's order."""
    out = [k for name, ks in dimension.items() if name in categories for k in ks]
    return out or None


def category_rows(items: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """One row for each item and known category, with its keywords, in order."""
    rows = items.select(key, F.posexplode("categories").alias("category_pos", "category"))
    return rows.join(small(dimension), "category")
