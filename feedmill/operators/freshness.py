"""Age rules.  ``as_of`` is always given; an item exactly as old as allowed is
kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_fresh(published: Column, as_of: Column, max_age_days: int) -> Column:
    return published >= as_of - F.make_dt_interval(F.lit(max_age_days))


def discovery_filter(df: DataFrame, published: Column, as_of: Column, max_age_days: int) -> DataFrame:
    """Drops what is too old; undated rows stay."""
    return df.where(published.isNull() | is_fresh(published, as_of, max_age_days))


def url_date_fallback(df: DataFrame, published: str, configured: Column, generic: Column, as_of: Column, max_age_days: int) -> DataFrame:
    """Dates undated rows by their URLs: a configured date that is too old counts
    for nothing, a generic one that is too old drops the row."""
    own = F.when(is_fresh(configured.cast("timestamp"), as_of, max_age_days), configured.cast("timestamp"))
    general = generic.cast("timestamp")
    undated = F.col(published).isNull()
    out = df.withColumn("_fm_own", own).withColumn("_fm_general", general)
    stale = undated & F.col("_fm_own").isNull() & F.col("_fm_general").isNotNull() & ~is_fresh(F.col("_fm_general"), as_of, max_age_days)
    return out.where(~F.coalesce(stale, F.lit(False))).withColumn(published, F.coalesce(F.col(published), F.col("_fm_own"), F.col("_fm_general"))).drop("_fm_own", "_fm_general")


def guardrail(df: DataFrame, published: Column, url_date: Column, as_of: Column, max_age_days: int) -> DataFrame:
    """Adds ``fresh_at`` and ``verdict``: fresh, stale or undated.  Only fresh
    rows go on, newest first."""
    at = F.coalesce(published, url_date.cast("timestamp"))
    verdict = F.when(at.isNull(), "undated").when(is_fresh(at, as_of, max_age_days), "fresh").otherwise("stale")
    return df.withColumn("fresh_at", at).withColumn("verdict", verdict)


def after_fetch(df: DataFrame, known: Column, listing: Column, found: Column, as_of: Column, max_age_days: int) -> DataFrame:
    """The rule after extraction: only for items whose date wasn't known and that
    aren't listings; ones that stay undated pass."""
    return df.where(known | listing | found.isNull() | is_fresh(found, as_of, max_age_days))
