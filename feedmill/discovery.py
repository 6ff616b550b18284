"""Discovery of all sources in one pass: sources are rows, with their rules, dates and
ways as columns, which pages, feed entries and site maps meet by a join.  The plan
has one scan of each input table however many sources there are.
"""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .config import Config, Source
from .functions import urls
from .functions.dates import parse_iso
from .functions.page import with_page
from .operators import candidates, freshness
from .operators.lookup import keywords_of, small
from .sources.feeds import feed_entries, sitemap_urls

RULES = "array<struct<rule: string, pattern: boolean>>"
SOURCES = f"source_url string, source_ord int, method string, inline boolean, ways array<string>, include {RULES}, exclude {RULES}, words array<string>, feed_dates string, url_dates array<string>, categories array<string>, reader string"
#: A pattern that matches nothing, in the place of one that doesn't compile.
NEVER = "(?!)"


def scan_variants(source: Source) -> tuple[str, ...]:
    """Ways to read a source's page, in order; actions need a browser."""
    if source.discovery_method in ("browser", "playwright"):
        return ("browser",)
    if source.discovery_method == "auto":
        return ("browser",) if source.browser_actions else ("static", "browser")
    return ("static",)


def source_rows(spark: SparkSession, cfg: Config, sources: tuple[Source, ...] | None = None) -> DataFrame:
    """The sources of a configuration as rows, in its order."""

    def rules(patterns: tuple[str, ...]) -> list[tuple[str, bool]]:
        return [(p, False) if not p.startswith("re:") else (p[3:] if urls.usable_pattern(p[3:]) else NEVER, True) for p in patterns]

    def row(ord_: int, s: Source) -> tuple:
        words = keywords_of(list(s.categories), cfg.keywords) if s.discovery_method == "rss" and cfg.keyword_filter_enabled else None
        reader = json.dumps([s.date_selectors, s.date_patterns]) if s.date_selectors or s.date_patterns else None
        dates = [p for p in s.date_patterns if urls.usable_pattern(p)]
        return s.url, ord_, s.discovery_method, s.listings_type == "inline", list(scan_variants(s)), rules(s.include), rules(s.exclude), [w.lower() for w in words] if words else None, s.rss_date_extraction, dates, list(s.categories), reader

    return spark.createDataFrame([row(i, s) for i, s in enumerate(cfg.web_sources if sources is None else sources)], SOURCES)


def passes(url: Column, include: Column, exclude: Column) -> Column:
    """``urls.passes_rules`` with the rules in columns."""
    hit = lambda r: F.when(r["pattern"], F.regexp_like(url, r["rule"])).otherwise(F.contains(url, r["rule"]))
    return ((F.size(include) == 0) | F.exists(include, hit)) & ~F.exists(exclude, hit)


def own_date(url: Column, patterns: Column) -> Column:
    """``urls.configured_date`` with the patterns in a column."""
    found = F.transform(patterns, lambda p: F.try_to_date(F.regexp_replace(F.call_function("regexp_extract", url, p, F.lit(1)), "/", "-"), "yyyy-MM-dd"))
    return F.get(F.array_compact(found), 0)


def is_old(date: Column, as_of: Column, days: int) -> Column:
    return F.coalesce(date < as_of - F.make_dt_interval(F.lit(days)), F.lit(False))


FOUND = ["source_ord", "url", "title", "published", "pos"]


def feed_rows(feeds: DataFrame, sources: DataFrame, as_of: Column, days: int) -> DataFrame:
    """Entries up to each source's first old one, with ``ok`` (by the source's
    rules) and ``old``, by which a feed ends the search."""
    c = F.col
    mine = small(sources.where(c("method").isin("rss", "auto")).select("source_url", "source_ord", "include", "exclude", "words", "feed_dates"))
    rows = feed_entries(feeds, "each").join(mine, "source_url")
    said = F.lower(F.concat_ws(" ", "title", "description"))
    rows = rows.where(c("words").isNull() | F.exists("words", lambda w: F.contains(said, w)))
    rows = rows.withColumn("published", F.when(c("feed_dates") == "feed_fields", c("own")).when(c("feed_dates") == "url_pattern", c("by_url")).otherwise(F.coalesce("own", "by_url")))
    rows = rows.withColumn("old", is_old(c("published"), as_of, days)).withColumn("ok", passes(c("url"), c("include"), c("exclude")))
    # Entries after an old one count only as old or not.
    seen = F.max(c("old").cast("int")).over(Window.partitionBy("source_ord").orderBy("pos"))
    return rows.withColumn("ok", c("ok") & (seen == 0)).select(*FOUND, "ok", "old")


def page_rows(pages: DataFrame, sources: DataFrame, as_of: datetime, days: int) -> DataFrame:
    """Links of the sources' pages: filters by the ways of each source, early stop,
    one row for each URL, then its rules.  A page is read once for all its ways;
    the second counts only where the first has no link left and was not stopped by
    age."""
    c, at = F.col, as_column(as_of)
    mine = small(sources.where(c("method").isin("static", "browser", "playwright", "auto")))
    wanted = pages.join(mine.select(c("source_url").alias("url"), "source_ord", "reader"), "url")
    read = with_page(wanted, as_of, options=c("reader"), parts=("links",))
    rows = read.select("source_ord", F.explode("page.links").alias("l")).select("source_ord", "l.pos", "l.text", "l.url", parse_iso(c("l.date")).alias("date"))
    rows = rows.join(mine.select("source_ord", "source_url", "ways", "include", "exclude"), "source_ord")
    way = lambda v: F.when(F.array_contains("ways", v) & urls.link_ok(c("url"), c("text"), c("source_url"), v), F.array_position("ways", v).cast("int") - 1)
    rows = rows.withColumn("way", F.explode(F.array_compact(F.array(way("static"), way("browser")))))
    old = c("date") < at - F.make_dt_interval(F.lit(days))
    rows = candidates.take_until_old(rows, ["source_ord", "way"], "pos", old, inclusive=True)
    rows = rows.withColumn("ok", passes(c("url"), c("include"), c("exclude")))
    closed = F.coalesce(F.max(F.when((c("way") == 0) & (c("ok") | old), 1)).over(Window.partitionBy("source_ord")), F.lit(0))
    rows = rows.withColumn("closed", closed).where(c("ok") & ((c("way") == 0) | (c("closed") == 0)))
    dated = rows.withColumn("date", F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss"))
    return candidates.upsert(dated, ["source_ord", "url"], title="text").select("source_ord", "url", c("text").alias("title"), F.try_to_timestamp("date").alias("published"), "pos")


def map_rows(maps: DataFrame, sources: DataFrame, as_of: Column, days: int) -> DataFrame:
    c = F.col
    mine = small(sources.where("method = 'sitemap'").select("source_url", "source_ord", "include", "exclude"))
    rows = sitemap_urls(maps).join(mine, "source_url")
    return rows.where(~is_old(c("published"), as_of, days) & passes(c("url"), c("include"), c("exclude"))).select(FOUND)


def as_column(as_of: datetime) -> Column:
    return F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")


def scan_sources(spark: SparkSession, sources: DataFrame, inputs, as_of: datetime, days: int) -> DataFrame:
    """source_ord, url, title, published, pos of all sources by their methods;
    ``auto`` takes the feed's, if any are left, else the page's.  A feed that was
    stopped by age ends the search, even if nothing is left of it."""
    at = as_column(as_of)
    rows = spark.createDataFrame([], "source_ord int, url string, title string, published timestamp, pos int")
    entries = feed_rows(inputs.feeds, sources, at, days) if inputs.feeds is not None else None
    if entries is not None:
        rows = rows.unionByName(entries.where("ok").select(FOUND))
    if inputs.sitemaps is not None:
        rows = rows.unionByName(map_rows(inputs.sitemaps, sources, at, days))
    if inputs.listing_pages is not None:
        found = page_rows(inputs.listing_pages, sources, as_of, days)
        if entries is not None:
            found = found.join(entries.where("ok or old").select("source_ord").distinct(), "source_ord", "left_anti")
        rows = rows.unionByName(found)
    return rows


def discover_sources(spark: SparkSession, sources: DataFrame, inputs, as_of: datetime, days: int) -> DataFrame:
    """source_url, url, title, published, pos, categories of all sources' candidates:
    no links to a source itself, none that is too old by its page or its URL; an
    inline source's own page is one."""
    c, at = F.col, as_column(as_of)
    about = small(sources.select("source_ord", "source_url", "method", "inline", "url_dates", "categories"))
    rows = scan_sources(spark, sources, inputs, as_of, days).join(about, "source_ord")
    rows = rows.where((c("method") == "rss") | ~urls.is_hub_link(c("url"), c("source_url"), c("inline")))
    rows = freshness.discovery_filter(rows, c("published"), at, days)
    rows = freshness.url_date_fallback(rows, "published", own_date(c("url"), c("url_dates")), urls.generic_date(c("url")), at, days)
    out = ["source_url", "url", "title", "published", "pos", "categories"]
    own = sources.where("inline").select("source_url", c("source_url").alias("url"), c("source_url").alias("title"), at.alias("published"), F.lit(0).alias("pos"), "categories")
    return rows.select(out).unionByName(own)
