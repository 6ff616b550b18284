"""Feeds and site maps, from fetched XML: one row for each entry."""

from __future__ import annotations

import gzip
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, urls
from ..functions.text import strip

#: Where sites usually have their feeds.
COMMON_PATHS = ("/feed", "/rss", "/atom", "/feed.xml", "/rss.xml", "/atom.xml", "/feed/", "/rss/", "/atom/")
ENTRY = "struct<pos: int, title: string, url: string, description: string, published: string, updated: string, created: string>"
FEED = f"struct<valid: boolean, reason: string, entries: array<{ENTRY}>>"
DATE_FIELDS = {"published": ("pubDate", "published", "date", "issued"), "updated": ("updated", "modified"), "created": ("created",)}


def feed_urls(page: str, explicit: str | None = None, discovered: tuple[str, ...] = ()) -> list[str]:
    """Addresses to try, in order: an explicit one alone comes first; links that
    the page declares come after the page itself."""
    root = "/".join(page.split("/")[:3])
    tries = [explicit] if explicit else []
    tries += [page, *([] if explicit else discovered), *(root + p for p in COMMON_PATHS)]
    return list(dict.fromkeys(tries))


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def parse_feed(body: bytes | None) -> dict:
    """Entries of an RSS or Atom document; why not, if it is none."""
    try:
        root = ElementTree.fromstring(body or b"")
    except ElementTree.ParseError as e:
        return {"valid": False, "reason": f"not well-formed: {e}", "entries": []}
    out = []
    for x in root.iter():
        if _local(x.tag) not in ("item", "entry"):
            continue
        text: dict[str, str] = {}
        for c in x:
            name = _local(c.tag)
            value = "".join(c.itertext()).strip()
            if name == "link" and not value and c.get("rel", "alternate") == "alternate":
                value = c.get("href", "")
            if value:
                text.setdefault(name, value)
        row = {"pos": len(out), "title": text.get("title", ""), "url": text.get("link") or text.get("guid") or "", "description": text.get("description") or text.get("summary") or text.get("content") or ""}
        out.append(row | {k: next((text[n] for n in names if n in text), None) for k, names in DATE_FIELDS.items()})
    return {"valid": bool(out), "reason": None if out else "no entries", "entries": out}


def _udf(parse, schema: str):
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    kind = to_arrow_type(_parse_datatype_string(schema))

    @F.arrow_udf(schema)
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([parse(x) for x in batch.to_pylist()], kind)

    return read


def _said(text: Column) -> Column:
    """RFC 822 times with their offsets, else the usual forms."""
    rfc = F.regexp_extract(text, r"(\d{1,2} [A-Z][a-z]{2} \d{4} \d{2}:\d{2}:\d{2} (?:[+-]\d{4}))", 1)
    return F.coalesce(F.try_to_timestamp(F.when(rfc != "", rfc), F.lit("d MMM yyyy HH:mm:ss Z")), dates.discovered(text))


def first_valid(feeds: DataFrame) -> DataFrame:
    """``feeds``: source_url, feed_ord, http_status, xml as binary.  For each
    source the first feed in order that was fetched and has entries: feed."""
    parsed = feeds.where("http_status = 200").withColumn("feed", _udf(parse_feed, FEED)(F.col("xml")))
    return parsed.where("feed.valid").groupBy("source_url").agg(F.min_by("feed", "feed_ord").alias("feed"))


def feed_entries(feeds: DataFrame, mode: str = "both", least_title: int = 8) -> DataFrame:
    """source_url, pos, title, url, description, published of the entries that
    have a link and a title.  ``mode``: where dates come from, the feed's
    fields, the URL, or the URL where the fields have none; ``each`` gives own and
    by_url instead of published.  Entries are dealt to all tasks once they are rows,
    so those of one large feed are not judged by the task that read it."""
    rows = first_valid(feeds).select("source_url", F.explode("feed.entries").alias("e")).select("source_url", "e.*").repartition("source_url", "pos")
    own = F.coalesce(*[_said(F.col(c)) for c in ("published", "updated", "created")])
    by_url = urls.dated(F.col("url")).cast("timestamp")
    when = {"feed_fields": [own.alias("published")], "url_pattern": [by_url.alias("published")], "both": [F.coalesce(own, by_url).alias("published")], "each": [own.alias("own"), by_url.alias("by_url")]}[mode]
    kept = rows.where((F.col("url") != "") & (F.length(strip(F.col("title"))) >= least_title))
    return kept.select("source_url", "pos", "title", "url", "description", *when)


def parse_sitemap(body: bytes | None) -> list[dict]:
    """(loc, lastmod) of a site map or index, plain or gzipped."""
    body = body or b""
    try:
        root = ElementTree.fromstring(gzip.decompress(body) if body[:2] == b"\x1f\x8b" else body)
    except (ElementTree.ParseError, OSError, EOFError):
        return []
    out = []
    for x in root:
        if _local(x.tag) in ("url", "sitemap"):
            text = {_local(c.tag): (c.text or "").strip() for c in x}
            if text.get("loc"):
                out.append({"pos": len(out), "loc": text["loc"], "lastmod": text.get("lastmod"), "kind": _local(x.tag)})
    return out


def sitemap_urls(maps: DataFrame) -> DataFrame:
    """``maps``: source_url, map_url, xml as binary, nested maps' rows included.
    Rows source_url, pos, title (empty), url, published by the URL's date."""
    read = _udf(parse_sitemap, "array<struct<pos: int, loc: string, lastmod: string, kind: string>>")
    rows = maps.select("source_url", F.explode(read(F.col("xml"))).alias("e")).where("e.kind = 'url'")
    return rows.select("source_url", "e.pos", F.lit("").alias("title"), F.col("e.loc").alias("url"), F.coalesce(urls.dated(F.col("e.loc")), urls.generic_date(F.col("e.loc"))).cast("timestamp").alias("published"))
