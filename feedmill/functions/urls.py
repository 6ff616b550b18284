"""Column functions on URLs: filters, parts and dates."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip, usable_pattern

# Fixed values of the link filters.
PAGINATION = ("?page=", "&page=", "?offset=", "&offset=", "?start=", "&start=", "?p=", "&p=", "?page_num=", "&page_num=", "/page/", "/seite/")
MEDIA = ("jpg", "jpeg", "png", "gif", "pdf", "mp3", "mp4", "webp")
SKIP_PATHS = {
    "static": ("/category/", "/tag/", "/tags/", "/archive/", "/autor/", "/author/", "/search/", "/kontakt", "/impressum", "/datenschutz", "/privacy", "/login", "/register", "?page=", "?offset=", "/team/"),
    "browser": ("/category/", "/tag/", "/archive/", "/autor/", "/author/", "/search/", "/kontakt", "/impressum", "/datenschutz", "/login", "?page=", "?offset=", "/team/"),
    "email": ("/category/", "/tag/", "/tags/", "/archive/", "/archiv/", "/themen/", "/kategorien/", "/kompetenzen/", "/topics/", "/taxonomy/", "/search/", "/results/", "?page=", "?offset="),
    "markdown": ("/category/", "/tag/", "/tags/", "/archive/", "/archiv/", "/themen/", "/kategorien/", "/kategorie/", "/kompetenzen/", "/topics/", "/taxonomy/", "/search/", "/results/", "/liste", "/list", "/all-", "/alle-", "/index", "?view=", "?page=", "?offset=", "/services/", "/leistung/", "/leistungen/", "/autor/", "/author/", "/profile/", "/team/", "/standorte/", "/locations/", "/karriere/", "/career/"),
}
NAV_WORDS = {
    "static": ("login", "menu", "search", "contact", "impressum", "datenschutz", "cookie", "home"),
    "browser": ("login", "search", "contact", "impressum", "datenschutz", "cookie", "home"),
    "email": (),
    "markdown": ("login", "menu", "search", "contact", "impressum", "datenschutz", "cookie", "home", "back", "next", "previous", "skip", "careers", "jobs", "right", "left", "top", "down", "up", "share", "download", "subscribe", "newsletter"),
}
#: Shortest link text.
MIN_TEXT = {"static": 8, "browser": 8, "email": 6, "markdown": 9}
LISTING = ("/news", "/articles", "/blog", "/archive", "/alerts", "/listings", "/list", "/feed", "/resources", "/updates", "/announcements", "?page=", "?start=", "?page_num=", "?offset=")
CONTENT_MARKS = ("-", "ueberschrift", "artikel", "news", "blog")


def has_any(c: Column, parts: tuple[str, ...]) -> Column:
    """Whether the text holds one of some fixed parts."""
    out = F.lit(False)
    for p in parts:
        out = out | F.contains(c, F.lit(p))
    return out


def matches_any(c: Column, parts: tuple[str, ...]) -> Column:
    """The same by one pattern, for long lists: the text is an expression, which
    ``has_any`` repeats for each part, more than compiled code can hold."""
    return c.rlike("|".join(map(re.escape, parts))) if parts else F.lit(False)


def is_pagination(url: Column) -> Column:
    low = F.lower(url)
    return matches_any(low, PAGINATION) | low.rlike(r"/p/\d+")


def is_media(url: Column) -> Column:
    return F.lower(url).rlike(r"\.(" + "|".join(MEDIA) + r")$")


def is_skipped_path(url: Column, variant: str) -> Column:
    return matches_any(F.lower(url), SKIP_PATHS[variant])


def is_navigation(text: Column, variant: str) -> Column:
    return matches_any(F.lower(text), NAV_WORDS[variant])


def passes_rules(url: Column, include: list[str], exclude: list[str]) -> Column:
    """Some include pattern matches, if there are any, and no exclude pattern.
    Patterns are parts of the URL, case and all, or after ``re:`` regular
    expressions; ones that don't compile match nothing."""

    def hit(pattern: str) -> Column:
        if not pattern.startswith("re:"):
            return F.contains(url, F.lit(pattern))
        return url.rlike(pattern[3:]) if usable_pattern(pattern[3:]) else F.lit(False)

    out = F.lit(True)
    if include:
        out = F.lit(False)
        for p in include:
            out = out | hit(p)
    for p in exclude:
        out = out & ~hit(p)
    return out


def count_of(c: Column, part: str) -> Column:
    return (F.length(c) - F.length(F.replace(c, F.lit(part), F.lit("")))) / len(part)


def email_url_ok(url: Column) -> Column:
    """A link of a message that may lead to an article."""
    navigation = F.rtrim(url).endswith("/") & (count_of(url, "/") <= 3)
    return ~(url.startswith("mailto:") | url.startswith("javascript:") | navigation | F.contains(url, F.lit("?t=a-s")) | (count_of(url, "?") > 2) | (F.length(url) < 15))


def markdown_url_ok(url: Column) -> Column:
    """A link of a page read as markdown: no short paths with a closing slash
    that don't look like content, no image parameters."""
    short = url.endswith("/") & ~has_any(F.lower(url), CONTENT_MARKS) & (F.size(F.split(F.regexp_replace(url, "/+$", ""), "/")) <= 4)
    return ~(short | F.contains(url, F.lit("?t=a-s")) | (count_of(url, "?") > 2))


def link_ok(url: Column, text: Column, page: Column, variant: str) -> Column:
    """The whole chain of link filters of a variant of the scan."""
    shown = strip(F.coalesce(text, F.lit("")))
    ok = ~is_pagination(url) & (F.length(shown) >= MIN_TEXT[variant]) & ~is_media(url) & ~is_skipped_path(url, variant)
    if variant == "email":
        return ok & email_url_ok(url)
    ok = ok & ~url.startswith("#") & (url != page) & ~is_navigation(shown, variant)
    return ok & markdown_url_ok(url) if variant == "markdown" else ok


def normalize(url: Column) -> Column:
    """For comparison: without query, fragment and closing slashes, lower case."""
    return F.lower(F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), "/+$", ""))


def resolve(page: Column, href: Column) -> Column:
    """Absolute URL of a link: from the root, absolute, or beside the page.
    Dotted paths are left to the page reader."""
    root = F.regexp_extract(page, r"^([a-zA-Z][\w+.-]*://[^/?#]*)", 1)
    folder = F.regexp_extract(F.regexp_replace(page, r"[?#].*$", ""), r"^([a-zA-Z][\w+.-]*://[^/]*(?:/.*)?/)[^/]*$", 1)
    beside = F.when(folder.rlike("^[a-zA-Z][^:]*://$") | (folder == ""), F.concat(root, F.lit("/"))).otherwise(folder)
    return F.when(href.startswith("/"), F.concat(root, href)).when(href.startswith("http"), href).otherwise(F.concat(beside, href))


def host(url: Column) -> Column:
    """Network location, with a port where there is one; ``unknown`` for none."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][\w+.-]*://([^/?#]*)", 1)
    return F.when(found == "", "unknown").otherwise(found)


def classify(url: Column) -> Column:
    return F.when(has_any(F.lower(url), LISTING), "likely_listings").otherwise("unknown")


def is_hub_link(url: Column, source: Column, inline: Column) -> Column:
    """The source's own page, or below an inline source's page."""
    path = lambda u: F.regexp_extract(normalize(u), r"^[a-z][\w+.-]*://[^/]*(.*)$", 1)
    below = (F.lower(host(url)) == F.lower(host(source))) & path(url).startswith(F.concat(path(source), F.lit("/")))
    return F.when(inline, below).otherwise(normalize(url) == normalize(source))


def _day(y: Column, m: Column, d: Column) -> Column:
    """A real day, or null."""
    return F.try_to_date(F.concat_ws("-", y, m, d), "yyyy-MM-dd")


def dated(url: Column) -> Column:
    """Date in a URL, by the first of four forms that gives a real day:
    /YYYYMMDD_, /YYYY_MM_ (its first day), /YYYY/MM/DD/, /YYYY-MM-DD/."""
    part = lambda pattern, k: F.regexp_extract(url, pattern, k)
    packed = part(r"/(\d{8})_", 1)
    month = r"/(\d{4})_(\d{2})_"
    slashes, dashes = r"/(\d{4})/(\d{2})/(\d{2})/", r"/(\d{4})-(\d{2})-(\d{2})/"
    return F.coalesce(
        _day(F.substring(packed, 1, 4), F.substring(packed, 5, 2), F.substring(packed, 7, 2)),
        _day(part(month, 1), part(month, 2), F.lit("01")),
        _day(part(slashes, 1), part(slashes, 2), part(slashes, 3)),
        _day(part(dashes, 1), part(dashes, 2), part(dashes, 3)),
    )


def generic_date(url: Column) -> Column:
    """Date by the first 20YY-MM-DD or 20YY/MM/DD in a URL."""
    p = r"(20\d{2})[/-](\d{2})[/-](\d{2})"
    return _day(F.regexp_extract(url, p, 1), F.regexp_extract(url, p, 2), F.regexp_extract(url, p, 3))


def configured_date(url: Column, patterns: list[str]) -> Column:
    """Date by the first of a source's own patterns, whose first group holds it."""
    found = [F.try_to_date(F.regexp_replace(F.regexp_extract(url, p, 1), "/", "-"), "yyyy-MM-dd") for p in patterns if usable_pattern(p)]
    return F.coalesce(*found) if found else F.lit(None).cast("date")
