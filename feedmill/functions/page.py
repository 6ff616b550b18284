"""What one parse of a page gives: links with dates, dates, texts, listings.

All stages that need a page's tree share one pass over it (``read_pages``), so
the HTML crosses to Python once.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from datetime import datetime
from difflib import SequenceMatcher
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..dom import Node, free, parse, select, select_one
from . import pydates
from .dates import MONTHS

# Where pages keep their dates and articles.
BOILERPLATE = frozenset(("script", "style", "nav", "footer", "header", "aside", "iframe", "noscript"))
LD_FIELDS = ("datePublished", "dateModified", "dateCreated")
HEAD_PROPERTIES = ("article:published_time", "article:modified_time", "og:published_time", "og:updated_time")
META_NAMES = ("publish-date", "publishdate", "date", "publication-date")
DATA_ATTRIBUTES = ("data-date", "data-published", "data-publish-date", "data-time")
DATE_CLASSES = ("date", "published", "post-date", "article-date", "entry-date", "time", "pubdate")
ARTICLE_META = ("article:published_time", "article:modified_time", "publish_date", "date", "dc:date")
ARTICLE_DATA = (*DATA_ATTRIBUTES, "data-timestamp", "data-created", "data-article-date")
TIME_CLASSES = ("published", "entry-date", "post-date", "article-date", "date")
CONTEXT_TAGS = ("article", "li", "div", "td", "p", "span")
READING = ("article", "[role='main']", ".article-body", ".post-content", ".entry-content", ".content", "main")
CONTAINERS = (
    ".article-panel", ".article-item", ".article-teaser", "[class*='article-item']", "[class*='article-teaser']", "[class*='article-card']", ".card[class*='article']",
    "[class*='news-item']", ".item[class*='article']", "[role='article']", ".post", ".entry", "article", "[class*='news']", "[class*='story']", "[class*='item']", "[class*='card']",
    "li[class*='article']", "li[class*='news']", "li[class*='item']", "div[class*='list'] > div", ".row[class*='item']",
)
TITLES = (".title", "h2", "h3", "h4", "h5", "[class*='title']", "[class*='headline']", "[class*='heading']", "a[class*='title']", "a[class*='headline']", "strong")
DATES = (".date", "time", "[class*='date']", "[class*='published']", "[data-date]", "span[class*='date']", "small[class*='date']", "[class*='timestamp']", "[class*='meta']", "time[datetime]", "[data-published]", "span[class*='time']", ".info", "[class*='author']")
CONTENTS = (".content", ".summary", ".description", "[class*='excerpt']", "[class*='body']", "[class*='desc']", "[class*='text']", "p", "div > p")
LABELS = (".tag", ".type", ".badge")
MIN_ARTICLES, SAME = 3, 0.95

_MONTH = "|".join(sorted(MONTHS, key=len, reverse=True))
#: Forms of dates in running text, in order: ISO, day month year, month day year, dotted.
TEXT_DATES = (
    r"\d{4}[-/]\d{2}[-/]\d{2}(?:[T ]\d{2}:\d{2}:\d{2})?",
    rf"\d{{1,2}}\.?\s+(?:{_MONTH})\s+\d{{4}}",
    rf"(?:{_MONTH})\s+\d{{1,2}}(?:st|nd|rd|th)?,?\s+\d{{4}}",
    r"\d{1,2}\.\s?\d{1,2}\.\s?\d{4}",
)


class Reader:
    """Extractors over a parsed page, with dates relative to ``as_of``."""

    def __init__(self, as_of: datetime, selectors: tuple[str, ...] = (), patterns: tuple[str, ...] = ()) -> None:
        self.as_of, self.selectors, self.patterns = as_of, selectors, patterns

    def _first(self, candidates: Iterator[str | None], normalise=pydates.discovered) -> datetime | None:
        """The first candidate that reads as a date."""
        return next((d for c in candidates if c and (d := normalise(c, self.as_of))), None)

    @staticmethod
    def linked_data(node: Node) -> Iterator[dict]:
        for script in node.find_all("script", type="application/ld+json"):
            try:
                data = json.loads(script.text())
            except ValueError:
                continue
            yield from (x for x in (data if isinstance(data, list) else [data]) if isinstance(x, dict))

    # Dates of links and their surroundings.

    @staticmethod
    def kinds(root: Node) -> frozenset[str]:
        """Tags, attributes and date classes that a page has at all: what it
        lacks needn't be looked for around each of its links."""
        out: set[str] = set()
        for x in root.walk():
            out.add(x.tag)
            out.update(f"@{a}" for a in x.attrs)
            if c := x.attrs.get("class"):
                out.update(f".{n}" for n in DATE_CLASSES if n in c.lower())
        return frozenset(out)

    def _element_candidates(self, node: Node, kinds: frozenset[str]) -> Iterator[str | None]:
        if "script" in kinds:
            for item in self.linked_data(node):
                yield from (item.get(f) for f in LD_FIELDS[:2])
        if "meta" in kinds:
            for meta in [node.find("meta", property=HEAD_PROPERTIES[0]), *(node.find("meta", name=n) for n in META_NAMES)]:
                if meta:
                    yield meta.get("content")
        for attribute in DATA_ATTRIBUTES:
            if f"@{attribute}" not in kinds:
                continue
            yield next((x.get(attribute) for x in node.walk() if attribute in x.attrs), None)
        for selector in self.selectors:
            if (x := select_one(node, selector)) is not None:
                yield x.get("datetime")
                if 0 < len(own := x.text(strip=True)) < 50:
                    yield own
                if x.parent and len(around := x.parent.text(strip=True)) < 300:
                    yield from self._searched(around, self.patterns)
        whole = node.text()
        yield from self._searched(whole, self.patterns)
        if "time" in kinds:
            yield next((x.get("datetime") for x in node.find_all("time") if x.get("datetime")), None)
        if "@itemprop" in kinds and (x := next((x for x in node.walk() if re.search(r"date(Published|Modified)", x.get("itemprop", ""), re.I)), None)) is not None:
            yield from (x.get("datetime"), x.get("content"), x.text(strip=True))
        for name in DATE_CLASSES:
            if f".{name}" in kinds and (x := next((x for x in node.walk() if name in x.get("class", "").lower()), None)) is not None:
                yield x.get("datetime")
                if len(own := x.text(strip=True)) < 50:
                    yield own
        for a in node.find_all("a"):
            if m := re.search(r"\d{4}[-/]\d{2}[-/]\d{2}", a.get("href", "")):
                yield m[0]
        yield from self._searched(whole, TEXT_DATES)

    @staticmethod
    def _searched(text: str, patterns) -> Iterator[str]:
        for p in patterns:
            try:
                m = re.search(p, text, re.I)
            except re.error:
                continue
            if m:
                yield m[0]

    def element_date(self, node: Node, kinds: frozenset[str] | None = None) -> datetime | None:
        if kinds is None:
            alone = Node("", {}, None)
            alone.children = [node]
            kinds = self.kinds(alone)
        return self._first(self._element_candidates(node, kinds))

    def page_date(self, root: Node) -> datetime | None:
        def candidates():
            for item in self.linked_data(root):
                yield from (item.get(f) for f in LD_FIELDS)
            head = root.find("head")
            if head:
                for meta in [*(head.find("meta", property=p) for p in HEAD_PROPERTIES), *(head.find("meta", name=n) for n in (*META_NAMES, "DC.date"))]:
                    if meta:
                        yield meta.get("content")

        return self._first(candidates())

    def link_date(self, a: Node, page: datetime | None, memory: dict[int, datetime | None], kinds: frozenset[str]) -> datetime | None:
        """Of the link itself, its neighbours, its parent and the parent's
        neighbours, and up to five elements around it; else the page's."""
        around: list[Node | str | None] = [a, a.sibling(-1), a.sibling(1), a.parent]
        if a.parent is not None:
            around += [a.parent.sibling(-1), a.parent.sibling(1)]
        up = a.parent
        for _ in range(5):
            if up is None:
                break
            if up.tag in CONTEXT_TAGS:
                around.append(up)
            up = up.parent
        for x in around:
            if isinstance(x, Node):
                if id(x) not in memory:
                    memory[id(x)] = self.element_date(x, kinds)
                if memory[id(x)]:
                    return memory[id(x)]
        return page

    def links(self, root: Node, url: str) -> list[dict]:
        page, memory, kinds = self.page_date(root), {}, self.kinds(root)
        out = []
        for pos, a in enumerate(x for x in root.find_all("a") if "href" in x.attrs):
            out.append({"pos": pos, "text": a.text(strip=True), "href": a.get("href"), "url": resolve(url, a.get("href")), "date": pydates.iso(self.link_date(a, page, memory, kinds))})
        return out

    # Dates and texts of articles.

    def article_date(self, root: Node, html: str) -> datetime | None:
        def structured():
            for item in self.linked_data(root):
                for f in LD_FIELDS[:2]:
                    if f in item:
                        return item[f]
            for tag in ("time", "span", "div"):
                x = next((x for x in root.find_all(tag) if re.search("datePublished|dateModified", x.get("itemprop", ""), re.I)), None)
                if x is not None and (x.get("datetime") or x.get("content")):
                    return x.get("datetime") or x.get("content")

        def first_meta(keys, *kinds):
            for key in keys:
                for kind in kinds:
                    meta = root.find("meta", **{kind: key})
                    if meta is not None:
                        if meta.get("content"):
                            return meta.get("content")
                        break

        def data():
            return next((v for n in ARTICLE_DATA if (v := next((x.get(n) for x in root.walk() if n in x.attrs), None)) and v.strip()), None)

        def times():
            x = next((x for x in root.find_all("time") if "datetime" in x.attrs), None)
            if x is not None and x.get("datetime"):
                return x.get("datetime")
            for name in TIME_CLASSES:
                x = next((x for x in root.find_all("time") if name in x.classes()), None)
                if x is not None and 0 < len(t := x.text(strip=True)) < 50:
                    return t

        def written():
            return next(self._searched(html, TEXT_DATES), None)

        tries = (structured, lambda: first_meta(HEAD_PROPERTIES[2:], "property"), lambda: first_meta(ARTICLE_META, "name", "property"), data, times, written)
        return self._first((f() for f in tries), pydates.article)

    @staticmethod
    def clean_text(node: Node) -> str:
        """Text without boilerplate elements, one phrase a line."""
        lines = node.text("\n\n", skip=BOILERPLATE).splitlines()
        return "\n".join(p for line in lines for x in line.strip().split("  ") if (p := x.strip()))

    def reading_text(self, root: Node) -> str:
        """Of the first container that has text, else of the largest block."""
        wrap = lambda x: self._only(x)
        for selector in READING:
            if (x := select_one(root, selector)) is not None and (t := self.clean_text(wrap(x))):
                return t
        blocks = list(root.find_all("p", "div", "article"))
        return self.clean_text(wrap(max(blocks, key=lambda x: len(x.text(strip=True))))) if blocks else ""

    @staticmethod
    def _only(x: Node) -> Node:
        top = Node("", {}, None)
        top.children = [x]
        return top

    @staticmethod
    def dense_text(root: Node) -> str:
        """Paragraphs that are mostly words, not links."""
        out = []
        for p in root.find_all("p", "li", "h1", "h2", "h3", "blockquote", "pre"):
            whole = re.sub(r"\s+", " ", p.text(skip=BOILERPLATE)).strip()
            linked = sum(len(a.text(strip=True)) for a in p.find_all("a"))
            up, outside = p.parent, True
            while up is not None:
                outside, up = outside and up.tag not in BOILERPLATE, up.parent
            if outside and whole and linked < 0.5 * len(whole) and (p.tag != "li" or len(whole) > 40):
                out.append(whole)
        return "\n\n".join(dict.fromkeys(out))

    def article_text(self, root: Node, least: int = 100) -> str:
        """Dense text if there is enough of it, else all clean text."""
        dense = self.dense_text(root)
        return dense if len(dense) > least else self.clean_text(root)

    # Listing pages.

    @staticmethod
    def _any(node: Node, selectors) -> Node | None:
        return next((x for s in selectors if (x := select_one(node, s)) is not None), None)

    def _field(self, node: Node, selectors) -> str:
        return next((t for s in selectors if (x := select_one(node, s)) is not None and (t := x.text(strip=True))), "")

    def container_counts(self, root: Node) -> dict[str, list[Node]]:
        """Elements by container selector.  Selectors that need a class, role or
        tag which the page doesn't have are not tried."""
        nodes = list(root.walk())
        classes, tags = " ".join(x.attrs.get("class", "") for x in nodes), {x.tag for x in nodes}
        roles = {x.attrs.get("role") for x in nodes}

        def may_match(selector: str) -> bool:
            needed = re.findall(r"\.([\w-]+)|class\*='([^']+)'", selector)
            return all((a or b) in classes for a, b in needed) and (needed or selector in tags or (selector.startswith("[role") and "article" in roles))

        return {s: select(root, s) if may_match(s) else [] for s in CONTAINERS}

    def confidence(self, found: dict[str, list[Node]]) -> int:
        """From 0 to 100: containers 30, dates 25, titles 25, contents 15, like
        structure 5."""
        out = 30 if max(map(len, found.values())) >= MIN_ARTICLES else 0
        nodes = next((x for x in found.values() if len(x) >= MIN_ARTICLES), [])[:5]
        if nodes:
            share = lambda selectors: sum(self._any(x, selectors) is not None for x in nodes) / len(nodes)
            out += 25 * (share(DATES) >= 0.8) + 25 * (share(TITLES) >= 0.8) + 15 * (share(CONTENTS) >= 0.6)
            sizes = [len(x.children) for x in nodes]
            mean = sum(sizes) / len(sizes)
            out += 5 * (len(nodes) < 2 or mean > 0 and all(abs(n - mean) / mean < 0.3 for n in sizes))
        return min(out, 100)

    def is_listing(self, root: Node, found: dict[str, list[Node]], least: int = MIN_ARTICLES) -> bool:
        """Containers enough, unless the page calls itself an article."""
        kind = select_one(root, "meta[property='og:type']")
        if kind is not None and kind.get("content", "").lower() == "article":
            return False
        return max(map(len, found.values())) >= max(least, MIN_ARTICLES)

    def pattern(self, found: dict[str, list[Node]]) -> tuple[str, str] | None:
        """The first selector whose containers mostly have titles and dates, and
        the kind of list that their class suggests."""
        for selector, nodes in found.items():
            if len(nodes) < max(2, MIN_ARTICLES - 1):
                continue
            sample = nodes[:5]
            if all(sum(self._any(x, s) is not None for x in sample) >= 0.8 * len(sample) for s in (TITLES, DATES)):
                name = " ".join(nodes[0].classes())
                kinds = (("carousel", ("carousel",)), ("grid", ("grid", "col")), ("list", ("list", "item")))
                return selector, next((k for k, marks in kinds if any(m in name for m in marks)), "generic")
        return None

    def listing_item(self, node: Node, pos: int, kind: str) -> dict | None:
        title, said = self._field(node, TITLES), self._field(node, DATES)
        if not title or not said:
            return None
        link, image = next((x for x in node.find_all("a") if "href" in x.attrs), None), next((x for x in node.find_all("img") if "src" in x.attrs), None)
        back = next((m[1] for x in node.walk() if (m := re.search(r"background-image\s*:\s*url\([\"']?([^\"')\s]+)", x.get("style", "")))), None)
        when = pydates.listing(said, self.as_of) or self.as_of
        return {
            "pos": pos, "title": title.strip(), "date": when.isoformat(), "content": (self._field(node, CONTENTS) or title).strip(), "url": link.get("href") if link is not None else node.get("data-href"),
            "category": self._field(node, LABELS), "image_url": image.get("src") if image is not None else back, "element_id": node.get("id"), "method": kind,
        }

    def listing_articles(self, found: dict[str, list[Node]], max_age_days: int | None = None) -> list[dict]:
        """Articles of a listing page: up to the first that is too old, valid
        ones, without near copies, newest first."""
        match = self.pattern(found)
        if match is None:
            return []
        out: list[dict] = []
        for pos, node in enumerate(found[match[0]]):
            item = self.listing_item(node, pos, match[1])
            if item is None:
                continue
            if max_age_days is not None and (self.as_of - datetime.fromisoformat(item["date"])).total_seconds() > max_age_days * 86400:
                break
            if 5 <= len(item["title"].strip()) <= 500 and (not item["content"] or len(item["content"]) >= 10):
                out.append(item)
        return sorted(drop_near_copies(out), key=lambda x: x["date"], reverse=True)

    def single_article(self, root: Node, fragment: str) -> str | None:
        """Text of the article with an id, or around the button that opens it."""
        node = next((x for x in root.walk() if x.get("id") == fragment), None)
        if node is None:
            button = next((x for x in root.find_all("button") if f"({fragment})" in x.get("onclick", "")), None)
            if button is None:
                return None
            ups, up = [], button.parent
            while up is not None and up.tag:
                ups.append(up)
                up = up.parent
            node = next((x for name in ("article-panel", "item") for x in ups if name in x.classes()), button.parent)
        title, content, said = (self._field(node, s) for s in (TITLES, CONTENTS, DATES))
        parts = [f"# {title}"] * bool(title) + [f"**Date:** {said}"] * bool(said) + [content] * bool(content)
        return "\n\n".join(parts) if parts else node.text("\n", strip=True)


def drop_near_copies(items: list[dict], same: float = SAME) -> list[dict]:
    """Greedy, in order: an item goes if its date and the start of its title are
    more than ``same`` alike to those of one kept.  Lists are one page's."""
    kept, marks = [], []
    for item in items:
        mark = f"{item['date']}|{item['title'][:30]}"
        if not any(SequenceMatcher(None, mark, m).ratio() > same for m in marks):
            kept.append(item)
            marks.append(mark)
    return kept


def resolve(page: str, href: str) -> str:
    m = re.match(r"[a-zA-Z][\w+.-]*://[^/?#]*", page)
    if href.startswith("/"):
        return (m[0] if m else "") + href
    return href if href.startswith("http") else urljoin(page, href)


ARTICLE = "struct<pos: int, title: string, date: string, content: string, url: string, category: string, image_url: string, element_id: string, method: string>"
PAGE = f"struct<links: array<struct<pos: int, text: string, href: string, url: string, date: string>>, clean: string, reading: string, article: string, page_date: string, article_date: string, is_listing: boolean, confidence: int, articles: array<{ARTICLE}>>"


#: Pages in an Arrow batch, and those whose results a worker holds at once.
BATCH, AT_ONCE = 500, 50

#: Parts of what a page gives.
PARTS = ("links", "texts", "dates", "listing")


def read_pages(html: Column, url: Column, as_of: datetime, selectors: tuple[str, ...] = (), patterns: tuple[str, ...] = (), max_age_days: int | None = None, parts: tuple[str, ...] = PARTS, options: Column | None = None) -> Column:
    """One struct for each page; a null page reads as an empty one.  Only the
    ``parts`` asked for are worked out, the others are null.  ``options``: a page's
    own selectors and patterns, as JSON."""
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    kind = to_arrow_type(_parse_datatype_string(PAGE))

    @F.arrow_udf(PAGE)
    def read(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        readers = {None: Reader(as_of, selectors, patterns)}
        for pages, urls, own in batches:
            for at_once in range(0, len(pages), AT_ONCE):
                out = []
                for page, at, o in zip(*(x.slice(at_once, AT_ONCE).to_pylist() for x in (pages, urls, own))):
                    if o not in readers:
                        readers[o] = Reader(as_of, *map(tuple, json.loads(o)))
                    reader, root = readers[o], parse(page)
                    row: dict = dict.fromkeys(f.name for f in kind)
                    if "links" in parts:
                        row |= {"links": reader.links(root, at or "")}
                    if "texts" in parts:
                        row |= {"clean": reader.clean_text(root), "reading": reader.reading_text(root), "article": reader.article_text(root)}
                    if "dates" in parts:
                        row |= {"page_date": pydates.iso(reader.page_date(root)), "article_date": pydates.iso(reader.article_date(root, page or ""))}
                    if "listing" in parts:
                        found = reader.container_counts(root)
                        row |= {"is_listing": reader.is_listing(root, found), "confidence": reader.confidence(found), "articles": reader.listing_articles(found, max_age_days)}
                    free(root)
                    out.append(row)
                yield pa.array(out, kind)
            if not len(pages):
                yield pa.array([], kind)

    return read(html, url, F.lit(None).cast("string") if options is None else options)


def fragments(html: Column, fragment: Column, as_of: datetime) -> Column:
    @F.arrow_udf("string")
    def read(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        reader = Reader(as_of)
        for pages, names in batches:
            yield pa.array([reader.single_article(parse(p), f) if f else None for p, f in zip(pages.to_pylist(), names.to_pylist())], pa.string())

    return read(html, fragment)


def with_page(pages: DataFrame, as_of: datetime, **options) -> DataFrame:
    """``pages`` (url, html) with ``page``, one parse for all that follows.  Sets the
    session's Arrow batches to BATCH rows, if they are larger: a worker holds one."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(pages.sparkSession.conf.get(key)) <= BATCH:
        pages.sparkSession.conf.set(key, str(BATCH))
    return pages.withColumn("page", read_pages(F.col("html"), F.col("url"), as_of, **options))
