"""The page tree, its selectors, and what is read from pages."""

import random
from datetime import UTC, datetime

import pytest

from feedmill.dom import parse, select, select_one
from feedmill.functions import language
from feedmill.functions.page import Reader, drop_near_copies, read_pages, resolve

AS_OF = datetime(2026, 1, 25, tzinfo=UTC)
READER = Reader(AS_OF)


def test_unclosed_elements_nest_and_stray_ends_are_ignored():
    root = parse("<p>a<b>b<p>c</b>d</i></p>e")
    p = root.children[0]
    assert p.tag == "p" and p.children[1].tag == "b" and p.children[1].children[1].tag == "p"
    assert root.text() == "abcde"


@pytest.mark.parametrize(
    ("selector", "n"),
    [("p", 2), (".a", 1), ("#i", 1), ("[data-x]", 1), ("[data-x='1']", 1), ("[class*='b c']", 1), ("div > p", 1), ("div p", 2), ("p.a, span", 2), ("*[data-x]", 1), ("p:hover", 0), ("", 0), ("p >", 2)],
)
def test_selectors(selector, n):
    root = parse('<div><p class="a" id=i>1</p><span class="b c" data-x=1><p>2</p></span></div>')
    assert len(select(root, selector)) == n
    assert (select_one(root, selector) is None) is (n == 0)


@pytest.mark.parametrize(
    ("html", "day"),
    [
        ('<div><time datetime="2026-01-23T10:00:00Z">x</time></div>', "2026-01-23"),
        ('<div><span itemprop="datePublished" content="2026-01-22"></span></div>', "2026-01-22"),
        ('<div><span class="post-date">22. Januar 2026</span></div>', "2026-01-22"),
        ('<div data-x><b data-date="2026-01-20">x</b></div>', "2026-01-20"),
        ("<div>Published 7 January 2026 by x</div>", "2026-01-07"),
        ('<div><a href="/2026/01/19/x">x</a></div>', "2026-01-19"),
        ('<div><script type="application/ld+json">{"dateModified": "2026-01-18"}</script></div>', "2026-01-18"),
        ('<div><script type="application/ld+json">{broken</script>12.01.2026</div>', "2026-01-12"),
        ("<div>no date at all</div>", None),
    ],
)
def test_element_dates(html, day):
    found = READER.element_date(parse(html).children[0])
    assert (str(found.date()) if found else None) == day


def test_configured_selectors_come_before_classes():
    html = '<div><i class="mine">03.01.2026</i><span class="date">04.01.2026</span></div>'
    assert Reader(AS_OF, selectors=(".mine",)).element_date(parse(html)).day == 3
    assert Reader(AS_OF, patterns=(r"03\.\d\d\.\d{4}", "([")).element_date(parse(html)).day == 3


def test_link_context():
    html = "<ul><li>20.01.2026 <a href=/a>A</a></li><li><a href=/b>B</a></li></ul>"
    links = READER.links(parse(html), "https://x.de/l")
    assert [(x["url"], (x["date"] or "")[:10]) for x in links] == [("https://x.de/a", "2026-01-20"), ("https://x.de/b", "2026-01-20")]
    head = '<head><meta property="og:updated_time" content="2026-01-02"></head><body><a href=/a>A</a></body>'
    assert READER.links(parse(head), "https://x.de")[0]["date"][:10] == "2026-01-02"


@pytest.mark.parametrize(
    ("html", "day"),
    [
        ('<script type="application/ld+json">[{"datePublished": "2026-01-02T03:00:00+02:00"}]</script><meta property="og:published_time" content="2026-01-09">', "2026-01-02"),
        ('<meta property="og:published_time" content="2026-01-09">', "2026-01-09"),
        ('<meta name="dc:date" content="9 Januar 2026">', "2026-01-09"),
        ('<p data-created="2026-01-08">', "2026-01-08"),
        ('<time class="entry-date">16. Okt 2017</time>', "2017-10-16"),
        ("<p>Stand: 16. Oktober 2017.</p>", "2017-10-16"),
        ("<p>nothing</p>", None),
    ],
)
def test_article_dates(html, day):
    found = READER.article_date(parse(html), html)
    assert (str(found.date()) if found else None) == day


def page(n, extra=""):
    cards = "".join(f'<div class="news-item" id="i{i}"><span class="date">{10 + i}.01.2026</span><h3>Headline number {i} of many {"abcdefghij"[i] * 9}</h3><p>Text of the item {i}</p><a href="/x/{i}">more</a><img src="/p{i}.png"></div>' for i in range(n))
    return f"<html><head>{extra}</head><body><main>{cards}</main></body></html>"


def test_listing_detection():
    found = lambda html: READER.container_counts(parse(html))
    assert READER.is_listing(parse(page(3)), found(page(3)))
    assert not READER.is_listing(parse(page(2)), found(page(2)))
    own = page(3, "<meta property='og:type' content='Article'>")
    assert not READER.is_listing(parse(own), found(own))
    assert READER.confidence(found(page(4))) == 100
    assert READER.pattern(found(page(4))) == ("[class*='news-item']", "list")
    assert READER.pattern(found("<p>x</p>")) is None


def test_listing_articles():
    got = READER.listing_articles(READER.container_counts(parse(page(4))))
    assert [x["date"][:10] for x in got] == ["2026-01-13", "2026-01-12", "2026-01-11", "2026-01-10"]
    assert got[0]["url"] == "/x/3" and got[0]["image_url"] == "/p3.png" and got[0]["element_id"] == "i3"
    # The first that is too old ends the list and isn't in it.
    assert READER.listing_articles(READER.container_counts(parse(page(4))), max_age_days=12) == []


def test_single_article():
    assert READER.single_article(parse(page(3)), "i1").startswith("# Headline number 1")
    html = '<div class="article-panel"><h2>Deep title</h2><button onclick="open(918)">x</button></div>'
    assert READER.single_article(parse(html), "918") == "# Deep title"
    assert READER.single_article(parse(html), "919") is None


def test_near_copies_are_greedy():
    items = [{"date": "2026-01-01", "title": t} for t in ("The same title of things", "The same title of things!", "Another")]
    assert [x["title"] for x in drop_near_copies(items)] == ["The same title of things", "Another"]


def test_texts():
    html = "<nav>menu</nav><article><h1>T</h1><p>one  two</p><script>x</script></article><footer>f</footer>"
    root = parse(html)
    assert READER.clean_text(root) == "T\none\ntwo"
    assert READER.reading_text(root) == "T\none\ntwo"
    assert READER.reading_text(parse("<div>a</div><p>longer text</p>")) == "longer text"
    assert READER.reading_text(parse("")) == ""


def test_resolve_dotted():
    assert resolve("https://a.de/b/c/d", "../e") == "https://a.de/b/e"
    assert resolve("https://a.de/b", "/e") == "https://a.de/e"


def test_read_pages_in_spark(spark):
    d = spark.createDataFrame([("https://x.de/l", page(3)), ("https://x.de/m", None), (None, "<a href=x>y</a>"), ("https://x.de/n", "")], "url string, html string")
    rows = d.select(read_pages(d.html, d.url, AS_OF).alias("p")).collect()
    assert [len(r.p.links) for r in rows] == [3, 0, 1, 0]
    assert [r.p.is_listing for r in rows] == [True, False, False, False]


def test_random_markup_never_fails():
    rng = random.Random(4)
    bits = ["<p>", "</p>", "<div class='item date'>", "</div>", "<a href=", "x", "'", '"', "<", ">", "&amp;", "<!--", "-->", "<script>", "</script>", "12.01.2026", "<time datetime='2026-01-01'>", "\0", "é"]
    for _ in range(300):
        html = "".join(rng.choice(bits) for _ in range(rng.randint(0, 30)))
        root = parse(html)
        READER.links(root, "https://x")
        READER.listing_articles(READER.container_counts(root))
        READER.article_date(root, html)
        READER.article_text(root)


@pytest.mark.parametrize(("code", "text"), [("de", "Die Staatsanwaltschaft hat gegen das Unternehmen Ermittlungen wegen des Verdachts auf Betrug eingeleitet."), ("en", "The department has opened an investigation into the company for alleged fraud and bribery."), ("fr", "Le parquet a ouvert une enquête sur la société pour des soupçons de corruption et de fraude."), ("es", "La fiscalía ha abierto una investigación sobre la empresa por presuntos delitos de corrupción."), ("en", "kurz"), ("en", None)])
def test_languages(code, text):
    profiles = {c: language.profile(w) for c, w in language.SAMPLES.items()}
    assert language.detect(text, profiles) == code


def test_languages_as_by_plain_counting():
    """Ranks and distances by a loop over words, on odd texts."""
    import random
    import time
    from collections import Counter

    def ranked(text):
        counts = Counter()
        for word in text.lower().split():
            w = f" {''.join(c for c in word if c.isalpha())} "
            if len(w) > 2:
                counts.update(w[i : i + n] for n in (2, 3) for i in range(len(w) - n + 1))
        return {g: i for i, g in enumerate(sorted(counts, key=lambda g: (-counts[g], g))[: language.SIZE])}

    rng = random.Random(9)
    profiles = {c: language.profile(w) for c, w in language.SAMPLES.items()}
    assert profiles == {c: ranked(w) for c, w in language.SAMPLES.items()}
    texts = ["".join(rng.choices("abé ß日İΣ\x00\u2003𐐀1-'.\n", k=rng.randint(0, 400))) for _ in range(200)] + [" ".join(rng.choices(" ".join(language.SAMPLES.values()).split(), k=1500)) for _ in range(20)]
    for t in texts:
        assert language.profile(t) == ranked(t)
        own = ranked(t.strip()[: language.MOST])
        far = {c: sum(abs(r - p[g]) if g in p else language.SIZE for g, r in own.items()) for c, p in profiles.items()}
        assert language.detect(t, profiles) == ("en" if len(t.strip()) < language.LEAST or not own else min(far, key=lambda c: (far[c], c)))

    kept, long = language._sorted(profiles), texts[-20:] * 3
    timed = lambda f: (start := time.process_time(), [f(t[: language.MOST]) for t in long], time.process_time() - start)[2]
    assert min(timed(lambda t: language._closest(t, kept)) for _ in range(3)) < 0.7 * min(timed(ranked) for _ in range(3))


def test_pages_are_read_a_few_at_a_time(spark, monkeypatch):
    """A tree goes with its page, batches are small, and rows stay in order."""
    import gc
    import weakref
    from datetime import UTC, datetime

    from pyspark.sql import functions as F

    from feedmill import dom
    from feedmill.functions import page

    class Tied(dom.Node):
        __slots__ = ("__weakref__",)

    monkeypatch.setattr(dom, "Node", Tied)
    gc.disable()
    try:
        root = dom.parse("<div><p>a<b>c</b></p></div>")
        seen = weakref.ref(next(root.find_all("b")))
        dom.free(root)
        del root
        assert seen() is None
    finally:
        gc.enable()
    monkeypatch.undo()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    rows = spark.range(3 * page.AT_ONCE + 7).coalesce(1).select("id", F.concat(F.lit('<a href="/x">number '), F.col("id").cast("string"), F.lit("</a>")).alias("html"), F.lit("https://a.de/").alias("url"))
    got = page.with_page(rows, datetime(2024, 1, 31, tzinfo=UTC), parts=("links",)).selectExpr("id", "page.links[0].text").collect()
    assert len(got) == 3 * page.AT_ONCE + 7 and all(t == f"number {i}" for i, t in got)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= page.BATCH
    assert page.with_page(rows.where("false"), datetime(2024, 1, 31, tzinfo=UTC), parts=("links",)).count() == 0
