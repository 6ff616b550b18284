"""The whole pipeline, runs after each other, the command line and streams."""

import json
from dataclasses import replace
from dataclasses import replace
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from feedmill import cli
from feedmill.config import from_dict
from feedmill.functions.scoring import DIMENSIONS
from feedmill.operators.state import StateStore
from feedmill.pipeline import Inputs, categories_of, discover, prompts, run, scan
from feedmill.provider import Replay
from feedmill.streaming.runner import distinct_events, run_available, upsert_batches

AS_OF = datetime(2026, 1, 25, 12, tzinfo=UTC)
LONG = "Die Ermittlungen wegen Betrug gegen das Unternehmen dauern an, wie die Behörde heute in Berlin mitgeteilt hat. "
HUB = "https://site.de/news"
CFG = {
    "pipeline_version": "1",
    "categories": [{"name": "law", "keywords": ["Betrug", "BETRUG"]}, {"name": "none", "keywords": []}],
    "web_sources": [{"url": HUB, "categories": ["law"], "discovery_method": "static"}, {"url": "https://list.de/all", "categories": ["law"], "listings_type": "inline", "discovery_method": "static"}],
    "email_folders": [{"folder_path": "Inbox/N"}],
}


def article(text):
    return f"<html><body><article><p>{text}</p></article></body></html>"


def link(n, date, title=None):
    return f'<li><span class="date">{date}</span> <a href="/news/a{n}">{title or f"Article number {n} of the day"}</a></li>'


@pytest.fixture(scope="module")
def inputs(spark):
    hub = "<html><body><ul>" + link(1, "25.01.2026") + link(2, "24.01.2026") + link(3, "24.01.2026") + link(4, "24.01.2026") + link(9, "01.01.2026") + link(5, "25.01.2026") + '<li><a href="/news">The hub itself again</a></li></ul></body></html>'
    cards = "".join(f'<div class="news-item"><span class="date">2{i}.01.2026</span><h3>Listing title number {i} {"xyzuvw"[i] * 12}</h3><p>{LONG}</p></div>' for i in range(4, 0, -1))
    pages = spark.createDataFrame([(HUB, hub), ("https://list.de/all", "<html></html>")], "url string, html string")
    rows = [
        ("https://site.de/news/a1", 200, article(LONG * 8), "auto"),
        ("https://site.de/news/a2", 401, None, "auto"),
        ("https://site.de/news/a3", 200, article("Nothing of interest was said here today at all by anyone. " * 15), "auto"),
        ("https://site.de/news/a4", 200, article("Betrug."), "auto"),
        ("https://list.de/all", 200, f"<html><body>{cards}</body></html>", "auto"),
        ("https://mail.de/article/one", 200, article(LONG * 9), "auto"),
    ]
    fetched = spark.createDataFrame([(u, s, h, None, None, m) for u, s, h, m in rows], "url string, http_status int, static_html string, rendered_html string, crawled_html string, fetch_method string")
    mail = spark.createDataFrame([("Inbox/N", "1", "s", "x@y", AS_OF, AS_OF, '<a href="https://mail.de/article/one">Read all about it</a>')], "folder string, email_id string, subject string, sender string, sent_at timestamp, received_at timestamp, body string")
    return Inputs(listing_pages=pages, fetched=fetched, messages=mail)


def answers(spark, keys, score=3):
    body = json.dumps({"title": "T " * 20, "summary": "S", "quality_score": 0.9, "relevance_dimensions": dict.fromkeys(DIMENSIONS, score), "practice_area": "Sonstiges"})
    return Replay(spark.createDataFrame([(k, body) for k in keys], "source_key string, answer string"))


def test_run_without_a_provider_and_again(spark, inputs, tmp_path):
    store = StateStore(spark, str(tmp_path))
    first = run(spark, from_dict(CFG), inputs, AS_OF, store)
    got = {r["source_key"]: r for r in first.items.collect()}
    kids = [k for k in got if k.startswith("listings:")]
    # Children older than three days are gone; 22.01. at midnight is older than AS_OF less three days.
    assert len(kids) == 2
    assert set(got) - set(kids) == {"web:https://site.de/news/a1", "web:https://mail.de/article/one"}
    assert got["web:https://site.de/news/a1"]["keywords"] == ["Betrug"] and got["web:https://site.de/news/a1"]["language_detected"] == "de"
    rejects = {(r["source_key"], r["stage"], r["kind"]): r["reason"] for r in first.rejects.collect()}
    assert rejects["web:https://site.de/news/a2", "extraction", "failed"] == "auth_required"
    assert rejects["web:https://site.de/news/a3", "extraction", "filtered"] == "No keywords matched"
    assert rejects["web:https://site.de/news/a4", "preparation", "failed"] == "article_text_insufficient"
    # a9 is old and ends the scan, so a5 after it is never seen; a9 itself is stale.
    assert not any("a5" in k[0] for k in [*rejects, *((x,) for x in got)])
    state = {r["source_key"]: r["status"] for r in store.read().collect()}
    assert state["web:https://site.de/news/a1"] == "success" and state["web:https://site.de/news/a2"] == "extraction_failed" and state["web:https://site.de/news/a3"] == "filtered"

    again = run(spark, from_dict(CFG), inputs, AS_OF, store)
    assert again.items.count() == 0  # children too are in the state
    assert {r["source_key"] for r in again.rejects.where("stage = 'extraction'").collect()} >= {"web:https://site.de/news/a2", "web:https://site.de/news/a3"}  # tried again
    assert {r["source_key"]: r["status"] for r in store.read().collect()}["web:https://site.de/news/a1"] == "success"


def test_run_with_recorded_answers(spark, inputs, tmp_path):
    store = StateStore(spark, str(tmp_path))
    provider = answers(spark, ["web:https://site.de/news/a1"])
    result = run(spark, from_dict(CFG), inputs, AS_OF, store, provider)
    (item,) = result.items.collect()
    assert item["relevance_score"] == 15 and item["relevance_level"] == "Hoch" and item["title"].endswith("…") and item["summary"] == "S"
    reasons = {r["source_key"]: r["reason"] for r in result.rejects.where("stage = 'enrichment'").collect()}
    assert reasons["web:https://mail.de/article/one"] == "no_answer"
    low = run(spark, from_dict(CFG), inputs, AS_OF, StateStore(spark, str(tmp_path / "2")), answers(spark, ["web:https://site.de/news/a1"], 1))
    assert low.items.count() == 0
    assert {r["reason"] for r in low.rejects.where("source_key like '%a1' and stage = 'enrichment'").collect()} == {"filtered: Mittel"}
    metrics = {(r["stage"], r["kind"]): r["n"] for r in result.metrics.collect()}
    assert metrics["output", "processed"] == 1


FEED = "<rss><channel>{}</channel></rss>"
ENTRY = "<item><title>Feed entry {0}</title><link>https://site.de/news/f{0}</link><pubDate>{1}</pubDate></item>"
NEW, OLD = "Sun, 25 Jan 2026 08:00:00 +0000", "Thu, 01 Jan 2026 08:00:00 +0000"


@pytest.mark.parametrize(
    "entries, rules, want",
    [
        ([("1", NEW)], {}, {"f1"}),  # the feed alone
        ([("1", NEW)], {"exclude_patterns": ["/f"]}, {"a1", "a2"}),  # emptied by rules: on to the page
        ([("1", NEW), ("2", OLD)], {"exclude_patterns": ["/f"]}, set()),  # stopped by age: the end
        ([("2", OLD)], {}, set()),
        ([], {}, {"a1", "a2"}),
    ],
)
def test_auto_falls_through_only_where_nothing_was_stopped(spark, entries, rules, want):
    cfg = from_dict(CFG | {"web_sources": [{"url": HUB, "discovery_method": "auto", "extraction_rules": rules}], "email_folders": []})
    xml = FEED.format("".join(ENTRY.format(*e) for e in entries)).encode()
    feeds = spark.createDataFrame([(HUB, 0, 200, xml)], "source_url string, feed_ord int, http_status int, xml binary")
    page = "<html><body><ul>" + link(1, "25.01.2026") + link(2, "24.01.2026") + "</ul></body></html>"
    pages = spark.createDataFrame([(HUB, page)], "url string, html string")
    got = scan(spark, cfg.web_sources[0], Inputs(listing_pages=pages, feeds=feeds), cfg, AS_OF).collect()
    assert {r["url"].rsplit("/", 1)[1] for r in got} == want and len(got) == len(want)


def test_second_way_of_a_page_only_where_the_first_finds_none(spark):
    """A link under /tags/ is skipped by the static way, not by the browser's."""
    cfg = from_dict(CFG | {"web_sources": [{"url": HUB, "discovery_method": "auto"}], "email_folders": []})
    tagged = '<li><span class="date">25.01.2026</span> <a href="/tags/t1">A tagged article of the day</a></li>'
    found = lambda rows: {r["url"] for r in scan(spark, cfg.web_sources[0], Inputs(listing_pages=spark.createDataFrame([(HUB, f"<ul>{rows}</ul>")], "url string, html string")), cfg, AS_OF).collect()}
    assert found(tagged) == {"https://site.de/tags/t1"}
    assert found(tagged + link(1, "25.01.2026")) == {"https://site.de/news/a1"}
    old = link(9, "01.01.2026")  # the static way keeps the old link that stops it
    assert found(old + tagged) == {"https://site.de/news/a9"}


def many_sources(n):
    """Sources of all methods with rules, words, dates and readers of their own."""
    methods = ["static", "auto", "rss", "sitemap", "browser"]
    out = []
    for i in range(n):
        own = {"url": f"https://s{i}.de/news", "discovery_method": methods[i % 5], "categories": ["law"] if i % 2 else ["none"]}
        if i % 3 == 0:
            own["extraction_rules"] = {"include_patterns": ["re:/[an]\\d", "re:(["], "exclude_patterns": ["a2", "re:(["]}
        if i % 4 == 0:
            own["date_extraction_pattern"] = {"css_selectors": [".when"], "regex_patterns": [r"/(\d{4}-\d{2}-\d{2})/x", "(["]}
        if i % 7 == 0:
            own["listings_type"] = "inline"
        own["rss_date_extraction"] = ["both", "feed_fields", "url_pattern"][i % 3]
        out.append(own)
    return from_dict(CFG | {"web_sources": out, "email_folders": []})


def many_inputs(spark, n, folder=None):
    pages, feeds, maps = [], [], []
    for i in range(n):
        root = f"https://s{i}.de"
        links = "".join(f'<li><span class="{"when" if k == 3 else "date"}">{d}</span> <a href="/{p}{k}">Link number {k} of the page</a></li>' for k, (p, d) in enumerate([("a", "25.01.2026"), ("tags/n", "24.01.2026"), ("a", "25.01.2026"), ("n", "24.01.2026"), ("n", "01.01.2026" if i % 2 else "24.01.2026"), ("n", "25.01.2026")]))
        pages.append((f"{root}/news", f'<ul>{links}<li><a href="/news">The hub itself again</a></li><li><a href="/2026-01-24/x">Dated by its address</a></li></ul>'))
        entries = "".join(f"<item><title>Betrug entry {k}</title><link>{root}/{p}{k}</link><pubDate>{d}</pubDate></item>" for k, (p, d) in enumerate([("n", NEW), ("a", NEW), ("2026/01/24/n", OLD if i % 4 == 1 else NEW), ("n", NEW)]))
        if i % 3:
            feeds.append((f"{root}/news", 0, 200, FEED.format(entries).encode()))
        maps.append((f"{root}/news", f"{root}/map.xml", f"<urlset><url><loc>{root}/2026/01/24/n1</loc></url><url><loc>{root}/2025/01/24/n2</loc></url><url><loc>{root}/a2</loc></url></urlset>".encode()))
    frames = spark.createDataFrame(pages, "url string, html string"), spark.createDataFrame(feeds, "source_url string, feed_ord int, http_status int, xml binary"), spark.createDataFrame(maps, "source_url string, map_url string, xml binary")
    if folder:
        for name, f in zip("pfm", frames):
            f.write.parquet(f"{folder}/{name}")
        frames = tuple(spark.read.parquet(f"{folder}/{name}") for name in "pfm")
    return Inputs(listing_pages=frames[0], feeds=frames[1], sitemaps=frames[2])


def test_all_sources_at_once_are_each_by_itself(spark):
    """Sources found together are found as each of them alone."""
    n = 8
    cfg, inputs = many_sources(n), many_inputs(spark, n)
    row = lambda r: (r["source_url"], r["url"], r["title"], r["published"], r["pos"], tuple(r["categories"]))
    together = sorted(map(row, discover(spark, cfg, inputs, AS_OF, AS_OF).collect()), key=str)
    alone = []
    for s in cfg.web_sources:
        alone += map(row, discover(spark, cfg.__class__(**{**cfg.__dict__, "web_sources": (s,)}), inputs, AS_OF, AS_OF).collect())
    assert together == sorted(alone, key=str) and len({r[0] for r in together}) > 5


def test_one_scan_of_each_input_for_any_number_of_sources(spark, tmp_path):
    inputs = many_inputs(spark, 40, str(tmp_path))
    scans = lambda n: discover(spark, many_sources(n), inputs, AS_OF, AS_OF)._jdf.queryExecution().optimizedPlan().toString().count("Relation [")
    assert scans(40) == scans(5) <= 5


def test_categories_given_on_discovery_and_prompts_by_schema(spark):
    dims = {d: {"label": f"L{i}", "question": f"Q{i}", "scores": {str(k): f"s{i}{k}" for k in range(4)}} for i, d in enumerate(DIMENSIONS)}
    schema = {"schema_id": "s", "system_message": "Be strict.", "dimensions": dims, "practice_areas": ["Tax", "Labour"]}
    cfg = from_dict(CFG | {"categories": [{"name": "law", "keywords": ["x"], "relevance_schema": schema}, {"name": "none", "keywords": ["y"]}]})
    items = spark.createDataFrame([("web:https://site.de/news/a", ["none"]), ("web:https://other.de/a", ["none"]), ("web:https://other.de/b", None)], "source_key string, categories array<string>")
    got = {r["source_key"]: r["categories"] for r in categories_of(cfg, items, spark).collect()}
    assert got == {"web:https://site.de/news/a": ["law"], "web:https://other.de/a": ["none"], "web:https://other.de/b": ["law", "none"]}
    rows = spark.createDataFrame([("T", "C", "s"), ("T", "C", None)], "title string, content string, schema_id string").withColumns(prompts(cfg)).collect()
    assert rows[0]["system"] == "Be strict." and rows[1]["system"] is None
    assert "L3 - Q3 (0=s30, 1=s31, 2=s32, 3=s33)" in rows[0]["prompt"] and "Tax, Labour" in rows[0]["prompt"]
    assert "Regulatorischer Impact" in rows[1]["prompt"] and "Sonstiges" in rows[1]["prompt"]


def test_run_on_nothing(spark, tmp_path):
    store = StateStore(spark, str(tmp_path))
    result = run(spark, from_dict(CFG), Inputs(), AS_OF, store)
    assert result.items.count() == 0
    assert store.last_run(AS_OF) == AS_OF.replace(tzinfo=None)  # moved on all the same


def test_command_line(spark, inputs, tmp_path, capsys):
    (tmp_path / "c.json").write_text(json.dumps(CFG))
    inputs.listing_pages.write.parquet(str(tmp_path / "in" / "listing_pages"))
    inputs.fetched.write.parquet(str(tmp_path / "in" / "fetched"))
    base = ["--input", str(tmp_path / "in"), "--state", str(tmp_path / "state"), "--results", str(tmp_path / "out"), "--as-of", "2026-01-25T12:00:00"]
    assert cli.main([*base, "--config", str(tmp_path / "c.json"), "--site", "site.de", "--logs", str(tmp_path / "log")], spark) == 0
    assert "output processed 1" in capsys.readouterr().out
    (doc,) = (tmp_path / "out").glob("results_*.json")
    assert json.loads(doc.read_text())["item_count"] == 1
    assert cli.main([*base, "--config", str(tmp_path / "c.json"), "--site", "nowhere"], spark) == 2
    assert cli.main([*base, "--config", str(tmp_path / "missing.json")], spark) == 2
    assert cli.main(["--nonsense"], spark) == 2
    (tmp_path / "bad" / "runs").mkdir(parents=True)
    (tmp_path / "bad" / "runs" / "p.parquet").write_text("x")
    assert cli.main([*base[:2], "--state", str(tmp_path / "bad"), *base[4:], "--config", str(tmp_path / "c.json")], spark) == 3


def test_micro_batches_are_idempotent(spark, tmp_path):
    src = tmp_path / "src"
    spark.range(6).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("source_key")).coalesce(2).write.parquet(str(src))
    store = StateStore(spark, str(tmp_path / "state"))
    decide = lambda todo: todo.select("source_key", F.lit("success").alias("status"), F.lit(None).cast("string").alias("reason"), F.lit(None).cast("string").alias("article_date"), F.lit(AS_OF.replace(tzinfo=None)).alias("processed_at"))
    read = lambda: spark.readStream.schema("source_key string").option("maxFilesPerTrigger", 1).parquet(str(src))
    run_available(read(), str(tmp_path / "c1"), upsert_batches(store, AS_OF, decide))
    assert store.read().count() == 6
    run_available(read(), str(tmp_path / "c2"), upsert_batches(store, AS_OF, decide))  # all of it comes again
    assert store.read().groupBy("status").count().collect()[0]["count"] == 6


def test_stream_without_repeats(spark, tmp_path):
    src = tmp_path / "src"
    spark.createDataFrame([(1, "2026-01-01 00:00:00"), (1, "2026-01-01 00:00:01"), (2, "2026-01-01 00:00:00")], "event_id long, ts string").select("event_id", F.col("ts").cast("timestamp_ntz")).write.parquet(str(src))
    out = str(tmp_path / "out")
    q = distinct_events(spark.readStream.schema("event_id long, ts timestamp_ntz").parquet(str(src))).writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.read.parquet(out).count() == 2


def test_run_with_a_learned_model_of_languages(spark, inputs, tmp_path):
    """The model decides in place of the built-in profiles; an item's columns stay."""
    from feedmill.operators import languages

    texts = spark.createDataFrame([("xx", LONG * 3), ("en", "Nothing of interest was said here today at all by anyone. " * 3)], "lang string, text string")
    plain = run(spark, from_dict(CFG), inputs, AS_OF, StateStore(spark, str(tmp_path / "a"))).items
    learned = run(spark, from_dict(CFG), replace(inputs, languages=languages.learn(texts)), AS_OF, StateStore(spark, str(tmp_path / "b"))).items
    assert sorted(plain.columns) == sorted(learned.columns) and plain.count() == learned.count()
    assert {r["source_key"]: r["language_detected"] for r in learned.collect()}["web:https://site.de/news/a1"] == "xx"
