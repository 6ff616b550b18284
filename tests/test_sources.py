"""Configuration, feeds, site maps, messages, fetched tiers and the archive."""

import gzip
import json
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from feedmill import config
from feedmill.functions.scoring import DIMENSIONS
from feedmill.provider import Http, Replay, retry
from feedmill.sinks import archive_messages, webhook_payload
from feedmill.sources import archive, email, feeds, fetched

AS_OF = datetime(2026, 1, 25, 12, tzinfo=UTC)
BASE = {"pipeline_version": "1", "categories": [{"name": "a", "keywords": ["x"]}], "web_sources": [{"url": "https://a.de"}]}


def test_defaults():
    cfg = config.from_dict(BASE)
    assert cfg.article_max_age_days == 3 and cfg.keyword_filter_enabled and not cfg.bonus_rule
    assert cfg.web_sources[0].categories == ("a",)  # all, if none is named
    old = config.from_dict({"pipeline_version": "1", "keywords": ["x"], "email_folders": [{"folder_path": "a/b"}]})
    assert old.categories[0].name == "general"


@pytest.mark.parametrize(
    ("change", "said"),
    [
        ({"pipeline_version": ""}, "pipeline_version"),
        ({"categories": []}, "no category"),
        ({"categories": [{"name": "a"}, {"name": "a"}]}, "twice"),
        ({"web_sources": []}, "neither"),
        ({"web_sources": [{"url": ""}]}, "no url"),
        ({"web_sources": [{"url": "u", "categories": ["z"]}]}, "unknown"),
        ({"web_sources": [{"url": "u", "discovery_method": "magic"}]}, "discovery_method"),
        ({"web_sources": [{"url": "u", "fetch_method": "magic"}]}, "fetch_method"),
        ({"web_sources": [{"url": "u", "rss_date_extraction": "magic"}]}, "rss_date_extraction"),
        ({"article_max_age_days": 0}, "article_max_age_days"),
        ({"article_max_age_days": True}, "article_max_age_days"),
        ({"keyword_filter_enabled": "yes"}, "true or false"),
        ({"email_folders": [{"folder_path": ""}]}, "folder_path"),
        ({"categories": [{"name": "a", "relevance_schema": {"schema_id": "s", "dimensions": {"d9": {}}}}]}, "dimensions missing"),
    ],
)
def test_faults(change, said):
    with pytest.raises(config.ConfigError, match=said):
        config.from_dict(BASE | change)


def test_all_faults_are_told_at_once():
    with pytest.raises(config.ConfigError) as e:
        config.from_dict({"web_sources": [{"url": ""}]})
    assert len(str(e.value).splitlines()) == 3


def test_whole_schema():
    dims = {d: {"label": "l", "question": "q", "scores": {0: "a", 1: "b", 2: "c", 3: "d"}} for d in DIMENSIONS}
    cfg = config.from_dict(BASE | {"categories": [{"name": "a", "relevance_schema": {"schema_id": "s", "dimensions": dims, "thresholds": {"hoch": 8}}}]})
    assert cfg.schemas == {"a": "s"}


def test_files(tmp_path, monkeypatch):
    (tmp_path / "config.yaml").write_text("pipeline_version: '1'\ncategories: [{name: a}]\n")
    (tmp_path / "sources.yaml").write_text("pipeline_version: '2'\nweb_sources: [{url: https://a.de}]\n")
    monkeypatch.setenv("WEBHOOK_URL", "https://hook")
    cfg = config.load(folder=str(tmp_path))
    assert (cfg.pipeline_version, cfg.web_sources[0].url, cfg.webhook_url) == ("1", "https://a.de", "https://hook")
    (tmp_path / "x.json").write_text(json.dumps(BASE))
    assert config.load(str(tmp_path / "x.json")).pipeline_version == "1"
    with pytest.raises(FileNotFoundError):
        config.load(folder=str(tmp_path / "none"))


def test_site_filter():
    cfg = config.from_dict(BASE | {"web_sources": [{"url": "https://a-b.de"}, {"url": "https://c.d.org"}]})
    assert [s.url for s in cfg.for_site("CD.org").web_sources] == ["https://c.d.org"]
    with pytest.raises(ValueError, match="a-b.de"):
        cfg.for_site("zzz")


RSS = b"""<rss><channel><item><title>A long enough title</title><link>https://a.de/1</link><description>about tion</description><pubDate>Thu, 22 Jan 2026 10:00:00 +0100</pubDate></item>
<item><title>short</title><link>https://a.de/2</link></item><item><title>No link in this one</title></item><item><title>Dated by its address</title><link>https://a.de/2026/01/20/x</link></item></channel></rss>"""
ATOM = b"""<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>An atom title here</title><link rel="self" href="https://no"/><link href="https://a.de/3"/><updated>2026-01-21T08:00:00Z</updated></entry></feed>"""


def test_feeds(spark):
    rows = [("s", 0, 200, b"<broken"), ("s", 1, 500, ATOM), ("s", 2, 200, RSS), ("s", 3, 200, ATOM), ("t", 0, 200, ATOM), ("e", 0, 200, b"<rss/>"), ("n", 0, 200, None)]
    d = spark.createDataFrame(rows, "source_url string, feed_ord int, http_status int, xml binary")
    got = {(r["source_url"], r["url"]): str(r["published"]) for r in feeds.feed_entries(d).collect()}
    assert got == {("s", "https://a.de/1"): "2026-01-22 09:00:00", ("s", "https://a.de/2026/01/20/x"): "2026-01-20 00:00:00", ("t", "https://a.de/3"): "2026-01-21 08:00:00"}
    only = {r["url"]: r["published"] for r in feeds.feed_entries(d, "feed_fields").collect()}
    assert only["https://a.de/2026/01/20/x"] is None


def test_feed_addresses():
    tries = feeds.feed_urls("https://a.de/x", discovered=("https://a.de/own.xml",))
    assert tries[:2] == ["https://a.de/x", "https://a.de/own.xml"] and "https://a.de/feed" in tries
    assert feeds.feed_urls("https://a.de/x", "https://a.de/f")[0] == "https://a.de/f"


def test_sitemaps(spark):
    xml = b'<urlset xmlns="x"><url><loc>https://a.de/2026-01-02/a</loc></url><url><loc>https://a.de/b</loc></url><url/></urlset>'
    index = b"<sitemapindex><sitemap><loc>https://a.de/m.xml</loc></sitemap></sitemapindex>"
    d = spark.createDataFrame([("s", "m", gzip.compress(xml)), ("s", "i", index), ("s", "b", b"<"), ("s", "n", None)], "source_url string, map_url string, xml binary")
    got = {r["url"]: str(r["published"])[:10] for r in feeds.sitemap_urls(d).collect()}
    assert got == {"https://a.de/2026-01-02/a": "2026-01-02", "https://a.de/b": "None"}


def test_messages(spark):
    body = '<p><a href="https://a.de/article/one"> Read <b>this</b> one </a><a href="https://a.de/tag/x">A tag page</a><a href="mailto:x@y.de.example">write to us</a><a href="https://a.de/">Homepage</a><a href="https://a.de/article/two">two</a></p>'
    rows = [("f", "1", "s", "x@y", AS_OF, AS_OF, body), ("f", "2", "s", "x@y", AS_OF, AS_OF - timedelta(days=2), body), ("f", "3", "s", "x@y", AS_OF, AS_OF, "see https://a.de/plain/address now")]
    d = spark.createDataFrame(rows, "folder string, email_id string, subject string, sender string, sent_at timestamp, received_at timestamp, body string")
    new = email.new_messages(d, AS_OF - timedelta(days=1))
    assert new.count() == 2 and email.new_messages(d, AS_OF - timedelta(days=1), limit=1).count() == 1
    items = {r["url"]: r for r in email.as_items(email.message_links(new)).collect()}
    assert set(items) == {"https://a.de/article/one", "https://a.de/plain/address"}
    one = items["https://a.de/article/one"]
    assert one["title"] == "Read this one" and one["source_key"] == "web:https://a.de/article/one" and one["origin"] == "email"


def test_tiers(spark):
    rows = [("a", 200, "S", "R", "C", "auto"), ("b", 403, "S", "R", None, "auto"), ("c", 401, "S", "R", "C", "auto"), ("d", 404, None, "R", "C", "static"), ("e", 500, None, None, None, "auto")]
    d = spark.createDataFrame(rows, "url string, http_status int, static_html string, rendered_html string, crawled_html string, fetch_method string")
    got = {r["url"]: (r["html"], r["extraction_method"], r["reason"]) for r in fetched.resolve_tiers(d).collect()}
    assert got == {"a": ("S", "local", None), "b": ("R", "browser", None), "c": (None, None, "auth_required"), "d": ("C", "browser_crawl", None), "e": (None, None, "no_content")}


def test_archive(spark, tmp_path):
    items = spark.createDataFrame([('{"id":"b"}',), ('{"id":"a"}',)], "json string")
    for days in (0, 1, 40):
        archive.write_document(items, str(tmp_path), AS_OF - timedelta(days=days))
    (tmp_path / "results_bad.json").write_text("{}")
    found = archive.list_results(spark, str(tmp_path)).collect()
    assert [r["item_count"] for r in found] == [2, 2, 2] and found[0]["at"] > found[1]["at"] > found[2]["at"]
    assert archive.list_results(spark, str(tmp_path), 1).count() == 1
    assert [json.loads(r["json"])["id"] for r in archive.load_results(spark, found[0]["path"]).orderBy("pos").collect()] == ["a", "b"]
    assert archive.clear_old(spark, str(tmp_path), AS_OF) == 1
    assert archive.list_results(spark, str(tmp_path)).count() == 2 and (tmp_path / "results_bad.json").exists()


def webhook_items(spark):
    row = ("t", "unknown", "2026-01-02", ["c"], "s", None, "u", "de", "web", None)
    return spark.createDataFrame([row], "title string, published_at string, extracted_at string, categories array<string>, summary string, keywords array<string>, url string, language_detected string, source_type string, relevance_practice_area string")


def test_webhook(spark):
    got = json.loads(webhook_payload(webhook_items(spark)).first()[0])
    assert got["date"] == "2026-01-02" and got["category"] == "c" and got["raw_html"] is None and got["practice_areas"] == [] and got["keywords"] == []


def test_retry_and_mail_archive():
    slept, calls = [], []

    def move(i, f):
        calls.append(i)
        if i == "bad" or len(calls) < 2:
            raise OSError

    with pytest.raises(OSError):
        retry(lambda: move("bad", ""), sleep=slept.append)
    assert slept == [0, 1, 2] and len(calls) == 3
    assert archive_messages([("a", "f")], move) == []


def test_providers(spark):
    prompts = spark.createDataFrame([("k1", "p1"), ("k2", None)], "source_key string, prompt string")
    answers = spark.createDataFrame([("k1", "x")], "source_key string, answer string")
    assert {r["source_key"]: r["answer"] for r in Replay(answers).answer(prompts).collect()} == {"k1": "x", "k2": None}

    def send(url, key, payload):
        if not payload["messages"][-1]["content"]:
            raise OSError
        return json.dumps({"choices": [{"message": {"content": "ok " + payload["messages"][-1]["content"]}}]})

    got = {r["source_key"]: r["answer"] for r in Http("openai", "u", "k", "m", "sys", send=send).answer(prompts).collect()}
    assert got == {"k1": "ok p1", "k2": None}
    with pytest.raises(RuntimeError):
        Http("other", "u", "k", "m")


def test_null_fields_are_left_out(spark):
    from feedmill.operators.outcome import output_json

    d = spark.createDataFrame([("a", None, "body")], "id string, author string, content string")
    assert d.select(output_json(F.struct("*"))).first()[0] == '{"id":"a"}'


def test_entries_of_one_feed_are_dealt_to_all_tasks(spark):
    from feedmill.sources.feeds import feed_entries

    xml = "<rss>" + "".join(f"<item><title>Article {i:05}</title><link>https://a.de/{i}</link></item>" for i in range(50)) + "</rss>"
    feeds = spark.createDataFrame([("https://a.de", 0, 200, xml.encode())], "source_url string, feed_ord int, http_status int, xml binary")
    found = feed_entries(feeds)
    assert "RepartitionByExpression" in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r["pos"], r["url"]) for r in found.collect()) == [(i, f"https://a.de/{i}") for i in range(50)]
