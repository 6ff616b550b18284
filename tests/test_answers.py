"""Lenient answers, the hosted service, and configurations there and back."""

import json

import pytest
from pyspark.sql import functions as F

from feedmill import config
from feedmill.functions import answers
from feedmill.sources.hosted import folder_parts, hosted_articles


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ('{"a": 1}', {"a": 1}),
        ("{'a': None, 'b': True}", {"a": None, "b": True}),
        ('Sure! {"a": "}"} and {"b": 2}', {"a": "}"}),
        ('{broken {"a": 1}', None),
        ('{no} {"a": 1}', {"a": 1}),
        ('{"content": "{\\"a\\": 1}"}', {"a": 1}),
        ('{"a": "say \\"{\\" "}', {"a": 'say "{" '}),
        ("[1, 2]", None),
        ("none", None),
        ("", None),
        (None, None),
        ("{" * 5000, None),
    ],
)
def test_read_answer(text, found):
    assert answers.read_answer(text) == found


def test_plain_text():
    value = [{"type": "reasoning", "text": "no"}, {"type": "message", "content": ["a", {"text": "b"}]}, 3, None]
    assert answers.plain_text(value) == "a\nb"


def test_in_spark(spark):
    d = spark.createDataFrame([('{"k": 1}',), ("x {'k': 2} y",), ("no",), (None,)], "a string")
    assert [r[0] for r in d.select(F.try_variant_get(answers.any_answer(F.col("a")), "$.k", "int")).collect()] == [1, 2, None, None]


def test_hosted(spark):
    inner = json.dumps({"articles": [{"title": "T", "url": "u", "date": "2 January 2026"}, {"title": "", "url": "v"}]})
    d = spark.createDataFrame([("s", inner), ("t", json.dumps({"data": {"json": json.loads(inner)}})), ("x", "broken"), ("y", None)], "source_url string, body string")
    got = [(r["source_url"], r["url"], str(r["published"])[:10]) for r in hosted_articles(d).orderBy("source_url").collect()]
    assert got == [("s", "u", "2026-01-02"), ("t", "u", "2026-01-02")]
    assert folder_parts("Inbox/a\\b//c") == ["Inbox", "a", "b", "c"]


def test_configuration_there_and_back():
    raw = {
        "pipeline_version": "1", "categories": [{"name": "a", "keywords": ["x"]}], "article_max_age_days": 5, "keyword_filter_enabled": False, "article_preparation": {"min_prepared_chars": 10},
        "web_sources": [{"url": "u", "categories": ["a"], "discovery_method": "rss", "extraction_rules": {"include_patterns": ["/x/"]}, "date_extraction_pattern": {"css_selectors": [".d"]}}], "email_folders": [{"folder_path": "f", "categories": ["a"]}],
    }
    cfg = config.from_dict(raw)
    assert cfg.to_dict() == raw and config.from_dict(cfg.to_dict()) == cfg
