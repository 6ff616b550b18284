"""Joins on parts and beginnings of texts against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from feedmill.operators import lookup, substrings


@pytest.mark.parametrize("most", [100_000, 5])
def test_containing(spark, monkeypatch, most):
    monkeypatch.setattr(substrings, "BROADCAST_WORDS", most)
    rng = random.Random(1)
    letters = "abcé日 "
    texts = [(i, "".join(rng.choices(letters, k=rng.randint(0, 40)))) for i in range(150)] + [(900, None), (901, ""), (902, "long " * 20_000)]
    words = sorted({"".join(rng.choices(letters, k=rng.randint(1, 6))) for _ in range(200)}) + ["", None, "ab", "ab"]
    got = substrings.containing(spark.createDataFrame([(*t, "x", "y") for t in texts], "id long, text string, code string, word string"), spark.createDataFrame([(w,) for w in words], "word string"), "id").collect()
    want = sorted((i, w) for i, t in texts for w in set(words) if w and t is not None and w in t)
    assert sorted((r["id"], r["word"]) for r in got) == want
    none = spark.createDataFrame([], "word string")
    assert substrings.containing(spark.createDataFrame(texts, "id long, text string"), none, "id").count() == 0


def test_containing_does_not_repeat_texts(spark, monkeypatch):
    """Words of over eight bytes, over the ends of parts and of texts; no row holds a
    text for each word."""
    monkeypatch.setattr(substrings, "PART", 16)
    rng = random.Random(4)
    texts = [(i, "".join(rng.choices("ab é\x00", k=rng.randint(0, 80)))) for i in range(200)]
    words = sorted({"".join(rng.choices("ab é\x00", k=rng.randint(1, 14))) for _ in range(300)} | {t[9:30] for _, t in texts} | {t[-12:] for _, t in texts})
    found = substrings.containing(spark.createDataFrame(texts, "id long, text string"), spark.createDataFrame([(w,) for w in words], "word string"), "id")
    assert sorted(map(tuple, found.collect())) == sorted((i, w) for i, t in texts for w in words if w and w in t)
    assert "Contains" not in (plan := found._jdf.queryExecution().optimizedPlan().toString()) and "contains(" not in plan


@pytest.mark.parametrize("contains", [False, True])
def test_many_sources_as_few(spark, monkeypatch, contains):
    rng = random.Random(2)
    make = lambda: "https://" + "".join(rng.choices("ab/", k=rng.randint(0, 7)))
    sources = [(make(), i) for i in range(120)]
    items = [(i, make() + rng.choice(["", "/x", "/y/z", "/"])) for i in range(300)] + [(1000, None), (1001, ""), (1001, "")]
    dim, rows = spark.createDataFrame(sources, "source_url string, source_ord int"), spark.createDataFrame(items, "id long, url string")
    run = lambda: sorted(((r["id"], r["source_url"]) for r in lookup.source_by_url(rows, dim, F.col("url"), contains).collect()), key=str)
    many = run()
    monkeypatch.setattr(lookup, "FEW", 1000)
    assert many == run()
    assert sum(s is not None for _, s in many) > 100


def test_plan_has_no_nested_loop(spark):
    """A hundred thousand sources: beginnings meet them by equality, filtered before the shuffle."""
    dim = spark.range(100_000).select(F.concat(F.lit("https://h"), F.col("id").cast("string"), F.lit(".de/")).alias("source_url"), F.col("id").alias("source_ord"))
    rows = spark.range(2_000).select(F.concat(F.lit("https://h"), (F.col("id") * 997 % 150_000).cast("string"), F.lit(".de/a/b")).alias("url"))
    out = lookup.source_by_url(rows, dim, F.col("url"))
    assert out.where("source_url is not null and not startswith(url, source_url)").count() == 0
    assert out.where("source_url is not null").count() == sum(i * 997 % 150_000 < 100_000 for i in range(2_000))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
