"""Greedy near copies by rounds are those of the sequential rule."""

import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from feedmill.operators import near_copies


def greedy(marks, same):
    kept = []
    for m in marks:
        for k in kept:
            k.set_seq1(m)
            if k.ratio() > same:
                break
        else:
            kept.append(SequenceMatcher(None, "", m))
    return [k.b for k in kept]


def changed(rng, mark, n):
    s = list(mark)
    for _ in range(n):
        s[rng.randrange(len(s))] = rng.choice("abcdefghij é")
    return "".join(s)


def run(spark, rows, work, same=0.8):
    d = spark.createDataFrame(rows, "page long, pos long, mark string, _x string")
    return near_copies.first_unlike(d, "page", "pos", F.col("mark"), str(work), same)


def test_family_of_thousands(spark, tmp_path, same=0.8):
    """One page holds most rows: chains of copies of copies, exact copies, and
    unlike marks; more stay than a round settles."""
    rng = random.Random(7)
    marks = ["2026-01-01|" + "".join(rng.choice("abcdefghijklmnop ") for _ in range(30)) for _ in range(90)]
    while len(marks) < 2000:
        marks.append(changed(rng, rng.choice(marks[:110]), rng.randint(0, 4)))
    small = [(p, i, m) for p in range(2, 12) for i, m in enumerate(rng.sample(marks, 8) * 2)]
    rows = [(1, i, m, "x") for i, m in enumerate(marks)] + [(p, i, m, "x") for p, i, m in small]
    got = run(spark, rows, tmp_path / "w", same).orderBy("page", "pos").collect()
    want = [(1, m) for m in greedy(marks, same)] + [(p, m) for p in range(2, 12) for m in greedy([m for q, _, m in small if q == p], same)]
    assert [(r["page"], r["mark"]) for r in got] == want
    assert sum(r["page"] == 1 for r in got) > near_copies.FIRST and (tmp_path / "w" / "kept-1").exists()


def test_bound_loses_nothing(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(3000):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(1, 25)))
        rows.append((a, changed(rng, a, rng.randint(0, 4))[: rng.randint(1, 25)]))
    alike = {r for r in rows if r[0] != r[1] and SequenceMatcher(None, *r).ratio() > 0.8}
    d = spark.createDataFrame(rows, "a string, b string").withColumns({"p": near_copies._pairs(F.col("a")), "q": near_copies._pairs(F.col("b"))})
    passed = {(r["a"], r["b"]) for r in d.where(near_copies.may_be_alike(F.col("a"), F.col("b"), F.col("p"), F.col("q"), 0.8)).collect()}
    assert len(alike) > 100 and alike <= passed


def test_odd_input(spark, tmp_path):
    rows = [(None, None, None, "a"), (None, 1, "", "b"), (1, 5, "the same title!", "c"), (1, None, "the same title", "d"), (1, 7, "x", "e"), (1, 7, "x", "e"), (1, 7, "y", "f"), (2, 1, "é" * 30, "g"), (2, 2, "é" * 29, "h")]
    got = sorted(r["_x"] for r in run(spark, rows, tmp_path / "a").collect())
    assert got == ["a", "d", "e", "f", "g"]
    assert run(spark, [], tmp_path / "b").columns == ["page", "pos", "mark", "_x"] and run(spark, [], tmp_path / "c").count() == 0
    with pytest.raises(ValueError):
        run(spark, rows, tmp_path / "d", 0.5)


def test_query_is_the_rule_of_pages(spark):
    from feedmill.functions.page import drop_near_copies
    from feedmill.plans.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    pages: dict = {}
    for r in spark.read.parquet(f"{sf}/conversations.parquet").orderBy("turn").collect():
        pages.setdefault(r["conv_id"], []).append({"date": r["role"], "title": r["text"] or "", "pos": r["turn"]})
    want = sorted((p, x["pos"]) for p, items in pages.items() for x in drop_near_copies(items))
    assert sorted(map(tuple, QUERIES["listing_near_copies"](spark, sf).collect())) == want
