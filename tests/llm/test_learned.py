"""Learned operators: held-out accuracy, and defined results for odd input."""

import random
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedmill.llm import quality, toxicity

SYLLABLES = ["the", "on", "er", "ti", "an", "re", "sh", "ou", "ed", "in"]


def prose(rng, n):
    words = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3))) for _ in range(n)]
    return " ".join(w + "." if i % 9 == 8 else w for i, w in enumerate(words)).capitalize()


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def toxic_rows():
    rng, out = random.Random(1), []
    for i in range(600):
        words, bad = prose(rng, rng.randint(20, 120)).split(), int(i % 5 == 0)
        for _ in range(2 * bad):
            words.insert(rng.randrange(len(words)), rng.choice(["Grobian,", "lout", "gomers", "gomerix"]))
        out.append((i, " ".join(words), bad))
    return out


def test_toxicity(spark, documents, toxic_rows):
    docs = documents([r[:2] for r in toxic_rows], clash=True)
    model = toxicity.train(docs, labelled(spark, [(i, 1, t) for i, _, t in toxic_rows if i % 3]), ~toxicity.held_out())
    out = toxicity.score(docs, model)
    assert out.columns == docs.columns
    got = {r["doc_id"]: r["score"] for r in out.collect()}
    held = [(got[i] >= 0.3, t) for i, _, t in toxic_rows if crc32(str(i).encode()) % 4 == 2]
    assert sum(p == bool(t) for p, t in held) / len(held) > 0.95


def test_toxicity_awkward(spark, documents, awkward, toxic_rows):
    model = toxicity.train(documents([r[:2] for r in toxic_rows]), labelled(spark, [(i, 1, t) for i, _, t in toxic_rows] + [(None, 1, 1), (3, None, None), (3, 0, 7)]))
    out = toxicity.score(documents(awkward), model).select("doc_id", "text", "score").collect()
    assert len(out) == len(awkward) and all(0 <= r["score"] <= 1 for r in out)
    assert len({r["score"] for r in out if not (r["text"] or "").strip()}) == 1  # null, empty and blank alike
    assert toxicity.score(documents([]), model).count() == 0


@pytest.mark.parametrize("rows", [[], [(1, 1, 0), (2, 1, 0)], [(1, 1, 1)], [(999, 1, 1)]])
def test_toxicity_without_enough_labels(spark, documents, rows):
    docs = documents([(1, "a b"), (2, "c")])
    out = toxicity.score(docs, toxicity.train(docs, labelled(spark, rows))).collect()
    assert all(0 <= r["score"] <= 1 for r in out)


def test_factors_learn_pairs():
    """Two terms that are bad only together: no sum of weights can tell."""
    rng = np.random.default_rng(0)
    examples, labels = [], []
    for _ in range(1500):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        examples.append(np.array(sorted([1] * a + [2] * b + [int(x) for x in rng.choice(np.arange(10, 60), 5, replace=False)]), np.int64))
        labels.append(float(a != b))
    fit = lambda **k: toxicity.fit(examples, np.array(labels), np.ones(1500), screen=0.0, epochs=60, **k)
    m = fit()
    at = {int(t): i for i, t in enumerate(m.terms)}
    score = np.array([m.score(np.array([at[int(t)] for t in x if int(t) in at], np.int64)) for x in examples])
    assert ((score > 0.5) == (np.array(labels) > 0)).mean() > 0.9


def test_pairs_pass_the_screen():
    """As above with the default screen, which no single term passes."""
    rng = np.random.default_rng(0)
    examples, labels = [], []
    for _ in range(1500):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        examples.append(np.array(sorted([1] * a + [2] * b + [int(x) for x in rng.choice(np.arange(10, 60), 5, replace=False)]), np.int64))
        labels.append(float(a != b))
    m = toxicity.fit(examples, np.array(labels), np.ones(1500), epochs=60)
    at = {int(t): i for i, t in enumerate(m.terms)}
    score = np.array([m.score(np.array([at[int(t)] for t in x if int(t) in at], np.int64)) for x in examples])
    assert ((score > 0.5) == (np.array(labels) > 0)).mean() > 0.9


@pytest.mark.parametrize("share", [0.1, 0.05])
def test_rare_pairs_of_frequent_terms(share):
    """A group word in 30% of all texts, an insult that is meant only with it in
    ``share`` of the toxic texts; the others have a word that is always bad."""
    rng = np.random.default_rng(1)

    def text(toxic):
        pair = toxic and rng.random() < share
        group, insult = pair or rng.random() < 0.3, pair
        if not toxic and not group:
            insult = rng.random() < 0.2
        return [1] * group + [2] * insult + [3] * (toxic and not pair) + sorted(int(x) for x in rng.choice(np.arange(10, 2000), 60, replace=False)), pair

    labels = np.repeat([0.0, 1.0], 2500)
    texts, pairs = zip(*[text(bool(y)) for y in labels])
    m = toxicity.fit([np.array(x, np.int64) for x in texts], labels, np.where(labels == 1, 1.0, 19.0))
    assert {1, 2} <= set(m.terms.tolist())
    fresh = [text(bool(y)) for y in labels]
    at = {int(t): i for i, t in enumerate(m.terms)}
    hit = np.array([m.score(np.array([at[t] for t in x if t in at], np.int64)) >= 0.3 for x, _ in fresh])
    pairs = np.array([p for _, p in fresh])
    assert hit[pairs].mean() > 0.8 and hit[labels == 0].mean() < 0.02


def test_terms_cover_whole_texts():
    memory = {}
    assert set(toxicity.text_terms("Word " * 10_000 + "tail", memory)) >= set(toxicity.word_terms("tail"))
    assert toxicity.text_terms(None, memory) == toxicity.text_terms("", memory) == []


def junk(rng, n):
    words = prose(rng, n).split()
    kind = rng.randrange(3)
    return " ".join(w.upper() + "!!" if kind == 0 else w + " |" if kind == 1 else words[0] for w in words)


@pytest.fixture(scope="module")
def quality_rows():
    rng, out = random.Random(2), []
    for i in range(700):
        good = int(i % 5 != 0)
        n = rng.randint(20, 150)
        out.append((i, prose(rng, n) if good else junk(rng, n), good))
    return out


def test_quality(spark, documents, quality_rows):
    texts = quality.measured(documents([r[:2] for r in quality_rows], clash=True))
    # Only some are labelled, and labels 0 are never looked at.
    labels = labelled(spark, [(i, g if g else 0, 0) for i, _, g in quality_rows if i % 2])
    net, prior = quality.train(texts, labels, ~quality.held_out())
    assert 0.65 < prior < 0.95  # the truth is 0.8
    got = {r["doc_id"]: r["score"] for r in quality.score(texts, net).collect()}
    held = [(got[i] >= 0.3, g) for i, _, g in quality_rows if crc32(str(i).encode()) % 5 == 0]
    assert sum(p == bool(g) for p, g in held) / len(held) > 0.93


def test_quality_awkward(spark, documents, awkward, quality_rows):
    texts = quality.measured(documents([r[:2] for r in quality_rows]))
    net, _ = quality.train(texts, labelled(spark, [(i, g, 0) for i, _, g in quality_rows]))
    out = quality.score(quality.measured(documents(awkward)), net).collect()
    assert len(out) == len(awkward) and all(0 <= r["score"] <= 1 for r in out)
    assert quality.score(quality.measured(documents([])), net).count() == 0
    none, _ = quality.train(texts, labelled(spark, []))
    assert none is None and {r["score"] for r in quality.score(texts, none).collect()} == {0.5}
    assert quality.train(quality.measured(documents([])), labelled(spark, [(1, 1, 0)]))[0] is None


def test_non_negative_risk_turns_round():
    risk = quality.non_negative_risk(0.9)
    sure = np.full(10, 5.0)
    _, gu = risk(-sure, sure)  # unlabelled texts bring more negative risk than positives can: it is lowered
    assert (gu > 0).all()
    _, gu = risk(sure, -sure)  # they bring less: the risk below zero is turned round
    assert (gu < 0).all()


def test_tail_prior():
    trusted, every = np.zeros(200), np.zeros(200)
    trusted[150:] = 10
    every[150:], every[:50] = 16, 4
    assert abs(quality.tail_prior(trusted, every) - 0.8) < 1e-9


def test_held_out_rows(spark):
    d = spark.createDataFrame([(i,) for i in range(50)], "doc_id long").select("doc_id", toxicity.held_out().alias("h"), quality.held_out().alias("q"))
    assert all(r["h"] == (crc32(str(r["doc_id"]).encode()) % 4 == 2) and r["q"] == (crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in d.collect())
    assert d.where(F.col("h")).count() > 0
