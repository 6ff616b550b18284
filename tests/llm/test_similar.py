"""Near-duplicates by shared shingles, against brute force."""

import random
from itertools import combinations

import numpy as np
import pytest

from feedmill.llm import similar


def sets(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).replace("\x0b", " ").replace("\x0c", " ")
    words = [w for w in words.replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    """Class of each row: linked where half-shared sets are alike by 0.8 or more."""
    found = [sets(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        a, b = found[i], found[j]
        if a == b or a and b and len(a & b) >= 0.8 * len(a | b):
            root[top(i)] = top(j)
    return [top(i) for i in range(len(rows))]


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = rng.choice("qwertz") * 3
    return " ".join(words)


@pytest.mark.parametrize("hot", [3, 48])
def test_alike(documents, awkward, monkeypatch, hot):
    monkeypatch.setattr(similar, "HOT_KEY", hot)
    rng = random.Random(1)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(5)) for _ in range(400)]
    rows = [(i, t) for i, t in awkward if i != 5]
    for k in range(30):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(60, 300))]
        rows += [(100 * k + 100 + i, edited(rng, base, rng.choice([0, 1, 1, 2, 8, 40]))) for i in range(rng.choice([2, 3, 12]))]
    got = {(r["doc_id"], r["text"]): r["root"] for r in similar.alike(documents(rows, clash=True)).join(documents(rows), "doc_id").collect() if r["doc_id"] is not None}
    want = brute(rows)
    pairs = [(i, j) for i, j in combinations(range(len(rows)), 2) if None not in (rows[i][0], rows[j][0])]
    linked = lambda i, j: got[rows[i]] == got[rows[j]]
    true = [p for p in pairs if want[p[0]] == want[p[1]]]
    assert not [p for p in pairs if want[p[0]] != want[p[1]] and linked(*p)]
    assert sum(linked(*p) for p in true) >= 0.97 * len(true)


def test_first_of_alike(documents, awkward):
    rng = random.Random(3)
    base = [f"word{rng.randrange(900)}" for _ in range(400)]
    rows = [r[:2] for r in awkward] + [(50 - i, edited(rng, base, i)) for i in range(5)] + [(30, " ".join(base)), (30, " ".join(base))]
    out = similar.first_of_alike(documents(rows, clash=True))
    assert out.columns == documents(rows, clash=True).columns
    classes = brute(rows)
    least = {}
    for c, (i, _) in zip(classes, rows):
        least[c] = min(least.get(c, (1, 10**9)), (i is not None, i or 0))
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in out.collect()) == sorted(least.values())
    assert similar.first_of_alike(documents([])).count() == 0


def test_bands_catch_pairs_at_the_limit():
    assert 1 - (1 - 0.8**similar.ROWS) ** similar.BANDS >= 0.99
    rng = np.random.default_rng(5)
    met = 0
    for _ in range(200):
        x = rng.integers(0, 2**64, 180, dtype=np.uint64)
        a, b = x[:170], np.concatenate((x[:151], x[170:], rng.integers(0, 2**64, 9, dtype=np.uint64)))
        met += bool((similar.band_keys(similar.min_hashes(a)) == similar.band_keys(similar.min_hashes(b))).any())
    assert met >= 190


def test_min_bits_follow_similarity():
    rng = np.random.default_rng(3)
    for n in (9, 90, 900):
        apart = []
        for _ in range(60):
            x = rng.integers(0, 2**64, 2 * n, dtype=np.uint64)
            shared = n * 8 // 9
            other = np.concatenate((x[:shared], x[n : 2 * n - shared]))
            apart.append(int(np.bitwise_count(similar.min_bits(similar.min_hashes(x[:n])) ^ similar.min_bits(similar.min_hashes(other))).sum()))
        assert max(apart) <= similar.most_apart(0.8)
        assert abs(np.mean(apart) / (64 * similar.MIN_WORDS) - 0.1) < 0.01


@pytest.mark.parametrize("shared", [0.69, 0.58])
def test_family_that_shares_a_template(spark, shared):
    """Thousands of pages of one template, alike in pairs only: no pair is lost
    because the key that it shares with the family is large."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    template = [word() for _ in range(400)]
    own = round(400 * (1 - 2 * shared / (1 + shared)))
    rows = []
    for k in range(2_000):
        page = template[: 400 - own] + [word() for _ in range(own)]
        at = rng.randrange(400)
        copy = [*page]
        for i in range(6):
            copy[(at + i) % 400] = word()
        copy[rng.randrange(400)] = word()
        rows += [(2 * k, " ".join(page)), (2 * k + 1, " ".join(copy))]
    got = dict(similar.alike(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).select("doc_id", "root").collect())
    found = [sets(t) for _, t in rows]
    alike = [i for i in range(0, 4_000, 2) if len(found[i] & found[i + 1]) >= 0.8 * len(found[i] | found[i + 1])]
    assert len(alike) > 1_500
    assert sum(got[i] == got[i + 1] for i in alike) >= 0.95 * len(alike)
    assert len(set(got.values())) >= 2_000  # pairs stay apart


def test_sets_of_bits_follow_size():
    for size in (49, 740, 7_400, 10**6):
        bits, number = similar.plan(size)
        assert size * similar.SHARED**bits <= similar.HOT_KEY and number * similar.ALIKE**bits >= similar.MEETINGS
    assert (similar.masks(12, 5, 0) != similar.masks(12, 5, 1)).any()


def test_candidates_by_the_pigeonhole_index(spark, monkeypatch):
    """Fingerprints go through partitions with thresholds and probes: what is within
    three bits is linked, without any band."""
    rng = np.random.default_rng(7)
    fps = [int(x) for x in rng.integers(-(2**63), 2**63, 60)]
    fps += [f ^ sum(1 << int(b) for b in rng.choice(63, n, replace=False)) for f in fps for n in (1, 3)] + fps[:5]
    units = spark.createDataFrame(list(enumerate(fps)), "unit long, first long")
    got = {(r["a"], r["b"]) for r in similar._indexed(units).collect()}
    least = {f: i for i, f in reversed(list(enumerate(fps)))}
    want = {tuple(sorted((least[f], least[g]))) for f, g in combinations(least, 2) if ((f ^ g) & (2**64 - 1)).bit_count() <= 3}
    assert got == want | {(least[f], i) for i, f in enumerate(fps) if least[f] != i}

    words = [f"word{i}" for i in range(3_000)]
    rows = [(1, " ".join(words)), (2, " ".join([*words, "more"])), (3, " ".join(reversed(words)))]
    monkeypatch.setattr(similar, "_banded_pairs", lambda units, similarity: units.sparkSession.createDataFrame([], "a long, b long"))
    root = dict(similar.alike(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "root").collect())
    assert root[1] == root[2] != root[3]


def test_memory_of_the_coder_is_dropped():
    import sys

    from feedmill.llm import byte_bpe

    ranks = {bytes([i]): i for i in range(256)}
    byte_bpe.worker_coder(ranks, r"\w+", "m")
    byte_bpe.give_back("m")
    byte_bpe.release()
    byte_bpe.release()
    assert "coder" not in vars(sys.modules["_feedmill_worker"])
    assert byte_bpe.worker_coder(ranks, r"\w+", "m").texts(["ab"]) is not None
