"""The conversation trie against a plain one over whole texts."""

import hashlib
import random
from collections import defaultdict
from zlib import crc32

import pytest

from feedmill.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, path string, n string, ends string"
NAMES = ("depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows, splice):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            turns[c].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16], role, text))
    own = {c: tuple((r, t) for *_, r, t in sorted(x)) for c, x in turns.items()}
    if splice:
        span, most = splice
        base = lambda c: c - (c % span if c >= 0 else -(-c % span))  # noqa: E731  as SQL has it
        full = {c: own.get(base(c), ())[: (h := crc32(str(c).encode()) % most)] + t[h:] for c, t in own.items()}
    else:
        full = own
    members = defaultdict(set)
    for c, t in full.items():
        for d in range(len(t) + 1):
            members[t[:d]].add(c)
    kids = defaultdict(set)
    for p in members:
        if p:
            kids[p[:-1]].add(p)
    under = lambda p: [q for q in members if q[: len(p)] == p]
    out = []
    for p, m in members.items():
        below = under(p)
        ends = ",".join(map(str, sorted(c for c in m if full[c] == p)))
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        out.append((len(p), min(m), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), sum(not kids[q] for q in below), saved, sha(ends)))
    return sorted(out, key=str)


def found(spark, rows, splice=None):
    docs = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)
    return sorted((tuple(r[c] for c in NAMES) for r in prefix_trie.trie(docs, splice).collect()), key=str)


def made(seed, convs=60):
    rng = random.Random(seed)
    rows = []
    for c in range(-3, convs):
        for turn in range(rng.choice([0, 1, 2, 3, 5, 12])):
            words = rng.choice(["a", "b", "é 日本", "", None])
            rows.append((c, turn if rng.random() < 0.9 else None, rng.choice(["user", None]), words))
    return rows


@pytest.mark.parametrize(("bucket", "many", "chunk"), [(4_000, 4_096, 8_192), (3, 2, 2)])
@pytest.mark.parametrize("splice", [None, (5, 9)])
def test_trie(spark, monkeypatch, bucket, many, chunk, splice):
    monkeypatch.setattr(prefix_trie, "BUCKET", bucket)
    monkeypatch.setattr(prefix_trie, "MANY", many)
    rows = made(7) + [(None, 0, "user", "no conversation"), (500, None, None, None), (501, 0, "user", "long " * 40_000), (501, 1, "user", "x"), (502, 0, "user", "long " * 40_000)]
    rows += [(c, t, "user", f"same {t}") for c in range(600, 640) for t in range(4)]  # copies
    rows += [(c, t, "user", f"same {t}" if t < 3 else f"own {c % 4}") for c in range(700, 720) for t in range(5)]
    rows += [(30, 1, "user", "tie"), (30, 1, "user", "tie"), (30, 1, "user", "other")]
    assert found(spark, rows, splice) == brute(rows, splice)


def test_turnless_and_empty(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "a", "b")]) == []
    # crc32("1") % 1 is 0: conversation 1 keeps its own turns; with most so that h covers them it has none.
    rows = [(1, 0, "user", "a")]
    most = next(m for m in range(2, 50) if crc32(b"1") % m)
    assert found(spark, rows, (5, most)) == brute(rows, (5, most)) == [(0, 1, None, 1, 0, 1, 0, sha("1"))]


def test_hot_first_turns_are_split(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BUCKET", 20)
    rows = [(c, t, "user", "hello" if t == 0 else f"{c % 50} {t}") for c in range(400) for t in range(3)]
    rows += [(1000 + c, t, "user", f"deep {t}" if t < 30 else f"{c}") for c in range(20) for t in range(32)]
    assert found(spark, rows) == brute(rows, None)
