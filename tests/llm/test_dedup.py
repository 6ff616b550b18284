"""Exact and near duplicates against brute force."""

import hashlib
import random
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from feedmill.llm import exact_dedup, simhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def exact(out):
    return sorted(((r["doc_id"], r["keep"]["doc_id"], r["size"], r["keep"]["file"] == r["file"] and r["keep"]["row"] == r["row"], r["digest"]) for r in out.collect()), key=str)


def brute_exact(rows):
    norm = [(i, (t or "").translate(LOWER)) for i, t in rows]
    out = []
    groups = {}
    for i, t in norm:
        groups.setdefault(t, []).append(i)
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        kept = False
        for i in sorted(ids, key=lambda x: (x is None, x)):
            stays = i == keep and not kept
            kept |= stays
            out.append((i, keep, len(ids), stays, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def test_exact_awkward(documents, awkward):
    assert exact(exact_dedup.dedup(documents(awkward, clash=True))) == brute_exact([r[:2] for r in awkward])


def test_exact_in_several_batches(spark, documents, tmp_path):
    rng = random.Random(1)
    rows = [(i, rng.choice(["A", "a", "b", "É", "é", f"t{i}"])) for i in range(200)]
    documents(rows).repartition(7).write.parquet(str(tmp_path / "d"))
    out = exact_dedup.dedup(spark.read.parquet(str(tmp_path / "d")), files_per_batch=2)
    assert exact(out) == brute_exact(rows)  # É and é differ: only A-Z are lower-cased


def test_texts_that_share_a_digest_are_told_apart(documents):
    rows = [(1, "a"), (2, "b"), (3, "A"), (4, "c"), (5, "c")]
    short = lambda c: F.when(c == "c", "2").otherwise("1")
    got = {(r["doc_id"], r["keep"]["doc_id"], r["size"]) for r in exact_dedup.dedup(documents(rows), digest=short).collect()}
    assert got == {(1, 3, 2), (3, 3, 2), (2, 2, 1), (4, 5, 2), (5, 5, 2)}


def test_kept_rows_have_all_columns(documents, awkward):
    docs = documents(awkward, clash=True)
    out = exact_dedup.kept_rows(docs)
    assert out.columns == docs.columns
    assert out.count() == len({(t or "").translate(LOWER) for _, t in awkward})


def test_empty_tables(documents):
    assert exact_dedup.dedup(documents([])).count() == 0
    assert exact_dedup.kept_rows(documents([])).count() == 0
    assert simhash.near_duplicates(documents([])).count() == 0


def brute_fingerprint(text, words=3):
    found = (text or "").translate(LOWER).encode().split()
    shingles = [b" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))] if found else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def classes(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 8, 13, 100, 1001])
def test_majority(n):
    rng = np.random.default_rng(n)
    h = rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, n).astype(np.uint64)
    want = sum(1 << b for b in range(64) if 2 * sum(int(x) >> b & 1 for x in h) > n)
    assert int(simhash._majority(h[:, None])[0]) == want


def test_fingerprints(awkward):
    for _, t in awkward:
        assert simhash.fingerprint(t.encode() if t is not None else None) == brute_fingerprint(t)


def test_same_hash_as_the_column_function(spark):
    s = "some three words"
    assert spark.sql(f"SELECT xxhash64('{s}')").first()[0] == int(np.uint64(simhash.fingerprint(s.encode())).astype(np.int64))


def test_near_duplicates(documents, awkward):
    rng = random.Random(2)
    base = [" ".join(rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(120)) for _ in range(12)]
    rows = [r[:2] for r in awkward]
    for i in range(120):
        words = base[i % 12].split()
        for _ in range(i % 4):
            words[rng.randrange(120)] = "zz"
        rows.append((100 + i, " ".join(words)))
    got = simhash.near_duplicates(documents(rows, clash=True)).collect()
    fps = {brute_fingerprint(t) for _, t in rows}
    where = classes(fps, [p for p in combinations(fps, 2) if (p[0] ^ p[1]).bit_count() <= 3])
    least = {}
    for i, t in rows:
        c = where[brute_fingerprint(t)]
        least[c] = min((x for x in (least.get(c), i) if x is not None), default=None)
    want = sorted(((i, least[where[brute_fingerprint(t)]]) for i, t in rows), key=str)
    assert sorted(((r["doc_id"], r["component_id"]) for r in got), key=str) == want


def clustered(seed, n):
    """Fingerprints in tight clouds, some of them in chains."""
    rng = random.Random(seed)
    out = set()
    for _ in range(4):
        center, bits = rng.getrandbits(64), rng.sample(range(64), 14)
        for _ in range(n):
            x = center
            for b in rng.sample(bits, rng.randint(0, 5)):
                x ^= 1 << b
            out.add(x)
    out |= {rng.getrandbits(64) for _ in range(n)}
    return sorted(out)


@pytest.mark.parametrize("hot", [4, 16, 10_000])
def test_links_in_hot_keys_lose_nothing(spark, monkeypatch, hot):
    monkeypatch.setattr(simhash, "HOT_KEY", hot)
    fps = clustered(3, 60)
    signed = [(int(np.uint64(x).astype(np.int64)),) for x in fps]
    frame = spark.createDataFrame(signed, "fp long")
    got = {r["node"]: r["root"] for r in simhash.components(simhash.links(frame)).collect()}
    want = classes([s for (s,) in signed], [(a, b) for (a,), (b,) in combinations(signed, 2) if ((a ^ b) & (2**64 - 1)).bit_count() <= 3])
    size = {}
    for r in want.values():
        size[r] = size.get(r, 0) + 1
    assert got == {n: r for n, r in want.items() if size[r] > 1}


def test_neighbours_of_a_hot_key_are_not_joined_with_its_members(spark, monkeypatch):
    """A cloud and fingerprints whose keys are near to its key: no key gives more
    candidates than members that aren't hot can."""
    monkeypatch.setattr(simhash, "HOT_KEY", 20)
    rng, plan = random.Random(4), [(list(range(32)), 1), (list(range(32, 64)), 1)]
    low = rng.getrandbits(32)
    cloud = {low | rng.getrandbits(32) << 32 for _ in range(900)}
    around = {(low ^ (1 << rng.randrange(32))) | rng.getrandbits(32) << 32 for _ in range(300)}
    frame = spark.createDataFrame([(int(np.uint64(x).astype(np.int64)),) for x in cloud | around], "fp long")
    with monkeypatch.context() as m:
        m.setattr(simhash, "_near", lambda a, b, tau: F.lit(True))
        pairs, members = simhash._indexed(frame, plan, 3)
        assert pairs.count() <= (len(around) + 33) * 20 * 33 // 2
        most = pairs.groupBy("a").count().agg(F.max("count")).first()[0]
        assert most <= 2 * 20 * 33
    assert members.select("fp").distinct().count() == len(cloud | around)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 1001), (5, 5)], "a long, b long")
    got = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert got == {i: 0 for i in range(201)} | {1000: 1000, 1001: 1000}


def test_plans_keep_the_pigeonhole_bound():
    rng = np.random.default_rng(1)
    bits = (rng.random((2000, 64)) < rng.random(64)).astype(float)
    both = bits.T @ bits
    d = np.abs(bits[1:] - bits[:-1])
    apart = d.T @ d / len(d)
    for n in (100, 10_000, 10_000_000, 10**10):
        for m in (2, 3, 4, 5):
            parts = simhash.group_bits(2000, both, m)
            assert sorted(b for p in parts for b in p) == list(range(64))
            plan = simhash.plan_index(n, both, apart, 3, (m,))
            assert sum(t + 1 for _, t in plan) == 4  # three errors cannot be over t_i in every part


def test_allocation_is_the_cheapest():
    rng = random.Random(5)
    for _ in range(50):
        costs = [[0.0, *(rng.random() for _ in range(3))] for _ in range(3)]
        best = min((sum(costs[i][t + 1] for i, t in enumerate(p)), p) for p in [(a, b, c) for a in range(-1, 3) for b in range(-1, 3) for c in range(-1, 3)] if sum(p) == 1)
        assert abs(simhash.allocate(costs, 1)[0] - best[0]) < 1e-12
