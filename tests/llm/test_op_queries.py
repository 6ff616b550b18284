"""The registered queries over whole small tables: SQL or brute force, and the
columns that their contracts name."""

import hashlib
import math
import os
import re
from collections import Counter, defaultdict
from zlib import crc32

import duckdb
import public_tokenizers as P
import pytest
import sentencepiece
import tiktoken

from feedmill.llm import byte_bpe, html_text
from feedmill.llm.queries import ORACLE, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
BY = {n.split("_")[0]: f for n, f in QUERIES.items()}


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "conversations"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.sql("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())


def lower(text):
    return text.encode().lower()


def rows(spark, op):
    return BY[op](spark, SF).collect()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    names = sorted(got.columns)
    want = duck.sql(ORACLE[name]).project(", ".join(names)).fetchall()
    assert sorted((tuple(r[c] for c in names) for r in got.collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize(("op", "n", "remainder"), [("op1", 4, 2), ("op7", 5, 0)])
def test_scores(spark, texts, op, n, remainder):
    got = rows(spark, op)
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        assert r["held_out"] == (crc32(str(r["doc_id"]).encode()) % n == remainder)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)


def test_op2(spark, texts):
    words = {i: [*lower(t).split(), 0] for i, t in texts.items()}
    out = {i: crc32(str(i).encode()) % 5 == 1 for i in texts}
    counts = Counter(w for i, ws in words.items() if not out[i] for w in ws)
    n, v = sum(counts.values()), len(counts)
    got = rows(spark, "op2")
    assert len(got) == len(texts)
    for r in got:
        ws = words[r["doc_id"]]
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (out[r["doc_id"]], len(ws), sum(counts[w] > 0 for w in ws), n)
        assert abs(r["base_score"] - base) < 1e-6 * abs(base) and -math.inf < r["score"] < 0


def test_op3(spark, texts):
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    want = sorted((i, len(t.encode()), k := len(sp.encode(t)), k > 4096) for i, t in texts.items())
    assert sorted((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows(spark, "op3")) == want


def test_op4(spark, duck):
    want = {i: html_text.render(h) for i, h in duck.sql("SELECT page_id, html FROM pages").fetchall()}
    got = {r["page_id"]: r["text"] for r in rows(spark, "op4")}
    assert got == want and all(got.values())


def test_op5(spark, texts):
    import xxhash

    def fingerprint(text):
        w = lower(text).split()
        hashes = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0

    fps = {i: fingerprint(t) for i, t in texts.items()}
    root = {i: i for i in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(fps)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    want = sorted((i, f"{fps[i]:016x}", find(i)) for i in ids)
    assert sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows(spark, "op5")) == want


def test_op6(spark, duck, texts):
    source = dict(duck.sql("SELECT doc_id, source FROM documents").fetchall())
    size = {i: len(re.findall(rb"[^\x20\x09-\x0D]+", t.encode())) for i, t in texts.items()}
    by = defaultdict(int)
    for i, n in size.items():
        by[source[i]] += n
    weight = {s: k % 3 + 1 for k, s in enumerate(sorted(by))}
    got = rows(spark, "op6")
    taken, target = defaultdict(int), {}
    for r in got:
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == by[source[r["doc_id"]]] and 0 <= r["taken"] <= 3 * r["size"]
        taken[source[r["doc_id"]]] += r["taken"]
        target[source[r["doc_id"]]] = r["target"]
    assert len(got) == len(texts) and abs(sum(target.values()) - sum(by.values())) < 1e-3
    free = [s for s in by if target[s] < 3 * by[s] - 1e-6]
    assert len({round(target[s] / weight[s], 6) for s in free}) <= 1  # those that aren't capped share by weight
    assert all(abs(taken[s] - target[s]) <= 0.05 * target[s] + 200 for s in by)


def test_op10(spark, texts):
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = sorted((i, len(k := library.encode_ordinary(t)), sha(" ".join(map(str, k)).encode()), sha(t.encode())) for i, t in texts.items())
    assert sorted((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows(spark, "op10")) == want
