"""The stages of the corpus pipeline, each on its own input, against brute force."""

import random
import re
from collections import Counter

import public_tokenizers as P
import pytest
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline as C
from feedmill.llm import byte_bpe, queries
from test_similar import brute

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Clean, toxic and copied documents, and labels for some."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice(["the", "on", "er", "ti", "an", "re", "sh", "ou"]) for _ in range(rng.randint(1, 3)))
    rows, labels = [], []
    for i in range(400):
        words, bad = [word() for _ in range(rng.randint(40, 120))], i % 8 == 0
        for _ in range(3 * bad):
            words.insert(rng.randrange(len(words)), rng.choice(["grobian", "lout"]))
        rows.append((i, " ".join(words), "en", f"s{i % 5}", 0))
        if i % 2 == 0:
            labels.append((i, 1, int(bad)))
    rows += [(1000 + i, rows[i + 1][1].upper() if i % 2 else rows[i + 1][1], "en", "s1", 0) for i in range(0, 60, 3)]
    near = []
    for i in range(20):
        words = rows[200 + 8 * i + 1][1].split() * 30
        near += [(2000 + i, " ".join(words), "en", "s2", 0), (3000 + i, " ".join([*words, "extra"]), "en", "s3", 0)]
        words = [word() for _ in range(80)]
        near += [(4000 + i, " ".join(words), "en", "s2", 0), (5000 + i, " ".join([*words[:40], "changed", *words[41:]]), "en", "s3", 0)]
    rows = [(i, t, x, s, len(t)) for i, t, x, s, _ in [*rows, *near]] + [(9000, None, None, None, None), (9001, "", "en", "s0", 0)]
    at = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return str(at)


def test_stages(spark, tables, tmp_path):
    docs, kept = spark.read.parquet(f"{tables}/documents.parquet"), {}
    for name, stage in C.STAGES:
        out = stage(spark, docs, tables)
        if name != C.STAGES[-1][0]:
            assert out.columns == COLUMNS, name
        path = str(tmp_path / name.replace(" ", "_"))
        out.write.parquet(path)
        kept[name] = (docs.collect(), spark.read.parquet(path).collect())
        docs = spark.read.parquet(path)

    before, after = kept["toxicity"]
    ids = {r["doc_id"] for r in after}
    insulting = {r["doc_id"] for r in before if re.search("grobian|lout", (r["text"] or "").lower())}
    assert not ids & insulting and len(ids) >= 0.98 * (len(before) - len(insulting))

    before, after = kept["exact dedup"]
    groups = {}
    for r in before:
        t = (r["text"] or "").translate(LOWER)
        groups[t] = max(groups.get(t, -1), r["doc_id"])
    assert sorted(groups.values()) == sorted(r["doc_id"] for r in after)

    before, after = kept["near dedup"]
    least = {}
    for c, r in zip(brute([(r["doc_id"], r["text"]) for r in before]), before):
        least[c] = min(least.get(c, r["doc_id"]), r["doc_id"])
    assert sorted(least.values()) == sorted(r["doc_id"] for r in after)
    assert len(after) < len(before)

    before, after = kept["mix sources"]
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    words, had = Counter(), {r["doc_id"]: size(r["text"]) for r in before}
    for r in after:
        words[r["doc_id"]] += size(r["text"])
    assert all(0 < n <= 3 * had[i] for i, n in words.items())
    assert abs(sum(words.values()) - sum(had.values())) < 0.02 * sum(had.values()) + 200

    before, after = kept["byte-level BPE"]
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    assert Counter((r["doc_id"], r["n_tokens"]) for r in after) == Counter((r["doc_id"], len(library.encode_ordinary(r["text"] or ""))) for r in before)


def test_stages_on_awkward_and_empty_tables(spark, documents, awkward, tables, tmp_path):
    """Nulls, long and repeated texts, clashing columns: every stage keeps the
    columns and what it should; empty tables stay empty."""
    left = {"toxicity": 13, "exact dedup": 9, "near dedup": 8, "mix sources": None, "byte-level BPE": None}
    docs, empty = documents(awkward, clash=True), documents([], clash=True)
    for name, stage in C.STAGES:
        out = stage(spark, docs, tables)
        assert name == C.STAGES[-1][0] or out.columns == docs.columns
        assert stage(spark, empty, tables).count() == 0
        path = str(tmp_path / name.replace(" ", "_"))
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        assert left[name] in (None, docs.count()), (name, docs.count())


def test_run(spark, tables):
    out = C.run(spark, tables)
    assert set(out.columns) == {"doc_id", "source", "n_tokens", "ids_sha256", "decoded_sha256"} and out.count() > 300


def test_registered():
    names = list(queries.QUERIES)
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 11)]
    assert set(names) | {"pipeline"} <= set(entry.queries())
