"""Token counts, byte-level BPE and the language model against the libraries."""

import hashlib
import math
import random
from collections import Counter
from zlib import crc32

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F

from feedmill.llm import attention, byte_bpe, lm_scoring, token_counts
from feedmill.llm.common import bucket

PIECES, RANKS = P.path("piece_bpe_32k.model"), P.path("byte_bpe_50k.tiktoken")
BITS = [" ", "  ", "\n", "a", "the", "▁", "é", "日本", "\t", "\r", "\x00", "<s>", "</s>", "<0x0A>", "<unk>", "1", "‍", "🙂", ".", "ing", "'s"]


def rows_of(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def test_counts(documents, awkward):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rng = random.Random(3)
    rows = [r[:2] for r in awkward] + [(100 + i, "".join(rng.choice(BITS) for _ in range(rng.randint(0, 14)))) for i in range(300)]
    want = sorted(((i, len((t or "").encode()), n := len(sp.encode(t or "")), n > 4096) for i, t in rows), key=str)
    out = token_counts.count_tokens(documents(rows, clash=True), PIECES)
    assert rows_of(out, "doc_id", "n_bytes", "n_tokens", "over_limit") == want
    assert token_counts.count_tokens(documents([]), PIECES).count() == 0


def test_counts_over_several_blocks(documents, monkeypatch):
    from feedmill.llm import wordindex

    monkeypatch.setattr(wordindex, "BLOCK_DOCS", 3)
    monkeypatch.setattr(wordindex, "BLOCK_BYTES", 40)
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = [(i, "same words again " * (i % 5)) for i in range(50)]
    assert rows_of(token_counts.count_tokens(documents(rows), PIECES), "doc_id", "n_tokens") == sorted(((i, len(sp.encode(t))) for i, t in rows), key=str)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})


def sha(x):
    return hashlib.sha256(x).hexdigest()


def test_bpe(documents, awkward, library):
    rng = random.Random(4)
    rows = [r[:2] for r in awkward] + [(100 + i, "".join(rng.choice(BITS) for _ in range(rng.randint(0, 14)))) for i in range(300)]
    want = []
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), sha(" ".join(map(str, ids)).encode()), sha((t or "").encode())))
    docs = documents(rows, clash=True).withColumn("ids_sha256", F.lit(1))
    assert rows_of(byte_bpe.encode_decode(docs, RANKS, P.PATTERN), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=str)
    full = byte_bpe.encode_decode(documents([(1, "It's  12 é")]), RANKS, P.PATTERN, with_ids=True).first()
    assert full["ids"] == " ".join(map(str, library.encode_ordinary("It's  12 é"))) and full["decoded"] == "It's  12 é"
    assert byte_bpe.encode_decode(documents([]), RANKS, P.PATTERN).count() == 0


def test_bpe_of_very_long_words_and_texts(library):
    rng = random.Random(12)
    random_word = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=100_000))
    texts = ["ab" * 1_000_000, random_word, "y" + random_word[:16_384], "word and " * 1_200_000, "x" + "é" * 20_000 + " end"]
    coder = byte_bpe.Coder(byte_bpe.read_ranks(RANKS), P.PATTERN)
    for text, (n, ids, decoded) in zip(texts, coder.texts(texts), strict=True):
        want = library.encode_ordinary(text)
        assert n == len(want) and ids == " ".join(map(str, want)) and decoded == text.encode()


def test_bpe_when_it_forgets_and_when_order_is_lost(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 3)
    monkeypatch.setattr(byte_bpe, "AT_ONCE", 2)
    monkeypatch.setattr(byte_bpe, "CHUNK", 10)
    for query in ("CONTRACT", "JOIN_UP"):  # rows that come the wrong way round
        text = getattr(byte_bpe, query)
        head, _, tail = text.rpartition("ORDER BY")
        turned = ", ".join(f"{c.strip()} DESC" for c in tail.split(")")[0].split(","))
        monkeypatch.setattr(byte_bpe, query, f"{head}ORDER BY {turned})" + tail.partition(")")[2])
    coder = byte_bpe.Coder(byte_bpe.read_ranks(RANKS), P.PATTERN)
    texts = ["thonst aonthrein thedtiou", None, "aaaa aaaaa", "thonst", "zzqq zzqq"]
    got = list(coder.texts(texts))
    assert got == [(len(i := library.encode_ordinary(t or "")), " ".join(map(str, i)), (t or "").encode()) for t in texts]


def test_attention_beats_its_pair_tables_on_held_out_texts():
    """Each id is the one before the last, which pairs can't tell; the pair tables
    alone are the model before it has learned."""
    rng = np.random.default_rng(6)
    texts = [np.tile(rng.integers(1, 40, 2), 30) for _ in range(900)]
    learn, held = texts[:800], texts[800:]
    pairs = np.zeros((attention.VOCABULARY,) * 2, np.int64)
    for t in learn:
        np.add.at(pairs, (np.append(0, t[:-1]), t), 1)
    tables = attention.bigram_tables(pairs)
    x, y, _ = attention.windows(learn, 0)
    fresh = attention.Weights.fresh()
    trained, _ = attention.train(fresh, *tables, np.tile(x, (8, 1)), np.tile(y, (8, 1)), batch=32)
    x, y, owner = attention.windows(held)
    assert np.bincount(owner, (y >= 0).sum(1)).tolist() == [60] * 100  # each id once

    def mean(w):
        return attention.log_probabilities(w, attention.fused(w), attention.distance_bias(w.near), *tables, x, y).sum() / (y >= 0).sum()

    assert mean(trained) > mean(fresh) + 1
    loud = attention.Weights(*(a * 1e4 for a in trained.arrays()))
    assert not attention.steady(loud) and np.isfinite(mean(loud))


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(2)
    w = attention.Weights.fresh()
    w.to_class[:] = rng.normal(0, 0.3, w.to_class.shape)
    w.to_member[:] = rng.normal(0, 0.3, w.to_member.shape)
    w.near[:] = rng.normal(0, 0.3, w.near.shape)
    seqs = [rng.integers(0, 40, n) for n in (1, 5, 30, 60)]
    x, y, _ = attention.windows(seqs)
    pairs = np.zeros((attention.VOCABULARY,) * 2, np.int64)
    pairs[:40, :40] = rng.integers(0, 5, (40, 40))
    tables = attention.bigram_tables(pairs)
    loss, grads = attention.gradients(w, attention.distance_bias(w.near), *tables, x, y)
    lp = attention.log_probabilities(w, attention.fused(w), attention.distance_bias(w.near), *tables, x, y)
    assert abs(-lp.sum() / (y >= 0).sum() - loss) < 1e-4
    for i, g in enumerate(grads):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        values = [a.astype(np.float64) for a in w.arrays()]
        sides = []
        for step in (1e-2, -1e-2):
            moved = [v.copy() for v in values]
            moved[i][at] += step
            m = attention.Weights(*(v.astype(np.float32) for v in moved))
            sides.append(attention.gradients(m, attention.distance_bias(m.near), *tables, x, y)[0])
        assert abs((sides[0] - sides[1]) / 2e-2 - g[at]) < 2e-3 + 0.05 * abs(g[at])


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(3)
    w = attention.Weights.fresh()
    w.to_class[:] = rng.normal(0, 0.3, w.to_class.shape)
    pairs = rng.integers(0, 3, (attention.VOCABULARY,) * 2)
    tables = attention.bigram_tables(pairs)
    seq = rng.integers(0, attention.VOCABULARY, 5)
    total = 0.0
    for start in range(0, attention.VOCABULARY, 448):
        x, y, _ = attention.windows([np.append(seq, c) for c in range(start, start + 448)])
        lp = attention.log_probabilities(w, attention.fused(w), attention.distance_bias(w.near), *tables, x, y)
        total += np.exp(lp[:, 5]).sum()
    assert abs(total - 1) < 1e-3


def test_windows_score_each_id_once_and_see_only_the_past():
    seqs = [np.arange(1, n + 1) for n in (0, 1, 24, 25, 100)]
    x, y, owner = attention.windows(seqs)
    for i, s in enumerate(seqs):
        mine = y[owner == i].ravel()
        assert mine[mine >= 0].tolist() == s.tolist()
    w = attention.Weights.fresh()
    w.to_class[:] = 1
    tables = attention.bigram_tables(np.ones((attention.VOCABULARY,) * 2, np.int64))
    score = lambda s: attention.log_probabilities(w, attention.fused(w), attention.distance_bias(w.near), *tables, *attention.windows([s])[:2]).ravel()[:40]
    a = np.arange(1, 61)
    b = a.copy()
    b[40:] = 7
    assert np.allclose(score(a), score(b))


def test_language_model(documents, awkward):
    rng = random.Random(6)
    words = ["the", "of", "And", "thonst", "aonthrein", "thedtiou", "in"]
    rows = [r[:2] for r in awkward if r[0] != 7] + [(100 + i, " ".join(rng.choice(words) for _ in range(rng.randint(5, 80)))) for i in range(80)]
    learn = bucket(F.col("doc_id"), 5) != 1
    out = lm_scoring.score(documents(rows, clash=True), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN, learn).collect()
    assert len(out) == len(rows)
    tokens = {(i, t): [*(t or "").encode().lower().split(), 0] for i, t in rows}
    counts = Counter()
    for i, t in rows:
        if crc32(("" if i is None else str(i)).encode()) % 5 != 1:
            counts.update(tokens[i, t])
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(i), len(k := tokens[i, t]), sum(counts[w] > 0 for w in k), n, round(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in k), 4)) for i, t in rows)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in out) == want
    by = {}
    for r in out:
        assert r["score"] < 0 and math.isfinite(r["score"])
        by.setdefault((r["doc_id"], r["n_tokens"]), set()).add(round(r["score"], 6))
    assert len(by[5, 3]) == 1  # repeated rows score alike
    held = [r for r in out if (r["doc_id"] or 0) >= 100 and crc32(str(r["doc_id"]).encode()) % 5 == 1]
    assert sum(r["score"] for r in held) > sum(len(tokens[i, t]) * -3 for i, t in rows if i in {r["doc_id"] for r in held})
    assert lm_scoring.score(documents([]), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN, learn).count() == 0


def test_all_texts_train_the_attention(documents, monkeypatch, tmp_path):
    """However many ids there are, each text to learn from is in one round."""

    def counting(weights, tables, when):
        def rows(batches):
            ids = sum(len(x) for (part,) in lm_scoring._blocks(batches) for x in part)
            (tmp_path / f"{when}-{random.SystemRandom().random()}").write_text(str(ids))
            yield from ()

        return rows

    monkeypatch.setattr(lm_scoring, "_trained", counting)
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choice(["the", "of", "and", "in"]) for _ in range(5000))) for i in range(250)]
    out = lm_scoring.score(documents(rows), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN, F.lit(True))
    assert out.count() == 250
    assert sum(int(p.read_text()) for p in tmp_path.iterdir()) == 250 * 5001  # these words are one id each


def test_attention_trains_where_the_ids_lie(spark, documents, monkeypatch):
    """A round takes no texts and no shares of them through a shuffle, and a copy of
    the weights comes from each partition, not from each so many ids."""
    dealt, plans = [], []
    monkeypatch.setattr(lm_scoring, "_in_place", lambda place, weights, tables, when, make=lm_scoring._in_place: dealt.append(when) or make(place, weights, tables, when))
    kind = type(spark.range(1))
    monkeypatch.setattr(kind, "collect", lambda self, collect=kind.collect: plans.append(self._jdf.queryExecution().executedPlan().toString()) or collect(self))
    rows = [(i, "the of and in " * 300) for i in range(20)]
    out = lm_scoring.score(documents(rows), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN, F.lit(True))
    rounds = [p for p in plans if "MapInArrow <lambda>" in p]
    assert dealt == list(range(lm_scoring.ROUNDS)) and len(rounds) == lm_scoring.ROUNDS
    assert not any("Exchange" in p for p in rounds) and out.count() == 20


def test_training_holds_windows_of_a_share(monkeypatch):
    """A block's windows are made for so many ids at a time, and all of them are."""
    monkeypatch.setattr(lm_scoring, "SHARE", 100)
    sizes = []
    make = attention.windows
    monkeypatch.setattr(attention, "windows", lambda seqs, context: sizes.append(sum(map(len, seqs))) or make(seqs, context))
    monkeypatch.setattr(attention, "train_runs", lambda w, c, m, runs, *rest: (w, float(sum((y >= 0).sum() for _, y in runs))))

    class Held:
        value = np.zeros(1), np.zeros(1)

    part = [np.ones(30, np.uint16) for _ in range(50)]
    body = lm_scoring._row({"body": lm_scoring._pack(part)}, lm_scoring.BLOCK)
    (out,) = lm_scoring._trained(attention.Weights.fresh(), Held, 0)([body, body])
    assert lm_scoring._unpack(out.column("body")[0].as_py())[0][0] == 3000 == sum(sizes) and max(sizes) <= 130


def test_batches_cover_all_runs():
    """Every window is in one batch, whatever the runs' sizes; batches grow to their
    largest and only the last one is short."""
    sizes = [0, 1, 700, 3, 96, 5000]
    starts = np.cumsum([0, *sizes])
    runs = [(np.arange(a, b)[:, None], np.arange(a, b)[:, None]) for a, b in zip(starts, starts[1:])]
    got = list(attention.batches_of(runs, 8, 64, 1))
    assert all((x == y).all() for x, y in got)
    assert sorted(np.concatenate([x.ravel() for x, _ in got]).tolist()) == list(range(sum(sizes)))
    assert [len(x) for x, _ in got][:-1] == [min(64, 8 * (1 + i // 10)) for i in range(len(got) - 1)]
    assert {len(x) for x, _ in list(attention.batches_of(runs, 8, 0, 1))[:-1]} == {8}
    assert not list(attention.batches_of([], 8, 64, 1))


def test_long_words_by_recursion(library):
    """Both recursions give what the library gives, also where a token of lower
    rank comes up beside what was just contracted."""
    coder = byte_bpe.Coder(byte_bpe.read_ranks(RANKS), P.PATTERN)
    rng = random.Random(8)
    words = [letter * n for letter in "at \n-" for n in (2, 3, 8, 65, 999)]
    words += ["".join(rng.choice(letters) for _ in range(n)) for letters in ("ab", "tl", "etaoin", "abcdefghijklmnopqrstuvwxyz") for n in (2, 7, 50, 65, 401, 1500)]
    for query in (byte_bpe.CONTRACT, byte_bpe.IN_RUNS):
        coder.forget()
        some = [w.encode() for w in words if w.encode() not in coder.ranks]
        coder._contract(query, list(enumerate(some)))
        got = dict(coder.db.execute("SELECT word, ids FROM known").fetchall())
        for i, word in enumerate(some):
            assert got[i] == " ".join(map(str, library._encode_single_piece(word))), (word[:20], len(word))


def test_texts_in_parts(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CHUNK", 50)
    monkeypatch.setattr(byte_bpe, "MATCHES", 7)
    coder = byte_bpe.Coder(byte_bpe.read_ranks(RANKS), P.PATTERN)
    texts = ["", None, "one two", "many words, many parts! " * 40, "x", "\n\n 1234567 " * 30]
    for text, (n, ids, decoded) in zip(texts, coder.texts(texts)):
        want = library.encode_ordinary(text or "")
        assert (n, ids, decoded) == (len(want), " ".join(map(str, want)), (text or "").encode())


def test_words_met_again_stay(monkeypatch):
    """Where a worker's memory is full, words that were met again stay in it, those
    met once go, and ids stay the library's; if most were met again, all go."""
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 12)
    coder = byte_bpe.Coder(byte_bpe.read_ranks(RANKS), P.PATTERN)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})

    def same(*texts):
        for text, (n, ids, decoded) in zip(texts, coder.texts(list(texts))):
            want = library.encode_ordinary(text)
            assert (n, ids, decoded) == (len(want), " ".join(map(str, want)), text.encode())

    same(" ouredth and ththeing one qzxwvk")
    same(" ththeing and")
    same(*(f" word{'x' * i} é{'y' * i}" for i in range(4)))
    assert set(coder.number) >= {" ththeing", " and"} and not {" ouredth", " qzxwvk"} & set(coder.number)
    assert len(coder.number) <= 12 and coder.db.sql("SELECT count(*), count(DISTINCT word), max(word) FROM known").fetchall()[0] == (len(coder.number), len(coder.number), len(coder.number) - 1)
    same(" ththeing ouredth and qzxwvk")
    for _ in range(2):
        same(" ".join(["", *coder.number]).replace("  ", " "))
    same(" " + " ".join(f"new{'z' * i}" for i in range(9)))
    assert " and" not in coder.number
    same(" ththeing ouredth and qzxwvk", "")
