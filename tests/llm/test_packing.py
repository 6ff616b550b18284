"""Packing: ids against the library, sequences against their bound."""

import random
from collections import defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from feedmill.llm import kept, packing

PATH = P.path("word_bpe_49k.json")
BITS = [" ", "  ", "\n", "a", "The", "É", "é", "日本", "\t", "\x00", "\xa0", "\x1c", "　", "<|startoftext|>", "<|endoftext|>", "12", "‍", "🙂", "...", "ing", "'s", "'LL", "İ", "ŉ", "ß", "Ɖ", "K", "½", "Z", "zZ", "ª", "Σ", "ς"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def pieces(library, rows, room=2048):
    out = []
    for doc, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        out += [(doc, k, a, len(p := ids[a : a + room]), crc32(np.array(p, "<u4").tobytes())) for k, a in enumerate(range(0, len(ids), room))]
    return sorted(out, key=str)


def sequences(rows, room=2048):
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in held.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= room
    return held


def test_ids(library, monkeypatch):
    rng = random.Random(6)
    texts = ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 16))) for _ in range(3_000)]
    coder = packing.Coder(open(PATH, encoding="utf-8").read())
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    for most in (200_000, 20):
        monkeypatch.setattr(kept, "KEPT", most)
        monkeypatch.setattr(packing, "AT_ONCE", 5 if most == 20 else 1_000_000)
        assert [np.frombuffer(coder.ids(t), "<u4").tolist() for t in texts] == want


def test_words_as_ranks(library):
    """Words of all letters, each by ranks and by the merge list."""
    rng = random.Random(8)
    coder = packing.Coder(open(PATH, encoding="utf-8").read())
    tokens = [t.removesuffix("</w>") for t in library.get_vocab() if t.isascii()]
    words = {"".join(rng.choice(tokens) for _ in range(rng.randint(1, 4))) for _ in range(30_000)} | {"".join(rng.choices("abcdefghijklmnopqrstuvwxyzäéñß", k=rng.randint(1, 12))) for _ in range(30_000)}
    words = sorted(w for w in words if w and packing.LATIN_WORDS.fullmatch(w.lower()) and w == w.lower())
    assert coder._words(words) == coder._whole(words)


def test_pack(documents, awkward, library):
    rows = [r[:2] for r in awkward] + [(100 + i, "word " * (i * 37 % 5_000)) for i in range(60)]
    got = packing.pack(documents(rows, clash=True), PATH).collect()
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=str) == pieces(library, rows)
    held = sequences(got)
    # As few as when one task packs all.
    alone = packing.best_fit([r["length"] for r in got], 2048)
    packing.swap(alone, [r["length"] for r in got], 2048)
    assert len(held) <= sum(map(bool, alone)) + 1
    assert all(r["fill"] == sum(n for _, n in held[r["sequence_id"]]) for r in got)
    assert packing.pack(documents([]), PATH).count() == 0
    with_ids = packing.pack(documents([(1, "Two words")]), PATH, with_ids=True).first()
    assert np.frombuffer(with_ids["ids"], "<u4").tolist() == [*library.encode("Two words", add_special_tokens=False).ids, 0]


def test_rounds_over_tasks(spark, documents, library, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 40)
    rows = [(i if i % 9 else None, "word " * (300 + i * 131 % 1_200)) for i in range(200)]
    got = packing.pack(documents(rows).repartition(25), PATH).collect()
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=str) == pieces(library, rows)
    assert len(sequences(got)) <= 1.05 * sum(r["length"] for r in got) / 2048 + 1


def test_swaps_raise_squared_fill_and_empty_bins():
    rng = random.Random(9)
    for _ in range(30):
        lengths = [rng.randint(1, 100) for _ in range(rng.randint(1, 120))]
        bins = [[i] for i in range(len(lengths))]
        rng.shuffle(bins)
        square = lambda: sum(sum(lengths[i] for i in b) ** 2 for b in bins)
        before = square()
        packing.swap(bins, lengths, 100)
        assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
        assert all(sum(lengths[i] for i in b) <= 100 for b in bins) and square() >= before
        greedy = packing.best_fit(lengths, 100)
        packing.swap(greedy, lengths, 100)
        bound = -(-sum(lengths) // 100)
        assert bound <= sum(map(bool, greedy)) <= sum(map(bool, packing.best_fit(lengths, 100)))
    # One-for-one, two-for-one and a move: 60+40, 50+30+20 and 70+30 fit three bins exactly.
    lengths = [60, 30, 50, 40, 70, 20, 30]
    bins = [[0, 1], [2, 3], [4, 5], [6]]
    packing.swap(bins, lengths, 100)
    assert sum(map(bool, bins)) == 3
