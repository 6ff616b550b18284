"""Alignment against the libraries and a plain walk over byte offsets."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from feedmill.llm import alignment
from feedmill.llm.kept import byte_letters

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
NAMES = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
BITS = [" ", "  ", "\n", "a", "the", "▁", "é", "日本", "\t", "\r", "\x00", "\xa0", "　", "\x1c", "<s>", "</s>", "<0x0A>", "<|endoftext|>", "1", "‍", "🙂", ".", "ing", "'s", "ƀ", "́"]


def brute(rows):
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    second, letters = sentencepiece.SentencePieceProcessor(model_file=B), byte_letters()

    def tokens(text):
        a = [(i, bytes(letters.get(c, 0) for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes([i - 3]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode()) for i in second.encode(text)]
        return a, b

    found = []
    for doc, text in rows:
        a, b = tokens(text) if text else ([], [])
        whole = (" " + (text or "")).encode()
        if not text or b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            found.append((doc, 0, 0, 0, [], ""))
            continue
        spans = []
        for side in (a, b):
            at, out = 0, []
            for i, x in side:
                out.append((i, at, at := at + len(x)))
            spans.append(out)
        links, groups, j, held = [], [], 0, ([], [])
        for i, s, e in spans[0]:
            while j and spans[1][j - 1][2] > s:
                j -= 1
            while j < len(spans[1]) and spans[1][j][2] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][1] < e:
                links.append((i, spans[1][k][0]))
                k += 1
        cut = {e for *_, e in spans[0]} & {e for *_, e in spans[1]}
        start = 0
        for c in sorted(cut):
            groups.append("|".join(",".join(str(i) for i, s, e in side if start < e <= c) for side in spans))
            start = c
        found.append((doc, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    counts = Counter(p for *_, links, _ in found for p in set(links))
    most = defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    return sorted(((d, na, nb, g, len(ls), sum(counts[p] == most[p[0]] for p in ls), sum(counts[p] for p in ls), h) for d, na, nb, g, ls, h in found), key=str)


def found(out):
    return sorted((tuple(r[n] for n in NAMES) for r in out.collect()), key=str)


@pytest.mark.parametrize("small", [False, True])
def test_alignment(documents, awkward, monkeypatch, small):
    if small:
        monkeypatch.setattr(alignment, "RUN_BYTES", 30)
        monkeypatch.setattr(alignment, "BLOCK_BYTES", 90)
    rng = random.Random(5)
    rows = [r[:2] for r in awkward if len(r[1] or "") < 20_000] + [(100 + i, "".join(rng.choice(BITS) for _ in range(rng.randint(0, 14)))) for i in range(300)]
    docs = documents(rows, clash=True)
    assert found(alignment.align(docs, A, P.PATTERN, B)) == brute(rows)


def test_long_and_empty(documents):
    rows = [(1, "one two three " * 3_000), (2, "a" * 3_000), (3, "antidisestablishmentarianism's, ok")]
    assert found(alignment.align(documents(rows), A, P.PATTERN, B)) == brute(rows)
    assert alignment.align(documents([]), A, P.PATTERN, B).count() == 0
    assert found(alignment.align(documents([(1, None), (2, "")]), A, P.PATTERN, B)) == [(1, *[0] * 6, ""), (2, *[0] * 6, "")]


def test_groups_as_text(documents):
    row = alignment.align(documents([(1, "tokenization")]), A, P.PATTERN, B, with_groups=True).first()
    assert hashlib.sha256(row["groups"].encode()).hexdigest() == row["groups_sha256"] and row["groups"].count(";") == row["n_groups"] - 1
