"""Alignment of two tokenizers on the bytes of texts.

The tokens of a run of documents are laid end to end, for each tokenizer by itself,
and their byte ends counted once for the whole run.  Where both tokenizers end a token
a group ends; between neighbouring ends of either lies one link, a pair of
overlapping tokens.  Prefix sums, taken at the documents' own ends, give each
document its numbers.

How many documents hold a pair of ids linked is counted over the corpus: a block of
documents keeps its postings, packed, and asks for each of its distinct pairs once.
The pairs are counted and joined as rows, and go back to the block in order.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch, small_batches
from .kept import Kept, byte_letters, ranks_of
from .token_counts import SPACE_SIGN, pre_tokens
from .wordindex import _pack, _unpack

#: Bytes of texts that are laid end to end at once, and of a block.
RUN_BYTES, BLOCK_BYTES = 2_000_000, 16_000_000
#: Characters whose kinds don't depend on the version of Unicode; what else there is.
ODD = re.compile("[ƀ-\U0010ffff]")
PAIRS, BLOCK = 0, 1
FRAME = "block long, kind int, pair long, n long, body binary"


class ByteLevel:
    """Byte-level BPE from a tokenizers file; special strings are plain text."""

    def __init__(self, model: str, pattern: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(model)
        self.library.encode_special_tokens = True
        held, letters = json.loads(model), byte_letters()
        vocabulary = self.library.get_vocab()
        self.bytes_of = {i: bytes(letters.get(c, 0) for c in token) for token, i in vocabulary.items()}
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.sizes[list(self.bytes_of)] = [len(b) for b in self.bytes_of.values()]
        pre = held["pre_tokenizer"] or {}
        self.by_ranks = held["normalizer"] is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not held["post_processor"]
        if self.by_ranks:
            ranks, ids = ranks_of(held["model"])
            self.ranks = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
            self.id_of = np.zeros(max(ranks.values()) + 1, "<u4")
            self.id_of[list(ids)] = list(ids.values())

    def ids(self, text: str) -> bytes | None:
        """Ids of a space and the text; None if they don't stand for its bytes."""
        whole = " " + text
        if self.by_ranks and (text.isascii() or not ODD.search(text)):
            return self.id_of[self.ranks.encode_ordinary(whole)].tobytes()
        ids = self.library.encode(whole, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes() if b"".join([self.bytes_of[i] for i in ids]) == whole.encode() else None


class Pieces:
    """Pieces of a sentencepiece model, which puts a space before a text."""

    def __init__(self, model: bytes) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = self.library.get_piece_size()
        byte = re.compile(r"<0x([0-9A-F]{2})>")
        text = lambda p: bytes([int(m[1], 16)]) if (m := byte.fullmatch(p)) else p.encode().replace(SPACE_SIGN, b" ")
        self.bytes_of = [text(self.library.id_to_piece(i)) for i in range(n)]
        self.sizes = np.array([len(b) for b in self.bytes_of], np.int64)
        self.space = self.library.piece_to_id("▁")
        self.kept = Kept(self._encode)

    def _encode(self, words: list[bytes]) -> list[bytes | None]:
        # The library adds a space to what it encodes: one is taken off, or a line end keeps it apart.
        texts = [w[1:].decode() if w[:1] == b" " else "\n" + w.decode() for w in words]
        out: list[bytes | None] = []
        for w, ids in zip(words, self.library.encode(texts, num_threads=1)):
            ids = [self.space] if w == b" " else ids if w[:1] == b" " else ids[2:]
            out.append(np.array(ids, "<u4").tobytes() if b"".join([self.bytes_of[i] for i in ids]) == w else None)
        return out

    def ids(self, text: bytes) -> bytes | None:
        """Ids of the text; None if they don't stand for a space and its bytes."""
        return None if SPACE_SIGN in text else self.kept.ids(pre_tokens(text))


_held: dict[tuple[int, int], tuple[ByteLevel, Pieces]] = {}


def _coders(model_a: str, pattern: str, model_b: bytes) -> tuple[ByteLevel, Pieces]:
    """This worker's tokenizers."""
    key = hash((model_a, pattern)), hash(model_b)
    if key not in _held:
        _held.clear()
        _held[key] = ByteLevel(model_a, pattern), Pieces(model_b)
    return _held[key]


def _digits() -> tuple[np.ndarray, np.ndarray]:
    texts = [str(i).encode() for i in range(1 << 16)]
    return np.frombuffer(b"".join(t.ljust(5, b"\0") for t in texts), np.uint8).reshape(-1, 5), np.array([len(t) for t in texts])


DIGITS, DIGITS_LONG = _digits()


def lay(a: list[bytes], b: list[bytes], sizes_a: np.ndarray, sizes_b: np.ndarray):
    """For documents' packed ids by either tokenizer, which stand for the same bytes:
    numbers of tokens, groups and links of each, its groups as text, and the links
    (document, id of the first, id of the second) in order."""
    ids_a, ids_b = (np.frombuffer(b"".join(x), "<u4").astype(np.int64) for x in (a, b))
    n_a, n_b = (np.array([len(t) // 4 for t in x], np.int64) for x in (a, b))
    ends_a, ends_b = np.cumsum(sizes_a[ids_a]), np.cumsum(sizes_b[ids_b])
    size = int(ends_a[-1]) if len(ends_a) else 0
    at_a, at_b = (np.bincount(e, minlength=size + 1).astype(np.int8) for e in (ends_a, ends_b))
    both = at_a & at_b
    groups, seen_a, seen_b = (np.cumsum(x, dtype=np.int32) for x in (both, at_a, at_b))
    last = np.append(0, ends_a)[np.cumsum(n_a)]  # where each document ends
    first = np.append(0, last[:-1])
    n_groups = (groups[last] - groups[first]).astype(np.int64)
    cuts = np.flatnonzero(at_a | at_b)
    links = np.searchsorted(cuts, last, "right") - np.searchsorted(cuts, first, "right")
    before = cuts - 1
    link_a, link_b = ids_a[seen_a[before]], ids_b[seen_b[before]]

    # Tokens in the order of their groups, those of the first tokenizer before the others.
    group_a, group_b = groups[ends_a - 1], groups[ends_b - 1]
    total = int(groups[-1])
    in_a, in_b = np.bincount(group_a, minlength=total), np.bincount(group_b, minlength=total)
    upto_a, upto_b = np.cumsum(in_a), np.cumsum(in_b)
    place_a = np.arange(len(ids_a)) + (upto_b - in_b)[group_a]
    place_b = np.arange(len(ids_b)) + upto_a[group_b]
    value, mark = np.empty(len(ids_a) + len(ids_b), np.int64), np.full(len(ids_a) + len(ids_b), ord(","), np.uint8)
    value[place_a], value[place_b] = ids_a, ids_b
    mark[place_a[upto_a - 1]], mark[place_b[upto_b - 1]] = ord("|"), ord(";")
    long = DIGITS_LONG[value]
    stop = np.cumsum(long + 1)
    start = stop - long - 1
    text = np.empty(int(stop[-1]) if len(stop) else 0, np.uint8)
    text[stop - 1] = mark
    for k in range(DIGITS.shape[1]):
        some = long > k
        text[start[some] + k] = DIGITS[value[some], k]
    ends = np.append(0, stop)[np.cumsum(n_a + n_b)]
    raw, begin, said = text.tobytes(), 0, []
    for e in ends.tolist():
        said.append(raw[begin : max(begin, e - 1)])
        begin = e
    return n_a, n_b, n_groups, links, said, np.repeat(np.arange(len(a)), links), link_a, link_b


def _align(model_a: str, pattern: str, model_b: bytes, with_groups: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = _coders(model_a, pattern, model_b)
        task, number = TaskContext.get(), 0
        base = (task.partitionId() if task else 0) << 20
        docs, size = [], 0
        run_a: list[bytes] = []
        run_b: list[bytes] = []
        run_size = 0
        parts: list[tuple] = []

        def laid() -> None:
            nonlocal run_a, run_b, run_size
            n_a, n_b, n_groups, links, said, doc, link_a, link_b = lay(run_a, run_b, first.sizes, second.sizes)
            key, times = np.unique(doc << 32 | link_a << 16 | link_b, return_counts=True)
            texts = [s.decode() for s in said] if with_groups else None
            parts.append((n_a, n_b, n_groups, links, [hashlib.sha256(s).hexdigest() if s else "" for s in said], texts, np.bincount(key >> 32, minlength=len(run_a)), key & 0xFFFFFFFF, times))
            run_a, run_b, run_size = [], [], 0

        def block() -> Iterator[pa.RecordBatch]:
            nonlocal docs, size, parts, number
            if run_a:
                laid()
            columns = list(zip(*parts))
            numbers = [np.concatenate(columns[i]) for i in (0, 1, 2, 3, 6)]
            pairs, at = np.unique(np.concatenate(columns[7]), return_inverse=True)
            here = base + number
            small = lambda x: x.astype(np.min_scalar_type(int(x.max()) if len(x) else 0))
            texts = [t for some in columns[5] for t in some] if with_groups else None
            body = _pack(docs, [small(x) for x in numbers], [s for some in columns[4] for s in some], texts, small(at), small(np.concatenate(columns[8])))
            times = np.bincount(at, minlength=len(pairs))
            for a in range(0, len(pairs), 100_000):
                some = pairs[a : a + 100_000]
                n = len(some)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, here)), pa.array(np.full(n, PAIRS, np.int32)), pa.array(some), pa.array(times[a : a + n]), pa.nulls(n, pa.binary())], ["block", "kind", "pair", "n", "body"])
            yield pa.RecordBatch.from_arrays([pa.array([here], pa.int64()), pa.array([BLOCK], pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([body], pa.binary())], ["block", "kind", "pair", "n", "body"])
            docs, size, parts, number = [], 0, [], number + 1

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                raw = text.encode()
                if docs and size + len(raw) > BLOCK_BYTES or len(docs) >= 1 << 16:
                    yield from block()
                a = first.ids(text) if text else None
                b = second.ids(raw) if a is not None else None
                run_a.append(a if b is not None else b"")
                run_b.append(b if b is not None else b"")
                docs.append(doc)
                size, run_size = size + len(raw), run_size + len(raw)
                if run_size >= RUN_BYTES:
                    laid()
        if docs:
            yield from block()

    return rows


OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, groups string"


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows, of a block first its pairs with their counts, then itself, to
    its documents."""
    counts: list[np.ndarray] = []
    best: list[np.ndarray] = []
    names = [c.split()[0] for c in OUT.split(", ")]
    for batch in batches:
        kind = batch.column(0).to_numpy()
        count, is_best = (batch.column(i).fill_null(none).to_numpy(zero_copy_only=False) for i, none in ((1, 0), (2, False)))
        start = 0
        for at in [*np.flatnonzero(kind == BLOCK).tolist(), len(kind)]:
            counts.append(count[start:at])
            best.append(is_best[start:at])
            start = at + 1
            if at == len(kind):
                break
            docs, (n_a, n_b, n_groups, links, postings), shas, texts, pair, times = _unpack(batch.column(3)[at].as_py())
            value, top = np.concatenate(counts), np.concatenate(best)
            counts, best = [], []
            times, pair = times.astype(np.int64), pair.astype(np.int64)
            ends = np.append(0, np.cumsum(postings.astype(np.int64)))
            upto = [np.append(0, np.cumsum(times * x[pair]))[ends] for x in (top.astype(np.int64), value.astype(np.int64))]
            whole = [x.astype(np.int64) for x in (n_a, n_b, n_groups, links)] + [np.diff(x) for x in upto]
            texts = pa.nulls(len(docs), pa.string()) if texts is None else pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), *map(pa.array, whole), pa.array(shas, pa.string()), texts], names)


def align(docs: DataFrame, path_a: str, pattern: str, path_b: str, with_groups: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id; n_a and n_b, the tokens of a space and
    the text by the byte-level tokenizer at
    ``path_a``, which cuts texts by ``pattern``, and of the text by the
    sentencepiece model at ``path_b``, which adds the space; n_groups, cut where both
    end a token; n_links, pairs of overlapping tokens; n_best, links whose pair of ids
    is linked in as many documents of the corpus as any with its first id; count_sum,
    these numbers of documents over all links; groups_sha256, and if ``with_groups``
    groups, ``a1,a2|b1;a3|b2,b3``.

    Special strings in texts are plain text.  Null and empty texts, and those whose
    tokens don't stand for their bytes, have no tokens: zeros and an empty string.
    Whole texts are aligned, however long.  Null doc_ids stay null; repeated rows count
    as documents each; an empty table gives an empty result; other columns are not
    read.  The driver reads the models; they travel with the tasks.
    """
    spark = docs.sparkSession
    small_batches(spark)
    with open(path_a, encoding="utf-8") as a, open(path_b, "rb") as b:
        model_a, model_b = a.read(), b.read()
    path = scratch(spark, "links")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    slim.mapInArrow(_align(model_a, pattern, model_b, with_groups), FRAME).write.partitionBy("kind").parquet(path)
    kept = spark.read.schema(FRAME).parquet(path)
    pairs = kept.where(F.col("kind") == PAIRS).select("block", "pair", "n")
    counts = pairs.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("a", F.shiftright("pair", 16))
    # A row for each id of the first vocabulary at most: small whatever the corpus.
    most = F.broadcast(counts.groupBy("a").agg(F.max("count").alias("most")))
    valued = counts.join(most, "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    answers = pairs.join(valued, "pair").select("block", F.lit(PAIRS).alias("kind"), "pair", "count", "best", F.lit(None).cast("binary").alias("body"))
    bodies = kept.where(F.col("kind") == BLOCK).select("block", F.lit(BLOCK).alias("kind"), F.lit(None).cast("long").alias("pair"), F.lit(None).cast("long").alias("count"), F.lit(None).cast("boolean").alias("best"), "body")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    back = answers.unionByName(bodies).withColumn("to", F.expr(f"cast(pmod((block >> 20) * 7 + (block & 1048575), {parts}) as int)")).repartitionById(parts, "to")
    out = back.sortWithinPartitions("block", "kind", "pair").select("kind", "count", "best", "body").mapInArrow(_sum_up, OUT)
    return out if with_groups else out.drop("groups")
