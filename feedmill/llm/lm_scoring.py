"""Scores of texts by a causal self-attention model over subword ids.

Texts are cut to subword ids by a public rank file, once for each distinct word
of a block, and kept packed in the shared folder.  Counts of single ids and of
pairs come from all texts to learn from.  The attention model starts from these
and is trained on all of them, each in one of a few rounds: in a round each partition
of the kept ids trains a copy on its texts of the round, block by block where they
lie, and the copies' mean starts the next.  Beside it
stands a smoothed count of whole words over the corpus.
"""

from __future__ import annotations

from math import ceil, log, log10
from zlib import crc32

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import attention as A
from .byte_bpe import read_ranks
from .common import cut, small_batches
from .wordindex import _pack, _unpack, sums_by_document

#: Each text to learn from trains the attention model in one of ROUNDS.
ROUNDS = 3
#: Ids whose windows are in memory at once in training, about.
SHARE = 500_000
#: Windows in a training batch, at first and at most.
BATCH, LARGEST = 96, 512
#: Copies that are added up at once.
FAN = 16
#: Windows that are scored at once.
AT_ONCE = 768
OTHER = A.VOCABULARY - 1


def words_of(text: bytes) -> list[bytes]:
    """Words of a lower-cased text, by ASCII white space."""
    return text.lower().split()


def _row(values: dict, schema: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([values[k]], t) for k, t in schema.items()], list(schema))


BLOCK = {"body": pa.binary()}


def _encoder(ranks: dict[bytes, int], pattern: str):
    """Subword ids of a block: how many each document has, and all in turn."""

    def make():
        library = tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        kind = np.uint16 if max(ranks.values(), default=0) < 65536 else np.uint32

        def encode(words: list[bytes], code: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            pieces = [library.encode_ordinary(" " + w.decode()) for w in words]
            size = np.array([len(x) for x in pieces], np.int64)
            flat, start = np.array([i for x in pieces for i in x], kind), np.cumsum(size) - size
            n = size[code]
            at = np.repeat(start[code] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            lengths = np.diff(np.append(0, np.cumsum(n))[np.append(0, np.cumsum(counts))])
            return lengths, flat[at]

        return encode

    return make


def _blocks(batches):
    for batch in batches:
        for body in batch.column("body").to_pylist():
            yield _unpack(body)


def _split(ids: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
    return np.split(ids, np.cumsum(lengths)[:-1]) if len(lengths) else []


def _single(size: int):
    """Counts of ids in texts to learn from."""

    def rows(batches):
        counts = np.zeros(size, np.int64)
        for _, _, flags, lengths, ids in _blocks(batches):
            counts += np.bincount(ids[np.repeat(np.array(flags, bool), lengths)], minlength=size)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["id", "n"])

    return rows


def _ended(ids: np.ndarray, lengths: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids by their place in the model, each text ended by 0; and lengths."""
    ends = np.cumsum(lengths)
    return np.insert(place[ids], ends, 0), lengths + 1


def _pair_frames(place: np.ndarray, frames: int):
    """Counts of pairs, packed by the first id modulo ``frames``."""
    square = A.VOCABULARY**2

    def rows(batches):
        total = np.zeros(square, np.int32)
        for _, _, flags, lengths, ids in _blocks(batches):
            learn = np.array(flags, bool)
            flat, _ = _ended(ids[np.repeat(learn, lengths)], lengths[learn], place)
            if len(flat):
                key = np.append(0, flat[:-1]).astype(np.int64) * A.VOCABULARY + flat
                for a in range(0, len(key), 4_000_000):
                    k, n = np.unique(key[a : a + 4_000_000], return_counts=True)
                    total[k] += n.astype(np.int32)
        keys = np.flatnonzero(total)
        frame = keys // A.VOCABULARY % frames
        for f in np.unique(frame):
            k = keys[frame == f]
            yield _row({"pid": int(f), "body": _pack(np.diff(k, prepend=0).astype(np.uint32), total[k])}, {"pid": pa.int32()} | BLOCK)

    return rows


def _pair_sums(batches):
    keys, counts = [], []
    for steps, n in _blocks(batches):
        keys.append(np.cumsum(steps.astype(np.int64)))
        counts.append(n.astype(np.int64))
    if keys:
        k, row = np.unique(np.concatenate(keys), return_inverse=True)
        yield _row({"body": _pack(np.diff(k, prepend=0).astype(np.uint32), np.bincount(row, np.concatenate(counts)))}, BLOCK)


def _dealt(place: np.ndarray, when: int):
    """Of each block the texts to learn from in round ``when``, by a hash of doc_id
    and text: their ids."""

    def rows(batches):
        for ids_of, tags, flags, lengths, ids in _blocks(batches):
            lots = np.array([crc32(f"{doc}/{tag}".encode()) % ROUNDS for doc, tag in zip(ids_of, tags)], np.int64)
            mine = np.array(flags, bool) & (lots == when)
            if mine.any():
                some = _split(place[ids[np.repeat(mine, lengths)]].astype(np.uint16), lengths[mine])
                yield _row({"body": _pack([np.append(x, np.uint16(0)) for x in some])}, BLOCK)

    return rows


def _trained(weights: A.Weights, tables, when: int):
    def rows(batches):
        n = 0

        def runs():
            nonlocal n
            for (part,) in _blocks(batches):
                lots = np.cumsum([len(x) for x in part]) // SHARE
                for some in np.split(np.arange(len(part)), np.flatnonzero(np.diff(lots)) + 1):
                    x, y, _ = A.windows([part[i] for i in some], 0)
                    n += int((y >= 0).sum())
                    yield x, y

        pa.default_memory_pool().release_unused()  # what cutting texts to words left
        log_class, log_member = _tables(tables)
        w, _ = A.train_runs(weights, log_class, log_member, runs(), 0.02 / 2**when, BATCH, LARGEST, when)
        if n:
            yield _row({"body": _pack([n, *(a.astype(np.float64) * n for a in w.arrays())])}, BLOCK)

    return rows


def _in_place(place: np.ndarray, weights: A.Weights, tables, when: int):
    """A copy of the weights, trained on a partition's texts of the round."""
    dealt, trained = _dealt(place, when), _trained(weights, tables, when)
    return lambda batches: trained(dealt(batches))


def _mean(batches):
    total = None
    for (part,) in _blocks(batches):
        total = part if total is None else [a + b for a, b in zip(total, part)]
    if total is not None:
        yield _row({"body": _pack(total)}, BLOCK)


def _tables(held) -> tuple[np.ndarray, np.ndarray]:
    log_class, log_member = held.value
    return log_class, log_member.astype(A.FLOAT)


def _scorer(weights: A.Weights, tables, place: np.ndarray, rare: np.ndarray):
    """Rows (doc_id, tag, score) of all texts of the blocks."""

    def rows(batches):
        log_class, log_member = _tables(tables)
        bias, fused, calm = A.distance_bias(weights.near), A.fused(weights), A.steady(weights)
        for ids_of, tags, _, lengths, ids in _blocks(batches):
            n = len(lengths)
            flat, ended = _ended(ids, lengths, place)
            out = np.zeros(n)
            # Ids that the model has only as "other" have their share in it.
            out += np.bincount(np.repeat(np.arange(n), lengths), np.where(place[ids] == OTHER, rare[ids], 0.0), n)
            at, texts = 0, _split(flat, ended)
            while at < n:
                size, to = 0, at
                while to < n and (to == at or size + len(texts[to]) <= 2_000_000):
                    size += len(texts[to])
                    to += 1
                x, y, owner = A.windows(texts[at:to])
                for a in range(0, len(x), AT_ONCE):
                    lp = A.log_probabilities(weights, fused, bias, log_class, log_member, x[a : a + AT_ONCE], y[a : a + AT_ONCE], calm)
                    out[at:to] += np.bincount(owner[a : a + AT_ONCE], lp.sum(1), to - at)
                at = to
            yield pa.RecordBatch.from_arrays([pa.array(ids_of, pa.int64()), pa.array(tags, pa.int64()), pa.array(out / log(10))], ["doc_id", "tag", "score"])

    return rows


def attention_scores(blocks: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """(doc_id, tag, score): log10 of each text's probability, from the packed
    blocks of ids, tags, flags (whether to learn from the text) and subword ids."""
    spark = blocks.sparkSession

    # Single counts: as many as the rank file has ids.
    size = max(ranks.values()) + 1
    got = blocks.mapInArrow(_single(size), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    single = np.zeros(size, np.int64)
    single[got["id"]] = got["n"]
    top = np.argsort(-single, kind="stable")[: A.VOCABULARY - 2]
    place = np.full(size, OTHER, np.int32)
    place[top] = np.arange(1, len(top) + 1)
    rest = np.where(place == OTHER, single + 0.5, 0.0)
    rare = np.log(np.where(rest > 0, rest, 1.0) / max(rest.sum(), 1.0))

    frames = int(spark.conf.get("spark.sql.shuffle.partitions"))
    summed = blocks.mapInArrow(_pair_frames(place, frames), "pid int, body binary").repartitionById(frames, "pid").select("body").mapInArrow(_pair_sums, "body binary")
    pairs = np.zeros((A.VOCABULARY, A.VOCABULARY), np.int64)
    for (body,) in summed.toLocalIterator():  # at most VOCABULARY^2 counts
        steps, n = _unpack(bytes(body))
        np.put(pairs, np.cumsum(steps.astype(np.int64)), n)
    log_class, log_member = A.bigram_tables(pairs)
    del pairs
    tables = spark.sparkContext.broadcast((log_class, log_member.astype(np.float16)))
    del log_class, log_member

    parts = max(1, blocks.rdd.getNumPartitions())
    weights = A.Weights.fresh()
    for when in range(ROUNDS):
        copies, left = blocks.mapInArrow(_in_place(place, weights, tables, when), "body binary"), parts
        while left > FAN:  # the driver gets a few sums, however many copies there are
            left = ceil(left / FAN)
            copies = copies.repartition(left).mapInArrow(_mean, "body binary")
        sums = copies.collect()
        total = None
        for (body,) in sums:
            part = _unpack(bytes(body))[0]
            total = part if total is None else [a + b for a, b in zip(total, part)]
        if total is not None:
            weights = A.Weights(*((a / total[0]).astype(A.FLOAT) for a in total[1:]))
    return blocks.mapInArrow(_scorer(weights, tables, place, rare), "doc_id long, tag long, score double")


def _word_weights():
    """Of distinct words and their counts: log10(c + 0.5), and whether c > 0."""
    return lambda words, counts: np.stack((np.log10(counts + 0.5), counts > 0), 1).astype(np.float64)


def score(docs: DataFrame, path: str, pattern: str, learn: Column) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens (words and one end), n_known
    (of them seen in texts to learn from), train_tokens (tokens of these texts),
    base_score (log10 probability by smoothed counts of words) and score (by the
    attention model).  ``learn``: which rows to learn from, by doc_id.

    A-Z are lower-cased.  Null texts count as empty, which have the end alone.
    Rows with a null doc_id are scored, and learned from if ``learn`` says so.
    Repeated rows are scored each, and counted each.  Without texts to learn
    from all ids are alike likely.  An empty table gives an empty result; other
    columns are not read.
    """
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tag"), text.alias("text"), F.coalesce(learn, F.lit(False)).alias("flag"))
    ranks = read_ranks(path)
    sums, blocks = sums_by_document(rows, words_of, _word_weights, 2, _encoder(ranks, pattern), counted=True)
    base = cut(sums)
    seen = base.where("n_bytes is null").agg(F.sum("total"), F.sum("distinct")).first()
    base = base.where("n_bytes is not null")
    ends = base.where("flag").count()
    n = int(seen[0] or 0) + ends
    v = int(seen[1] or 0) + (ends > 0)
    each = F.col("n_words") + 1
    known = F.col("v1").cast("long") + int(ends > 0)
    base_score = F.col("v0") + log10(ends + 0.5) - each * log10(n + 0.5 * (v + 1))
    # The score depends on the text alone, so rows with the same id and text share one.
    scores = attention_scores(blocks, ranks).dropDuplicates(["doc_id", "tag"]).select(F.col("doc_id").alias("_fm_id"), F.col("tag").alias("_fm_tag"), "score")
    out = base.join(scores, F.col("doc_id").eqNullSafe(F.col("_fm_id")) & (F.col("tag") == F.col("_fm_tag")))
    return out.select("doc_id", each.alias("n_tokens"), known.alias("n_known"), F.lit(n).cast("long").alias("train_tokens"), base_score.alias("base_score"), "score")
