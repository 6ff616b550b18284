"""Toxicity by a factorization machine over hashed terms.

A text's terms are its distinct words and their beginnings (the first four and
five letters, which catch new forms of a word), each hashed to one of 2^20
numbers.  score = sigmoid(w0 + sum w_i + sum over pairs <v_i, v_j>): the factors
v learn pairs of terms that are worse together than each alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .byte_bpe import release
from .common import bucket, cut, small_batches

SPACE = 1 << 20
WORD = re.compile(r"\w+")
#: Words whose terms a task remembers; beyond that it starts anew.
REMEMBERED = 200_000


def word_terms(word: str) -> tuple[int, ...]:
    """Hashed terms of a word: itself, and its beginnings where it is longer."""
    terms = [word, *(f"{word[:k]}-" for k in (4, 5) if len(word) > k)]
    return tuple(crc32(t.encode()) & (SPACE - 1) for t in terms)


def text_terms(text: str | None, memory: dict[str, tuple[int, ...]], of=word_terms) -> list[int]:
    """The distinct terms of a whole text."""
    found: set[int] = set()
    if len(memory) > REMEMBERED:
        memory.clear()
    for word in set(WORD.findall((text or "").lower())):
        if (terms := memory.get(word)) is None:
            terms = memory[word] = of(word)
        found.update(terms)
    return sorted(found)


@dataclass
class Machine:
    """Terms known to the model in rising order, their weights and factors."""

    bias: float
    terms: np.ndarray
    weights: np.ndarray
    factors: np.ndarray

    def score(self, rows: np.ndarray) -> float:
        """Of the places of a text's known terms."""
        v = self.factors[rows]
        z = self.bias + self.weights[rows].sum() + 0.5 * ((v.sum(0) ** 2).sum() - (v * v).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def strong_pairs(columns: list[np.ndarray], texts: int, pull: np.ndarray, noise: np.ndarray, most: tuple[float, float], false: float = 0.1, block: int = 512) -> np.ndarray:
    """Which terms are in a pair that pulls more than chance gives.  ``columns``:
    the texts of each term; ``pull``, ``noise``: each text's gradient and its
    variance; ``most``: how far one text can pull up and down.  By Bernstein's
    bound, pairs of idle terms pass ``false`` times in all at the most.  Terms
    that are too rare to pass with any other are not paired."""
    strong, level = np.zeros(len(columns), bool), 2 * np.log(max(len(columns), 2) ** 2 / false)
    up, down = np.maximum(pull, 0), np.maximum(-pull, 0)
    able = [i for i, c in enumerate(columns) if 3 * up[c].sum() >= level * most[0] > 0 or 3 * down[c].sum() >= level * most[1] > 0]

    def dense(some: list[int]) -> np.ndarray:
        out = np.zeros((texts, len(some)), np.float32)
        for k, i in enumerate(some):
            out[columns[i], k] = 1
        return out

    for a in range(0, len(able), block):
        here = dense(able[a : a + block])
        pulls, noises = (here * pull[:, None].astype(np.float32)).T, (here * noise[:, None].astype(np.float32)).T
        for b in range(a, len(able), block):
            there = dense(able[b : b + block])
            t, v = pulls @ there, noises @ there
            found = t**2 > level * (v + np.where(t > 0, most[0], most[1]) * np.abs(t) / 3)
            if a == b:
                np.fill_diagonal(found, False)
            strong[np.array(able[a : a + block])[found.any(1)]] = True
            strong[np.array(able[b : b + block])[found.any(0)]] = True
    return strong


def fit(examples: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, rank: int = 4, epochs: int = 40, rate: float = 0.3, l1: float = 1e-3, least: int = 3, screen: float = 3.5, seed: int = 5) -> Machine:
    """Adagrad on weighted log loss over batches of texts; weights are drawn to
    zero (l1) and learn alone at first, factors join in the second half.  Terms in fewer than ``least`` examples are left out, and those
    whose first gradient is under ``screen`` times what chance gives: in long
    texts thousands of idle terms would else drown the few that matter.  Of these,
    the terms of pairs on which the weights alone fail come back with the factors."""
    total = float(weights.sum())
    if not len(labels) or total <= 0:
        return Machine(-30.0, np.empty(0, np.int64), np.empty(0), np.empty((0, rank)))
    mean = float(np.clip((weights * labels).sum() / total, 1e-4, 1 - 1e-4))
    every, row, counts = np.unique(np.concatenate(examples), return_inverse=True, return_counts=True)
    row, doc = row.astype(np.int32), np.repeat(np.arange(len(examples), dtype=np.int32), [len(x) for x in examples])
    pull = np.bincount(row, (weights * (labels - mean))[doc], len(every))
    noise = np.sqrt(np.bincount(row, (weights**2 * mean * (1 - mean))[doc], len(every)))
    frequent = counts >= least
    kept = frequent & (np.abs(pull) > screen * noise)
    rng = np.random.default_rng(seed)
    terms = every[kept]
    n = len(terms)
    bias, w, v = np.log(mean / (1 - mean)), np.zeros(n), rng.normal(0, 0.01, (n, rank))
    held = lambda: [np.flatnonzero(np.isin(terms, x, assume_unique=True)) for x in examples]
    places = held()
    gw, gv, gb = np.full(n, 1e-4), np.full((n, rank), 1e-4), 1e-4
    for epoch in range(epochs):
        if epoch == (epochs + 1) // 2:
            chance = np.array([1 / (1 + np.exp(-np.clip(bias + w[p].sum(), -30, 30))) for p in places])
            order = np.argsort(row, kind="stable")
            columns = [x for x, f in zip(np.split(doc[order], np.cumsum(counts)[:-1]), frequent) if f]
            most = tuple(float(weights[labels == k].max(initial=0)) for k in (1, 0))
            paired = np.zeros(len(every), bool)
            paired[frequent] = strong_pairs(columns, len(examples), weights * (labels - chance), weights**2 * chance * (1 - chance), most)
            if (paired & ~kept).any():
                both = kept | paired
                old = kept[both]
                terms, n = every[both], int(both.sum())
                fresh = np.zeros(n), np.full(n, 1e-4), np.full((n, rank), 1e-4), rng.normal(0, 0.01, (n, rank))
                for x, y in zip((w, gw, gv, v), fresh):
                    y[old] = x
                w, gw, gv, v = fresh
                places = held()
        order = rng.permutation(len(places))
        for start in range(0, len(order) if n else 0, 128):
            some = order[start : start + 128]
            length = np.array([len(places[i]) for i in some])
            rows = np.repeat(np.arange(len(some)), length)
            cols = np.concatenate([places[i] for i in some])
            if not len(cols):
                continue
            used, cols = np.unique(cols, return_inverse=True)
            vu = v[used]
            sums = np.stack([np.bincount(rows, vu[cols, f], len(some)) for f in range(rank)], 1)
            squares = np.bincount(rows, (vu * vu).sum(1)[cols], len(some))
            z = bias + np.bincount(rows, w[used][cols], len(some)) + 0.5 * ((sums**2).sum(1) - squares)
            err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[some]) * weights[some] / weights[some].sum()
            dw = np.bincount(cols, err[rows], len(used))
            both = np.stack([np.bincount(cols, (err[:, None] * sums)[rows, f], len(used)) for f in range(rank)], 1)
            dv = both - vu * dw[:, None] + 1e-4 * vu
            gw[used] += dw**2
            gb += err.sum() ** 2
            step = rate / np.sqrt(gw[used])
            moved = w[used] - step * dw
            w[used] = np.sign(moved) * np.maximum(np.abs(moved) - step * l1, 0)
            if 2 * epoch >= epochs:
                gv[used] += dv**2
                v[used] = vu - 0.5 * rate / np.sqrt(gv[used]) * dv
            bias -= rate / np.sqrt(gb) * err.sum()
    v[np.abs(v).max(1, initial=0) < 0.02] = 0  # never told apart from its start
    known = (w != 0) | v.any(1)
    return Machine(float(bias), terms[known].astype(np.int64), w[known], v[known])


def terms_column(text: Column) -> Column:
    @F.arrow_udf("array<int>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release()
        memory: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            yield pa.array([text_terms(x, memory) for x in batch.to_pylist()], pa.list_(pa.int32()))

    return of(text)


def score_column(text: Column, model: Machine) -> Column:
    @F.arrow_udf("double")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release()
        at = {int(t): i for i, t in enumerate(model.terms)}
        known = lambda word: tuple(at[t] for t in word_terms(word) if t in at)
        memory: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            yield pa.array([model.score(np.array(text_terms(x, memory, known), np.int64)) for x in batch.to_pylist()], pa.float64())

    return of(text)


def labelled_sample(labels: DataFrame, label: str, learn: Column, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """Of the labelled rows to learn from, the first ``per_class`` of each
    class by a hash of doc_id (doc_id, label), and how many there are in all.
    Rows with a null id or label, or one that isn't 0 or 1, teach nothing; an
    id that is labelled twice counts as 1 if any row says so."""
    rows = labels.where(learn & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    rows = cut(rows)
    totals = {int(r[0]): int(r[1]) for r in rows.groupBy("label").count().collect()}
    picks = [rows.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for k in (0, 1)]
    return picks[0].unionByName(picks[1]), totals


def train(docs: DataFrame, labels: DataFrame, learn: Column | None = None, per_class: int = 2500) -> Machine:
    """A model from at most ``per_class`` labelled texts of each class, weighted
    to the classes' true shares; ``learn``: the condition on doc_id for rows to learn from
    (all, if none).  Without labels of both classes every score is the share of
    label 1."""
    small_batches(docs.sparkSession)
    sample, totals = labelled_sample(labels, "toxic", F.lit(True) if learn is None else learn, per_class)
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    got = text.join(F.broadcast(sample), "doc_id").select("doc_id", "label", terms_column(F.col("text")).alias("terms")).toArrow()
    got = got.take(np.lexsort((got["label"].to_numpy(), got["doc_id"].to_numpy())))
    y, lists = got["label"].to_numpy().astype(np.float64), pa.concat_arrays(got["terms"].chunks) if got.num_rows else pa.array([], pa.list_(pa.int32()))
    examples = np.split(lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy())[:-1]) if len(lists) else []
    held = np.array([max(1, int((y == k).sum())) for k in (0, 1)], np.float64)
    share = np.array([totals.get(k, 0) for k in (0, 1)], np.float64)
    return fit(examples, y, (share / held)[y.astype(int)])


def score(docs: DataFrame, model: Machine) -> DataFrame:
    """``docs`` with ``score``: the chance that the whole text is toxic.  Null
    texts count as empty, whose score is the model's bias alone.  Repeated rows
    are scored each; an empty table gives an empty result; a column named
    ``score`` is replaced."""
    small_batches(docs.sparkSession)
    return docs.withColumn("score", score_column(F.col("text"), model))


def held_out(remainder: int = 2, n: int = 4) -> Column:
    return bucket(F.col("doc_id"), n) == remainder
