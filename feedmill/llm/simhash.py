"""Near-duplicates by SimHash, linked through a generalised pigeonhole index.

Fingerprints of 64 bits are made from word shingles.  Bits that go together
are grouped into m partitions; each partition i gets its own threshold t_i
(-1: unused) with sum(t_i) = tau - m + 1, so two fingerprints that differ in at
most tau bits differ in at most t_i bits of some partition i.  Partitions and
thresholds come from dynamic programming on estimated candidate counts.  Each
distinct fingerprint is indexed under its own value of a partition and probes
all values within t_i bits; candidates are verified on all 64 bits.

Keys with many members are not joined pairwise, and their members don't probe:
whatever is near to one of them has its own key within t_i bits of the hot key, so
all members of such keys are handled with it.  They are indexed again by halves,
whose keys are long enough that unrelated fingerprints don't share them.  A key
that is not hot so meets probes from other such keys alone, a bounded number.
What is left in keys with many members are near copies of each other; they are
linked through points of the Hamming space: two fingerprints differ in
at most three bits exactly if some point lies within one bit of one and within
two of the other, and a point links all that lie so near with one row each.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, small_batches

BITS = 64
#: Members of a key, from which on it isn't joined pairwise.
HOT_KEY = 96
#: Hot keys, with their neighbours, up to which they are broadcast; a row has 24 bytes.
BROADCAST_KEYS = 200_000


def _majority(hashes: np.ndarray) -> np.ndarray:
    """Of rows of 64-bit words, the bits that are set in over half of the rows."""
    counts = np.zeros(hashes.shape[1] * BITS, np.int64)
    for a in range(0, len(hashes), 255):  # so many fit a byte
        bits = np.unpackbits(np.ascontiguousarray(hashes[a : a + 255]).view(np.uint8), axis=1, bitorder="little")
        counts += np.add.reduce(bits, 0, np.uint8)
    return np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)


def fingerprint(text: bytes | None, words: int = 3) -> int:
    """SimHash of one text; null and empty texts and texts without words have
    fingerprint zero, texts of fewer words than a shingle one shingle."""
    found = (text or b"").lower().split()
    if not found:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(found) <= words:
        return digest(b" ".join(found), 42)
    flat = memoryview(b" ".join(found))
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = [0, *(ends + 1).tolist()]
    hashes = np.fromiter((digest(flat[a:b], 42) for a, b in zip(starts, ends[words - 1 :].tolist())), np.uint64, len(found) - words + 1)
    return int(_majority(hashes[:, None])[0])


def fingerprints(text: Column, words: int = 3) -> Column:
    """Column of fingerprints as signed 64-bit numbers."""

    @F.arrow_udf("long")
    def of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array(np.array([fingerprint(x, words) for x in batch.to_pylist()], np.uint64).view(np.int64))

    return of(text.cast("binary"))


def bit_statistics(fps: DataFrame, lags: int = 16) -> tuple[int, np.ndarray, np.ndarray]:
    """Over all fingerprints: their number, how often two bits are set
    together (64 x 64), and, for pairs of unrelated fingerprints, how often two
    bits differ together.  Pairs are rows at some lags in a shuffled batch."""

    def part(batches):
        both, apart, n, pairs = np.zeros((BITS, BITS)), np.zeros((BITS, BITS)), 0, 0
        for batch in batches:
            x = batch.column(0).to_numpy().astype(np.int64).view(np.uint64)
            x = x[np.random.default_rng(7).permutation(len(x))]
            bits = ((x[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float32)
            both += bits.T @ bits
            n += len(x)
            for lag in range(1, min(lags, len(x) - 1) + 1):
                d = np.abs(bits[lag:] - bits[:-lag])
                apart += d.T @ d
                pairs += len(d)
        yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(2 * BITS * BITS + 2), pa.int32()), "v": np.concatenate((both.ravel(), apart.ravel(), [n, pairs]))})

    sums = fps.select("fp").mapInArrow(part, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).toPandas()
    v = np.zeros(2 * BITS * BITS + 2)
    v[sums["i"].to_numpy()] = sums["v"].to_numpy()
    square = BITS * BITS
    return int(v[-2]), v[:square].reshape(BITS, BITS), v[square:-2].reshape(BITS, BITS) / max(v[-1], 1)


def group_bits(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """Bits in m partitions of about equal size, correlated bits together:
    each partition starts with the free bit that is most correlated with
    others and takes in turn the free bit closest to what it has."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    near = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(near, 0)
    free, parts = list(range(BITS)), []
    for k in range(m):
        size = len(free) // (m - k)
        part = [max(free, key=lambda b: (near[b, free].sum(), -b))]
        free.remove(part[0])
        while len(part) < size:
            b = max(free, key=lambda b: (near[b, part].sum(), -b))
            part.append(b)
            free.remove(b)
        parts.append(sorted(part))
    return parts


def near_chance(part: list[int], apart: np.ndarray) -> list[float]:
    """Chance that two unrelated fingerprints differ in at most t = 0, 1, 2, 3
    bits of the partition: bits differ one by one, each given the one before
    it (a chain over the measured pairwise counts)."""
    state = np.zeros((2, 5))
    q = np.clip(np.diag(apart), 1e-6, 1 - 1e-6)
    state[1, 1], state[0, 0] = q[part[0]], 1 - q[part[0]]
    for a, b in zip(part, part[1:]):
        both = min(apart[a, b], q[a], q[b])
        up = (min(1, both / q[a]), min(1, max(0, q[b] - both) / (1 - q[a])))
        new = np.zeros_like(state)
        for was, chance in ((1, up[0]), (0, up[1])):
            new[1, 1:] += state[was, :-1] * chance
            new[1, 4] += state[was, 4] * chance
            new[0] += state[was] * (1 - chance)
        state = new
    return np.cumsum(state.sum(0))[:4].tolist()


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds t_i >= -1 that sum to ``total`` at the least cost, by dynamic
    programming; ``costs[i][t + 1]`` is the cost of t_i = t."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, picks) in best.items():
            for t, c in enumerate(row, -1):
                if (s := spent + t) not in step or cost + c < step[s][0]:
                    step[s] = (cost + c, [*picks, t])
        best = step
    return best.get(total, (float("inf"), []))


def plan_index(n: int, both: np.ndarray, apart: np.ndarray, tau: int = 3, numbers: tuple[int, ...] = (2, 3, 4, 5)) -> list[tuple[list[int], int]]:
    """Partitions with their thresholds, of the given numbers of partitions the
    cheapest: a row indexed or probed costs 1, a candidate 1/4."""
    choices = []
    for m in numbers:
        parts = group_bits(n, both, m)
        costs = []
        for part in parts:
            chance = near_chance(part, apart)
            rows = [n * (1 + sum(comb(len(part), j) for j in range(t + 1))) for t in range(min(tau, 3))]
            costs.append([0.0, *(r + 0.25 * n * n * chance[t] for t, r in enumerate(rows))])
        cost, picks = allocate(costs, tau - m + 1)
        choices.append((cost, [(p, t) for p, t in zip(parts, picks) if t >= 0]))
    return min(choices, key=lambda x: x[0])[1]


def _masks(bits: list[int], radius: int) -> np.ndarray:
    """Exclusive-or masks for all flips of at most ``radius`` of the bits."""
    return np.array([sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(bits, r)], np.uint64)


def _probes(plan: list[tuple[list[int], int]]):
    """For rows (part, key): all keys within the partition's threshold."""
    flips_of = [_masks(part, t) for part, t in plan]

    def rows(batches):
        for whole in batches:
            part, key, fp = (whole.column(i).to_numpy() for i in range(3))
            for i, flips in enumerate(flips_of):
                mine = np.flatnonzero(part == i)
                for at in range(0, len(mine), 4096):
                    some = mine[at : at + 4096]
                    to = (key[some].view(np.uint64)[:, None] ^ flips[None, :]).ravel()
                    yield pa.RecordBatch.from_pydict({"part": pa.array(np.full(len(to), i, np.int32)), "key": to.view(np.int64), "probe": np.repeat(fp[some], len(flips))})

    return rows


def _points(batches):
    """For rows (hot, mask, fp): the points within two bits of fp, where only
    bits of mask are turned, with their distance."""
    for batch in batches:
        for hot, mask, fp in zip(*(batch.column(i).to_pylist() for i in range(3))):
            bits = [b for b in range(BITS) if mask >> b & 1]
            m = _masks(bits, 2)
            point = np.uint64(fp & (2**64 - 1)) ^ m
            far = np.concatenate(([0], np.ones(len(bits), np.int8), np.full(len(m) - 1 - len(bits), 2, np.int8))).astype(np.int8)
            yield pa.RecordBatch.from_pydict({"hot": pa.array(np.full(len(m), hot)), "point": point.view(np.int64), "fp": pa.array(np.full(len(m), fp)), "near": pa.array(far <= 1)})


def _near(a: str, b: str, tau: int) -> Column:
    return (F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= tau) & (F.col(a) < F.col(b))


def _indexed(fps: DataFrame, plan: list[tuple[list[int], int]], tau: int) -> tuple[DataFrame, DataFrame | None]:
    """Links (a, b) found in ordinary keys, and the members (hot, fp) of the
    others and of the keys near them, if there are any."""
    signed = [int(np.uint64(sum(1 << b for b in part)).astype(np.int64)) for part, _ in plan]
    own = F.array(*[F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(s)).alias("key")) for i, s in enumerate(signed)])
    index = fps.select("fp", F.inline(own))
    hot = cut(index.groupBy("part", "key").count().where(F.col("count") > HOT_KEY).withColumn("hot", F.monotonically_increasing_id()).drop("count"))
    n_hot = hot.count()
    near = max(len(_masks(part, t)) for part, t in plan)
    small = (lambda df: F.broadcast(df)) if n_hot * near <= BROADCAST_KEYS else (lambda df: df)
    cold = index.join(small(hot), ["part", "key"], "left_anti") if n_hot else index
    probe = cold.select("part", "key", "fp").mapInArrow(_probes(plan), "part int, key long, probe long")
    found = cold.join(probe, ["part", "key"]).where(_near("fp", "probe", tau)).select(F.col("fp").alias("a"), F.col("probe").alias("b"))
    if not n_hot:
        return found, None
    around = hot.select("part", "key", "hot").mapInArrow(_probes(plan), "part int, key long, probe long").withColumnRenamed("probe", "hot")
    return found, cut(index.join(small(around), ["part", "key"]).select("hot", "fp").distinct())


def _starred(members: DataFrame) -> DataFrame:
    """Links (a, b) that connect what is near within each hot key, through
    points that turn only bits in which the key's members differ."""
    turned = members.groupBy("hot").agg(F.bit_or("fp").bitwiseXOR(F.bit_and("fp")).alias("mask"))
    points = members.join(turned, "hot").select("hot", "mask", "fp").mapInArrow(_points, "hot long, point long, fp long, near boolean")
    # A point holds at most as many fingerprints as there are within two bits of it.
    stars = points.groupBy("hot", "point").agg(F.min(F.when(F.col("near"), F.col("fp"))).alias("a"), F.collect_set("fp").alias("all"))
    return stars.where(F.col("a").isNotNull() & (F.size("all") > 1)).select("a", F.explode("all").alias("b")).where("a <> b").distinct()


def links(fps: DataFrame, tau: int = 3) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints (column fp) that connect all which
    differ in at most tau bits: all pairs within ordinary keys, and enough
    pairs within hot keys.  ``tau`` is at most 3."""
    n, both, apart = bit_statistics(fps)
    if n < 2:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where(F.lit(False))
    found, members = _indexed(fps, plan_index(n, both, apart, tau), tau)
    if members is None:
        return found
    again, members = _indexed(members.select("fp").distinct(), plan_index(n, both, apart, tau, (2,)), tau)
    found = found.unionByName(again)
    return found if members is None else found.unionByName(_starred(members))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the smallest
    node that it reaches.  Alternating large-star and small-star steps until
    nothing changes, in about log(n) rounds; each round is kept in the shared
    folder."""
    e = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    before = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        e = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = e.groupBy("u").agg(F.min("v").alias("m"))
        pairs = F.array(F.struct(F.col("u").alias("a"), F.col("m").alias("b")), F.struct(F.col("v").alias("a"), F.col("m").alias("b")))
        e = cut(e.join(least, "u").select(F.inline(pairs)).where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct())
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = now


def near_duplicates(docs: DataFrame, words: int = 3, tau: int = 3, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: doc_id, the columns ``carry``, fp (signed 64
    bits), component_id, the smallest doc_id that the row reaches over links,
    itself included, and root, a fingerprint that stands for the component.

    Null and empty texts and texts without words have fingerprint zero and are
    linked like any other.  Rows with a null doc_id link texts like others; a
    component in which all ids are null has a null component_id.  Repeated rows
    stay, each a row of its own.  Very long texts are hashed whole.  An empty table
    gives an empty result; other columns are not read, but ``carry`` must not
    name a column of the result.
    """
    small_batches(docs.sparkSession)
    rows = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), *carry, fingerprints(F.col("text"), words).alias("fp")))
    distinct = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = components(links(distinct, tau)).withColumnRenamed("node", "fp")
    rooted = cut(distinct.join(found, "fp"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = rooted.join(ids, "root").select("fp", "component_id", "root")
    known = distinct.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"), F.coalesce("root", "fp").alias("root"))
    return rows.join(cut(known), "fp").select("doc_id", *carry, "fp", "component_id", "root")
