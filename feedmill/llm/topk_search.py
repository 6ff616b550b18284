"""Exact search for the highest inner products, by norm buckets.

Vectors are grouped by length into buckets, blocks of one bucket are searched on
their own.  For a query q with a threshold theta (a score that its k-th best
surely reaches), a vector of length l only matters if theta <= |q| l, and only if
its cosine with q is at least t = theta / (|q| l).  So a query goes only to the
buckets whose longest vector is long enough for it, and a vector only to the
chunks of queries that one of its length may matter to: chunks are ranges of
theta / |q|.  In a block, runs of vectors from the longest on have thresholds of
their own.  Where t says little, vectors are pruned by length.  Where it says
much, by coordinates: a unit vector p with cosine t or more to the unit vector q
has each coordinate within q_f t +- sqrt((1 - q_f^2)(1 - t^2)), without upper
bound where q_f >= t and without lower one where q_f <= -t, which is tried on q's
largest coordinates.  What is left is verified by whole products.

Components are whole numbers held as doubles.  Products are summed as doubles
where every sum stays under 2^53, as 64-bit numbers where it stays under 2^63,
and as numbers of any width beyond.
"""

from __future__ import annotations

from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

VECTOR = "at long, vec_id long, dim int, norm double, q binary"
FOUND = "query_at long, query_id long, vec_id long, score long, beyond string"
LOW, HIGH = -(2**63), 2**63 - 1
#: Components of a block of vectors, at most, and vectors of a run.
BLOCK, RUN = 1 << 22, 2048


def _norms(x: np.ndarray) -> np.ndarray:
    """Lengths of rows, also of rows whose squares are too large for doubles."""
    top = np.abs(x).max(1, initial=0.0)
    return top * np.sqrt(((x / np.where(top > 0, top, 1.0)[:, None]) ** 2).sum(1))


def _quantised(scale: float):
    """Rows (at, vec_id, embedding) to whole numbers floor(scale * x)."""

    def rows(batches):
        for batch in batches:
            vectors = batch.column(2).cast(pa.list_(pa.float64()))
            out = []
            flat, off = vectors.values.to_numpy(zero_copy_only=False), vectors.offsets.to_numpy()
            with np.errstate(over="ignore", invalid="ignore"):
                for i, (a, b) in enumerate(zip(off[:-1], off[1:])):
                    x = np.floor(scale * flat[a:b])
                    if np.isfinite(x).all():
                        out.append((i, len(x), float(_norms(x[None])[0]), x.astype("<f8").tobytes()))
            where, dim, norm, q = zip(*out) if out else ((), (), (), ())
            where = pa.array(where, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(where), batch.column(1).take(where), pa.array(dim, pa.int32()), pa.array(norm, pa.float64()), pa.array(q, pa.binary())], ["at", "vec_id", "dim", "norm", "q"])

    return rows


def _matrix(blobs, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), "<f8").reshape(len(blobs), dim)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``a`` and ``b``, pair by pair: as
    doubles, 64-bit numbers or Python integers, whichever holds every sum."""
    bound = a.shape[1] * float(np.abs(a).max(initial=0.0)) * float(np.abs(b).max(initial=0.0))
    if bound < 2.0**53:
        return np.einsum("ij,ij->i", a, b)
    if bound < 2.0**62:
        return np.einsum("ij,ij->i", a.astype(np.int64), b.astype(np.int64))
    out = np.empty(len(a), object)
    out[:] = [sum(int(x) * int(y) for x, y in zip(p, q)) for p, q in zip(a.tolist(), b.tolist())]
    return out


def _as_double(score: np.ndarray) -> np.ndarray:
    """For thresholds: numbers beyond the range of doubles become infinite."""
    if score.dtype != object:
        return score.astype(np.float64)
    top = 1 << 1023
    return np.array([float(s) if -top < s < top else (np.inf if s > 0 else -np.inf) for s in score], np.float64)


def _best(query: np.ndarray, score: np.ndarray, vec: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows (query, score, vec) the k best of each query."""
    if score.dtype == object:
        order = np.array(sorted(range(len(query)), key=lambda i: (query[i], -score[i], vec[i])), np.int64)
    else:
        order = np.lexsort((vec, -score, query))
    query, score, vec = query[order], score[order], vec[order]
    keep = np.arange(len(query)) - np.searchsorted(query, query, "left") < k
    return query[keep], score[keep], vec[keep]


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Scores side by side, exact: doubles and 64-bit numbers meet as the latter."""
    if len(a) and len(b) and a.dtype != b.dtype:
        kind = object if object in (a.dtype, b.dtype) else np.int64
        a, b = (x if x.dtype == kind else np.array([int(v) for v in x], kind) for x in (a, b))
    return np.concatenate((a, b)) if len(a) and len(b) else (a if len(a) else b)


def _kth(query: np.ndarray, score: np.ndarray, n: int, k: int) -> np.ndarray:
    """Each query's k-th best score so far; rows are sorted as _best gives them."""
    out = np.full(n, -np.inf)
    last = np.arange(len(query)) - np.searchsorted(query, query, "left") == k - 1
    out[query[last]] = _as_double(score[last])
    return out


def _lowered(theta: np.ndarray) -> np.ndarray:
    """Thresholds with room for rounding."""
    return np.where(np.isfinite(theta), theta - 1e-9 * np.abs(theta) - 1e-6, -np.inf)


def _floor(sample: dict[int, tuple[np.ndarray, np.ndarray]], k: int):
    """Adds to queries a score that their k-th best surely reaches, from the
    sampled vectors, and the least length of vectors that matter."""

    def rows(batches):
        for batch in batches:
            own, dims, norm = (batch.column(c).to_numpy() for c in (0, 2, 3))
            theta = np.full(len(own), -np.inf)
            for dim in np.unique(dims):
                mine = np.flatnonzero(dims == dim)
                at, m = sample.get(int(dim), (np.empty(0, np.int64), np.empty((0, dim))))
                if len(at) < k + 1:
                    continue
                x = _matrix(batch.column(4).take(pa.array(mine)).to_pylist(), int(dim))
                for a in range(0, len(mine), 256):
                    with np.errstate(over="ignore", invalid="ignore"):
                        score = x[a : a + 256] @ m.T
                    score[own[mine[a : a + 256], None] == at] = -np.inf
                    error = dim * 2.0**-52 * norm[mine[a : a + 256]] * _norms(m).max(initial=0)
                    theta[mine[a : a + 256]] = np.partition(np.where(np.isfinite(score), score, -np.inf), -k, 1)[:, -k] - error
            theta = _lowered(theta)
            with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
                needs = np.where((theta > 0) & (norm > 0), theta / norm * (1 - 1e-9), 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(theta), pa.array(np.nan_to_num(needs))], [*batch.schema.names, "theta", "needs"])

    return rows


def _left(unit_q: np.ndarray, unit_p: np.ndarray, t: np.ndarray, coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that coordinate pruning leaves: each query's largest coordinates
    against what its local threshold allows there."""
    focus = np.argsort(-np.abs(unit_q), 1)[:, :coordinates]
    left = np.ones((len(unit_q), len(unit_p)), bool)
    for c in range(focus.shape[1]):
        qf = unit_q[np.arange(len(unit_q)), focus[:, c]]
        middle, half = qf * t, np.sqrt(np.maximum(0, (1 - qf**2) * (1 - t**2)))
        low = np.where(qf <= -t, -1.0, middle - half) - 1e-9
        high = np.where(qf >= t, 1.0, middle + half) + 1e-9
        p = unit_p[:, focus[:, c]].T
        left &= (p >= low[:, None]) & (p <= high[:, None])
    return np.nonzero(left)


def _units(x: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return x / np.where(norm > 0, norm, 1.0)[:, None]


def _beyond(score: int) -> str | None:
    """For a score that 64 bits don't hold, text that sorts as its value does."""
    if score > HIGH:
        return f"p{len(str(score)):06}{score}"
    if score <= LOW:
        return f"n{999_999 - len(str(-score)):06}" + "".join(str(9 - int(d)) for d in str(-score))
    return None


def _search(k: int, selective: float, coordinates: int):
    def search(key: tuple, queries: pa.Table, vectors: pa.Table) -> pa.Table:
        dim, nq = key[-1].as_py(), queries.num_rows
        at, ids, theta, ql = (queries.column(c).to_numpy() for c in ("at", "vec_id", "theta", "norm"))
        own, vec, norm = (vectors.column(c).to_numpy() for c in ("at", "vec_id", "norm"))
        q, p_all = (_matrix(t.column("q").to_pylist(), dim) for t in (queries, vectors))
        theta, unit_q = theta.copy(), _units(q, ql)
        exact = dim * float(np.abs(q).max(initial=0.0)) * float(np.abs(p_all).max(initial=0.0)) < 2.0**53
        best = (np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64))
        longest_first = np.argsort(-norm, kind="stable")
        for a in range(0, len(norm), RUN):
            rows = longest_first[a : a + RUN]
            p, lengths = p_all[rows], norm[rows]
            unit_p = _units(p, lengths)
            for b in range(0, nq, 512):
                some = np.arange(b, min(nq, b + 512))
                with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
                    some = some[~(theta[some] > ql[some] * lengths[0] * (1 + 1e-9))]
                    t = np.nan_to_num(theta[some] / (ql[some] * lengths[0]), nan=-1.0, posinf=-1.0, neginf=-1.0)
                    by_coordinate = t >= selective
                    c, d = _left(unit_q[some[by_coordinate]], unit_p, np.minimum(t[by_coordinate] * (1 - 1e-9), 1), coordinates)
                    mine = some[~by_coordinate]
                    e, f = np.nonzero(~(theta[mine][:, None] > ql[mine][:, None] * lengths[None, :] * (1 + 1e-9)))
                x, y = np.concatenate((some[by_coordinate][c], mine[e])), np.concatenate((d, f))
                other = at[x] != own[rows][y]
                x, y = x[other], y[other]
                # Where much is left, one matrix product gives all that is asked for.
                grid = q[some] @ p.T if exact and 8 * len(x) > len(some) * len(p) else None
                size = len(x) if grid is not None else 65536
                for s in range(0, len(x), max(size, 1)):
                    xs, ys = x[s : s + size], y[s : s + size]
                    score = products(q[xs], p[ys]) if grid is None else grid[np.searchsorted(some, xs), ys]
                    keep = _as_double(score) >= theta[xs]
                    if keep.any():
                        best = _best(np.concatenate((best[0], xs[keep])), _joined(best[1], score[keep]), np.concatenate((best[2], vec[rows][ys[keep]])), k)
                theta = np.maximum(theta, _lowered(_kth(best[0], best[1], nq, k)))
        whole = [int(s) for s in best[1].tolist()]
        out = {"query_at": at[best[0]], "query_id": ids[best[0]], "vec_id": best[2], "score": [min(max(s, LOW), HIGH) for s in whole], "beyond": [_beyond(s) for s in whole]}
        kinds = [pa.int64()] * 4 + [pa.string()]
        return pa.table({name: pa.array(v, kind) for (name, v), kind in zip(out.items(), kinds)})

    return search


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    scale: float = 256.0,
    buckets: int = 16,
    sample: int = 1024,
    selective: float = 0.2,
    coordinates: int = 3,
) -> DataFrame:
    """The ``k`` highest inner products of each query: query_id, rank, vec_id,
    score, beyond; ties go to the smaller vec_id.

    ``vectors``: vec_id, embedding; ``is_query``: which of them are queries, by
    vec_id.  A vector's components are floor(scale * x), of any size that a double
    holds; a score that 64 bits don't hold is ranked by its exact value, ``score``
    is then the nearest 64-bit number, and ``beyond`` tells it from others (null
    for all others).  Rows take no part if vec_id or embedding is null, or a
    component is null or, as given or scaled, not finite.  Products are between
    vectors of one dimension; empty vectors have products of zero.  A row is told
    from others by its place, not its vec_id: repeated rows are queries and
    candidates each, and so give the same ranks more than once.  An empty table
    gives an empty result; columns but vec_id and embedding are not read, so
    clashing names do no harm.  First thresholds come from the ``sample`` longest
    vectors; they only save work.
    """
    base = vectors.where("vec_id is not null and embedding is not null and not exists(embedding, x -> x is null)")
    base = base.select(F.monotonically_increasing_id().alias("at"), F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    base = cut(base.mapInArrow(_quantised(scale), VECTOR))
    asked = base.where(is_query)
    n, widest = base.agg(F.count("*"), F.coalesce(F.max("dim"), F.lit(1))).first()
    edges = sorted(set(base.agg(F.percentile_approx("norm", [i / buckets for i in range(1, buckets + 1)], 1000)).first()[0] or [0.0]))
    longest = base.orderBy(F.col("norm").desc(), "at").limit(sample).toPandas()
    held = {int(d): (g["at"].to_numpy(), _matrix(list(g["q"]), int(d))) for d, g in longest.groupby("dim")}
    asked = cut(asked.mapInArrow(_floor(held, k), VECTOR + ", theta double, needs double"))
    n_asked = asked.count()

    # Blocks of vectors have at most about BLOCK components, and are at least about sqrt(n) / 4; chunks of queries are a quarter as many rows or less.
    blocks = max(1, ceil(max(n * max(widest, 1) / BLOCK, sqrt(n) / 4) / len(edges)))
    chunks = max(1, min(ceil(n_asked * max(widest, 1) * 4 / BLOCK) + ceil(sqrt(n_asked) / 16), 4096))
    least = sorted(set(asked.agg(F.percentile_approx("needs", [i / chunks for i in range(chunks)], 1000)).first()[0] or [0.0]))
    split = lambda c: F.pmod(F.xxhash64(F.lit(c), "at"), F.lit(max(1, ceil(chunks / len(least))))).cast("int")
    ends, starts = F.array(*[F.lit(float(e)) for e in edges]), F.array(*[F.lit(float(s)) for s in least])
    place = lambda bounds, c, inside: F.size(F.filter(bounds, lambda e: inside(e, F.col(c))))
    # A query's chunk: the last start at or under what it needs.  A vector's bucket: the edges under its length; the last holds what is longer than any.
    chunk = F.greatest(place(starts, "needs", lambda s, x: s <= x) - 1, F.lit(0))
    bucket = F.least(place(ends, "norm", lambda e, x: e < x), F.lit(len(edges) - 1))
    longer = F.filter(F.sequence(F.lit(0), F.lit(len(edges) - 1)), lambda b: (b == len(edges) - 1) | (F.element_at(ends, b + 1) >= F.col("needs")))
    for_it = F.filter(F.sequence(F.lit(0), F.lit(len(least) - 1)), lambda c: (c == 0) | (F.element_at(starts, c + 1) <= F.col("norm")))
    every = F.sequence(F.lit(0), F.lit(blocks - 1))
    lots = F.sequence(F.lit(0), F.lit(max(1, ceil(chunks / len(least))) - 1))
    left = asked.withColumns({"chunk": chunk, "lot": split(1), "bucket": F.explode(longer)}).withColumn("block", F.explode(every))
    right = base.withColumns({"bucket": bucket, "block": F.pmod(F.xxhash64(F.lit(2), "at"), F.lit(blocks)).cast("int"), "chunk": F.explode(for_it)}).withColumn("lot", F.explode(lots))
    keys = ["chunk", "lot", "bucket", "block", "dim"]
    pairs = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_search(k, selective, coordinates), FOUND)
    order = Window.partitionBy("query_at").orderBy(F.col("score").desc(), F.coalesce("beyond", F.lit("")).desc(), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", "beyond")
