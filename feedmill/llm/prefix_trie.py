"""The trie of conversations: one node for each distinct beginning.

A conversation becomes one packed row: 24 bytes a turn, of which 16 are a digest
of role and text and 8 the text's length.  Conversations with the same turns fold
to one path before anything is built.  Paths are dealt by the digest of their first
turn, and ``applyInPandas`` builds the tries of a bucket from dictionaries of
pointers and sums them up by an iterative postorder.

A first turn whose paths are too many for a task is cut out as an edge, the longest
beginning that all its paths share, and its paths are dealt anew by the next turn,
again and again until all parts fit.  What stands below an edge is summed up by
partial sums, so no task ever holds a hot subtrie.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from zlib import crc32

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded, cut, marked, marks

#: Turns of paths that a bucket holds, about; a beginning with more is split.
BUCKET = 4_000
#: Conversations with the same turns, from which on their ids are hashed in chunks,
#: and the ids of a chunk.
MANY, CHUNK = 4_096, 8_192
#: Bytes of a turn in a path, and of a digest.
ENTRY, DIGEST = 24, 16
ROOT, NOTHING = bytes(DIGEST), hashlib.sha256(b"").hexdigest()
NODE = "node_id binary, parent_id binary, turn_digest binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def turn_digest(role: Column, text: Column) -> Column:
    """16 bytes for a turn; null counts as empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.substring(F.sha2(whole.cast("binary"), 256), 1, 2 * DIGEST))


def child_id(parent: bytes, entry: bytes) -> bytes:
    return hashlib.sha256(parent + entry).digest()[:DIGEST]


def _child_id(parent: Column, path: Column, depth: Column) -> Column:
    """``child_id`` of the node at ``depth`` under its parent, as an expression."""
    return F.unhex(F.substring(F.sha2(F.concat(parent, F.substring(path, depth * ENTRY - (ENTRY - 1), F.lit(ENTRY))), 256), 1, 2 * DIGEST))


def _joined(most: int | None):
    """Sorted rows (base, conv_id, entry) to one row for each conversation."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, parts, out = None, {}, []

        def rebuilt():
            whole = {c: b"".join(entries) for c, entries in parts.items()}
            for c, own in whole.items():
                h = ENTRY * (crc32(str(c).encode()) % most) if most else 0
                path = whole.get(base, b"")[:h] + own[h:]
                out.append((c, hashlib.sha256(path).digest()[:DIGEST], path))

        def packed():
            ids, digests, paths = zip(*out)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(digests, pa.binary()), pa.array(paths, pa.binary())], ["conv_id", "path_id", "path"])

        for batch in batches:
            for b, c, entry in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if b != base:
                    rebuilt()
                    base, parts = b, {}
                    if len(out) >= 1000:
                        yield packed()
                parts.setdefault(c, []).append(entry)
        rebuilt()
        if out:
            yield packed()

    return rows


def paths(conversations: DataFrame, splice: tuple[int, int] | None = None) -> DataFrame:
    """conv_id, path_id, path: each conversation's turns in order, packed.

    With ``splice`` (span, most) a conversation c gets the first h turns of
    conversation c - c % span for its own first h, h being crc32 of c as text modulo
    ``most``.
    """
    c = F.col
    span = splice[0] if splice else 1
    turns = conversations.where("conv_id is not null").select(
        (c("conv_id").cast("long") - c("conv_id").cast("long") % span).alias("base"),
        c("conv_id").cast("long").alias("conv_id"),
        c("turn").cast("long").alias("turn"),
        F.concat(turn_digest(c("role"), c("text")), F.unhex(F.lpad(F.hex(F.octet_length(F.coalesce("text", F.lit(""))).cast("long")), 16, "0"))).alias("entry"),
    )
    ordered = turns.repartition("base").sortWithinPartitions("base", "conv_id", c("turn").asc_nulls_first(), "entry")
    return ordered.select("base", "conv_id", "entry").mapInArrow(_joined(splice[1] if splice else None), "conv_id long, path_id binary, path binary")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (path_id, conv_id) to rows of up to CHUNK ids, comma-joined."""
    held: list[int] = []
    now = None

    def packed():
        return pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([held[0]], pa.int64()), pa.array([",".join(map(str, held))])], ["path_id", "first", "ids"])

    for batch in batches:
        for path, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if held and (path != now or len(held) >= CHUNK):
                yield packed()
                held = []
            now = path
            held.append(conv)
    if held:
        yield packed()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted chunks to one digest for each path, a chunk at a time."""
    now, digest = None, None

    def packed():
        return pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([digest.hexdigest()])], ["path_id", "ends"])

    for batch in batches:
        for path, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if path != now:
                if digest is not None:
                    yield packed()
                now, digest = path, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
    if digest is not None:
        yield packed()


def ends_of(found: DataFrame, counts: DataFrame) -> DataFrame:
    """path_id, ends: the digest of the sorted ids of each path's conversations."""
    ids = found.select("path_id", "conv_id")
    few = lambda rows: rows.groupBy("path_id").agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").cast("binary"), 256).alias("ends"))
    hot = counts.where(F.col("n") > MANY).select("path_id")
    if hot.isEmpty():
        return few(ids)
    ids = marked(ids, ["path_id"], marks(hot, ["path_id"]))
    chunks = ids.where("_fm_marked").select("path_id", "conv_id").repartitionByRange("path_id", "conv_id").sortWithinPartitions("path_id", "conv_id").mapInArrow(_chunks, "path_id binary, first long, ids string")
    many = cut(chunks).repartition("path_id").sortWithinPartitions("path_id", "first").mapInArrow(_hashed, "path_id binary, ends string")
    return few(ids.where("not _fm_marked")).unionByName(many)


@F.pandas_udf(T.StructType([T.StructField("edge_id", T.BinaryType()), T.StructField("upto", T.IntegerType()), T.StructField("segment", T.BinaryType())]))
def _shared(low: pd.Series, high: pd.Series, depth: pd.Series, parent: pd.Series) -> pd.DataFrame:
    """The edge of paths between ``low`` and ``high``: as their order is bytewise,
    what these two share from ``depth`` on all of them share."""
    out = []
    for a, b, k, node in zip(low, high, depth, parent):
        upto = k
        while a[upto * ENTRY : (upto + 1) * ENTRY] == b[upto * ENTRY : (upto + 1) * ENTRY] != b"":
            upto += 1
        segment = bytes(a[(k - 1) * ENTRY : upto * ENTRY])
        for i in range(0, len(segment), ENTRY):
            node = child_id(node, segment[i : i + ENTRY])
        out.append((node, upto, segment))
    return pd.DataFrame(out, columns=["edge_id", "upto", "segment"])


def _tries(rows: pd.DataFrame) -> pd.DataFrame:
    """The nodes of all tries of a bucket, each trie from depth k on down."""
    kids: list[dict[bytes, int]] = []
    ids, above, entries, depth, convs, least, ends, trails = [], [], [], [], [], [], [], []
    tops: dict[bytes, int] = {}

    def node(node_id: bytes, parent: int, entry: bytes, at: int, trail) -> int:
        kids.append({})
        for values, value in ((ids, node_id), (above, parent), (entries, entry), (depth, at), (convs, 0), (least, None), (ends, NOTHING), (trails, trail)):
            values.append(value)
        return len(kids) - 1

    for path, k, key, n, conv, digest, trail in zip(rows["path"], rows["k"], rows["key"], rows["n"], rows["conv_id"], rows["ends"], rows["trail"]):
        x = tops.get(key)
        if x is None:
            x = tops[key] = node(key, -1, path[(k - 1) * ENTRY : k * ENTRY], k, list(trail))
        at = k
        while True:
            convs[x] += n
            least[x] = conv if least[x] is None else min(conv, least[x])
            entry = path[at * ENTRY : (at + 1) * ENTRY]
            if not entry:
                break
            down = kids[x].get(entry)
            if down is None:
                down = kids[x][entry] = node(child_id(ids[x], entry), x, entry, at + 1, None)
            x, at = down, at + 1
        ends[x] = digest

    order, stack = [], list(tops.values())
    while stack:  # parents before children; read backwards it is a postorder
        order.append(x := stack.pop())
        stack.extend(kids[x].values())
    leaves, saved = [0] * len(kids), [0] * len(kids)
    for x in reversed(order):
        leaves[x] = leaves[x] or 1
        saved[x] += (convs[x] - 1) * int.from_bytes(entries[x][DIGEST:], "big")
        if above[x] >= 0:
            leaves[above[x]] += leaves[x]
            saved[above[x]] += saved[x]
    return pd.DataFrame({
        "node_id": ids, "parent_id": [trails[x][-1] if p < 0 else ids[p] for x, p in enumerate(above)], "turn_digest": [e[:DIGEST] for e in entries], "depth": depth,
        "conv_id": least, "parent_conv_id": pd.array([None if p < 0 else least[p] for p in above], "Int64"), "n_convs": convs, "n_children": [len(x) for x in kids], "n_leaves": leaves,
        "saved_tokens": saved, "ends_sha256": ends, "trail": trails,
    })


def _edge_nodes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Nodes of edges, whose inner nodes have one child each."""
    for edges in batches:
        out = []
        for e in edges.itertuples():
            if e.edge_id == ROOT:
                out.append((ROOT, None, None, 0, e.conv_id, None, e.n, e.n_children, e.n_leaves, e.saved, e.ends))
                continue
            node, parent_conv, saved = e.parent_id, e.parent_conv_id, e.saved
            for at in range(0, len(e.segment), ENTRY):
                entry, last = bytes(e.segment[at : at + ENTRY]), at + ENTRY == len(e.segment)
                parent, node = node, child_id(node, entry)
                out.append((node, parent, entry[:DIGEST], e.start + at // ENTRY, e.conv_id, parent_conv, e.n, e.n_children if last else 1, e.n_leaves, saved, e.ends if last else NOTHING))
                saved, parent_conv = saved - (e.n - 1) * int.from_bytes(entry[DIGEST:], "big"), e.conv_id
        frame = pd.DataFrame(out, columns=[f.split()[0] for f in NODE.split(", ")])
        yield frame.astype({"parent_conv_id": "Int64"})


@F.pandas_udf(T.LongType())
def _bytes_of(segment: pd.Series) -> pd.Series:
    return segment.map(lambda s: sum(int.from_bytes(s[i + DIGEST : i + ENTRY], "big") for i in range(0, len(s), ENTRY)))


def trie(conversations: DataFrame, splice: tuple[int, int] | None = None) -> DataFrame:
    """The nodes of the trie of ``conversations`` (conv_id, turn, role, text).

    A node stands for a distinct sequence of first turns; its members are the
    conversations that start so.  Columns: node_id, parent_id, turn_digest (of its
    last turn: ``turn_digest``), depth, conv_id (smallest member), parent_conv_id,
    n_convs (members), n_children, n_leaves, saved_tokens (over its subtree, each
    node's members but one times the bytes of its last text), ends_sha256 (digest of
    the comma-joined ids of the members that end here).

    Turns go by their number, null first; turns with the same number, repeated rows
    too, go by their digest.  Null roles and texts count as empty.  Rows with a null
    conv_id belong to no conversation.  Whole texts count, however long; a
    conversation's turns are one row of 24 bytes each.  An empty table gives no node.
    Other columns are not read.
    """
    c = F.col
    found = cut(paths(conversations, splice))
    counts = cut(found.groupBy("path_id").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id"), F.first("path").alias("path")))
    turns = F.octet_length("path") / ENTRY
    total = counts.agg(F.sum(turns + 1)).first()[0]
    if total is None:
        return conversations.sparkSession.createDataFrame([], NODE)
    buckets = int(total // BUCKET) + 1
    left = counts.join(ends_of(found, counts), "path_id").withColumns({"edge_id": F.lit(ROOT), "upto": F.lit(0), "trail": F.array(F.lit(ROOT))})
    edges = [conversations.sparkSession.createDataFrame([(ROOT, None, 0, 0, b"", [ROOT])], "edge_id binary, parent_id binary, start int, upto int, segment binary, trail array<binary>")]
    cold, ended = [], []
    carry = ["path", "n", "conv_id", "ends", "trail"]
    while True:
        over = turns <= c("upto")
        ended.append(left.where(over).select("edge_id", *carry[1:]))
        on = left.where(~over).select(*carry, (c("upto") + 1).alias("k"), _child_id(c("edge_id"), c("path"), c("upto") + 1).alias("key"))
        left = cut(on)
        size = left.groupBy("key").agg(F.sum(turns - c("k") + 1).alias("size"), F.count("*").alias("paths"), F.min("path").alias("low"), F.max("path").alias("high"), F.first("k").alias("k"), F.first("trail").alias("trail"))
        big = size.where((c("size") > BUCKET) & (c("paths") > 1)).withColumn("parent_id", F.element_at("trail", -1))
        edge = big.select("key", "parent_id", c("k").alias("start"), "trail", _shared("low", "high", "k", "parent_id").alias("e"))
        edge = cut(edge.select("key", "parent_id", "start", "e.*", F.array_append("trail", c("e.edge_id")).alias("trail")))
        if edge.isEmpty():
            cold.append(left)
            break
        edges.append(edge.select("edge_id", "parent_id", "start", "upto", "segment", "trail"))
        split = left.join(bounded(edge.select("key", "edge_id", "upto", c("trail").alias("through"))), "key", "left")
        cold.append(split.where("edge_id is null").select(left.columns))
        left = split.where("edge_id is not null").select(*carry[:-1], c("through").alias("trail"), "edge_id", "upto")

    def union(frames: list[DataFrame]) -> DataFrame:
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out

    dealt = union(cold).withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    nodes = cut(dealt.groupBy("bucket").applyInPandas(_tries, f"{NODE}, trail array<binary>"))
    ended, edges = union(ended), union(edges)
    tops = nodes.where("trail is not null")
    zero = F.lit(0).cast("long")
    below = tops.select(F.explode("trail").alias("edge_id"), c("n_convs").alias("n"), "conv_id", "n_leaves", "saved_tokens").unionByName(ended.select(F.explode("trail").alias("edge_id"), "n", "conv_id", zero.alias("n_leaves"), zero.alias("saved_tokens")))
    sums = below.groupBy("edge_id").agg(F.sum("n").alias("n"), F.min("conv_id").alias("conv_id"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    children = tops.select(F.element_at("trail", -1).alias("edge_id")).unionByName(edges.where("parent_id is not null").select(c("parent_id").alias("edge_id"))).groupBy("edge_id").agg(F.count("*").alias("n_children"))
    known = cut(edges.join(sums, "edge_id").join(children, "edge_id", "left").join(ended.select("edge_id", "ends"), "edge_id", "left").withColumn("own", (c("n") - 1) * _bytes_of("segment")))
    own = known.select(F.explode("trail").alias("edge_id"), "own").groupBy("edge_id").agg(F.sum("own").alias("under"))
    parent = known.select(c("edge_id").alias("parent_id"), c("conv_id").alias("parent_conv_id"))
    full = known.join(own, "edge_id").join(parent, "parent_id", "left").select(
        "edge_id", "parent_id", "start", "segment", "conv_id", "parent_conv_id", "n", F.coalesce("n_children", zero).alias("n_children"), F.greatest("n_leaves", F.lit(1)).alias("n_leaves"),
        (c("saved_tokens") + c("under")).alias("saved"), F.coalesce("ends", F.lit(NOTHING)).alias("ends"),
    )
    names = [f.split()[0] for f in NODE.split(", ")]
    top = known.where(c("edge_id") == F.lit(ROOT)).first()["conv_id"]
    first = tops.where(c("parent_id") == F.lit(ROOT)).withColumn("parent_conv_id", F.lit(top)).select(names)
    later = tops.where(c("parent_id") != F.lit(ROOT)).drop("parent_conv_id").join(bounded(parent), "parent_id").select(names)
    return full.mapInPandas(_edge_nodes, NODE).unionByName(nodes.where("trail is null").select(names)).unionByName(first).unionByName(later)
