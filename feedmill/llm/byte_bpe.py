"""Byte-level BPE encoding and decoding with recursive DuckDB queries.

In each partition the distinct words of a batch become token-position rows.  A
recursive query joins neighbouring tokens to the merge table and contracts each
word's leftmost pair of least rank until no pair is left.  The recursion is keyed
by word and position, so only the live state of each row is held.  Ordered
aggregation joins the ids of each text and decodes them to its bytes again.
Aggregates over sorted rows are several times as fast as ones that sort, but may
take rows in another order when memory is short; so each also lists the positions
as it met them, and where these don't rise the aggregates are run again with an
order.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import sys
import types
import uuid
from collections.abc import Iterator
from itertools import islice

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches

#: Distinct words whose ids a worker remembers; beyond that it keeps those that were
#: met again since it last did so.
REMEMBERED = 400_000
#: Distinct words, and their bytes, in one recursive query; a longer word is alone.
AT_ONCE, ROWS = 60_000, 300_000
#: Words of more bytes take several contractions in a step, see IN_RUNS; and words of
#: so many that rows of them would not fit, which the library codes.
SHORT, LONG = 64, 16_384
#: Characters of text that are handled at once, and matches of one longer text.
CHUNK, MATCHES = 1_000_000, 200_000

_TOKENS = """
WITH RECURSIVE token(word, pos, next_pos, id, next_id, merged, alone) USING KEY (word, pos) AS (
    SELECT word, pos, next_pos, id, next_id, m.merged, m.alone FROM start LEFT JOIN merges m ON m.l = id AND m.r = next_id
  UNION ALL
    SELECT n.*, m.merged, m.alone FROM ({step}) n LEFT JOIN merges m ON m.l = n.id AND m.r = n.next_id
)
SELECT word, count(*)::INTEGER AS n, string_agg(id::VARCHAR, ' '{{order}}) AS ids, string_agg(chars, ''{{order}}) AS chars, list(pos{{order}}) AS seen FROM (
    SELECT t.word, t.pos, t.id, v.chars FROM token t JOIN vocabulary v ON v.id = t.id ORDER BY t.word, t.pos
) GROUP BY word
"""

#: start: word, pos, next_pos, id, next_id.  A row knows its right neighbour and
#: the rank of what both give.  Of each word the row of least rank, leftmost, takes
#: its neighbour's place, which goes (no id).  A word without pairs is settled.
CONTRACT = _TOKENS.format(step="""
    SELECT t.word, t.pos,
        CASE WHEN t.pos = b.here THEN b.next_pos ELSE t.next_pos END AS next_pos,
        CASE WHEN t.pos = b.here THEN b.merged WHEN t.pos <> b.gone THEN t.id END AS id,
        CASE WHEN t.pos = b.here THEN b.next_id WHEN t.pos = b.gone THEN NULL WHEN t.next_pos = b.here THEN b.merged ELSE t.next_id END AS next_id
    FROM token t JOIN (
        SELECT a.word, h.pos AS here, h.merged, g.pos AS gone, g.next_pos, g.next_id
        FROM (SELECT word, min((merged::BIGINT << 32) + pos) AS best FROM token WHERE merged IS NOT NULL GROUP BY word) a
        JOIN token h ON h.word = a.word AND h.pos = (a.best & 4294967295)::INTEGER
        JOIN token g ON g.word = a.word AND g.pos = h.next_pos
    ) b ON b.word = t.word WHERE t.id IS NOT NULL
""")

#: The same for long words, with fewer steps: all pairs of the word's least rank
#: that don't overlap, from the left, in one step.  That gives what one at a time
#: gives, unless what they give pairs with a neighbour at a lower rank still; such
#: tokens (``alone``) are contracted one at a time.
IN_RUNS = _TOKENS.format(step="""
    WITH hit AS (
        SELECT t.word, t.pos, t.next_pos, t.merged, t.alone, row_number() OVER w AS i, lag(t.next_pos) OVER w IS NOT DISTINCT FROM t.pos AS goes_on
        FROM token t JOIN (SELECT word, min(merged) AS merged FROM token WHERE merged IS NOT NULL GROUP BY word) l ON l.word = t.word AND l.merged = t.merged
        WINDOW w AS (PARTITION BY t.word ORDER BY t.pos)),
    run AS (SELECT *, i - max(CASE WHEN NOT goes_on THEN i END) OVER (PARTITION BY word ORDER BY pos) AS in_run FROM hit),
    c AS MATERIALIZED (
        SELECT r.word, r.pos AS here, r.next_pos AS gone, r.merged, g.next_pos, g.next_id
        FROM run r JOIN token g ON g.word = r.word AND g.pos = r.next_pos WHERE r.in_run % 2 = 0 AND (r.i = 1 OR NOT r.alone))
    SELECT t.word, t.pos, CASE WHEN h.here IS NULL THEN t.next_pos ELSE h.next_pos END AS next_pos,
        CASE WHEN h.here IS NOT NULL THEN h.merged WHEN g.here IS NULL THEN t.id END AS id,
        CASE WHEN g.here IS NOT NULL THEN NULL WHEN x.here IS NOT NULL THEN x.merged WHEN h.here IS NOT NULL THEN h.next_id ELSE t.next_id END AS next_id
    FROM token t SEMI JOIN c ON c.word = t.word
    LEFT JOIN c h ON h.word = t.word AND h.here = t.pos LEFT JOIN c g ON g.word = t.word AND g.gone = t.pos
    LEFT JOIN c x ON x.word = t.word AND x.here = CASE WHEN h.here IS NULL THEN t.next_pos ELSE h.next_pos END
    WHERE t.id IS NOT NULL
""")

#: seen: doc, pos, word.  Of each text the number of its ids, the ids in order,
#: and the bytes that they stand for, each byte as the character of its number.
JOIN_UP = """
SELECT doc, sum(n)::BIGINT AS n, string_agg(ids, ' '{order}) AS ids, string_agg(chars, ''{order}) AS chars, list(pos{order}) AS seen
FROM (SELECT s.doc, s.pos, k.n, k.ids, k.chars FROM seen s JOIN known k ON k.word = s.word ORDER BY s.doc, s.pos) GROUP BY doc
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks by token of a rank file (base64 token, rank in each line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Coder:
    """The merge table and what is remembered, in one DuckDB connection."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "500MB", "temp_directory": ""})
        pairs = np.array([(ranks[w[:i]], ranks[w[i:]], rank) for w, rank in ranks.items() for i in range(1, len(w)) if w[:i] in ranks and w[i:] in ranks] or [(-1, -1, -1)], np.int32)
        low = np.concatenate([pairs[pairs[:, 2] < pairs[:, c], c] for c in (0, 1)])
        self._load("merges", {"l": pairs[:, 0], "r": pairs[:, 1], "merged": pairs[:, 2], "alone": np.isin(pairs[:, 2], low)})
        self._load("vocabulary", {"id": pa.array(ranks.values(), pa.int32()), "chars": [w.decode("latin-1") for w in ranks]})
        self.byte = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.forget()

    def _load(self, name: str, columns: dict) -> None:
        self.db.register("loading", pa.table(columns))
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM loading")
        self.db.unregister("loading")

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.again = np.zeros(0, bool)
        self.db.execute("CREATE OR REPLACE TABLE known (word INTEGER, n INTEGER, ids VARCHAR, chars VARCHAR)")

    def keep_met(self) -> None:
        """Forget the words that weren't met again, and all if these are few."""
        kept = np.flatnonzero(self.again)
        if len(kept) > REMEMBERED // 2:
            return self.forget()
        moved = np.full(len(self.again), -1)
        moved[kept] = np.arange(len(kept))
        self.number = {w: i for w, i in zip(self.number, moved.tolist()) if i >= 0}  # in the order of numbers
        self.again = np.zeros(len(kept), bool)
        self.db.register("moved", pa.table({"was": kept.astype(np.int32), "word": np.arange(len(kept), dtype=np.int32)}))
        self.db.execute("CREATE OR REPLACE TABLE known AS SELECT m.word, k.n, k.ids, k.chars FROM known k JOIN moved m ON m.was = k.word")
        self.db.unregister("moved")

    def learn(self, words: list[str]) -> None:
        """Encode words that aren't known yet."""
        first = len(self.number)
        self.number.update(zip(words, range(first, first + len(words))))
        self.again = np.append(self.again, np.zeros(len(words), bool))
        raw = [w.encode() for w in words]
        whole = [(first + i, self.ranks[w], w.decode("latin-1")) for i, w in enumerate(raw) if w in self.ranks]
        if whole:
            number, ids, chars = zip(*whole)
            self.db.register("whole", pa.table({"word": pa.array(number, pa.int32()), "id": pa.array(ids, pa.int32()), "chars": chars}))
            self.db.execute("INSERT INTO known SELECT word, 1, id::VARCHAR, chars FROM whole")
        todo = [(first + i, w) for i, w in enumerate(raw) if w not in self.ranks]
        if long := [x for x in todo if len(x[1]) > LONG]:
            self._long(long)
        for query, some in ((CONTRACT, [x for x in todo if len(x[1]) <= SHORT]), (IN_RUNS, [x for x in todo if SHORT < len(x[1]) <= LONG])):
            at = 0
            while at < len(some):
                to, size = at, 0
                while to < len(some) and to - at < AT_ONCE and (to == at or size + len(some[to][1]) <= ROWS):
                    size += len(some[to][1])
                    to += 1
                self._contract(query, some[at:to])
                at = to

    def _long(self, part: list[tuple[int, bytes]]) -> None:
        """Words of which a recursion would take time by the square of their length."""
        import tiktoken

        library = tiktoken.Encoding("long", pat_str=r"[\s\S]+", mergeable_ranks=self.ranks, special_tokens={})
        for number, word in part:
            ids = library.encode_ordinary(word.decode())
            row = [number], [len(ids)], [" ".join(map(str, ids))], [library.decode_bytes(ids).decode("latin-1")]
            self.db.register("long", pa.table([pa.array(row[0], pa.int32()), pa.array(row[1], pa.int32()), *map(pa.array, row[2:])], names=["word", "n", "ids", "chars"]))
            self.db.execute("INSERT INTO known SELECT word, n, ids, chars FROM long")
            self.db.unregister("long")

    def _contract(self, query: str, part: list[tuple[int, bytes]]) -> None:
        data = np.frombuffer(b"".join(w for _, w in part), np.uint8)
        length = np.array([len(w) for _, w in part])
        start = np.cumsum(length) - length
        pos = (np.arange(len(data)) - np.repeat(start, length)).astype(np.int32)
        last = np.zeros(len(data), bool)
        last[start + length - 1] = True
        ids = self.byte[data]
        columns = {
            "word": np.repeat(np.array([i for i, _ in part], np.int32), length),
            "pos": pos,
            "next_pos": pa.array(pos + 1, mask=last),
            "id": ids,
            "next_id": pa.array(np.append(ids[1:], np.int32(0)), mask=last),
        }
        self.db.register("start", pa.table(columns))
        self.db.register("met", self._ordered(query, "pos"))
        self.db.execute("INSERT INTO known SELECT word, n, ids, chars FROM met")
        self.db.unregister("met")

    def _ordered(self, query: str, by: str) -> pa.Table:
        """The query's rows, its aggregates in the order of ``by``."""
        out = self.db.sql(query.format(order="")).to_arrow_table().combine_chunks()
        seen = out["seen"].combine_chunks()
        if isinstance(seen, pa.ChunkedArray):
            seen = pa.concat_arrays(seen.chunks) if seen.num_chunks else pa.array([], pa.list_(pa.int64()))
        values, starts = seen.flatten().to_numpy(zero_copy_only=False), seen.offsets.to_numpy()
        falls = np.flatnonzero(np.diff(values) <= 0) + 1
        if not np.isin(falls, starts).all():
            out = self.db.sql(query.format(order=f" ORDER BY {by}")).to_arrow_table()
        return out.drop_columns(["seen"])

    def code(self, found: list[list[str]]) -> tuple[list[int], list[str], list[bytes]]:
        """Of each list of matches: the number of ids, the ids joined by a space,
        and the bytes that they decode to."""
        counts = np.array([len(x) for x in found], np.int64)
        flat = pa.array([w for x in found for w in x], pa.string()).dictionary_encode()
        words = flat.dictionary.to_pylist()
        fresh = [w for w in words if w not in self.number]
        if len(self.number) + len(fresh) > REMEMBERED:
            self.keep_met()
            fresh = [w for w in words if w not in self.number]
        self.again[[self.number[w] for w in words if w in self.number]] = True
        if fresh:
            self.learn(fresh)
        n, ids, decoded = [0] * len(found), [""] * len(found), [b""] * len(found)
        if words:
            number = np.array([self.number[w] for w in words], np.int32)[flat.indices.to_numpy()]
            start = np.cumsum(counts) - counts
            doc = np.repeat(np.arange(len(found), dtype=np.int32), counts)
            self.db.register("seen", pa.table({"doc": doc, "pos": np.arange(len(doc)) - np.repeat(start, counts), "word": number}))
            got = self._ordered(JOIN_UP, "pos")
            for i, *rest in zip(*(got[c].to_pylist() for c in ("doc", "n", "ids", "chars"))):
                n[i], ids[i], decoded[i] = rest[0], rest[1], rest[2].encode("latin-1")
        return n, ids, decoded

    def texts(self, texts: list[str | None]) -> Iterator[tuple[int, str, bytes]]:
        """Of each text what ``code`` gives; a very long text goes in parts."""

        def parts(held: list[str]):
            yield from zip(*self.code([self.pattern.findall(x) for x in held]))

        held, size = [], 0
        for x in (x or "" for x in texts):
            if held and size + len(x) > CHUNK:
                yield from parts(held)
                held, size = [], 0
            if len(x) <= CHUNK:
                held.append(x)
                size += len(x)
                continue
            matches, done = (m[0] for m in self.pattern.finditer(x)), []
            while part := list(islice(matches, MATCHES)):
                done.append(next(zip(*self.code([part]))))
            n, ids, decoded = zip(*done)
            yield sum(n), " ".join(ids), b"".join(decoded)
        if held:
            yield from parts(held)


def worker_coder(ranks: dict[bytes, int], pattern: str, mark: str) -> Coder:
    """The coder of this worker process.  Workers serve many tasks, so it stays
    between tasks of the same vocabulary; a task that fails takes it along."""
    held = sys.modules.setdefault("_feedmill_worker", types.ModuleType("_feedmill_worker")).__dict__
    if held.get("mark") != mark:
        held["coder"] = None
        held["coder"] = Coder(ranks, pattern)
    held["mark"] = None  # until the task gives it back
    return held["coder"]


def give_back(mark: str) -> None:
    sys.modules["_feedmill_worker"].__dict__["mark"] = mark


def release() -> None:
    """Drop what this worker remembers, where it now serves something else."""
    held = sys.modules.get("_feedmill_worker")
    if held is not None and held.__dict__.pop("coder", None) is not None:
        held.__dict__["mark"] = None
        gc.collect()
        pa.default_memory_pool().release_unused()


def coded(text: Column, ranks: dict[bytes, int], pattern: str, with_ids: bool = False) -> Column:
    """Struct column: n_tokens, ids_sha256, decoded_sha256, and with ``with_ids``
    the ids joined by spaces and the decoded text."""
    mark = uuid.uuid4().hex  # a worker's memory lasts for one use of the column
    kind = "struct<n_tokens: long, ids_sha256: string, decoded_sha256: string" + ", ids: string, decoded: string" * with_ids + ">"

    @F.arrow_udf(kind)
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = worker_coder(ranks, pattern, mark)
        for batch in batches:
            given, out = batch.to_pylist(), []
            for text, (n, ids, decoded) in zip(given, coder.texts(given)):
                if decoded != (text or "").encode():
                    raise RuntimeError("decoding does not give the text back")
                out.append((n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded).hexdigest(), *([ids, decoded.decode()] if with_ids else [])))
            pa.default_memory_pool().release_unused()
            out = list(zip(*out)) or [[]] * (3 + 2 * with_ids)
            names = ["n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"][: 3 + 2 * with_ids]
            kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]
            yield pa.StructArray.from_arrays([pa.array(x, t) for x, t in zip(out, kinds[: len(names)])], names)
        give_back(mark)

    return of(text)


def encode_decode(docs: DataFrame, path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """``docs`` with n_tokens, ids_sha256 and decoded_sha256 (and ids, decoded):
    every whole text encoded by the rank file at ``path``, each match of
    ``pattern`` separately, without special tokens, and decoded from its ids.

    Null texts count as empty; empty texts have no tokens.  Very long texts are
    coded in parts of so many matches, whole words always.  Words of up to LONG
    bytes are contracted by recursion, in time by the square of their length; longer
    ones are coded by the library, with the same ids.  Repeated rows are coded each; an empty table
    gives an empty result; columns of ``docs`` with the names of results are
    replaced.  The ranks are read by the driver and
    travel with the tasks, their size is the file's.
    """
    small_batches(docs.sparkSession)
    names = ["n_tokens", "ids_sha256", "decoded_sha256", *["ids", "decoded"] * with_ids]
    done = docs.drop(*names).withColumn("_fm_coded", coded(F.col("text"), read_ranks(path), pattern, with_ids))
    return done.select("*", *[F.col(f"_fm_coded.{n}").alias(n) for n in names]).drop("_fm_coded")
