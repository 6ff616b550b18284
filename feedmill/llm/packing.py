"""Packing documents into sequences of tokens: best fit, then swaps.

A task encodes its documents, cuts long ones into pieces and packs them, a block of
pieces at a time: by best fit, longest first, then by exchanges between bins that
aren't full.  An exchange moves one or two pieces from a bin to a fuller one, against
none, one or two of its pieces, if that raises the sum of squared fills; bins that
lose all their pieces go.  Only bins that are still underfull are shuffled, whole, to
be worked on with those of other tasks; each round has at most half the blocks of the
one before, so the last one leaves few of them whatever the corpus holds.

Ids come from parts of texts that are independent of each other; a worker keeps the
ids of parts that it has met, up to a bound.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from itertools import islice
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, small_batches
from .kept import Kept, ranks_of

#: Pieces of a block; tokens that a bin may lack to count as full.
BLOCK, SLACK = 20_000, 8
#: Characters of a text that are cut at once.
AT_ONCE = 1_000_000
#: The fixed pattern of tokenizers whose texts can be taken in parts.
WORDS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
#: It for lower-case Latin letters, of which no form is changed by NFC; what else there is.
LATIN_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ſ]+|[0-9²³¹¼-¾]|[^\t-\r \x85\xa0a-zªµºß-öø-ſ0-9²³¹¼-¾]+")
ODD = re.compile("[İƀ-\U0010ffff]")
SPACE = re.compile("[\t-\r ]+")
#: A letter that lower-cased texts lack, for the end of a word.
END = "Z"


class Coder:
    """Texts to ids, as little-endian unsigned 32-bit numbers, without special
    tokens at the ends."""

    def __init__(self, model: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(model)
        held = json.loads(model)
        steps = [[s.get("pattern", {}).get("Regex") or s["type"] for s in ((held[k] or {}).get(parts) or [])] for k, parts in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))]
        specials = held["added_tokens"]
        # Text in between white space is independent of the rest, and so are words.
        self.in_parts = steps == [["NFC", "\\s+", "Lowercase"], [WORDS, "ByteLevel"]] and not held["post_processor"] and not any(t["lstrip"] or t["rstrip"] or t["normalized"] for t in specials)
        self.specials = [t["content"] for t in specials]
        if self.in_parts:
            ranks, ids = ranks_of(held["model"], END.encode())
            self.words = tiktoken.Encoding("words", pat_str=f"[^{END}]+{END}", mergeable_ranks=ranks, special_tokens={})
            self.id_of, self.last = np.zeros(max(ranks.values()) + 1, "<u4"), np.zeros(max(ranks.values()) + 1, bool)
            self.id_of[list(ids)] = list(ids.values())
            self.last[[k for token, k in ranks.items() if token.endswith(END.encode())]] = True
            self.kept, self.odd = Kept(self._words), Kept(self._whole)

    def _words(self, words: list[str]) -> list[bytes]:
        found = np.array(self.words.encode_ordinary(END.join(words) + END))
        packed = self.id_of[found].tobytes()
        ends = (4 * (np.flatnonzero(self.last[found]) + 1)).tolist()
        return [packed[a:b] for a, b in zip([0, *ends], ends)]

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _latin(self, text: str) -> bytes:
        return self.kept.ids(LATIN_WORDS.findall(text.lower()))

    def ids(self, text: str) -> bytes:
        if not self.in_parts or any(s in text for s in self.specials):
            return self._whole([text])[0]
        out, start = [], 0
        while start < len(text):
            end = text.find(" ", start + AT_ONCE)
            end = len(text) if end < 0 else end
            some = text[start:end]
            if some.isascii() or not ODD.search(some):
                out.append(self._latin(some))
            else:
                out.extend(self.odd.ids([part]) if ODD.search(part) else self._latin(part) for part in SPACE.split(some))
            start = end
        return b"".join(out)


_coders: dict[int, Coder] = {}


def coder(model: str) -> Coder:
    """This worker's coder."""
    key = hash(model)
    if key not in _coders:
        _coders.clear()
        _coders[key] = Coder(model)
    return _coders[key]


def best_fit(lengths: list[int], room: int) -> list[list[int]]:
    """Bins of indices: longest first, each into the fullest bin that holds it."""
    bins: list[list[int]] = []
    free: list[list[int]] = [[] for _ in range(room + 1)]
    some = 0  # bit s: some bin lacks s
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = some >> lengths[i]
        if fits:
            s = lengths[i] + (fits & -fits).bit_length() - 1
            b = free[s].pop()
            if not free[s]:
                some ^= 1 << s
            bins[b].append(i)
            s -= lengths[i]
        else:
            b, s = len(bins), room - lengths[i]
            bins.append([i])
        free[s].append(b)
        some |= 1 << s
    return bins


class Offers:
    """What bins can give: single pieces and pairs, by their tokens."""

    def __init__(self, room: int) -> None:
        self.mask = [0, 0]
        self.bins: list[list[set[int]]] = [[set() for _ in range(room + 1)] for _ in range(2)]

    def change(self, b: int, gives: tuple[list[int], list[int]], there: bool) -> None:
        for kind in (0, 1):
            for s in gives[kind]:
                held = self.bins[kind][s]
                if there:
                    held.add(b)
                    self.mask[kind] |= 1 << s
                else:
                    held.discard(b)
                    if not held:
                        self.mask[kind] &= ~(1 << s)

    def largest(self, kind: int, most: int) -> int:
        return (self.mask[kind] & ((2 << most) - 1)).bit_length() - 1


def swap(bins: list[list[int]], lengths: list[int], room: int) -> None:
    """Exchange pieces between bins in place until no exchange of the named kinds
    raises the sum of squared fills of a bin and an emptier one; bins may end empty."""
    fill = [sum(lengths[i] for i in b) for b in bins]

    def gives(b: int) -> tuple[list[int], list[int]]:
        sizes = sorted(lengths[i] for i in bins[b])
        one = sorted(set(sizes))
        two = {x + y for k, x in enumerate(one) for y in one[k + 1 :]} | {x + x for x, y in zip(sizes, sizes[1:]) if x == y}
        return one, [s for s in two if s <= room]

    def taken(b: int, kind: int, size: int) -> list[int]:
        """Pieces of a bin: one of this size, or two that have it together."""
        by = {}
        for i in bins[b]:
            if kind == 0 and lengths[i] == size:
                return [i]
            if kind == 1 and size - lengths[i] in by:
                return [by[size - lengths[i]], i]
            by[lengths[i]] = i
        raise KeyError(size)

    changed = True
    while changed:
        changed = False
        offers = Offers(room)
        now = {b: gives(b) for b in range(len(bins)) if 0 < fill[b] < room}
        for b, g in now.items():
            offers.change(b, g, True)
        heap = [(-fill[b], b) for b in now]
        heapq.heapify(heap)
        while heap:
            f, b = heapq.heappop(heap)
            if b not in now or -f != fill[b]:
                continue
            offers.change(b, now.pop(b), False)
            while fill[b] < room:
                lack = room - fill[b]
                one, two = gives(b)
                best = (0,)
                for kind, own in ((0, [(0, 0), *((0, s) for s in one), *((1, s) for s in two)]), (1, [(0, 0), *((0, s) for s in one)])):
                    for mine, give in own:
                        most = min(room, give + lack)
                        if (gain := offers.largest(kind, most) - give) > best[0]:
                            best = (gain, kind, give + gain, mine, give)
                    if best[0] == lack:
                        break
                if not best[0]:
                    break
                gain, kind, size, mine, give = best
                other = min(islice(offers.bins[kind][size], 32), key=lambda x: (fill[x], x))
                offers.change(other, now.pop(other), False)
                theirs, ours = taken(other, kind, size), taken(b, mine, give) if give else []
                for mover, place in ((theirs, other), (ours, b)):
                    bins[place] = [i for i in bins[place] if i not in mover]
                bins[b] += theirs
                bins[other] += ours
                fill[b] += gain
                fill[other] -= gain
                changed = True
                if bins[other]:
                    now[other] = gives(other)
                    offers.change(other, now[other], True)
                    heapq.heappush(heap, (-fill[other], other))


ROWS = ["doc_id", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset", "fill"]
SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, sequence_id long, offset long, fill long"
_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]


def _packed(rows: list[tuple], bins: list[list[int]], names: list[int]) -> Iterator[pa.RecordBatch]:
    out = []
    for name, held in zip(names, bins):
        offset, fill = 0, sum(rows[i][3] for i in held)
        for i in held:
            out.append((*rows[i], name, offset, fill))
            offset += rows[i][3]
    for a in range(0, len(out), 10_000):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[a : a + 10_000]), _TYPES)], ROWS)


def _encode_and_pack(model: str, room: int, end: int, with_ids: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, last = coder(model).ids, np.array([end], "<u4").tobytes()
        task = TaskContext.get()
        name = (task.partitionId() if task else 0) << 32

        def packed(held: list[tuple]):
            nonlocal name
            lengths = [r[3] for r in held]
            bins = best_fit(lengths, room)
            swap(bins, lengths, room)
            bins = [b for b in bins if b]
            yield from _packed(held, bins, list(range(name, name + len(bins))))
            name += len(bins)

        held: list[tuple] = []
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = ids_of(text.as_py() or "") + last
                for piece, a in enumerate(range(0, len(ids), 4 * room)):
                    part = ids[a : a + 4 * room]
                    held.append((doc, piece, a // 4, len(part) // 4, crc32(part), part if with_ids else None))
                    if len(held) == BLOCK:
                        yield from packed(held)
                        held = []
        if held:
            yield from packed(held)

    return rows


def _pack_again(room: int):
    """Rows of whole bins, sorted by bin, to rows of fewer bins: by swaps, or anew by
    best fit and swaps where that takes fewer."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(held: list[tuple], bins: list[list[int]], names: list[int]):
            lengths = [r[3] for r in held]
            swap(bins, lengths, room)
            anew = best_fit(lengths, room)
            swap(anew, lengths, room)
            few = min(([b for b in some if b] for some in (bins, anew)), key=len)
            yield from _packed(held, few, names[: len(few)])

        held, bins, names = [], [], []
        for batch in batches:
            columns = [batch.column(batch.schema.names.index(c)).to_pylist() for c in ROWS[:7]]
            for *row, name in zip(*columns):
                if not names or names[-1] != name:
                    if len(held) >= 2 * BLOCK:
                        yield from packed(held, bins, names)
                        held, bins, names = [], [], []
                    names.append(name)
                    bins.append([])
                bins[-1].append(len(held))
                held.append(tuple(row))
        if held:
            yield from packed(held, bins, names)

    return rows


def pack(docs: DataFrame, path: str, room: int = 2048, end: int = 0, with_ids: bool = False) -> DataFrame:
    """One row for each piece of a document: doc_id, piece (from 0), start, length,
    ids_crc32, ids (packed, if ``with_ids``), sequence_id, offset, fill (of its
    sequence).

    A document is its text's ids by the tokenizer at ``path`` and the id ``end``; only
    those of over ``room`` ids are cut, into pieces of ``room``.  Null and empty texts
    are ``end`` alone.  Null doc_ids stay null; repeated rows are packed each; pieces of
    equal length take any order; other columns are not read; an empty table gives an
    empty result.  Long texts are encoded whole, a stretch between spaces at a time; a
    text that holds a special token's string is encoded at once.
    """
    spark = docs.sparkSession
    small_batches(spark)
    with open(path, encoding="utf-8") as f:
        model = f.read()
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    left = cut(slim.mapInArrow(_encode_and_pack(model, room, end, with_ids), SCHEMA))
    full, under = F.col("fill") >= room - SLACK, F.col("fill") < room - SLACK
    size = left.agg(F.countDistinct(F.shiftright("sequence_id", 32)).alias("tasks"), F.count("*").alias("n"), F.count_if(under).alias("under")).first()
    blocks = max(size["tasks"], -(-size["n"] // BLOCK))
    done = []
    while 2 * (fewer := -(-size["under"] // BLOCK)) <= blocks and size["under"]:
        done.append(left.where(full))
        again = left.where(under).repartition(fewer, "sequence_id").sortWithinPartitions("sequence_id", "offset")
        left, blocks = cut(again.mapInArrow(_pack_again(room), SCHEMA)), fewer
        size = left.agg(F.count_if(under).alias("under")).first()
    for part in done:
        left = left.unionByName(part)
    return left
