"""Near-duplicates that share most of their word shingles.

Two texts are alike if the sets of their five-word shingles have a Jaccard
similarity of 0.8 or more.  Candidates come from SimHash fingerprints through the
generalised pigeonhole index (simhash.py): partitions and thresholds by dynamic
programming, probes, and all 64 bits compared.  Texts at the limit differ in about
seven bits and more, which no index of 64 bits finds in a large corpus, so bands of
min-hashes, a constant number for each text whatever the corpus, bring those that
the index can't reach; of these, units whose fingerprints are far apart or whose
min-hash bits differ too much are no pair.  All pairs are verified by their shingles.
A pair at the limit shares no band with a chance of one in a hundred, one more alike
far less.

Texts with the same shingles are one unit.  A key with many units is not joined
pairwise: its units meet one of them, another in each band, and those that are
surely alike to it stay with it.  All others, near to it or not, are keyed again by
sets of min-hash bits, as many and as long as the key's size asks for, and so on
until keys are small.  So units that share a template, but aren't alike, still meet
all those to which they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .byte_bpe import release
from .common import bounded, cut, marked, marks, small_batches
from .exact_dedup import located, without
from .simhash import _majority, components, links

#: Units of a key, from which on it isn't joined pairwise.
HOT_KEY = 48
#: Min-hashes of a band, and bands; bits of a fingerprint that tell texts apart.
ROWS, BANDS, FAR_WORD = 5, 12, 24
#: Min-hash bits in which units that are surely alike to a key's centre differ at most:
#: at the limit of similarity five in six do, of those alike by 0.7 one in a hundred.
SURE = 58
#: Of two units of a large key that aren't alike, so many min-hash bits agree at most, as
#: sets of bits are planned for; of two at the limit, so many do; times that a pair at
#: the limit meets again, on average.
SHARED, ALIKE, MEETINGS = 0.85, 0.9, 1.5
#: Words of min-hash bits.  Of two sets, each bit differs with a chance of half of
#: what their similarity lacks to 1; pairs at the limit stay up to so many standard
#: deviations above that, so the bits lose about 3 in a million of these.
MIN_WORDS, DEVIATIONS = 8, 4.5
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one mixing of 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: bytes | None) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.array([digest(w, 42) for w in (text or b"").lower().split()], np.uint64)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of runs of ``size`` words; of a shorter text, of the whole."""
    size = min(size, len(words))
    if not size:
        return np.empty(0, np.uint64)
    n = len(words) - size + 1
    out = np.full(n, size, np.uint64)
    for i in range(size):
        out = _mixed(out + words[i : i + n] * _ODD[i % len(_ODD)])
    return out


def min_hashes(found: np.ndarray) -> np.ndarray:
    """For hashes of a set as many min-hashes as there are bits in MIN_WORDS words."""
    number = np.arange(1, MIN_WORDS * 64 + 1, dtype=np.uint64)
    turn, shift = (_mixed(number * k).astype(np.uint32) for k in _ODD[:2])
    low = (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(number), 0xFFFFFFFF, np.uint32)
    for a in range(0, len(low), 512):
        np.minimum(least, (low[a : a + 512, None] * (turn | np.uint32(1)) + shift).min(0), out=least)
    return least


def min_bits(least: np.ndarray) -> np.ndarray:
    """One bit of each min-hash, as words."""
    number = np.arange(1, MIN_WORDS * 64 + 1, dtype=np.uint64)
    return np.packbits(_mixed(least.astype(np.uint64) + number * _ODD[2]) >> np.uint64(63) == 1, bitorder="little").view(np.uint64)


def band_keys(least: np.ndarray) -> np.ndarray:
    key = np.zeros(BANDS, np.uint64)
    for row in least[: ROWS * BANDS].reshape(ROWS, BANDS):
        key = _mixed(key + row.astype(np.uint64) * _ODD[3])
    return key


def most_apart(similarity: float) -> int:
    """Min-hash bits in which sets of this similarity differ at most, but for chance."""
    bits, each = MIN_WORDS * 64, (1 - similarity) / 2
    return ceil(bits * each + DEVIATIONS * sqrt(bits * each * (1 - each)))


def sketches(text: Column, size: int) -> Column:
    """Struct column: unit (hash of the set of shingles), n (their number), first (a
    fingerprint of runs of three words), mins (min-hash bits of the set) and bands
    (keys of its min-hashes), the last two null if the text has no words."""

    @F.arrow_udf("struct<unit: long, n: int, first: long, mins: array<long>, bands: array<long>>")
    def of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release()
        for batch in texts:
            units, counts, firsts, mins, keys = [], [], [], [], []
            for x in batch.to_pylist():
                words = word_hashes(x)
                found = np.unique(shingles(words, size))
                units.append(int(np.bitwise_xor.reduce(_mixed(found + _ODD[1]))) if len(found) else 0)
                counts.append(len(found))
                if len(found):
                    least = min_hashes(found)
                    firsts.append(int(_majority(shingles(words, 3)[:, None]).view(np.int64)[0]))
                    mins.append(min_bits(least).view(np.int64))
                    keys.append(band_keys(least).view(np.int64))
                else:
                    firsts.append(0)
                    mins.append(None)
                    keys.append(None)
            yield pa.StructArray.from_arrays([pa.array(np.array(units, np.uint64).view(np.int64)), pa.array(counts, pa.int32()), pa.array(firsts, pa.int64()), *(pa.array(c, pa.list_(pa.int64())) for c in (mins, keys))], ["unit", "n", "first", "mins", "bands"])

    return of(text.cast("binary"))


def shingle_sets(text: Column, size: int) -> Column:
    @F.arrow_udf("array<long>")
    def of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release()
        for batch in texts:
            yield pa.array([np.unique(shingles(word_hashes(x), size)).view(np.int64) for x in batch.to_pylist()], pa.list_(pa.int64()))

    return of(text.cast("binary"))


def plan(size: int) -> tuple[int, int]:
    """Bits of a set, and the number of sets, by which a key of ``size`` units is
    cut."""
    bits = max(8, min(MIN_WORDS * 32, ceil(log(max(size, 1) / (HOT_KEY * 2 / 3)) / -log(SHARED))))
    bits += -bits % 4  # few plans, so that few sets of masks are made
    return bits, ceil(MEETINGS / ALIKE**bits)


def masks(bits: int, number: int, turn: int) -> np.ndarray:
    """For each set its bits among the min-hash bits, as words."""
    rng = np.random.default_rng([bits, turn])
    chosen = np.zeros((number, MIN_WORDS * 64), np.uint8)
    for row in chosen:
        row[rng.choice(MIN_WORDS * 64, bits, replace=False)] = 1
    return np.packbits(chosen, axis=1, bitorder="little").view(np.uint64)


def _banded(turn: int):
    """Rows (part, key, unit, first, mins, size) to one row for each set of bits."""

    def rows(batches):
        known: dict[int, np.ndarray] = {}
        for whole in batches:
            size = whole.column(5).to_numpy()
            for n in np.unique(size):
                some = whole.filter(pa.array(size == n))
                bits, number = plan(int(n))
                if bits not in known:
                    known[bits] = masks(bits, number, turn)
                mask = known[bits]
                step = max(1, 65_536 // len(mask))
                for at in range(0, some.num_rows, step):
                    rows = some.slice(at, step)
                    mins = rows.column(4).flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(rows.num_rows, 1, MIN_WORDS)
                    key = _mixed(rows.column(1).to_numpy().view(np.uint64)[:, None] + np.arange(1, len(mask) + 1, dtype=np.uint64) * _ODD[3])
                    for w in range(MIN_WORDS):
                        key = _mixed(key + (mins[:, :, w] & mask[None, :, w]) * _ODD[w % 5])
                    of = lambda i, rows=rows: np.repeat(rows.column(i).to_numpy(), len(mask))
                    yield pa.RecordBatch.from_pydict({"part": of(0), "key": key.ravel().view(np.int64), "unit": of(2), "first": of(3)})

    return rows


def _indexed(units: DataFrame) -> DataFrame:
    """Pairs (a, b) of units by the pigeonhole index of their fingerprints.  Units of
    one fingerprint meet the least of them, which stands for it in links."""
    fps = cut(units.groupBy("first").agg(F.min("unit").alias("least"), F.count("*").alias("size")))
    found = cut(links(fps.select(F.col("first").alias("fp"))))
    least = lambda c, fp: fps.select(F.col("first").alias(fp), F.col("least").alias(c))
    near = found.withColumnsRenamed({"a": "fa", "b": "fb"}).join(least("a", "fa"), "fa").join(least("b", "fb"), "fb").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    shared = bounded(fps.where("size > 1").select("first", "least"))
    return near.unionByName(units.join(shared, "first").where("unit <> least").select(F.col("least").alias("a"), F.col("unit").alias("b")))


def _banded_pairs(units: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of units that share a band, nearly a fingerprint, and min-hash
    bits and sizes as sets of the similarity do."""
    schema = "part int, key long, unit long, first long"
    index = cut(units.select(F.posexplode("bands").alias("part", "key"), "unit", "first"))
    sets = units.select("unit", "n", "mins")
    near = lambda a, b: F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= FAR_WORD
    differ = lambda a, b: sum((F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(MIN_WORDS)), F.lit(0))
    fits = lambda n, m, a, b: (F.least(n, m) >= similarity * F.greatest(n, m)) & (differ(a, b) <= most_apart(similarity))
    found, turn = None, 0
    while True:
        size = index.groupBy("part", "key").agg(F.count("*").alias("size")).where("size > 1")
        sized = cut(index.join(size, ["part", "key"]).join(sets, "unit"))
        cold = sized.where(F.col("size") <= HOT_KEY).select("part", "key", "unit", "first", "n", "mins")
        other = cold.select("part", "key", F.col("unit").alias("b"), F.col("first").alias("with"), F.col("n").alias("m"), F.col("mins").alias("least"))
        pairs = cold.join(other, ["part", "key"]).where((F.col("unit") < F.col("b")) & near("first", "with") & fits("n", "m", "mins", "least")).select(F.col("unit").alias("a"), "b")
        hot = sized.where(F.col("size") > HOT_KEY)
        if hot.isEmpty():
            return cut(pairs if found is None else found.unionByName(pairs)).distinct()
        center = hot.groupBy("part", "key").agg(F.min(F.struct(F.xxhash64("part", "unit").alias("lot"), "unit", "first", "n", "mins")).alias("center"))
        hot = hot.join(center, ["part", "key"])
        hot = cut(hot.withColumns({"fit": fits("n", "center.n", "mins", "center.mins"), "sure": differ("mins", "center.mins") <= SURE}))
        met = hot.where("fit").select(F.least("unit", "center.unit").alias("a"), F.greatest("unit", "center.unit").alias("b")).where("a <> b")
        pairs = cut(pairs.unionByName(met))  # each round's plan ends here
        found = pairs if found is None else found.unionByName(pairs)
        left = hot.where("not (fit and sure)").select("part", "key", "unit", "first", "mins", "size")
        index, turn = cut(left.mapInArrow(_banded(turn), schema)), turn + 1
        if index.isEmpty():
            return found.distinct()


def alike(docs: DataFrame, words: int = 5, similarity: float = 0.8, carry: tuple[str, ...] = ()) -> DataFrame:
    """For each row of ``docs`` doc_id, the columns ``carry``, and root: rows with
    one root are linked by texts whose sets of ``words``-word shingles have a Jaccard
    similarity of ``similarity`` or more.

    A-Z are lower-cased.  Texts with fewer words than a shingle have one; null and
    empty texts and texts without words are alike each other and nothing else.
    Whole texts are used, however long.  Repeated rows stay; an empty table gives
    an empty result; columns but doc_id, text and ``carry`` are not read.
    """
    small_batches(docs.sparkSession)
    rows = cut(docs.select("doc_id", *carry, "text", sketches(F.col("text"), words).alias("s")).select("doc_id", *carry, "text", "s.*"))
    units = cut(rows.where("n > 0").groupBy("unit").agg(*(F.first(c).alias(c) for c in ("n", "first", "mins", "bands"))))
    pairs = cut(_indexed(units).unionByName(_banded_pairs(units, similarity)).distinct())
    asked = pairs.select(F.col("a").alias("unit")).union(pairs.select("b")).distinct()
    # Only texts of units that are asked for are shuffled; each map task folds copies first.
    texts = marked(rows.select("unit", "text"), ["unit"], marks(asked, ["unit"])).where("_fm_marked").groupBy("unit").agg(F.min("text").alias("text"))
    sets = cut(texts.select("unit", shingle_sets(F.col("text"), words).alias("set")))
    side = lambda c: sets.select(F.col("unit").alias(c), F.col("set").alias(f"s{c}"))
    both = F.size(F.array_intersect("sa", "sb"))
    alike = pairs.join(side("a"), "a").join(side("b"), "b").where(both >= similarity * (F.size("sa") + F.size("sb") - both)).select("a", "b")
    rooted = components(alike)
    return rows.join(rooted.withColumnRenamed("node", "unit"), "unit", "left").select("doc_id", *carry, F.coalesce("root", "unit").alias("root"))


def first_of_alike(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of rows with one
    root the one with the smallest doc_id, null first; of rows with the same
    doc_id the one with the first locator."""
    rows = located(docs)
    found = cut(alike(rows, words, similarity, ("_fm_file", "_fm_row")).select("root", F.struct("doc_id", F.col("_fm_file").alias("file"), F.col("_fm_row").alias("row")).alias("at")))
    stay = found.groupBy("root").agg(F.min("at").alias("at"))
    gone = found.select("at.file", "at.row").join(stay.select("at.file", "at.row"), ["file", "row"], "left_anti")
    return without(rows, gone)
