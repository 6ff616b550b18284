"""Joins on "text contains word" for large sets of words, and on "text starts with".

A word is found through its anchor, three of its bytes that few words have.  Each
text is read once for the anchors in it, by a set of bits of 8 MB; only words whose
anchor a text has are tested against it, and only where the anchor is.  No word meets
a text without one, and texts are not repeated for words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words up to which the dictionary is broadcast; beyond, pairs are shuffled.
BROADCAST_WORDS = 100_000
#: Bytes of an anchor.  Shorter words are their own, told apart by their length.
GRAM = 3
#: Bits of the set of anchors, and of the set of prefixes.
ANCHORS, MARKS = GRAM + 1 << 24, 1 << 26
#: Bytes of a text that are searched at once.
PART = 1 << 20


def _grams(word: Column) -> Column:
    """Codes of all runs of GRAM bytes of a word, or of the whole of a shorter one."""
    raw = word.cast("binary")
    size = F.octet_length(word)
    code = lambda part, n: F.conv(F.hex(part), 16, 10).cast("int") + F.shiftleft(n, 24)
    runs = F.transform(F.sequence(F.lit(1), size - (GRAM - 1)), lambda i: code(F.substring(raw, i, F.lit(GRAM)), F.lit(GRAM)))
    return F.when(size >= GRAM, runs).otherwise(F.array(code(raw, size)))


def anchors(words: DataFrame) -> DataFrame:
    """word, code: the run of each distinct word that the fewest words have."""
    one = words.where(F.octet_length("word") > 0).select("word").distinct()
    grams = one.select("word", F.explode(F.array_distinct(_grams(F.col("word")))).alias("code"))
    often = grams.groupBy("code").agg(F.count("*").alias("n"))
    return grams.join(often, "code").groupBy("word").agg(F.min(F.struct("n", "code")).alias("a")).select("word", "a.code")


def _bits(codes: DataFrame) -> np.ndarray:
    """One bit for each code that occurs: 8 MB at most, whatever the words."""
    place = F.col("code") + 1  # lots begin with 1
    lots = codes.select(F.bitmap_bucket_number(place).alias("lot"), F.bitmap_bit_position(place).alias("at")).groupBy("lot").agg(F.bitmap_construct_agg("at").alias("bits")).collect()
    size = 8 * 4096
    out = np.zeros(ANCHORS // size * size // 8, np.uint8)
    for row in lots:
        start = (row["lot"] - 1) * size // 8
        out[start : start + size // 8] = np.frombuffer(row["bits"], np.uint8)
    return out


def anchors_in(text: Column, codes: DataFrame) -> Column:
    """The codes that occur in a text, each once."""
    packed = pa.compress(_bits(codes).tobytes(), codec="zstd", asbytes=True)
    size = ANCHORS // 8

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = np.unpackbits(np.frombuffer(pa.decompress(packed, decompressed_size=size, codec="zstd", asbytes=True), np.uint8), bitorder="little").view(bool)
        short = [n for n in range(1, GRAM) if known[n << 24 : n + 1 << 24].any()]
        for batch in texts:
            found = []
            for x in batch.to_pylist():
                b = np.frombuffer(x or b"", np.uint8).astype(np.int32)
                hits = []
                for n in (*short, GRAM):
                    if len(b) >= n:
                        code = sum((b[i : len(b) - n + 1 + i] << 8 * (n - 1 - i) for i in range(n)), np.full(len(b) - n + 1, n << 24, np.int32))
                        hits.append(code[known[code]])
                found.append(np.unique(np.concatenate(hits)) if hits else np.empty(0, np.int32))
            yield pa.array(found, pa.list_(pa.int32()))

    return of(text.cast("binary"))


def words_in(text: Column, words: list[tuple[int, str]]) -> Column:
    """Numbers of the ``words`` (anchor, word) that a text contains, each once.

    An anchor has its place in a word, so the word can only be around it: there eight
    bytes are compared, and of longer words the rest."""
    raw = [w.encode() for _, w in words]
    codes, starts = np.unique(np.array([c for c, _ in words], np.int32), return_index=True)
    number = np.diff(np.append(starts, len(words)))
    size = np.array([len(w) for w in raw], np.int64)
    ahead = np.array([w.index((c & 0xFFFFFF).to_bytes(c >> 24, "big")) for w, (c, _) in zip(raw, words)], np.int64)
    head = np.array([int.from_bytes(w[:8], "little") for w in raw], np.uint64)
    whole = np.array([(1 << 8 * min(len(w), 8)) - 1 for w in raw], np.uint64)
    longest, lengths = int(size.max()), np.unique(codes >> 24).tolist()
    mixed = lambda code: (code.astype(np.uint32) * np.uint32(0x9E3779B1)) >> np.uint32(12)
    slots = np.zeros(1 << 20, bool)  # few places have an anchor's slot without the anchor
    slots[mixed(codes)] = True

    def found_in(x: bytes) -> np.ndarray:
        b = np.frombuffer(x + bytes(8), np.uint8)
        n, wide, hits = len(x), b.astype(np.uint64), []
        for k in (1, 2, 4):  # the eight bytes from each place on
            wide[:-k] |= wide[k:] << np.uint64(8 * k)
        for k in lengths:
            if n >= k:
                code = sum((b[i : n - k + 1 + i].astype(np.int32) << 8 * (k - 1 - i) for i in range(k)), np.full(n - k + 1, k << 24, np.int32))
                here = np.flatnonzero(slots[mixed(code)])
                at = np.searchsorted(codes, code[here]).clip(max=len(codes) - 1)
                same = codes[at] == code[here]
                hits.append((here[same], at[same]))
        here, anchor = map(np.concatenate, zip(*hits)) if hits else (np.empty(0, np.int64), np.empty(0, np.int64))
        each = number[anchor]
        begin = np.cumsum(each) - each
        word = np.arange(each.sum()) - np.repeat(begin - starts[anchor], each)
        at = np.repeat(here, each) - ahead[word]
        fits = (at >= 0) & (at + size[word] <= n)
        word, at = word[fits], at[fits]
        word, at = (v[wide[at] & whole[word] == head[word]] for v in (word, at))
        long = size[word] > 8
        same = [x.startswith(raw[w], p) for w, p in zip(word[long].tolist(), at[long].tolist())]
        return np.unique(np.concatenate((word[~long], word[long][np.array(same, bool)])))

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            found = []
            for x in batch.to_pylist():
                x = x or b""
                parts = [found_in(x[i : i + PART + longest - 1]) for i in range(0, len(x), PART)]
                found.append(np.unique(np.concatenate(parts)).astype(np.int32) if parts else np.empty(0, np.int32))
            yield pa.array(found, pa.list_(pa.int32()))

    return of(text.cast("binary"))


def containing(texts: DataFrame, words: DataFrame, key: str, text: str = "text") -> DataFrame:
    """key, word: a row for each row of ``texts`` and distinct word of ``words``
    (word) that it contains, case and all.

    Null texts contain nothing; null and empty words are in no text.  ``key`` names
    the text: where the words are more than BROADCAST_WORDS, rows with the same key
    must have the same text.  Other columns are not read.
    """
    known = anchors(words)
    few = known.limit(BROADCAST_WORDS + 1).collect()
    slim = texts.select(F.col(key).alias("_fm_key"), F.col(text).alias("_fm_text"))
    if not few:
        return slim.select(F.col("_fm_key").alias(key), F.lit(None).cast("string").alias("word")).where(F.lit(False))
    if len(few) <= BROADCAST_WORDS:
        by_anchor = sorted((r["code"], r["word"]) for r in few)
        numbers = texts.sparkSession.createDataFrame([(i, w) for i, (_, w) in enumerate(by_anchor)], "_fm_word int, word string")
        found = slim.select("_fm_key", F.explode(words_in(F.col("_fm_text"), by_anchor)).alias("_fm_word"))
        return found.join(F.broadcast(numbers), "_fm_word").select(F.col("_fm_key").alias(key), "word")
    rows = slim.select("_fm_key", F.explode(anchors_in(F.col("_fm_text"), known.select("code"))).alias("code"))
    pairs = rows.join(known, "code").select("_fm_key", "word").distinct()
    return pairs.join(slim, "_fm_key").where(F.contains(F.col("_fm_text"), F.col("word"))).select(F.col("_fm_key").alias(key), "word")


def prefixed(texts: DataFrame, words: DataFrame, text: str) -> DataFrame:
    """text, word: for each distinct text the words of ``words`` (word) that it
    starts with.

    A text is cut at the lengths that words have, of which there are few, and its
    beginnings are met with the words by equality; a set of bits of 8 MB keeps
    those that are no word from the shuffle.
    """
    one = words.where("word is not null").select("word").distinct()
    lengths = [r[0] for r in one.select(F.length("word").alias("n")).distinct().orderBy("n").collect()]
    if not lengths:
        return texts.select(F.col(text), F.lit(None).cast("string").alias("word")).where(F.lit(False))
    at = lambda c: F.pmod(F.xxhash64(c), F.lit(MARKS))
    marks = one.select(F.bitmap_bucket_number(at("word")).alias("lot"), F.bitmap_bit_position(at("word")).alias("at")).groupBy("lot").agg(F.bitmap_construct_agg("at").alias("bits"))
    cut = texts.where(F.col(text).isNotNull()).select(text).distinct()
    heads = cut.select(text, F.explode(F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(text))).alias("n")).select(text, F.col(text).substr(F.lit(1), F.col("n")).alias("word"))
    place = F.bitmap_bit_position(at("word"))
    byte = F.conv(F.hex(F.substring("bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    some = heads.join(F.broadcast(marks), F.bitmap_bucket_number(at("word")) == F.col("lot")).where(F.getbit(byte, (place % 8).cast("int")) == 1)
    return some.select(text, "word").join(one, "word").select(text, "word")
