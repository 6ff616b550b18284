"""Languages of texts by a model of letter runs that is learned from labelled texts.

Learning is an aggregation: words by language, then their runs of letters.  The
model is a table (gram, lang, weight) of at most ``per_language`` runs of each
language, so it can be kept as Parquet and broadcast whatever it was learned from.
Scoring folds a text's runs where it lies, joins those that the model has with it,
and sums by text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Lengths of the runs: single letters tell scripts, triples tell languages.
SIZES = (1, 3)
#: Letters after which a word is cut, so that no run is looked up far inside a word.
WORD = 32
PER_LANGUAGE = 1000
#: With these the broadcast model has at most 200,000 runs.
MOST_LANGUAGES = 200
#: Texts under this many characters are not judged.
LEAST, FALLBACK = 50, "en"
MODEL = "gram string, lang string, weight long"
#: Letters that are counted at once; a multiple of WORD, so that words are cut alike.
PART = WORD << 12


def words(text: Column) -> Column:
    """The words of a whole text in small letters, cut after WORD letters."""
    return F.regexp_extract_all(F.lower(text), F.lit(rf"(\p{{L}}{{1,{WORD}}})"), F.lit(1))


def grams(word: Column) -> Column:
    """Runs of letters of a word that has a space on both sides; single letters
    without these."""
    padded, size = F.concat(F.lit(" "), word, F.lit(" ")), F.char_length(word)

    def runs(of: Column, n: int, number: Column) -> Column:
        at = F.sequence(F.lit(1), F.greatest(number, F.lit(1)))
        return F.when(number > 0, F.transform(at, lambda i: F.substring(of, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))

    return F.concat(*(runs(word, 1, size) if n == 1 else runs(padded, n, size + 3 - n) for n in SIZES))


def learn(texts: DataFrame, text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> DataFrame:
    """The model of labelled texts: gram, lang, weight, in thousandths of a natural
    logarithm.

    Kept are the ``per_language`` most frequent runs of each language, ties by code
    point; each has a weight for all languages, log((n + 0.5) / (N + 0.5 V)), with n
    its count in the language, N all counts there, V the number of runs kept.  Rows
    without text or language teach nothing, repeated rows count each; no labelled
    row gives an empty model.  Words fold before their runs are made, so what is
    shuffled is distinct words and runs.  Over MOST_LANGUAGES languages raise
    ValueError."""
    known = texts.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang is not null and text is not null")
    by_word = known.select("lang", F.explode(words(F.col("text"))).alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n"))
    counts = by_word.select("lang", "n", F.explode(grams(F.col("word"))).alias("gram")).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram"))
    top = counts.withColumn("place", place).where(F.col("place") <= per_language).select("gram").distinct()
    rows = counts.join(F.broadcast(top), "gram").groupBy("gram").agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("n")).limit(MOST_LANGUAGES * per_language + 1).collect()
    if len(rows) > MOST_LANGUAGES * per_language or len(codes := sorted({c for r in rows for c in r["n"]})) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    total = {c: sum(r["n"].get(c, 0) for r in rows) for c in codes}
    weight = lambda n, c: math.floor(1000 * math.log((n + 0.5) / (total[c] + 0.5 * len(rows))))
    return texts.sparkSession.createDataFrame([(r["gram"], c, weight(r["n"].get(c, 0), c)) for r in rows for c in codes], MODEL)


def _code(gram: str) -> int:
    """21 bits for each letter."""
    return sum(ord(c) << 21 * i for i, c in enumerate(reversed(gram)))


def _parts(text: str) -> Iterator[str]:
    """A text of letters and spaces in parts of at most PART, between words; words
    that are longer still are cut where ``words`` does."""
    while len(text) > PART:
        at = text.rfind(" ", 0, PART) + 1 or PART
        yield text[:at]
        text = text[at:]
    yield text


def _counted(texts: list[tuple[int, str]], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of (number, letters and spaces) the number, the places of runs among ``codes``,
    and how often each occurs."""
    c = np.frombuffer(f" {' '.join(t for _, t in texts)} ".encode("utf-32-le"), np.uint32).astype(np.int64)
    of = np.repeat(np.array([i for i, _ in texts]), [len(t) + 1 for _, t in texts])
    of = np.append(of[:1], of)
    letter, place = c != 32, np.arange(len(c))
    inside = place - np.maximum.accumulate(np.where(letter, 0, place)) - 1
    if (ends := np.flatnonzero(letter & (inside > 0) & (inside % WORD == 0))).size:
        c, of, letter = np.insert(c, ends, 32), np.insert(of, ends, of[ends]), np.insert(letter, ends, False)
    at = np.flatnonzero(letter)
    runs = np.concatenate((c[at], c[at - 1] << 42 | c[at] << 21 | c[at + 1]))
    gram = np.searchsorted(codes, runs).clip(max=len(codes) - 1)
    known = codes[gram] == runs
    both, n = np.unique((np.concatenate((of[at], of[at])) * len(codes) + gram)[known], return_counts=True)
    return both // len(codes), both % len(codes), n


def known_runs(text: Column, grams: list[str]) -> Column:
    """Of a text array<struct<gram, n>>: numbers of those of ``grams`` that it has, and
    how often; the same one more than once where a text is counted in parts."""
    number = {_code(g): i for i, g in enumerate(grams) if len(g) in SIZES}
    codes = np.array(sorted(number), np.int64)
    numbers = np.array([number[c] for c in codes.tolist()], np.int32)

    @F.arrow_udf("array<struct<gram: int, n: long>>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            held, size, found = [], 0, []
            for i, text in enumerate(batch):
                for part in _parts(text.as_py() or "") if len(codes) else ():
                    held.append((i, part))
                    size += len(part)
                    if size >= PART:
                        found.append(_counted(held, codes))
                        held, size = [], 0
            if held:
                found.append(_counted(held, codes))
            row, gram, n = map(np.concatenate, zip(*found)) if found else (np.empty(0, np.int64),) * 3
            starts = np.searchsorted(row, np.arange(len(batch) + 1)).astype(np.int32)
            yield pa.ListArray.from_arrays(starts, pa.StructArray.from_arrays([pa.array(numbers[gram], pa.int32()), pa.array(n, pa.int64())], ["gram", "n"]))

    letters = F.regexp_replace(F.lower(text), r"[^\p{L}]+", " ")
    return of(letters)


def detect(texts: DataFrame, model: DataFrame, keys: tuple[str, ...] = ("doc_id",), text: str = "text", found: str = "found") -> DataFrame:
    """The keys and the language that scores highest, ties by code.

    Texts under LEAST characters, null ones, those without a run of the model, and
    all texts where the model is empty, are FALLBACK.  Whole texts are read.  Rows
    that share their keys count as one text and give one row.  Runs are counted and
    sums made where a text lies, so a text is joined with each run of the model once
    at most, and shuffles one row for each task that reads it."""
    codes = [r[0] for r in model.select("lang").distinct().orderBy("lang").limit(MOST_LANGUAGES + 1).collect()]
    if len(codes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not codes:
        return texts.select(*keys).distinct().withColumn(found, F.lit(FALLBACK))
    wide = model.groupBy("gram").pivot("lang", codes).agg(F.first("weight"))
    wide = wide.select(F.col("gram").alias("_gram"), *(F.col(f"`{c}`").alias(f"_w{i}") for i, c in enumerate(codes)))
    grams = [r[0] for r in model.where("gram is not null").select("gram").distinct().orderBy("gram").collect()]
    numbers = texts.sparkSession.createDataFrame(list(enumerate(grams)), "_run int, _gram string")
    wide = wide.join(F.broadcast(numbers), "_gram").drop("_gram")
    own = texts.select(*keys, F.coalesce(F.char_length(text), F.lit(0)).alias("_size"), known_runs(F.col(text), grams).alias("_runs"))
    runs = own.select(*keys, "_size", F.inline_outer("_runs").alias("_run", "_n"))
    sums = runs.join(F.broadcast(wide), "_run", "left").groupBy(*keys).agg(F.max("_size").alias("_size"), *(F.sum(F.col(f"_w{i}") * F.col("_n")).alias(f"_w{i}") for i in range(len(codes))))
    scores = F.array(*(F.col(f"_w{i}") for i in range(len(codes))))
    best = F.element_at(F.array(*map(F.lit, codes)), F.array_position(scores, F.array_max(scores)).cast("int"))
    return sums.select(*keys, F.when((F.col("_size") >= LEAST) & F.col("_w0").isNotNull(), best).otherwise(FALLBACK).alias(found))
