"""Greedy near copies: in order, an item goes if it is alike to one that was kept.

Alike is by matching letters, 2 M / T over ``same``: M letters in matching blocks, T
letters of both.  The rule is sequential, so it is followed in rounds.  In each, the
first undecided items of every group settle among themselves who stays; all later
ones then meet those that stay, and no others.  No item meets more than the rule
itself would make it meet, and copies never meet each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Items of a group that are settled at once: in the first round, and at most.
FIRST, MOST = 64, 1024


def _pairs(mark: Column) -> Column:
    """Neighbouring letters of a mark, each with the number of equal ones before
    it, so that the common ones of two marks are those of two sets."""
    size = F.char_length(mark)
    two = F.when(size > 1, F.transform(F.sequence(F.lit(1), F.greatest(size - 1, F.lit(1))), lambda i: F.substring(mark, i, F.lit(2)))).otherwise(F.array().cast("array<string>"))
    return F.transform(two, lambda x, i: F.concat(x, F.size(F.filter(F.slice(two, F.lit(1), i), lambda y: y == x)).cast("string")))


def may_be_alike(a: Column, b: Column, pairs_a: Column, pairs_b: Column, same: float) -> Column:
    """What must hold of marks that are alike.

    Of T letters, U = T - 2 M don't match, and U > 0 of them part the blocks, so
    there are U + 1 blocks at most, which hold M - U - 1 common pairs of neighbours
    at least: over (1.5 same - 1) T - 1."""
    la, lb = F.char_length(a), F.char_length(b)
    total = la + lb
    return (2 * F.least(la, lb) > same * total) & (F.size(F.array_intersect(pairs_a, pairs_b)) > F.lit(1.5 * same - 1) * total - F.lit(1 + 1e-9))


def _alike(same: float):
    @F.arrow_udf("boolean")
    def alike(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for marks, kept in batches:
            yield pa.array([SequenceMatcher(None, m, k).ratio() > same for m, k in zip(marks.to_pylist(), kept.to_pylist())], pa.bool_())

    return alike


def _settle(same: float):
    @F.arrow_udf("array<int>")
    def settle(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for marks, pairs in batches:
            yield pa.array([_stay(m, p, same) for m, p in zip(marks.to_pylist(), pairs.to_pylist())], pa.list_(pa.int32()))

    return settle


def _stay(marks: list[str], pairs: list[list[str]], same: float) -> list[int]:
    """Places of the marks of one list that stay; ``may_be_alike`` goes before."""
    stay: list[tuple[int, set[str], SequenceMatcher]] = []
    for i, mark in enumerate(marks):
        own, size = set(pairs[i]), len(mark)
        for k, other, matcher in stay:
            total = size + len(marks[k])
            if 2 * min(size, len(marks[k])) > same * total and len(own & other) > (1.5 * same - 1) * total - 1 - 1e-9:
                matcher.set_seq1(mark)
                if matcher.ratio() > same:
                    break
        else:
            stay.append((i, own, SequenceMatcher(None, "", mark)))
    return [i for i, _, _ in stay]


def first_unlike(items: DataFrame, group: str, order: str, mark: Column, work: str, same: float = 0.8) -> DataFrame:
    """The items that stay, with all their columns.

    Within a group, in the order of ``order`` (nulls first) and then of ``mark``; of
    rows equal in all three one stays.  Null marks are empty ones, null groups are
    one group; an empty table stays empty.  ``same`` is at least 0.8 and under 1,
    for which unequal marks that are alike share a pair of letters.  Marks are short
    (starts of titles): the work of comparing two grows with the square of their
    length.  ``work`` is a new folder that driver and executors share; the rounds
    are written there, so a lost executor repeats one round's part only.

    A group of n distinct marks with k that stay takes about 4 + k / 1024 rounds."""
    if not 0.8 <= same < 1:
        raise ValueError("same must be at least 0.8 and under 1")
    spark = items.sparkSession
    rows = items.withColumns({"_g": F.col(group), "_o": F.col(order), "_m": F.coalesce(mark, F.lit(""))})
    # Equal marks share their fate with the first of them, and only that can stay.
    heads = rows.groupBy("_g", "_m").agg(F.min(F.struct(F.col("_o").isNotNull().alias("some"), F.col("_o").alias("o"))).alias("f")).select("_g", "_m", F.col("f.o").alias("_o"))
    heads.withColumn("_p", _pairs(F.col("_m"))).write.parquet(f"{work}/left-0")
    alike, settle, lot, i = _alike(same), _settle(same), FIRST, 0
    while not (left := spark.read.parquet(f"{work}/left-{i}")).isEmpty():
        place = F.row_number().over(Window.partitionBy("_g").orderBy(F.col("_o").asc_nulls_first(), "_m"))
        first = left.withColumn("_n", place).where(F.col("_n") <= lot)
        lists = first.groupBy("_g").agg(F.array_sort(F.collect_list(F.struct("_n", "_o", "_m", "_p"))).alias("l"))
        kept = lists.withColumn("k", settle(F.col("l._m"), F.col("l._p"))).select("_g", F.explode(F.transform("k", lambda at: F.get("l", at))).alias("x"), F.element_at("l", -1)["_o"].alias("_to"), F.element_at("l", -1)["_m"].alias("_to_m"))
        kept.select("_g", "x._o", "x._m", "x._p", "_to", "_to_m").write.parquet(f"{work}/kept-{i}")
        kept = spark.read.parquet(f"{work}/kept-{i}").select(*(F.col(c).alias(f"k{c}") for c in ("_g", "_m", "_p")))
        ends = spark.read.parquet(f"{work}/kept-{i}").select(F.col("_g").alias("k_g"), "_to", "_to_m").distinct()
        # Later than the last that was settled; nulls come first.
        later = F.coalesce(F.col("_o") > F.col("_to"), F.col("_o").isNotNull() & F.col("_to").isNull(), F.lit(False)) | (F.col("_o").eqNullSafe(F.col("_to")) & (F.col("_m") > F.col("_to_m")))
        rest = left.join(ends, F.col("_g").eqNullSafe(F.col("k_g"))).where(later).select("_g", "_m", "_o", "_p")
        met = rest.join(kept, F.col("_g").eqNullSafe(F.col("k_g")) & may_be_alike(F.col("_m"), F.col("k_m"), F.col("_p"), F.col("k_p"), same))
        gone = met.where(alike(F.col("_m"), F.col("k_m"))).select(F.col("_g").alias("d_g"), F.col("_m").alias("d_m")).distinct()
        rest.join(gone, F.col("_g").eqNullSafe(F.col("d_g")) & (F.col("_m") == F.col("d_m")), "left_anti").write.parquet(f"{work}/left-{i + 1}")
        lot, i = min(2 * lot, MOST), i + 1
    if i == 0:
        return items.where("false")
    stay = spark.read.parquet(*(f"{work}/kept-{j}" for j in range(i))).select(*(F.col(c).alias(f"s{c}") for c in ("_g", "_o", "_m")))
    on = F.col("_g").eqNullSafe(F.col("s_g")) & F.col("_o").eqNullSafe(F.col("s_o")) & (F.col("_m") == F.col("s_m"))
    return rows.join(stay, on, "left_semi").dropDuplicates(["_g", "_o", "_m"]).drop("_g", "_o", "_m")
