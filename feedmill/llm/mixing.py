"""Mixing sources to target weights by Sainte-Lague apportionment.

Words are the unit of size.  Each source gets a target: its share of all words
by weight, at most ``cap`` times its own words, the excess shared again by
weight.  Documents are dealt to shards by a hash; in each shard the sources
compete for equal-sized blocks by highest quotient votes / (2 k + 1), where a
source's votes are its target's part for that shard.  The blocks won are then
selected in a seeded order from the source's stream in the shard: whole passes
first, then a run of blocks from a seeded start.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut
from .exact_dedup import located

WORD = r"[^\x20\x09-\x0D]+"
#: Sources up to which their sizes are broadcast; a row has under 200 bytes.
BROADCAST_SOURCES = 50_000


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: float = 3.0) -> DataFrame:
    """Targets of sources.  ``sizes``: source, source_size.  Sources by code
    point, null last, take the weights in turn.

    Filling to a common level: with sources in order of cap * size / weight,
    the first ones whose caps lie under the level are capped, and the level is
    what is left for the others over their weights.  The windows run over one
    row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    all_rows = Window.partitionBy(F.lit(0))
    fill = Window.partitionBy(F.lit(0)).orderBy("_fm_full_at", F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_fm_pos") % len(weights) + 1).cast("int"))
    w = (
        sizes.withColumn("_fm_pos", F.row_number().over(order) - 1)
        .withColumn("weight", weight)
        .withColumn("_fm_full_at", cap * F.col("source_size") / F.col("weight"))
        .withColumn("_fm_turn", F.row_number().over(fill))
        .withColumn("_fm_total", F.sum("source_size").over(all_rows))
        .withColumn("_fm_caps", F.sum(cap * F.col("source_size")).over(fill.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("_fm_weights", F.sum("weight").over(fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("_fm_level", (F.col("_fm_total") - F.coalesce("_fm_caps", F.lit(0.0))) / F.col("_fm_weights"))
        # The first source that its cap does not stop fixes the level.
        .withColumn("_fm_level", F.min(F.when(F.col("_fm_level") <= F.col("_fm_full_at"), F.struct("_fm_full_at", "_fm_turn", "_fm_level"))).over(all_rows)["_fm_level"])
    )
    capped = F.least(cap * F.col("source_size"), F.col("_fm_level") * F.col("weight"))
    return w.select("source", "source_size", "weight", F.coalesce(capped, cap * F.col("source_size")).alias("target"))


def sainte_lague(parties: DataFrame, group: str, party: str, votes: str, seats: str) -> DataFrame:
    """Seats of each party: ``parties`` has a row for each group and party,
    with its votes and the group's number of seats; adds ``quota``.

    A divisor that is surely too large gives every party a first part of its
    seats, one that is surely too small an upper bound; between them lie a few
    quotients for each party, of which the highest win.  Ties go to the
    party that sorts first.
    """
    each = Window.partitionBy(group)
    v, s, n = F.sum(votes).over(each), F.col(seats), F.count("*").over(each)
    high = F.greatest(s - n / 2, F.lit(0.0)) / v
    bounds = parties.withColumn("_fm_v", v).withColumn("_fm_least", F.when(v > 0, F.floor(F.col(votes) * high * (1 - 1e-12) + 0.5)).otherwise(0).cast("long"))
    bounds = bounds.withColumn("_fm_most", F.when(F.col("_fm_v") > 0, F.floor(F.col(votes) * ((s + n / 2) / F.col("_fm_v")) * (1 + 1e-12) + 0.5) + 1).otherwise(0).cast("long"))
    bounds = bounds.withColumn("_fm_least", F.greatest(F.col("_fm_least") - 1, F.lit(0)))
    bounds = bounds.withColumn("_fm_open", s - F.sum("_fm_least").over(each))
    k = F.explode_outer(F.when((F.col(votes) > 0) & (F.col("_fm_most") > F.col("_fm_least")), F.sequence(F.col("_fm_least"), F.col("_fm_most") - 1)))
    rival = bounds.withColumn("_fm_k", k).withColumn("_fm_quotient", F.col(votes) / (2 * F.col("_fm_k") + 1))
    best = Window.partitionBy(group).orderBy(F.col("_fm_quotient").desc_nulls_last(), F.col(party).asc_nulls_last())
    won = (F.row_number().over(best) <= F.col("_fm_open")) & F.col("_fm_quotient").isNotNull()
    same = [F.col(group), F.col(party)]
    return rival.withColumn("_fm_won", won.cast("long")).groupBy(*same).agg((F.first("_fm_least") + F.sum("_fm_won")).alias("quota"))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (1, 2, 3),
    cap: int = 3,
    block_words: int = 16,
    shard_words: int = 16384,
    lot_shards: int = 4096,
    seed: int = 17,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """For each row its share in the mix: doc_id, the columns ``carry``, source, size,
    source_size, target, taken, passes (whole readings), part_from and part
    (words of the last, partial reading: ``part`` words from word
    ``part_from`` of the row on, going on from its start where the row ends).

    Sizes are words; null texts have none and take nothing.  Null sources are
    one source, the last.  Repeated rows are rows of their own.  A run gives
    the same result again: order within a shard goes by a seeded hash of
    doc_id, then doc_id, then the text's hash; rows alike in all of these are
    alike in any order.  Very long texts are one row of their shard, which may so
    be larger than others.  A source takes its target to within a block, and a
    block more for each of its shards where ``cap`` cuts a block short; one whose
    target is under half a block takes nothing.  An empty table gives an empty result.
    """
    base = cut(docs.select(*carry, F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("_fm_text")))
    sizes = targets(base.groupBy("source").agg(F.sum("size").alias("source_size")), weights, float(cap))
    null_safe = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("t"))  # "t" sorts after every "s..."
    own = cut(sizes.select(null_safe.alias("party"), "source_size", "target").withColumn("all", F.lit(0)))
    sources = own.withColumn("seats", F.round(F.sum("target").over(Window.partitionBy("all")) / block_words).cast("long"))
    won = sainte_lague(sources, "all", "party", "target", "seats").withColumnRenamed("quota", "seats")
    own = cut(own.join(won.drop("all"), "party").withColumn("shards", F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1))))
    own = F.broadcast(own) if own.count() <= BROADCAST_SOURCES else own

    # By the text too, so that rows of one doc_id are spread.
    deal = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "_fm_text"), F.col("shards"))
    spread = base.withColumn("party", null_safe).join(own, "party").withColumn("shard", deal)
    streams = spread.groupBy("party", "shard").agg(F.sum("size").alias("length"))
    streams = cut(streams.withColumn("lot", F.floor(F.col("shard") / lot_shards)))
    lots = streams.groupBy("party", "lot").agg(F.sum("length").alias("length")).join(own.select("party", "seats"), "party")
    lots = cut(sainte_lague(lots, "party", "lot", "length", "seats").withColumnRenamed("quota", "seats"))
    shares = streams.join(lots, ["party", "lot"]).withColumn("lot", F.struct("party", "lot"))
    quotas = cut(sainte_lague(shares, "lot", "shard", "length", "seats").select(F.col("lot.party").alias("party"), "shard", "quota"))

    stream = Window.partitionBy("shard", "party")
    order = stream.orderBy(F.xxhash64(F.lit(seed + 1), "doc_id"), "doc_id", "_fm_text", "size")
    laid = spread.withColumn("at", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size"))
    laid = laid.withColumn("length", F.sum("size").over(stream))
    got = laid.join(quotas, ["party", "shard"])
    words = F.least(F.col("quota") * block_words, cap * F.col("length"))
    got = got.withColumn("passes", F.when(F.col("length") > 0, F.floor(words / F.col("length"))).otherwise(0).cast("long"))
    got = got.withColumn("rest", words - F.col("passes") * F.col("length"))
    blocks = F.greatest(F.ceil(F.col("length") / block_words), F.lit(1))
    got = got.withColumn("start", F.pmod(F.xxhash64(F.lit(seed + 2), "shard", "party"), blocks) * block_words)
    # The run [start, start + rest) on a ring of `length` words, seen from this row: its first reading, and what has gone round.
    lo1, hi1 = F.greatest("at", "start"), F.least(F.col("at") + F.col("size"), F.col("start") + F.col("rest"))
    lo2, hi2 = F.col("at"), F.least(F.col("at") + F.col("size"), F.col("start") + F.col("rest") - F.col("length"))
    first, again = F.greatest(hi1 - lo1, F.lit(0)), F.greatest(hi2 - lo2, F.lit(0))
    got = got.withColumn("part", first + again).withColumn("part_from", F.when(first > 0, lo1 - F.col("at")).otherwise(0))
    got = got.withColumn("taken", F.col("passes") * F.col("size") + F.col("part"))
    return got.select("doc_id", *carry, "source", "size", "source_size", "target", "taken", "passes", "part_from", "part", "shard")


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each whole pass of
    a text, and one with the words of its last, partial pass, joined by spaces.
    n_chars, where there is one, is that of the text given."""
    rows = located(docs)
    at = ["_fm_file", "_fm_row"]
    share = mix(rows, carry=tuple(at), **options).where("taken > 0").select(*at, "passes", "part_from", "part")
    found = rows.join(share, at)
    copies = F.explode(F.sequence(F.when(F.col("part") > 0, F.lit(0)).otherwise(F.lit(1)).cast("long"), F.col("passes")))
    words = F.regexp_extract_all(F.col("text"), F.lit(WORD), F.lit(0))
    ring = F.slice(F.concat(words, words), (F.col("part_from") + 1).cast("int"), F.col("part").cast("int"))
    found = found.withColumn("_fm_copy", copies).withColumn("text", F.when(F.col("_fm_copy") == 0, F.array_join(ring, " ")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        found = found.withColumn("n_chars", F.when(F.col("_fm_copy") == 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return found.select(*docs.columns)
