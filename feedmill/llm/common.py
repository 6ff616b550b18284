"""What the corpus operators share: scratch places and text expressions."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII letters, the only ones that the contracts lower-case.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Bits of a set of marks: 8 MB however many keys there are.
MARKS = 1 << 26

#: Rows in an Arrow batch.  Texts are long; small batches keep workers small.
ARROW_ROWS = "1000"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    A cluster names it in ``spark.checkpoint.dir``, or this raises.  Only where
    that is unset on one machine (tests) a local folder is made and set.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        if held.isDefined():
            return held.get()
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="feedmill-")
        spark.sparkContext.setCheckpointDir(found)
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/feedmill-{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and keep it in the shared folder, whose copy
    outlives executors; Spark deletes it when the frame is no longer used."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def bounded(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """``df``, broadcast if it has at most so many rows; else the planner joins it
    by shuffles, with skewed partitions split."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, nothing else; null stays null.  Pure ASCII texts take
    the fast byte-wise path."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bucket(doc_id: Column, n: int) -> Column:
    """crc32(doc_id as text) mod n; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def marks(keys: DataFrame, columns: list[str], bits: int = MARKS) -> DataFrame:
    """One bit set for each key, by a hash of ``columns``: rows (mark_lot,
    mark_bits), of ``bits`` / 8 bytes in all at most, kept in the shared folder."""
    at = F.pmod(F.xxhash64(*columns), F.lit(bits))
    rows = keys.select(F.bitmap_bucket_number(at).alias("mark_lot"), F.bitmap_bit_position(at).alias("at")).distinct()
    return cut(rows.groupBy("mark_lot").agg(F.bitmap_construct_agg("at").alias("mark_bits")))


def marked(rows: DataFrame, columns: list[str], found: DataFrame, bits: int = MARKS) -> DataFrame:
    """``rows`` with ``_fm_marked``: true for all whose key has its mark, and for
    few others; nothing is shuffled."""
    at = F.pmod(F.xxhash64(*columns), F.lit(bits))
    sets = F.broadcast(found.withColumnsRenamed({"mark_lot": "_fm_lot", "mark_bits": "_fm_bits"}))
    place = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring("_fm_bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))
    return rows.join(sets, F.bitmap_bucket_number(at) == F.col("_fm_lot"), "left").withColumn("_fm_marked", hit).drop("_fm_lot", "_fm_bits")
