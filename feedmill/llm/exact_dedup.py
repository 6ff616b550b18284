"""Exact deduplication by stateful streaming.

A stream over (digest, identifier, locator) rows feeds a keyed aggregation
whose state lives on disk (RocksDB), is saved in the shared folder and never
expires.  For each digest the state keeps the row that stays and the number
of rows.  A locator is the file and row where the content stands.  Digest hits
are then checked on their full bytes: the locators of rows that share a digest
are marked in a set of bits of a fixed size, which all tasks get, so that only
the texts of these rows (and a few more) are shuffled.  DataFrame and SQL
functions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, cut, marked, marks, scratch

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Many small stores: files are not to be allocated in advance.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def sha256_of(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def located(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_fm_file`` and ``_fm_row``: where each row stands.  Rows
    that are not read straight from files are written to the shared folder
    first."""
    try:
        return docs.withColumns({"_fm_file": F.col("_metadata.file_path"), "_fm_row": F.col("_metadata.row_index")})
    except AnalysisException:
        path = scratch(docs.sparkSession, "located")
        docs.write.parquet(path)
        again = docs.sparkSession.read.parquet(path)
        return again.withColumns({"_fm_file": F.col("_metadata.file_path"), "_fm_row": F.col("_metadata.row_index")})


def keyed_state(spark: SparkSession, spool: str, files_per_batch: int | None = None) -> DataFrame:
    """Run the stream over the rows in ``spool`` until it has read all, then
    read its state: digest, keep (doc_id, file, row), size."""
    at = scratch(spark, "state")
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        reader = spark.readStream.schema(spark.read.parquet(spool).schema)
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        (
            reader.parquet(spool)
            .groupBy("digest")
            .agg(F.max(F.struct("doc_id", "file", "row")).alias("keep"), F.count("*").alias("size"))
            .writeStream.outputMode("update")
            .format("noop")
            .option("checkpointLocation", at)
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
        state = spark.read.format("statestore").load(at)
        value = state.schema["value"].dataType.names
        return cut(state.select(F.col("key.digest").alias("digest"), F.col(f"value.{value[0]}").alias("keep"), F.col(f"value.{value[1]}").alias("size")))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def dedup(
    docs: DataFrame,
    digest: Callable[[Column], Column] = sha256_of,
    files_per_batch: int | None = None,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, file, row (its locator), digest,
    keep (doc_id, file, row of the row that stays), size (rows with this text).

    Texts are equal when identical after lower-casing A-Z.  Null texts count as
    empty; empty texts are equal to each other.  Of equal texts the largest
    doc_id stays; null doc_ids come before all others; of rows with the same
    doc_id the one with the last locator stays.  An empty table gives an empty
    result.  Other columns of ``docs`` are not looked at, so clashing names do no
    harm.  Very long texts are digested whole.  Texts that share a digest without
    being equal are told apart by their bytes.
    """
    return dedup_located(located(docs), digest, files_per_batch)


def dedup_located(rows: DataFrame, digest: Callable[[Column], Column] = sha256_of, files_per_batch: int | None = None) -> DataFrame:
    """``dedup`` for rows that have ``_fm_file`` and ``_fm_row`` already."""
    spark = rows.sparkSession
    text = ascii_lower(F.coalesce(F.col("text"), F.lit("")))
    slim = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("_fm_file").alias("file"), F.col("_fm_row").alias("row"), text.alias("text"))
    spool = scratch(spark, "spool")
    slim.select(digest(F.col("text")).alias("digest"), "doc_id", "file", "row").write.parquet(spool)
    state = keyed_state(spark, spool, files_per_batch)

    # Full bytes of hits: only marked rows are digested again; each map task folds copies into one row before the shuffle.
    seen = spark.read.parquet(spool)
    out = ["doc_id", "file", "row", "digest", "keep", "size"]
    hits = seen.join(state.where("size > 1").select("digest"), "digest", "left_semi")
    suspects = marked(slim, ["file", "row"], marks(hits, ["file", "row"])).where("_fm_marked")
    bytes_of = suspects.select(digest(F.col("text")).alias("digest"), "text").groupBy("digest").agg(F.min("text").alias("a"), F.max("text").alias("b"))
    clash = cut(bytes_of.where("a <> b").select("digest"))
    if clash.isEmpty():
        return seen.join(state, "digest").select(out)
    plain = seen.join(state.join(clash, "digest", "left_anti"), "digest").select(out)
    odd = cut(suspects.drop("_fm_marked").withColumn("digest", digest(F.col("text"))).join(clash, "digest", "left_semi"))
    groups = cut(odd.groupBy("digest", "text").agg(F.max(F.struct("doc_id", "file", "row")).alias("keep"), F.count("*").alias("size")))
    return plain.unionByName(odd.join(groups, ["digest", "text"]).select(out))


def kept_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    rows = located(docs)
    gone = dedup_located(rows).where("keep.file <> file or keep.row <> row")
    return without(rows, gone.select("file", "row"))


def without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """Located rows but those at ``gone`` (file, row).  Rows that have no mark
    surely stay and are not shuffled; the others meet the list itself."""
    at = ["_fm_file", "_fm_row"]
    gone = cut(gone.select(F.col("file").alias("_fm_file"), F.col("row").alias("_fm_row")))
    rows = marked(rows, at, marks(gone, at))
    stay = rows.where("not _fm_marked").unionByName(rows.where("_fm_marked").join(gone, at, "left_anti"))
    return stay.drop(*at, "_fm_marked")
