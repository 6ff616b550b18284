"""Versioned results: writing, listing, loading, and clearing old ones."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import filename_time

ITEMS = "execution_timestamp string, item_count long, items array<map<string,string>>"


def file_name(at: datetime) -> str:
    return at.strftime("results_%Y-%m-%dT%H%M%SZ.json")


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    p = hadoop.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop.Path


def write_items(items: DataFrame, path: str, at: datetime) -> str:
    """The run's items as Parquet under their run, and a small JSON document that
    names them; items never pass through the driver."""
    items.write.mode("overwrite").parquet(f"{path}/items/run={at:%Y%m%dT%H%M%SZ}")
    return f"{path}/items/run={at:%Y%m%dT%H%M%SZ}"


def write_document(items: DataFrame, path: str, at: datetime) -> str:
    """One JSON document {execution_timestamp, item_count, items}, for consumers
    that want a file; ``items`` has a column json.  It is one row, so this is
    for a run's accepted items, not for a corpus."""

    spark = items.sparkSession
    body = items.agg(F.count("*").alias("n"), F.array_sort(F.collect_list("json")).alias("j"))
    text = body.select(F.concat(F.lit(f'{{"execution_timestamp":"{at:%Y-%m-%dT%H:%M:%SZ}","item_count":'), F.col("n").cast("string"), F.lit(',"items":['), F.array_join("j", ","), F.lit("]}")).alias("value"))
    fs, as_path = _fs(spark, path)
    tmp = f"{path}/.{file_name(at)}.tmp"
    text.coalesce(1).write.mode("overwrite").text(tmp)
    part = next(str(f.getPath()) for f in fs.listStatus(as_path(tmp)) if f.getPath().getName().startswith("part-"))
    target = f"{path}/{file_name(at)}"
    fs.delete(as_path(target), False)
    fs.rename(as_path(part), as_path(target))
    fs.delete(as_path(tmp), True)
    return target


def list_results(spark: SparkSession, path: str, limit: int = 100) -> DataFrame:
    """path, at, size_bytes, item_count of the newest documents; files whose
    names hold no time are left out."""
    fs, as_path = _fs(spark, path)
    if not fs.globStatus(as_path(f"{path}/results_*.json")):
        return spark.createDataFrame([], "path string, at timestamp, size_bytes long, item_count long")
    files = spark.read.format("binaryFile").load(f"{path}/results_*.json")
    rows = files.select("path", filename_time(F.col("path")).alias("at"), F.col("length").alias("size_bytes"), F.get_json_object(F.col("content").cast("string"), "$.item_count").cast("long").alias("item_count"))
    return rows.where("at is not null").orderBy(F.col("at").desc()).limit(limit)


def load_results(spark: SparkSession, file: str) -> DataFrame:
    """Items of one document, as JSON texts in its order."""
    whole = spark.read.text(file, wholetext=True)
    return whole.select(F.posexplode(F.from_json(F.get_json_object("value", "$.items"), "array<string>")).alias("pos", "json"))


def clear_old(spark: SparkSession, path: str, as_of: datetime, days: int = 30) -> int:
    """Delete documents older than ``days``; how many they were."""
    fs, as_path = _fs(spark, path)
    old = list_results(spark, path, 1_000_000).where(F.col("at") < F.lit(as_of - timedelta(days=days)))
    n = 0
    for row in old.select("path").toLocalIterator():
        n += bool(fs.delete(as_path(row[0]), False))
    return n
