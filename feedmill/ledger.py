"""Durable keyed work: a task puts what it has done on record as it goes.

A ledger is a folder of small Parquet files (key, value), a subfolder for each bucket
of keys.  ``work`` hands rows whose key has no entry to a function, a batch at a time,
and writes each batch's results before it takes the next.  So a job that is killed
loses one batch of each task at most, and the next one asks only for what has no
entry; a task that is run again in the same job first reads what it has written.

The folder is a path that ``pyarrow.fs`` opens on the executors and Spark reads.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "key string, value string"


def open_folder(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else f"file:{path}")


def write_whole(path: str, table: pa.Table) -> None:
    """A Parquet file that appears complete or not at all."""
    fs, name = open_folder(path)
    folder, _, base = name.rpartition("/")
    fs.create_dir(folder, recursive=True)
    pq.write_table(table, f"{folder}/_{base}", filesystem=fs)  # names with _ are not read
    fs.move(f"{folder}/_{base}", name)


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


class Pace:
    """Lets ``per_second`` calls through in a second; all, if it is None."""

    def __init__(self, per_second: float | None, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic) -> None:
        self.step, self.sleep, self.clock, self.next = 1 / per_second if per_second else 0, sleep, clock, 0.0

    def wait(self) -> None:
        now = self.clock()
        if self.step and now < self.next:
            self.sleep(self.next - now)
        self.next = max(now, self.next) + self.step


@dataclass(frozen=True)
class Ledger:
    path: str
    buckets: int = 64

    def read(self, spark: SparkSession) -> DataFrame:
        """key, value: the entry of each key; of several (from tasks that ran twice
        at once) the largest."""
        if not exists(spark, self.path):
            return spark.createDataFrame([], SCHEMA)
        rows = spark.read.schema(f"{SCHEMA}, bucket int").parquet(self.path)
        return rows.groupBy("key").agg(F.max("value").alias("value"))

    def todo(self, rows: DataFrame) -> DataFrame:
        """Rows (key, body) without an entry, one for each key."""
        one = rows.where("key is not null").groupBy("key").agg(F.max("body").alias("body"))
        return one.join(self.read(rows.sparkSession).select("key"), "key", "left_anti")

    def work(self, rows: DataFrame, do: Callable[[list[tuple[str, str]]], list[str | None]], batch: int = 100, per_second: float | None = None) -> dict[str, int]:
        """Hand rows (key, body) without an entry to ``do``, up to ``batch`` of them
        at once, and record what it returns; None is no entry, so that key comes again
        in the next job.  How many were asked for and how many have an entry now."""
        run, me = uuid.uuid4().hex, self

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pace, held, bucket, done = Pace(per_second), [], None, set()
            asked = answered = 0

            def flush() -> None:
                nonlocal answered, held
                if held:
                    pace.wait()
                    got = [(k, v) for (k, _), v in zip(held, do(held), strict=True) if v is not None]
                    if got:
                        write_whole(f"{me.path}/bucket={bucket}/{run}-{uuid.uuid4().hex}.parquet", pa.table({"key": [k for k, _ in got], "value": [v for _, v in got]}))
                    answered += len(got)
                    held = []

            for some in batches:
                for b, key, body in zip(*(some.column(i).to_pylist() for i in range(3))):
                    if b != bucket:
                        flush()
                        bucket, done = b, me._written(b, run)
                    asked += 1
                    if key in done:
                        answered += 1
                        continue
                    held.append((key, body))
                    if len(held) == batch:
                        flush()
            flush()
            yield pa.RecordBatch.from_pydict({"asked": [asked], "answered": [answered]})

        left = self.todo(rows).select(F.pmod(F.xxhash64("key"), F.lit(self.buckets)).cast("int").alias("bucket"), "key", "body")
        dealt = left.repartitionById(self.buckets, "bucket").sortWithinPartitions("bucket", "key")
        sums = dealt.mapInArrow(task, "asked long, answered long").agg(F.sum("asked"), F.sum("answered")).first()
        return {"asked": sums[0] or 0, "answered": sums[1] or 0}

    def _written(self, bucket: int, run: str) -> set[str]:
        """Keys that an earlier attempt of this job's task has recorded."""
        fs, at = open_folder(f"{self.path}/bucket={bucket}")
        files = fs.get_file_info(pafs.FileSelector(at, allow_not_found=True))
        mine = [f.path for f in files if f.base_name.startswith(run)]
        return {k for f in mine for k in pq.read_table(f, columns=["key"], filesystem=fs, partitioning=None)["key"].to_pylist()}

    def compact(self, spark: SparkSession) -> None:
        """One file for each bucket instead of one for each batch.  The new files
        are complete before the old ones go; a crash in between leaves repeated
        entries, which reading folds."""
        if not exists(spark, self.path):
            return
        me, name = self, f"compact-{uuid.uuid4().hex}.parquet"
        rows = spark.read.schema(f"{SCHEMA}, bucket int").parquet(self.path).select("bucket", F.col("_metadata.file_path").alias("file"))

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for some in batches:
                for bucket in some.column(0).to_pylist():
                    fs, at = open_folder(f"{me.path}/bucket={bucket}")
                    files = [f.path for f in fs.get_file_info(pafs.FileSelector(at)) if not f.base_name.startswith("_")]
                    whole = pa.concat_tables([pq.read_table(f, columns=["key", "value"], filesystem=fs, partitioning=None) for f in files])
                    write_whole(f"{me.path}/bucket={bucket}/{name}", whole.group_by("key").aggregate([("value", "max")]).rename_columns(["key", "value"]))
                    for f in files:
                        fs.delete_file(f)
                    yield pa.RecordBatch.from_pydict({"files": [len(files)]})

        many = rows.distinct().groupBy("bucket").count().where("count > 1").select("bucket")
        many.repartitionById(self.buckets, "bucket").mapInArrow(task, "files long").agg(F.sum("files")).first()
