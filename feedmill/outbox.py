"""Deliveries apart from the run: an outbox that a run commits to, and its delivery.

The Python data source ``feedmill_outbox`` writes a run's deliveries (key, body) as
Parquet parts, a task for each; only the commit, which names the parts of all tasks,
makes them visible.  So a run that fails has sent nothing, and no item passes the
driver.  ``deliver`` sends what is committed and has no receipt, a batch for each
request, and records receipts as it goes: a key is sent once, whatever runs name it.
A batch that was sent when the task died before its receipt is sent again, under an
identifier of its own that the receiver knows from the first time.
"""

from __future__ import annotations

import hashlib
import json
import urllib.request
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from .ledger import Ledger, exists, open_folder
from .provider import retry

FORMAT = "feedmill_outbox"


@dataclass
class Part(WriterCommitMessage):
    name: str | None
    rows: int


class Writer(DataSourceArrowWriter):
    def __init__(self, path: str, run: str) -> None:
        self.path, self.run = path, run

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        name, rows, out = f"{self.run}-{uuid.uuid4().hex}.parquet", 0, None
        fs, at = open_folder(f"{self.path}/parts")
        fs.create_dir(at, recursive=True)
        for batch in iterator:
            if batch.num_rows:
                table = pa.table({"key": batch.column("key").cast(pa.string()), "body": batch.column("body").cast(pa.string())})
                out = out or pq.ParquetWriter(f"{at}/{name}", table.schema, filesystem=fs)
                out.write_table(table)
                rows += batch.num_rows
        if out is None:
            return Part(None, 0)
        out.close()
        return Part(name, rows)

    def commit(self, messages: list[Part | None]) -> None:
        named = [m for m in messages if m and m.name]
        fs, at = open_folder(f"{self.path}/commits")
        fs.create_dir(at, recursive=True)
        lines = "".join(json.dumps({"run": self.run, "part": m.name, "rows": m.rows}) + "\n" for m in named)
        with fs.open_output_stream(f"{at}/_{self.run}.json") as f:
            f.write(lines.encode())
        fs.move(f"{at}/_{self.run}.json", f"{at}/{self.run}.json")

    def abort(self, messages: list[Part | None]) -> None:
        fs, at = open_folder(f"{self.path}/parts")
        for m in messages:
            if m and m.name and fs.get_file_info(f"{at}/{m.name}").type != pafs.FileType.NotFound:
                fs.delete_file(f"{at}/{m.name}")


class OutboxSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "key string, body string"

    def writer(self, schema, overwrite: bool) -> Writer:
        if overwrite:
            raise ValueError("an outbox is only added to")
        return Writer(self.options["path"], self.options.get("run") or uuid.uuid4().hex)


def post_json(url: str, body: bytes, identifier: str, timeout: float = 30) -> int:
    request = urllib.request.Request(url, body, {"Content-Type": "application/json", "Idempotency-Key": identifier})
    with urllib.request.urlopen(request, timeout=timeout) as r:
        return r.status


@dataclass(frozen=True)
class Outbox:
    path: str
    buckets: int = 64

    @property
    def receipts(self) -> Ledger:
        return Ledger(f"{self.path}/receipts", self.buckets)

    def add(self, rows: DataFrame, run: str | None = None) -> None:
        """Commit rows (key, body), all or none."""
        spark = rows.sparkSession
        spark.dataSource.register(OutboxSource)
        rows.select(F.col("key").cast("string").alias("key"), F.col("body").cast("string").alias("body")).write.format(FORMAT).mode("append").option("path", self.path).option("run", run or uuid.uuid4().hex).save()

    def committed(self, spark: SparkSession) -> DataFrame:
        """key, body of all commits, one row for each key; parts that no commit
        names are not read."""
        if not exists(spark, f"{self.path}/commits") or not exists(spark, f"{self.path}/parts"):
            return spark.createDataFrame([], "key string, body string")
        named = spark.read.schema("run string, part string, rows long").json(f"{self.path}/commits").select("part")
        rows = spark.read.schema("key string, body string").parquet(f"{self.path}/parts").withColumn("part", F.col("_metadata.file_name"))
        return rows.join(named, "part", "left_semi").groupBy("key").agg(F.min("body").alias("body"))

    def pending(self, spark: SparkSession) -> DataFrame:
        return self.receipts.todo(self.committed(spark))

    def deliver(self, spark: SparkSession, send: Callable[[bytes, str], int], per_request: int = 100, per_second: float | None = None, delays: tuple[float, ...] = (0, 1, 4)) -> dict[str, int]:
        """Send what is pending; ``send`` gets a JSON array and its identifier and
        returns a status, or raises OSError, which is tried again after ``delays``.
        What was refused stays pending.  How many were asked and how many are sent."""

        def do(batch: list[tuple[str, str]]) -> list[str | None]:
            body = "[" + ",".join(b for _, b in batch) + "]"
            identifier = hashlib.sha256("\n".join(k for k, _ in batch).encode()).hexdigest()
            try:
                status = retry(lambda: send(body.encode(), identifier), delays)
            except OSError:
                return [None] * len(batch)
            return [str(status) if 200 <= status < 300 else None] * len(batch)

        return self.receipts.work(self.committed(spark), do, per_request, per_second)
