"""Incremental work: micro-batches of candidates into the state, and events
without repeats."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.state import StateStore, skip_processed


def run_available(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> None:
    """Hand all that has arrived to ``handle`` in micro-batches, then stop."""
    stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def upsert_batches(store: StateStore, as_of, decide: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """Handler that drops what the state has done, lets ``decide`` give each
    item's status, and records it.  A batch that comes again after a crash finds
    its successes done, so it changes nothing."""

    def handle(batch: DataFrame, _: int) -> None:
        todo = skip_processed(batch, store.read(batch))
        store.upsert(decide(todo), as_of)

    return handle


def distinct_events(events: DataFrame, key: str = "event_id", time: str = "ts", delay: str = "3 days") -> DataFrame:
    """Streamed events without repeats within a delay; later ones are dropped.
    Times without a zone are taken as UTC."""
    typed = events.withColumn(time, F.col(time).cast("timestamp"))
    return typed.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def events_by_day(spark: SparkSession, path: str, checkpoint: str, out: str) -> DataFrame:
    """Counts of distinct events for each day and type, through a stream."""
    raw = spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path}*")  # a glob, as a stream cannot read a path that is one file
    q = distinct_events(raw).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(out).groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("n"))
