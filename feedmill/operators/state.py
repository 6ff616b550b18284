"""The processing state: anti-join, last writer wins, a base and runs over it in Parquet."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATUSES = ("success", "extraction_failed", "enrichment_failed", "preparation_failed", "filtered", "archive_failed")
SCHEMA = "source_key string, status string, reason string, article_date string, processed_at timestamp, seq long"
_COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]


def skip_processed(items: DataFrame, state: DataFrame, key: str = "source_key", terminal: tuple[str, ...] = ("success",)) -> DataFrame:
    """Items without a record of a terminal status; all others are tried again."""
    done = state.where(F.col("status").isin(*terminal)).select(F.col("source_key").alias(key))
    return items.join(done, key, "left_anti")


def latest(records: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The last record of each key, by ``seq``; partial sums fold a busy key's
    records before the shuffle."""
    rest = [c for c in records.columns if c not in keys]
    best = records.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(seq)).alias("_fm_last"))
    return best.select(*keys, *[F.col(f"_fm_last.{c}").alias(c) for c in rest])


class StateError(Exception):
    """The state cannot be read."""


#: A row of the table of runs; ``covers`` are the versions that a base replaces,
#: ``keys`` is a sketch of the keys of a version.
RUN = "version string, base boolean, seq long, last_run timestamp, n long, keys binary, covers array<string>"


class StateStore:
    """State in Parquet folders under one path: a base and, over it, a folder for
    each run with that run's records alone, so what a run writes follows its own
    size.  Readers take the last record of a key from both.

    A folder counts once a row of the table of runs names it, each row in a
    folder of its own, so a crash in between changes nothing and two writers
    cannot disturb each other: both their runs count.  Of records with the same
    number the later one wins.  A base names all versions it replaces, so runs
    that were written meanwhile still lie over it; of two bases the one with the
    higher number counts.  Once more than ``dead`` of all records are surely
    replaced, or more than ``folders`` lie over the base, a run makes a new base.
    """

    def __init__(self, spark: SparkSession, path: str, dead: float = 0.5, folders: int = 64) -> None:
        self.spark, self.path, self.dead, self.folders = spark, path, dead, folders

    def _fs(self):
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        root = hadoop.Path(f"{self.path}/runs")
        return root.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop.Path

    def _runs(self) -> DataFrame:
        return self.spark.read.schema(RUN).option("recursiveFileLookup", True).parquet(f"{self.path}/runs")

    def runs(self) -> list:
        """Rows of the table of runs without their sketches, newest first; few, as
        a new base does away with what the one before it replaced."""
        fs, as_path = self._fs()
        if not fs.exists(as_path(f"{self.path}/runs")):
            return []
        try:
            rows = self._runs().drop("keys").collect()
        except Exception as e:
            raise StateError(f"state at {self.path} cannot be read") from e
        return sorted(rows, key=lambda r: (r["seq"], r["last_run"], r["version"]), reverse=True)

    @staticmethod
    def _live(runs: list) -> tuple[object | None, list]:
        """The base that counts, and the versions to read: it and all runs that it
        does not replace."""
        base = next((r for r in runs if r["base"]), None)
        gone = set(base["covers"]) if base else set()
        return base, [r for r in runs if (r is base or not r["base"]) and r["version"] not in gone]

    def _records(self, live: list) -> DataFrame:
        if not live:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(*[f"{self.path}/{r['version']}" for r in live])

    @staticmethod
    def _merged(records: DataFrame) -> DataFrame:
        rest = ["seq", "processed_at", "status", "reason", "article_date"]
        last = records.groupBy("source_key").agg(F.max(F.struct(*rest)).alias("_fm_last"))
        return last.select("source_key", *[F.col(f"_fm_last.{c}").alias(c) for c in _COLUMNS[1:]])

    def read(self, keys: DataFrame | None = None, key: str = "source_key") -> DataFrame:
        """The last record of each key; none if there is no state yet.  With
        ``keys``, only of the keys that are among them, so that a small batch
        meets the state where it lies and only its own records are shuffled."""
        records = self._records(self._live(self.runs())[1])
        if keys is not None:
            records = records.join(keys.select(F.col(key).alias("source_key")), "source_key", "left_semi")
        return self._merged(records)

    def last_run(self, as_of):
        """When the last run was; a day before ``as_of``, if there was none."""
        from datetime import timedelta

        runs = self.runs()
        return runs[0]["last_run"] if runs else as_of - timedelta(hours=24)

    def _name(self, version: str, base: bool, seq: int, last_run, covers: list[str]) -> None:
        """Count and sketch a written folder where it lies, and make it count."""
        folder = self.spark.read.schema(SCHEMA).parquet(f"{self.path}/{version}")
        row = folder.agg(F.count("*").alias("n"), F.hll_sketch_agg("source_key").alias("keys"))
        row = row.withColumns({"version": F.lit(version), "base": F.lit(base), "seq": F.lit(seq).cast("long"), "last_run": F.lit(last_run), "covers": F.array(*map(F.lit, covers)).cast("array<string>")})
        row.select([c.split()[0] for c in RUN.split(", ")]).coalesce(1).write.parquet(f"{self.path}/runs/{version}")

    def upsert(self, records: DataFrame, as_of) -> None:
        """Write ``records`` over the old ones; also for empty runs, which move the
        last run on."""
        runs = self.runs()
        seq = (runs[0]["seq"] if runs else 0) + 1
        known = F.col("status").isin(*STATUSES)
        # Checked while it is written, so that the records are made once.
        checked = F.when(known, F.col("status")).otherwise(F.raise_error(F.concat(F.lit("status is not known: "), F.col("status"))))
        fresh = records.withColumn("status", checked).withColumn("seq", F.lit(seq).cast("long")).select(*_COLUMNS)
        version = f"v{seq}-{uuid.uuid4().hex[:8]}"
        fresh.write.parquet(f"{self.path}/{version}")
        self._name(version, False, seq, as_of, [])
        if self._worn():
            self.compact()

    def _worn(self) -> bool:
        live = self._live(self.runs())[1]
        n = sum(r["n"] for r in live)
        if len(live) > self.folders + 1 or n == 0:
            return n > 0
        keys = self._runs().where(F.col("version").isin([r["version"] for r in live])).agg(F.hll_sketch_estimate(F.hll_union_agg("keys"))).first()[0]
        return len(live) > 1 and n - keys > self.dead * n

    def compact(self) -> None:
        """Make a base of all that counts now; then delete what the base before it
        had replaced.  What this one replaces stays, for readers who began earlier."""
        runs = self.runs()
        base, live = self._live(runs)
        if not live:
            return
        seq = runs[0]["seq"] + 1  # higher than that of any base whose runs it may delete
        version = f"b{seq}-{uuid.uuid4().hex[:8]}"
        self._merged(self._records(live)).write.parquet(f"{self.path}/{version}")
        self._name(version, True, seq, runs[0]["last_run"], [r["version"] for r in runs])
        fs, as_path = self._fs()
        present = {r["version"] for r in runs}
        for old in base["covers"] if base else []:
            if old in present:
                fs.delete(as_path(f"{self.path}/runs/{old}"), True)
                fs.delete(as_path(f"{self.path}/{old}"), True)
