"""Command line: one run over a folder of fetched input, or the delivery of what
runs have left in an outbox: ``deliver --outbox DIR --url URL``.

Exit codes: 0 done, 1 failed, 2 bad configuration or usage, 3 unreadable state,
130 interrupted.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import sinks
from .config import ConfigError, load
from .operators.state import StateError, StateStore
from .outbox import Outbox, post_json
from .pipeline import Inputs, run
from .provider import Replay
from .sources import archive


def arguments(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser("feedmill")
    p.add_argument("--config", help="configuration file")
    p.add_argument("--input", required=True, help="folder with parquet tables listing_pages, feeds, sitemaps, messages, fetched, answers, languages")
    p.add_argument("--state", required=True)
    p.add_argument("--results", required=True)
    p.add_argument("--site", help="only sources whose URL has this part")
    p.add_argument("--as-of", help="time of the run, ISO; now, if not given")
    p.add_argument("--outbox", help="folder where the items are left for delivery")
    p.add_argument("--logs")
    return p.parse_args(argv)


def deliver(argv: list[str], spark: SparkSession | None = None, send: Callable[[str, bytes, str], int] = post_json) -> int:
    p = argparse.ArgumentParser("feedmill deliver")
    p.add_argument("--outbox", required=True)
    p.add_argument("--url", required=True)
    p.add_argument("--per-request", type=int, default=100)
    p.add_argument("--per-second", type=float, help="requests of each task")
    try:
        args = p.parse_args(argv)
    except SystemExit as e:
        return int(e.code or 0)
    spark = spark or session()
    url = args.url
    done = Outbox(args.outbox).deliver(spark, lambda body, identifier: send(url, body, identifier), args.per_request, args.per_second)
    print(f"delivered {done['answered']} of {done['asked']}")
    return 0 if done["answered"] == done["asked"] else 1


def session() -> SparkSession:
    return SparkSession.builder.appName("feedmill").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    argv = sys.argv[1:] if argv is None else argv
    if argv[:1] == ["deliver"]:
        return deliver(argv[1:], spark)
    try:
        args = arguments(argv)
    except SystemExit as e:
        return int(e.code or 0)
    if args.logs:
        sinks.set_up_logs(args.logs)
    try:
        cfg = load(args.config)
        cfg = cfg.for_site(args.site) if args.site else cfg
        as_of = datetime.fromisoformat(args.as_of) if args.as_of else datetime.now(UTC)
    except (ConfigError, FileNotFoundError, ValueError) as e:
        print(e, file=sys.stderr)
        return 2
    as_of = as_of if as_of.tzinfo else as_of.replace(tzinfo=UTC)
    spark = spark or session()
    table = lambda name: spark.read.parquet(f"{args.input}/{name}") if "://" in args.input or Path(args.input, name).exists() else None
    try:
        answers = table("answers")
        inputs = Inputs(*(table(n) for n in ("listing_pages", "feeds", "sitemaps", "messages", "fetched", "languages")))
        result = run(spark, cfg, inputs, as_of, StateStore(spark, args.state), Replay(answers) if answers is not None else None)
        archive.write_items(result.items, args.results, as_of)
        archive.write_document(result.items.select(F.to_json(F.struct("source_key", "url", "title", "categories", "keywords")).alias("json")), args.results, as_of)
        if args.outbox:
            Outbox(args.outbox).add(sinks.deliveries(result.items, as_of))
        archive.clear_old(spark, args.results, as_of)
        for row in result.metrics.orderBy("stage", "kind").collect():
            print(f"{row['stage']} {row['kind']} {row['n']}")
    except KeyboardInterrupt:
        return 130
    except StateError as e:
        print(e, file=sys.stderr)
        return 3
    except Exception as e:  # noqa: BLE001
        print(f"failed: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
