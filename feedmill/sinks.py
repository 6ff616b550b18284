"""Sinks beside the archive: webhook, mail archive, logs."""

from __future__ import annotations

import json
import logging
import logging.handlers
from collections.abc import Callable
from datetime import datetime
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .operators.outcome import webhook_row
from .provider import retry

log = logging.getLogger("feedmill")


def webhook_row_json() -> Column:
    c = F.col
    row = webhook_row(c("title"), c("published_at"), c("extracted_at"), c("categories"), c("summary"), c("keywords"), c("url"), c("language_detected"), c("source_type"), c("relevance_practice_area"))
    return F.to_json(row, {"ignoreNullFields": "false"})


def webhook_payload(items: DataFrame) -> DataFrame:
    """One column ``json``, a row for each item."""
    return items.select(webhook_row_json().alias("json"))


def deliveries(items: DataFrame, as_of: datetime) -> DataFrame:
    """A run's items as rows (key, body) for an outbox: the key is the item's, the
    body what the webhook gets.  Columns that a run without a provider lacks are null."""
    none = lambda kind: F.lit(None).cast(kind)
    made = {
        "published_at": F.coalesce(F.date_format("fresh_at", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("unknown")), "extracted_at": F.lit(as_of.strftime("%Y-%m-%dT%H:%M:%SZ")), "source_type": F.col("origin"),
        "summary": none("string"), "relevance_practice_area": none("string"),
    }
    rows = items.withColumns({k: v for k, v in made.items() if k not in items.columns})
    return rows.select(F.col("source_key").alias("key"), webhook_row_json().alias("body"))


def archive_messages(ids: list[tuple[str, str]], move: Callable[[str, str], None]) -> list[str]:
    """Moves messages (id, folder) with three attempts each; ids that failed."""
    failed = []
    for message, folder in ids:
        try:
            retry(lambda m=message, f=folder: move(m, f))
        except OSError as e:
            log.warning("message %s stays: %s", message, e)
            failed.append(message)
    return failed


def set_up_logs(folder: str, level: int = logging.INFO) -> logging.Handler:
    """A file that starts anew each day and keeps one old one."""
    Path(folder).mkdir(parents=True, exist_ok=True)
    handler = logging.handlers.TimedRotatingFileHandler(Path(folder, "feedmill.log"), when="midnight", backupCount=1, utc=True)
    handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(name)s %(message)s"))
    log.addHandler(handler)
    log.setLevel(level)
    return handler


def as_json(row: dict) -> str:
    """Without fields that are None."""
    return json.dumps({k: v for k, v in row.items() if v is not None}, ensure_ascii=False)
