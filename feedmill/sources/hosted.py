"""Articles of a hosted extraction service, from its JSON answers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import discovered

ARTICLES = "struct<articles: array<struct<title: string, url: string, date: string, summary: string>>>"


def hosted_articles(answers: DataFrame) -> DataFrame:
    """``answers``: source_url, body.  Rows source_url, pos, title, url,
    published, description; bodies that aren't such JSON give none."""
    body = F.from_json("body", ARTICLES)
    nested = F.from_json(F.get_json_object("body", "$.data.json"), ARTICLES)
    rows = answers.select("source_url", F.posexplode(F.coalesce(body["articles"], nested["articles"])).alias("pos", "a"))
    return rows.where((F.col("a.url") != "") & (F.col("a.title") != "")).select("source_url", "pos", "a.title", "a.url", discovered(F.col("a.date")).alias("published"), F.col("a.summary").alias("description"))


def folder_parts(path: str) -> list[str]:
    """Names of a mail folder's path, from the top."""
    return [p for p in path.replace("\\", "/").split("/") if p]
