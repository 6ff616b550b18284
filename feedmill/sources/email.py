"""Messages of mail folders: their links as candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import urls
from ..functions.text import strip

ANCHOR = r"(?is)<a\s[^>]*?href\s*=\s*[\"']([^\"']*)[\"'][^>]*>(.*?)</a>"
PLAIN = r"https?://[^\s\"'<>)]+"


def new_messages(messages: DataFrame, last_run, limit: int = 100) -> DataFrame:
    """``messages``: folder, email_id, subject, sender, sent_at, received_at,
    body.  The newest ``limit`` of each folder since the last run."""
    order = Window.partitionBy("folder").orderBy(F.col("received_at").desc(), "email_id")
    fresh = messages.where(F.col("received_at") >= F.lit(last_run))
    return fresh.withColumn("_fm_n", F.row_number().over(order)).where(F.col("_fm_n") <= limit).drop("_fm_n")


def message_links(messages: DataFrame) -> DataFrame:
    """A row for each link of a message that may be an article; where a message
    has no anchors, its plain URLs are links."""
    found = F.regexp_extract_all("body", F.lit(ANCHOR), F.lit(0))
    anchors = F.transform(found, lambda a: F.struct(F.regexp_extract(a, ANCHOR, 1).alias("url"), strip(F.regexp_replace(F.regexp_replace(F.regexp_extract(a, ANCHOR, 2), "<[^>]*>", ""), r"\s+", " ")).alias("title")))
    plain = F.transform(F.regexp_extract_all("body", F.lit(PLAIN), F.lit(0)), lambda u: F.struct(u.alias("url"), u.alias("title")))
    rows = messages.select("*", F.posexplode(F.when(F.size(found) > 0, anchors).otherwise(plain)).alias("pos", "link"))
    rows = rows.select("*", "link.url", "link.title").drop("link")
    return rows.where(urls.link_ok(F.col("url"), F.col("title"), F.lit(""), "email"))


def as_items(links: DataFrame) -> DataFrame:
    """Candidates: keyed like those of web pages, so both kinds meet in the
    state, with ``origin`` to tell them apart."""
    return links.select(
        F.concat(F.lit("web:"), F.col("url")).alias("source_key"), "url", "title", F.col("sent_at").alias("published"), "pos", F.lit("email").alias("origin"),
        F.col("subject").alias("email_subject"), F.col("sender").alias("email_sender"), F.col("folder").alias("email_folder"), "email_id",
    )
