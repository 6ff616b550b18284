"""Fetched pages: which tier's body counts, and why there is none."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def resolve_tiers(fetched: DataFrame) -> DataFrame:
    """``fetched``: url, http_status, static_html, rendered_html, crawled_html,
    fetch_method.  Adds html, extraction_method and reason.  A page that asks
    for a login ends the attempts; else the first tier with a body counts."""
    auth = F.col("http_status") == 401
    static = F.when((F.col("http_status") == 200) & F.col("fetch_method").isin("static", "auto"), F.col("static_html"))
    rendered = F.when(F.col("fetch_method").isin("browser", "playwright", "auto"), F.col("rendered_html"))
    html = F.when(~F.coalesce(auth, F.lit(False)), F.coalesce(static, rendered, F.col("crawled_html")))
    method = F.when(static.isNotNull(), "local").when(rendered.isNotNull(), "browser").when(F.col("crawled_html").isNotNull(), "browser_crawl")
    reason = F.when(auth, "auth_required").when(html.isNull(), "no_content")
    return fetched.withColumn("html", html).withColumn("extraction_method", F.when(html.isNotNull(), method)).withColumn("reason", reason)
