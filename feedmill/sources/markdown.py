"""Links of pages that a reader service gives as markdown."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LINK = r"\[([^\]]*)\]\(([^)\s]*)[^)]*\)"


def links(markdown: Column) -> Column:
    """Array of (text, url) in order."""
    found = F.regexp_extract_all(markdown, F.lit(LINK), F.lit(0))
    return F.transform(found, lambda m: F.struct(F.regexp_extract(m, LINK, 1).alias("text"), F.regexp_extract(m, LINK, 2).alias("url")))
