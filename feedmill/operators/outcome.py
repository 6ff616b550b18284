"""What became of each item: kinds of rejects, run counters, output rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize_title


def reject_kind(stage: Column, reason: Column) -> Column:
    """``filtered`` for items that rules put aside, ``failed`` for the rest."""
    r = F.coalesce(reason, F.lit(""))
    extraction = F.contains(r, F.lit("No keywords matched")) | (r == "filtered_out") | F.contains(F.lower(r), F.lit("too old"))
    return F.when(F.when(stage == "enrichment", r.startswith("filtered:")).otherwise(extraction), "filtered").otherwise("failed")


def run_metrics(rows: DataFrame) -> DataFrame:
    """Items by stage and kind."""
    return rows.groupBy("stage", "kind").agg(F.count("*").alias("n"))


def failed_items(rejects: DataFrame) -> DataFrame:
    """Reject records: the stage without its ``_failed`` ending."""
    return rejects.withColumn("failure_stage", F.regexp_replace("stage", "_failed$", ""))


def output_json(item: Column) -> Column:
    """An item as JSON without its content and without null fields."""
    return F.to_json(item.dropFields("content"))


def webhook_row(title: Column, published: Column, extracted: Column, categories: Column, summary: Column, keywords: Column, url: Column, language: Column, source_type: Column, area: Column) -> Column:
    date = F.when(published.isNull() | (published == "unknown"), extracted).otherwise(published)
    return F.struct(
        normalize_title(title).alias("title"), date.alias("date"), F.get(categories, F.lit(0)).alias("category"), summary.alias("summary"),
        F.coalesce(keywords, F.array().cast("array<string>")).alias("keywords"), url.alias("url"), language.alias("language"), categories.alias("tags"),
        F.lit(None).cast("string").alias("raw_html"), source_type.alias("source_type"), F.when(area.isNull(), F.array().cast("array<string>")).otherwise(F.array(area)).alias("practice_areas"),
    )


def not_empty_gate(title: Column, summary: Column) -> Column:
    filled = lambda c: F.trim(F.coalesce(c, F.lit(""))) != ""
    return filled(title) & filled(summary)


def cleaned(title: Column, proposed: Column, least: int = 10) -> Column:
    """A proposed title is taken if it is longer than ``least``."""
    return F.when(F.length(F.trim(proposed)) > least, F.trim(proposed)).otherwise(title)
