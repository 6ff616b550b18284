"""The content pipeline: discover, freshness, state, extract, prepare, enrich,
output.  Every stage maps DataFrames to DataFrames; rejected items are rows with
a stage, a kind and a reason; ``as_of`` is the only clock.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import Config, Source
from .discovery import as_column, discover_sources, scan_sources, source_rows
from .functions import keywords, scoring, text, urls
from .functions.answers import any_answer
from .functions.dates import parse_iso
from .functions.language import language
from .functions.page import with_page
from .operators import freshness, languages, listings, lookup, outcome
from .operators.state import StateStore, skip_processed
from .provider import Provider, Replay
from .sources.email import as_items, message_links, new_messages
from .sources.fetched import resolve_tiers

CANDIDATE = "source_url string, source_key string, url string, title string, published timestamp, pos int, origin string, email_subject string, email_sender string, email_folder string, email_id string, categories array<string>"
REJECT = ["source_key", "stage", "kind", "reason", "article_date"]


@dataclass
class Inputs:
    """What was fetched, as DataFrames; any may be missing.

    listing_pages (url, html); feeds (source_url, feed_ord, http_status, xml);
    sitemaps (source_url, map_url, xml); messages (folder, email_id, subject,
    sender, sent_at, received_at, body); fetched (url, http_status, static_html,
    rendered_html, crawled_html, fetch_method); languages (gram, lang, weight), a
    model that operators.languages learned, in place of the built-in profiles.
    """

    listing_pages: DataFrame | None = None
    feeds: DataFrame | None = None
    sitemaps: DataFrame | None = None
    messages: DataFrame | None = None
    fetched: DataFrame | None = None
    languages: DataFrame | None = None


@dataclass
class Result:
    items: DataFrame
    rejects: DataFrame
    metrics: DataFrame
    parts: dict[str, DataFrame] = field(default_factory=dict)


def scan(spark: SparkSession, source: Source, inputs: Inputs, cfg: Config, as_of: datetime) -> DataFrame:
    """Candidates of one source, by its method and rules."""
    rows = scan_sources(spark, source_rows(spark, cfg, (source,)), inputs, as_of, cfg.article_max_age_days)
    return rows.select(F.lit(source.url).alias("source_url"), "url", "title", "published", "pos")


def names_column(names: tuple[str, ...]) -> Column:
    return F.array(*[F.lit(n) for n in names]).cast("array<string>")


def discover(spark: SparkSession, cfg: Config, inputs: Inputs, as_of: datetime, last_run: datetime) -> DataFrame:
    """Candidates of all sources and folders."""
    out = spark.createDataFrame([], CANDIDATE)
    if cfg.web_sources:
        rows = discover_sources(spark, source_rows(spark, cfg), inputs, as_of, cfg.article_max_age_days)
        out = out.unionByName(rows.withColumn("source_key", F.concat(F.lit("web:"), F.col("url"))).withColumn("origin", F.lit("web")), allowMissingColumns=True)
    if inputs.messages is not None and cfg.email_folders:
        mine = inputs.messages.where(F.col("folder").isin([f.folder_path for f in cfg.email_folders]))
        of_folder = F.create_map(*[x for f in cfg.email_folders for x in (F.lit(f.folder_path), names_column(f.categories))])
        out = out.unionByName(as_items(message_links(new_messages(mine, last_run))).withColumn("categories", F.element_at(of_folder, F.col("email_folder"))), allowMissingColumns=True)
    # Both origins share keys: one row for each, web before mail, then by position.
    order = F.struct(F.when(F.col("origin") == "web", 0).otherwise(1), "pos", F.coalesce("source_url", F.lit("")))
    rest = [c for c in out.columns if c != "source_key"]
    best = out.groupBy("source_key").agg(F.min_by(F.struct(*rest), order).alias("b"))
    return best.select("source_key", "b.*")


def reject(rows: DataFrame, stage: str, reason: Column, at: Column, kind: Column | None = None) -> DataFrame:
    made = rows.select("source_key", F.lit(stage).alias("stage"), reason.alias("reason"), at.cast("string").alias("article_date"))
    return made.withColumn("kind", outcome.reject_kind(F.col("stage"), F.col("reason")) if kind is None else kind).select(REJECT)


def extract(cfg: Config, items: DataFrame, fetched: DataFrame, as_of: datetime) -> DataFrame:
    """Items with page, html and, where they fail, a reason."""
    got = resolve_tiers(fetched).select("url", "html", "extraction_method", F.col("reason").alias("fetch_reason"))
    joined = items.join(got, "url", "left")
    read = with_page(joined, as_of, max_age_days=cfg.article_max_age_days, parts=("texts", "dates", "listing"))
    inline = F.col("url").isin([s.url for s in cfg.web_sources if s.listings_type == "inline"])
    return read.withColumn("is_listing", inline | (F.col("page.is_listing") & (F.size("page.articles") > 0))).withColumn("reason", F.when(F.col("html").isNull(), F.coalesce("fetch_reason", F.lit("no_content"))))


def categories_of(cfg: Config, items: DataFrame, spark: SparkSession) -> DataFrame:
    """Sets ``categories``: those of the source that the item's URL leads to, else
    those that the item got when it was found (from its feed, page or folder);
    without either, all."""
    every = names_column(tuple(c.name for c in cfg.categories))
    given = F.coalesce(F.col("categories"), every) if "categories" in items.columns else every
    if not cfg.web_sources:
        return items.withColumn("categories", given)
    dim = spark.createDataFrame([(s.url, i) for i, s in enumerate(cfg.web_sources)], "source_url string, source_ord int")
    found = lookup.source_by_url(items.drop("source_url"), dim, lookup.page_of(F.col("source_key")))
    own = F.create_map(*[x for u, cs in {s.url: s.categories for s in cfg.web_sources}.items() for x in (F.lit(u), names_column(cs))])
    return found.withColumn("categories", F.coalesce(F.element_at(own, F.col("source_url")), given))


def prompts(cfg: Config) -> dict[str, Column]:
    """Columns prompt and system: by the item's schema its dimensions, areas and
    system message; the default ones for items without a schema."""
    ask = lambda dims, areas: text.enrich_prompt(F.col("title"), F.col("content"), dims, areas)
    prompt, system = ask(scoring.DEFAULT_QUESTIONS, sorted(scoring.PRACTICE_AREAS)), F.lit(None).cast("string")
    for s in {c.relevance_schema.schema_id: c.relevance_schema for c in cfg.categories if c.relevance_schema}.values():
        mine = F.col("schema_id") == s.schema_id
        prompt = F.when(mine, ask(scoring.questions(s.dimensions), s.practice_areas or sorted(scoring.PRACTICE_AREAS))).otherwise(prompt)
        system = F.when(mine & F.lit(bool(s.system_message)), F.lit(s.system_message)).otherwise(system)
    return {"prompt": prompt, "system": system}


def enrich(cfg: Config, items: DataFrame, provider: Provider | None) -> DataFrame:
    """Adds the matched keywords and categories, the model's answer, scores,
    level and reason.  Items without a category never reach the provider;
    without a provider only keywords decide."""
    body = F.coalesce(F.when(F.col("content") != "", F.col("content")), F.col("title"))
    cats = keywords.matched_categories(body, cfg.keywords)
    rows = items.withColumn("categories", F.array_intersect("categories", cats))
    words = F.array().cast("array<string>")
    for name, ks in cfg.keywords.items():
        words = F.concat(words, F.when(F.array_contains("categories", name), keywords.matched(body, ks)).otherwise(F.array().cast("array<string>")))
    rows = rows.withColumn("keywords", keywords.distinct_ignoring_case(words)).withColumn("schema_id", lookup.first_schema(F.col("categories"), cfg.schemas))
    none = F.size("categories") == 0
    if provider is None:
        return rows.withColumn("reason", F.when(none, "filtered: no_categories_matched"))
    asked = rows.where(~none).withColumns(prompts(cfg))
    got = provider.answer(asked).withColumn("v", any_answer(F.col("answer")))
    get = lambda path, kind: F.try_variant_get(F.col("v"), path, kind)
    dims = [scoring.lenient_dimension(F.col("v"), d, "$.relevance_dimensions") for d in scoring.DIMENSIONS]
    got = got.withColumn("dims", F.struct(*[d.alias(n) for d, n in zip(dims, scoring.DIMENSIONS)])).withColumn("relevance_score", scoring.total([F.col(f"dims.{n}") for n in scoring.DIMENSIONS], cfg.bonus_rule))
    level = scoring.level(F.col("relevance_score"))
    for c in cfg.categories:
        if c.relevance_schema and c.relevance_schema.thresholds:
            level = F.when(F.col("schema_id") == c.relevance_schema.schema_id, scoring.level(F.col("relevance_score"), c.relevance_schema.thresholds)).otherwise(level)
    got = got.withColumn("relevance_level", F.when(F.col("v").isNotNull(), level))
    got = got.withColumn("title", F.coalesce(get("$.title", "string"), get("$.cleaned_title", "string"), F.col("title"))).withColumn("summary", get("$.summary", "string"))
    got = got.withColumn("relevance_practice_area", scoring.lenient_area(F.col("v"))).withColumn("validation_status", scoring.quality_status(get("$.quality_score", "double")))
    got = got.withColumn("reason", F.when(F.col("answer").isNull(), "no_answer").when(F.col("v").isNull(), "answer_not_json").otherwise(scoring.gate_reason(F.col("relevance_level")))).drop("v", "prompt", "system", "answer")
    return got.unionByName(rows.where(none).withColumn("reason", F.lit("no_categories_matched")), allowMissingColumns=True)


def run(spark: SparkSession, cfg: Config, inputs: Inputs, as_of: datetime, store: StateStore, provider: Provider | None = None, dedup_children: bool = True) -> Result:
    """One run over what was fetched.  Its records go into the state in one new
    version at the end; an empty run still moves the last run on."""
    at = as_column(as_of)
    state = store.read()
    found = discover(spark, cfg, inputs, as_of, store.last_run(as_of))
    judged = freshness.guardrail(found, F.col("published"), urls.dated(F.col("url")), at, cfg.article_max_age_days).persist()
    fresh = skip_processed(judged.where("verdict = 'fresh'"), state)
    stale = reject(judged.where("verdict <> 'fresh'"), "discovery", F.col("verdict"), F.col("fresh_at"), F.lit("filtered"))

    fetched = inputs.fetched if inputs.fetched is not None else spark.createDataFrame([], "url string, http_status int, static_html string, rendered_html string, crawled_html string, fetch_method string")
    read = extract(cfg, fresh, fetched, as_of).persist()
    failed = reject(read.where("reason is not null"), "extraction", F.col("reason"), F.col("fresh_at"))
    whole = read.where("reason is null")

    plain = categories_of(cfg, whole.where("not is_listing"), spark).withColumn("content", F.col("page.article"))
    plain = freshness.after_fetch(plain, F.col("published").isNotNull(), F.lit(False), parse_iso(F.col("page.article_date")), at, cfg.article_max_age_days)
    allowed = keywords.allowed(F.col("content"), F.col("categories"), cfg.keywords) if cfg.keyword_filter_enabled else F.lit(True)
    gated = reject(plain.where(~allowed), "extraction", F.lit("No keywords matched"), F.col("fresh_at"))
    articles = plain.where(allowed).select("source_key", "url", "title", "content", "fresh_at", "categories", "extraction_method", "origin")

    kids = listings.explode_children(whole.where("is_listing").select("url", F.col("page.articles").alias("articles")), "url", "articles").withColumnRenamed("url", "child_url")
    kids = kids.where(listings.is_valid(F.col("title"), F.col("date"), F.col("content"))).withColumn("fresh_at", F.try_to_timestamp("date"))
    if dedup_children:
        kids = skip_processed(kids, state)
    kids = kids.withColumn("child_ok", freshness.is_fresh(F.col("fresh_at"), at, cfg.article_max_age_days))
    empty = listings.parent_rollup(kids, "page_url", F.coalesce("child_ok", F.lit(False)), F.lit("filtered: too old"))
    parents = reject(empty.withColumn("source_key", F.concat(F.lit("web:"), F.col("page_url"))), "extraction", F.col("reason"), F.lit(None), F.lit("filtered"))
    kid_rows = categories_of(cfg, kids.where("child_ok").select("source_key", F.col("child_url").alias("url"), "title", "content", "fresh_at", "extraction_method", F.lit("web").alias("origin")), spark)
    rows = articles.unionByName(kid_rows.select(articles.columns))

    p = cfg.preparation
    if p.enabled:
        rows = rows.withColumn("prep", F.when(F.col("extraction_method") == "listings_article", F.struct(F.col("content").alias("text"), F.lit(1.0).alias("ratio"), F.lit("PASS").alias("status"), F.lit(None).cast("string").alias("reason"))).otherwise(text.prepare(F.col("content"), p.min_prepared_chars, p.min_article_ratio, p.warn_margin)))
    else:
        rows = rows.withColumn("prep", F.struct(F.col("content").alias("text"), F.lit(1.0).alias("ratio"), F.lit("PASS").alias("status"), F.lit(None).cast("string").alias("reason")))
    thin = reject(rows.where("prep.status = 'FAIL'"), "preparation", F.col("prep.reason"), F.col("fresh_at"))
    ready = rows.where("prep.status <> 'FAIL'").withColumn("content", F.col("prep.text")).drop("prep")

    done = enrich(cfg, ready, provider)
    if inputs.languages is None:
        done = done.withColumn("language_detected", language(F.col("content"))).persist()
    else:
        done = done.persist()
        done = done.join(languages.detect(done, inputs.languages, ("source_key",), "content", "language_detected"), "source_key")
    late = reject(done.where("reason is not null"), "enrichment", F.col("reason"), F.col("fresh_at"))
    items = done.where("reason is null").drop("reason").withColumn("title", text.normalize_title(F.col("title"))).orderBy(F.col("fresh_at").desc(), "source_key")

    rejects = stale
    for r in (failed, gated, parents, thin, late):
        rejects = rejects.unionByName(r)
    rejects = rejects.persist()
    ok = items.select("source_key", F.lit("success").alias("status"), F.lit(None).cast("string").alias("reason"), F.col("fresh_at").cast("string").alias("article_date"))
    status = F.when(F.col("kind") == "filtered", "filtered").otherwise(F.concat("stage", F.lit("_failed")))
    bad = rejects.where("stage <> 'discovery'").select("source_key", status.alias("status"), "reason", "article_date")
    kept = ok.unionByName(bad).groupBy("source_key").agg(F.min_by(F.struct("status", "reason", "article_date"), F.when(F.col("status") == "success", 0).otherwise(1)).alias("r")).select("source_key", "r.*")
    store.upsert(kept.withColumn("processed_at", at), as_of)
    metrics = outcome.run_metrics(rejects.select("stage", "kind").unionByName(items.select(F.lit("output").alias("stage"), F.lit("processed").alias("kind"))))
    return Result(items, rejects, metrics, {"found": found, "fresh": fresh})


__all__ = ["Inputs", "Replay", "Result", "run"]
