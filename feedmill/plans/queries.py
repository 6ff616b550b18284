"""Queries over the given tables, one or more for each operator, with the SQL
that gives the same rows.  Times are literal: 2001-01-01 and the like."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, keywords, scoring, text, urls
from ..operators import candidates, freshness, languages, listings, lookup, near_copies, outcome, state

#: Dictionary of the sample categories; "empty" has no keywords.
CATEGORIES = {"legal": ["license", "einheit", "heit"], "flow": ["tion", "ment"], "empty": []}
SOURCES = [("https://the", 0), ("http://", 1), ("https://th", 2), ("https://", 3)]


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _shared(spark: SparkSession) -> str:
    """The folder that driver and executors share; a local one only on one machine."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return found or tempfile.mkdtemp(prefix="feedmill-")


def _sql_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def _any_sql(column: str, parts) -> str:
    return "(" + " OR ".join(f"contains({column}, '{p}')" for p in parts) + ")" if parts else "FALSE"


QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


_STRIP = "regexp_replace({0}, '^\\s+|\\s+$', '', 'g')"
_LINES = f"list_filter(list_transform(regexp_split_to_array(text, '\\r\\n|\\n|\\r'), lambda x: {_STRIP.format('x')}), lambda s: s <> '' AND (length(s) > 60 OR regexp_matches(s, '[.?!]$') OR (upper(s) = s AND lower(s) <> s AND length(s) > 10)))"
_PREPARED = f"""p AS (SELECT doc_id, text, lang, source, array_to_string({_LINES}, chr(10) || chr(10)) AS prepared FROM documents),
    q AS (SELECT *, CASE WHEN length(text) > 0 THEN CAST(length(prepared) AS DOUBLE) / length(text) ELSE 0.0 END AS ratio, {_STRIP.format('text')} = '' AS blank FROM p),
    s AS (SELECT *, CASE WHEN blank OR length(prepared) < 600 OR ratio < 0.95 THEN 'FAIL' WHEN ratio < 0.99 THEN 'WARN' ELSE 'PASS' END AS status FROM q)"""


def _prepared(spark, sf):
    return _t(spark, sf, "documents").withColumn("prep", text.prepare(F.col("text"), min_ratio=0.95, margin=0.04))


@query(f"""WITH {_PREPARED},
    c AS (SELECT s.status, s.doc_id, unnest(list_filter(['legal', 'flow'], lambda n: CASE WHEN n = 'legal' THEN {_any_sql('lower(prepared)', CATEGORIES['legal'])} ELSE {_any_sql('lower(prepared)', CATEGORIES['flow'])} END)) AS category FROM s)
    SELECT category, status, count(*) AS n FROM c GROUP BY category, status""")
def categories_by_status(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: prepared documents, matched against keyword categories."""
    rows = _prepared(spark, sf).select("prep.status", keywords.matched_categories(F.col("prep.text"), CATEGORIES).alias("found"))
    # An outer explode, as a plain one would add a filter that works "found" out twice.
    found = rows.select("status", F.explode_outer("found").alias("category")).where("category is not null")
    return found.groupBy("category", "status").agg(F.count("*").alias("n"))


@query(f"""WITH {_PREPARED} SELECT doc_id, md5(prepared) AS prepared_md5, length(prepared) AS n_prepared, ratio, status,
    CASE WHEN blank THEN 'article_text_empty' WHEN status = 'FAIL' THEN 'article_text_insufficient' END AS reason FROM s""")
def prepare_text(spark, sf):
    p = F.col("prep")
    return _prepared(spark, sf).select("doc_id", F.md5(p["text"].cast("binary")).alias("prepared_md5"), F.length(p["text"]).cast("long").alias("n_prepared"), p["ratio"].alias("ratio"), p["status"].alias("status"), p["reason"].alias("reason"))


_ALL_WORDS = ["tion", "Heit", "einheit", "HEIT", "license"]


@query(f"""SELECT doc_id, list_filter({_sql_list(_ALL_WORDS)}, lambda k: contains(lower(text), lower(k))) AS matched,
    list_filter(['tion', 'Heit', 'einheit', 'license'], lambda k: contains(lower(text), lower(k))) AS kept FROM documents WHERE {_any_sql('lower(text)', [w.lower() for w in _ALL_WORDS])}""")
def categorize_keywords(spark, sf):
    d = _t(spark, sf, "documents").withColumn("matched", keywords.matched(F.col("text"), _ALL_WORDS)).where(F.size("matched") > 0)
    return d.select("doc_id", "matched", keywords.distinct_ignoring_case(F.col("matched")).alias("kept"))


@query(f"""WITH k(category, category_ord, keyword, keyword_ord) AS (VALUES ('legal', 0, 'license', 0), ('legal', 0, 'einheit', 1), ('flow', 1, 'tion', 0))
    SELECT k.category, k.keyword, count(*) AS n FROM documents d JOIN k ON contains(lower(d.text), k.keyword) GROUP BY 1, 2""")
def keyword_theta_join(spark, sf):
    """The join form, for matched keywords as rows."""
    from ..operators import substrings

    dim = spark.createDataFrame([("legal", "license"), ("legal", "einheit"), ("flow", "tion")], "category string, word string")
    low = _t(spark, sf, "documents").select("doc_id", F.lower("text").alias("text"))
    found = substrings.containing(low, dim, "doc_id").groupBy("word").agg(F.count("*").alias("n"))
    return found.join(F.broadcast(dim), "word").select("category", F.col("word").alias("keyword"), "n")  # three rows


@query(f"""SELECT doc_id, lang FROM documents WHERE lang NOT IN ('en', 'de', 'fr') OR lang = 'fr' OR (lang = 'en' AND {_any_sql('lower(text)', CATEGORIES['flow'])}) OR (lang = 'de' AND {_any_sql('lower(text)', CATEGORIES['legal'])})""")
def extraction_keyword_gate(spark, sf):
    """English needs "flow", German "legal", French a category without keywords, Spanish has none."""
    cats = F.when(F.col("lang") == "en", F.array(F.lit("flow"))).when(F.col("lang") == "de", F.array(F.lit("legal"))).when(F.col("lang") == "fr", F.array(F.lit("empty"))).otherwise(F.array().cast("array<string>"))
    return _t(spark, sf, "documents").withColumn("categories", cats).where(keywords.allowed(F.col("text"), F.col("categories"), CATEGORIES)).select("doc_id", "lang")


@query(f"SELECT doc_id FROM documents WHERE {_any_sql('lower(text)', ['license', 'einheit', 'heit', 'tion', 'ment'])}")
def rss_prefilter(spark, sf):
    words = lookup.keywords_of(["legal", "flow"], CATEGORIES)
    return _t(spark, sf, "documents").where(keywords.any_of(F.col("text"), words)).select("doc_id")


_PAGED = _any_sql("lower(url)", urls.PAGINATION) + " OR regexp_matches(lower(url), '/p/\\d+')"


@query(f"SELECT page_id, url, ({_PAGED}) AS paged, regexp_matches(lower(url), '\\.(jpg|jpeg|png|gif|pdf|mp3|mp4|webp)$') AS media, CASE WHEN {_any_sql('lower(url)', urls.LISTING)} THEN 'likely_listings' ELSE 'unknown' END AS kind FROM pages")
def url_flags(spark, sf):
    u = F.col("url")
    return _t(spark, sf, "pages").select("page_id", "url", urls.is_pagination(u).alias("paged"), urls.is_media(u).alias("media"), urls.classify(u).alias("kind"))


@query(f"SELECT page_id, url FROM pages WHERE NOT ({_PAGED})")
def pagination_filter(spark, sf):
    return _t(spark, sf, "pages").where(~urls.is_pagination(F.col("url"))).select("page_id", "url")


@query("SELECT page_id, url FROM pages WHERE (contains(url, '/en/') OR regexp_matches(url, 'example\\.(org|net)')) AND NOT (contains(url, 'utm_source') OR regexp_matches(url, '#[a-z]+$'))")
def url_rules(spark, sf):
    return _t(spark, sf, "pages").where(urls.passes_rules(F.col("url"), ["/en/", r"re:example\.(org|net)", "re:(["], ["utm_source", "re:#[a-z]+$", "re:*"])).select("page_id", "url")


_NORM = "lower(regexp_replace(regexp_replace({0}, '[?#].*$', ''), '/+$', ''))"


@query(f"SELECT page_id, {_NORM.format('url')} AS normal, regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9_+.-]*://([^/?#]*)', 1) AS host FROM pages")
def url_normalize(spark, sf):
    return _t(spark, sf, "pages").select("page_id", urls.normalize(F.col("url")).alias("normal"), urls.host(F.col("url")).alias("host"))


@query("SELECT regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9_+.-]*://([^/?#]*)', 1) AS host, count(*) AS n FROM pages GROUP BY 1")
def url_host_counts(spark, sf):
    return candidates.by_host(_t(spark, sf, "pages"), urls.host(F.col("url")))


@query(f"""WITH a AS (SELECT page_id, url, {_NORM.format('url')} AS n FROM pages), s AS (SELECT arg_min({_NORM.format('url')}, page_id) AS n FROM pages)
    SELECT page_id FROM a WHERE NOT (n IN (SELECT n FROM s))""")
def hub_filter(spark, sf):
    p = _t(spark, sf, "pages")
    hub = p.agg(F.min_by("url", "page_id").alias("hub"))  # one row
    return p.join(F.broadcast(hub), urls.is_hub_link(F.col("url"), F.col("hub"), F.lit(False)), "left_anti").select("page_id")


@query(f"""WITH s(source_url, ord) AS (VALUES ('https://the', 0), ('http://', 1), ('https://th', 2), ('https://', 3)),
    m AS (SELECT p.page_id, s.source_url, row_number() OVER (PARTITION BY p.page_id ORDER BY s.ord) AS r FROM pages p JOIN s ON starts_with(p.url, s.source_url))
    SELECT p.page_id, m.source_url FROM pages p LEFT JOIN m ON m.page_id = p.page_id AND m.r = 1""")
def source_lookup_prefix(spark, sf):
    dim = spark.createDataFrame(SOURCES, "source_url string, source_ord int")
    return lookup.source_by_url(_t(spark, sf, "pages"), dim, F.col("url")).select("page_id", "source_url")


@query("""WITH s AS (SELECT arg_max(url, page_id) AS source_url FROM pages GROUP BY regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9_+.-]*://([^/?#]*)', 1))
    SELECT p.page_id, s.source_url FROM pages p JOIN s ON regexp_replace(s.source_url, '/+$', '') = regexp_replace(p.url, '/+$', '')""")
def source_lookup_exact(spark, sf):
    """Sources are the newest page of each host; pages that are a source."""
    p = _t(spark, sf, "pages")
    dim = p.groupBy(urls.host(F.col("url")).alias("h")).agg(F.max_by("url", "page_id").alias("source_url"), F.max("page_id").cast("int").alias("source_ord")).drop("h")
    bare = lambda c: F.regexp_replace(c, "/+$", "")
    out = lookup.source_by_url(p, dim, F.col("url"))
    return out.where(bare(F.col("source_url")) == bare(F.col("url"))).select("page_id", "source_url")


_ORDER_URL = """CASE o_orderkey % 5 WHEN 0 THEN 'https://a.example/' || strftime(o_orderdate, '%Y%m%d') || '_x' WHEN 1 THEN 'https://a.example/' || strftime(o_orderdate, '%Y_%m') || '_x'
    WHEN 2 THEN 'https://a.example/' || strftime(o_orderdate, '%Y/%m/%d') || '/x' WHEN 3 THEN 'https://a.example/' || strftime(o_orderdate, '%Y-%m-%d') || '/x' ELSE 'https://a.example/2001/02/30/x' END"""
_ISO_DAY = "strftime({0}, '%Y-%m-%d')"


def _order_urls(spark, sf):
    d = F.col("o_orderdate")
    k = F.col("o_orderkey") % 5
    base = F.lit("https://a.example/")
    url = F.when(k == 0, F.concat(base, F.date_format(d, "yyyyMMdd"), F.lit("_x"))).when(k == 1, F.concat(base, F.date_format(d, "yyyy_MM"), F.lit("_x"))).when(k == 2, F.concat(base, F.date_format(d, "yyyy/MM/dd"), F.lit("/x")))
    url = url.when(k == 3, F.concat(base, F.date_format(d, "yyyy-MM-dd"), F.lit("/x"))).otherwise(F.concat(base, F.lit("2001/02/30/x")))
    return _t(spark, sf, "orders").withColumn("url", url)


@query(f"""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 1 THEN strftime(o_orderdate, '%Y-%m-01') WHEN 4 THEN NULL ELSE {_ISO_DAY.format('o_orderdate')} END AS dated,
    CASE WHEN o_orderkey % 5 IN (2, 3) AND year(o_orderdate) >= 2000 THEN {_ISO_DAY.format('o_orderdate')} END AS generic FROM orders""")
def url_date_extract(spark, sf):
    u = F.col("url")
    return _order_urls(spark, sf).select("o_orderkey", urls.dated(u).cast("string").alias("dated"), urls.generic_date(u).cast("string").alias("generic"))


_DE = ["Januar", "Februar", "März", "April", "Mai", "Juni", "Juli", "August", "September", "Oktober", "November", "Dezember"]


def _order_texts(spark, sf):
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 6
    german = F.element_at(F.array(*[F.lit(m) for m in _DE]), F.month(d))
    t = F.when(k == 0, F.concat(F.dayofmonth(d).cast("string"), F.lit(". "), german, F.lit(" "), F.year(d).cast("string")))
    t = t.when(k == 1, F.date_format(d, "MMMM d, yyyy")).when(k == 2, F.date_format(d, "d.M.yyyy")).when(k == 3, F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit("T10:20:30+02:00")))
    t = t.when(k == 4, F.date_format(d, "dd/MM/yyyy")).otherwise(F.lit("32.13.2026"))
    return _t(spark, sf, "orders").withColumn("said", t)


_TS = "strftime({0}, '%Y-%m-%dT%H:%M:%SZ')"


@query(f"""SELECT o_orderkey, CASE o_orderkey % 6 WHEN 5 THEN 'unknown' WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%dT10:20:30Z') ELSE strftime(o_orderdate, '%Y-%m-%dT00:00:00Z') END AS said_at FROM orders""")
def date_normalize_discovered(spark, sf):
    return _order_texts(spark, sf).select("o_orderkey", dates.iso_or_unknown(dates.discovered(F.col("said"))).alias("said_at"))


_SWAP = "CASE WHEN day(o_orderdate) <= 12 THEN strftime(o_orderdate, '%Y-%d-%mT00:00:00Z') ELSE strftime(o_orderdate, '%Y-%m-%dT00:00:00Z') END"


@query(f"""SELECT o_orderkey, CASE o_orderkey % 6 WHEN 5 THEN 'unknown' WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%dT08:20:30Z') WHEN 2 THEN {_SWAP} WHEN 4 THEN {_SWAP} ELSE strftime(o_orderdate, '%Y-%m-%dT00:00:00Z') END AS said_at FROM orders""")
def date_normalize_article(spark, sf):
    return _order_texts(spark, sf).select("o_orderkey", dates.iso_or_unknown(dates.article(F.col("said"))).alias("said_at"))


@query(f"""WITH a AS (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 5 THEN NULL WHEN 3 THEN date_trunc('day', o_orderdate) + INTERVAL 37230 SECOND ELSE date_trunc('day', o_orderdate) END AS t FROM orders)
    SELECT o_orderkey, CASE WHEN floor((epoch(TIMESTAMP '2000-01-01') - epoch(t)) / 86400) BETWEEN CASE WHEN o_orderkey % 6 = 4 THEN 0 ELSE -365 END AND 730 THEN {_TS.format('t')} ELSE 'unknown' END AS said_at FROM a""")
def date_normalize_listing(spark, sf):
    found = dates.listing(F.col("said"), F.lit("2000-01-01 00:00:00").cast("timestamp"))
    return _order_texts(spark, sf).select("o_orderkey", dates.iso_or_unknown(found).alias("said_at"))


_AS_OF = "2000-06-01 00:00:00"


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 7 = 0 OR o_orderdate >= TIMESTAMP '2000-06-01' - INTERVAL 90 DAY")
def freshness_filter(spark, sf):
    at = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderdate").cast("timestamp"))
    return freshness.discovery_filter(_t(spark, sf, "orders"), at, F.lit(_AS_OF).cast("timestamp"), 90).select("o_orderkey")


@query(f"""WITH a AS (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate ELSE CASE o_orderkey % 5 WHEN 1 THEN date_trunc('month', o_orderdate) WHEN 4 THEN NULL ELSE date_trunc('day', o_orderdate) END END AS seen FROM orders),
    v AS (SELECT *, CASE WHEN seen IS NULL THEN 'undated' WHEN seen >= TIMESTAMP '2000-06-01' - INTERVAL 90 DAY THEN 'fresh' ELSE 'stale' END AS verdict FROM a)
    SELECT verdict, count(*) AS n, {_TS.format('max(seen)')} AS newest FROM v GROUP BY verdict""")
def freshness_guardrail(spark, sf):
    at = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderdate").cast("timestamp"))
    rows = freshness.guardrail(_order_urls(spark, sf), at, urls.dated(F.col("url")), F.lit(_AS_OF).cast("timestamp"), 90)
    return rows.groupBy("verdict").agg(F.count("*").alias("n"), F.date_format(F.max("fresh_at"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("newest"))


@query("""WITH a AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate END AS p, o_orderdate AS d, CASE WHEN o_orderkey % 5 IN (2, 3) AND year(o_orderdate) >= 2000 THEN date_trunc('day', o_orderdate) END AS g FROM orders),
    b AS (SELECT *, TIMESTAMP '2000-06-01' - INTERVAL 90 DAY AS c FROM a)
    SELECT o_orderkey, strftime(coalesce(p, g), '%Y-%m-%d') AS published FROM b WHERE p IS NOT NULL OR g IS NULL OR g >= c""")
def url_date_fallback(spark, sf):
    rows = _order_urls(spark, sf).withColumn("published", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderdate").cast("timestamp")))
    u = F.col("url")
    out = freshness.url_date_fallback(rows, "published", urls.configured_date(u, [r"/(\d{4}-\d{2}-\d{2})/x", "(["]), urls.generic_date(u), F.lit(_AS_OF).cast("timestamp"), 90)
    return out.select("o_orderkey", F.date_format("published", "yyyy-MM-dd").alias("published"))


_STOP = """WITH e AS (SELECT event_id, user_id, max(CASE WHEN value < 1 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND {0}) AS old FROM events)
    SELECT event_id, user_id FROM e WHERE coalesce(old, 0) = 0"""


@query(_STOP.format("CURRENT ROW"))
def early_stop_exclusive(spark, sf):
    return candidates.take_until_old(_t(spark, sf, "events"), ["user_id"], "event_id", F.col("value") < 1, inclusive=False).select("event_id", "user_id")


@query(_STOP.format("1 PRECEDING"))
def early_stop_inclusive(spark, sf):
    return candidates.take_until_old(_t(spark, sf, "events"), ["user_id"], "event_id", F.col("value") < 1, inclusive=True).select("event_id", "user_id")


def _state(spark, sf):
    return _t(spark, sf, "labels").select(F.concat(F.lit("web:"), F.col("doc_id").cast("string")).alias("source_key"), F.when(F.col("quality") == 1, "success").when(F.col("toxic") == 1, "filtered").otherwise("extraction_failed").alias("status"))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)")
def state_anti_join(spark, sf):
    items = _t(spark, sf, "documents").select("doc_id", F.concat(F.lit("web:"), F.col("doc_id").cast("string")).alias("source_key"))
    return state.skip_processed(items, _state(spark, sf)).select("doc_id")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1 OR toxic = 1)")
def state_retry(spark, sf):
    items = _t(spark, sf, "documents").select("doc_id", F.concat(F.lit("web:"), F.col("doc_id").cast("string")).alias("source_key"))
    return state.skip_processed(items, _state(spark, sf), terminal=("success", "filtered")).select("doc_id")


@query("SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id FROM events GROUP BY user_id")
def state_upsert(spark, sf):
    return state.latest(_t(spark, sf, "events").select("user_id", "event_type", "event_id"), ["user_id"], "event_id")


@query("""WITH c AS (SELECT conv_id, turn AS pos, text AS title, CASE WHEN turn % 2 = 1 THEN 'd' || turn ELSE 'unknown' END AS date FROM conversations)
    SELECT conv_id, arg_max(title, length(title) * 1000000 - pos) AS title, arg_min(CASE WHEN date <> 'unknown' THEN date END, CASE WHEN date <> 'unknown' THEN pos END) AS date, min(pos) AS pos FROM c GROUP BY conv_id""")
def candidate_upsert(spark, sf):
    date = F.when(F.col("turn") % 2 == 1, F.concat(F.lit("d"), F.col("turn").cast("string"))).otherwise("unknown")
    return candidates.upsert(_t(spark, sf, "conversations").select("conv_id", F.col("turn").alias("pos"), F.col("text").alias("title"), date.alias("date")), ["conv_id"])


@query("SELECT CAST(count(*) AS BIGINT) AS n, CAST(count_if(o_orderkey % 3 = 0) AS BIGINT) AS dated, CAST(count_if(o_orderkey % 3 = 0) * 100 // count(*) AS BIGINT) AS percent FROM orders")
def dated_share(spark, sf):
    return candidates.dated_share(_t(spark, sf, "orders"), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderdate")))


@query(f"SELECT doc_id, 'listings:' || source || '#' || substr(sha256({_STRIP.format('text')} || '|' || lang), 1, 12) AS child_key FROM documents")
def content_hash(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", listings.child_key(F.col("source"), F.col("text"), F.col("lang")).alias("child_key"))


def _listing_pages(spark, sf):
    c = _t(spark, sf, "conversations")
    article = F.struct(F.col("turn"), F.substring("text", 1, 40).alias("title"), F.col("role").alias("date"), F.col("text").alias("content"), F.lit("").alias("url"))
    return c.groupBy("conv_id").agg(F.array_sort(F.collect_list(article)).alias("articles")).withColumn("page", F.concat(F.lit("https://p.example/"), F.col("conv_id").cast("string")))


_CHILDREN = f"""c AS (SELECT 'https://p.example/' || conv_id AS page_url, row_number() OVER (PARTITION BY conv_id ORDER BY turn, substr(text, 1, 40), role, text) - 1 AS pos, substr(text, 1, 40) AS title, role AS date, text AS content FROM conversations)"""


@query(f"""WITH {_CHILDREN} SELECT page_url, CAST(pos AS INTEGER) AS pos, title, 'listings:' || page_url || '#' || substr(sha256({_STRIP.format('title')} || '|' || date), 1, 12) AS source_key, page_url AS url FROM c""")
def listing_explode(spark, sf):
    return listings.explode_children(_listing_pages(spark, sf), "page", "articles").select("page_url", "pos", "title", "source_key", "url")


@query(f"""WITH {_CHILDREN} SELECT page_url, count(*) AS n_children, arg_min('short: ' || date, pos) AS reason FROM c GROUP BY page_url HAVING count_if(length(content) > 400) = 0""")
def listing_parent_rollup(spark, sf):
    kids = listings.explode_children(_listing_pages(spark, sf), "page", "articles")
    return listings.parent_rollup(kids, "page_url", F.length("content") > 400, F.concat(F.lit("short: "), F.col("date")))


@query(f"""SELECT doc_id FROM documents WHERE length({_STRIP.format('substr(text, 1, 60)')}) BETWEEN 5 AND 500 AND lang <> '' AND (source = '' OR length(source || lang) >= 10 OR length(text) >= 10)""")
def listing_validate(spark, sf):
    return _t(spark, sf, "documents").where(listings.is_valid(F.substring("text", 1, 60), F.col("lang"), F.col("text"))).select("doc_id")


def _answers(spark, sf):
    """Model answers built from event numbers, some out of range or of odd types."""
    n = F.get_json_object("props", "$.k").cast("int")
    odd = F.col("event_id") % 6
    d3 = F.when(odd == 0, F.concat(F.lit('"'), (n % 4).cast("string"), F.lit('"'))).when(odd == 1, F.concat((n % 3).cast("string"), F.lit(".7"))).when(odd == 2, F.lit("true")).when(odd == 3, F.lit("null")).otherwise((n % 4).cast("string"))
    body = F.concat(F.lit('{"d1_enforcement": '), (n % 5).cast("string"), F.lit(', "d2_organ": {"score": '), (n % 4).cast("string"), F.lit('}, "d3_compliance": '), d3, F.lit(', "d4_regulatory": '), (n % 3).cast("string"), F.lit(', "practice_area": "'), F.when(odd < 3, "Sonstiges").otherwise("Other"), F.lit('"}'))
    raw = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).when(F.col("event_id") % 3 == 1, F.concat(F.lit("Here: "), body, F.lit(" ok"))).otherwise(body)
    return _t(spark, sf, "events").select("event_id", raw.alias("raw"))


_N = "WITH e AS (SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS n, event_id % 6 AS odd FROM events)"


@query(f"""{_N}, d AS (SELECT event_id, CASE WHEN n % 5 <= 3 THEN n % 5 END AS d1, n % 4 AS d2, CASE WHEN odd IN (0, 1, 3) THEN NULL WHEN odd = 2 THEN 1 ELSE n % 4 END AS d3, n % 3 AS d4, CASE WHEN odd < 3 THEN 'Sonstiges' END AS area FROM e)
    SELECT event_id, d1, d2, d3, d4, area FROM d""")
def score_dimensions_strict(spark, sf):
    v = scoring.answer(F.col("raw"))
    dims = [scoring.strict_dimension(F.col("v"), d).alias(f"d{i}") for i, d in enumerate(scoring.DIMENSIONS[:4], 1)]
    return _answers(spark, sf).select("event_id", v.alias("v")).select("event_id", *dims, scoring.strict_area(F.col("v")).alias("area"))


@query(f"""{_N}, d AS (SELECT event_id, n % 5 AS d1, 0 AS d2, CASE odd WHEN 0 THEN n % 4 WHEN 1 THEN n % 3 WHEN 2 THEN 1 WHEN 3 THEN 0 ELSE n % 4 END AS d3, n % 3 AS d4, CASE WHEN odd < 3 THEN 'Sonstiges' ELSE 'Other' END AS area FROM e)
    SELECT event_id, d1, d2, d3, d4, d1 + d2 + d3 + d4 AS total, area FROM d""")
def score_dimensions_lenient(spark, sf):
    v = scoring.answer(F.col("raw"))
    rows = _answers(spark, sf).select("event_id", v.alias("v")).select("event_id", *[scoring.lenient_dimension(F.col("v"), d).alias(f"d{i}") for i, d in enumerate(scoring.DIMENSIONS[:4], 1)], scoring.lenient_area(F.col("v")).alias("area"))
    return rows.withColumn("total", scoring.total([F.col(f"d{i}") for i in range(1, 5)]))


@query("""WITH s AS (SELECT event_id, CAST(floor(value) AS INTEGER) % 4 AS d1, CAST(event_id % 4 AS INTEGER) AS d2, CAST(event_id % 3 AS INTEGER) * 4 AS d3 FROM events),
    t AS (SELECT event_id, d1 + d2 + d3 + CASE WHEN d1 >= 2 AND d2 >= 2 THEN 2 ELSE 0 END AS total FROM s),
    l AS (SELECT *, CASE WHEN total >= 10 THEN 'Hoch' WHEN total >= 5 THEN 'Mittel' ELSE 'Niedrig' END AS level, CASE WHEN total >= 7 THEN 'Hoch' WHEN total >= 5 THEN 'Mittel' ELSE 'Niedrig' END AS own FROM t)
    SELECT event_id, total, level, own, CASE WHEN level <> 'Hoch' THEN 'filtered: ' || level END AS reason FROM l""")
def classify_level(spark, sf):
    dims = [F.floor("value").cast("int") % 4, (F.col("event_id") % 4).cast("int"), (F.col("event_id") % 3).cast("int") * 4]
    rows = _t(spark, sf, "events").select("event_id", scoring.total(dims, bonus=True).alias("total"))
    rows = rows.withColumn("level", scoring.level(F.col("total"))).withColumn("own", scoring.level(F.col("total"), {"Hoch": 7, "mittel": 0}))
    return rows.withColumn("reason", scoring.gate_reason(F.col("level")))


@query("SELECT event_id FROM events WHERE CAST(floor(value) AS INTEGER) % 16 >= 10")
def level_gate(spark, sf):
    found = scoring.level(F.floor("value").cast("int") % 16)
    return _t(spark, sf, "events").where(scoring.gate_reason(found).isNull()).select("event_id")


@query("SELECT event_id, CASE WHEN event_id % 5 = 0 OR value > 30 THEN 'PASS' ELSE 'WARN' END AS status FROM events")
def quality_status(spark, sf):
    score = F.when(F.col("event_id") % 5 != 0, F.col("value") / 100)
    return _t(spark, sf, "events").select("event_id", scoring.quality_status(score).alias("status"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 2 THEN NULL ELSE event_type END AS said FROM events")
def llm_envelope_text(spark, sf):
    e = F.col("event_type")
    body = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('{"output": [{"type": "reasoning", "content": []}, {"type": "message", "content": [{"type": "x", "text": "no"}, {"type": "output_text", "text": "'), e, F.lit('"}]}]}')))
    body = body.when(F.col("event_id") % 3 == 1, F.concat(F.lit('{"choices": [{"message": {"content": "'), e, F.lit('"}}]}'))).otherwise("{}")
    return _t(spark, sf, "events").select("event_id", scoring.envelope_text(body).alias("said"))


@query("SELECT event_id, props AS bare FROM events")
def code_fence_strip(spark, sf):
    fenced = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("  ```json\n"), F.col("props"), F.lit("\n```\n"))).otherwise(F.col("props"))
    return _t(spark, sf, "events").select("event_id", text.strip_code_fence(fenced).alias("bare"))


_WORDS = f"list_filter(regexp_split_to_array({_STRIP.format('text')}, '\\s+'), lambda w: w <> '')"


@query(f"SELECT doc_id, array_to_string(list_slice({_WORDS}, 1, 15), ' ') || CASE WHEN len({_WORDS}) > 15 THEN '…' ELSE '' END AS title FROM documents")
def title_normalize(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", text.normalize_title(F.col("text")).alias("title"))


@query(f"""SELECT doc_id, regexp_matches(text, '(?i){'|'.join(text.META_RESPONSE).replace("'", "''")}') AS meta, length({_STRIP.format('text')}) <= 500 AS short, substr(text, 1, 300) AS abstract FROM documents""")
def text_gates(spark, sf):
    c = F.col("text")
    return _t(spark, sf, "documents").select("doc_id", text.is_meta_response(c).alias("meta"), text.is_short(c).alias("short"), text.truncate(c, "abstract").alias("abstract"))


@query("""SELECT doc_id, md5(replace(replace(replace(replace(replace(text, '\\', '\\\\'), '"', '\\"'), chr(10), '\\n'), chr(13), '\\r'), chr(9), '\\t')) AS safe FROM documents""")
def json_escape(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", F.md5(text.json_escape(F.col("text")).cast("binary")).alias("safe"))


@query("SELECT doc_id, CASE lang WHEN 'de' THEN 'German' WHEN 'en' THEN 'English' WHEN 'es' THEN 'Spanish' WHEN 'fr' THEN 'French' ELSE lang END AS language FROM documents")
def language_name(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", text.language_name(F.col("lang")).alias("language"))


@query("""SELECT d.doc_id, CASE WHEN d.doc_id % 3 = 0 THEN 'extracted' ELSE 'published' END AS date, lang AS category, CASE WHEN l.quality = 1 THEN ['Sonstiges'] ELSE [] END AS practice_areas FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def webhook_rows(spark, sf):
    d = _t(spark, sf, "documents").join(_t(spark, sf, "labels"), "doc_id", "left")
    published = F.when(F.col("doc_id") % 3 == 0, "unknown").otherwise("published")
    row = outcome.webhook_row(F.col("text"), published, F.lit("extracted"), F.array("lang"), F.lit(""), F.array().cast("array<string>"), F.lit("u"), F.col("lang"), F.lit("web"), F.when(F.col("quality") == 1, "Sonstiges"))
    return d.select("doc_id", row.alias("r")).select("doc_id", "r.date", "r.category", "r.practice_areas")


@query("""SELECT doc_id, '{"id":' || doc_id || CASE WHEN doc_id % 2 = 0 THEN ',"lang":"' || lang || '"' ELSE '' END || '}' AS json FROM documents""")
def output_items(spark, sf):
    item = F.struct(F.col("doc_id").alias("id"), F.when(F.col("doc_id") % 2 == 0, F.col("lang")).alias("lang"), F.col("text").alias("content"))
    return _t(spark, sf, "documents").select("doc_id", outcome.output_json(item).alias("json"))


def _rejects(spark, sf):
    k = F.col("event_id") % 6
    reason = F.when(k == 0, "No keywords matched in x").when(k == 1, "Item too OLD by 3 days").when(k == 2, "filtered_out").when(k == 3, "filtered: Niedrig").when(k == 4, "no_categories_matched").otherwise("timeout")
    return _t(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 2 == 0, "extraction").otherwise("enrichment").alias("stage"), reason.alias("reason"))


_REJECTS = """WITH r AS (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'extraction' ELSE 'enrichment' END AS stage, event_id % 6 AS k FROM events),
    c AS (SELECT event_id, stage, CASE WHEN (stage = 'extraction' AND k IN (0, 2)) OR (stage = 'enrichment' AND k = 3) THEN 'filtered' ELSE 'failed' END AS kind FROM r)"""


@query(f"{_REJECTS} SELECT event_id, stage, kind FROM c")
def reject_classify(spark, sf):
    return _rejects(spark, sf).select("event_id", "stage", outcome.reject_kind(F.col("stage"), F.col("reason")).alias("kind"))


@query(f"{_REJECTS} SELECT stage, kind, count(*) AS n FROM c GROUP BY stage, kind")
def run_metrics(spark, sf):
    return outcome.run_metrics(_rejects(spark, sf).withColumn("kind", outcome.reject_kind(F.col("stage"), F.col("reason"))))


@query("""WITH r AS (SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC, o_orderkey) AS rank FROM orders WHERE o_orderdate >= TIMESTAMP '1998-07-01')
    SELECT o_orderkey, o_orderpriority FROM r WHERE rank <= 100""")
def per_folder_limit(spark, sf):
    """The newest 100 messages of each folder since the last run."""
    from datetime import datetime

    from ..sources.email import new_messages

    mail = _t(spark, sf, "orders").select(F.col("o_orderpriority").alias("folder"), F.col("o_orderkey").alias("email_id"), F.col("o_orderdate").cast("timestamp").alias("received_at"))
    return new_messages(mail, datetime(1998, 7, 1)).select(F.col("email_id").alias("o_orderkey"), F.col("folder").alias("o_orderpriority"))


@query("""WITH c(category, n_keywords) AS (VALUES ('legal', 3), ('flow', 2)), i AS (SELECT doc_id, unnest(CASE lang WHEN 'en' THEN ['none', 'flow'] WHEN 'de' THEN ['legal', 'flow'] ELSE [] END) AS category, CASE lang WHEN 'en' THEN ['none', 'flow'] ELSE ['legal', 'flow'] END AS all_of FROM documents)
    SELECT i.doc_id, i.category, CAST(list_position(i.all_of, i.category) - 1 AS INTEGER) AS category_pos, c.n_keywords FROM i JOIN c ON c.category = i.category""")
def category_rows(spark, sf):
    """A row for each document and known category of it."""
    names = F.when(F.col("lang") == "en", F.array(F.lit("none"), F.lit("flow"))).when(F.col("lang") == "de", F.array(F.lit("legal"), F.lit("flow"))).otherwise(F.array().cast("array<string>"))
    dim = spark.createDataFrame([(c, len(k)) for c, k in CATEGORIES.items()], "category string, n_keywords int")
    rows = lookup.category_rows(_t(spark, sf, "documents").withColumn("categories", names), dim, "doc_id")
    return rows.select("doc_id", "category", "category_pos", "n_keywords")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 5 = 0 OR o_orderkey % 7 = 0 OR o_orderdate >= TIMESTAMP '2000-06-01' - INTERVAL 90 DAY")
def freshness_after_fetch(spark, sf):
    k = F.col("o_orderkey")
    found = F.when(k % 7 != 0, F.col("o_orderdate").cast("timestamp"))
    return freshness.after_fetch(_t(spark, sf, "orders"), k % 3 == 0, k % 5 == 0, found, F.lit(_AS_OF).cast("timestamp"), 90).select("o_orderkey")


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 100")
def topk_latest(spark, sf):
    return _t(spark, sf, "orders").orderBy(F.col("o_orderdate").desc(), "o_orderkey").limit(100).select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


_ANCHORS = """WITH a AS (SELECT page_id, url AS page, regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9_+.-]*://[^/?#]*)', 1) AS root, unnest(regexp_extract_all(html, '<a href="[^"]*">[^<]*</a>')) AS a FROM pages),
    l AS (SELECT page_id, page, regexp_extract(a, '<a href="([^"]*)"', 1) AS href, root, regexp_replace(regexp_extract(a, '>([^<]*)</a>', 1), '^\\s+|\\s+$', '', 'g') AS text FROM a),
    u AS (SELECT page_id, page, root || href AS url, text FROM l WHERE href LIKE '/%')"""


def _link_sql(variant: str) -> str:
    low = "lower(url)"
    keep = f"NOT ({_PAGED}) AND length(text) >= {urls.MIN_TEXT[variant]} AND NOT regexp_matches({low}, '\\.(jpg|jpeg|png|gif|pdf|mp3|mp4|webp)$') AND NOT {_any_sql(low, urls.SKIP_PATHS[variant])}"
    if variant == "email":
        keep += " AND NOT (url LIKE '%/' AND length(url) - length(replace(url, '/', '')) <= 3) AND NOT contains(url, '?t=a-s') AND length(url) >= 15"
    else:
        keep += f" AND url <> page AND NOT {_any_sql('lower(text)', urls.NAV_WORDS[variant])}"
    return f"{_ANCHORS} SELECT page_id, url, text FROM u WHERE {keep}"


def _anchors(spark, sf):
    p = _t(spark, sf, "pages")
    a = p.select("page_id", F.col("url").alias("page"), F.explode(F.regexp_extract_all("html", F.lit('<a href="[^"]*">[^<]*</a>'), F.lit(0))).alias("a"))
    a = a.select("page_id", "page", F.regexp_extract("a", '<a href="([^"]*)"', 1).alias("href"), text.strip(F.regexp_extract("a", ">([^<]*)</a>", 1)).alias("text"))
    return a.select("page_id", "page", urls.resolve(F.col("page"), F.col("href")).alias("url"), "text")


def _links(variant):
    def links(spark, sf):
        return _anchors(spark, sf).where(urls.link_ok(F.col("url"), F.col("text"), F.col("page"), variant)).select("page_id", "url", "text")

    links.__name__ = f"link_extract_{variant}"
    return links


for _v in ("static", "browser", "email"):
    query(_link_sql(_v))(_links(_v))


@query("""WITH m AS (SELECT doc_id, unnest(regexp_extract_all('[' || source || '](https://m.example/' || lang || '/a-' || doc_id || ') [x](https://m.example/tag/)', '\\[[^\\]]*\\]\\([^)]*\\)')) AS link FROM documents)
    SELECT doc_id, regexp_extract(link, '\\(([^)]*)\\)', 1) AS url FROM m WHERE length(regexp_extract(link, '\\[([^\\]]*)\\]', 1)) >= 4""")
def markdown_links(spark, sf):
    from ..sources.markdown import links

    doc = F.concat(F.lit("["), F.col("source"), F.lit("](https://m.example/"), F.col("lang"), F.lit("/a-"), F.col("doc_id").cast("string"), F.lit(") [x](https://m.example/tag/)"))
    return _t(spark, sf, "documents").select("doc_id", F.explode(links(doc)).alias("l")).select("doc_id", "l.text", "l.url").where(F.length("text") >= 4).drop("text")


@query("""SELECT doc_id, 'web:' || doc_id AS source_key, 'web' AS origin FROM documents WHERE lang IN ('en', 'de') UNION ALL SELECT doc_id, 'web:' || doc_id, 'email' FROM documents WHERE lang IN ('de', 'fr')""")
def union_candidates(spark, sf):
    d = _t(spark, sf, "documents").select("doc_id", "lang", F.concat(F.lit("web:"), F.col("doc_id").cast("string")).alias("source_key"))
    pick = lambda *langs: d.where(F.col("lang").isin(*langs)).drop("lang")
    return pick("en", "de").withColumn("origin", F.lit("web")).unionByName(pick("de", "fr").withColumn("origin", F.lit("email")), allowMissingColumns=True)


@query("SELECT doc_id, CASE lang WHEN 'en' THEN 's-flow' WHEN 'de' THEN 's-legal' END AS schema FROM documents")
def first_schema(spark, sf):
    cats = F.array(F.lit("none"), F.when(F.col("lang") == "en", "flow").when(F.col("lang") == "de", "legal").otherwise("empty"), F.lit("empty"))
    return _t(spark, sf, "documents").select("doc_id", lookup.first_schema(cats, {"legal": "s-legal", "flow": "s-flow"}).alias("schema"))


# Queries through page trees, letter statistics and streams.


@query()
def page_links(spark, sf):
    """Links with resolved addresses and dates, through one parse of each page."""
    from datetime import UTC, datetime

    from ..functions.page import with_page

    p = with_page(_t(spark, sf, "pages"), datetime(2024, 1, 31, tzinfo=UTC), parts=("links",))
    return p.select("page_id", F.explode("page.links").alias("l")).select("page_id", "l.pos", "l.text", "l.url", "l.date")


@query()
def page_texts(spark, sf):
    """Clean text, reading view and article text of each page."""
    from datetime import UTC, datetime

    from ..functions.page import with_page

    p = with_page(_t(spark, sf, "pages"), datetime(2024, 1, 31, tzinfo=UTC), parts=("texts", "listing"))
    return p.select("page_id", F.md5(F.col("page.clean").cast("binary")).alias("clean_md5"), F.length("page.reading").alias("n_reading"), F.length("page.article").alias("n_article"), "page.is_listing", "page.confidence")


@query()
def language_detect(spark, sf):
    from ..functions.language import language

    return _t(spark, sf, "documents").select("doc_id", "lang", language(F.col("text")).alias("found"))


_GRAMS = """(SELECT {key}, n, unnest(list_concat(
        list_transform(range(1, length(word) + 1), lambda i: substring(word, i, 1)),
        list_transform(range(1, length(word) + 1), lambda i: substring(' ' || word || ' ', i, 3)))) AS gram FROM {words})"""


@query(f"""WITH w AS (SELECT doc_id, lang, length(text) AS size, unnest(regexp_extract_all(lower(text), '\\p{{L}}{{1,32}}')) AS word FROM documents),
    lw AS (SELECT lang, word, count(*) AS n FROM w WHERE doc_id % 5 <> 0 AND lang IS NOT NULL GROUP BY 1, 2),
    c AS (SELECT lang, gram, CAST(sum(n) AS BIGINT) AS n FROM {_GRAMS.format(key='lang', words='lw')} GROUP BY 1, 2),
    top AS (SELECT DISTINCT gram FROM (SELECT gram, row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) AS k FROM c) WHERE k <= 1000),
    total AS (SELECT lang, sum(n) AS total FROM c JOIN top USING (gram) GROUP BY 1),
    m AS (SELECT top.gram, total.lang, CAST(floor(1000 * ln((coalesce(c.n, 0) + 0.5) / (total.total + 0.5 * (SELECT count(*) FROM top)))) AS BIGINT) AS weight
        FROM top CROSS JOIN total LEFT JOIN c ON c.gram = top.gram AND c.lang = total.lang),
    dw AS (SELECT doc_id, word, count(*) AS n FROM w GROUP BY 1, 2),
    s AS (SELECT g.doc_id, m.lang, sum(g.n * m.weight) AS score FROM {_GRAMS.format(key='doc_id', words='dw')} g JOIN m USING (gram) GROUP BY 1, 2),
    best AS (SELECT doc_id, lang FROM s QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, lang) = 1)
    SELECT d.doc_id, CASE WHEN d.size >= 50 THEN coalesce(best.lang, 'en') ELSE 'en' END AS found
    FROM (SELECT doc_id, max(coalesce(length(text), 0)) AS size FROM documents GROUP BY 1) d LEFT JOIN best USING (doc_id)""")
def language_learned(spark, sf):
    """Languages by a model that is learned from four of five labelled texts."""
    docs = _t(spark, sf, "documents")
    return languages.detect(docs, languages.learn(docs.where("doc_id % 5 <> 0")))


@query()
def listing_near_copies(spark, sf):
    """Greedy near copies among the articles of each page, by letters alike."""
    c = _t(spark, sf, "conversations").select("conv_id", F.col("turn").alias("pos"), "role", "text")
    mark = F.concat(F.coalesce("role", F.lit("None")), F.lit("|"), F.left(F.coalesce("text", F.lit("")), F.lit(30)))
    return near_copies.first_unlike(c, "conv_id", "pos", mark, f"{_shared(spark)}/near-copies-{uuid.uuid4().hex}").select("conv_id", "pos")


@query("""WITH d AS (SELECT DISTINCT event_id, ts, event_type FROM events) SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM d GROUP BY 1, 2""")
def stream_dedup_events(spark, sf):
    """Distinct events by day, read as a stream."""
    from ..streaming.runner import events_by_day

    shared = _shared(spark)
    at = f"{shared}/events-{spark.sparkContext.applicationId}-{abs(hash(sf))}-{spark.sql('SELECT uuid()').first()[0]}"
    return events_by_day(spark, f"{sf}/events.parquet", f"{at}/checkpoint", f"{at}/out").withColumn("day", F.col("day").cast("string"))


@query()
def pipeline_end_to_end(spark, sf):
    """The whole feed pipeline over the pages, with recorded answers; its
    rejects and items, counted."""
    from datetime import UTC, datetime

    from ..config import Category, Config, Preparation, Source
    from ..operators.state import StateStore
    from ..pipeline import Inputs, run
    from ..provider import Replay

    shared = _shared(spark)
    store = StateStore(spark, f"{shared}/state-{spark.sql('SELECT uuid()').first()[0]}")
    as_of = datetime(2024, 1, 31, tzinfo=UTC)
    pages = _t(spark, sf, "pages")
    hub = pages.where("page_id = 0").select("url", "html").first()
    cfg = Config("1", (Category("flow", ("tion", "ment")), Category("legal", ("license", "heit"))), (Source(hub["url"], ("flow", "legal"), discovery_method="rss"),), preparation=Preparation(min_prepared_chars=200))
    entry = F.concat(F.lit("<item><title>Article number "), F.col("page_id").cast("string"), F.lit("</title><link>"), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit("</link><description>tion</description><pubDate>Tue, 30 Jan 2024 10:00:00 +0000</pubDate></item>"))
    body = pages.select(entry.alias("e")).agg(F.concat(F.lit("<rss><channel>"), F.array_join(F.array_sort(F.collect_list("e")), ""), F.lit("</channel></rss>")).cast("binary").alias("xml"))
    feeds = body.select(F.lit(hub["url"]).alias("source_url"), F.lit(0).alias("feed_ord"), F.lit(200).alias("http_status"), "xml")
    fetched = pages.select("url", F.when(F.col("page_id") % 10 == 3, 401).otherwise(200).alias("http_status"), F.col("html").alias("static_html"), F.lit(None).cast("string").alias("rendered_html"), F.lit(None).cast("string").alias("crawled_html"), F.lit("static").alias("fetch_method"))
    dims = ", ".join(f'"{d}": {{0}}' for d in scoring.DIMENSIONS)
    k = (F.col("page_id") % 4).cast("string")
    answer = F.concat(F.lit('{"title": "T", "summary": "S", "relevance_dimensions": {'), *[x for i, d in enumerate(dims.split("{0}")[:-1]) for x in (F.lit(d), k)], F.lit("}}"))
    answers = pages.select(F.concat(F.lit("web:"), F.col("url")).alias("source_key"), answer.alias("answer"))
    return run(spark, cfg, Inputs(feeds=feeds, fetched=fetched), as_of, store, Replay(answers)).metrics


@query("SELECT event_type, count(*) AS n, avg(CASE WHEN value > 20 THEN 1 ELSE 0 END) AS share FROM events GROUP BY event_type")
def dated_by_source(spark, sf):
    return candidates.dated_by_source(_t(spark, sf, "events"), "event_type", F.when(F.col("value") > 20, F.col("ts")))


@query("SELECT event_id, CASE WHEN event_id % 4 = 3 THEN NULL ELSE CAST(json_extract(props, '$.k') AS INTEGER) END AS k FROM events")
def answer_parse_lenient(spark, sf):
    """JSON, fenced JSON, Python literals with words around them, and none."""
    from ..functions.answers import any_answer

    k = F.get_json_object("props", "$.k")
    raw = F.when(F.col("event_id") % 4 == 0, F.col("props")).when(F.col("event_id") % 4 == 1, F.concat(F.lit("```\n"), F.col("props"), F.lit("\n```")))
    raw = raw.when(F.col("event_id") % 4 == 2, F.concat(F.lit("{not this} but {'k': "), k, F.lit(", 'x': None} there"))).otherwise(F.concat(F.lit("["), k, F.lit("]")))
    return _t(spark, sf, "events").select("event_id", F.try_variant_get(any_answer(raw), "$.k", "int").alias("k"))


@query("SELECT user_id, event_type || ' title' AS title, 'https://h.example/' || event_id AS url FROM events")
def hosted_articles(spark, sf):
    from ..sources.hosted import hosted_articles as read

    body = F.concat(F.lit('{"articles": [{"title": "'), F.col("event_type"), F.lit(' title", "url": "https://h.example/'), F.col("event_id").cast("string"), F.lit('", "date": "2026-01-02"}]}'))
    return read(_t(spark, sf, "events").select(F.col("user_id").alias("source_url"), body.alias("body"))).select(F.col("source_url").alias("user_id"), "title", "url")


@query("SELECT doc_id, length(text) > 3 AS filled FROM documents WHERE trim(text) <> '' AND trim(lang) <> ''")
def not_empty_gate(spark, sf):
    d = _t(spark, sf, "documents")
    return d.where(outcome.not_empty_gate(F.col("text"), F.col("lang"))).select("doc_id", (F.length("text") > 3).alias("filled"))


@query("SELECT doc_id, CAST(1 AS BIGINT) AS n_sent, length('{\"id\":' || doc_id || ',\"lang\":\"' || lang || '\"}') AS n_body FROM documents")
def outbox_delivery(spark, sf):
    """Two runs commit the documents, the second one half of them again; every
    delivery is sent once, in requests of 50, and has its receipt."""
    from ..outbox import Outbox

    d = _t(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("key"), F.to_json(F.struct(F.col("doc_id").alias("id"), "lang")).alias("body"), "doc_id")
    box = Outbox(f"{_shared(spark)}/outbox-{spark.sql('SELECT uuid()').first()[0]}", 8)
    box.add(d.where("doc_id % 4 <> 0"), "first")
    box.deliver(spark, lambda body, identifier: 200, per_request=50)
    box.add(d.where("doc_id % 2 = 0"), "second")
    box.deliver(spark, lambda body, identifier: 200, per_request=50)
    sent = box.receipts.read(spark).join(box.committed(spark), "key")
    return sent.groupBy(F.col("key").cast("long").alias("doc_id")).agg(F.count("*").alias("n_sent"), F.max(F.length("body")).cast("long").alias("n_body"))


@query("SELECT event_id, upper(event_type) || ' ' || CAST(json_extract(props, '$.k') AS INTEGER) AS answer FROM events")
def durable_answers(spark, sf):
    """Prompts that many events share, each asked once and kept; the first run
    gets no answer to some, the second asks for these only."""
    import json

    from ..ledger import Ledger
    from ..provider import Durable, Http

    k = F.get_json_object("props", "$.k")
    prompts = _t(spark, sf, "events").select("event_id", F.concat("event_type", F.lit(" "), k).alias("prompt"))
    ledger = Ledger(f"{_shared(spark)}/answers-{spark.sql('SELECT uuid()').first()[0]}", 8)

    def endpoint(busy):
        def send(url, key, payload):
            asked = payload["messages"][-1]["content"]
            if busy and asked.endswith("7"):
                raise OSError("busy")
            return json.dumps({"choices": [{"message": {"content": asked.upper()}}]})

        return send

    for busy in (True, False):
        answered = Durable(Http("openai", "u", "k", "m", send=endpoint(busy), delays=(0,)), ledger).answer(prompts)
    return answered.select("event_id", "answer")


_HEADS = """s AS (SELECT DISTINCT ON (source_url) source_url, ord FROM (SELECT substr(url, 1, 12 + page_id % 40) AS source_url, page_id AS ord FROM pages UNION ALL SELECT url || '/', 1000000 + page_id FROM pages WHERE page_id % 17 = 0) ORDER BY source_url, ord)"""
_EXACT = """x AS (SELECT regexp_replace(source_url, '/+$', '') AS bare, max_by(source_url, ord) AS source_url FROM s GROUP BY 1)"""


def _heads(spark, sf):
    """Beginnings of pages' addresses and some whole ones as sources, the first of equal ones."""
    p = _t(spark, sf, "pages")
    every = p.select(F.col("url").substr(F.lit(1), (12 + F.col("page_id") % 40).cast("int")).alias("source_url"), F.col("page_id").alias("source_ord"))
    every = every.unionByName(p.where("page_id % 17 = 0").select(F.concat("url", F.lit("/")).alias("source_url"), (F.lit(1000000) + F.col("page_id")).alias("source_ord")))
    return every.groupBy("source_url").agg(F.min("source_ord").alias("source_ord"))


@query(f"""WITH {_HEADS}, {_EXACT}, m AS (SELECT p.page_id, s.source_url, row_number() OVER (PARTITION BY p.page_id ORDER BY s.ord, s.source_url) AS r FROM pages p JOIN s ON starts_with(p.url, s.source_url))
    SELECT p.page_id, coalesce(x.source_url, m.source_url) AS source_url FROM pages p LEFT JOIN x ON x.bare = regexp_replace(p.url, '/+$', '') LEFT JOIN m ON m.page_id = p.page_id AND m.r = 1""")
def source_lookup_many(spark, sf):
    """As many sources as pages, met by equality of beginnings."""
    return lookup.source_by_url(_t(spark, sf, "pages"), _heads(spark, sf), F.col("url")).select("page_id", "source_url")


_PARTS = """s AS (SELECT source_url, min(ord) AS ord FROM (SELECT substr(url, 9, 6 + page_id % 30) AS source_url, page_id AS ord FROM pages) GROUP BY source_url)"""


@query(f"""WITH {_PARTS}, {_EXACT}, m AS (SELECT p.page_id, s.source_url, row_number() OVER (PARTITION BY p.page_id ORDER BY s.ord, s.source_url) AS r FROM pages p JOIN s ON contains(p.url, s.source_url))
    SELECT p.page_id, coalesce(x.source_url, m.source_url) AS source_url FROM pages p LEFT JOIN x ON x.bare = regexp_replace(p.url, '/+$', '') LEFT JOIN m ON m.page_id = p.page_id AND m.r = 1""")
def source_lookup_contains(spark, sf):
    """Sources without a scheme, found anywhere in the address."""
    dim = _t(spark, sf, "pages").select(F.col("url").substr(F.lit(9), (6 + F.col("page_id") % 30).cast("int")).alias("source_url"), F.col("page_id").alias("source_ord"))
    dim = dim.groupBy("source_url").agg(F.min("source_ord").alias("source_ord"))
    return lookup.source_by_url(_t(spark, sf, "pages"), dim, F.col("url"), contains=True).select("page_id", "source_url")


@query("""WITH k AS (SELECT DISTINCT unnest(regexp_split_to_array(lower(text), '[^a-zà-ÿß]+')) AS keyword FROM benchmark), w AS (SELECT keyword FROM k WHERE length(keyword) BETWEEN 2 AND 9)
    SELECT w.keyword, count(*) AS n FROM documents d JOIN w ON contains(lower(d.text), w.keyword) GROUP BY 1""")
def keyword_join_large(spark, sf):
    """Documents that hold each of some thousands of keywords, the words of another table."""
    from ..operators import substrings

    words = _t(spark, sf, "benchmark").select(F.explode(F.split(F.lower("text"), "[^a-zà-ÿß]+")).alias("word")).where(F.length("word").between(2, 9))
    low = _t(spark, sf, "documents").select("doc_id", F.lower("text").alias("text"))
    return substrings.containing(low, words, "doc_id").groupBy(F.col("word").alias("keyword")).agg(F.count("*").alias("n"))
