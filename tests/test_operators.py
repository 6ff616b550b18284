"""Operators on small tables, with the traps that each decision is about."""

from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from feedmill.operators import candidates, freshness, listings, lookup, outcome, state

AS_OF = datetime(2026, 1, 25, 12, tzinfo=UTC)


def at(text):
    return F.to_timestamp(F.lit(text))


def test_early_stops(spark):
    rows = [("s", 0, False), ("s", 1, True), ("s", 2, False), ("t", 0, False), ("t", 1, None)]
    d = spark.createDataFrame(rows, "s string, pos int, old boolean")
    got = lambda inc: sorted((r["s"], r["pos"]) for r in candidates.take_until_old(d, ["s"], "pos", F.col("old"), inc).collect())
    assert got(False) == [("s", 0), ("t", 0), ("t", 1)]
    assert got(True) == [("s", 0), ("s", 1), ("t", 0), ("t", 1)]


def test_filtered_rows_do_not_stop_a_scan(spark):
    d = spark.createDataFrame([("s", 0, True, True), ("s", 1, False, False)], "s string, pos int, old boolean, filtered boolean")
    assert candidates.take_until_old(d.where("not filtered"), ["s"], "pos", F.col("old"), False).count() == 1


def test_upsert_ties(spark):
    rows = [("u", 0, "abc", "unknown"), ("u", 1, "xyz", "2026-01-02"), ("u", 2, "longer", "2026-01-03"), ("v", 3, "", "unknown"), ("v", 4, None, None)]
    d = spark.createDataFrame(rows, "url string, pos int, title string, date string")
    got = {r["url"]: (r["title"], r["date"], r["pos"]) for r in candidates.upsert(d, ["url"]).collect()}
    assert got == {"u": ("longer", "2026-01-02", 0), "v": ("", None, 3)}
    assert candidates.upsert(d.where("pos < 2"), ["url"]).first()["title"] == "abc"  # the first of the longest


@pytest.mark.parametrize(("published", "fresh"), [("2026-01-22 12:00:00", True), ("2026-01-22 11:59:59", False), ("2026-01-25 00:00:00", True)])
def test_age_boundary(spark, published, fresh):
    now = F.lit("2026-01-25 12:00:00").cast("timestamp")
    d = spark.range(1).select(at(published).alias("p"))
    assert (freshness.discovery_filter(d, F.col("p"), now, 3).count() == 1) is fresh
    assert freshness.guardrail(d, F.col("p"), F.lit(None), now, 3).first()["verdict"] == ("fresh" if fresh else "stale")


def test_undated_items(spark):
    now = F.lit("2026-01-25 12:00:00").cast("timestamp")
    d = spark.range(1).select(F.lit(None).cast("timestamp").alias("p"))
    assert freshness.discovery_filter(d, F.col("p"), now, 3).count() == 1  # discovery keeps them
    assert freshness.guardrail(d, F.col("p"), F.lit(None), now, 3).first()["verdict"] == "undated"  # the guardrail doesn't


def test_configured_dates_that_are_too_old_do_not_drop(spark):
    now = F.lit("2026-01-25 12:00:00").cast("timestamp")
    d = spark.createDataFrame([(1, "2020-01-01", None), (2, "2020-01-01", "2026-01-24"), (3, None, "2020-01-01"), (4, None, None)], "i int, own string, general string").withColumn("p", F.lit(None).cast("timestamp"))
    got = {r["i"]: str(r["p"])[:10] for r in freshness.url_date_fallback(d, "p", F.col("own").cast("date"), F.col("general").cast("date"), now, 3).collect()}
    assert got == {1: "None", 2: "2026-01-24", 4: "None"}


def test_state_skips_only_terminal(spark):
    items = spark.createDataFrame([("a",), ("b",), ("c",)], "source_key string")
    done = spark.createDataFrame([("a", "success"), ("b", "filtered")], "source_key string, status string")
    assert sorted(r[0] for r in state.skip_processed(items, done).collect()) == ["b", "c"]
    assert [r[0] for r in state.skip_processed(items, done, terminal=("success", "filtered")).collect()] == ["c"]


def records(spark, *rows):
    return spark.createDataFrame([(*r, None, None, AS_OF.replace(tzinfo=None)) for r in rows], "source_key string, status string, reason string, article_date string, processed_at timestamp")


def test_state_store(spark, tmp_path):
    store = state.StateStore(spark, str(tmp_path / "state"))
    assert store.read().count() == 0
    assert (AS_OF - store.last_run(AS_OF)).total_seconds() == 86400
    store.upsert(records(spark, ("a", "extraction_failed"), ("b", "success")), AS_OF)
    store.upsert(records(spark, ("a", "success")), AS_OF)
    store.upsert(records(spark, ("a", "success")), AS_OF)  # again: nothing changes
    assert {r["source_key"]: r["status"] for r in store.read().collect()} == {"a": "success", "b": "success"}
    with pytest.raises(Exception, match="nonsense"):
        store.upsert(records(spark, ("c", "nonsense")), AS_OF)
    # A version that was written but never named, as after a crash, counts for nothing.
    records(spark, ("z", "success")).withColumn("seq", F.lit(9).cast("long")).write.parquet(str(tmp_path / "state" / "v9-lost"))
    assert store.read().count() == 2


def folder_bytes(path):
    return sum(f.stat().st_size for f in path.rglob("*.parquet"))


def test_state_writes_what_a_run_brings(spark, tmp_path):
    store = state.StateStore(spark, str(tmp_path))
    store.upsert(spark.range(40_000).selectExpr("concat('https://a/', sha2(cast(id AS string), 256)) AS source_key", "'success' AS status", "'' AS reason", "'' AS article_date", "timestamp'2026-01-01' AS processed_at"), AS_OF)
    before = folder_bytes(tmp_path)
    store.upsert(records(spark, ("x", "success")), AS_OF)
    assert folder_bytes(tmp_path) - before < before / 50
    few = spark.createDataFrame([("x",), ("x",), ("y",)], "k string")
    assert [(r["source_key"], r["status"]) for r in store.read(few, "k").collect()] == [("x", "success")]
    assert store.read().count() == 40_001


def test_state_bases(spark, tmp_path):
    store, want = state.StateStore(spark, str(tmp_path), folders=3), {}
    for i in range(12):
        rows = [(f"k{i % 4}", "success" if i % 3 else "filtered"), (f"n{i}", "success")]
        store.upsert(records(spark, *rows), AS_OF)
        want |= dict(rows)
        assert {r["source_key"]: r["status"] for r in store.read().collect()} == want
    runs = store.runs()
    assert any(r["base"] for r in runs) and len(runs) < 12
    # Folders of versions that are gone from the table are gone too.
    assert {p.name for p in tmp_path.iterdir() if p.name != "runs"} == {r["version"] for r in runs}
    # Bases one upon another, with no run between, lose nothing.
    store.compact()
    store.compact()
    assert {r["source_key"]: r["status"] for r in store.read().collect()} == want


def test_state_of_two_writers(spark, tmp_path):
    stores = [state.StateStore(spark, str(tmp_path), folders=100) for _ in range(2)]

    def write(w):
        for i in range(3):
            stores[w].upsert(records(spark, (f"{w}-{i}", "success"), ("both", "filtered")), AS_OF)

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(write, range(2)))
    got = {r["source_key"] for r in stores[0].read().collect()}
    assert got == {"both", *(f"{w}-{i}" for w in range(2) for i in range(3))}
    # A run that begins before a base is made and ends after it still counts.
    late = state.StateStore(spark, str(tmp_path))
    seen = late.runs()
    stores[0].compact()
    late.runs = lambda: seen
    late.upsert(records(spark, ("late", "success")), AS_OF)
    assert "late" in {r["source_key"] for r in stores[0].read().collect()}


def test_unreadable_state(spark, tmp_path):
    (tmp_path / "runs").mkdir()
    (tmp_path / "runs" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(state.StateError):
        state.StateStore(spark, str(tmp_path)).read()


def test_source_lookup(spark):
    dim = spark.createDataFrame([("https://a/news", 0), ("https://a/newsletter", 1), ("https://b/", 2)], "source_url string, source_ord int")
    items = spark.createDataFrame([("https://a/newsletter/1",), ("https://a/newsletter/",), ("https://b",), ("https://c",), ("https://z/?u=https://b/",)], "u string")
    got = {r["u"]: r["source_url"] for r in lookup.source_by_url(items, dim, F.col("u")).collect()}
    # No boundary is checked: /news also takes /newsletter/1; an exact match wins.
    assert got == {"https://a/newsletter/1": "https://a/news", "https://a/newsletter/": "https://a/newsletter", "https://b": "https://b/", "https://c": None, "https://z/?u=https://b/": None}
    assert {r["u"]: r["source_url"] for r in lookup.source_by_url(items, dim, F.col("u"), contains=True).collect()}["https://z/?u=https://b/"] == "https://b/"


def test_page_of(spark):
    d = spark.createDataFrame([("web:https://a",), ("listings:https://a#1f",), ("x",)], "k string")
    assert [r[0] for r in d.select(lookup.page_of(F.col("k"))).collect()] == ["https://a", "https://a", None]


def test_first_schema(spark):
    d = spark.createDataFrame([(["x", "b", "a"],), ([],), (None,)], "c array<string>")
    assert [r[0] for r in d.select(lookup.first_schema(F.col("c"), {"a": "1", "b": "2"})).collect()] == ["2", None, None]


def test_listing_children_and_rollup(spark):
    pages = spark.createDataFrame([("https://p", [(" T ", "d", "c", None), ("U", "d", "", "https://u")])], "page string, articles array<struct<title string, date string, content string, url string>>")
    rows = listings.explode_children(pages, "page", "articles").orderBy("pos").collect()
    assert [r["url"] for r in rows] == ["https://p", "https://u"]
    import hashlib

    assert rows[0]["source_key"] == "listings:https://p#" + hashlib.sha256(b"T|d").hexdigest()[:12]
    kids = spark.createDataFrame([("p", 0, False, "r0"), ("p", 1, False, "r1"), ("q", 0, True, None), ("q", 1, False, "x")], "page_url string, pos int, ok boolean, r string")
    got = listings.parent_rollup(kids, "page_url", F.col("ok"), F.col("r")).collect()
    assert [(r["page_url"], r["n_children"], r["reason"]) for r in got] == [("p", 2, "r0")]


def test_reject_kinds(spark):
    rows = [("extraction", "No keywords matched"), ("extraction", "Too Old"), ("extraction", "filtered_out"), ("extraction", "timeout"), ("enrichment", "filtered: Niedrig"), ("enrichment", "no_categories_matched"), ("extraction", None)]
    d = spark.createDataFrame(rows, "s string, r string").select(outcome.reject_kind(F.col("s"), F.col("r")))
    assert [r[0] for r in d.collect()] == ["filtered", "filtered", "filtered", "failed", "filtered", "failed", "failed"]


def test_anti_join_is_pushed_before_wide_columns(spark, tmp_path):
    spark.range(100).select(F.concat(F.lit("web:"), F.col("id").cast("string")).alias("source_key"), F.lit("success").alias("status"), F.lit("x").alias("wide")).write.parquet(str(tmp_path / "s"))
    done = spark.read.parquet(str(tmp_path / "s"))
    items = spark.range(10).select(F.concat(F.lit("web:"), F.col("id").cast("string")).alias("source_key"))
    plan = state.skip_processed(items, done)._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "PushedFilters: [In(status, [success])" in plan.replace("IsNotNull(status), EqualTo(status,success)", "In(status, [success])") or "EqualTo(status,success)" in plan
    assert "wide" not in plan
