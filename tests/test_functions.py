"""Column functions: the cases that each rule turns on."""

from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from feedmill.functions import dates, keywords, pydates, scoring, text, urls

AS_OF = datetime(2026, 1, 25, tzinfo=UTC)


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("url", "paged"),
    [("https://a/x?page=2", True), ("https://a/PAGE/2/", True), ("https://a/p/3", True), ("https://a/p/x", False), ("https://a/seite/1", True), ("https://a/x?start=10", True), ("https://a/article", False)],
)
def test_pagination(spark, url, paged):
    assert one(spark, url, urls.is_pagination) is paged


@pytest.mark.parametrize(
    ("url", "day"),
    [
        ("https://a/20250930_embargo", "2025-09-30"),
        ("https://a/20251330_x", None),
        ("https://a/2025_01_x", "2025-01-01"),
        ("https://a/2024_13_x", None),
        ("https://a/2025/09/30/x", "2025-09-30"),
        ("https://a/2025-02-30/x", None),
        ("https://a/2025-02-28/x", "2025-02-28"),
        ("https://a/x", None),
    ],
)
def test_date_in_url(spark, url, day):
    assert one(spark, url, lambda c: urls.dated(c).cast("string")) == day


def test_url_rules(spark):
    rows = spark.createDataFrame([(u,) for u in ("https://a/News/1", "https://a/news/1", "https://a/news/tag/2")], "u string")
    kept = lambda inc, exc: [r[0] for r in rows.where(urls.passes_rules(F.col("u"), inc, exc)).collect()]
    assert kept(["/news/"], []) == ["https://a/news/1", "https://a/news/tag/2"]  # case counts
    assert kept(["re:(?i)/news/"], ["/tag/"]) == ["https://a/News/1", "https://a/news/1"]
    assert kept(["re:(["], []) == []  # doesn't compile, matches nothing
    assert len(kept([], ["re:(["])) == 3


def test_hub_links(spark):
    f = lambda u, s, i: spark.createDataFrame([(u, s)], "u string, s string").select(urls.is_hub_link(F.col("u"), F.col("s"), F.lit(i))).first()[0]
    assert f("https://A.de/x/?q=1#f", "https://a.de/x", False)
    assert not f("https://a.de/x/y", "https://a.de/x", False)
    assert f("https://a.de/x/y", "https://a.de/x", True)
    assert not f("https://a.de/xy", "https://a.de/x", True)


def test_resolve(spark):
    f = lambda p, h: spark.createDataFrame([(p, h)], "p string, h string").select(urls.resolve(F.col("p"), F.col("h"))).first()[0]
    assert f("https://a.de/b/c?x=1", "/d") == "https://a.de/d"
    assert f("https://a.de/b/c", "d") == "https://a.de/b/d"
    assert f("https://a.de", "d") == "https://a.de/d"
    assert f("https://a.de/b/c", "http://e/f") == "http://e/f"


DATES = [
    ("22 January 2026", "2026-01-22", "2026-01-22"),
    ("22. Januar 2026", "2026-01-22", "2026-01-22"),
    ("January 8, 2026", "2026-01-08", "2026-01-08"),
    ("Dez 3rd, 2025", "2025-12-03", None),
    ("22.01.2026", "2026-01-22", "2026-01-22"),
    ("01/02/2026", "2026-02-01", "2026-01-02"),
    ("32.13.2026", None, None),
    ("30 February 2026", None, None),
    ("nothing", None, None),
    ("", None, None),
]


@pytest.mark.parametrize(("said", "found", "article"), DATES)
def test_dates(spark, said, found, article):
    day = lambda f: one(spark, said, lambda c: f(c).cast("date").cast("string"))
    assert day(dates.discovered) == found
    if article:
        assert day(dates.article) == article
    py = pydates.discovered(said, AS_OF)
    if found:
        assert str(py.date()) == found


def test_offsets(spark):
    said = "2026-01-22T10:00:00+02:00"
    assert one(spark, said, lambda c: dates.iso_or_unknown(dates.discovered(c))) == "2026-01-22T10:00:00Z"
    assert one(spark, said, lambda c: dates.iso_or_unknown(dates.article(c))) == "2026-01-22T08:00:00Z"
    assert one(spark, None, lambda c: dates.iso_or_unknown(dates.article(c))) == "unknown"


@pytest.mark.parametrize(("said", "ok"), [("1.1.2024", False), ("25.01.2024", False), ("26.01.2024", True), ("1.1.2027", True), ("1.3.2027", False), ("30.02.2026", False)])
def test_listing_window(spark, said, ok):
    as_of = F.lit("2026-01-25 00:00:00").cast("timestamp")
    assert (one(spark, said, lambda c: dates.listing(c, as_of)) is not None) is ok


def test_titles(spark):
    f = lambda x: one(spark, x, text.normalize_title)
    assert f(" a \n b\t c ") == "a b c"
    assert f(" ".join("w" * 1 for _ in range(16))) == " ".join(["w"] * 15) + "…"
    assert f(None) == "" == f("")


@pytest.mark.parametrize(
    ("body", "status", "reason"),
    [
        (None, "FAIL", "article_text_empty"),
        ("  \n ", "FAIL", "article_text_empty"),
        ("Menu\nHome", "FAIL", "article_text_insufficient"),
        ("x" * 700, "PASS", None),
        ("x" * 650 + "\n" + "menu\n" * 400, "FAIL", "article_text_insufficient"),
        ("x" * 650 + "\n" + "menu\n" * 300, "WARN", None),
    ],
)
def test_prepare(spark, body, status, reason):
    p = one(spark, body, text.prepare)
    assert (p["status"], p["reason"]) == (status, reason)


def test_kept_lines(spark):
    lines = "MENU\nA LONG CAPITAL HEADER\nEnds here.\nWhy?\nshort\n1234567890123\n" + "y" * 61
    assert one(spark, lines, text.kept_lines) == ["A LONG CAPITAL HEADER", "Ends here.", "Why?", "y" * 61]


def test_ratio_may_exceed_one(spark):
    assert one(spark, "\n".join(["Yes."] * 200), text.prepare)["ratio"] > 1


def test_code_fence(spark):
    f = lambda x: one(spark, x, text.strip_code_fence)
    assert f('```json\n{"a": 1}\n```') == '{"a": 1}'
    assert f('{"a": 1}') == '{"a": 1}'


def test_meta_response(spark):
    f = lambda x: one(spark, x, text.is_meta_response)
    assert f("i don't have the text") and f("Please PASTE it") and not f("A summary.") and not f(None)


@pytest.mark.parametrize(
    ("raw", "strict", "lenient"),
    [("3", 3, 3), ("0", 0, 0), ("4", None, 4), ("-1", None, -1), ('"2"', None, 2), ("2.7", None, 2), ('"2.7"', None, 0), ("true", 1, 1), ("null", None, 0), ('{"score": 2}', 2, 0)],
)
def test_dimensions(spark, raw, strict, lenient):
    v = lambda c: scoring.answer(F.concat(F.lit('{"d2_organ": '), c, F.lit("}")))
    assert one(spark, raw, lambda c: scoring.strict_dimension(v(c), "d2_organ")) == strict
    assert one(spark, raw, lambda c: scoring.lenient_dimension(v(c), "d2_organ")) == lenient


def test_answers(spark):
    f = lambda x: one(spark, x, lambda c: scoring.answer(c).cast("string"))
    assert f('```\n{"a":1}\n```') == '{"a":1}' == f('Sure: {"a":1} ok')
    assert f("[1]") is None and f("none") is None and f(None) is None


@pytest.mark.parametrize(("total", "level", "own"), [(0, "Niedrig", "Niedrig"), (4, "Niedrig", "Niedrig"), (5, "Mittel", "Mittel"), (9, "Mittel", "Hoch"), (10, "Hoch", "Hoch"), (None, None, None)])
def test_levels(spark, total, level, own):
    assert one(spark, total, scoring.level, "int") == level
    assert one(spark, total, lambda c: scoring.level(c, {"hoch": 8, "Mittel": 0}), "int") == own


def test_bonus(spark):
    dims = lambda *v: spark.createDataFrame([v], "a int, b int, c int").select(scoring.total([F.col(x) for x in "abc"], True)).first()[0]
    assert dims(2, 2, 0) == 6 and dims(2, 1, 3) == 6 and dims(1, 3, 0) == 4


def test_practice_areas(spark):
    v = lambda c: scoring.answer(F.concat(F.lit('{"practice_area": '), c, F.lit("}")))
    assert one(spark, '" Sonstiges "', lambda c: scoring.strict_area(v(c))) == "Sonstiges"
    assert one(spark, '"x"', lambda c: scoring.strict_area(v(c))) is None
    assert one(spark, '""', lambda c: scoring.lenient_area(v(c))) == "Sonstiges"


def test_keyword_predicates_differ_for_empty_categories(spark):
    cats = {"a": ["x"], "b": []}
    d = spark.createDataFrame([("nothing", ["b"]), ("nothing", ["a"]), ("X", ["a"]), ("nothing", [])], "t string, c array<string>")
    assert [r[0] for r in d.select(keywords.allowed(F.col("t"), F.col("c"), cats)).collect()] == [True, False, True, True]
    assert [r[0] for r in d.select(keywords.matched_categories(F.col("t"), cats)).collect()] == [[], [], ["a"], []]


def test_distinct_ignoring_case(spark):
    f = lambda x: one(spark, x, keywords.distinct_ignoring_case, "array<string>")
    assert f(["Aa", "b", "AA", "B"]) == ["Aa", "b"]
    assert f([]) is None
