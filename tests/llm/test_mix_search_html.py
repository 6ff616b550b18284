"""Mixing, search and rendering against brute force and fixtures."""

import heapq
import math
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from feedmill.llm import html_text, mixing, topk_search

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes):
    """Shares by weight, capped at three times the size, by rounds."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, target, free = sum(sizes.values()), {}, set(order)
    while free:
        left = total - sum(target.values())
        w = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / w > 3 * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / w for s in free}
        target |= {s: 3.0 * sizes[s] for s in over}
        free -= over
    return target


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 20, "c": 30}, {"a": 1, "b": 1000, "c": 1, None: 5}, {"a": 0, "b": 10}, {None: 7}, {"é": 5, "z": 5, "Z": 900, "a": 1, "b": 2}, {"a": 0}])
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(frame).collect()}
    want = brute_targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def brute_seats(votes, seats):
    quota = dict.fromkeys(votes, 0)
    heap = [(-v, p) for p, v in votes.items() if v > 0]
    heapq.heapify(heap)
    for _ in range(seats if heap else 0):
        _, p = heapq.heappop(heap)
        quota[p] += 1
        heapq.heappush(heap, (-votes[p] / (2 * quota[p] + 1), p))
    return quota


def test_sainte_lague(spark):
    rng, rows, want = random.Random(1), [], {}
    for g in range(60):
        votes = {f"p{i}": rng.choice([0.0, rng.random(), rng.random() * 1000, 7.0]) for i in range(rng.randint(1, 9))}
        seats = rng.choice([0, 1, 3, 50, 997])
        want |= {(g, p): q for p, q in brute_seats(votes, seats).items()}
        rows += [(g, p, v, seats) for p, v in votes.items()]
    frame = spark.createDataFrame(rows, "g int, p string, votes double, seats long")
    got = {(r["g"], r["p"]): r["quota"] for r in mixing.sainte_lague(frame, "g", "p", "votes", "seats").collect()}
    assert got == want


def mix_rows(seed=3, n=400):
    rng = random.Random(seed)
    return [(i, "w " * rng.randint(0, 60), rng.choice(["a", "a", "a", "b", "c", "d", None])) for i in range(n)]


def test_mix(documents):
    rows = mix_rows()
    docs = documents(rows, clash=True)
    out = mixing.mix(docs, shard_words=2000).collect()
    assert len(out) == len(rows)
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in out:
        assert 0 <= r["taken"] <= 3 * r["size"]
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    want = brute_targets(dict(sizes))
    assert all(abs(target[s] - want[s]) < 1e-6 for s in want)
    assert all(abs(taken[s] - want[s]) <= 0.03 * want[s] + 100 for s in want)
    again = mixing.mix(docs.repartition(7), shard_words=2000).collect()
    key = lambda r: (r["doc_id"], r["taken"], r["part_from"])
    assert sorted(map(key, out)) == sorted(map(key, again))


def test_sources_get_their_targets_at_any_size(documents):
    # Short texts of small sources beside a large source, and a doc_id that many rows share.
    rows = [(i, "w " * 50, "big") for i in range(3000)] + [(7, f"x{i} " * 3, "short") for i in range(300)] + [(None, "one two", "few") for _ in range(40)] + [(9, "a b", "tiny")]
    for shard_words, lot_shards in ((500, 7), (20, 50), (10**6, 4096)):
        out = mixing.mix(documents(rows), shard_words=shard_words, lot_shards=lot_shards).collect()
        assert len(out) == len(rows) and all(0 <= r["taken"] <= 3 * r["size"] for r in out)
        taken, target = defaultdict(int), {r["source"]: r["target"] for r in out}
        for r in out:
            taken[r["source"]] += r["taken"]
        shards = {s: len({r["shard"] for r in out if r["source"] == s}) for s in target}
        assert all(abs(taken[s] - target[s]) <= 0.01 * target[s] + 16 for s in ("big", "tiny")), (taken, target)
        assert all(abs(taken[s] - target[s]) <= 16 * shards[s] for s in target), (taken, target)


def test_taken_equals_seats_given_one_by_one(documents):
    rows = mix_rows(5, 200)
    out = mixing.mix(documents(rows), shard_words=400, lot_shards=2).collect()
    target = {("t" if r["source"] is None else "s" + r["source"]): r["target"] for r in out}
    length, taken = defaultdict(lambda: defaultdict(int)), defaultdict(int)
    for r in out:
        p = "t" if r["source"] is None else "s" + r["source"]
        length[p][r["shard"]] += r["size"]
        taken[p, r["shard"]] += r["taken"]
    for p, seats in brute_seats(target, round(sum(target.values()) / 16)).items():
        lots = defaultdict(dict)
        for shard, n in length[p].items():
            lots[shard // 2][shard] = n
        for lot, n in brute_seats({k: sum(v.values()) for k, v in lots.items()}, seats).items():
            for shard, quota in brute_seats(lots[lot], n).items():
                assert taken[p, shard] == min(16 * quota, 3 * length[p][shard])


def test_mixed_rows_hold_the_words_taken(documents):
    rows = mix_rows(4, 120)
    docs = documents(rows)
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(docs).collect()}
    out = mixing.mixed_rows(docs)
    assert out.columns == docs.columns
    words = defaultdict(int)
    for r in out.collect():
        words[r["doc_id"]] += len(WORD.findall(r["text"]))
        assert r["n_chars"] == len(r["text"])
    assert {i: n for i, n in taken.items() if n} == dict(words)


def test_mix_awkward(documents, awkward):
    out = mixing.mix(documents(awkward, clash=True)).collect()
    assert len(out) == len(awkward)
    got = sorted(((r["doc_id"], r["size"]) for r in out), key=str)
    assert got == sorted(((i, len(WORD.findall(t or ""))) for i, t in awkward), key=str)
    assert mixing.mix(documents([])).count() == 0
    assert mixing.mix(documents([(1, None), (2, "")])).agg(F.sum("taken")).first()[0] == 0


def brute_search(rows, queries, k=5):
    import math

    def whole(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(256 * x) for x in v]

    known = [(i, q) for i, v in rows if i is not None and (q := whole(v)) is not None]
    out = []
    for i, q in {i: q for i, q in known if i in queries}.items():
        found = sorted((-sum(a * b for a, b in zip(q, p)), j) for j, p in known if j != i and len(p) == len(q))[:k]
        out += [(i, r, j, -s) for r, (s, j) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("kind", ["unit", "lengths", "ties", "tiny"])
def test_search(spark, kind):
    rng = random.Random(kind)
    rows = []
    for i in range(3 if kind == "tiny" else 400):
        v = [rng.gauss(0, 1) for _ in range(8)]
        if kind == "lengths":
            v = [x * rng.choice([0.01, 1, 20]) for x in v]
        if kind == "ties":
            v = [float(round(x)) for x in v] if i % 3 else [1.0] * 8
        rows.append((i, v))
    rows += [(1000, None), (1001, [1.0, None] * 4), (1002, [float("nan")] * 8), (1003, [float("inf")] * 8), (1050, [0.0] * 8), (1100, [1.0, 2.0]), (1150, []), (None, [1.0] * 8)]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")
    import numpy as np

    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    for options in ({}, {"sample": 4, "selective": -2.0, "coordinates": 5}, {"buckets": 1, "selective": 2.0}):
        got = sorted(tuple(r) for r in topk_search.search(frame, F.col("vec_id") % 50 == 0, **options).select("query_id", "rank", "vec_id", "score").collect())
        assert got == brute_search(exact, {i for i, _ in rows if i is not None and i % 50 == 0})


def test_search_of_large_numbers(spark):
    """All finite vectors take part; scores over 53 and 64 bits rank exactly."""
    large = float(2**31 - 1)
    rows = [(0, [1e10, 1.0] * 4), (50, [large] * 8), (1, [8388608.0] + [0.0] * 7), (2, [large] * 7 + [large - 1]), (3, [1e30] * 8), (4, [-1e30] * 8), (5, [float("inf")] + [0.0] * 7), (6, None), (7, [1.0, None] + [0.0] * 6)]
    rows += [(8, [float(2**27) + i for i in range(8)]), (9, [float(2**27) + i + (i == 3) for i in range(8)]), (10, [0.0] * 8), (50, [large] * 8), (100, [1e300] * 8), (100, [1.0, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    exact = [(i, [math.floor(256.0 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for a, (i, q) in enumerate(exact):
        if i % 50 == 0:
            each = sorted((-sum(x * y for x, y in zip(q, p)), j) for b, (j, p) in enumerate(exact) if a != b and len(p) == len(q))[:5]
            want += [(i, r, j, min(max(-s, -(2**63)), 2**63 - 1)) for r, (s, j) in enumerate(each, 1)]
    for sample in (0, 1024):
        got = topk_search.search(frame, F.col("vec_id") % 50 == 0, sample=sample).select("query_id", "rank", "vec_id", "score").collect()
        assert sorted(map(tuple, got)) == sorted(want)


def test_search_of_nothing(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk_search.search(frame, F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain  text\n here", "plain text here"),
        ("<p>a<p>b", "a\n\nb"),
        ("<div>a</div><div>b</div>", "a\nb"),
        ("a<br>b", "a\nb"),
        ("<title>t</title><style>p{}</style><script>x</script><p>v", "v"),
        ("<ul><li>a<li>b<ul><li>c</ul></ul>", "- a\n- b\n  - c"),
        ("<ol start=3><li>a<li value=7>b<li>c</ol>", "3. a\n7. b\n8. c"),
        ("<ol type=i reversed><li>a<li>b</ol>", "ii. a\ni. b"),
        ("<ol type=A><li>a</ol>", "A. a"),
        ("<table><tr><td>a<td>bb<tr><td>ccc<td>d</table>", "a    bb\nccc  d"),
        ("<table><tr><th rowspan=2>x<td>1<tr><td>22</table>", "x  1\n   22"),
        ("<table><tr><td colspan=2>wide cell<td>e<tr><td>a<td>b<td>c</table>", "wide cell     e\na          b  c"),
        ("<table><tfoot><tr><td>f</tfoot><tbody><tr><td>b</tbody></table>", "b\nf"),
        ("<table><td>日本<td>x<tr><td>a<td>y</table>", "日本  x\na     y"),
        ("<p hidden>a</p><p style='display: none'>b</p><p>c", "c"),
        ("<style>.g, #i{display:none} .h{color:red}</style><p class='g h'>a<p id=i>b<p class=h>c", "c"),
        ("<div style='visibility:hidden'>a<span style='visibility:visible'>b</span></div>", "b"),
        ("<details><summary>s</summary>x</details><details open><summary>t</summary>y</details>", "s\nt\ny"),
        ("<pre>\n a\n\n  b</pre>", " a\n\n  b"),
        ("<blockquote>q</blockquote>r", "    q\n\nr"),
        ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n    d\nu\n    e"),
        ("&lt;b&gt; &amp;copy; &copy;&nbsp;x", "<b> &copy; © x"),
        ("<!-- c -->a<!---->b<![CDATA[x]]>c", "abc"),
        ("<q>a</q><input type=hidden value=h><input value=v><noscript>n</noscript>", '"a"vn'),
        ("<h1>a<h2>b</h2>c", "a\n\nb\n\nc"),
        ("x</div></p>y", "x\n\ny"),
        ("<a href='>'>a</a><a title=\"<b>\">c", "ac"),
        ("<textarea>\n a <b></textarea>", " a <b>"),
        ("a<hr>b", "a\n\n--------\n\nb"),
        ("<style>@media print {.x{display:none}}</style><p class=x>Hello</p><p>B", "Hello\n\nB"),
        ("<style>@media (max-width:600px){.m{display:none}} @media screen and (min-width: 40em) {.n{display:none}}</style><p class=m>a<p class=n>b", "a"),
        ("<style>@media not all and (width >= 500px){.a{display:none}} @media (400px <= width <= 2000px) {.b{display:none}}</style><p class=a>a<p class=b>b", "a"),
        ("<style media=print>p{display:none}</style><style>@supports (display:grid){ .g{display:none} } @supports not (display:grid){ .h{display:none} }</style><p>a<p class=g>b<p class=h>c", "a\n\nc"),
        ("<style>p{display:none}.keep{display:block}p{display:none}</style><p class=keep>a<p>b", "a"),
        ("<style>.a{display:none !important}</style><p class=a style='display:block'>a<p style='display:none!important;display:block'>b<p>c", "c"),
        ("<style>#i{display:block}.a{display:none}</style><p id=i class=a>a<p class=a>b", "a"),
        ("<style>ul.menu > li.x, nav a{display:none}</style><ul class=menu><li class=x>a<li>b</ul><nav><p><a>c</a>d</nav>", "- b\n\nd"),
        ("<style>[data-off], a[href^='#']{display:none} p:not(.on){display:none}</style><p class=on>a<a href='#x'>b</a><i data-off>c</i><p>d", "a"),
        ("<style>p:hover{display:none} p::before{display:none} p:first-child{display:none} p + p.t{display:none}</style><p>a<p>b<p class=t>c", "b"),
        ("<style>.o{color:red; .i{display:none} &.j{display:none} @media screen{display:none}} .k{.l &{display:none}}</style><div class=o>a</div><div class=l>b<i class=k>c</i></div>", "b"),
        ("<style>@layer late{.a{display:none}} .a{display:block} @font-face{display:none} @keyframes k{from{display:none}}</style><p class=a>a", "a"),
        ("<style>p{display:nonsense} .v{visibility:hidden} .v b{visibility:visible} /* p{display:none} */ i{content:'}p{display:none}'}</style><p>a<p class=v>b<b>c</b>", "a\n\nc"),
        ("<style>[hidden]{display:block} dialog{display:block}</style><p hidden>a</p><dialog>b</dialog>", "a\n\nb"),
        ("<p>E = <math><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup><annotation>mc^2</annotation></math>", "E = mc2"),
        ("<svg><title>t</title><path d='M0'/><g><text x=1>label</text></g></svg>after", "label\nafter"),
        ("<a title=it's>x</a> <b =y>z", "x z"),
    ],
)
def test_rendering(html, text):
    assert html_text.render(html) == text


def test_long_tags_and_deep_trees():
    assert html_text.render("<a " + "x " * 60_000 + ">in</a><img src=data:" + "A" * 300_000 + ">out") == "inout"
    assert html_text.render("<div>" * 60_000 + "deep" + "</div>" * 60_000 + "<p>after") == "deep\n\nafter"
    for tag in ("blockquote", "ul><li", "table><tr><td", "b", "p><a", "span><li"):
        assert html_text.render(f"<{tag}>" * 20_000 + "deep").split()[-1] == "deep"
    assert html_text.render("<p>a<" + "b " * 50) == "a"  # the page ends in a tag


def test_random_markup_keeps_visible_words():
    rng = random.Random(9)
    bits = ["<p>", "</p>", "<div>", "</div>", "<table>", "<tr>", "<td>", "</table>", "<ul>", "<li>", "</ul>", "<b>", "</b>", "<h2>", "<dl>", "<dd>", "<br>", "<blockquote>", "<pre>", "</pre>", "</x>", "<ol>", "</td>", "<span a='<'>"]
    for i in range(400):
        parts, words = [], []
        for k in range(rng.randint(0, 60)):
            if rng.random() < 0.4:
                words.append(f"w{k}")
                parts.append(f" w{k} ")
            else:
                parts.append(rng.choice(bits))
        assert sorted(re.findall(r"w\d+", html_text.render("".join(parts)))) == sorted(words), "".join(parts)


def test_rendering_in_spark(spark):
    rows = [(1, "<p>a", "old"), (1, "<p>a", "old"), (2, None, None), (3, "<b>" * 3000 + "deep", "x"), (4, "x" * 200_000, "y"), (5, '<a "' * 2000, "z")]
    out = html_text.extract(spark.createDataFrame(rows, "page_id long, html string, text string"))
    got = [(r["page_id"], r["text"][:10]) for r in out.collect()]
    assert got[:5] == [(1, "a"), (1, "a"), (2, ""), (3, "deep"), (4, "x" * 10)]
    assert html_text.extract(spark.createDataFrame([], "page_id long, html string")).count() == 0
