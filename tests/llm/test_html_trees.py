"""Trees of misnested markup and templates, by the rules of the HTML standard."""

import time

import pytest

from feedmill.llm.html_text import build, render

PAGES = [
    ("<head><template><p>inert</p></template></head><body>Hi", "Hi"),
    ("<template>a<template>b</template>c</template>Hi", "Hi"),
    ("<head><template><body><p>x</template><title>t</title></head>Hi", "Hi"),
    ("<template><div>a</template></div>Hi", "Hi"),
    ("<head><template><style>p{display:none}</style></template></head><p>a", "a"),
    ("<template>never closed <p>Hi", ""),
    ("<p>a<template>b</template>c", "ac"),
    ("<template><table><tr><td>x</template><p>a", "a"),
    ("<head><noscript><p>Enable JavaScript</p></noscript></head><body>Hi", "Enable JavaScript\n\nHi"),
    ("<body>a<noscript>b</noscript>", "ab"),
    ("<b><p>x</b>y</p>z", "xy\n\nz"),
    ("<p><b>x</p>y</b>z", "x\n\nyz"),
    ("<b>x<i>y</b>z</i>", "xyz"),
    ("<i><div>a</i>b</div>c", "ab\nc"),
    ("<b><i><p>x</b>y</i>z</p>w", "xyz\n\nw"),
    ("<b><div><p>x</b>y</p>z</div>w", "xy\n\nz\nw"),
    ("<em><ul><li>a</em>b<li>c</ul>d", "- ab\n- c\n\nd"),
    ("<a href=1><div>x<a href=2>y</a></div>z", "xy\nz"),
    ("<a href=1>x<a href=2>y", "xy"),
    ("<b hidden><p>x</b>y</p>z", "y\n\nz"),
    ("<b><p hidden>x</b>y</p>z", "z"),
    ("<font><table><tr><td>x</font>y</table>", "xy"),
    ("<b><table><tr><td>x</b>y</td></tr></table>z", "xy\n\nz"),
    ("<strong><h1>t</strong>u</h1>v", "tu\n\nv"),
    ("<u><blockquote>q</u>r</blockquote>s", "    qr\n\ns"),
    ("<s><p>a</s><p>b", "a\n\nb"),
    ("<small><section><article>a</small>b</article>c</section>d", "ab\nc\nd"),
    ("<b><span><p>x</b>y</p>z", "xy\n\nz"),
    ("<style>b p{display:none}</style><b><p>x</b>y</p>z", "xy\n\nz"),
    ("<style>p>b{display:none}</style><b><p>x</b>y</p>z", "y\n\nz"),
    ("</b></i>a<b></b></b>b", "ab"),
    ("<code><pre>x\n</code> y</pre>z", "x\n y\n\nz"),
]


@pytest.mark.parametrize(("html", "text"), PAGES)
def test_pages(html, text):
    assert render(html) == text


def test_each_node_knows_its_place():
    """What moves keeps parents and places right."""
    todo = [build("".join(h for h, _ in PAGES if "never" not in h))]
    while todo:
        node = todo.pop()
        assert [x for x in node.children if not isinstance(x, str)] == node.elements
        assert all(x.parent is node and x.place == i for i, x in enumerate(node.elements))
        todo.extend(node.elements)


def test_many_misnested_tags_take_little_time():
    start = time.perf_counter()
    for html in ("<b>" * 20_000 + "<div>" * 20_000 + "x" + "</b>" * 20_000 + "y", "<b><p>x</b>" * 30_000, "<b><div>" * 10_000 + "</b>" * 10_000, "<template>" * 30_000):
        build(html)
    assert time.perf_counter() - start < 60
