"""Layout-aware rendering of HTML pages as text.

A tolerant tree builder supplies implied tags; visibility rules (elements never
shown, ``hidden``, closed ``details``, and the cascade of style attributes and
style sheets, see ``css``) decide what is shown; the renderer writes all visible
text with blank lines between blocks, list markers with indentation, and table
cells aligned in columns.  Trees of any depth are built and rendered without
recursion: rendering steps are generators that hand their parts to one loop.

The page is shown as a browser without scripts shows it: ``noscript`` is visible,
a ``template`` never is, wherever it stands.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from unicodedata import combining, east_asian_width

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches
from .css import Cascade, media

#: Element classes of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
NEVER = frozenset("area audio base canvas datalist embed head iframe link meta noembed noframes object param script source style template title track video annotation annotation-xml rp".split())
#: Blocks, with the blank lines around each.
BLOCKS = dict.fromkeys("address article aside body center details dd div dt fieldset figcaption footer form header hgroup html legend li main nav section summary tr td th thead tbody tfoot caption option optgroup dialog search".split(), 0) | dict.fromkeys("blockquote dl figure h1 h2 h3 h4 h5 h6 menu ol p pre table ul xmp listing plaintext hr".split(), 1)
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul xmp plaintext listing li dd dt".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HEAD_ONLY = frozenset("base basefont bgsound link meta noframes script style template title".split())
#: An opening tag closes these open elements, up to the nearest of the scopes.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "table", "td", "th"}),
    "dt": ({"dt", "dd"}, {"dl", "table", "td", "th"}),
    "dd": ({"dt", "dd"}, {"dl", "table", "td", "th"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select", "datalist"}),
    "td": ({"td", "th"}, {"table"}),
    "th": ({"td", "th"}, {"table"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "rt": ({"rt", "rp"}, {"ruby"}),
    "rp": ({"rt", "rp"}, {"ruby"}),
}
SCOPES = frozenset("table td th caption button object template html body".split())
#: Quotes, lists and tables that are laid out within each other; the text of
#: deeper ones is laid out as plain blocks, as each would indent it further.
NESTED = 200
#: Elements of SVG that may hold text.
SVG = frozenset("svg g a switch".split())

_ATTRIBUTE = r"[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>\"'][^\s>]*+|(?=>)|\Z))?+"
TAG = re.compile(rf"<!--(?:>|->|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|{_ATTRIBUTE})*+)(>|\Z)|<[!?/][^>]*+(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)(?:\"|\Z)|'([^']*+)(?:'|\Z)|([^\s>\"'][^\s>]*+)|(?=>)|\Z))?+")
SPACE = re.compile(r"[ \t\n\r\f]+")
#: Elements that are taken out of the blocks that their end tag stands in.
FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u".split())
#: Open elements within a formatting element up to which that is done; with more,
#: its end tag ends the blocks in it.
ADOPTED = 256


class Node:
    """An element; ``elements`` are those of its children that are elements, and
    ``place`` its place among its parent's."""

    __slots__ = ("tag", "attrs", "children", "parent", "place", "elements")

    def __init__(self, tag: str, attrs: dict[str, str]) -> None:
        self.tag, self.attrs, self.children = tag, attrs, []
        self.parent, self.place, self.elements = None, 0, []

    def add(self, child: Node) -> None:
        child.parent, child.place = self, len(self.elements)
        self.elements.append(child)
        self.children.append(child)

    def drop_last(self) -> None:
        """Take out the last element, which is the last child."""
        self.elements.pop()
        self.children.pop()

    def wrap(self, inner: Node) -> Node:
        """Put all children into ``inner``, the only child from now on."""
        children, self.children, self.elements = self.children, [], []
        for x in children:
            if isinstance(x, str):
                inner.children.append(x)
            else:
                inner.add(x)
        self.add(inner)
        return inner


class Open:
    """The open elements, and where each tag stands among them."""

    def __init__(self, nodes: list[Node]) -> None:
        self.nodes: list[Node] = []
        self.where: dict[str, list[int]] = {}
        for x in nodes:
            self.push(x)

    def push(self, node: Node) -> None:
        self.where.setdefault(node.tag, []).append(len(self.nodes))
        self.nodes.append(node)

    def cut(self, at: int) -> None:
        while len(self.nodes) > at:
            self.where[self.nodes.pop().tag].pop()

    def last(self, tags) -> int:
        """The innermost element of these tags, over the page and its body."""
        where, found = self.where, 1
        for t in tags if len(tags) <= len(where) else where:
            if (at := where.get(t)) and at[-1] > found and t in tags:
                found = at[-1]
        return found if found > 1 else -1

    def close(self, tags, scope) -> None:
        """Close the innermost of these tags, unless a scope lies within it; with
        a row go its cells, with a group of rows its rows."""
        again = not tags.isdisjoint(("tr", "tbody", "thead", "tfoot"))
        while (at := self.last(tags)) > 0 and at > self.last(scope):
            self.cut(at)
            if not again:
                return

    def end_formatting(self, at: int) -> None:
        """End the formatting element at ``at``.  Blocks that are open in it stay
        open: each moves out of it, and what it holds so far goes into a copy."""
        for _ in range(8):
            block = next((i for i in range(at + 1, len(self.nodes)) if self.nodes[i].tag in BLOCKS), 0)
            if not block or len(self.nodes) - at > ADOPTED:
                self.cut(at)
                return
            element, *between = self.nodes[at:block]
            moved, *within = self.nodes[block:]
            self.nodes[block - 1].drop_last()
            # Formatting between the two goes on around the block, in copies.
            around = [Node(x.tag, dict(x.attrs)) for x in between if x.tag in FORMATTING]
            parent = self.nodes[at - 1]
            for x in [*around, moved]:
                parent.add(x)
                parent = x
            copy = moved.wrap(Node(element.tag, dict(element.attrs)))
            self.cut(at)
            for x in [*around, moved, copy, *within]:
                self.push(x)
            at += len(around) + 1


def build(html: str) -> Node:
    """The tree of a page; children are nodes and strings."""
    root, head, body = Node("html", {}), Node("head", {}), Node("body", {})
    root.add(head)
    root.add(body)
    stack, at, n, in_body, find = Open([root, head]), 0, len(html), False, TAG.search

    def text(s: str) -> None:
        nonlocal in_body, stack
        if not s:
            return
        if not (in_body or s.isspace() or stack.where.get("template")):
            in_body, stack = True, Open([root, body])
        if in_body or len(stack.nodes) > 2:
            stack.nodes[-1].children.append(unescape(s) if "&" in s else s)

    while at < n:
        m = find(html, at)
        if m is None:
            text(html[at:])
            break
        text(html[at : m.start()])
        at = m.end()
        if (tag := m[2]) is None or not m[4]:
            continue  # no tag, or one that the page ends in
        tag = tag.lower()
        foreign = bool(stack.where.get("svg") or stack.where.get("math"))
        if m[1]:
            inert = stack.where.get("template")
            if stack.nodes[-1].tag == tag and len(stack.nodes) > 2:
                stack.cut(len(stack.nodes) - 1)
            elif tag == "br":
                stack.nodes[-1].add(Node("br", {}))
            elif tag == "p" and not stack.where.get("p"):
                if in_body or inert:
                    stack.nodes[-1].add(Node("p", {}))
            elif tag not in ("html", "body", "head"):
                found = stack.last(HEADINGS if tag in HEADINGS else (tag,))
                # A stray end tag does not leave its cell.
                if found > 0 and tag in FORMATTING and found > stack.last(SCOPES):
                    stack.end_formatting(found)
                elif found > 0 and (tag == "template" or tag in LEAVES and found > stack.last(_TEMPLATE) or tag in SCOPES and found >= stack.last(SCOPES) or found > stack.last(SCOPES)):
                    stack.cut(found)
            continue
        attrs: dict[str, str] = {}
        if m[3] and not m[3].isspace():
            for a, x, y, z in ATTRIBUTE.findall(m[3]):
                attrs.setdefault(a.lower(), unescape(x or y or z))
        inert = bool(stack.where.get("template"))
        if tag in ("html", "head", "body"):
            if inert:
                continue
            if tag == "body":
                in_body, stack = True, stack if in_body else Open([root, body])
            target = {"html": root, "head": head, "body": body}[tag]
            for k, v in attrs.items():
                target.attrs.setdefault(k, v)
            continue
        if not (in_body or inert or tag in HEAD_ONLY):
            in_body, stack = True, Open([root, body])
        if tag in CLOSES_P:
            stack.close(_P, SCOPES)
        if tag in IMPLIED:
            stack.close(*IMPLIED[tag])
        if tag in HEADINGS and stack.nodes[-1].tag in HEADINGS:
            stack.cut(len(stack.nodes) - 1)
        if tag == "a" and not foreign and (found := stack.last(_A)) > stack.last(SCOPES):
            stack.end_formatting(found)
        node = Node(tag, attrs)
        if tag in ("td", "th") and stack.nodes[-1].tag in ("table", "tbody", "thead", "tfoot"):
            row = Node("tr", {})
            stack.nodes[-1].add(row)
            stack.push(row)
        stack.nodes[-1].add(node)
        done = m[3].endswith("/") and (foreign or tag in ("svg", "math"))
        if tag in RAW and not done:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(html, at)
            inner = html[at : end.start() if end and tag != "plaintext" else n]
            at = end.end() if end and tag != "plaintext" else n
            node.children.append(unescape(inner) if tag in ("textarea", "title") else inner)
        elif tag not in VOID and not done and (in_body or inert or tag == "template"):
            stack.push(node)
    return root


_P, _A, _TEMPLATE = frozenset(["p"]), frozenset(["a"]), frozenset(["template"])
#: End tags that leave a cell.
LEAVES = frozenset("table tr tbody thead tfoot td th caption".split())


def sheets(node: Node) -> Cascade:
    """The rules of the page's style sheets, in order."""
    found, todo = Cascade(), [node]
    while todo:
        x = todo.pop()
        if x.tag == "style" and x.attrs.get("type", "").strip().lower() in ("", "text/css") and media(x.attrs.get("media", "")):
            found.add("".join(c for c in x.children if isinstance(c, str)))
        if x.tag != "template":
            todo.extend(reversed(x.elements))
    return found


def width(line: str) -> int:
    return len(line) if line.isascii() else sum(0 if combining(c) else 2 if east_asian_width(c) in "WF" else 1 for c in line)


class Flow:
    """Lines of a block: inline text is gathered into a line, blocks end it."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line = ""
        self.gap = 0

    def text(self, s: str, pre: bool) -> None:
        if pre:
            first, *more = s.replace("\r\n", "\n").split("\n")
            self.line += first
            for x in more:
                self.end(keep=True)
                self.line += x
            return
        s = SPACE.sub(" ", s).replace("\xa0", "\0")
        if not self.line or self.line[-1] == " ":
            s = s.lstrip(" ")
        self.line += s

    def end(self, keep: bool = False) -> None:
        """End the line; an empty one only counts if ``keep``."""
        line = self.line.rstrip(" ").replace("\0", " ")
        self.line = ""
        if line or keep:
            self.add([line])

    def add(self, lines: list[str]) -> None:
        if lines:
            if self.lines and self.gap:
                self.lines.extend([""] * self.gap)
            self.gap = 0
            self.lines.extend(lines)

    def block(self, gap: int) -> None:
        self.end()
        self.gap = max(self.gap, gap)


def marker(kind: str, number: int) -> str:
    """A list item's number as the list's ``type`` writes it."""
    if kind in ("a", "A") and number > 0:
        s = ""
        while number:
            number, r = divmod(number - 1, 26)
            s = chr(97 + r) + s
        return (s if kind == "a" else s.upper()) + "."
    if kind in ("i", "I") and 0 < number < 4000:
        s = ""
        for value, sign in zip((1000, 900, 500, 400, 100, 90, 50, 40, 10, 9, 5, 4, 1), "m cm d cd c xc l xl x ix v iv i".split()):
            s += sign * (number // value)
            number %= value
        return (s if kind == "i" else s.upper()) + "."
    return f"{number}."


def _int(s: str | None, default: int) -> int:
    try:
        return int(s or "")
    except ValueError:
        return default


def finish(step) -> None:
    """Run a step (a generator) and all steps that it hands on, in their order."""
    steps = [step]
    while steps:
        following = next(steps[-1], None)
        if following is None:
            steps.pop()
        else:
            steps.append(following)


class Renderer:
    def __init__(self, rules: Cascade) -> None:
        self.rules = rules

    def style(self, node: Node) -> dict[str, str]:
        return self.rules.style(node) if self.rules or "style" in node.attrs else {}

    def gone(self, node: Node, style: dict[str, str] | None = None) -> bool:
        """Whether nothing of the node is laid out."""
        attrs = node.attrs
        if node.tag in NEVER or node.tag == "input" and attrs.get("type", "").lower() == "hidden":
            return True
        display = (self.style(node) if style is None else style).get("display")
        if display is not None:
            return display == "none"
        return "hidden" in attrs or node.tag == "dialog" and "open" not in attrs

    def render(self, children: list, flow: Flow, pre: bool, seen: bool, level: int, in_item: bool = False):
        for child in children:
            if isinstance(child, str):
                if seen:
                    flow.text(child, pre)
                continue
            style = self.style(child)
            if self.gone(child, style):
                continue
            tag, shown = child.tag, seen
            if (v := style.get("visibility", "inherit")) not in ("inherit", "unset"):
                shown = v in ("visible", "initial")
            if tag == "br":
                flow.end(keep=bool(flow.lines or flow.line))
            elif tag == "hr":
                flow.block(1)
                flow.add(["-" * 8])
                flow.block(1)
            elif tag == "input":
                if shown and child.attrs.get("type", "text").lower() in ("text", "submit", "button", "reset", "search", "email", "url", "tel", "number"):
                    flow.text(child.attrs.get("value", ""), False)
            elif tag == "svg":
                yield self.drawing(child, flow, shown, level)
            elif tag == "table" and level < NESTED:
                flow.block(1)
                yield self.table(child, flow, shown, level + 1)
                flow.block(1)
            elif tag in ("ul", "ol", "menu", "dir") and level < NESTED:
                flow.block(0 if in_item else 1)
                yield self.items(child, flow, shown, level + 1)
                flow.block(0 if in_item else 1)
            elif tag in ("blockquote", "dd") and level < NESTED:
                flow.block(BLOCKS[tag])
                inner = Flow()
                yield self.render(child.children, inner, pre, shown, level + 1)
                inner.end()
                flow.add([f"    {x}" if x else "" for x in inner.lines])
                flow.block(BLOCKS[tag])
            elif tag == "details" and "open" not in child.attrs:
                flow.block(0)
                for x in child.elements:
                    if x.tag == "summary":
                        yield self.render([x], flow, pre, shown, level)
                        break
                flow.block(0)
            elif tag in ("pre", "xmp", "listing", "plaintext", "textarea"):
                flow.block(BLOCKS.get(tag, 0))
                inside = child.children
                if inside and isinstance(inside[0], str) and inside[0].startswith("\n"):
                    inside = [inside[0][1:], *inside[1:]]
                yield self.render(inside, flow, True, shown, level)
                flow.block(BLOCKS.get(tag, 0))
            elif tag == "q":
                flow.text('"' if shown else "", pre)
                yield self.render(child.children, flow, pre, shown, level)
                flow.text('"' if shown else "", pre)
            elif tag in BLOCKS:
                flow.block(BLOCKS[tag])
                yield self.render(child.children, flow, pre, shown, level)
                flow.block(BLOCKS[tag])
            else:
                yield self.render(child.children, flow, pre, shown, level)

    def drawing(self, node: Node, flow: Flow, seen: bool, level: int):
        """Texts of a drawing, a line each; other shapes have none."""
        for child in node.elements:
            if self.gone(child):
                continue
            if child.tag in ("text", "foreignobject"):
                flow.block(0)
                yield self.render(child.children, flow, False, seen, level)
                flow.block(0)
            elif child.tag in SVG:
                yield self.drawing(child, flow, seen, level)

    def items(self, node: Node, flow: Flow, seen: bool, level: int):
        down = "reversed" in node.attrs
        number = _int(node.attrs.get("start"), sum(x.tag == "li" for x in node.elements) if down else 1)
        for child in node.children:
            if not (isinstance(child, Node) and child.tag == "li"):
                yield self.render([child], flow, False, seen, level)
                continue
            number = _int(child.attrs.get("value"), number)
            style = self.style(child)
            if not self.gone(child, style):
                v = style.get("visibility", "inherit")
                shown = seen if v in ("inherit", "unset") else v in ("visible", "initial")
                sign = (marker(node.attrs.get("type", ""), number) if node.tag == "ol" else "-") if shown else ""
                inner = Flow()
                yield self.render(child.children, inner, False, shown, level, True)
                inner.end()
                flow.end()
                pad = " " * (len(sign) + 1)
                if shown or inner.lines:
                    flow.add([(f"{sign} " if i == 0 else pad) + x if x or i == 0 else "" for i, x in enumerate(inner.lines or [""])])
            number += -1 if down else 1

    def table(self, node: Node, flow: Flow, seen: bool, level: int):
        """Captions and stray content first, then rows of cells, each column as
        wide as its widest line; cells over several columns or rows hold their
        places."""
        rows: list[Node] = []
        feet: list[Node] = []
        for part in node.children:
            if isinstance(part, Node) and part.tag == "tr":
                rows.append(part)
            elif isinstance(part, Node) and part.tag in ("thead", "tbody", "tfoot"):
                if not self.gone(part):
                    into = feet if part.tag == "tfoot" else rows
                    for x in part.children:
                        if isinstance(x, Node) and x.tag == "tr":
                            into.append(x)
                        else:
                            yield self.render([x], flow, False, seen, level)
            elif not (isinstance(part, Node) and part.tag in ("colgroup", "col")):
                yield self.render([part], flow, False, seen, level)
        flow.end()
        grid: list[list[tuple[int, list[str]]]] = []
        held: dict[int, int] = {}  # column: rows that a cell above still covers
        for row in rows + feet:
            if self.gone(row):
                continue
            cells, column = [], 0
            for cell in row.children:
                if not (isinstance(cell, Node) and cell.tag in ("td", "th")):
                    yield self.render([cell], flow, False, seen, level)
                    continue
                style = self.style(cell)
                if self.gone(cell, style):
                    continue
                while held.get(column, 0) > 0:
                    column += 1
                inner, shown = Flow(), seen
                for x in (part for part in (row.parent, row) if part is not node):
                    if (v := self.style(x).get("visibility", "inherit")) not in ("inherit", "unset"):
                        shown = v in ("visible", "initial")
                if (v := style.get("visibility", "inherit")) not in ("inherit", "unset"):
                    shown = v in ("visible", "initial")
                yield self.render(cell.children, inner, False, shown, level)
                inner.end()
                cells.append((column, inner.lines))
                over, down = min(max(1, _int(cell.attrs.get("colspan"), 1)), 1000), _int(cell.attrs.get("rowspan"), 1)
                for c in range(column, column + over):
                    held[c] = max(held.get(c, 0), down)
                column += over
            held = {c: left - 1 for c, left in held.items() if left > 1}
            if cells:
                grid.append(cells)
        flow.end()
        widths: dict[int, int] = {}
        for cells in grid:
            for column, lines in cells:
                widths[column] = max([widths.get(column, 0), *map(width, lines)])
        starts, at = {}, 0
        for column in sorted(widths):
            starts[column] = at
            at += widths[column] + 2 if widths[column] else 0
        for cells in grid:
            for k in range(max((len(lines) for _, lines in cells), default=0)):
                out, have = "", 0
                for column, lines in cells:
                    if k < len(lines) and lines[k]:
                        out += " " * (starts[column] - have) + lines[k]
                        have = max(have, starts[column]) + width(lines[k])
                flow.add([out])


def render(html: str | None) -> str:
    """All visible text of a page; of a null or empty one, the empty text."""
    if not html:
        return ""
    root = build(html.replace("\0", ""))
    flow, out = Flow(), Renderer(sheets(root))
    body = root.elements[1]
    if not out.gone(root):
        shown = out.style(root).get("visibility", "visible") not in ("hidden", "collapse")
        finish(out.render([body], flow, False, shown, 0))
    flow.end()
    return "\n".join(flow.lines).strip("\n")


def rendered(html: Column) -> Column:
    @F.arrow_udf("string")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([render(x) for x in batch.to_pylist()], pa.string())

    return of(html)


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` with ``text``: the visible text of ``html`` as a screen shows it.
    Null and empty pages have empty text; broken markup never fails; pages of any
    length and depth are rendered whole, though the layout of quotes, lists and
    tables ends where ``NESTED`` are within each other; texts of drawings and
    formulas are shown.  Repeated rows are rendered each; an empty table gives an
    empty result; a column named ``text`` is replaced, all others stay."""
    small_batches(pages.sparkSession)
    return pages.withColumn("text", rendered(F.col("html")))
