"""A plain HTML tree, as a lenient parser without implied end tags sees it, and
the part of CSS selectors that sources use.

An end tag closes the nearest open element of its name and all within; a stray
one is ignored; void elements never stay open.
"""

from __future__ import annotations

import re
from functools import lru_cache
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input keygen link menuitem meta param source track wbr".split())


class Node:
    __slots__ = ("tag", "attrs", "parent", "children")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None) -> None:
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []

    def get(self, name: str, default: str | None = None) -> str | None:
        return self.attrs.get(name, default)

    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()

    def walk(self):
        """Elements below this one, in document order."""
        todo = [c for c in reversed(self.children) if isinstance(c, Node)]
        while todo:
            x = todo.pop()
            yield x
            todo.extend(c for c in reversed(x.children) if isinstance(c, Node))

    def strings(self, skip: frozenset[str] = frozenset()):
        """Texts below this element, in order, but for elements of ``skip``."""
        todo: list[Node | str] = list(reversed(self.children))
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                yield x
            elif x.tag not in skip:
                todo.extend(reversed(x.children))

    def text(self, sep: str = "", strip: bool = False, skip: frozenset[str] = frozenset()) -> str:
        parts = self.strings(skip)
        return sep.join(p for s in parts if (p := s.strip())) if strip else sep.join(parts)

    def sibling(self, step: int) -> Node | str | None:
        if self.parent is None:
            return None
        around = self.parent.children
        at = next(i for i, c in enumerate(around) if c is self) + step
        return around[at] if 0 <= at < len(around) else None

    def find(self, *tags: str, **attrs: str) -> Node | None:
        return next(self.find_all(*tags, **attrs), None)

    def find_all(self, *tags: str, **attrs: str):
        """Elements of some tags (all, if none) whose attributes have these
        values; underscores in names stand for hyphens."""
        wanted = [(k.replace("_", "-"), v) for k, v in attrs.items()]
        for x in self.walk():
            if (not tags or x.tag in tags) and all(x.attrs.get(k) == v for k, v in wanted):
                yield x


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("", {}, None)
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in reversed(attrs)}, self.open[-1])
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.open.pop()

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


def parse(html: str | None) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def free(root: Node) -> None:
    """Cut the tree's ties to parents, so that it goes with its last use and doesn't
    wait for the collector of cycles."""
    for x in root.walk():
        x.parent = None


_PART = re.compile(r"""([a-zA-Z][\w-]*|\*)|\.([\w-]+)|\#([\w-]+)|\[\s*([\w:-]+)\s*(?:([*^$~|]?=)\s*(?:"([^"]*)"|'([^']*)'|([^\]\s]+))\s*)?\]""")


def _value_test(op: str, want: str):
    return {
        "=": lambda v: v == want,
        "*=": lambda v: bool(want) and want in v,
        "^=": lambda v: bool(want) and v.startswith(want),
        "$=": lambda v: bool(want) and v.endswith(want),
        "~=": lambda v: want in v.split(),
        "|=": lambda v: v == want or v.startswith(want + "-"),
    }[op]


@lru_cache(maxsize=512)
def compile_selector(selector: str):
    """Alternatives, each a chain of (combinator, tests); None where the text
    isn't a selector of this kind."""
    out = []
    for one in selector.split(","):
        chain, combinator, rest = [], "", one.strip()
        if not rest:
            return None
        while rest:
            tests, at = [], 0
            while (m := _PART.match(rest, at)) is not None:
                tag, cls, ident, attr, op, *values = m.groups()
                if tag:
                    tests.append((lambda t: lambda x: t == "*" or x.tag == t)(tag.lower()))
                elif cls:
                    tests.append((lambda c: lambda x: c in x.classes())(cls))
                elif ident:
                    tests.append((lambda i: lambda x: x.get("id") == i)(ident))
                elif op:
                    tests.append((lambda a, f: lambda x: a in x.attrs and f(x.attrs[a]))(attr.lower(), _value_test(op, next((v for v in values if v is not None), ""))))
                else:
                    tests.append((lambda a: lambda x: a in x.attrs)(attr.lower()))
                at = m.end()
            if not tests:
                return None
            chain.append((combinator, tests))
            rest = rest[at:]
            m = re.match(r"\s*>\s*|\s+", rest)
            if rest and m is None:
                return None
            combinator = ">" if m and ">" in m[0] else " "
            rest = rest[m.end() :] if m else rest
        out.append(chain)
    return out


def _matches(x: Node, chain: list, top: Node) -> bool:
    combinator, tests = chain[-1]
    if not all(t(x) for t in tests):
        return False
    if len(chain) == 1:
        return True
    p = x.parent
    while p is not None and p.tag:
        if _matches(p, chain[:-1], top):
            return True
        if combinator == ">":
            return False
        p = p.parent
    return False


def select(node: Node, selector: str) -> list[Node]:
    """Elements below ``node`` that a selector matches, in document order; none
    for selectors that aren't understood."""
    alternatives = compile_selector(selector)
    return [x for x in node.walk() if any(_matches(x, c, node) for c in alternatives)] if alternatives else []


def select_one(node: Node, selector: str) -> Node | None:
    alternatives = compile_selector(selector)
    return next((x for x in node.walk() if any(_matches(x, c, node) for c in alternatives)), None) if alternatives else None
