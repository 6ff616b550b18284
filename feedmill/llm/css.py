"""What style sheets say about ``display`` and ``visibility`` of elements.

Sheets are read with nested blocks: media queries are evaluated for a screen,
rules may be nested in rules, other at-rules don't style elements.  Selectors
have types, classes, ids, attributes, the four combinators and the pseudo-classes
that a still page decides; others match nothing.  Declarations compete by
importance, style attribute, layer, specificity and order.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from operator import ge, gt, le, lt

#: The screen that media queries are asked about, in pixels.
SCREEN = {"width": 1280.0, "height": 800.0, "device-width": 1280.0, "device-height": 800.0}
#: Other features of it.
FEATURES = {
    "orientation": "landscape", "prefers-color-scheme": "light", "prefers-reduced-motion": "no-preference", "prefers-contrast": "no-preference",
    "hover": "hover", "any-hover": "hover", "pointer": "fine", "any-pointer": "fine", "scripting": "enabled", "update": "fast", "grid": "0", "forced-colors": "none",
}
UNITS = {"px": 1.0, "em": 16.0, "rem": 16.0, "pt": 4 / 3, "in": 96.0, "cm": 96 / 2.54, "mm": 96 / 25.4, "": 1.0}
#: Words that ``display`` takes.
DISPLAY = frozenset(
    "none block inline inline-block flex inline-flex grid inline-grid table inline-table table-row table-cell table-row-group table-header-group table-footer-group table-column table-column-group table-caption "
    "list-item contents flow flow-root run-in ruby ruby-base ruby-text math initial inherit unset revert revert-layer -webkit-box -webkit-inline-box -webkit-flex -ms-flexbox -moz-box".split()
)
VISIBILITY = frozenset("visible hidden collapse initial inherit unset revert revert-layer".split())

_TOKEN = re.compile(r"\"(?:[^\"\\\n]|\\.)*+(?:\"|$|(?=\n))|'(?:[^'\\\n]|\\.)*+(?:'|$|(?=\n))|\\.|[{}();\[\]]", re.S | re.M)
_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)|<!--|-->", re.S)
_NAME = r"(?:[\w-]|[^\x00-\x7f]|\\.)+"
_PART = re.compile(rf"(?P<tag>\*|{_NAME})|\.(?P<cls>{_NAME})|#(?P<id>{_NAME})|\[\s*(?P<attr>{_NAME})\s*(?:(?P<op>[~|^$*]?=)\s*(?:\"(?P<v1>[^\"]*)\"|'(?P<v2>[^']*)'|(?P<v3>[^\]\s]+))\s*(?P<flag>[is])?\s*)?\]|(?P<amp>&)|(?P<pseudo>::?)(?P<name>[\w-]+)(?P<args>\()?", re.S | re.I)


def _split(text: str, at: str) -> list[str]:
    """Parts of a text between the marks ``at`` outside brackets and strings."""
    out, deep, start, quote = [], 0, 0, ""
    low = text.lower()
    i = 0
    while i < len(text):
        c = text[i]
        if quote:
            quote = "" if c == quote else quote
        elif c in "\"'":
            quote = c
        elif c in "([":
            deep += 1
        elif c in ")]":
            deep -= 1
        elif deep == 0 and low.startswith(at, i):
            out.append(text[start:i])
            i += len(at)
            start = i
            continue
        i += 1
    return [*out, text[start:]]


def _pixels(text: str) -> float | None:
    m = re.fullmatch(r"\s*([+-]?\d*\.?\d+)\s*([a-z]*)\s*", text)
    return float(m[1]) * UNITS[m[2]] if m and m[2] in UNITS else None


def _feature(text: str) -> bool | None:
    """One media feature; None: unknown."""
    name, colon, value = (x.strip() for x in text.partition(":"))
    if colon:
        edge, bare = (name[:4], name[4:]) if name[:4] in ("min-", "max-") else ("", name)
        if bare in SCREEN:
            if (p := _pixels(value)) is None:
                return None
            return SCREEN[bare] >= p if edge == "min-" else SCREEN[bare] <= p if edge == "max-" else SCREEN[bare] == p
        return FEATURES[bare] == value if bare in FEATURES and not edge else None
    m = re.fullmatch(r"([^<>=]+)([<>]=?|=)([^<>=]+)(?:([<>]=?)([^<>=]+))?", text)
    if not m:
        return True if name in SCREEN or name == "color" else FEATURES[name] not in ("none", "0", "no-preference") if name in FEATURES else None
    signs = {"<": lt, "<=": le, ">": gt, ">=": ge, "=": lambda a, b: a == b}
    known = lambda s: SCREEN.get(s.strip(), _pixels(s))
    a, b, c = known(m[1]), known(m[3]), known(m[5]) if m[5] else 0.0
    if a is None or b is None or c is None:
        return None
    return signs[m[2]](a, b) and (not m[5] or signs[m[4]](b, c))


def _condition(text: str, feature) -> bool | None:
    text = text.strip()
    if len(parts := _split(text, " and ")) > 1:
        found = [_condition(p, feature) for p in parts]
        return False if False in found else None if None in found else True
    if len(parts := _split(text, " or ")) > 1:
        found = [_condition(p, feature) for p in parts]
        return True if True in found else None if None in found else False
    if re.match(r"not[\s(]", text):
        found = _condition(text[3:], feature)
        return None if found is None else not found
    if text.startswith("(") and text.endswith(")"):
        inner = text[1:-1].strip()
        return _condition(inner, feature) if inner.startswith(("(", "not ", "not(")) else feature(inner)
    return feature(text) if feature is not _feature else None


def media(query: str) -> bool:
    """Whether a list of media queries is true for the screen; an empty one is."""

    def one(q: str) -> bool:
        q = re.sub(r"\s+", " ", q.strip().lower())
        m = re.fullmatch(r"(?:(not|only) )?([a-z-]+)(?: and (.*))?", q)
        if m and m[2] != "not":
            rest = _condition(m[3], _feature) if m[3] else True
            found = False if m[2] not in ("all", "screen") else rest
            return False if found is None else found != (m[1] == "not")
        return _condition(q, _feature) is True

    return not query.strip() or any(map(one, _split(query, ",")))


def supports(condition: str) -> bool:
    """A browser of today supports what a sheet asks for."""
    return _condition(re.sub(r"\s+", " ", condition.strip().lower()), lambda _: True) is not False


@dataclass
class Compound:
    """What one element must be like."""

    tag: str = ""
    need: frozenset[str] = frozenset()
    attrs: list[tuple] = field(default_factory=list)
    any_of: list[list[Selector]] = field(default_factory=list)
    none_of: list[list[Selector]] = field(default_factory=list)
    places: list = field(default_factory=list)
    never: bool = False


@dataclass
class Selector:
    """Compounds from the last to the first, with the combinator before each."""

    parts: list[tuple[str, Compound]]
    weight: tuple[int, int, int]


def _nth(text: str):
    text = {"odd": "2n+1", "even": "2n"}.get(text.strip().lower(), text.strip().lower()).replace(" ", "")
    m = re.fullmatch(r"([+-]?\d*)n([+-]\d+)?|([+-]?\d+)", text)
    if not m:
        return None
    a, b = (0, int(m[3])) if m[3] else (int(m[1] + "1" if m[1] in ("", "+", "-") else m[1]), int(m[2] or 0))
    return lambda i: (i - b) % a == 0 and (i - b) // a >= 0 if a else i == b


def _plain(name: str) -> str:
    return re.sub(r"\\(.)", r"\1", name) if "\\" in name else name


def selector(text: str, parent: list[Selector] | None = None) -> Selector | None:
    """One selector; None if it isn't well formed.  ``parent``: the selectors
    of the rule that it is nested in."""
    parts, comb, weight = [], "", [0, 0, 0]
    text = text.strip()
    if parent is not None and "&" not in text:
        text = "& " + text
    at = 0
    while at < len(text):
        c = Compound()
        need, start = set(), at
        while m := _PART.match(text, at):
            if m["tag"] and at != start:
                return None
            at = m.end()
            if m["tag"]:
                c.tag = "" if m["tag"] == "*" else _plain(m["tag"]).lower()
                weight[2] += m["tag"] != "*"
            elif m["cls"] or m["id"]:
                need.add("." + _plain(m["cls"]) if m["cls"] else "#" + _plain(m["id"]))
                weight[1 if m["cls"] else 0] += 1
            elif m["attr"]:
                c.attrs.append((m["attr"].lower(), m["op"], m["v1"] if m["v1"] is not None else m["v2"] if m["v2"] is not None else m["v3"], (m["flag"] or "").lower() == "i"))
                weight[1] += 1
            elif m["amp"]:
                if parent:
                    c.any_of.append(parent)
                    weight = [a + b for a, b in zip(weight, max(p.weight for p in parent))]
            else:
                name, inner = m["name"].lower(), ""
                if m["args"]:
                    deep, end = 1, at
                    while end < len(text) and deep:
                        deep += {"(": 1, ")": -1}.get(text[end], 0)
                        end += 1
                    inner, at = text[at : end - 1], end
                if name in ("not", "is", "where", "matches", "-webkit-any") and m["pseudo"] == ":":
                    found = [selector(x, None) for x in _split(inner, ",")]
                    if name == "not" and None in found:
                        return None
                    found = [f for f in found if f]
                    (c.none_of if name == "not" else c.any_of).append(found)
                    if name != "where" and found:
                        weight = [a + b for a, b in zip(weight, max(f.weight for f in found))]
                    continue
                weight[1 if m["pseudo"] == ":" else 2] += 1
                nth = {"first-child": "1", "nth-child": inner, "last-child": "1", "nth-last-child": inner}
                if name == "root":
                    c.places.append(("root", None))
                elif name == "only-child":
                    c.places += [("child", _nth("1")), ("last", _nth("1"))]
                elif name in nth and (f := _nth(nth[name])):
                    c.places.append(("last" if "last" in name else "child", f))
                elif name in ("link", "any-link"):
                    c.attrs.append(("href", None, None, False))
                else:
                    c.never = True  # a state, or a part that is no element
        if at == start:
            return None
        c.need = frozenset(need)
        parts.append((comb, c))
        m = re.compile(r"\s*([>+~])\s*|\s+").match(text, at)
        if m is None and at < len(text):
            return None
        if m:
            comb, at = m[1] or " ", m.end()
            if at >= len(text):
                return None
    # Each compound's combinator tells how the one before it stands to it.
    turned = [(parts[i][0], parts[i][1]) for i in range(len(parts) - 1, -1, -1)]
    return Selector(turned, tuple(weight)) if parts and len(parts) <= 200 else None


def own_names(node) -> set[str]:
    names = {"." + c for c in node.attrs.get("class", "").split()}
    if "id" in node.attrs:
        names.add("#" + node.attrs["id"])
    return names


def _attribute(node, name, op, value, blind) -> bool:
    if name not in node.attrs:
        return False
    if op is None:
        return True
    have = node.attrs[name]
    if blind:
        have, value = have.lower(), value.lower()
    if op == "=":
        return have == value
    if op == "~=":
        return value in have.split()
    if op == "|=":
        return have == value or have.startswith(value + "-")
    return value != "" and (have.startswith(value) if op == "^=" else have.endswith(value) if op == "$=" else value in have)


def _fits(node, c: Compound) -> bool:
    if c.never or (c.tag and c.tag != node.tag) or (c.need and not c.need <= own_names(node)):
        return False
    if not all(_attribute(node, *a) for a in c.attrs):
        return False
    for kind, test in c.places:
        if node.parent is None:
            if kind == "root":
                continue
            return False
        if kind == "root" or not test(node.place + 1 if kind == "child" else len(node.parent.elements) - node.place):
            return False
    return all(any(matches(node, s) for s in some) for some in c.any_of) and not any(matches(node, s) for some in c.none_of for s in some)


def matches(node, s: Selector, i: int = 0) -> bool:
    comb, c = s.parts[i]
    if not _fits(node, c):
        return False
    if i + 1 == len(s.parts):
        return True
    if comb == ">":
        return node.parent is not None and matches(node.parent, s, i + 1)
    if comb == " ":
        above = node.parent
        while above is not None:
            if matches(above, s, i + 1):
                return True
            above = above.parent
        return False
    if node.parent is None:
        return False
    before = node.parent.elements[: node.place]
    return any(matches(x, s, i + 1) for x in (before[-1:] if comb == "+" else before))


def declarations(text: str) -> list[tuple[str, str, bool]]:
    """(property, value, important) of ``display`` and ``visibility``."""
    out = []
    for one in _split(text, ";") if ";" in text else [text]:
        name, colon, value = one.partition(":")
        name, value = name.strip().lower(), value.strip().lower()
        if not colon or name not in ("display", "visibility"):
            continue
        important = re.search(r"!\s*important$", value)
        value = value[: important.start()].strip() if important else value
        words = value.split()
        if words and all(w in (DISPLAY if name == "display" else VISIBILITY) for w in words) and (len(words) == 1 or name == "display" and "none" not in words):
            out.append((name, words[0], bool(important)))
    return out


@dataclass
class _Block:
    kind: str  # sheet, group, rule, skip
    selectors: list[Selector] | None
    layer: int | None


class Cascade:
    """Rules of a page's style sheets, found by what their last compound needs."""

    def __init__(self) -> None:
        self.rules: dict[str, list[tuple]] = {}
        self.layers: dict[str, int] = {}
        self.count = 0

    def __bool__(self) -> bool:
        return bool(self.rules)

    def add(self, css: str) -> None:
        css = _COMMENT.sub(" ", css)
        stack, start, deep = [_Block("sheet", None, None)], 0, 0
        for m in _TOKEN.finditer(css):
            t = m[0]
            if t in "([":
                deep += 1
            elif t in ")]":
                deep = max(0, deep - 1)
            elif t == "{":
                stack.append(self._opened(css[start : m.start()].strip(), stack[-1]))
                start, deep = m.end(), 0
            elif t == "}":
                self._declared(css[start : m.start()], stack[-1])
                if len(stack) > 1:
                    stack.pop()
                start, deep = m.end(), 0
            elif t == ";" and not deep:
                said = css[start : m.start()].strip()
                if said.lower().startswith("@layer"):
                    for name in said[6:].split(","):
                        self.layers.setdefault(name.strip(), len(self.layers))
                self._declared(said, stack[-1])
                start = m.end()
        self._declared(css[start:], stack[-1])

    def _opened(self, prelude: str, above: _Block) -> _Block:
        if above.kind == "skip":
            return above
        if prelude.startswith("@"):
            name, _, rest = prelude[1:].partition(" ") if "(" not in prelude.split(" ")[0] else (prelude[1:].partition("(")[0], "", "(" + prelude.partition("(")[2])
            name = name.lower()
            layer = above.layer
            if name == "layer":
                layer = self.layers.setdefault(rest.strip() or f" {self.count}{len(self.layers)}", len(self.layers))
            applies = name == "layer" or name == "media" and media(rest) or name == "supports" and supports(rest)
            return _Block("group" if above.selectors is None else "rule", above.selectors, layer) if applies else _Block("skip", None, None)
        found = [selector(s, above.selectors) for s in _split(prelude, ",")]
        if not prelude or None in found:  # one that is wrong takes the whole list along
            return _Block("skip", None, None)
        return _Block("rule", found, above.layer)

    def _declared(self, text: str, block: _Block) -> None:
        if block.kind != "rule" or ":" not in text:
            return
        for name, value, important in declarations(text):
            layer = len(self.layers) + 10**6 if block.layer is None else block.layer
            for s in block.selectors:
                last = s.parts[0][1]
                key = min(last.need, default=None) or last.tag or "*"
                self.count += 1
                self.rules.setdefault(key, []).append((s, name, value, (important, False, -layer if important else layer, s.weight, self.count)))

    def style(self, node) -> dict[str, str]:
        """The winning values of ``display`` and ``visibility``, where an author's
        sheet or the style attribute says something."""
        best: dict[str, tuple] = {}
        if self.rules:
            for key in (*own_names(node), node.tag, "*"):
                for s, name, value, rank in self.rules.get(key, ()):
                    if (name not in best or rank > best[name][0]) and matches(node, s):
                        best[name] = (rank, value)
        if "style" in node.attrs:
            for i, (name, value, important) in enumerate(declarations(_COMMENT.sub(" ", node.attrs["style"]))):
                rank = (important, True, 0, (0, 0, 0), i)
                if name not in best or rank > best[name][0]:
                    best[name] = (rank, value)
        return {name: value for name, (_, value) in best.items() if not value.startswith("revert")}
