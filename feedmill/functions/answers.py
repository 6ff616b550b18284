"""Model answers that aren't clean JSON: a lenient reader, after the native one."""

from __future__ import annotations

import ast
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .scoring import answer
from .text import strip_code_fence


def read_object(text: str) -> dict | None:
    """An object written as JSON or as a Python literal; anything else is None."""
    for read in (json.loads, ast.literal_eval):
        try:
            found = read(text)
        except (ValueError, SyntaxError, TypeError, RecursionError, MemoryError):
            continue
        if isinstance(found, dict):
            return found
    return None


def braced_parts(text: str) -> Iterator[str]:
    """Outermost {...} parts of a text; braces within quotes don't count, and a
    backslash takes the next character's meaning."""
    depth, start, quote, skip = 0, 0, "", False
    for i, c in enumerate(text):
        if skip:
            skip = False
        elif c == "\\":
            skip = True
        elif quote:
            quote = "" if c == quote else quote
        elif depth and c in "\"'":
            quote = c
        elif c == "{":
            start = start if depth else i
            depth += 1
        elif c == "}" and depth:
            depth -= 1
            if not depth:
                yield text[start : i + 1]


def read_answer(text: str | None, inner: str = "content") -> dict | None:
    """The whole text as an object; else its first braced part that is one; else
    from the first brace to the last.  An object that only wraps another answer
    in ``inner`` gives that one."""
    text = (text or "").strip()
    candidates = [text, *braced_parts(text)]
    if "{" in text and "}" in text:
        candidates.append(text[text.index("{") : text.rindex("}") + 1])
    for c in candidates:
        if (found := read_object(c)) is not None:
            wrapped = found.get(inner)
            if isinstance(wrapped, str) and len(found) <= 2 and "{" in wrapped:
                return read_answer(wrapped, inner) or found
            return found
    return None


def plain_text(value: object, skip: tuple[str, ...] = ("reasoning",)) -> str:
    """Texts in nested lists and objects, one a line, without parts of a type
    that is skipped."""
    if isinstance(value, str):
        return value
    if isinstance(value, dict):
        if value.get("type") in skip:
            return ""
        value = [v for k, v in value.items() if k not in ("type", *skip)]
    return "\n".join(t for v in value if (t := plain_text(v, skip))) if isinstance(value, list) else ""


def lenient_json(text: Column) -> Column:
    @F.arrow_udf("string")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [read_answer(x) if x else None for x in batch.to_pylist()]
            yield pa.array([None if f is None else json.dumps(f, default=str) for f in found], pa.string())

    return of(text)


def any_answer(text: Column) -> Column:
    """The answer as a variant object, natively where possible; only other texts
    are read leniently."""
    native = answer(text)
    rest = lenient_json(F.when(native.isNull(), strip_code_fence(text)))
    return F.coalesce(native, F.try_parse_json(rest))
