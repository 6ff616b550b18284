"""The date normalisers for texts within pages, where a page stage runs anyway.

As ``functions.dates``, with a fuzzy reading of other forms last.  What such a
text leaves out comes from ``as_of``, never from the clock.
"""

from __future__ import annotations

import re
from datetime import UTC, datetime, timedelta

from dateutil import parser

from .dates import DAY_MONTH, DOTTED, ISO, MONTH_DAY, MONTHS

_ENGLISH = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
_WORD = re.compile(r"\b(" + "|".join(MONTHS) + r")\b")


def _utc(*parts: int) -> datetime | None:
    try:
        return datetime(*parts, tzinfo=UTC)
    except ValueError:
        return None


def _stated(text: str, strict: bool) -> tuple[bool, datetime | None]:
    """The date by the first stated form, and whether the search is over;
    ``strict``: also after an impossible day."""
    low = text.lower()
    if m := re.search(DAY_MONTH, low):
        if (d := _utc(int(m[3]), MONTHS[m[2]], int(m[1]))) or strict:
            return True, d
    if m := re.search(MONTH_DAY, low):
        if (d := _utc(int(m[3]), MONTHS[m[1]], int(m[2]))) or strict:
            return True, d
    if m := re.search(DOTTED, text):
        if (d := _utc(int(m[3]), int(m[2]), int(m[1]))) or strict:
            return True, d
    if m := re.search(ISO, text):
        if (d := _utc(*(int(g or 0) for g in m.groups()))) or strict:
            return True, d
    return False, None


def _fuzzy(text: str, as_of: datetime, **options) -> datetime | None:
    english = _WORD.sub(lambda m: _ENGLISH[MONTHS[m[1]] - 1], text.lower())
    try:
        out = parser.parse(english, default=as_of.replace(hour=0, minute=0, second=0, microsecond=0, tzinfo=None), **options)
    except (ValueError, OverflowError, TypeError):
        return None
    return out if out.tzinfo else out.replace(tzinfo=UTC)


def discovered(text: str | None, as_of: datetime) -> datetime | None:
    text = (text or "").strip() if isinstance(text, str) else ""
    if not text:
        return None
    done, out = _stated(text, strict=False)
    return out if done else _fuzzy(text, as_of, dayfirst=True, fuzzy=True)


def article(text: str | None, as_of: datetime) -> datetime | None:
    if not isinstance(text, str) or not text.strip():
        return None
    out = _fuzzy(re.sub(r"(\d{1,2})\.\s+", r"\1 ", text), as_of, dayfirst=False)
    return out.astimezone(UTC) if out else None


def listing(text: str | None, as_of: datetime) -> datetime | None:
    text = (text or "").strip()
    if not text:
        return None
    done, out = _stated(text, strict=True)
    ahead = 365
    if not done:
        out, ahead = _fuzzy(text, as_of, dayfirst=True, fuzzy=True), 0
    return out if out and timedelta(days=-ahead) <= as_of - out < timedelta(days=731) else None


def iso(d: datetime | None) -> str | None:
    return d.isoformat().replace("+00:00", "Z") if d else None
