"""Three normalisers of dates in texts, as their callers need them.

``discovered``: day first, offsets of ISO times are ignored.  ``article``: month
first, offsets count.  ``listing``: as discovered, an impossible day gives nothing
at once, and only a window around ``as_of`` is accepted.  All give a timestamp
or null; texts outside the stated forms give null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Months in English and German, full and short.
MONTHS = {
    "january": 1, "february": 2, "march": 3, "april": 4, "may": 5, "june": 6, "july": 7, "august": 8, "september": 9, "october": 10, "november": 11, "december": 12,
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "jun": 6, "jul": 7, "aug": 8, "sep": 9, "oct": 10, "nov": 11, "dec": 12,
    "januar": 1, "februar": 2, "märz": 3, "mai": 5, "juni": 6, "juli": 7, "oktober": 10, "dezember": 12, "mär": 3, "okt": 10, "dez": 12,
}
_NAMES = "|".join(sorted(MONTHS, key=lambda m: (-len(m), m)))
#: The word ends where no letter follows.
DAY_MONTH = rf"(?<!\d)(\d{{1,2}})\.?\s+({_NAMES})\s+(\d{{4}})"
MONTH_DAY = rf"({_NAMES})\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}})"
DOTTED = r"(\d{1,2})\.(\d{1,2})\.(\d{4})"
ISO = r"(\d{4})[-/](\d{2})[-/](\d{2})(?:[T ](\d{2}):(\d{2}):(\d{2}))?"
OFFSET = r"\d{2}:\d{2}:\d{2}(?:\.\d+)?\s*([+-])(\d{2}):?(\d{2})"
SLASHED = r"(?<!\d)(\d{1,2})/(\d{1,2})/(\d{4})"


def _month(name: Column) -> Column:
    known = F.create_map(*[F.lit(x) for kv in MONTHS.items() for x in kv])
    return F.element_at(known, name)


def _int(c: Column) -> Column:
    return c.try_cast("int")


def _at(y: Column, m: Column, d: Column, *clock: Column) -> Column:
    """A timestamp, null for impossible days and times."""
    h, i, s = clock or (F.lit(0), F.lit(0), F.lit(0))
    return F.try_make_timestamp(y, m, d, h, i, s.cast("decimal(8,6)"))


def _forms(text: Column) -> list[tuple[Column, Column]]:
    """For each form in order: whether it is there, and its timestamp."""
    low = F.lower(text)
    part = F.regexp_extract
    a = _at(_int(part(low, DAY_MONTH, 3)), _month(part(low, DAY_MONTH, 2)), _int(part(low, DAY_MONTH, 1)))
    b = _at(_int(part(low, MONTH_DAY, 3)), _month(part(low, MONTH_DAY, 1)), _int(part(low, MONTH_DAY, 2)))
    c = _at(_int(part(text, DOTTED, 3)), _int(part(text, DOTTED, 2)), _int(part(text, DOTTED, 1)))
    zero = lambda k: F.coalesce(_int(part(text, ISO, k)), F.lit(0))
    d = _at(_int(part(text, ISO, 1)), _int(part(text, ISO, 2)), _int(part(text, ISO, 3)), zero(4), zero(5), zero(6))
    return [(low.rlike(DAY_MONTH), a), (low.rlike(MONTH_DAY), b), (text.rlike(DOTTED), c), (text.rlike(ISO), d)]


def _slashed(text: Column, day_first: bool) -> Column:
    """Numbers with slashes: the usual order, the other where that is no day."""
    x, y, year = (_int(F.regexp_extract(text, SLASHED, k)) for k in (1, 2, 3))
    one, two = _at(year, y, x), _at(year, x, y)
    return F.coalesce(one, two) if day_first else F.coalesce(two, one)


def discovered(text: Column) -> Column:
    return F.coalesce(*[t for _, t in _forms(text)], _slashed(text, True))


def article(text: Column) -> Column:
    """Dotted numbers are read month first, as far as that is a month."""
    forms = _forms(text)
    x, y, year = (_int(F.regexp_extract(text, DOTTED, k)) for k in (1, 2, 3))
    dotted = F.coalesce(_at(year, x, y), _at(year, y, x))
    sign = F.when(F.regexp_extract(text, OFFSET, 1) == "-", -1).otherwise(1)
    minutes = sign * (F.coalesce(_int(F.regexp_extract(text, OFFSET, 2)), F.lit(0)) * 60 + F.coalesce(_int(F.regexp_extract(text, OFFSET, 3)), F.lit(0)))
    iso = F.timestamp_add("MINUTE", -minutes, forms[3][1])
    return F.when(forms[3][0], iso).otherwise(F.coalesce(forms[0][1], forms[1][1], dotted, _slashed(text, False)))


def listing(text: Column, as_of: Column, back: int = 730, ahead: int = 365) -> Column:
    """Days since the date from ``-ahead`` (other forms: from 0) to ``back``."""
    out, stated = F.when(F.lit(False), F.lit(None).cast("timestamp")), F.lit(False)
    for there, value in _forms(text):
        out, stated = out.when(there, value), stated | there
    out = out.otherwise(_slashed(text, True))
    age = F.floor((F.unix_timestamp(as_of) - F.unix_timestamp(out)) / 86400)
    return F.when((age >= F.when(stated, -ahead).otherwise(0)) & (age <= back), out)


def iso_or_unknown(c: Column) -> Column:
    return F.coalesce(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("unknown"))


def parse_iso(c: Column) -> Column:
    """Timestamp of an ISO text; ``unknown`` and what isn't one give null."""
    return F.when(c != "unknown", F.try_to_timestamp(c))


def filename_time(c: Column) -> Column:
    """Run time in a results file's name."""
    return F.try_to_timestamp(F.regexp_extract(c, r"results_(\d{4}-\d{2}-\d{2}T\d{6})Z\.json$", 1), F.lit("yyyy-MM-dd'T'HHmmss"))
