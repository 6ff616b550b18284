"""Keyword matching as array functions: no row is multiplied, order is kept."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let


def matched(text: Column, keywords: list[str]) -> Column:
    """Keywords that occur in the text, whatever the case, in their order."""
    if not keywords:
        return F.array().cast("array<string>")
    every = F.array(*[F.lit(k) for k in keywords])
    return let(F.lower(F.coalesce(text, F.lit(""))), lambda low: F.filter(every, lambda k: F.contains(low, F.lower(k))))


def any_of(text: Column, keywords: list[str]) -> Column:
    """Whether some keyword occurs; without keywords none does."""
    low, out = F.lower(F.coalesce(text, F.lit(""))), F.lit(False)
    for k in keywords:
        out = out | F.contains(low, F.lit(k.lower()))
    return out


def matched_categories(text: Column, categories: dict[str, list[str]]) -> Column:
    """Names of categories with a keyword in the text; ones without keywords
    never match."""
    names = [F.when(any_of(text, ks), F.lit(name)) for name, ks in categories.items()]
    return F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")


def allowed(text: Column, categories: Column, keywords: dict[str, list[str]]) -> Column:
    """Gate after extraction: items without categories pass, and so do those
    with a category that has no keywords or one of whose keywords occurs."""
    out = F.coalesce(F.size(categories) == 0, F.lit(True))
    for name, ks in keywords.items():
        out = out | (F.array_contains(categories, name) & (any_of(text, ks) if ks else F.lit(True)))
    return out


def distinct_ignoring_case(words: Column) -> Column:
    """First spelling of each word, in order; null if there is none."""
    step = lambda acc, w: F.when(F.exists(acc, lambda y: F.lower(y) == F.lower(w)), acc).otherwise(F.array_append(acc, w))
    out = F.aggregate(words, F.array().cast("array<string>"), step)
    return F.when(F.size(out) > 0, out)
