"""Column functions on text: clean-up, gates and prompt parts."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Phrases of a model that answers about its task instead of doing it.
META_RESPONSE = (
    r"I don'?t have",
    r"I cannot",
    r"I can'?t",
    r"please (provide|paste|share|send)",
    r"no (article|text|content) (text|provided|available)",
    r"article text is (missing|not provided|unavailable)",
    r"full article",
    r"which do you prefer",
    r"once you provide",
    r"if you want,? I can",
)

#: Names of languages by code.
LANGUAGE_NAMES = {
    "de": "German", "en": "English", "fr": "French", "es": "Spanish", "it": "Italian", "nl": "Dutch", "pl": "Polish", "pt": "Portuguese",
    "ru": "Russian", "ja": "Japanese", "zh": "Chinese", "cs": "Czech", "da": "Danish", "fi": "Finnish", "hu": "Hungarian", "no": "Norwegian",
    "sv": "Swedish", "tr": "Turkish", "uk": "Ukrainian", "ar": "Arabic", "he": "Hebrew", "ko": "Korean", "th": "Thai", "vi": "Vietnamese",
}

#: Longest part of a text that goes into each kind of prompt.
PROMPT_CHARS = {"enrich": 4500, "summary": 4000, "score": 3000, "language": 5000, "title": 100, "abstract": 300}

SHORT_CHARS = 500


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: Characters that are white space.
WHITE = "".join(map(chr, (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def strip(c: Column) -> Column:
    """White space of any kind taken off both ends."""
    return F.btrim(c, F.lit(WHITE))


def words(c: Column) -> Column:
    return F.filter(F.split(strip(c), r"(?U)\s+"), lambda w: w != "")


def normalize_title(title: Column, max_words: int = 15) -> Column:
    """One space between words, at most ``max_words`` of them, then an ellipsis;
    null and empty give an empty title."""
    w = words(F.coalesce(title, F.lit("")))
    short = F.array_join(F.slice(w, 1, max_words), " ")
    return F.when(F.size(w) > max_words, F.concat(short, F.lit("…"))).otherwise(short)


def json_escape(c: Column) -> Column:
    out = F.coalesce(c, F.lit(""))
    for raw, safe in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        out = F.replace(out, F.lit(raw), F.lit(safe))
    return out


def strip_code_fence(c: Column) -> Column:
    """A leading fence line and a closing fence taken off."""
    s = strip(c)
    opened = F.regexp_replace(s, r"^```[^\n]*\n?", "")
    return F.when(s.startswith("```"), strip(F.regexp_replace(opened, r"\s*```\s*$", ""))).otherwise(s)


def truncate(c: Column, kind: str) -> Column:
    return F.left(c, F.lit(PROMPT_CHARS[kind]))


def is_meta_response(c: Column) -> Column:
    return F.coalesce(c.rlike("(?i)" + "|".join(META_RESPONSE)), F.lit(False))


def is_short(c: Column, limit: int = SHORT_CHARS) -> Column:
    return F.length(strip(F.coalesce(c, F.lit("")))) <= limit


def language_name(code: Column) -> Column:
    known = F.create_map(*[F.lit(x) for kv in LANGUAGE_NAMES.items() for x in kv])
    return F.coalesce(F.element_at(known, code), code)


def decode_body(raw: Column) -> Column:
    """Bytes as UTF-8; invalid sequences become replacement characters."""
    return F.make_valid_utf8(raw.cast("string"))


def kept_lines(text: Column, long_line: int = 60, header: int = 10) -> Column:
    """Lines that read like prose: long ones, ones that end a sentence, and
    capital headers; each stripped."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), r"\R"), strip)
    prose = lambda s: (F.length(s) > long_line) | s.rlike(r"[.?!]$") | ((F.upper(s) == s) & (F.lower(s) != s) & (F.length(s) > header))
    return F.filter(lines, lambda s: (s != "") & prose(s))


def prepare(text: Column, min_chars: int = 600, min_ratio: float = 0.25, margin: float = 0.10) -> Column:
    """Struct of the prepared text, its ratio to the raw one, the status (PASS,
    WARN or FAIL) and the reason of a failure."""
    raw = F.coalesce(text, F.lit(""))

    def judged(prepared: Column) -> Column:
        ratio = F.when(F.length(raw) > 0, F.length(prepared).cast("double") / F.length(raw)).otherwise(F.lit(0.0))
        # Nothing is kept of a blank text, so only then it needs a look.
        blank = (prepared == "") & (strip(raw) == "")
        status = F.when((F.length(prepared) < min_chars) | (ratio < min_ratio) | blank, "FAIL").when(ratio < min_ratio + margin, "WARN").otherwise("PASS")
        reason = F.when(blank, "article_text_empty").when(status == "FAIL", "article_text_insufficient")
        return F.struct(prepared.alias("text"), ratio.alias("ratio"), status.alias("status"), reason.alias("reason"))

    return let(F.array_join(kept_lines(text), "\n\n"), judged)


def enrich_prompt(title: Column, text: Column, dimensions: dict[str, str], areas: tuple[str, ...] | list[str] = ()) -> Column:
    """Prompt that asks for a title, a summary, a score from 0 to 3 for each
    dimension and, if areas are given, one of these, as JSON."""
    asked = "\n".join(f"{k}: {q}" for k, q in dimensions.items())
    area = f"\n\npractice_area is one of: {', '.join(areas)}" if areas else ""
    head = F.lit(f"Answer with one JSON object that has title, summary, quality_score, relevance_dimensions{' and practice_area' if areas else ''}. Score each dimension from 0 to 3.\n\n{asked}{area}\n\nTitle: ")
    return F.concat(head, F.coalesce(title, F.lit("")), F.lit("\n\nText: "), F.coalesce(truncate(text, "enrich"), F.lit("")))


def score_prompt(text: Column, dimensions: dict[str, str]) -> Column:
    asked = "\n".join(f"- {k}: {q}" for k, q in dimensions.items())
    return F.concat(F.lit(f"Score the article from 0 to 3 in each of\n{asked}\nand answer as JSON.\n\n"), F.coalesce(truncate(text, "score"), F.lit("")))


def summary_prompt(text: Column, language: str = "Deutsch") -> Column:
    return F.concat(F.lit(f"Summarise this article in {language} in three sentences:\n\n"), F.coalesce(truncate(text, "summary"), F.lit("")))


def usable_pattern(pattern: str) -> bool:
    """Whether a pattern compiles; those that don't match nothing."""
    try:
        re.compile(pattern)
    except re.error:
        return False
    return True
