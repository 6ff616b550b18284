"""Column functions for relevance scores from model answers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip, strip_code_fence

# Fixed values of the scoring scheme.
DIMENSIONS = ("d1_enforcement", "d2_organ", "d3_compliance", "d4_regulatory", "d5_mandate")
LEVELS = ((10, "Hoch"), (5, "Mittel"), (0, "Niedrig"))
PRACTICE_AREAS = ("Wirtschaftsstrafrecht", "Interne Untersuchungen", "ESG/Regulatory", "Investigativer Journalismus", "Sonstiges")
TOP_LEVEL, OTHER_AREA = "Hoch", "Sonstiges"
BONUS = 2
#: What is asked in each dimension where no schema says it.
DEFAULT_QUESTIONS = {
    "d1_enforcement": "Enforcement-Intensität (0=Keine Maßnahme, 1=Ankündigung, 2=Ermittlung, 3=Sanktion)",
    "d2_organ": "Organ-/Management-Exposition (0=Keine, 1=Indirekt, 2=Management, 3=Vorstand)",
    "d3_compliance": "Systemische Compliance-Relevanz (0=Einzelfall, 1=Operativ, 2=Compliance-Versagen, 3=Strukturell)",
    "d4_regulatory": "Regulatorischer Impact (0=Kein Bezug, 1=Routine, 2=Verschärfung, 3=Neues Gesetz)",
    "d5_mandate": "Mandatspotenzial (0=Kein Mandat, 1=Möglich, 2=Wahrscheinlich, 3=Typisch/Hoch)",
}


def questions(dimensions: dict) -> dict[str, str]:
    """A schema's dimensions as lines of a prompt: label, question, what each
    score means, and the rule of scoring, if there is one."""
    out = {}
    for name in DIMENSIONS:
        d = dimensions[name]
        scores = {str(k): v for k, v in d["scores"].items()}
        rule = f" Rule: {d['scoring_rule']}" if d.get("scoring_rule") else ""
        out[name] = f"{d['label']} - {d['question']} ({', '.join(f'{k}={scores[k]}' for k in sorted(scores))}){rule}"
    return out


def answer(text: Column) -> Column:
    """A model's answer as a variant object: without a code fence, as a whole or
    from its first brace to its last; null if that is no object."""
    bare = strip_code_fence(text)
    inner = F.regexp_extract(bare, r"(?s)(\{.*\})", 1)
    one, two = F.try_parse_json(bare), F.try_parse_json(F.when(inner != "", inner))
    is_object = lambda v: F.schema_of_variant(v).startswith("OBJECT")
    return F.when(is_object(one), one).when(is_object(two), two)


def envelope_text(body: Column) -> Column:
    """The text in a model endpoint's JSON answer: of the first message's first
    text output, else of the first choice."""
    v = F.try_parse_json(body)
    part = "struct<type: string, text: string>"
    outputs = F.from_json(F.get_json_object(body, "$.output"), f"array<struct<type: string, content: array<{part}>>>")
    message = F.get(F.filter(outputs, lambda o: o["type"] == "message"), 0)
    chosen = F.get(F.filter(message["content"], lambda c: c["type"] == "output_text"), 0)["text"]
    get = lambda path: F.try_variant_get(v, path, "string")
    return F.coalesce(chosen, get("$.choices[0].message.content"), get("$.choices[0].text"))


def strict_dimension(v: Column, name: str, at: str = "$") -> Column:
    """A whole number from 0 to 3, plain or as ``score`` of an object; anything
    else is null.  true and false count as 1 and 0, as they do in the answers'
    usual reader."""

    def number(path: str) -> Column:
        raw = F.try_variant_get(v, path, "variant")
        kind = F.schema_of_variant(raw)
        return F.when(kind.isin("BIGINT", "BOOLEAN"), F.try_variant_get(v, path, "int"))

    out = F.coalesce(number(f"{at}.{name}.score"), number(f"{at}.{name}"))
    return F.when(out.between(0, 3), out)


def lenient_dimension(v: Column, name: str, at: str = "$") -> Column:
    """A number cut to a whole one, or a text that is a whole number; 0 else."""
    raw = F.try_variant_get(v, f"{at}.{name}", "variant")
    kind = F.schema_of_variant(raw)
    text = F.try_variant_get(v, f"{at}.{name}", "string")
    value = F.when(kind == "STRING", F.when(strip(text).rlike(r"^[+-]?\d+$"), strip(text).try_cast("int"))).when(kind == "BOOLEAN", F.try_variant_get(v, f"{at}.{name}", "int")).otherwise(F.try_variant_get(v, f"{at}.{name}", "double").try_cast("int"))
    return F.coalesce(value, F.lit(0))


def total(values: list[Column], bonus: bool = False) -> Column:
    """Sum of the dimensions; with ``bonus`` two more where the first two are
    both 2 or more."""
    out = values[0]
    for v in values[1:]:
        out = out + v
    return out + F.when((values[0] >= 2) & (values[1] >= 2), BONUS).otherwise(0) if bonus else out


def level(score: Column, thresholds: dict[str, int] | None = None) -> Column:
    """Level of a total; ``thresholds`` may set hoch and mittel, 0 sets nothing."""
    own = {k.lower(): v for k, v in (thresholds or {}).items()}
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for least, name in LEVELS[:-1]:
        out = out.when(score >= (own.get(name.lower()) or least), name)
    return out.when(score.isNotNull(), LEVELS[-1][1])


def strict_area(v: Column, path: str = "$.practice_area") -> Column:
    area = strip(F.try_variant_get(v, path, "string"))
    return F.when(area.isin(*PRACTICE_AREAS), area)


def lenient_area(v: Column, path: str = "$.practice_area") -> Column:
    area = F.try_variant_get(v, path, "string")
    return F.when(area.isNull() | (area == ""), OTHER_AREA).otherwise(area)


def quality_status(score: Column, least: float = 0.3) -> Column:
    return F.when(F.coalesce(score, F.lit(1.0)) > least, "PASS").otherwise("WARN")


def gate_reason(found: Column) -> Column:
    """Reason why an item of some level goes; null for the top level."""
    return F.when(found.isNull() | (found != TOP_LEVEL), F.concat(F.lit("filtered: "), F.coalesce(found, F.lit("None"))))


def valid_enrichment(title: Column, summary: Column, language: Column, status: Column, statuses: tuple[str, ...] = ("PASS", "WARN", "FAIL")) -> Column:
    filled = lambda c: c.isNotNull() & (strip(c) != "")
    return filled(title) & filled(summary) & filled(language) & F.coalesce(status.isin(*statuses), F.lit(False))
