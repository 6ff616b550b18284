import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names clash with results and internal ones.
CLASH = "score string, size string, keep string, digest string, fp string, target string, taken string, block string, row string, file string"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) rows."""

    def make(rows, clash=False):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        if clash:
            return spark.createDataFrame([(*r, *["x"] * 10) for r in full], f"{SCHEMA}, {CLASH}")
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture
def awkward():
    """Nulls, empty and very long texts, repeated rows, odd characters."""
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, "Two words"), (5, "Two words"), (6, "two WORDS"), (None, "no id"), (None, None),
        (7, "a" * 50_000), (8, "one two three " * 8_000), (9, "é ß 日本語   ▁ \x00 x  y\r\n\r\nz"), (10, "<|endoftext|> it's 12345 !!"),
    ]
