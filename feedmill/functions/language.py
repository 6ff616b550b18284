"""Language of a text by ranks of its letter pairs and triples (the out-of-place
measure), against profiles of a few function words of each language."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Frequent words that the profiles are made of.
SAMPLES = {
    "de": "der die das und ist nicht mit von den dem ein eine zu auf für sich auch werden wird des im bei nach aus einer über wurde sind einem durch heit keit ung sch lich",
    "en": "the of and to in is that for it was on are with as by this be from at have which or not they his but had an were there their been would ing tion ly",
    "fr": "le la les de des et en un une du est que pour dans qui sur par plus pas au avec ce il sont cette ont mais nous vous leur été aux comme ment eux",
    "es": "el la los las de que y en un una ser se no por con para como más pero sus le ha este cuando muy sin sobre también me hasta hay donde ción mente",
    "it": "il la di che e un una per non sono con del della le si da gli nel alla come anche più questo ma ha dei delle zione mente",
    "nl": "de het een van en in is dat op te voor met zijn niet aan er ook als bij door naar heeft worden uit werd nog lijk ing",
}
SIZE, LEAST, MOST = 300, 50, 5000


def _ranked(text: str) -> np.ndarray:
    """Codes of the SIZE most frequent pairs and triples of a text, ties by code
    point.  A code has 21 bits for each letter, so codes sort as their texts do."""
    words = (w for x in text.lower().split() if (w := x if x.isalpha() else "".join(filter(str.isalpha, x))))
    c = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le"), np.uint32).astype(np.int64)
    if len(c) < 3:
        return np.empty(0, np.int64)
    pairs = c[:-1] << 42 | c[1:] << 21
    inside = c[1:-1] != 32  # no triple goes over the end of a word
    codes, n = np.unique(np.concatenate((pairs, (pairs[:-1] | c[2:])[inside])), return_counts=True)
    return codes[np.argsort(-n, kind="stable")[:SIZE]]


def _text(code: int) -> str:
    return "".join(chr(x) for s in (42, 21, 0) if (x := code >> s & 0x1FFFFF))


def profile(text: str) -> dict[str, int]:
    return {_text(g): i for i, g in enumerate(_ranked(text).tolist())}


def _sorted(profiles: dict[str, dict[str, int]]) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Of each profile the codes in order, with their ranks."""
    out = {}
    for name, p in profiles.items():
        codes = np.array([sum(ord(c) << s for c, s in zip(g, (42, 21, 0))) for g in p], np.int64)
        order = np.argsort(codes)
        out[name] = codes[order], np.array(list(p.values()), np.int64)[order]
    return out


def _closest(text: str | None, profiles: dict[str, tuple[np.ndarray, np.ndarray]]) -> str:
    text = (text or "").strip()
    if len(text) < LEAST or not len(own := _ranked(text[:MOST])):
        return "en"

    def distance(codes: np.ndarray, ranks: np.ndarray) -> int:
        at = np.searchsorted(codes, own).clip(max=len(codes) - 1)
        return int(np.where(codes[at] == own, np.abs(np.arange(len(own)) - ranks[at]), SIZE).sum())

    return min((distance(*p), name) for name, p in profiles.items())[1]


def detect(text: str | None, profiles: dict[str, dict[str, int]]) -> str:
    """Code of the closest profile; ``en`` for texts under 50 characters."""
    return _closest(text, _sorted(profiles))


def language(text: Column) -> Column:
    @F.arrow_udf("string")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        profiles = _sorted({code: profile(words) for code, words in SAMPLES.items()})
        for batch in batches:
            yield pa.array([_closest(x.as_py(), profiles) for x in batch], pa.string())

    return of(F.left(text, F.lit(MOST + 200)))
