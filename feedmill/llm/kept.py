"""Ids of parts of texts, kept by a worker for parts that it has met before, and
merge lists as ranks."""

from __future__ import annotations

from collections.abc import Callable, Hashable
from itertools import islice

#: Parts that are kept, and the longest one.
KEPT, LONGEST = 200_000, 100


class Kept:
    """``encode`` gives the packed ids of parts, or None for those that cannot be taken."""

    def __init__(self, encode: Callable[[list], list[bytes | None]]) -> None:
        self.encode = encode
        self.parts: dict[Hashable, bytes | None] = {}

    def ids(self, parts: list) -> bytes | None:
        """Ids of all parts in turn; None if one cannot be taken."""
        known = self.parts
        distinct = set(parts)
        new = [p for p in distinct if p not in known]
        if new:
            fresh = dict(zip(new, self.encode(new)))
            known = {p: known[p] for p in distinct if p not in fresh} | fresh
            if len(self.parts) + len(fresh) > KEPT:
                self.parts = {}
            self.parts.update((k, v) for k, v in islice(fresh.items(), KEPT) if len(k) <= LONGEST)
        found = [known[p] for p in parts]
        return None if None in found else b"".join(found)


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable
    ones for themselves, the others in turn from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def ranks_of(model: dict, end: bytes = b"") -> tuple[dict[bytes, int], dict[int, int]]:
    """A byte-level merge list as ranks of byte strings, and the id of each rank.

    A suffix that marks a word's last letter becomes the byte ``end``, which may not
    occur otherwise: joining it to a byte comes before all merges.
    """
    letters, vocabulary, suffix = byte_letters(), model["vocab"], model.get("end_of_word_suffix") or ""

    def as_bytes(token: str) -> bytes:
        last = bool(suffix) and token.endswith(suffix) and token != suffix
        return bytes(letters[c] for c in (token[: -len(suffix)] if last else token)) + (end if last else b"")

    singles = [c for c in letters]
    ranks = {as_bytes(c): k for k, c in enumerate(singles)}
    tokens = dict(enumerate(singles))
    if suffix:
        for k, c in enumerate(singles):
            if as_bytes(c) != end:
                ranks[as_bytes(c + suffix)] = 256 + k
                tokens[256 + k] = c + suffix
    for k, pair in enumerate(model["merges"]):
        token = "".join(pair if isinstance(pair, list) else pair.split(" "))
        if as_bytes(token) in ranks:
            raise ValueError(f"two merges give {token!r}")
        ranks[as_bytes(token)] = 512 + k
        tokens[512 + k] = token
    return ranks, {k: vocabulary[t] for k, t in tokens.items() if t in vocabulary}
