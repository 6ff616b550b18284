"""Token counts: pieces are counted once for each distinct pre-token of the
corpus, joined to each document's pre-token frequencies and summed.  No ids are
made for documents."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches
from .wordindex import sums_by_document

#: A run of spaces with what follows it, what follows a line end, or line ends.
PRE_TOKEN = re.compile(rb" +[^ \n]*|[^ \n]+|\n+")
#: The sign that the vocabulary has for a space; the library takes it for one.
SPACE_SIGN = "▁".encode()


def pre_tokens(text: bytes) -> list[bytes]:
    """Parts of a text whose pieces are independent: no piece of the vocabulary
    has a space after another character, and none holds a line end.  The library
    puts a space before a text that isn't empty."""
    return PRE_TOKEN.findall(b" " + text.replace(SPACE_SIGN, b" ")) if text else []


def piece_counter(model: bytes):
    """Function that counts the pieces of pre-tokens."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_proto=model)

    def count(words: list[bytes], _=None) -> np.ndarray:
        # The library adds a space to what it encodes: one is taken off, or a line end keeps it apart.
        texts = [w[1:].decode() if w[:1] == b" " else "\n" + w.decode() for w in words]
        extra = np.array([0 if w[:1] == b" " else 2 for w in words])
        out = np.array([len(x) for x in library.encode(texts, num_threads=1)]) - extra
        out[[i for i, w in enumerate(words) if w == b" "]] = 1  # encoding nothing gives nothing, not even the space
        return out[:, None]

    return count


def checked(model: bytes) -> bytes:
    """Refuse a model for which pre-tokens would not be independent."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    for i in range(library.get_piece_size()):
        piece = library.id_to_piece(i)
        if "▁" in piece.lstrip("▁") or "\n" in piece:
            raise ValueError(f"piece {piece!r} goes across pre-tokens")
    if library.encode("a  b ﬁ", out_type=str) != library.encode("a▁▁b ﬁ", out_type=str) or library.decode(library.encode("ﬁ")) != "ﬁ":
        raise ValueError("the model changes texts before it cuts them")
    return model


def count_tokens(docs: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit, as
    the sentencepiece model at ``path`` encodes the whole text, without begin or
    end tokens.

    Null texts count as empty, which have no tokens.  Null doc_ids stay null;
    repeated rows are counted each; an empty table gives an empty result; other
    columns are not read.  The driver reads the model; it travels with the tasks.
    """
    small_batches(docs.sparkSession)
    with open(path, "rb") as f:
        model = checked(f.read())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(0).cast("long").alias("tag"), F.col("text").cast("binary").alias("text"), F.lit(False).alias("flag"))
    out = sums_by_document(rows, pre_tokens, lambda: piece_counter(model), 1)[0].where("n_bytes is not null")
    n = F.col("v0").cast("long")
    return out.select("doc_id", "n_bytes", n.alias("n_tokens"), (n > limit).alias("over_limit"))
