"""A corpus pipeline: toxic texts go, exact and near copies go, sources are mixed
to target weights, and what is left is encoded.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.llm import byte_bpe, exact_dedup, mixing, similar, toxicity
from feedmill.llm.common import scratch, small_batches, table

#: Texts with this score or more go.
TOXIC = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under TOXIC stay, with all their columns; null and
    empty texts score by the model's bias alone, very long ones whole, repeated
    rows each.  An empty table stays empty."""
    small_batches(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~toxicity.held_out())
    return docs.where(toxicity.score_column(F.col("text"), model) < TOXIC)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are identical after lower-casing A-Z, however long, the row
    with the largest doc_id stays, of these the last; null texts are empty ones,
    null doc_ids come before all others.  An empty table stays empty."""
    return exact_dedup.kept_rows(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest doc_id, null
    first.  Candidates come from SimHash fingerprints through op5's pigeonhole index,
    and from bands of min-hashes where fingerprints are further apart; links are
    verified: 0.8 or more of the five-word shingles of whole texts are shared.  Texts without
    words, null or empty, are one group.  An empty table stays empty."""
    return similar.first_of_alike(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each whole pass of a text, and one with the words of a last,
    partial pass.  Null sources are one source; texts without words, null or
    empty, take nothing and go; repeated rows are mixed each.  An empty table
    stays empty."""
    return mixing.mixed_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, the number of ids and the digests of ids and decoded
    bytes of each whole text; null counts as empty, repeated rows are coded each.
    An empty table gives an empty result."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    out = byte_bpe.encode_decode(docs.select("doc_id", "source", "text"), path, public_tokenizers.PATTERN)
    return out.drop("text")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("mix sources", mix_sources),
    ("byte-level BPE", encode),
]

#: Models, streams and iteration are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
