"""Queries and SQL of the corpus operators, for the entry module."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, byte_bpe, exact_dedup, html_text, lm_scoring, mixing, packing, prefix_trie, quality, simhash, token_counts, topk_search, toxicity
from .common import bucket, table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~toxicity.held_out())
    out = toxicity.score(docs, model).withColumn("held_out", toxicity.held_out())
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = bucket(F.col("doc_id"), 5) == 1
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    out = lm_scoring.score(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, ~held_out)
    return out.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages").select("page_id", "html")).drop("html")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = quality.measured(table(spark, sf_dir, "documents"))
    net, _ = quality.train(texts, table(spark, sf_dir, "labels"), ~quality.held_out())
    out = quality.score(texts, net).withColumn("held_out", quality.held_out())
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.dedup(table(spark, sf_dir, "documents"))
    same = (F.col("keep.file") == F.col("file")) & (F.col("keep.row") == F.col("row"))
    return out.select("doc_id", F.col("keep.doc_id").alias("keep_id"), F.col("size").alias("group_size"), same.alias("kept"), F.col("digest").alias("text_sha256"))


def op9_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0).drop("beyond")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = byte_bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.drop("text")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = prefix_trie.trie(table(spark, sf_dir, "conversations"), splice=(5, 9))
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path
    return alignment.align(table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"), public_tokenizers.PATTERN, path("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_lm_scoring, op3_token_counts, op4_html_text, op5_simhash_near_dedup, op6_mix_sources, op7_quality, op8_exact_dedup, op9_topk_search, op10_byte_bpe, op11_prefix_trie, op12_best_fit_packing, op13_token_alignment)}

ORACLE = {
    "op9_topk_search": """
        WITH v AS (SELECT row_number() OVER () AS place, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS HUGEINT)) AS q FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.place, a.vec_id AS query_id, b.vec_id, coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])), 0) AS s
            FROM v a JOIN v b ON a.place <> b.place AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0),
        r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY place ORDER BY s DESC, vec_id) AS INTEGER) AS rank, vec_id,
            CAST(greatest(least(s, 9223372036854775807), -9223372036854775808) AS BIGINT) AS score FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op8_exact_dedup": """
        WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
        g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
        FROM d JOIN g ON d.t = g.t""",
    "op11_prefix_trie": """
        WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn FROM conversations WHERE conv_id IS NOT NULL),
        e AS (SELECT conv_id, turn, octet_length(encode(text)) AS bytes, sha256(concat(octet_length(encode(role)), ':', role, text)) AS turn_id FROM t),
        o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, turn_id) AS pos FROM e),
        k AS (SELECT conv_id, conv_id - conv_id % 5 AS base,
            xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: [CAST(ord(ch) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
                lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END), 4294967295) % 9 AS h
            FROM (SELECT DISTINCT conv_id FROM e)),
        r AS (SELECT k.conv_id, o.pos, o.turn_id, o.bytes FROM k JOIN o ON o.conv_id = k.base AND o.pos <= k.h
            UNION ALL SELECT k.conv_id, o.pos, o.turn_id, o.bytes FROM k JOIN o ON o.conv_id = k.conv_id AND o.pos > k.h),
        d AS (SELECT conv_id, row_number() OVER w AS depth, bytes, sha256(string_agg(turn_id, ',') OVER w) AS node FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
        s AS (SELECT conv_id, depth, bytes, node, coalesce(lag(node) OVER (PARTITION BY conv_id ORDER BY depth), 'root') AS parent FROM d
            UNION ALL SELECT conv_id, 0, 0, 'root', NULL FROM k),
        last AS (SELECT conv_id, max_by(node, depth) AS node FROM s GROUP BY conv_id),
        ends AS (SELECT node, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends FROM last GROUP BY node),
        n AS (SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, any_value(bytes) AS bytes, min(conv_id) AS conv_id, count(*) AS n_convs FROM s GROUP BY node),
        c AS (SELECT parent AS node, count(*) AS n_children FROM n WHERE parent IS NOT NULL GROUP BY parent),
        u AS (SELECT DISTINCT a.node, b.node AS under FROM s a JOIN s b ON a.conv_id = b.conv_id AND b.depth >= a.depth),
        v AS (SELECT u.node, sum((n.n_convs - 1) * n.bytes) AS saved, count(*) FILTER (c.n_children IS NULL) AS leaves FROM u JOIN n ON n.node = u.under LEFT JOIN c ON c.node = u.under GROUP BY u.node)
        SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children, v.leaves AS n_leaves, CAST(v.saved AS BIGINT) AS saved_tokens, coalesce(ends.ends, sha256('')) AS ends_sha256
        FROM n JOIN v ON v.node = n.node LEFT JOIN n p ON p.node = n.parent LEFT JOIN c ON c.node = n.node LEFT JOIN ends ON ends.node = n.node""",
}
