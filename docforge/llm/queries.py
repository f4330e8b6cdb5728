"""Registered queries ``opN_<name>`` over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    byte_bpe,
    decontaminate,
    embed_pivots,
    html_mincut,
    language_id,
    line_templates,
    piece_codec,
    quality_crf,
    sharding,
    simhash_vptree,
    suffix_dedup,
    token_align,
    turn_tries,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_templates.drop_recurring_lines(docs)


def op2_html_extraction(spark, sf_dir):
    return html_mincut.extract_main_text(_table(spark, sf_dir, "pages"))


def op3_benchmark_decontamination(spark, sf_dir):
    return decontaminate.find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_embedding_near_dedup(spark, sf_dir):
    return embed_pivots.embedding_near_duplicates(_table(spark, sf_dir, "embeddings"))


def op5_suffix_array_dedup(spark, sf_dir):
    out = suffix_dedup.remove_repeated_strings(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_quality_classifier(spark, sf_dir):
    return quality_crf.classify_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_sentencepiece(spark, sf_dir):
    """Pieces of every text as count and checksum, and whether they spell it."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    back = piece_codec.encode_sampled(docs, decoded_col="decoded")
    text = F.coalesce("text", F.lit(""))
    return back.select("doc_id", F.size("piece_ids").cast("long").alias("n_pieces"),
                       F.octet_length(text).cast("long").alias("n_bytes"),
                       F.xxhash64("piece_ids").alias("pieces_hash"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
                       (F.col("decoded") == text).alias("lossless"))


def op8_language_id(spark, sf_dir):
    return language_id.identify_language(_table(spark, sf_dir, "documents"))


def op9_simhash_near_dedup(spark, sf_dir):
    return simhash_vptree.simhash_near_duplicates(_table(spark, sf_dir, "documents"))


def op10_sharding(spark, sf_dir):
    tree = sharding.uniform_tree(40)
    return sharding.assign_shards(_table(spark, sf_dir, "documents"), tree, sharding.with_new_shard(tree))


def op11_tokenizer_alignment(spark, sf_dir):
    return token_align.align_tokenizers(_table(spark, sf_dir, "documents"), groups="sha256")


def op12_conversation_trie(spark, sf_dir):
    return turn_tries.conversation_trie(_table(spark, sf_dir, "conversations"))


def op13_byte_bpe(spark, sf_dir):
    """Tokens of every text as count and digest, and the digest of the bytes they spell."""
    coded = byte_bpe.encode_bytes(_table(spark, sf_dir, "documents"), decoded_col="decoded")
    return coded.select("doc_id", (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_line_dedup, op2_html_extraction,
                        op3_benchmark_decontamination, op4_embedding_near_dedup, op5_suffix_array_dedup, op6_quality_classifier,
                        op7_sentencepiece, op8_language_id, op9_simhash_near_dedup, op10_sharding,
                        op11_tokenizer_alignment, op12_conversation_trie, op13_byte_bpe)
}
ORACLES: dict[str, str] = {
    # CRC-32 bit by bit over the decimal id; a prefix is keyed by the digest of its turns
    "op12_conversation_trie": r"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
           lambda c: ord(c)::BIGINT)), lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0,0,0,0,0,0,0,0]::BIGINT[]),
           lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384::BIGINT) ELSE v // 2 END)), 4294967295::BIGINT) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)),
built AS (
  SELECT c.conv_id, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 20 AND t.pos <= c.h
  UNION ALL
  SELECT c.conv_id, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY pos) AS depth, count(*) OVER (PARTITION BY conv_id) AS total FROM built),
member AS (
  SELECT conv_id, 0 AS depth, '' AS node, 0 AS words,
         coalesce((SELECT max(total) FROM numbered n WHERE n.conv_id = c.conv_id), 0) = 0 AS ends FROM convs c
  UNION ALL
  SELECT conv_id, depth, md5(string_agg(strlen(role) || ':' || strlen(text) || ':' || role || text, '')
                             OVER (PARTITION BY conv_id ORDER BY depth)),
         len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), depth = total FROM numbered),
node AS (
  SELECT depth, node, min(conv_id) AS conv_id, count(*) AS n, max(words) AS words,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM member GROUP BY depth, node),
placed AS (
  SELECT n.*, p.node AS parent FROM node n LEFT JOIN member p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1),
children AS (SELECT depth - 1 AS depth, parent AS node, count(*) AS n FROM placed WHERE depth > 0 GROUP BY ALL),
below AS (
  SELECT a.depth, a.node, count(*) FILTER (c.n IS NULL) AS leaves, sum((n.n - 1) * n.words) AS saved
  FROM node n JOIN member a ON a.conv_id = n.conv_id AND a.depth <= n.depth
  LEFT JOIN children c ON c.depth = n.depth AND c.node = n.node GROUP BY a.depth, a.node)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(n.n AS BIGINT) AS n_convs,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n_children, CAST(b.leaves AS BIGINT) AS n_leaves,
       CAST(b.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM placed n LEFT JOIN node p ON p.depth = n.depth - 1 AND p.node = n.parent
LEFT JOIN children c ON c.depth = n.depth AND c.node = n.node JOIN below b ON b.depth = n.depth AND b.node = n.node""",
}
