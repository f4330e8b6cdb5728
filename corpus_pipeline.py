"""The training-corpus pipeline over ``documents``.

Language identification, line de-duplication, SimHash near-duplicates,
benchmark decontamination, SentencePiece encoding and decoding.  Each stage
works on all that its predecessor kept; ``run`` writes every stage as Parquet
into the shared checkpoint folder and reads it back, so a lost executor costs
a part of one stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docforge.llm import decontaminate, language_id, line_templates, piece_codec, simhash_vptree
from docforge.session import checkpoint_path

MIN_LANGUAGE_SCORE = 0.1  # an undecided vote is near 0; held-out texts of the learned languages get 0.19 and more at sf0.01


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which no language is recognised (null, empty or
    without a letter, an undecided vote, or n-grams unlike the language's)."""
    columns = docs.columns
    model = language_id.fit(docs.where(~language_id.held_out(F.col("doc_id"), 5, 0)))
    scored = language_id.predict(docs, model, lang_out="_lang_pred", score_out="_lang_score")
    known = (F.col("_lang_pred") != "und") & (F.col("_lang_score") >= MIN_LANGUAGE_SCORE)
    return scored.where(known).select(columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops recurring lines, and documents that consisted of nothing else;
    ``n_chars`` follows the text."""
    columns = docs.columns
    out = line_templates.drop_recurring_lines(docs, count_cols=("_lines", "_dropped"))
    out = out.where((F.col("_dropped") == 0) | F.col("text").rlike(r"[^ \t\r\f\n]"))
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.when(F.col("_dropped") == 0, F.col("n_chars")).otherwise(
            F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(columns)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of every group of SimHash near-duplicates."""
    return simhash_vptree.keep_one_per_group(docs).select(docs.columns)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.drop_contaminated(docs, benchmark).select(docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the sampled pieces of the text, their number, and whether decoding
    them gives the text back."""
    coded = piece_codec.encode_sampled(docs, decoded_col="_decoded")
    return coded.select(*docs.columns, "piece_ids", F.size("piece_ids").cast("long").alias("n_pieces"),
                        (F.col("_decoded") == F.coalesce("text", F.lit(""))).alias("lossless"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", dedup_documents),
    ("benchmark_decontamination", decontaminate_benchmark),
    ("sentencepiece", encode_pieces),
]

#: Fitted classifiers, hashes and sampled pieces are not expressible in SQL;
#: tests/llm compares the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: its columns, ``piece_ids, n_pieces, lossless``."""
    docs, base = spark.read.parquet(f"{sf_dir}/documents.parquet"), f"corpus-pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = checkpoint_path(spark, base, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
