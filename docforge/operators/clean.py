"""Document-table operators for Markdown cleaning and text extraction.

All of these are narrow projections (no shuffle) except the summaries, which
are global aggregates, and the skip join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.names import split_ext, stem


def strip_markdown(docs: DataFrame, text: str = "text", rules=None) -> DataFrame:
    return docs.withColumn(text, T.strip_markdown(F.col(text), rules))


def flatten_tables(docs: DataFrame, text: str = "text") -> DataFrame:
    return docs.withColumn(text, T.flatten_tables(F.col(text)))


def clean_markdown(docs: DataFrame, text: str = "text", rules=None) -> DataFrame:
    return docs.withColumn(text, T.clean_markdown(F.col(text), rules))


def normalize_markdown(docs: DataFrame, text: str = "text") -> DataFrame:
    return docs.withColumn(text, T.normalize_markdown(F.col(text)))


def extract_text_nodes(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    return pages.withColumn(out, T.extract_text_nodes(F.col(html)))


def table_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Line state inside Markdown tables, one row per line.

    A line is a separator when it has a pipe and ``---`` or ``-+-``; it is a
    table row when it has a pipe, is no separator, and a separator came
    earlier with no pipe-free line in between.  The table regions of
    ``flatten_tables`` hold exactly the separators and rows, so the state is an
    expression over the document's lines and nothing is shuffled.
    """
    lines = docs.select(key, F.posexplode(T.table_lines(F.col(text))).alias("line_no", "_l"))
    return lines.select(key, F.col("line_no").cast("bigint").alias("line_no"), "_l.line", "_l.is_sep", "_l.is_row")


def list_markdown(files: DataFrame) -> DataFrame:
    """Direct ``*.md`` children of a listing (case-sensitive, as a glob)."""
    return files.filter(F.col("name").endswith(".md") & (F.col("depth") == 0))


def skip_existing_text(markdown: DataFrame, texts: DataFrame, override: bool = False) -> DataFrame:
    """Drop Markdown files whose ``<stem>.txt`` already exists, unless
    ``override``.  ``texts`` holds the names of existing outputs."""
    if override:
        return markdown
    have = texts.select(stem(F.col("name")).alias("_stem")).filter(split_ext(F.col("name")) == ".txt")
    return (markdown.withColumn("_stem", stem(F.col("name")))
            .join(have, "_stem", "left_anti").drop("_stem"))


def clean_outcomes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: cleaned text, status and cleaned character count
    (code points; cleaning an unreadable document fails)."""
    cleaned = T.clean_markdown(F.col(text))
    return docs.select(key, cleaned.alias("text"),
                       F.when(F.col(text).isNull(), "failed").otherwise("ok").alias("status"),
                       F.coalesce(F.length(cleaned), F.lit(0)).cast("bigint").alias("chars"))


def clean_summary(outcomes: DataFrame) -> DataFrame:
    return outcomes.agg(
        F.count(F.when(F.col("status") == "ok", 1)).alias("successful_files"),
        F.count(F.when(F.col("status") != "ok", 1)).alias("failed_files"),
        F.coalesce(F.sum(F.when(F.col("status") == "ok", F.col("chars"))), F.lit(0)).cast("bigint")
        .alias("total_chars"))
