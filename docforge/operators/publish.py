"""Dataset card for a published corpus ``(text, file_name, file_size)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEATURES = ("text", "file_name", "file_size")


def dataset_card(corpus: DataFrame, title: str, description: str | None = None,
                 created: str = "1970-01-01") -> DataFrame:
    """One row: number of documents, total bytes, total MB (bytes / 1024^2,
    two decimals) and the card text built from them."""
    return card_of(corpus.agg(F.count(F.lit(1)).alias("documents"),
                              F.coalesce(F.sum("file_size"), F.lit(0)).cast("bigint").alias("total_bytes")),
                   title, description, created)


def card_of(totals: DataFrame, title: str, description: str | None = None, created: str = "1970-01-01") -> DataFrame:
    """``dataset_card`` from one row of ``documents, total_bytes``."""
    mb = F.regexp_replace(F.format_number(F.col("total_bytes") / F.lit(1024.0 * 1024.0), 2), ",", "")
    desc = (F.lit(description) if description else
            F.concat(F.lit("A corpus of "), F.col("documents").cast("string"),
                     F.lit(" plain-text documents converted from Markdown.")))
    card = F.concat(
        F.lit(f"# Dataset: {title}\n\n"), desc, F.lit("\n\n## Summary\n\n- Documents: "),
        F.col("documents").cast("string"), F.lit("\n- Total size: "), mb, F.lit(" MB"),
        F.lit(f"\n- Created: {created}\n\n## Features\n\n"),
        F.lit(", ".join(FEATURES)), F.lit("\n"))
    return totals.select("documents", "total_bytes", mb.alias("total_mb"), card.alias("card"))
