"""Queries over real files: readers on files that Spark writes from the
documents into the shared checkpoint folder, and writers read back."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixtures import Fixtures
from ..functions import text as T
from ..session import checkpoint_path
from ..sinks import writers as W
from ..sources import files as S
from .registry import query


def write_files(files: DataFrame, root: str) -> None:
    """One file per row of ``files(path, content, mtime_us)`` under a folder
    that all executors share as a local path; ``path`` begins with a slash."""
    root = S.normal_root(root)
    if not root.startswith("/"):
        raise ValueError("files are written to a shared local folder")

    def write(batches):
        for batch in batches:
            for path, content, mtime in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                os.makedirs(os.path.dirname(root + path), exist_ok=True)
                with open(root + path, "wb") as f:
                    f.write(content)
                os.utime(root + path, ns=(mtime * 1000, mtime * 1000))
            yield batch

    files.select("path", "content", "mtime_us").mapInArrow(write, "path string, content binary, mtime_us bigint")\
        .write.format("noop").mode("overwrite").save()


def _fresh(spark, name: str) -> str:
    return checkpoint_path(spark, f"{name}-{uuid.uuid4().hex}")


def _tree(spark, sf) -> str:
    """The manifest's files, with their texts and times."""
    root = _fresh(spark, "files")
    write_files(Fixtures(spark, sf)["manifest"].select("path", F.col("text").cast("binary").alias("content"), "mtime_us"), root)
    return root


@query("scan_manifest", """
SELECT substr(path, 8) AS path, name, lower(ext) AS ext, depth, size, mtime_us,
       CAST(row_number() OVER (ORDER BY encode(path)) AS BIGINT) AS position FROM manifest""", ("manifest",))
def q_scan_manifest(spark, sf):
    """The listing of a tree whose root is spelled with a detour."""
    from ..operators.ranking import sorted_positions
    root = _tree(spark, sf)
    found = S.scan_manifest(spark, f"file://{S.normal_root(root)}/corpus/../corpus")
    found = sorted_positions(found, [F.col("ord")])
    return found.select(F.substr("path", F.lit(len(S.normal_root(root)) + 8)).alias("path"), "name", "ext", "depth", "size",
                        "mtime_us", "position")


def _flat(spark, sf) -> str:
    """All documents in one folder: three in four as Markdown files, a third of all with a byte that is not UTF-8."""
    root = _fresh(spark, "flat")
    doc = Fixtures(spark, sf)["documents"]
    name = F.concat(F.lit("/d"), F.col("doc_id").cast("string"), F.when(F.col("doc_id") % 4 == 0, ".txt").otherwise(".md"))
    content = F.concat(F.col("text").cast("binary"), F.when(F.col("doc_id") % 3 == 1, F.unhex(F.lit("E9"))).otherwise(F.unhex(F.lit(""))))
    write_files(doc.select(name.alias("path"), content.alias("content"), F.lit(1_700_000_000_000_000).alias("mtime_us")), root)
    return root


_FLAT = """
WITH flat AS (SELECT 'd' || CAST(doc_id AS VARCHAR) AS stem, doc_id % 4 = 0 AS is_txt, doc_id % 3 = 1 AS broken, text,
                     strlen(text) + CASE WHEN doc_id % 3 = 1 THEN 1 ELSE 0 END AS size FROM documents)"""


@query("list_markdown_files", _FLAT + """
SELECT stem || '.md' AS name, stem, CAST(size AS BIGINT) AS size FROM flat WHERE NOT is_txt""", ())
def q_list_markdown_files(spark, sf):
    return S.list_markdown(spark, _flat(spark, sf)).select("name", "stem", "size")


@query("decode_with_fallback", _FLAT + """
SELECT stem || '.md' AS name,
       md5(replace(replace(CASE WHEN NOT broken THEN text ELSE array_to_string(list_transform(
           regexp_extract_all(hex(encode(text)), '..'), lambda h: chr(CAST('0x' || h AS INTEGER))), '') || chr(233) END,
           chr(13) || chr(10), chr(10)), chr(13), chr(10))) AS text_md5
FROM flat WHERE NOT is_txt""", ())
def q_decode_with_fallback(spark, sf):
    md = S.read_markdown(spark, _flat(spark, sf))
    return md.select("name", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query("read_text_corpus_files", _FLAT + """
SELECT stem || '.txt' AS file_name, CAST(size AS BIGINT) AS file_size,
       md5(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10))
           || CASE WHEN broken THEN chr(65533) ELSE '' END) AS text_md5
FROM flat WHERE is_txt""", ())
def q_read_text_corpus_files(spark, sf):
    corpus = S.read_text_corpus(spark, _flat(spark, sf))
    return corpus.select("file_name", "file_size", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query("write_corpus", """
SELECT 'd' || CAST(doc_id AS VARCHAR) || '.txt' AS name, md5(text) AS text_md5,
       CAST(count(*) OVER () AS BIGINT) AS documents, CAST(sum(strlen(text)) OVER () AS BIGINT) AS total_bytes,
       CAST(sum(length(text)) OVER () AS BIGINT) AS total_chars
FROM documents""", ())
def q_write_corpus(spark, sf):
    """The corpus written and read back, with what the writer saw passing."""
    path, doc = _fresh(spark, "corpus"), Fixtures(spark, sf)["documents"]
    seen = W.write_corpus(doc.select(F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("name"), "text"), path)
    return spark.read.parquet(path).select("name", F.md5(F.col("text").cast("binary")).alias("text_md5"),
                                           *[F.lit(seen[c]).cast("bigint").alias(c) for c in ("documents", "total_bytes", "total_chars")])


@query("write_dataset", """
SELECT 'd' || CAST(doc_id AS VARCHAR) || '.txt' AS file_name, CAST(strlen(text) AS BIGINT) AS file_size, md5(text) AS text_md5
FROM documents
UNION ALL
SELECT '_card', CAST(count(*) AS BIGINT),
       '- Total size: ' || format('{:.2f}', coalesce(sum(strlen(text)), 0) / 1048576.0) || ' MB' FROM documents""", ())
def q_write_dataset(spark, sf):
    """The dataset read back, and of its card the documents and the line of the size."""
    path, doc = _fresh(spark, "dataset"), Fixtures(spark, sf)["documents"]
    seen = W.write_dataset(doc.select("text", F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("file_name"),
                                      F.octet_length("text").alias("file_size")), path, "docforge/corpus")
    card = spark.read.text(f"{path}/_card").where("value like '- Total size%'")
    return spark.read.parquet(f"{path}/data").select("file_name", "file_size", F.md5(F.col("text").cast("binary")).alias("text_md5"))\
        .unionByName(card.select(F.lit("_card").alias("file_name"), F.lit(seen["documents"]).cast("bigint").alias("file_size"),
                                 F.col("value").alias("text_md5")))


@query("write_state", """
SELECT md5(path || '_' || CAST(mtime_us AS VARCHAR) || '_' || CAST(size AS VARCHAR)) AS file_id, CAST(3 AS BIGINT) AS version
FROM manifest""", ("manifest",))
def q_write_state(spark, sf):
    """Two runs that began together commit versions of their own; the third adds to what the second wrote."""
    from ..functions.names import file_id
    base, m = _fresh(spark, "state"), Fixtures(spark, sf)["manifest"]
    ids = m.select("ord", file_id(F.col("path"), F.col("mtime_us"), F.col("size")).alias("file_id"))
    first, second = W.claim_version(spark, base), W.claim_version(spark, base)
    W.write_state_version(ids.where("ord % 3 = 0").select("file_id"), base, second)
    W.write_state_version(ids.where("ord % 3 = 1").select("file_id"), base, first)
    done = W.read_state(spark, base, "file_id string")
    version = W.write_state_version(done.unionByName(ids.where("ord % 3 <> 0").select("file_id")).distinct(), base)
    return W.read_state(spark, base, "file_id string").withColumn("version", F.lit(version).cast("bigint"))
