"""Streaming queries: each runs a Structured Streaming job over a driver
table (file source, ``availableNow``), writes to files under the shared
checkpoint folder, and returns the written result."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.quota import FOLD_SCHEMA
from ..session import checkpoint_path
from ..sinks import writers as W
from ..streaming import streams as S
from . import q_quota, q_text  # noqa: F401  (their oracles are reused below)
from .registry import ORACLES, query

# of files in one micro-batch, at least one file
MICRO_BATCH_BYTES = 1 << 30


def _dirs(spark, name):
    run = f"{name}-{uuid.uuid4().hex[:12]}"
    return checkpoint_path(spark, "streams", run, "out"), checkpoint_path(spark, "streams", run, "ckpt")


def _stream(spark, sf, table, cols=None, **bound):
    """A driver table, one file or a folder of files, as a stream."""
    path = f"{sf}/{table}.parquet"
    schema = spark.read.parquet(path).schema
    if W.is_folder(spark, path):
        s = S.table_stream(spark, path, schema, **bound)
    else:  # a stream's path is a folder
        s = S.table_stream(spark, sf, schema, glob=f"{table}.parquet", **bound)
    return s.select(*cols) if cols else s


def _documents(spark, sf):
    return _stream(spark, sf, "documents", ["doc_id", "text"], max_bytes_per_trigger=MICRO_BATCH_BYTES)


def _requests(stream):
    return stream.select(
        "event_id", (F.col("user_id") % 3).alias("api_key"),
        F.floor(F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)") / 250)
        .cast("bigint").alias("ts_us"),
        F.floor(F.col("value") * 1000).cast("bigint").alias("tokens"))


@query("stream_clean")
def q_stream_clean(spark, sf):
    out, ck = _dirs(spark, "clean")
    docs = _documents(spark, sf)
    q = S.stream_clean(docs, out, ck)
    q.awaitTermination()
    return spark.read.schema(docs.schema).parquet(out).select("doc_id", "text")


ORACLES["stream_clean"] = ORACLES["clean_markdown_raw"]


@query("stream_dedup", """
SELECT DISTINCT CAST(strlen(text) AS BIGINT) AS size, md5(text) AS md5 FROM documents""")
def q_stream_dedup(spark, sf):
    out, ck = _dirs(spark, "dedup")
    s = _documents(spark, sf).select(
        F.octet_length("text").cast("bigint").alias("size"), F.md5(F.col("text").cast("binary")).alias("md5"), "doc_id")
    S.run_available(S.stream_dedup(s), out, ck)
    return spark.read.schema(s.schema).parquet(out).select("size", "md5")


@query("stream_quota_windows", """
WITH r AS (SELECT event_id, user_id % 3 AS api_key, epoch_us(ts) // 250 AS ts_us,
                  CAST(floor(value * 1000) AS BIGINT) AS tokens FROM events),
w AS (SELECT api_key, (ts_us // 10000000) * 10000000 - k * 10000000 AS window_start_us, tokens
      FROM r, (SELECT unnest(range(0, 6)) AS k) ks)
SELECT api_key, window_start_us, CAST(count(*) AS BIGINT) AS requests, CAST(sum(tokens) AS BIGINT) AS tokens
FROM w GROUP BY api_key, window_start_us""")
def q_stream_quota_windows(spark, sf):
    out, ck = _dirs(spark, "quota_windows")
    S.run_updates(S.stream_quota_windows(_requests(_stream(spark, sf, "events"))), out, ck)
    return S.latest_updates(spark, out, ["api_key", "window_start_us"])


@query("stream_quota_exact")
def q_stream_quota_exact(spark, sf):
    out, ck = _dirs(spark, "quota_exact")
    # one micro-batch: the files of a table are in no order of time
    S.run_available(S.stream_quota_exact(_requests(_stream(spark, sf, "events"))), out, ck)
    return spark.read.schema(FOLD_SCHEMA).parquet(out)


ORACLES["stream_quota_exact"] = ORACLES["quota_fold"]
