"""Incremental (Structured Streaming) forms of cleaning, de-duplication and
request accounting.

The reference keeps progress files so a rerun skips finished work; here that
is the streaming checkpoint: a restarted query continues where it stopped and
each input row is processed once.  Sinks are files (Parquet) or
``foreachBatch`` writers, never driver memory.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.names import base_name, file_id
from ..operators import clean as C
from ..operators.quota import CARRY_SCHEMA, FOLD_COLUMNS, FOLD_SCHEMA, carried, quota_fold_after
from ..sinks import writers as W
from ..sources import files as S


# ---------------------------------------------------------------------------
# sources
# ---------------------------------------------------------------------------
def markdown_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New ``*.md`` files arriving in a folder, decoded like the batch reader.
    Spark's file streams see neither empty nor hidden files; ``clean_folder`` does."""
    r = (spark.readStream.format("binaryFile")
         .schema("path string, modificationTime timestamp, length bigint, content binary")
         .option("pathGlobFilter", "*.md"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = r.load(folder)
    return raw.select(F.col("path").alias("name"),
                      T.fold_newlines(T.decode_with_fallback(F.col("content"))).alias("text"))


def clean_folder(spark: SparkSession, folder: str, out: str, state: str) -> dict:
    """One increment over the ``*.md`` files of a folder: what is listed now
    and not in the state (by path, time and size) is cleaned and written as
    ``<out>/increment=N``, then the state's version N is committed.  Empty and
    hidden files are seen, changed files are cleaned again, and files that
    cannot be read count as failed and stay for the next increment.  An
    increment that was cut off leaves no version, so ``read_increments`` does
    not see it and its files come again.  Returns the counts of ``clean_job``."""
    version = W.claim_version(spark, state)
    listing = S.glob_filter(S.walk_files(spark, folder, recursive=False), "*.md")
    listing = listing.withColumn("file_id", file_id(F.col("path"), F.col("mtime_us"), F.col("size")))
    done = W.read_state(spark, state, "file_id string")
    new = S.read_contents(listing.join(done, "file_id", "left_anti").repartition(spark.sparkContext.defaultParallelism * 4))
    text = T.fold_newlines(T.decode_with_fallback(F.col("content")))
    outcomes = C.clean_outcomes(new.select(F.struct("file_id", base_name(F.col("path")).alias("name")).alias("key"),
                                           text.alias("text")), key="key")
    path = f"{out.rstrip('/')}/increment={version}"
    outcomes.select("key.*", "text", "status", "chars").write.mode("errorifexists").parquet(path)
    written = spark.read.parquet(path)
    W.write_state_version(done.unionByName(written.where("status = 'ok'").select("file_id")).distinct(), state, version)
    return C.clean_summary(written).first().asDict()


def read_increments(spark: SparkSession, out: str, state: str) -> DataFrame:
    """``name, text`` of all committed increments; of a file that changed, the latest."""
    rows = spark.read.parquet(*[f"{out.rstrip('/')}/increment={v}" for v in W.committed_versions(spark, state)])
    rows = rows.where("status = 'ok'").withColumn("_at", F.regexp_extract(F.input_file_name(), r"increment=(\d+)", 1).cast("bigint"))
    return rows.groupBy("name").agg(F.max_by("text", "_at").alias("text"))


def table_stream(spark: SparkSession, folder: str, schema, glob: str | None = None,
                 max_files_per_trigger: int | None = None, max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Parquet files arriving in ``folder`` (optionally only those whose own
    names match ``glob``; folders inside are not entered).  A micro-batch holds
    all new files, or up to a number of files or of bytes."""
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if max_bytes_per_trigger:
        r = r.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    return r.parquet(folder)


# ---------------------------------------------------------------------------
# operators
# ---------------------------------------------------------------------------
def stream_clean(stream: DataFrame, out_path: str, checkpoint: str, text: str = "text"):
    """Clean each arriving document once and append it; the checkpoint makes
    a restart continue (a second run over the same input adds nothing)."""
    cleaned = stream.withColumn(text, T.clean_markdown(F.col(text)))
    return (cleaned.writeStream.format("parquet").outputMode("append")
            .option("path", out_path).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def stream_dedup(stream: DataFrame, keys=("size", "md5"), watermark: tuple[str, str] | None = None) -> DataFrame:
    """One row per key over the whole stream (first arrival wins across
    micro-batches; inside one micro-batch the survivor is arbitrary).  With a
    watermark ``(column, delay)`` the state is bounded
    (``dropDuplicatesWithinWatermark``)."""
    if watermark:
        col, delay = watermark
        return stream.withWatermark(col, delay).dropDuplicatesWithinWatermark(list(keys))
    return stream.dropDuplicates(list(keys))


def stream_quota_windows(stream: DataFrame, ts_us: str = "ts_us", key: str = "api_key",
                         tokens: str = "tokens", delay: str = "10 minutes") -> DataFrame:
    """Requests and tokens per key in sliding 60 s windows every 10 s, with
    a watermark so that old windows are finalised and their state dropped.
    (An aligned approximation of the trailing minute; ``request_rate`` is the
    exact batch form.)"""
    s = stream.withColumn("_ts", F.timestamp_micros(F.col(ts_us))).withWatermark("_ts", delay)
    return (s.groupBy(F.window("_ts", "60 seconds", "10 seconds"), F.col(key))
            .agg(F.count(F.lit(1)).alias("requests"), F.sum(tokens).alias("tokens"))
            .select(key, F.unix_micros(F.col("window.start")).alias("window_start_us"), "requests", "tokens"))


class QuotaStream(NamedTuple):
    """A request stream to be folded into the tracker's counters; ``run_available`` runs it."""
    requests: DataFrame
    anchor_us: int | None

    def folded(self, checkpoint: str) -> DataFrame:
        """Fold all requests available now and return a stream of the folded
        rows.  A micro-batch folds on all workers from the state that the one
        before it left, and writes its rows and the new state as its version
        under ``checkpoint``; one that was cut off writes them again."""
        rows, states = f"{checkpoint}/folded", f"{checkpoint}/state"
        if W.is_folder(self.requests.sparkSession, f"{checkpoint}/offsets"):
            raise ValueError(f"{checkpoint} is the checkpoint of another kind of stream: use a new one")

        def fold(batch: DataFrame, batch_id: int):
            spark = batch.sparkSession
            state = spark.read.schema(CARRY_SCHEMA).parquet(f"{states}/batch={batch_id - 1}") if batch_id else None
            here = f"{rows}/batch={batch_id}"
            folded = quota_fold_after(batch, state, self.anchor_us)
            folded.write.mode("overwrite").parquet(here)
            carried(spark.read.schema(folded.schema).parquet(here), state).write.mode("overwrite").parquet(
                f"{states}/batch={batch_id}")
            W.drop_batches(spark, states, below=batch_id - 1)

        (self.requests.writeStream.foreachBatch(fold).option("checkpointLocation", f"{checkpoint}/requests")
         .trigger(availableNow=True).start().awaitTermination())
        spark = self.requests.sparkSession
        W.make_folder(spark, rows)
        return (spark.readStream.schema(f"{FOLD_SCHEMA}, batch bigint").option("maxFileAge", "36500d").parquet(rows)
                .select(*FOLD_COLUMNS))

    def published(self, checkpoint: str) -> None:
        """The folded rows are written: drop them here."""
        W.drop_batches(self.requests.sparkSession, f"{checkpoint}/folded")


def stream_quota_exact(stream: DataFrame, anchor_us: int | None = None) -> QuotaStream:
    """The tracker's exact counters on a request stream, for ``run_available``;
    state per key (resets, token and daily counters, and how many requests fell
    on each timestamp of the trailing minute).  Requests of a key must arrive in
    time order across micro-batches; a micro-batch of any size, of one key or
    many, folds in ranges of bounded rows.  Null tokens count 0, and requests
    without a key are a key of their own."""
    return QuotaStream(stream.select(F.col("event_id").cast("long"), F.col("api_key").cast("long"),
                                     F.col("ts_us").cast("long"), F.col("tokens").cast("long")), anchor_us)


def stream_quota(stream: DataFrame, anchor_us: int | None = None, exact: bool = True,
                 delay: str = "10 minutes") -> DataFrame | QuotaStream:
    """Usage per key on a request stream: the tracker's exact counters
    (``exact=True``, state per key, for ``run_available``) or watermarked sliding-window counts."""
    if exact:
        return stream_quota_exact(stream, anchor_us)
    return stream_quota_windows(stream, delay=delay)


# ---------------------------------------------------------------------------
# running to completion (for jobs and tests)
# ---------------------------------------------------------------------------
def run_available(df: DataFrame | QuotaStream, out_path: str, checkpoint: str, mode: str = "append",
                  fmt: str = "parquet"):
    """Process everything available now into files and stop."""
    if isinstance(df, QuotaStream):
        q = run_available(df.folded(checkpoint), out_path, f"{checkpoint}/written", mode, fmt)
        df.published(checkpoint)
        return q
    q = (df.writeStream.format(fmt).outputMode(mode)
         .option("path", out_path).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def run_updates(df: DataFrame, out_path: str, checkpoint: str):
    """Aggregations in update mode: every micro-batch appends its changed rows
    tagged with the batch id; the latest version of each row is read back with
    ``latest_updates``."""
    def sink(batch: DataFrame, batch_id: int):
        batch.withColumn("_batch", F.lit(batch_id)).write.mode("append").parquet(out_path)

    q = (df.writeStream.outputMode("update").foreachBatch(sink)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def latest_updates(spark: SparkSession, out_path: str, keys: list[str]) -> DataFrame:
    d = spark.read.parquet(out_path)
    vals = [c for c in d.columns if c not in keys and c != "_batch"]
    latest = d.groupBy(*keys).agg(F.max_by(F.struct(*vals), F.col("_batch")).alias("_v"))
    return latest.select(*keys, *[F.col("_v." + c).alias(c) for c in vals])

