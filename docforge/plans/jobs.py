"""File-to-file jobs: the pipelines run on folders, with results written as
Parquet (and the report / card as text).  Physical file moves are not done;
every job writes the plan of what should happen (see README, "Not built").
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.names import base_name, stem
from ..operators import clean as C
from ..operators import dedup as D
from ..operators import intake as I
from ..session import reliable_checkpoint
from ..sinks.writers import (
    check_run_options,
    claim_version,
    read_state,
    resume_stage,
    write_corpus,
    write_dataset,
    write_state_version,
)
from ..sources import files as S
from . import pipelines as PL


def _out(path: str, part: str) -> str:
    return f"{path.rstrip('/')}/{part}"


def dedup_job(spark: SparkSession, directory: str, out: str, include=(), exclude=(), max_depth=None,
              strategy: str = "newest", symlink: bool = False, chunk_size: int = 8192,
              report_at: str = "", state_dir: str | None = None, run_id: str = "dedup") -> dict:
    """Scan, filter, run the cascade once (members with their report order,
    checkpointed), then write members, the action plan and the report.  With
    ``state_dir`` the listing and the members are stored under ``run_id``, and
    a rerun reads them back; another directory or other options are refused."""
    check_run_options(spark, state_dir, run_id, {
        "directory": directory, "include": sorted(include or ()), "exclude": sorted(exclude or ()),
        "max_depth": max_depth, "strategy": strategy, "chunk_size": chunk_size})
    filtered = resume_stage(spark, state_dir, run_id, "listing", lambda: D.filter_depth(
        D.filter_extensions(S.scan_manifest(spark, directory), include, exclude), max_depth))
    ordered = resume_stage(spark, state_dir, run_id, "ordered_members", lambda: D.dup_members(
        filtered, strategy, content="content", chunk_size=chunk_size, with_order=True))
    if state_dir is None:
        ordered = reliable_checkpoint(ordered)
    members = ordered.select(*D.MEMBER_COLS)
    members.write.mode("overwrite").parquet(_out(out, "members"))
    D.action_plan(members, symlink).write.mode("overwrite").parquet(_out(out, "plan"))
    report = D.dup_report(ordered, filtered, directory, report_at, content="content", chunk_size=chunk_size,
                          strategy=strategy)
    (report.orderBy("group_no", "line_no").select("line")
     .write.mode("overwrite").text(_out(out, "report")))
    stats = D.dedup_stats(members, filtered).first().asDict()
    return stats | {"groups": members.select("stage", "group_key").distinct().count()}


def clean_job(spark: SparkSession, md_dir: str, txt_dir: str | None, out: str, override: bool = False) -> dict:
    """Clean the Markdown files of a folder; every file is read once.  Files
    that cannot be read count as failed."""
    md = S.read_markdown(spark, md_dir)
    existing = None
    if txt_dir:
        existing = S.walk_files(spark, txt_dir, recursive=False).select(base_name(F.col("path")).alias("name"))
    todo = md if existing is None else C.skip_existing_text(md, existing, override)
    outcomes = C.clean_outcomes(todo, key="name")
    failed = Observation(f"failed-{uuid.uuid4().hex}")
    outcomes = outcomes.observe(failed, F.count(F.when(F.col("status") != "ok", 1)).alias("failed_files"))
    seen = write_corpus(outcomes.where("status = 'ok'").withColumn("name", F.concat(stem(F.col("name")), F.lit(".txt"))), out)
    return {"successful_files": seen["documents"], **failed.get, "total_chars": seen["total_chars"]}


def consolidate_job(spark: SparkSession, source: str, target_names: DataFrame | None, out: str,
                    state: str | None = None, overwrite: bool = False) -> dict:
    began = time.monotonic()
    version = claim_version(spark, state) if state else None
    files = S.scan_manifest(spark, source).select("ord", "path", "name", "mtime_us", "size")
    processed = (read_state(spark, state, "file_id string") if state
                 else spark.createDataFrame([], "file_id string"))
    results, _, _ = PL.consolidate_corpus(files, processed, target_names, overwrite)
    results.write.mode("overwrite").parquet(_out(out, "results"))
    written = spark.read.parquet(_out(out, "results"))
    if state:
        # the next version is the old ids plus this run's processed ids
        write_state_version(
            processed.select("file_id").unionByName(
                written.filter(F.col("status") == "processed").select("file_id")).distinct(), state, version)
    return I.consolidate_stats(written, time.monotonic() - began).first().asDict()


def intake_job(spark: SparkSession, inbox_dir: str, output_dir: str, error_dir: str, out: str) -> int:
    inbox = S.scan_manifest(spark, inbox_dir).select(
        "path", "name", "size", "ord", F.lit(None).cast("bigint").alias("page_count"))
    outputs = S.walk_files(spark, output_dir, recursive=False).select(base_name(F.col("path")).alias("name"))\
        .filter(F.col("name").endswith(".md")).select(stem(F.col("name")).alias("stem"))
    quarantine = S.scan_manifest(spark, error_dir).select(
        "path", "name", "size", "ord", F.lit(None).cast("bigint").alias("page_count"))
    # inputs that are converted already leave the inbox
    I.intake_done(inbox, outputs).select("path", "name", F.lit("processed/").alias("folder"), F.lit("move").alias("action"))\
        .write.mode("overwrite").parquet(_out(out, "done"))
    plan = PL.intake_batch(inbox, outputs, quarantine)
    plan.write.mode("overwrite").parquet(_out(out, "intake"))
    return spark.read.parquet(_out(out, "intake")).count()


def _names(spark: SparkSession, folder: str) -> DataFrame:
    return S.walk_files(spark, folder, recursive=False).select(base_name(F.col("path")).alias("name"))


def finish_job(spark: SparkSession, outcomes: DataFrame, error_log: str, processed_dir: str, error_dir: str,
               out: str, epoch: int) -> dict:
    """The end of a conversion batch: where every file of ``outcomes(ord, name,
    file_name, ext, status)`` goes, what the error log (a text file) says about
    the failed ones, counts by type, and the summary."""
    log = S.read_text_corpus(spark, error_log).select(
        F.lit(0).cast("bigint").alias("log_id"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    log = log.withColumn("line_no", F.col("line_no").cast("bigint"))
    taken = _names(spark, processed_dir).withColumn("folder", F.lit("processed/")).unionByName(
        _names(spark, error_dir).withColumn("folder", F.lit("error/")))
    end = PL.finish_batch(outcomes, log, taken, epoch)
    end.files.write.mode("overwrite").parquet(_out(out, "files"))
    end.types.write.mode("overwrite").parquet(_out(out, "types"))
    return end.summary.first().asDict()


def validate_job(spark: SparkSession, folder: str, out: str, action: str = "move") -> dict:
    """What happens to the outputs of a folder that are no ``.txt`` files."""
    I.validate_output_format(_names(spark, folder), action).write.mode("overwrite").parquet(_out(out, "routes"))
    routes = spark.read.parquet(_out(out, "routes"))
    return {r["route"]: r["files"] for r in I.output_format_summary(routes).collect()}


def repair_job(spark: SparkSession, folder: str, extractions: DataFrame, out: str) -> dict:
    """Quarantined Word files against new extraction results ``(name, text)``."""
    I.repair_quarantine(_names(spark, folder), extractions).write.mode("overwrite").parquet(_out(out, "repaired"))
    counts = spark.read.parquet(_out(out, "repaired")).groupBy("status").count()
    return {r["status"]: r["count"] for r in counts.collect()}


def publish_job(spark: SparkSession, txt_dir: str, out: str, title: str, pattern: str = "*.txt",
                description: str | None = None, created: str = "") -> dict:
    """Publish the text files of a folder; every file is read once."""
    return write_dataset(S.read_text_corpus(spark, txt_dir, pattern), out, title, description, created)


__all__ = ["dedup_job", "clean_job", "consolidate_job", "intake_job", "finish_job", "validate_job", "repair_job",
           "publish_job"]
