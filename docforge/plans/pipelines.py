"""End-to-end jobs composed from the operators.

Each returns DataFrames (lazy plans); writing is left to the caller or done
through ``docforge.sinks`` when a path is given.  With ``state_dir``, stage
results are written under ``<state_dir>/<run_id>/<stage>`` and a rerun with
the same run id reads finished stages back instead of recomputing them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import file_id
from ..operators import clean as C
from ..operators import dedup as D
from ..operators import intake as I
from ..operators.consolidate import allocate_names
from ..operators.publish import dataset_card
from ..sinks.writers import check_run_options, resume_stage
from ..session import reliable_checkpoint


@dataclass
class DedupResult:
    members: DataFrame
    stats: DataFrame
    plan: DataFrame


def dedup_corpus(manifest: DataFrame, include=(), exclude=(), max_depth: int | None = None,
                 strategy: str = "newest", symlink: bool = False, content: str = "text",
                 use_prefix: bool = True, chunk_size: int = 8192,
                 state_dir: str | None = None, run_id: str = "dedup", source: str = "") -> DedupResult:
    """Scan filters, size and name stages, content stage, keeper policy,
    statistics and the action plan.  A run with ``state_dir`` resumes its
    finished stages; the same run id with another ``source`` or other options
    is refused."""
    spark = manifest.sparkSession
    check_run_options(spark, state_dir, run_id, {
        "source": source, "include": sorted(include or ()), "exclude": sorted(exclude or ()), "max_depth": max_depth,
        "strategy": strategy, "content": content, "use_prefix": use_prefix, "chunk_size": chunk_size})
    # content is hashed in the scan and left behind; every stage reads slim rows
    m = resume_stage(spark, state_dir, run_id, "manifest", lambda: D.slim_manifest(
        D.filter_depth(D.filter_extensions(manifest, include, exclude), max_depth), content, chunk_size))
    if state_dir is None:
        m = reliable_checkpoint(m)
    stats_n = resume_stage(spark, state_dir, run_id, "names", lambda: D.name_stats(m, strategy))
    # one join carries each file's group counts to both stages
    counted = m.join(stats_n.select("size", "name", "n", "size_n", "keep_ord"), ["size", "name"])
    names = resume_stage(
        spark, state_dir, run_id, "filename_groups",
        lambda: D.filename_members(counted))
    contents = resume_stage(
        spark, state_dir, run_id, "content_groups",
        lambda: D.content_dups(D.content_candidates(counted), strategy, content, use_prefix, chunk_size))
    members = names.unionByName(contents)
    if state_dir is None:
        # stats and plan both read the members: freeze them once (they are
        # only the duplicates, a small table next to the manifest)
        members = reliable_checkpoint(members)
    return DedupResult(members, D.dedup_stats(members, m), D.action_plan(members, symlink))


def clean_corpus(markdown: DataFrame, existing_texts: DataFrame | None = None, override: bool = False,
                 key: str = "name") -> tuple[DataFrame, DataFrame]:
    """Skip documents whose text output exists, clean the rest; returns the
    cleaned documents and the summary row (unreadable documents, with a null
    text, are counted as failed)."""
    todo = markdown if existing_texts is None else C.skip_existing_text(markdown, existing_texts, override)
    outcomes = C.clean_outcomes(todo, key=key)
    return outcomes.where("status = 'ok'").select(key, "text"), C.clean_summary(outcomes)


def consolidate_corpus(files: DataFrame, processed: DataFrame, taken: DataFrame | None = None,
                       overwrite: bool = False, elapsed: float | None = None):
    """File ids, skip processed ids, collision-free target names; returns the
    per-file results, the statistics and the new processed-id state."""
    f = files.withColumn("file_id", file_id(F.col("path"), F.col("mtime_us"), F.col("size")))
    todo = I.checkpoint_antijoin(f, processed, "file_id")
    placed = allocate_names(todo, taken, overwrite)
    skipped = f.join(processed.select("file_id").distinct(), "file_id", "left_semi")
    results = (placed.select("ord", "file_id", "name", "target_name", F.lit("processed").alias("status"))
               .unionByName(skipped.select("ord", "file_id", "name", F.lit(None).cast("string").alias("target_name"),
                                           F.lit("skipped").alias("status"))))
    new_state = I.merge_processed(processed, placed, "file_id")
    return results, I.consolidate_stats(results, elapsed), new_state


def intake_batch(inbox: DataFrame, outputs: DataFrame, quarantine: DataFrame) -> DataFrame:
    """What a conversion batch will do: the chosen source (new inputs, else
    the quarantine), in complexity order, with lock files marked skipped."""
    chosen = I.intake_select(I.intake_new(inbox, outputs), quarantine)
    ordered = I.complexity_order(chosen)
    return I.filter_temp_files(ordered).select("position", "name", "from_quarantine", "pages", "score", "status")


@dataclass
class BatchEnd:
    files: DataFrame
    types: DataFrame
    summary: DataFrame


def finish_batch(outcomes: DataFrame, log_lines: DataFrame, taken: DataFrame, epoch: int) -> BatchEnd:
    """The end of a conversion batch: every outcome of ``outcomes(ord, name,
    file_name, ext, status)`` with where its file goes and, if it failed, the
    last message of the error log for ``name``.  Joined once and frozen; type
    counts and the summary are read from that table.  Skipped files have no
    folder.  ``taken(name[, folder])``: names in the target folders."""
    routed = I.route_manifest(outcomes, taken, epoch, name="file_name").select("ord", "folder", "dest_name", "action")
    failed = outcomes.where("status = 'failed'").select("ord", "name", "status")
    told = failed.join(I.error_details(failed, I.parse_error_log(log_lines)).distinct(), "name").select("ord", "message")
    files = reliable_checkpoint(outcomes.join(routed, "ord", "left").join(told, "ord", "left"))
    return BatchEnd(files, I.type_counts(files), I.batch_summary(files))


def publish_corpus(corpus: DataFrame, title: str, description: str | None = None,
                   created: str = "1970-01-01") -> tuple[DataFrame, DataFrame]:
    """The dataset with its fixed schema and its card."""
    ds = corpus.select(F.col("text").cast("string"), F.col("file_name").cast("string"),
                       F.col("file_size").cast("bigint"))
    return ds, dataset_card(ds, title, description, created)
