"""Command line: ``python -m docforge <job> ...`` (or through spark-submit,
which supplies the master and the cluster's checkpoint folder)."""

from __future__ import annotations

import argparse
import json
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _session(master: str | None) -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    from .session import get_spark
    return get_spark(master=master)


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="docforge", description="Document corpus preparation on Spark")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="job", required=True)

    d = sub.add_parser("dedup", help="find duplicate files (size, name, content) and plan actions")
    d.add_argument("directory")
    d.add_argument("out")
    d.add_argument("-i", "--include", nargs="+", default=[])
    d.add_argument("-e", "--exclude", nargs="+", default=[])
    d.add_argument("-d", "--max-depth", type=int)
    d.add_argument("-k", "--keep", choices=["newest", "oldest", "first_found"], default="newest")
    d.add_argument("-s", "--symlink", action="store_true")
    d.add_argument("-c", "--chunk-size", type=int, default=8192)
    d.add_argument("--state-dir")
    d.add_argument("--run-id", default="dedup")
    d.add_argument("--decisions", help="Parquet table (group_key, choice d|k|s, keep_path) to apply")

    c = sub.add_parser("clean", help="Markdown folder to plain-text corpus")
    c.add_argument("md_dir")
    c.add_argument("out")
    c.add_argument("--txt-dir", help="folder of existing .txt outputs to skip")
    c.add_argument("--override", action="store_true")

    k = sub.add_parser("consolidate", help="collision-free names for a tree flattened into one folder")
    k.add_argument("source")
    k.add_argument("out")
    k.add_argument("--target", help="existing target folder (its names are taken)")
    k.add_argument("--state", help="processed-id state (Parquet)")
    k.add_argument("--overwrite", action="store_true")

    n = sub.add_parser("intake", help="plan a conversion batch")
    n.add_argument("inbox")
    n.add_argument("outputs")
    n.add_argument("errors")
    n.add_argument("out")

    e = sub.add_parser("finish", help="routes, error details and summary at the end of a conversion batch")
    e.add_argument("outcomes", help="Parquet table (ord, name, file_name, ext, status)")
    e.add_argument("error_log")
    e.add_argument("processed_dir")
    e.add_argument("error_dir")
    e.add_argument("out")

    v = sub.add_parser("validate", help="outputs that are no .txt files")
    v.add_argument("folder")
    v.add_argument("out")
    v.add_argument("--action", choices=["move", "delete"], default="move")

    r = sub.add_parser("repair", help="quarantined Word files against new extraction results")
    r.add_argument("folder")
    r.add_argument("extractions", help="Parquet table (name, text)")
    r.add_argument("out")

    u = sub.add_parser("publish", help="dataset (text, file_name, file_size) and its card")
    u.add_argument("txt_dir")
    u.add_argument("out")
    u.add_argument("--title", required=True)
    u.add_argument("--pattern", default="*.txt")
    u.add_argument("--description")

    a = p.parse_args(argv)
    spark = _session(a.master)
    from . import plans  # noqa: F401
    from .plans import jobs
    from .sources.files import walk_files
    from .functions.names import base_name
    t0 = time.time()
    if a.job == "dedup":
        out = jobs.dedup_job(spark, a.directory, a.out, a.include, a.exclude, a.max_depth, a.keep, a.symlink,
                             a.chunk_size, time.strftime("%Y-%m-%d %H:%M:%S"), a.state_dir, a.run_id)
        if a.decisions:
            from .operators.dedup import apply_decisions
            members = spark.read.parquet(a.out.rstrip("/") + "/members")
            applied = apply_decisions(members, spark.read.parquet(a.decisions))
            applied.write.mode("overwrite").parquet(a.out.rstrip("/") + "/decided")
            out["decided"] = spark.read.parquet(a.out.rstrip("/") + "/decided").count()
    elif a.job == "clean":
        out = jobs.clean_job(spark, a.md_dir, a.txt_dir, a.out, a.override)
    elif a.job == "consolidate":
        taken = (walk_files(spark, a.target, recursive=False).select(base_name(F.col("path")).alias("name"))
                 if a.target else None)
        out = jobs.consolidate_job(spark, a.source, taken, a.out, a.state, a.overwrite)
    elif a.job == "intake":
        out = {"files": jobs.intake_job(spark, a.inbox, a.outputs, a.errors, a.out)}
    elif a.job == "finish":
        out = jobs.finish_job(spark, spark.read.parquet(a.outcomes), a.error_log, a.processed_dir, a.error_dir, a.out, int(t0))
    elif a.job == "validate":
        out = jobs.validate_job(spark, a.folder, a.out, a.action)
    elif a.job == "repair":
        out = jobs.repair_job(spark, a.folder, spark.read.parquet(a.extractions), a.out)
    else:
        out = jobs.publish_job(spark, a.txt_dir, a.out, a.title, a.pattern, a.description,
                               time.strftime("%Y-%m-%d"))
    out["seconds"] = round(time.time() - t0, 2)
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
