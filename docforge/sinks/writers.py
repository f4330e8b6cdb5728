"""Sinks: cleaned corpora, the published dataset with its card, and stage
state for resumable runs.

Every writer goes through Spark's committers (atomic job commit, ``_SUCCESS``
marker), so a lost executor only retries tasks and a half-written stage is
never mistaken for a finished one.  A corpus is read and written once: adaptive
execution sizes the files from the shuffled bytes (``REBALANCE``), and counts
and bytes are observed on the way.
"""

from __future__ import annotations

import json
import uuid
import warnings

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.publish import card_of

DATASET_SCHEMA = "text string, file_name string, file_size bigint"


def _write_sized(df: DataFrame, path: str, mode: str, size, **more) -> dict:
    """Write Parquet files of about ``spark.sql.adaptive.advisoryPartitionSizeInBytes``
    in one pass; what was written as ``documents``, ``total_bytes`` and ``more``."""
    seen = Observation(f"written-{uuid.uuid4().hex}")
    df.observe(seen, F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum(size), F.lit(0)).cast("bigint").alias("total_bytes"),
               *[c.alias(n) for n, c in more.items()]).hint("rebalance").write.mode(mode).parquet(path)
    return dict(seen.get)


def write_corpus(docs: DataFrame, path: str, name: str = "name", text: str = "text", mode: str = "overwrite") -> dict:
    """Cleaned text per document as Parquet ``(name, text)``, never one file per
    document; returns the documents, UTF-8 bytes and characters written."""
    out = docs.select(F.col(name).alias("name"), F.col(text).alias("text"))
    return _write_sized(out, path, mode, F.octet_length("text"),
                        total_chars=F.coalesce(F.sum(F.length("text")), F.lit(0)).cast("bigint"))


def write_dataset(corpus: DataFrame, path: str, title: str | None = None, description: str | None = None,
                  created: str = "1970-01-01", mode: str = "overwrite") -> dict:
    """The published dataset with its fixed schema ``(text, file_name,
    file_size)``; with a ``title`` also its card, built from what was written,
    as a text file under ``<path>/_card``.  Returns documents and bytes."""
    spark, path = corpus.sparkSession, path.rstrip("/")
    ds = corpus.select(F.col("text").cast("string"), F.col("file_name").cast("string"),
                       F.col("file_size").cast("bigint"))
    seen = _write_sized(ds, f"{path}/data", mode, F.col("file_size"))
    if title is not None:
        totals = spark.createDataFrame([(seen["documents"], seen["total_bytes"])], "documents bigint, total_bytes bigint")
        card_of(totals, title, description, created).select("card").coalesce(1).write.mode(mode).text(f"{path}/_card")
    return seen


# ---------------------------------------------------------------------------
# stage state
# ---------------------------------------------------------------------------
def _fs_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def stage_path(base: str, run_id: str, stage: str) -> str:
    return f"{base.rstrip('/')}/{run_id}/{stage}"


def stage_done(spark: SparkSession, base: str, run_id: str, stage: str) -> bool:
    return _fs_exists(spark, stage_path(base, run_id, stage) + "/_SUCCESS")


def write_state(df: DataFrame, base: str, run_id: str, stage: str) -> DataFrame:
    """Persist a stage result and return it read back from storage (which
    also cuts the lineage: later stages start from the written table)."""
    spark = df.sparkSession
    p = stage_path(base, run_id, stage)
    df.write.mode("overwrite").parquet(p)
    return spark.read.parquet(p)


def check_run_options(spark: SparkSession, base: str | None, run_id: str, options: dict) -> None:
    """Remember what a run was started with; a rerun under the same id with
    other inputs or options is refused, since its stored stages are not those
    of this run."""
    if base is None:
        return
    path, now = stage_path(base, run_id, "options"), json.dumps(options, sort_keys=True)
    if stage_done(spark, base, run_id, "options"):
        before = spark.read.text(path).first()[0]
        if before != now:
            raise ValueError(f"run {run_id!r} was started with {before}, not {now}: use another run id")
        return
    spark.createDataFrame([(now,)], "options string").coalesce(1).write.mode("overwrite").text(path)


def resume_stage(spark: SparkSession, base: str | None, run_id: str, stage: str, build) -> DataFrame:
    """The stored result of a finished stage, or ``build()`` written as that
    stage.  Without a base folder, just ``build()``."""
    if base is None:
        return build()
    if stage_done(spark, base, run_id, stage):
        return spark.read.parquet(stage_path(base, run_id, stage))
    return write_state(build(), base, run_id, stage)


# ---------------------------------------------------------------------------
# versioned state (processed ids): each run commits a new version
# ---------------------------------------------------------------------------
def _file_system(spark: SparkSession, base: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(base)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, of = _file_system(spark, path)
    return bool(fs.exists(of(path)) and fs.getFileStatus(of(path)).isDirectory())


def make_folder(spark: SparkSession, path: str) -> None:
    fs, of = _file_system(spark, path)
    fs.mkdirs(of(path))


def drop_batches(spark: SparkSession, base: str, below: int | None = None) -> None:
    """Delete the folders ``<base>/batch=N`` (of ``N < below``): micro-batches that nothing reads again."""
    fs, path = _file_system(spark, base)
    for st in fs.listStatus(path(base)) if fs.exists(path(base)) else []:
        kind, _, number = st.getPath().getName().partition("=")
        if kind == "batch" and number.isdigit() and (below is None or int(number) < below):
            fs.delete(st.getPath(), True)


def _numbers(spark: SparkSession, base: str) -> tuple[list[int], list[int]]:
    """The committed versions, and all that were claimed."""
    fs, path = _file_system(spark, base)
    committed, claimed = [], []
    if not fs.exists(path(base)):
        return committed, claimed
    for st in fs.listStatus(path(base)):
        kind, _, number = st.getPath().getName().partition("=")
        if number.isdigit() and kind in ("v", "claim"):
            claimed.append(int(number))
            if kind == "v" and fs.exists(path(st.getPath(), "_SUCCESS")):
                committed.append(int(number))
    return sorted(committed), sorted(claimed)


def committed_versions(spark: SparkSession, base: str) -> list[int]:
    """The committed versions of a state, oldest first."""
    return _numbers(spark, base)[0]


def read_state(spark: SparkSession, base: str, schema: str) -> DataFrame:
    """The newest committed version of a state table; empty when there is none.

    Versions whose files are damaged are passed over with a warning, newest
    first, and a state without a sound version is empty; that a folder may not
    be read is an error."""
    committed, _ = _numbers(spark, base)
    for v in reversed(committed):
        path = f"{base.rstrip('/')}/v={v}"
        try:
            state = spark.read.schema(schema).parquet(path)
            state.write.format("noop").mode("overwrite").save()    # every file opens
            return state
        except Exception as why:  # noqa: BLE001 - a damaged file surfaces as any of Spark's errors
            if any(x in str(why) for x in ("AccessControlException", "Permission denied")):
                raise
            warnings.warn(f"state version {path} cannot be read, trying an older one: {type(why).__name__}", stacklevel=2)
    return spark.createDataFrame([], schema)


def claim_version(spark: SparkSession, base: str) -> int:
    """Claim the next version: a marker file that only one run can create.  A
    run that finds its number taken tries the next one."""
    fs, path = _file_system(spark, base)
    v = max(_numbers(spark, base)[1], default=0) + 1
    while True:
        try:
            fs.create(path(f"{base.rstrip('/')}/claim={v}"), False).close()
            return v
        except Py4JJavaError as why:
            if "FileAlreadyExistsException" not in str(why.java_exception):
                raise
            v += 1


def write_state_version(df: DataFrame, base: str, version: int | None = None) -> int:
    """Commit ``df`` as a version of its own (``claim_version``, or one that was
    claimed before the run began); a failed write leaves a claim, no version."""
    v = claim_version(df.sparkSession, base) if version is None else version
    df.write.mode("errorifexists").parquet(f"{base.rstrip('/')}/v={v}")
    return v
