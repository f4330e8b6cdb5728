"""Batch intake, outcomes, routing, summaries and error logs.

Set-membership tests of the reference become semi/anti joins; counters become
conditional aggregates; the error log is parsed with an ordered forward fill.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.names import split_ext, stem
from ..session import reliable_checkpoint
from .ranking import forward_fill, row_number_by_buckets

# Fixed values (must equal the reference's for equal results): input
# extensions, the quarantine's log file, the lock-file prefix, the error-log
# header, the log noise token and the error-message phrases.
SUPPORTED = (".doc", ".docx", ".pdf")
ERROR_LOG_NAME = "error_log.txt"
LOCK_PREFIX = "~$"
HEADER = r"(?d)^## (\d\d:\d\d:\d\d) - (.*)$"
NOISE_TOKEN = "AFC"
RATE_LIMIT_PHRASES = ["429", "resource exhausted", "rate limit", "too many requests"]
QUOTA_PHRASES = ["quota exceeded", "usage limit"]
CODE_MARKER = "'code': "


def _ends_with_any(c, suffixes) -> F.Column:
    cond = F.lit(False)
    for s in suffixes:
        cond = cond | c.endswith(s)
    return cond


def filter_supported(files: DataFrame, name: str = "name", quarantine: bool = False) -> DataFrame:
    """``.doc/.docx/.pdf`` case-insensitively; a quarantine listing also
    drops ``error_log.txt``."""
    low = F.lower(F.col(name))
    cond = _ends_with_any(low, SUPPORTED)
    if quarantine:
        cond = cond & (low != ERROR_LOG_NAME)
    return files.filter(cond)


def filter_temp_files(files: DataFrame, name: str = "name") -> DataFrame:
    """Office lock files (``~$`` prefix) are counted but neither converted nor
    failed: status ``skipped``; the rest ``pending``."""
    return files.withColumn("status", F.when(F.lower(F.col(name)).startswith(LOCK_PREFIX), "skipped")
                            .otherwise("pending"))


def _with_stem(files: DataFrame, name: str) -> DataFrame:
    return files.withColumn("_stem", stem(F.col(name)))


def intake_done(inbox: DataFrame, outputs: DataFrame, name: str = "name") -> DataFrame:
    """Supported inputs whose ``<stem>.md`` exists among the output stems."""
    have = outputs.select(F.col("stem").alias("_stem"))
    return _with_stem(filter_supported(inbox, name), name).join(have, "_stem", "left_semi").drop("_stem")


def intake_new(inbox: DataFrame, outputs: DataFrame, name: str = "name") -> DataFrame:
    have = outputs.select(F.col("stem").alias("_stem"))
    return _with_stem(filter_supported(inbox, name), name).join(have, "_stem", "left_anti").drop("_stem")


def intake_select(new_files: DataFrame, quarantine: DataFrame, name: str = "name") -> DataFrame:
    """New inputs if there are any, else the quarantine listing (flagged).

    Both branches are tagged with a priority and unioned; the one-row
    ``min(priority)`` picks the branch, joined by value (a one-row table).
    Every file keeps its own columns (path, size, page count, ...), so equal
    base names stay different files."""
    a = new_files.withColumn("_prio", F.lit(0))
    b = filter_supported(quarantine, name, quarantine=True).withColumn("_prio", F.lit(1))
    both = a.unionByName(b, allowMissingColumns=True)
    chosen = both.agg(F.min("_prio").alias("_prio"))
    return (both.join(F.broadcast(chosen), "_prio")
            .withColumn("from_quarantine", F.col("_prio") == 1).drop("_prio"))


def checkpoint_antijoin(files: DataFrame, processed: DataFrame, key: str = "file_id") -> DataFrame:
    """Files whose id is not in the processed state."""
    return files.join(processed.select(key).distinct(), key, "left_anti")


def merge_processed(old: DataFrame, new: DataFrame, key: str = "file_id") -> DataFrame:
    return old.select(key).unionByName(new.select(key)).distinct()


# ---------------------------------------------------------------------------
# ordering by complexity
# ---------------------------------------------------------------------------
def complexity_score(files: DataFrame, name: str = "name") -> DataFrame:
    """score = bytes x pages; pages = 1 unless a PDF with a known count;
    an unreadable file (no size) scores +infinity."""
    is_pdf = F.lower(F.col(name)).endswith(".pdf")
    pages = F.when(is_pdf & F.col("page_count").isNotNull(), F.col("page_count")).otherwise(F.lit(1))
    score = F.when(F.col("size").isNull(), F.lit(float("inf"))).otherwise(
        (F.col("size") * pages).cast("double"))
    return files.withColumn("pages", F.when(F.col("size").isNull(), 0).otherwise(pages).cast("bigint"))\
        .withColumn("score", score)


def complexity_order(files: DataFrame, name: str = "name", ord_col: str = "ord") -> DataFrame:
    """Ascending score, stable (ties keep input order).  Positions are
    numbered after a range-partitioned sort: ids increase with the sort
    order, and per-partition counts (one row per partition) give offsets."""
    from .ranking import sorted_positions
    s = complexity_score(files, name)
    return sorted_positions(s, [F.col("score").asc(), F.col(ord_col).asc(), F.col(name).asc()], out="position")


def complexity_top5(files: DataFrame, name: str = "name", ord_col: str = "ord", k: int = 5) -> DataFrame:
    """The first ``k`` of the order (a top-k: TakeOrderedAndProject) with MB
    and pages, and how many files follow them."""
    s = complexity_score(files, name)
    top = s.orderBy(F.col("score").asc(), F.col(ord_col).asc()).limit(k)
    n = s.agg(F.count(F.lit(1)).alias("_total"))
    from pyspark.sql import Window
    w = Window.orderBy(F.col("score").asc(), F.col(ord_col).asc())  # k rows only
    size_mb = F.format_string("%.2f", F.coalesce(F.col("size"), F.lit(0)) / F.lit(1024.0 * 1024.0))
    one = F.lit(1).alias("_one")
    return (top.select("*", one).join(n.select("*", one), "_one")
            .select(F.row_number().over(w).cast("bigint").alias("position"), F.col(name).alias("name"),
                    size_mb.alias("size_mb"), "pages",
                    F.greatest(F.col("_total") - F.lit(k), F.lit(0)).cast("bigint").alias("rest")))


# ---------------------------------------------------------------------------
# outcomes and summaries
# ---------------------------------------------------------------------------
def type_counts(outcomes: DataFrame, ext: str = "ext") -> DataFrame:
    return outcomes.groupBy(F.lower(F.col(ext)).alias("ext")).agg(F.count(F.lit(1)).alias("files"))


def _pct(part, total):
    return F.when(total > 0, part.cast("double") * F.lit(100.0) / total.cast("double")).otherwise(F.lit(0.0))


def batch_summary(outcomes: DataFrame, status: str = "status") -> DataFrame:
    """Total, successes and failures with percentages (0 when empty)."""
    s = outcomes.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.count(F.when(F.col(status) == "ok", 1)).alias("success_files"),
        F.count(F.when(F.col(status) == "failed", 1)).alias("failed_files"))
    return s.select("total_files", "success_files",
                    _pct(F.col("success_files"), F.col("total_files")).alias("success_pct"),
                    "failed_files",
                    _pct(F.col("failed_files"), F.col("total_files")).alias("failed_pct"))


def consolidate_stats(results: DataFrame, elapsed: float | None = None, status: str = "status") -> DataFrame:
    """processed / skipped / failed counts; files per second from a supplied
    elapsed time (0 without one)."""
    s = results.agg(
        F.count(F.when(F.col(status) == "processed", 1)).alias("processed"),
        F.count(F.when(F.col(status) == "skipped", 1)).alias("skipped"),
        F.count(F.when(F.col(status) == "failed", 1)).alias("failed"))
    fps = (F.col("processed").cast("double") / F.lit(float(elapsed))) if elapsed and elapsed > 0 else F.lit(0.0)
    return s.withColumn("files_per_second", fps)


def validate_output_format(outputs: DataFrame, action: str = "move", name: str = "name") -> DataFrame:
    """``.txt`` outputs (any case) stay; the rest are routed ``move`` (to the
    error folder) or ``delete``."""
    is_txt = F.lower(F.col(name)).endswith(".txt")
    return outputs.withColumn("route", F.when(is_txt, "keep").otherwise(F.lit(action)))


def output_format_summary(validated: DataFrame) -> DataFrame:
    return validated.groupBy("route").agg(F.count(F.lit(1)).alias("files"))


def route_manifest(outcomes: DataFrame, taken: DataFrame, epoch: int, name: str = "file_name",
                   ord_col: str = "ord") -> DataFrame:
    """Destination per outcome: ``processed/`` (move) for successes,
    ``error/`` (copy: the reference's "move" copies) for failures; a taken
    name gets ``_<epoch>`` before its extension.  Skipped files stay.

    ``taken`` holds names, per ``folder`` if it has that column.  Files with
    equal names take their turn by ``ord_col``: the first gets the name (if
    free), the next ``_<epoch>``, the third ``_<epoch>_2`` and so on; outcomes
    without ``ord_col`` come last, in the order of their other columns.  Without
    a name there is no destination name."""
    by_folder = "folder" in taken.columns
    t = taken.select(F.col("name").alias("_taken"), *([F.col("folder").alias("_in")] if by_folder else [])).distinct()
    o = outcomes.filter(F.col("status") != "skipped").withColumn(
        "folder", F.when(F.col("status") == "ok", "processed/").otherwise("error/"))
    turn = F.struct(F.col(ord_col).isNull(), F.floor(F.col(ord_col) / F.lit(1 << 16)))
    o = row_number_by_buckets(o, [F.col(ord_col).asc_nulls_last(), F.to_json(F.struct(*outcomes.columns))], turn,
                              partition=["folder", name], out="_turn")
    same = F.col(name) == F.col("_taken")
    o = o.join(t, (same & (F.col("folder") == F.col("_in"))) if by_folder else same, "left")
    nth = F.col("_turn") - F.when(F.col("_taken").isNull(), 1).otherwise(0)
    suffix = F.concat(F.lit(f"_{int(epoch)}"), F.when(nth > 1, F.concat(F.lit("_"), nth.cast("string"))).otherwise(""))
    renamed = F.concat(stem(F.col(name)), suffix, split_ext(F.col(name)))
    return o.select(
        *outcomes.columns, "folder",
        F.when(nth > 0, renamed).otherwise(F.col(name)).alias("dest_name"),
        F.when(F.col("status") == "ok", "move").otherwise("copy").alias("action"))


def repair_quarantine(quarantine: DataFrame, extractions: DataFrame, name: str = "name") -> DataFrame:
    """Word files of the quarantine joined to new extraction results: a
    non-empty (stripped) text means fixed, with the text file name the
    reference derives (``str.replace`` of the matched extension, case as
    written); everything else remains."""
    low = F.lower(F.col(name))
    word = quarantine.filter(low.endswith(".doc") | low.endswith(".docx"))
    txt_name = (F.when(low.endswith(".doc"), F.replace(F.col(name), F.lit(".doc"), F.lit(".txt")))
                .otherwise(F.replace(F.col(name), F.lit(".docx"), F.lit(".txt"))))
    ex = extractions.select(F.col(name).alias("_n"), T.py_strip(F.col("text")).alias("_text"))
    j = word.join(ex, F.col(name) == F.col("_n"), "left")
    fixed = F.coalesce(F.col("_text"), F.lit("")) != ""
    return j.select(F.col(name).alias("name"),
                    F.when(fixed, "fixed").otherwise("remains").alias("status"),
                    F.when(fixed, txt_name).alias("txt_name"))


# ---------------------------------------------------------------------------
# logs
# ---------------------------------------------------------------------------
def filter_log_noise(lines: DataFrame, token: str = NOISE_TOKEN, col: str = "line") -> DataFrame:
    return lines.filter(~F.col(col).contains(token))


def parse_error_log(lines: DataFrame, log_id: str = "log_id", line_no: str = "line_no",
                    line: str = "line") -> DataFrame:
    """``## HH:MM:SS - file`` headers; the lines after a header, up to the
    next one, are its message (joined by newlines, stripped)."""
    is_hdr = F.col(line).rlike(HEADER)
    x = lines.withColumn("_hdr", F.when(is_hdr, F.col(line_no)))
    # headers and bodies both read the owner-filled lines: freeze them once
    x = reliable_checkpoint(forward_fill(x, [log_id], line_no, "_hdr", "_owner"))
    heads = x.filter(F.col("_hdr").isNotNull()).select(
        log_id, F.col(line_no).alias("_owner"),
        F.regexp_extract(F.col(line), HEADER, 1).alias("time"),
        F.regexp_extract(F.col(line), HEADER, 2).alias("file"))
    body = (x.filter(F.col("_hdr").isNull() & F.col("_owner").isNotNull())
            .groupBy(log_id, "_owner")
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(line_no), F.col(line)))),
                                          lambda s: s[line]), "\n").alias("_msg")))
    return (heads.join(body, [log_id, "_owner"], "left")
            .select(log_id, F.col("_owner").alias("line_no"), "time", "file",
                    T.py_strip(F.coalesce(F.col("_msg"), F.lit(""))).alias("message")))


def error_details(outcomes: DataFrame, parsed: DataFrame, default: str = "no information",
                  name: str = "name") -> DataFrame:
    """Failed files with their logged message (the last one logged for the
    file), or a default text."""
    last = parsed.groupBy("file").agg(
        F.max_by(F.col("message"), F.struct("log_id", "line_no")).alias("_msg"))
    f = outcomes.filter(F.col("status") == "failed")
    return (f.join(last, F.col(name) == F.col("file"), "left")
            .select(F.col(name).alias("name"), F.coalesce(F.col("_msg"), F.lit(default)).alias("message")))


def classify_api_errors(messages: DataFrame, col: str = "message") -> DataFrame:
    """rate_limit / quota / other, and the error code (429, or the digits
    after ``'code': `` up to the next comma)."""
    m = F.lower(F.col(col))
    # text after the first code marker, up to the next occurrence, up to a comma
    rest = F.substr(m, F.instr(m, CODE_MARKER) + F.lit(len(CODE_MARKER)))
    after = F.substring_index(F.substring_index(rest, CODE_MARKER, 1), ",", 1)
    has_code = F.instr(m, CODE_MARKER) > 0
    digits = T.py_strip(after)
    code = (F.when(m.contains("429"), F.lit(429).cast("bigint"))
            .when(has_code & digits.rlike(r"^[0-9]+$"), digits.cast("bigint")))
    rate = F.lit(False)
    for phrase in RATE_LIMIT_PHRASES:
        rate = rate | m.contains(phrase)
    quota = F.lit(False)
    for phrase in QUOTA_PHRASES:
        quota = quota | m.contains(phrase)
    return messages.withColumn("error_class", F.when(rate, "rate_limit").when(quota, "quota").otherwise("other"))\
        .withColumn("error_code", code)
