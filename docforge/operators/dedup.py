"""Duplicate search as a cascade of relational steps.

Input is a *manifest*: one row per file with ``path, name, ext, depth, size,
mtime_us, ord`` (``ord`` = scan order, unique) and, for the content stage, a
content column (text or binary) or a precomputed ``md5`` column.

Plan shape (what Catalyst gets):

1. one aggregate over ``(size, name)`` -- map-side partial aggregation, so a
   size or name held by a third of all files is a handful of partial rows per
   task, never a collected group;
2. size sharing and filename groups are derived from that aggregate;
3. content hashing runs only for the files left as candidates, and groups are
   again an aggregate over ``(size, md5)``;
4. the keeper of every group is an aggregate (``max``/``min`` of
   ``struct(mtime_us, ord)``), joined back to the members.  The join is an
   equi-join on the group key: AQE broadcasts the group table when its
   measured size is small and splits a skewed key otherwise.

No step sorts or collects a whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


from ..session import reliable_checkpoint
from ..functions.names import format_size, relative_link
from .ranges import in_ranges, running_sums

STRATEGIES = ("newest", "oldest", "first_found")
MEMBER_COLS = ["stage", "group_key", "size", "path", "ord", "mtime_us", "role"]


# ---------------------------------------------------------------------------
# filters
# ---------------------------------------------------------------------------
def _norm_exts(exts) -> list[str]:
    return [e.lower() if e.startswith(".") else "." + e.lower() for e in (exts or [])]


def filter_extensions(manifest: DataFrame, include=(), exclude=()) -> DataFrame:
    """Keep if (no include list or ext in it) and ext not excluded."""
    inc, exc = _norm_exts(include), _norm_exts(exclude)
    ext = F.lower(F.col("ext"))
    cond = F.lit(True)
    if inc:
        cond = cond & ext.isin(inc)
    if exc:
        cond = cond & ~ext.isin(exc)
    return manifest.filter(cond)


def filter_depth(manifest: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Files in the root (depth 0) always pass; others need depth <= max_depth."""
    if max_depth is None:
        return manifest
    return manifest.filter((F.col("depth") == 0) | (F.col("depth") <= F.lit(max_depth)))


# ---------------------------------------------------------------------------
# size and name stages
# ---------------------------------------------------------------------------
def scan_totals(manifest: DataFrame) -> DataFrame:
    return manifest.agg(F.count(F.lit(1)).alias("total_files"),
                        F.coalesce(F.sum("size"), F.lit(0)).cast("bigint").alias("total_size"))


def _keeper(strategy: str) -> Column:
    if strategy == "newest":   # greatest mtime, ties to the last in scan order
        return F.max(F.struct("mtime_us", "ord"))["ord"]
    if strategy == "oldest":   # least mtime, ties to the first in scan order
        return F.min(F.struct("mtime_us", "ord"))["ord"]
    if strategy == "first_found":
        return F.min("ord")
    raise ValueError(f"unknown keep strategy {strategy!r}")


def name_stats(manifest: DataFrame, strategy: str = "newest") -> DataFrame:
    """Per ``(size, name)``: member count, first scan position, keeper, plus
    per-size totals (files sharing the size, first scan position of the size).
    """
    g = manifest.groupBy("size", "name").agg(
        F.count(F.lit(1)).alias("n"), F.min("ord").alias("first_ord"),
        _keeper(strategy).alias("keep_ord"))
    s = g.groupBy("size").agg(F.sum("n").alias("size_n"), F.min("first_ord").alias("size_first_ord"))
    return g.join(s, "size")


def size_groups(manifest: DataFrame) -> DataFrame:
    """Files whose size is shared by two or more files."""
    shared = manifest.groupBy("size").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("size")
    return manifest.join(shared, "size", "left_semi")


def _members(files: DataFrame, groups: DataFrame | None, on: list[str] | None, stage: str, key: Column) -> DataFrame:
    m = files.join(groups, on) if groups is not None else files
    return m.select(
        F.lit(stage).alias("stage"),
        F.concat_ws(":", F.lit(stage[0]), F.col("size").cast("string"), key).alias("group_key"),
        "size", "path", "ord", "mtime_us",
        F.when(F.col("ord") == F.col("keep_ord"), "keep").otherwise("delete").alias("role"))


def filename_dups(manifest: DataFrame, strategy: str = "newest", stats: DataFrame | None = None) -> DataFrame:
    """Equal size and equal (case-sensitive) base name: a duplicate group,
    without looking at content.  Long form, one row per member."""
    stats = stats if stats is not None else name_stats(manifest, strategy)
    groups = stats.filter("n > 1").select("size", "name", "keep_ord")
    return _members(manifest, groups, ["size", "name"], "filename", F.col("name"))


def filename_dups_verified(manifest: DataFrame, strategy: str = "newest", content: str = "text") -> DataFrame:
    """``verify_names``: equal size and name count as duplicates only when
    the contents hash equal too (the reference groups on name alone)."""
    h = with_content_hash(size_groups(manifest), content)
    groups = (h.groupBy("size", "name", "md5")
              .agg(F.count(F.lit(1)).alias("n"), _keeper(strategy).alias("keep_ord"))
              .filter("n > 1").drop("n"))
    return _members(h, groups, ["size", "name", "md5"], "filename",
                    F.concat_ws(":", F.col("name"), F.col("md5")))


def filename_members(counted: DataFrame) -> DataFrame:
    """Filename-group members from a manifest joined to its name counts."""
    return _members(counted.filter("n > 1"), None, None, "filename", F.col("name"))


def content_candidates(counted: DataFrame) -> DataFrame:
    """Content-stage candidates from a manifest joined to its name counts."""
    return counted.filter("n = 1 AND size_n > 1").drop("n", "size_n", "keep_ord")


def exclude_name_dups(manifest: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Content-stage candidates: files of a shared size that are in no
    filename group (every member of a filename group leaves, keeper too)."""
    stats = stats if stats is not None else name_stats(manifest)
    keep = stats.filter("n = 1 AND size_n > 1").select("size", "name")
    return manifest.join(keep, ["size", "name"], "left_semi")


# ---------------------------------------------------------------------------
# content stage
# ---------------------------------------------------------------------------
def _as_binary(c: Column) -> Column:
    return c.cast("binary")


def with_content_hash(df: DataFrame, content: str = "text", out: str = "md5") -> DataFrame:
    """md5 of the content bytes (UTF-8 for text columns)."""
    return df.withColumn(out, F.md5(_as_binary(F.col(content))))


def with_prefix_hash(df: DataFrame, content: str = "text", chunk_size: int = 8192,
                     out: str = "prefix_md5") -> DataFrame:
    """md5 of the first ``chunk_size`` bytes."""
    return df.withColumn(out, F.md5(F.substring(_as_binary(F.col(content)), 1, chunk_size)))


def slim_manifest(manifest: DataFrame, content: str = "text", chunk_size: int = 8192) -> DataFrame:
    """A manifest with ``md5`` and ``prefix_md5`` in the place of its content
    column: both are expressions of the scan, so no later step of the cascade
    moves content.  A listing without content stays as it is (its candidates
    are hashed by the file reader)."""
    if content not in manifest.columns:
        return manifest
    return with_content_hash(with_prefix_hash(manifest, content, chunk_size), content).drop(content)


def prefix_candidates(candidates: DataFrame, content: str = "text", chunk_size: int = 8192) -> DataFrame:
    """Candidates whose ``(size, prefix md5)`` is shared by two or more.

    An optional prefilter: equal files have equal prefixes, so the full-hash
    groups are the same with or without it.  Without a content column the
    files are read on the executors (first ``chunk_size`` bytes only).  A slim
    manifest's ``prefix_md5`` is used as it is."""
    if "prefix_md5" in candidates.columns:
        h = candidates
    elif content in candidates.columns:
        h = with_prefix_hash(candidates, content, chunk_size)
    else:
        from ..sources.files import hash_files
        h = hash_files(candidates, chunk_size, first_chunk_only=True).filter(F.col("prefix_md5").isNotNull())
    shared = h.groupBy("size", "prefix_md5").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("prefix_first_ord"))\
        .filter("n > 1").drop("n")
    return h.join(shared, ["size", "prefix_md5"])


def content_groups(hashed: DataFrame, strategy: str = "newest") -> DataFrame:
    return (hashed.filter(F.col("md5").isNotNull())
            .groupBy("size", "md5")
            .agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("first_ord"),
                 _keeper(strategy).alias("keep_ord"))
            .filter("n > 1"))


def content_dups(candidates: DataFrame, strategy: str = "newest", content: str = "text",
                 use_prefix: bool = True, chunk_size: int = 8192) -> DataFrame:
    """Full-hash groups inside a size.  ``candidates`` may already carry
    ``md5`` (for files hashed by the file reader); otherwise it is computed
    from ``content``.  Files that could not be hashed (null) are left out."""
    c = prefix_candidates(candidates, content, chunk_size) if use_prefix else candidates
    if "md5" not in c.columns:
        if content in c.columns:
            c = with_content_hash(c, content)
        else:   # a file listing: stream the remaining files on the executors
            from ..sources.files import hash_files
            c = hash_files(c, chunk_size)
    groups = content_groups(c, strategy).select("size", "md5", "keep_ord")
    return _members(c, groups, ["size", "md5"], "content", F.col("md5"))


def keep_policy(groups: DataFrame, strategy: str = "newest") -> DataFrame:
    """Re-pick the keeper of existing groups (long form) with a strategy."""
    k = groups.groupBy("stage", "group_key").agg(_keeper(strategy).alias("keep_ord"))
    return (groups.drop("role").join(k, ["stage", "group_key"])
            .withColumn("role", F.when(F.col("ord") == F.col("keep_ord"), "keep").otherwise("delete"))
            .select(*MEMBER_COLS))


# ---------------------------------------------------------------------------
# whole cascade
# ---------------------------------------------------------------------------
def dup_members(manifest: DataFrame, strategy: str = "newest", content: str = "text",
                use_prefix: bool = True, chunk_size: int = 8192, with_order: bool = False) -> DataFrame:
    """Filename groups followed by content groups, long form.

    ``with_order`` adds the report order of each group: first scan position
    of its size, of its prefix group (content groups; the group itself for
    filename groups) and of the group.

    The content is hashed in one scan and left behind; the slim rows are
    frozen once and every step reads them."""
    if content in manifest.columns:
        manifest = reliable_checkpoint(slim_manifest(manifest, content, chunk_size))
    stats = name_stats(manifest, strategy)
    # one join carries each file's group counts; both stages branch from it
    m = manifest.join(stats.select("size", "name", "n", "size_n", "keep_ord"), ["size", "name"])
    names = filename_members(m)
    cands = content_candidates(m)
    if not with_order:
        contents = content_dups(cands, strategy, content, use_prefix, chunk_size)
        return names.unionByName(contents)
    size_first = stats.select("size", "size_first_ord").distinct()
    name_first = stats.filter("n > 1").select("size", F.concat_ws(
        ":", F.lit("f"), F.col("size").cast("string"), F.col("name")).alias("group_key"),
        "first_ord", F.col("first_ord").alias("prefix_first_ord"))
    names = names.join(name_first, ["size", "group_key"])
    c = prefix_candidates(cands, content, chunk_size)
    if "md5" not in c.columns:
        from ..sources.files import hash_files
        c = hash_files(c, chunk_size)
    groups = (c.groupBy("size", "md5")
              .agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("first_ord"),
                   F.min("prefix_first_ord").alias("prefix_first_ord"), _keeper(strategy).alias("keep_ord"))
              .filter("n > 1").drop("n"))
    contents = c.drop("prefix_first_ord").join(groups, ["size", "md5"]).select(
        F.lit("content").alias("stage"),
        F.concat_ws(":", F.lit("c"), F.col("size").cast("string"), F.col("md5")).alias("group_key"),
        "size", "path", "ord", "mtime_us",
        F.when(F.col("ord") == F.col("keep_ord"), "keep").otherwise("delete").alias("role"),
        "first_ord", "prefix_first_ord")
    return names.unionByName(contents).join(size_first, "size")


all_dups = dup_members


def dedup_stats(members: DataFrame, manifest: DataFrame) -> DataFrame:
    """Totals of the scan and of the non-kept members of all groups."""
    d = members.agg(
        F.count(F.when(F.col("role") == "delete", 1)).alias("duplicate_files"),
        F.coalesce(F.sum(F.when(F.col("role") == "delete", F.col("size"))), F.lit(0))
        .cast("bigint").alias("duplicate_size"))
    # both sides are one-row global aggregates: join them on a constant key
    one = F.lit(1).alias("_one")
    return scan_totals(manifest).select("*", one).join(d.select("*", one), "_one").drop("_one")


def kept_corpus(manifest: DataFrame, members: DataFrame) -> DataFrame:
    """Files left after deleting every non-kept member."""
    gone = members.filter(F.col("role") == "delete").select("path")
    return manifest.join(gone, "path", "left_anti")


# ---------------------------------------------------------------------------
# actions
# ---------------------------------------------------------------------------
def _with_keep_path(members: DataFrame) -> DataFrame:
    keepers = members.filter(F.col("role") == "keep").select(
        "stage", "group_key", F.col("path").alias("keep_path"))
    return members.join(keepers, ["stage", "group_key"], "left")


def action_plan(members: DataFrame, symlink: bool = False) -> DataFrame:
    """One row per action on a non-kept member; nothing is touched."""
    d = _with_keep_path(members).filter(F.col("role") == "delete")
    link = relative_link(F.col("keep_path"), F.col("path"))
    return d.select(
        "stage", "group_key", "path", "keep_path",
        F.lit("symlink" if symlink else "delete").alias("action"),
        (link if symlink else F.lit(None).cast("string")).alias("link_target"))


def apply_decisions(members: DataFrame, decisions: DataFrame) -> DataFrame:
    """Per-group choices: ``d`` delete, ``k`` keep all, ``s`` symlink; an
    optional ``keep_path`` replaces the keeper when it is a member.  Groups
    without a decision stay untouched (action ``none``).  Of several decisions
    for a group the one with the largest ``ord`` holds (without that column, the
    last in the order of choice and path)."""
    said = F.struct("choice", F.col("keep_path").alias("_new_keep"))
    last = F.max_by(said, "ord") if "ord" in decisions.columns else F.max(said)
    dec = decisions.groupBy("group_key").agg(last.alias("_d")).select("group_key", "_d.*")
    in_group = (members.join(dec.filter(F.col("_new_keep").isNotNull()), "group_key")
                .filter(F.col("path") == F.col("_new_keep"))
                .select("stage", "group_key", F.lit(True).alias("_replace")))
    m = (members.join(dec, "group_key", "left")
         .join(in_group, ["stage", "group_key"], "left"))
    role = (F.when(F.col("_replace").isNull(), F.col("role"))
            .when(F.col("path") == F.col("_new_keep"), "keep").otherwise("delete"))
    m = m.withColumn("role", role)
    keepers = m.filter(F.col("role") == "keep").select("stage", "group_key", F.col("path").alias("keep_path"))
    m = m.join(keepers, ["stage", "group_key"], "left")
    action = (F.when(F.col("choice").isNull(), "none")
              .when(F.col("choice") == "k", "keep")
              .when(F.col("role") == "keep", "keep")
              .when(F.col("choice") == "d", "delete")
              .when(F.col("choice") == "s", "symlink")
              .otherwise("none"))
    return m.select(
        "stage", "group_key", "size", "path", "role",
        action.alias("action"),
        F.when(action == "symlink", relative_link(F.col("keep_path"), F.col("path"))).alias("link_target"))


# ---------------------------------------------------------------------------
# report
# ---------------------------------------------------------------------------
def dup_report(members: DataFrame, manifest: DataFrame, directory: str, at: str,
               content: str = "text", chunk_size: int = 8192, strategy: str = "newest") -> DataFrame:
    """The text report as rows ``(group_no, line_no, line)``; group 0 is the
    header.  Sorting by ``(group_no, line_no)`` gives the file.

    ``members`` should come from ``dup_members(..., with_order=True)``;
    otherwise the order columns are recomputed.  All lines but the header are
    put in their total order once, in ranges of bounded rows; running sums of
    groups and of their lines number both."""
    if "size_first_ord" not in members.columns:
        order = dup_members(manifest, strategy, content, chunk_size=chunk_size, with_order=True).select(
            "stage", "group_key", "size_first_ord", "prefix_first_ord", "first_ord").distinct()
        members = members.join(order, ["stage", "group_key"])
    members = members.transform(reliable_checkpoint)
    spark = members.sparkSession

    # header: one row of totals joined to the seven header templates
    totals = (scan_totals(manifest).select("*", F.lit(1).alias("_one"))
              .join(members.agg(F.count(F.when(F.col("role") == "delete", 1)).alias("dfiles"),
                                F.coalesce(F.sum(F.when(F.col("role") == "delete", F.col("size"))), F.lit(0))
                                .cast("bigint").alias("dsize")).select("*", F.lit(1).alias("_one")), "_one"))
    tmpl = spark.createDataFrame([(i,) for i in range(7)], "line_no long")
    line = (F.when(F.col("line_no") == 0, F.lit(f"Duplicate File Report - {at}"))
            .when(F.col("line_no") == 1, F.lit(f"Scanned directory: {directory}"))
            .when(F.col("line_no") == 2, F.concat(F.lit("Total files scanned: "), F.col("total_files").cast("string")))
            .when(F.col("line_no") == 3, F.concat(F.lit("Total size of all files: "), format_size(F.col("total_size"))))
            .when(F.col("line_no") == 4, F.concat(F.lit("Duplicate files found: "), F.col("dfiles").cast("string")))
            .when(F.col("line_no") == 5, F.concat(F.lit("Duplicate files size: "), format_size(F.col("dsize"))))
            .otherwise(F.lit("")))
    hdr = tmpl.select("*", F.lit(1).alias("_one")).join(F.broadcast(totals), "_one").select(
        F.lit(0).cast("bigint").alias("group_no"), "line_no", line.alias("line"))

    # title, keeper, deletes in list order, blank line: kinds 0 to 3 of a group
    place = ["stage_no", "size_first_ord", "prefix_first_ord", "first_ord"]
    members = members.withColumn("stage_no", F.when(F.col("stage") == "filename", 0).otherwise(1))
    groups = members.groupBy("stage", "group_key", "size", *place).agg(F.count(F.lit(1)).alias("n_files"))
    zero = F.lit(0).cast("bigint")
    frame = groups.select(*place, "size", "n_files", F.explode(F.array(F.lit(0), F.lit(3))).alias("kind"),
                          zero.alias("at"), zero.alias("then"), F.lit(None).cast("string").alias("path"))
    kind = F.when(F.col("role") == "keep", 1).otherwise(2)
    listed = members.join(groups.select("stage", "group_key", "n_files"), ["stage", "group_key"]).select(
        *place, "size", "n_files", kind.alias("kind"),
        (zero if strategy == "first_found" else F.col("mtime_us")).alias("at"), F.col("ord").alias("then"), "path")
    title, n = F.col("kind") == 0, F.col("n_files")
    lines = frame.unionByName(listed).withColumns({
        "all": F.lit(0), "one": F.lit(1), "title": F.when(title, 1).otherwise(0), "lines": F.when(title, n + 2).otherwise(0)})
    order = [*place, "kind", "at", "then"]
    lines = running_sums(in_ranges(lines, ["all"], order), ["all"], order,
                         {"group_no": "title", "upto": "one", "begun": "lines"})
    line = (F.when(title, F.concat(F.lit("Group "), F.col("group_no").cast("string"), F.lit(": "), n.cast("string"),
                                   F.lit(" files of size "), format_size(F.col("size"))))
            .when(F.col("kind") == 1, F.concat(F.lit("  Keep: "), F.col("path")))
            .when(F.col("kind") == 2, F.concat(F.lit("  Delete: "), F.col("path"))).otherwise(""))
    # lines of this and earlier groups up to here, less those of the earlier groups
    line_no = F.col("upto") - (F.col("begun") - (n + 2)) - 1
    return hdr.unionByName(lines.select("group_no", line_no.cast("bigint").alias("line_no"), line.alias("line")))
