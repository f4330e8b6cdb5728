"""Queries of the duplicate-search family over the ``manifest`` view."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import Fixtures
from ..operators import dedup as D
from ..session import reliable_checkpoint
from .registry import query

# ---------------------------------------------------------------------------
# Oracle building blocks (DuckDB).  Windows and row_number are used here on
# purpose: an independent formulation of what the Spark side does with
# aggregates and joins.
# ---------------------------------------------------------------------------
_ORDER = {
    "newest": "mtime_us DESC, ord DESC",
    "oldest": "mtime_us ASC, ord ASC",
    "first_found": "ord ASC",
}


def members_sql(strategy: str = "newest", chunk: int = 8192, src: str = "manifest") -> str:
    o = _ORDER[strategy]
    return f"""
name_g AS (SELECT size, name, count(*) AS n FROM {src} GROUP BY size, name),
size_g AS (SELECT size, sum(n) AS size_n FROM name_g GROUP BY size),
fmem AS (
  SELECT 'filename' AS stage, 'f:' || CAST(m.size AS VARCHAR) || ':' || m.name AS group_key,
         m.size, m.path, m.ord, m.mtime_us,
         CASE WHEN row_number() OVER (PARTITION BY m.size, m.name ORDER BY {o}) = 1
              THEN 'keep' ELSE 'delete' END AS role
  FROM {src} m JOIN name_g g ON m.size = g.size AND m.name = g.name WHERE g.n > 1),
cand AS (
  SELECT m.* FROM {src} m JOIN name_g g ON m.size = g.size AND m.name = g.name
  JOIN size_g s ON m.size = s.size WHERE g.n = 1 AND s.size_n > 1),
pref AS (SELECT *, md5(encode(text)[1:{chunk}]) AS prefix_md5 FROM cand),
pgrp AS (SELECT size, prefix_md5, min(ord) AS prefix_first_ord FROM pref GROUP BY size, prefix_md5 HAVING count(*) > 1),
pc AS (SELECT p.*, g.prefix_first_ord FROM pref p JOIN pgrp g ON p.size = g.size AND p.prefix_md5 = g.prefix_md5),
hc AS (SELECT *, md5(text) AS md5 FROM pc),
cgrp AS (SELECT size, md5 FROM hc GROUP BY size, md5 HAVING count(*) > 1),
cmem AS (
  SELECT 'content' AS stage, 'c:' || CAST(h.size AS VARCHAR) || ':' || h.md5 AS group_key,
         h.size, h.path, h.ord, h.mtime_us,
         CASE WHEN row_number() OVER (PARTITION BY h.size, h.md5 ORDER BY {o}) = 1
              THEN 'keep' ELSE 'delete' END AS role
  FROM hc h JOIN cgrp c ON h.size = c.size AND h.md5 = c.md5),
members AS (SELECT * FROM fmem UNION ALL SELECT * FROM cmem)"""


def _with(strategy="newest", chunk=8192, extra="", src="manifest", pre=""):
    head = "WITH " + (pre.strip() + ",\n" if pre else "")
    return head + members_sql(strategy, chunk, src).strip() + (",\n" + extra.strip() if extra else "")


MEMBER_SELECT = "SELECT stage, group_key, size, path, ord, mtime_us, role FROM members"


# ---------------------------------------------------------------------------
# filters and totals
# ---------------------------------------------------------------------------
@query("scan_totals", """
SELECT CAST(count(*) AS BIGINT) AS total_files, CAST(coalesce(sum(size), 0) AS BIGINT) AS total_size
FROM manifest""", ("manifest",))
def q_scan_totals(spark, sf):
    return D.scan_totals(Fixtures(spark, sf)["manifest"])


@query("filter_extensions", """
SELECT ord, path, ext FROM manifest WHERE lower(ext) IN ('.md', '.pdf', '.txt') AND lower(ext) NOT IN ('.txt')""",
       ("manifest",))
def q_filter_extensions(spark, sf):
    m = Fixtures(spark, sf)["manifest"]
    return D.filter_extensions(m, include=["md", ".PDF", "txt"], exclude=["TXT"]).select("ord", "path", "ext")


@query("filter_depth", """
SELECT ord, path, depth FROM manifest WHERE depth = 0 OR depth <= 2""", ("manifest",))
def q_filter_depth(spark, sf):
    return D.filter_depth(Fixtures(spark, sf)["manifest"], max_depth=2).select("ord", "path", "depth")


@query("size_groups", """
SELECT ord, path, size FROM manifest WHERE size IN (SELECT size FROM manifest GROUP BY size HAVING count(*) > 1)""",
       ("manifest",))
def q_size_groups(spark, sf):
    return D.size_groups(Fixtures(spark, sf)["manifest"]).select("ord", "path", "size")


# ---------------------------------------------------------------------------
# cascade stages
# ---------------------------------------------------------------------------
@query("filename_dups", _with() + "\nSELECT stage, group_key, size, path, ord, mtime_us, role FROM fmem",
       ("manifest",))
def q_filename_dups(spark, sf):
    return D.filename_dups(Fixtures(spark, sf)["manifest"], "newest").select(*D.MEMBER_COLS)


@query("exclude_name_dups", _with() + "\nSELECT ord, path, size FROM cand", ("manifest",))
def q_exclude_name_dups(spark, sf):
    return D.exclude_name_dups(Fixtures(spark, sf)["manifest"]).select("ord", "path", "size")


@query("prefix_candidates", _with() + "\nSELECT ord, path, size, prefix_md5 FROM pc", ("manifest",))
def q_prefix_candidates(spark, sf):
    m = Fixtures(spark, sf)["manifest"]
    return D.prefix_candidates(D.exclude_name_dups(D.slim_manifest(m)), "text", 8192).select("ord", "path", "size", "prefix_md5")


@query("content_dups", _with() + "\nSELECT stage, group_key, size, path, ord, mtime_us, role FROM cmem",
       ("manifest",))
def q_content_dups(spark, sf):
    m = Fixtures(spark, sf)["manifest"]
    return D.content_dups(D.exclude_name_dups(D.slim_manifest(m)), "newest").select(*D.MEMBER_COLS)


@query("content_dups_noprefix", _with() + "\nSELECT stage, group_key, size, path, ord, mtime_us, role FROM cmem",
       ("manifest",))
def q_content_dups_noprefix(spark, sf):
    """Same groups with the prefix stage switched off (it is only a filter)."""
    m = Fixtures(spark, sf)["manifest"]
    return D.content_dups(D.exclude_name_dups(D.slim_manifest(m)), "newest", use_prefix=False).select(*D.MEMBER_COLS)


for _s in D.STRATEGIES:
    def _mk(strategy):
        def fn(spark, sf):
            return D.dup_members(Fixtures(spark, sf)["manifest"], strategy).select(*D.MEMBER_COLS)
        return fn
    query(f"keep_policy_{_s}", _with(_s) + "\n" + MEMBER_SELECT, ("manifest",))(_mk(_s))


@query("keep_policy_regroup", _with("oldest") + "\n" + MEMBER_SELECT, ("manifest",))
def q_keep_policy_regroup(spark, sf):
    """Keeper re-picked on existing groups: newest groups, re-kept oldest."""
    m = Fixtures(spark, sf)["manifest"]
    return D.keep_policy(D.dup_members(m, "newest"), "oldest").select(*D.MEMBER_COLS)


@query("all_dups", _with() + "\n" + MEMBER_SELECT, ("manifest",))
def q_all_dups(spark, sf):
    return D.all_dups(Fixtures(spark, sf)["manifest"]).select(*D.MEMBER_COLS)


@query("dedup_stats", _with() + """
SELECT CAST((SELECT count(*) FROM manifest) AS BIGINT) AS total_files,
       CAST((SELECT coalesce(sum(size), 0) FROM manifest) AS BIGINT) AS total_size,
       CAST((SELECT count(*) FROM members WHERE role = 'delete') AS BIGINT) AS duplicate_files,
       CAST((SELECT coalesce(sum(size), 0) FROM members WHERE role = 'delete') AS BIGINT) AS duplicate_size""",
       ("manifest",))
def q_dedup_stats(spark, sf):
    m = Fixtures(spark, sf)["manifest"]
    return D.dedup_stats(D.dup_members(m), m)


@query("kept_corpus", _with() + """
SELECT ord, path, size FROM manifest WHERE path NOT IN (SELECT path FROM members WHERE role = 'delete')""",
       ("manifest",))
def q_kept_corpus(spark, sf):
    m = Fixtures(spark, sf)["manifest"]
    return D.kept_corpus(m, D.dup_members(m)).select("ord", "path", "size")


# relpath of the keeper seen from the deleted file's folder, in SQL: common
# prefix of the two component lists, '..' per remaining folder component.
_RELPATH = """
rp AS (
  SELECT d.*, string_split(ltrim(keep_path, '/'), '/') AS t,
         CASE WHEN regexp_extract(ltrim(path, '/'), '^(.*)/[^/]*$', 1) = '' THEN []::VARCHAR[]
              ELSE string_split(regexp_extract(ltrim(path, '/'), '^(.*)/[^/]*$', 1), '/') END AS dd
  FROM dl d),
rp2 AS (
  SELECT *, coalesce(list_min(list_filter(range(1, least(len(t), len(dd)) + 1), lambda i: t[i] <> dd[i])) - 1,
                     least(len(t), len(dd))) AS common FROM rp),
rp3 AS (
  SELECT *, list_concat(list_transform(range(len(dd) - common), lambda x: '..'), t[common + 1:]) AS parts FROM rp2)"""


@query("action_plan", _with(extra="""
keepers AS (SELECT stage, group_key, path AS keep_path FROM members WHERE role = 'keep'),
dl AS (SELECT m.stage, m.group_key, m.path, k.keep_path FROM members m
       JOIN keepers k ON m.stage = k.stage AND m.group_key = k.group_key WHERE m.role = 'delete'),
""" + _RELPATH.strip()) + """
SELECT stage, group_key, path, keep_path, 'symlink' AS action,
       CASE WHEN len(parts) = 0 THEN '.' ELSE array_to_string(parts, '/') END AS link_target FROM rp3""",
       ("manifest",))
def q_action_plan(spark, sf):
    m = Fixtures(spark, sf)["manifest"]
    return D.action_plan(reliable_checkpoint(D.dup_members(m)), symlink=True)


def decisions_df(members):
    """Fixture decisions: choice by size % 4 (0 d, 1 k, 2 s, 3 none);
    replacement keeper = least path of the group for even sizes."""
    g = members.groupBy("group_key", "size").agg(F.min("path").alias("least_path"))
    return (g.filter(F.col("size") % 4 != 3)
            .select("group_key",
                    F.element_at(F.array(F.lit("d"), F.lit("k"), F.lit("s")), (F.col("size") % 4 + 1).cast("int"))
                    .alias("choice"),
                    F.when(F.col("size") % 2 == 0, F.col("least_path")).alias("keep_path")))


@query("apply_decisions", _with(extra="""
dec AS (SELECT group_key, CASE size % 4 WHEN 0 THEN 'd' WHEN 1 THEN 'k' ELSE 's' END AS choice,
               CASE WHEN size % 2 = 0 THEN min(path) END AS new_keep
        FROM members GROUP BY group_key, size HAVING size % 4 <> 3),
m2 AS (SELECT m.*, d.choice, d.new_keep,
              CASE WHEN d.new_keep IS NULL THEN m.role
                   WHEN m.path = d.new_keep THEN 'keep' ELSE 'delete' END AS role2
       FROM members m LEFT JOIN dec d ON m.group_key = d.group_key),
keepers AS (SELECT stage, group_key, path AS keep_path FROM m2 WHERE role2 = 'keep'),
m3 AS (SELECT m2.*, k.keep_path,
              CASE WHEN choice IS NULL THEN 'none' WHEN choice = 'k' THEN 'keep' WHEN role2 = 'keep' THEN 'keep'
                   WHEN choice = 'd' THEN 'delete' WHEN choice = 's' THEN 'symlink' ELSE 'none' END AS action
       FROM m2 LEFT JOIN keepers k ON m2.stage = k.stage AND m2.group_key = k.group_key),
dl AS (SELECT * FROM m3),
""" + _RELPATH.strip()) + """
SELECT stage, group_key, size, path, role2 AS role, action,
       CASE WHEN action = 'symlink' THEN (CASE WHEN len(parts) = 0 THEN '.' ELSE array_to_string(parts, '/') END) END
         AS link_target
FROM rp3""", ("manifest",))
def q_apply_decisions(spark, sf):
    m = Fixtures(spark, sf)["manifest"]
    members = reliable_checkpoint(D.dup_members(m))   # read four times below
    return D.apply_decisions(members, decisions_df(members))


def _fmt_size_sql(x: str) -> str:
    return (f"CASE WHEN {x} < 1024 THEN CAST({x} AS VARCHAR) || ' bytes' "
            f"WHEN {x} < 1048576 THEN format('{{:.2f}}', {x} / 1024.0) || ' KB' "
            f"WHEN {x} < 1073741824 THEN format('{{:.2f}}', {x} / 1048576.0) || ' MB' "
            f"ELSE format('{{:.2f}}', {x} / 1073741824.0) || ' GB' END")


REPORT_AT = "2024-01-01 00:00:00"


@query("dup_report", _with(extra=f"""
sf AS (SELECT size, min(ord) AS size_first_ord FROM manifest GROUP BY size),
pf AS (SELECT h.size, h.md5, min(h.prefix_first_ord) AS prefix_first_ord FROM hc h GROUP BY h.size, h.md5),
grp AS (
  SELECT m.stage, m.group_key, m.size, count(*) AS n_files, min(m.ord) AS first_ord,
         CASE WHEN m.stage = 'filename' THEN 0 ELSE 1 END AS stage_no
  FROM members m GROUP BY m.stage, m.group_key, m.size),
grp2 AS (
  SELECT g.*, s.size_first_ord,
         coalesce((SELECT p.prefix_first_ord FROM pf p WHERE 'c:' || CAST(p.size AS VARCHAR) || ':' || p.md5 = g.group_key
                   AND g.stage = 'content'), g.first_ord) AS prefix_first_ord
  FROM grp g JOIN sf s ON g.size = s.size),
num AS (SELECT *, row_number() OVER (ORDER BY stage_no, size_first_ord, prefix_first_ord, first_ord) AS group_no FROM grp2),
st AS (SELECT (SELECT count(*) FROM manifest) AS tf, (SELECT coalesce(sum(size), 0) FROM manifest) AS ts,
              (SELECT count(*) FROM members WHERE role = 'delete') AS df,
              (SELECT coalesce(sum(size), 0) FROM members WHERE role = 'delete') AS ds),
lines AS (
  SELECT 0 AS group_no, 0 AS line_no, 'Duplicate File Report - {REPORT_AT}' AS line
  UNION ALL SELECT 0, 1, 'Scanned directory: /corpus'
  UNION ALL SELECT 0, 2, 'Total files scanned: ' || CAST(tf AS VARCHAR) FROM st
  UNION ALL SELECT 0, 3, 'Total size of all files: ' || {_fmt_size_sql('ts')} FROM st
  UNION ALL SELECT 0, 4, 'Duplicate files found: ' || CAST(df AS VARCHAR) FROM st
  UNION ALL SELECT 0, 5, 'Duplicate files size: ' || {_fmt_size_sql('ds')} FROM st
  UNION ALL SELECT 0, 6, ''
  UNION ALL SELECT group_no, 0, 'Group ' || CAST(group_no AS VARCHAR) || ': ' || CAST(n_files AS VARCHAR)
                   || ' files of size ' || {_fmt_size_sql('size')} FROM num
  UNION ALL SELECT n.group_no, 1, '  Keep: ' || m.path FROM members m JOIN num n
            ON m.stage = n.stage AND m.group_key = n.group_key WHERE m.role = 'keep'
  UNION ALL SELECT n.group_no, 1 + row_number() OVER (PARTITION BY m.stage, m.group_key ORDER BY m.mtime_us, m.ord),
                   '  Delete: ' || m.path FROM members m JOIN num n
            ON m.stage = n.stage AND m.group_key = n.group_key WHERE m.role = 'delete'
  UNION ALL SELECT group_no, n_files + 1, '' FROM num)""") + """
SELECT CAST(group_no AS BIGINT) AS group_no, CAST(line_no AS BIGINT) AS line_no, line FROM lines""",
       ("manifest",))
def q_dup_report(spark, sf):
    m = reliable_checkpoint(D.slim_manifest(Fixtures(spark, sf)["manifest"]))
    return D.dup_report(D.dup_members(m, with_order=True), m, "/corpus", REPORT_AT)


@query("filename_dups_verified", """
WITH sized AS (SELECT * FROM manifest WHERE size IN (SELECT size FROM manifest GROUP BY size HAVING count(*) > 1)),
h AS (SELECT *, md5(text) AS md5 FROM sized),
g AS (SELECT size, name, md5 FROM h GROUP BY size, name, md5 HAVING count(*) > 1)
SELECT 'filename' AS stage, 'f:' || CAST(h.size AS VARCHAR) || ':' || h.name || ':' || h.md5 AS group_key,
       h.size, h.path, h.ord, h.mtime_us,
       CASE WHEN row_number() OVER (PARTITION BY h.size, h.name, h.md5 ORDER BY mtime_us DESC, ord DESC) = 1
            THEN 'keep' ELSE 'delete' END AS role
FROM h JOIN g ON h.size = g.size AND h.name = g.name AND h.md5 = g.md5""", ("manifest",))
def q_filename_dups_verified(spark, sf):
    """Quirk option: filename groups re-checked by content hash."""
    return D.filename_dups_verified(Fixtures(spark, sf)["manifest"]).select(*D.MEMBER_COLS)


@query("name_helpers", f"""
SELECT ord, {_fmt_size_sql('size')} AS size_text,
       regexp_extract(name, '^\\.*[^.].*(\\.[^.]*)$', 1) AS ext_raw,
       CASE WHEN length(path) > 24 THEN left(path, 10) || '...' || right(path, 10) ELSE path END AS short_path,
       md5(path || '_' || CAST(mtime_us AS VARCHAR) || '_' || CAST(size AS VARCHAR)) AS file_id
FROM manifest""", ("manifest",))
def q_name_helpers(spark, sf):
    """Column helpers: size text, extension, middle-ellipsis path, file id."""
    from ..functions import names as N
    m = Fixtures(spark, sf)["manifest"]
    return m.select("ord", N.format_size(F.col("size")).alias("size_text"),
                    N.split_ext(F.col("name")).alias("ext_raw"),
                    N.shorten_path(F.col("path"), 24).alias("short_path"),
                    N.file_id(F.col("path"), F.col("mtime_us"), F.col("size")).alias("file_id"))
