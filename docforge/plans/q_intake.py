"""Queries of the intake family: supported files, done/new split, selection,
skip and checkpoint joins, complexity order, summaries, routes, quarantine
repair and error logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import Fixtures
from ..operators import intake as I
from .q_text import strip_sql
from .registry import query


def ext_sql(x: str) -> str:
    return f"regexp_extract({x}, '^\\.*[^.].*(\\.[^.]*)$', 1)"


def stem_sql(x: str) -> str:
    return f"left({x}, CAST(length({x}) - length({ext_sql(x)}) AS BIGINT))"


SUPPORTED_SQL = "(ends_with(lower(name), '.doc') OR ends_with(lower(name), '.docx') OR ends_with(lower(name), '.pdf'))"


def _inbox(fx):
    return fx["inbox"]


@query("filter_supported", f"SELECT ord, name FROM inbox WHERE {SUPPORTED_SQL}", ("inbox",))
def q_filter_supported(spark, sf):
    return I.filter_supported(_inbox(Fixtures(spark, sf))).select("ord", "name")


@query("filter_temp_files", f"""
SELECT ord, name, CASE WHEN starts_with(lower(name), '~$') THEN 'skipped' ELSE 'pending' END AS status
FROM inbox WHERE {SUPPORTED_SQL}""", ("inbox",))
def q_filter_temp_files(spark, sf):
    return I.filter_temp_files(I.filter_supported(_inbox(Fixtures(spark, sf)))).select("ord", "name", "status")


@query("intake_new", f"""
SELECT ord, name FROM inbox WHERE {SUPPORTED_SQL} AND {stem_sql('name')} NOT IN (SELECT stem FROM outputs)""",
       ("inbox", "outputs"))
def q_intake_new(spark, sf):
    fx = Fixtures(spark, sf)
    return I.intake_new(fx["inbox"], fx["outputs"]).select("ord", "name")


@query("intake_done", f"""
SELECT ord, name FROM inbox WHERE {SUPPORTED_SQL} AND {stem_sql('name')} IN (SELECT stem FROM outputs)""",
       ("inbox", "outputs"))
def q_intake_done(spark, sf):
    fx = Fixtures(spark, sf)
    return I.intake_done(fx["inbox"], fx["outputs"]).select("ord", "name")


@query("intake_select", f"""
WITH new AS (SELECT name, 0 AS prio FROM inbox WHERE {SUPPORTED_SQL} AND {stem_sql('name')} NOT IN (SELECT stem FROM outputs)),
q AS (SELECT name, 1 AS prio FROM outputs WHERE {SUPPORTED_SQL} AND lower(name) <> 'error_log.txt'),
b AS (SELECT * FROM new UNION ALL SELECT * FROM q)
SELECT name, prio = 1 AS from_quarantine FROM b WHERE prio = (SELECT min(prio) FROM b)""", ("inbox", "outputs"))
def q_intake_select(spark, sf):
    fx = Fixtures(spark, sf)
    return I.intake_select(I.intake_new(fx["inbox"], fx["outputs"]), fx["outputs"]).select("name", "from_quarantine")


@query("intake_select_quarantine", """
WITH q AS (SELECT name FROM outputs WHERE (ends_with(lower(name), '.doc') OR ends_with(lower(name), '.docx')
           OR ends_with(lower(name), '.pdf')) AND lower(name) <> 'error_log.txt')
SELECT name, true AS from_quarantine FROM q""", ("outputs",))
def q_intake_select_quarantine(spark, sf):
    """The fallback branch: every inbox file is already done (the inbox is
    replaced by its done part), so the quarantine listing is chosen."""
    fx = Fixtures(spark, sf)
    done = I.intake_done(fx["inbox"], fx["outputs"])
    return I.intake_select(I.intake_new(done, fx["outputs"]), fx["outputs"]).select("name", "from_quarantine")


@query("skip_existing_text", f"""
WITH md AS (SELECT doc_id, 'd' || CAST(doc_id AS VARCHAR) || '.md' AS name FROM documents)
SELECT doc_id, name FROM md WHERE {stem_sql('name')} || '.txt' NOT IN (SELECT name FROM outputs)""",
       ("outputs",))
def q_skip_existing_text(spark, sf):
    from ..operators.clean import skip_existing_text
    fx = Fixtures(spark, sf)
    md = fx["documents"].select("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".md")).alias("name"))
    return skip_existing_text(md, fx["outputs"].select("name"))


@query("checkpoint_antijoin", "SELECT ord, path FROM manifest WHERE ord NOT IN (SELECT ord FROM processed_docs)",
       ("manifest", "processed_docs"))
def q_checkpoint_antijoin(spark, sf):
    fx = Fixtures(spark, sf)
    return I.checkpoint_antijoin(fx["manifest"], fx["processed_docs"], key="ord").select("ord", "path")


@query("merge_processed", """
SELECT ord FROM processed_docs UNION SELECT ord FROM manifest WHERE ord NOT IN (SELECT ord FROM processed_docs)""",
       ("manifest", "processed_docs"))
def q_merge_processed(spark, sf):
    fx = Fixtures(spark, sf)
    new = I.checkpoint_antijoin(fx["manifest"], fx["processed_docs"], key="ord")
    return I.merge_processed(fx["processed_docs"], new, key="ord")


@query("consolidate_stats", """
SELECT CAST(count(*) FILTER (WHERE ord NOT IN (SELECT ord FROM processed_docs)) AS BIGINT) AS processed,
       CAST(count(*) FILTER (WHERE ord IN (SELECT ord FROM processed_docs)) AS BIGINT) AS skipped,
       CAST(0 AS BIGINT) AS failed,
       CAST(count(*) FILTER (WHERE ord NOT IN (SELECT ord FROM processed_docs)) AS DOUBLE) / 10.0 AS files_per_second
FROM manifest""", ("manifest", "processed_docs"))
def q_consolidate_stats(spark, sf):
    fx = Fixtures(spark, sf)
    done = fx["processed_docs"].select("ord", F.lit(True).alias("_done"))
    res = fx["manifest"].join(done, "ord", "left").select(
        F.when(F.col("_done").isNotNull(), "skipped").otherwise("processed").alias("status"))
    return I.consolidate_stats(res, elapsed=10.0)


_SCORE = """CASE WHEN size IS NULL THEN 'Infinity'::DOUBLE
       ELSE CAST(size * (CASE WHEN ends_with(lower(name), '.pdf') AND page_count IS NOT NULL THEN page_count ELSE 1 END)
                 AS DOUBLE) END"""
_PAGES = """CAST(CASE WHEN size IS NULL THEN 0 WHEN ends_with(lower(name), '.pdf') AND page_count IS NOT NULL
       THEN page_count ELSE 1 END AS BIGINT)"""
_NEW = f"SELECT * FROM inbox WHERE {SUPPORTED_SQL} AND {stem_sql('name')} NOT IN (SELECT stem FROM outputs)"


@query("complexity_order", f"""
WITH n AS ({_NEW})
SELECT CAST(row_number() OVER (ORDER BY {_SCORE}, ord) AS BIGINT) AS position, ord, name, {_PAGES} AS pages,
       {_SCORE} AS score FROM n""", ("inbox", "outputs"))
def q_complexity_order(spark, sf):
    fx = Fixtures(spark, sf)
    return I.complexity_order(I.intake_new(fx["inbox"], fx["outputs"])).select("position", "ord", "name", "pages", "score")


@query("complexity_top5", f"""
WITH n AS ({_NEW}),
r AS (SELECT row_number() OVER (ORDER BY {_SCORE}, ord) AS position, name, size, {_PAGES} AS pages FROM n)
SELECT CAST(position AS BIGINT) AS position, name, format('{{:.2f}}', coalesce(size, 0) / 1048576.0) AS size_mb, pages,
       CAST(greatest((SELECT count(*) FROM n) - 5, 0) AS BIGINT) AS rest
FROM r WHERE position <= 5""", ("inbox", "outputs"))
def q_complexity_top5(spark, sf):
    fx = Fixtures(spark, sf)
    return I.complexity_top5(I.intake_new(fx["inbox"], fx["outputs"]))


@query("type_counts", "SELECT lower(ext) AS ext, CAST(count(*) AS BIGINT) AS files FROM outcomes GROUP BY lower(ext)",
       ("outcomes",))
def q_type_counts(spark, sf):
    return I.type_counts(Fixtures(spark, sf)["outcomes"])


@query("batch_summary", """
SELECT CAST(count(*) AS BIGINT) AS total_files,
       CAST(count(*) FILTER (WHERE status = 'ok') AS BIGINT) AS success_files,
       CASE WHEN count(*) > 0 THEN CAST(count(*) FILTER (WHERE status = 'ok') AS DOUBLE) * 100.0 / CAST(count(*) AS DOUBLE)
            ELSE 0.0 END AS success_pct,
       CAST(count(*) FILTER (WHERE status = 'failed') AS BIGINT) AS failed_files,
       CASE WHEN count(*) > 0 THEN CAST(count(*) FILTER (WHERE status = 'failed') AS DOUBLE) * 100.0 / CAST(count(*) AS DOUBLE)
            ELSE 0.0 END AS failed_pct
FROM outcomes""", ("outcomes",))
def q_batch_summary(spark, sf):
    return I.batch_summary(Fixtures(spark, sf)["outcomes"])


@query("validate_output_format", """
SELECT name, CASE WHEN ends_with(lower(name), '.txt') THEN 'keep' ELSE 'move' END AS route FROM outputs""",
       ("outputs",))
def q_validate_output_format(spark, sf):
    return I.validate_output_format(Fixtures(spark, sf)["outputs"]).select("name", "route")


@query("output_format_summary", """
SELECT CASE WHEN ends_with(lower(name), '.txt') THEN 'keep' ELSE 'delete' END AS route, CAST(count(*) AS BIGINT) AS files
FROM outputs GROUP BY 1""", ("outputs",))
def q_output_format_summary(spark, sf):
    return I.output_format_summary(I.validate_output_format(Fixtures(spark, sf)["outputs"], action="delete"))


ROUTE_EPOCH = 1700000000


@query("route_manifest", f"""
WITH o AS (SELECT ord, name || '.' || ext AS file_name, status FROM outcomes),
t AS (SELECT o.file_name AS name FROM o JOIN outcomes x ON o.ord = x.ord WHERE x.name IN (SELECT name FROM taken_names))
SELECT ord, file_name, status,
       CASE WHEN status = 'ok' THEN 'processed/' ELSE 'error/' END AS folder,
       CASE WHEN file_name IN (SELECT name FROM t)
            THEN {stem_sql('file_name')} || '_{ROUTE_EPOCH}' || {ext_sql('file_name')} ELSE file_name END AS dest_name,
       CASE WHEN status = 'ok' THEN 'move' ELSE 'copy' END AS action
FROM o WHERE status <> 'skipped'""", ("outcomes", "taken_names"))
def q_route_manifest(spark, sf):
    fx = Fixtures(spark, sf)
    o = fx["outcomes"].select("ord", F.concat_ws(".", "name", "ext").alias("file_name"), "status", "name")
    taken = o.join(fx["taken_names"], "name", "left_semi").select(F.col("file_name").alias("name"))
    return I.route_manifest(o.drop("name"), taken, ROUTE_EPOCH)


@query("repair_quarantine", f"""
WITH q AS (SELECT name FROM outputs WHERE NOT ends_with(lower(name), '.txt')
           AND (ends_with(lower(name), '.doc') OR ends_with(lower(name), '.docx'))),
j AS (SELECT q.name, {strip_sql('e.text')} AS t FROM q LEFT JOIN extractions e ON q.name = e.name)
SELECT name, CASE WHEN coalesce(t, '') <> '' THEN 'fixed' ELSE 'remains' END AS status,
       CASE WHEN coalesce(t, '') <> '' THEN
         (CASE WHEN ends_with(lower(name), '.doc') THEN replace(name, '.doc', '.txt') ELSE replace(name, '.docx', '.txt') END)
       END AS txt_name
FROM j""", ("outputs", "extractions"))
def q_repair_quarantine(spark, sf):
    fx = Fixtures(spark, sf)
    quarantine = fx["outputs"].filter(~F.lower("name").endswith(".txt"))
    return I.repair_quarantine(quarantine, fx["extractions"])


@query("filter_log_noise", "SELECT log_id, line_no, line FROM log_lines WHERE NOT contains(line, 'AFC')",
       ("log_lines",))
def q_filter_log_noise(spark, sf):
    return I.filter_log_noise(Fixtures(spark, sf)["log_lines"])


PARSED_SQL = f"""
h AS (SELECT *, regexp_matches(line, '^## (\\d\\d:\\d\\d:\\d\\d) - (.*)$') AS is_hdr FROM log_lines),
o AS (SELECT *, max(CASE WHEN is_hdr THEN line_no END) OVER (PARTITION BY log_id ORDER BY line_no
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS owner FROM h),
heads AS (SELECT log_id, line_no AS owner, regexp_extract(line, '^## (\\d\\d:\\d\\d:\\d\\d) - (.*)$', 1) AS time,
          regexp_extract(line, '^## (\\d\\d:\\d\\d:\\d\\d) - (.*)$', 2) AS file FROM h WHERE is_hdr),
body AS (SELECT log_id, owner, string_agg(line, chr(10) ORDER BY line_no) AS msg FROM o
         WHERE NOT is_hdr AND owner IS NOT NULL GROUP BY log_id, owner),
parsed AS (SELECT h.log_id, CAST(h.owner AS BIGINT) AS line_no, h.time, h.file, {strip_sql("coalesce(b.msg, '')")} AS message
           FROM heads h LEFT JOIN body b ON h.log_id = b.log_id AND h.owner = b.owner)"""


@query("parse_error_log", "WITH " + PARSED_SQL.strip() + "\nSELECT log_id, line_no, time, file, message FROM parsed",
       ("log_lines",))
def q_parse_error_log(spark, sf):
    return I.parse_error_log(Fixtures(spark, sf)["log_lines"])


@query("error_details", "WITH " + PARSED_SQL.strip() + """,
last AS (SELECT file, arg_max(message, (log_id, line_no)) AS msg FROM parsed GROUP BY file)
SELECT o.name, coalesce(l.msg, 'no information') AS message
FROM outcomes o LEFT JOIN last l ON o.name = l.file WHERE o.status = 'failed'""", ("log_lines", "outcomes"))
def q_error_details(spark, sf):
    fx = Fixtures(spark, sf)
    return I.error_details(fx["outcomes"], I.parse_error_log(fx["log_lines"]))


CLASSIFY_SQL = """
cl AS (SELECT *, lower(message) AS m FROM parsed),
cl2 AS (SELECT *, trim(split_part(split_part(substr(m, strpos(m, '''code'': ') + 8), '''code'': ', 1), ',', 1)) AS digits
        FROM cl),
classified AS (
  SELECT log_id, line_no, file,
         CASE WHEN contains(m, '429') OR contains(m, 'resource exhausted') OR contains(m, 'rate limit')
                   OR contains(m, 'too many requests') THEN 'rate_limit'
              WHEN contains(m, 'quota exceeded') OR contains(m, 'usage limit') THEN 'quota' ELSE 'other' END AS error_class,
         CASE WHEN contains(m, '429') THEN CAST(429 AS BIGINT)
              WHEN contains(m, '''code'': ') AND regexp_full_match(digits, '[0-9]+') THEN CAST(digits AS BIGINT) END
           AS error_code
  FROM cl2)"""


@query("classify_api_errors", "WITH " + PARSED_SQL.strip() + "," + CLASSIFY_SQL +
       "\nSELECT log_id, line_no, file, error_class, error_code FROM classified", ("log_lines",))
def q_classify_api_errors(spark, sf):
    p = I.parse_error_log(Fixtures(spark, sf)["log_lines"])
    return I.classify_api_errors(p).select("log_id", "line_no", "file", "error_class", "error_code")


@query("api_error_counts", "WITH " + PARSED_SQL.strip() + "," + CLASSIFY_SQL +
       "\nSELECT error_class, CAST(count(*) AS BIGINT) AS errors FROM classified GROUP BY error_class",
       ("log_lines",))
def q_api_error_counts(spark, sf):
    p = I.classify_api_errors(I.parse_error_log(Fixtures(spark, sf)["log_lines"]))
    return p.groupBy("error_class").agg(F.count(F.lit(1)).alias("errors"))


_FINISH = "WITH " + PARSED_SQL.strip() + f""",
last AS (SELECT file, arg_max(message, (log_id, line_no)) AS msg FROM parsed GROUP BY file),
out_ AS (SELECT ord, name, name || '.' || ext AS file_name, ext, status FROM outcomes),
t AS (SELECT name || '.' || ext AS name FROM outcomes WHERE name IN (SELECT name FROM taken_names)),
files AS (
  SELECT out_.*, CASE status WHEN 'ok' THEN 'processed/' WHEN 'failed' THEN 'error/' END AS folder,
         CASE WHEN status = 'skipped' THEN NULL WHEN file_name IN (SELECT name FROM t)
              THEN {stem_sql('file_name')} || '_{ROUTE_EPOCH}' || {ext_sql('file_name')} ELSE file_name END AS dest_name,
         CASE status WHEN 'ok' THEN 'move' WHEN 'failed' THEN 'copy' END AS action,
         CASE WHEN status = 'failed' THEN coalesce(l.msg, 'no information') END AS message
  FROM out_ LEFT JOIN last l ON out_.name = l.file)"""


def _finish(spark, sf):
    from .pipelines import finish_batch
    fx = Fixtures(spark, sf)
    o = fx["outcomes"].select("ord", "name", F.concat_ws(".", "name", "ext").alias("file_name"), "ext", "status")
    taken = o.join(fx["taken_names"], "name", "left_semi").select(F.col("file_name").alias("name"))
    return finish_batch(o, fx["log_lines"], taken, ROUTE_EPOCH)


@query("finish_batch", _FINISH + """
SELECT ord, name, file_name, ext, status, folder, dest_name, action, message FROM files""",
       ("outcomes", "taken_names", "log_lines"))
def q_finish_batch(spark, sf):
    """The end of a batch: routes and error details of every outcome."""
    return _finish(spark, sf).files.select("ord", "name", "file_name", "ext", "status", "folder", "dest_name", "action", "message")


@query("finish_batch_report", _FINISH + """
SELECT 'type ' || lower(ext) AS item, CAST(count(*) AS BIGINT) AS files FROM files GROUP BY lower(ext)
UNION ALL SELECT 'success', CAST(count(*) FILTER (WHERE status = 'ok') AS BIGINT) FROM files
UNION ALL SELECT 'failed', CAST(count(*) FILTER (WHERE status = 'failed') AS BIGINT) FROM files""",
       ("outcomes", "taken_names", "log_lines"))
def q_finish_batch_report(spark, sf):
    """Counts by type and outcome, read from the same frozen table."""
    end = _finish(spark, sf)
    totals = end.summary.select(F.explode(F.create_map(F.lit("success"), F.col("success_files"), F.lit("failed"), F.col("failed_files")))
                                .alias("item", "files"))
    return end.types.select(F.concat(F.lit("type "), F.col("ext")).alias("item"), "files").unionByName(totals)
