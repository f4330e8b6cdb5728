"""End-to-end pipelines registered as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import Fixtures
from . import pipelines as PL
from .q_dedup import MEMBER_SELECT, _with
from .q_intake import SUPPORTED_SQL, _NEW, _PAGES, _SCORE, ext_sql, stem_sql
from .q_text import flatten_ctes, rules_sql, strip_sql
from .registry import query

_FMAN = ("fman AS (SELECT * FROM manifest WHERE lower(ext) IN ('.md', '.txt') "
         "AND (depth = 0 OR depth <= 2))")


def _dedup(spark, sf):
    m = Fixtures(spark, sf)["manifest"]
    return PL.dedup_corpus(m, include=("md", "txt"), max_depth=2)


@query("dedup_corpus", _with(src="fman", pre=_FMAN) + "\n" + MEMBER_SELECT, ("manifest",))
def q_dedup_corpus(spark, sf):
    from ..operators.dedup import MEMBER_COLS
    return _dedup(spark, sf).members.select(*MEMBER_COLS)


@query("dedup_corpus_stats", _with(src="fman", pre=_FMAN) + """
SELECT CAST((SELECT count(*) FROM fman) AS BIGINT) AS total_files,
       CAST((SELECT coalesce(sum(size), 0) FROM fman) AS BIGINT) AS total_size,
       CAST((SELECT count(*) FROM members WHERE role = 'delete') AS BIGINT) AS duplicate_files,
       CAST((SELECT coalesce(sum(size), 0) FROM members WHERE role = 'delete') AS BIGINT) AS duplicate_size""",
       ("manifest",))
def q_dedup_corpus_stats(spark, sf):
    return _dedup(spark, sf).stats


@query("dedup_corpus_plan", _with(src="fman", pre=_FMAN, extra="""
keepers AS (SELECT stage, group_key, path AS keep_path FROM members WHERE role = 'keep')""") + """
SELECT m.stage, m.group_key, m.path, k.keep_path, 'delete' AS action, CAST(NULL AS VARCHAR) AS link_target
FROM members m JOIN keepers k ON m.stage = k.stage AND m.group_key = k.group_key WHERE m.role = 'delete'""",
       ("manifest",))
def q_dedup_corpus_plan(spark, sf):
    return _dedup(spark, sf).plan


_CLEAN_TODO = ("todo AS (SELECT doc_id, 'd' || CAST(doc_id AS VARCHAR) || '.md' AS name, text FROM md_docs "
               "WHERE 'd' || CAST(doc_id AS VARCHAR) || '.txt' NOT IN (SELECT name FROM outputs))")
_CLEAN_PIPE = (f"WITH {_CLEAN_TODO},\nsrc AS (SELECT name AS doc_id, {rules_sql('text')} AS t FROM todo),"
               + flatten_ctes("src") + f""",
cleaned AS (SELECT doc_id AS name, {strip_sql("regexp_replace(text, '\\n{3,}', chr(10) || chr(10), 'g')")} AS text
            FROM fl_out)""")


def _clean(spark, sf):
    fx = Fixtures(spark, sf)
    md = fx["md_docs"].select(F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".md")).alias("name"), "text")
    return PL.clean_corpus(md, fx["outputs"].select("name"))


@query("clean_corpus", _CLEAN_PIPE + "\nSELECT name, text FROM cleaned", ("md_docs", "outputs"))
def q_clean_corpus(spark, sf):
    return _clean(spark, sf)[0]


@query("clean_corpus_summary", _CLEAN_PIPE + """
SELECT CAST(count(*) AS BIGINT) AS successful_files, CAST(0 AS BIGINT) AS failed_files,
       CAST(coalesce(sum(length(text)), 0) AS BIGINT) AS total_chars FROM cleaned""", ("md_docs", "outputs"))
def q_clean_corpus_summary(spark, sf):
    return _clean(spark, sf)[1]


_CONS = f"""
WITH ids AS (SELECT ord, name, md5(path || '_' || CAST(mtime_us AS VARCHAR) || '_' || CAST(size AS VARCHAR)) AS file_id,
                    ord IN (SELECT ord FROM processed_docs) AS done FROM manifest),
f AS (SELECT ord, name, file_id, row_number() OVER (PARTITION BY name ORDER BY ord) - 1 AS j,
             count(*) OVER (PARTITION BY name) AS n FROM ids WHERE NOT done),
nm AS (SELECT DISTINCT name, n FROM f),
slots AS (SELECT name, unnest(range(0, n + (SELECT count(*) FROM existing_names) + 1)) AS slot FROM nm),
named AS (SELECT name, slot, CASE WHEN slot = 0 THEN name
                 ELSE {stem_sql('name')} || '_' || CAST(slot AS VARCHAR) || {ext_sql('name')} END AS target FROM slots),
free AS (SELECT name, target, row_number() OVER (PARTITION BY name ORDER BY slot) - 1 AS j
         FROM named WHERE target NOT IN (SELECT name FROM existing_names)),
results AS (
  SELECT f.ord, f.file_id, f.name, free.target AS target_name, 'processed' AS status
  FROM f JOIN free ON f.name = free.name AND f.j = free.j
  UNION ALL SELECT ord, file_id, name, CAST(NULL AS VARCHAR), 'skipped' FROM ids WHERE done)"""


def _consolidate(spark, sf):
    fx = Fixtures(spark, sf)
    m = fx["manifest"]
    from ..functions.names import file_id
    processed = (m.join(fx["processed_docs"], "ord", "left_semi")
                 .select(file_id(F.col("path"), F.col("mtime_us"), F.col("size")).alias("file_id")))
    return PL.consolidate_corpus(m.select("ord", "path", "name", "mtime_us", "size"), processed,
                                 fx["existing_names"], elapsed=10.0)


@query("consolidate_corpus", _CONS + "\nSELECT ord, file_id, name, target_name, status FROM results",
       ("manifest", "processed_docs", "existing_names"))
def q_consolidate_corpus(spark, sf):
    return _consolidate(spark, sf)[0].select("ord", "file_id", "name", "target_name", "status")


@query("consolidate_corpus_state", _CONS + """
SELECT file_id FROM ids WHERE done UNION SELECT file_id FROM results WHERE status = 'processed'""",
       ("manifest", "processed_docs", "existing_names"))
def q_consolidate_corpus_state(spark, sf):
    return _consolidate(spark, sf)[2]


@query("intake_batch", f"""
WITH n AS ({_NEW})
SELECT CAST(row_number() OVER (ORDER BY {_SCORE}, ord) AS BIGINT) AS position, name, false AS from_quarantine,
       {_PAGES} AS pages, {_SCORE} AS score,
       CASE WHEN starts_with(lower(name), '~$') THEN 'skipped' ELSE 'pending' END AS status
FROM n""", ("inbox", "outputs"))
def q_intake_batch(spark, sf):
    fx = Fixtures(spark, sf)
    quarantine = fx["outputs"].filter(~F.lower("name").endswith(".txt"))
    return PL.intake_batch(fx["inbox"], fx["outputs"], quarantine)


CARD_TITLE, CARD_DATE = "docforge/corpus", "2024-01-01"


@query("publish_corpus", f"""
WITH s AS (SELECT CAST(count(*) AS BIGINT) AS documents, CAST(coalesce(sum(file_size), 0) AS BIGINT) AS total_bytes
           FROM corpus),
t AS (SELECT *, format('{{:.2f}}', total_bytes / 1048576.0) AS total_mb FROM s)
SELECT documents, total_bytes, total_mb,
       '# Dataset: {CARD_TITLE}' || chr(10) || chr(10) || 'A corpus of ' || CAST(documents AS VARCHAR)
       || ' plain-text documents converted from Markdown.' || chr(10) || chr(10) || '## Summary' || chr(10) || chr(10)
       || '- Documents: ' || CAST(documents AS VARCHAR) || chr(10) || '- Total size: ' || total_mb || ' MB'
       || chr(10) || '- Created: {CARD_DATE}' || chr(10) || chr(10) || '## Features' || chr(10) || chr(10)
       || 'text, file_name, file_size' || chr(10) AS card
FROM t""", ("corpus",))
def q_publish_corpus(spark, sf):
    from ..sources.files import corpus_from_table
    corpus = corpus_from_table(Fixtures(spark, sf)["documents"])
    return PL.publish_corpus(corpus, CARD_TITLE, created=CARD_DATE)[1]


@query("dataset_card", f"""
SELECT CAST(count(*) AS BIGINT) AS documents, CAST(coalesce(sum(file_size), 0) AS BIGINT) AS total_bytes,
       format('{{:.2f}}', coalesce(sum(file_size), 0) / 1048576.0) AS total_mb
FROM corpus""", ("corpus",))
def q_dataset_card(spark, sf):
    from ..operators.publish import dataset_card
    from ..sources.files import corpus_from_table
    return dataset_card(corpus_from_table(Fixtures(spark, sf)["documents"]), CARD_TITLE, created=CARD_DATE)\
        .select("documents", "total_bytes", "total_mb")
