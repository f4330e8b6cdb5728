"""Queries of the page family: page state, budgets, document assembly,
Word paragraphs and archive members."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import Fixtures
from ..operators import pages as P
from .q_text import strip_sql
from .registry import query

BUDGET = 10000

_COST = ("CAST(floor(coalesce(length(text) / 4.0, 0)) AS BIGINT) + "
         "CAST(floor(coalesce(least(width * height / 750.0, 4000), 0)) AS BIGINT)")


@query("budget_pages", f"""
WITH RECURSIVE c AS (SELECT doc_id, page_no, {_COST} AS cost,
                            row_number() OVER (PARTITION BY doc_id ORDER BY page_no) AS k FROM doc_pages),
r AS (
  SELECT doc_id, k, page_no, cost, cost <= {BUDGET} AS taken,
         CASE WHEN cost <= {BUDGET} THEN cost ELSE 0 END AS used FROM c WHERE k = 1
  UNION ALL
  SELECT c.doc_id, c.k, c.page_no, c.cost, r.used + c.cost <= {BUDGET},
         CASE WHEN r.used + c.cost <= {BUDGET} THEN r.used + c.cost ELSE r.used END
  FROM r JOIN c ON c.doc_id = r.doc_id AND c.k = r.k + 1)
SELECT doc_id, page_no, cost, taken FROM r""", ("doc_pages",))
def q_budget_pages(spark, sf):
    return P.budget_pages(P.page_cost(Fixtures(spark, sf)["doc_pages"]), BUDGET)


@query("retry_outcome", """
WITH g AS (SELECT doc_id, page_no, count(*) AS attempts, min(attempt) FILTER (WHERE ok) AS ok_attempt,
                  count(*) FILTER (WHERE NOT ok) AS fails FROM attempts GROUP BY doc_id, page_no)
SELECT p.doc_id, p.page_no, CAST(coalesce(g.attempts, 0) AS BIGINT) AS attempts, CAST(g.ok_attempt AS BIGINT) AS ok_attempt,
       CASE WHEN g.ok_attempt IS NOT NULL THEN 'ok' WHEN coalesce(g.fails, 0) >= 3 THEN 'failed' ELSE 'pending' END AS status
FROM doc_pages p LEFT JOIN g ON p.doc_id = g.doc_id AND p.page_no = g.page_no""", ("doc_pages", "attempts"))
def q_retry_outcome(spark, sf):
    fx = Fixtures(spark, sf)
    return P.retry_outcome(fx["attempts"], fx["doc_pages"], max_retries=2)


@query("pending_pages", """
WITH f AS (SELECT doc_id, page_no, count(*) AS attempts FROM attempts WHERE NOT ok GROUP BY doc_id, page_no)
SELECT p.doc_id, p.page_no, CAST(coalesce(f.attempts, 0) AS BIGINT) AS attempts
FROM doc_pages p LEFT JOIN f ON p.doc_id = f.doc_id AND p.page_no = f.page_no
WHERE NOT EXISTS (SELECT 1 FROM attempts a WHERE a.ok AND a.doc_id = p.doc_id AND a.page_no = p.page_no)
  AND coalesce(f.attempts, 0) <= 2""", ("doc_pages", "attempts"))
def q_pending_pages(spark, sf):
    fx = Fixtures(spark, sf)
    return P.pending_pages(fx["doc_pages"], fx["attempts"], max_retries=2)


@query("page_summary", """
SELECT doc_id, CAST(count(*) AS BIGINT) AS pages_total,
       CAST(count(*) FILTER (WHERE status = 'ok') AS BIGINT) AS pages_ok,
       CAST(count(*) FILTER (WHERE status <> 'ok') AS BIGINT) AS pages_failed,
       CAST(count(*) FILTER (WHERE status = 'ok') AS DOUBLE) * 100.0 / CAST(count(*) AS DOUBLE) AS success_pct,
       bool_or(status = 'ok' AND coalesce(length(text), 0) > 0) AS doc_ok
FROM doc_pages GROUP BY doc_id""", ("doc_pages",))
def q_page_summary(spark, sf):
    return P.page_summary(Fixtures(spark, sf)["doc_pages"])


@query("assemble_pages", """
SELECT doc_id, string_agg(text, chr(10) || chr(10) ORDER BY page_no) AS text
FROM doc_pages WHERE status = 'ok' AND coalesce(length(text), 0) > 0 GROUP BY doc_id""", ("doc_pages",))
def q_assemble_pages(spark, sf):
    return P.assemble_pages(Fixtures(spark, sf)["doc_pages"])


def _paragraph_sql(styled: bool) -> str:
    base = "text"
    if styled:
        base = (f"(CASE WHEN starts_with(style, 'Heading') AND regexp_full_match(right(style, 1), '[0-9]') "
                f"THEN repeat('#', CAST(right(style, 1) AS INTEGER)) || ' ' || {strip_sql('text')} ELSE text END)")
    return f"""
WITH p AS (SELECT *, {strip_sql("coalesce(text, '')")} = '' AS empty FROM paragraphs),
q AS (SELECT *, coalesce(lag(empty) OVER (PARTITION BY doc_id ORDER BY para_no), true) AS prev_empty FROM p),
r AS (SELECT *, CASE WHEN starts_with(style, 'List') THEN '- ' ELSE '' END ||
             CASE alignment WHEN 'center' THEN {base} || '  ' WHEN 'right' THEN '    ' || {base} ELSE {base} END AS md
      FROM q),
s AS (SELECT doc_id, para_no,
             CASE WHEN NOT empty AND (starts_with(md, '#') OR NOT prev_empty) THEN chr(10) || md
                  WHEN NOT empty THEN md WHEN NOT prev_empty THEN '' END AS piece FROM r)
SELECT doc_id, {strip_sql("coalesce(string_agg(piece, chr(10) ORDER BY para_no), '')")} || chr(10) AS text
FROM s GROUP BY doc_id"""


@query("assemble_paragraphs", _paragraph_sql(False), ("paragraphs",))
def q_assemble_paragraphs(spark, sf):
    return P.assemble_paragraphs(Fixtures(spark, sf)["paragraphs"])


@query("assemble_paragraphs_styled", _paragraph_sql(True), ("paragraphs",))
def q_assemble_paragraphs_styled(spark, sf):
    return P.assemble_paragraphs(Fixtures(spark, sf)["paragraphs"], styled=True)


def _containers_sql(word_first: bool) -> str:
    order = [("theme", "theme/theme"), ("word", "word/document.xml"), ("excel", "xl/workbook.xml"),
             ("powerpoint", "ppt/presentation.xml")]
    if word_first:
        order = [order[1], order[0], *order[2:]]
    cases = " ".join(f"WHEN bool_or(contains(member, '{m}')) THEN '{k}'" for k, m in order)
    return f"SELECT path, CASE {cases} ELSE 'unknown' END AS kind FROM members GROUP BY path"


@query("classify_containers", _containers_sql(False), ("members",))
def q_classify_containers(spark, sf):
    return P.classify_containers(Fixtures(spark, sf)["members"])


@query("classify_containers_word_first", _containers_sql(True), ("members",))
def q_classify_containers_word_first(spark, sf):
    return P.classify_containers(Fixtures(spark, sf)["members"], word_first=True)


@query("valid_docx", """
SELECT path, bool_or(member = '[Content_Types].xml') AND bool_or(contains(member, 'word/document.xml')) AS valid
FROM members GROUP BY path""", ("members",))
def q_valid_docx(spark, sf):
    return P.valid_docx(Fixtures(spark, sf)["members"])


@query("sniff_legacy_doc", """
SELECT i.ord, i.name, ends_with(i.name, '.doc') AND upper(hex(encode(d.text)[1:8])) = 'D0CF11E0A1B11AE1' AS legacy_doc
FROM inbox i JOIN documents d ON i.ord = d.doc_id""", ("inbox",))
def q_sniff_legacy_doc(spark, sf):
    fx = Fixtures(spark, sf)
    files = fx["inbox"].join(fx["documents"].select(F.col("doc_id").alias("ord"), F.col("text").alias("content")), "ord")
    return P.sniff_legacy_doc(files).select("ord", "name", "legacy_doc")
