"""Queries of the text family: Markdown cleaning and normalisation, text
nodes of web pages, token estimates, corpus decoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import Fixtures
from ..functions import text as T
from ..operators import clean as C
from .registry import query

# ---------------------------------------------------------------------------
# DuckDB spellings of the Python rules.  RE2's \s and \d are ASCII, so the
# oracle spells out Python's white-space set and uses \p{Nd}.
# ---------------------------------------------------------------------------
WS_SQL = "(" + " || ".join(f"chr({ord(c)})" for c in T.PY_WHITESPACE) + ")"
WS_RE2 = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in T.PY_WHITESPACE) + "]"


def strip_sql(x: str) -> str:
    return f"trim({x}, {WS_SQL})"


def lstrip_sql(x: str) -> str:
    return f"ltrim({x}, {WS_SQL})"


RULES_RE2 = [
    (r"(?m)^#+" + WS_RE2 + "+", ""),
    (r"\*\*(.*?)\*\*", r"\1"),
    (r"\*(.*?)\*", r"\1"),
    (r"__(.*?)__", r"\1"),
    (r"_(.*?)_", r"\1"),
    (r"`(.*?)`", r"\1"),
    (r"(?s)```(?:.*?)\n(.*?)```", r"\1"),
    (r"\[(.*?)\]\(.*?\)", r"\1"),
    (r"(?m)^>" + WS_RE2 + "+", ""),
    (r"(?m)^" + WS_RE2 + r"*[\-\*]" + WS_RE2 + "+", "• "),
    (r"(?m)^" + WS_RE2 + r"*\p{Nd}+\." + WS_RE2 + "+", ""),
    (r"(?m)^" + WS_RE2 + "*---" + WS_RE2 + "*$", ""),
]


def rules_sql(x: str) -> str:
    for pat, rep in RULES_RE2:
        x = f"regexp_replace({x}, '{pat}', '{rep}', 'g')"
    return x


def flatten_ctes(src: str, key: str = "doc_id") -> str:
    """CTEs ``fl_out(key, text)``: line explode + windows (independent of the
    Spark region regex)."""
    return f"""
fl_l AS (SELECT {key}, unnest(range(len(string_split(t, chr(10))))) AS i,
                unnest(string_split(t, chr(10))) AS line FROM {src}),
fl_f AS (SELECT *, contains(line, '|') AS hp,
                contains(line, '|') AND (contains(line, '---') OR contains(line, '-+-')) AS sep FROM fl_l),
fl_g AS (SELECT *, sum(CASE WHEN hp THEN 0 ELSE 1 END) OVER (PARTITION BY {key} ORDER BY i
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM fl_f),
fl_h AS (SELECT *, coalesce(bool_or(sep) OVER (PARTITION BY {key}, island ORDER BY i
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS after_sep FROM fl_g),
fl_o AS (SELECT {key}, i,
                CASE WHEN hp AND after_sep THEN array_to_string(list_filter(list_transform(string_split(line, '|'),
                     lambda c: {strip_sql('c')}), lambda c: c <> ''), ' | ') ELSE line END AS line
         FROM fl_h WHERE NOT sep),
fl_j AS (SELECT {key}, string_agg(line, chr(10) ORDER BY i) AS t FROM fl_o GROUP BY {key}),
fl_out AS (SELECT s.{key}, coalesce(j.t, '') AS text FROM {src} s LEFT JOIN fl_j j ON s.{key} = j.{key})"""


def normalize_sql(x: str) -> str:
    d = ("(CASE WHEN starts_with(" + strip_sql("line") + ", '```') THEN "
         + strip_sql("replace(replace(line, '```markdown', ''), '```', '')") + " ELSE line END)")
    s = strip_sql(d)
    heading = ("(CASE WHEN position(' ' IN " + s + ") > 0 THEN split_part(" + s + ", ' ', 1) || ' ' || "
               + lstrip_sql("substr(" + s + ", position(' ' IN " + s + ") + 1)") + " ELSE " + s + " END)")
    listed = "(repeat(' ', CAST(length(" + d + ") - length(" + lstrip_sql(d) + ") AS INTEGER)) || " + s + ")"
    piped = "array_to_string(list_transform(string_split(" + d + ", '|'), lambda c: " + strip_sql("c") + "), '|')"
    line = ("CASE WHEN " + s + " = '' THEN '' WHEN starts_with(" + s + ", '#') THEN " + heading
            + " WHEN starts_with(" + s + ", '-') OR starts_with(" + s + ", '*') OR starts_with(" + s + ", '1.') THEN "
            + listed + " WHEN contains(" + d + ", '|') THEN " + piped + " ELSE " + s + " END")
    joined = "array_to_string(list_transform(string_split(" + x + ", chr(10)), lambda line: " + line + "), chr(10))"
    return "(" + strip_sql("regexp_replace(" + joined + ", '\\n{3,}', chr(10) || chr(10), 'g')") + " || chr(10))"


# ---------------------------------------------------------------------------
# queries
# ---------------------------------------------------------------------------
@query("strip_markdown", f"SELECT doc_id, {rules_sql('text')} AS text FROM md_docs", ("md_docs",))
def q_strip_markdown(spark, sf):
    return C.strip_markdown(Fixtures(spark, sf)["md_docs"])


@query("flatten_tables", "WITH src AS (SELECT doc_id, text AS t FROM md_docs)," + flatten_ctes("src") +
       "\nSELECT doc_id, text FROM fl_out", ("md_docs",))
def q_flatten_tables(spark, sf):
    return C.flatten_tables(Fixtures(spark, sf)["md_docs"])


CLEAN_SQL = (f"WITH src AS (SELECT doc_id, {rules_sql('text')} AS t FROM md_docs)," + flatten_ctes("src") + f""",
cleaned AS (SELECT doc_id, {strip_sql("regexp_replace(text, '\\n{3,}', chr(10) || chr(10), 'g')")} AS text FROM fl_out)""")


@query("clean_markdown", CLEAN_SQL + "\nSELECT doc_id, text FROM cleaned", ("md_docs",))
def q_clean_markdown(spark, sf):
    return C.clean_markdown(Fixtures(spark, sf)["md_docs"])


@query("clean_markdown_raw", f"""
WITH src AS (SELECT doc_id, {rules_sql('text')} AS t FROM documents),""" + flatten_ctes("src") + f"""
SELECT doc_id, {strip_sql("regexp_replace(text, '\\n{3,}', chr(10) || chr(10), 'g')")} AS text FROM fl_out""")
def q_clean_markdown_raw(spark, sf):
    """The cleaner over the raw documents (prose with junk, secrets, etc.)."""
    return C.clean_markdown(Fixtures(spark, sf)["documents"].select("doc_id", "text"))


@query("clean_summary", CLEAN_SQL + """
SELECT CAST(count(*) AS BIGINT) AS successful_files, CAST(0 AS BIGINT) AS failed_files,
       CAST(coalesce(sum(length(text)), 0) AS BIGINT) AS total_chars FROM cleaned""", ("md_docs",))
def q_clean_summary(spark, sf):
    return C.clean_summary(C.clean_outcomes(Fixtures(spark, sf)["md_docs"]))


@query("normalize_markdown", f"SELECT doc_id, {normalize_sql('text')} AS text FROM md_docs", ("md_docs",))
def q_normalize_markdown(spark, sf):
    return C.normalize_markdown(Fixtures(spark, sf)["md_docs"])


@query("normalize_conversations", f"SELECT conv_id, turn, {normalize_sql('text')} AS text FROM conversations")
def q_normalize_conversations(spark, sf):
    return C.normalize_markdown(Fixtures(spark, sf)["conversations"].select("conv_id", "turn", "text"))


@query("table_rows", """
WITH l AS (SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS line_no,
                  unnest(string_split(text, chr(10))) AS line FROM md_docs),
f AS (SELECT *, contains(line, '|') AS hp,
             contains(line, '|') AND (contains(line, '---') OR contains(line, '-+-')) AS is_sep FROM l),
g AS (SELECT *, sum(CASE WHEN hp THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY line_no
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM f)
SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, line, is_sep,
       hp AND NOT is_sep AND coalesce(bool_or(is_sep) OVER (PARTITION BY doc_id, island ORDER BY line_no
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS is_row
FROM g""", ("md_docs",))
def q_table_rows(spark, sf):
    return C.table_rows(Fixtures(spark, sf)["md_docs"])


@query("extract_text_nodes", f"""
SELECT page_id, array_to_string(list_filter(list_transform(regexp_extract_all(html, '>([^<]+)<', 1),
       lambda x: {strip_sql('x')}), lambda x: x <> ''), chr(10) || chr(10)) AS text FROM pages""")
def q_extract_text_nodes(spark, sf):
    return C.extract_text_nodes(Fixtures(spark, sf)["pages"].select("page_id", "html")).select("page_id", "text")


@query("estimate_tokens", """
SELECT doc_id, page_no,
       CAST(floor(coalesce(length(text) / 4.0, 0) + coalesce(least(width * height / 750.0, 4000), 0)) AS BIGINT)
         AS tokens
FROM doc_pages""", ("doc_pages",))
def q_estimate_tokens(spark, sf):
    p = Fixtures(spark, sf)["doc_pages"]
    return p.select("doc_id", "page_no", T.estimate_tokens(F.col("text"), F.col("width"), F.col("height")).alias("tokens"))


@query("read_text_corpus", """
SELECT replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS text, file_name, file_size
FROM corpus""", ("corpus",))
def q_read_text_corpus(spark, sf):
    """Corpus rows as the file reader yields them: bytes decoded as UTF-8
    with replacement, newlines folded, size in bytes."""
    from ..sources.files import corpus_from_table
    return corpus_from_table(Fixtures(spark, sf)["documents"])
