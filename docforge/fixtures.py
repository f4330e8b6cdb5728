"""Derived input views over the driver tables.

The operators take files, pages, paragraphs, request logs and so on; the test
tables hold documents, conversations, events and pages.  Each view below is
one SQL text that both Spark and DuckDB run (the DuckDB form is what the
oracle queries are built on), so the two engines see identical inputs.

Placeholders: ``@table`` names a base table or another view; ``@bytes``,
``@ts_us`` and ``@div`` are the three spots where the dialects differ.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region nation customer supplier part orders lineitem events documents "
               "embeddings pages benchmark labels conversations").split()

MACROS = {
    "spark": {"bytes": "octet_length(text)",
              # equal to unix_micros(CAST(ts AS TIMESTAMP)) under a UTC session,
              # and independent of the session time zone (ts is timestamp_ntz)
              "ts_us": "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)",
              "div": "div"},
    "duckdb": {"bytes": "strlen(text)",
               "ts_us": "epoch_us(ts)",
               "div": "//"},
}

# doc_lines is the one view whose text differs between the engines.
DOC_LINES = {
    "spark": """
SELECT doc_id, CAST(i AS BIGINT) AS i, line FROM @documents
LATERAL VIEW posexplode(split(text, chr(10))) t AS i, line""",
    "duckdb": """
SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS i,
       unnest(string_split(text, chr(10))) AS line FROM @documents""",
}

MD_DOCS = {
    "spark": """
SELECT doc_id, array_join(transform(array_sort(collect_list(struct(i, line))), x -> x.line), chr(10)) AS text
FROM @md_lines GROUP BY doc_id""",
    "duckdb": """
SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS text FROM @md_lines GROUP BY doc_id""",
}

VIEWS = {
    "manifest": """
SELECT doc_id AS ord,
       '/corpus/' || CASE doc_id % 4 WHEN 0 THEN '' WHEN 2 THEN source || '/' || lang || '/'
                     ELSE source || '/' END
         || 'd' || CAST(doc_id AS STRING) || '/f' || CAST(doc_id % 3 AS STRING)
         || CASE doc_id % 3 WHEN 0 THEN '.md' WHEN 1 THEN '.txt' ELSE '.PDF' END AS path,
       'f' || CAST(doc_id % 3 AS STRING)
         || CASE doc_id % 3 WHEN 0 THEN '.md' WHEN 1 THEN '.txt' ELSE '.PDF' END AS name,
       CASE doc_id % 3 WHEN 0 THEN '.md' WHEN 1 THEN '.txt' ELSE '.pdf' END AS ext,
       CAST(CASE doc_id % 4 WHEN 0 THEN 1 WHEN 2 THEN 3 ELSE 2 END AS BIGINT) AS depth,
       CAST(@bytes AS BIGINT) AS size,
       1704067200000000 + ((doc_id * 7919) % 5) * 1000000 AS mtime_us,
       text
FROM @documents""",
    "processed_docs": """
SELECT ord FROM @manifest WHERE ord % 5 = 0""",
    "inbox": """
SELECT doc_id AS ord,
       CASE WHEN doc_id % 29 = 0 THEN '~$' ELSE '' END || 'd' || CAST(doc_id AS STRING)
         || CASE doc_id % 4 WHEN 0 THEN '.pdf' WHEN 1 THEN '.docx' WHEN 2 THEN '.DOC' ELSE '.xlsx' END AS name,
       CAST(@bytes AS BIGINT) AS size,
       CASE WHEN doc_id % 4 = 0 THEN 1 + doc_id % 9 END AS page_count
FROM @documents""",
    "outputs": """
SELECT 'd' || CAST(doc_id AS STRING) AS stem,
       'd' || CAST(doc_id AS STRING) || CASE doc_id % 15 WHEN 0 THEN '.docx' WHEN 5 THEN '.TXT' ELSE '.txt' END AS name
FROM @documents WHERE doc_id % 5 = 0""",
    "extractions": """
SELECT 'd' || CAST(doc_id AS STRING) || '.docx' AS name,
       CASE doc_id % 60 WHEN 0 THEN text WHEN 15 THEN text WHEN 30 THEN '' END AS text
FROM @documents WHERE doc_id % 15 = 0""",
    "outcomes": """
SELECT doc_id AS ord, 'd' || CAST(doc_id AS STRING) AS name,
       CASE doc_id % 3 WHEN 0 THEN 'pdf' WHEN 1 THEN 'doc' ELSE 'docx' END AS ext,
       CASE WHEN doc_id % 10 = 0 THEN 'failed' WHEN doc_id % 29 = 0 THEN 'skipped' ELSE 'ok' END AS status
FROM @documents""",
    "taken_names": """
SELECT name FROM @outcomes WHERE ord % 50 = 0""",
    "log_lines": """
SELECT (doc_id @div 10) % 4 AS log_id, doc_id * 3 + 0 AS line_no, '## 10:' || CAST(10 + doc_id % 50 AS STRING) || ':00 - d' || CAST(doc_id AS STRING) AS line
FROM @documents WHERE doc_id % 40 <> 0
UNION ALL
SELECT (doc_id @div 10) % 4, doc_id * 3 + 1, CASE (doc_id @div 10) % 6 WHEN 0 THEN '429 RESOURCE EXHAUSTED'
         WHEN 1 THEN 'Quota exceeded {''code'': 403, x}' WHEN 2 THEN 'usage limit and rate limit'
         WHEN 3 THEN 'AFC is enabled' WHEN 4 THEN 'Too Many Requests' ELSE 'bad page' END
FROM @documents WHERE doc_id % 40 <> 0
UNION ALL
SELECT (doc_id @div 10) % 4, doc_id * 3 + 2, '' FROM @documents WHERE doc_id % 40 <> 0""",
    "md_lines": """
SELECT doc_id, i,
       CASE i % 10 WHEN 0 THEN '# ' || line WHEN 1 THEN '**' || line || '**'
         WHEN 2 THEN '- ' || line WHEN 3 THEN '1. ' || line WHEN 4 THEN '> ' || line
         WHEN 5 THEN '| a | ' || line || ' |' || chr(10) || '|---|---|' || chr(10) || '| x |  y |' || chr(10) || '|  | ' || line || '|'
         WHEN 6 THEN '`' || line || '`' WHEN 7 THEN '[' || line || '](http://e.x/p)'
         WHEN 8 THEN '---' || chr(10) || chr(10) || chr(10)
         ELSE '  snake_case_name *' || line || '* ' END AS line
FROM @doc_lines""",
    "doc_pages": """
SELECT conv_id AS doc_id, turn AS page_no, text,
       CAST(1654 AS BIGINT) AS width, 2339 - 250 * turn AS height,
       CASE WHEN (conv_id + turn) % 7 = 0 THEN 'failed' ELSE 'ok' END AS status
FROM @conversations""",
    "attempts": """
SELECT c.conv_id AS doc_id, c.turn AS page_no, a.attempt AS attempt,
       a.attempt = (c.conv_id * 31 + c.turn * 17) % 5 AS ok
FROM @conversations c CROSS JOIN (SELECT 1 AS attempt UNION ALL SELECT 2 UNION ALL SELECT 3) a
WHERE a.attempt <= (c.conv_id * 31 + c.turn * 17) % 5""",
    "paragraphs": """
SELECT doc_id, i AS para_no, CASE WHEN i % 6 = 5 THEN '  ' ELSE line END AS text,
       CASE i % 5 WHEN 0 THEN 'Heading 1' WHEN 3 THEN 'List Bullet' ELSE 'Normal' END AS style,
       CASE i % 3 WHEN 1 THEN 'center' WHEN 2 THEN 'right' ELSE 'left' END AS alignment
FROM @doc_lines""",
    "members": """
SELECT 'd' || CAST(d.doc_id AS STRING) || '.docx' AS path, m.member AS member
FROM @documents d JOIN (
  SELECT 0 AS k, '[Content_Types].xml' AS member UNION ALL SELECT 0, 'word/document.xml'
  UNION ALL SELECT 1, '[Content_Types].xml' UNION ALL SELECT 1, 'word/document.xml' UNION ALL SELECT 1, 'word/theme/theme1.xml'
  UNION ALL SELECT 2, '[Content_Types].xml' UNION ALL SELECT 2, 'xl/workbook.xml'
  UNION ALL SELECT 3, 'ppt/presentation.xml' UNION ALL SELECT 4, 'mimetype' UNION ALL SELECT 5, 'word/document.xml') m
ON d.doc_id % 6 = m.k""",
    "requests": """
SELECT event_id, user_id % 3 AS api_key, @ts_us @div 250 AS ts_us,
       CAST(floor(value * 1000) AS BIGINT) AS tokens
FROM @events""",
    "corpus": """
SELECT text, 'd' || CAST(doc_id AS STRING) || '.txt' AS file_name, CAST(@bytes AS BIGINT) AS file_size
FROM @documents""",
    "existing_names": """
SELECT 'f0.md' AS name UNION ALL SELECT 'f0_1.md' UNION ALL SELECT 'f1_2.txt'""",
}

_REF = re.compile(r"@([a-z_]+)")


def _template(name: str, dialect: str) -> str:
    if name == "doc_lines":
        return DOC_LINES[dialect]
    if name == "md_docs":
        return MD_DOCS[dialect]
    return VIEWS[name]


def _deps(name: str) -> list[str]:
    """Views (not base tables, not macros) that ``name`` reads."""
    text = _template(name, "spark") + _template(name, "duckdb")
    out = []
    for ref in _REF.findall(text):
        if ref in MACROS["spark"] or ref in BASE_TABLES or ref in out:
            continue
        out.append(ref)
    return out


def _ordered(names) -> list[str]:
    seen: list[str] = []

    def visit(n):
        if n in seen:
            return
        for d in _deps(n):
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def _render(text: str, dialect: str, ref) -> str:
    def sub(m):
        key = m.group(1)
        if key in MACROS[dialect]:
            return MACROS[dialect][key]
        return ref(key)
    return _REF.sub(sub, text)


def duckdb_with(body: str, *views: str) -> str:
    """Prefix ``body`` with the CTEs of ``views`` (and what they read)."""
    names = _ordered(views)
    if not names:
        return body
    ctes = ",\n".join(
        f"{n} AS ({_render(_template(n, 'duckdb'), 'duckdb', lambda k: k)})" for n in names)
    head = body.lstrip()
    if head.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes},\n{head[15:]}"
    if head.upper().startswith("WITH "):
        # merge the body's own CTE list into ours
        return f"WITH {ctes},\n{head[5:]}"
    return f"WITH {ctes}\n{body}"


class Fixtures:
    """Lazily built Spark DataFrames for the base tables and the views."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name in BASE_TABLES:
                path = f"{self.sf_dir}/{name}.parquet"
                self._cache[name] = self._spread(self.spark.read.parquet(path), path)
            else:
                self._cache[name] = self._build(name)
        return self._cache[name]

    __getitem__ = table

    def _spread(self, df: DataFrame, path: str) -> DataFrame:
        """The test tables are single-row-group files, which Spark reads in
        one task however many cores there are.  Spread such a table over the
        cores once (round-robin; columns and filters are still pruned below
        it).  Inputs with enough row groups are left as read."""
        try:
            import pyarrow.parquet as pq
            groups = pq.ParquetFile(path).metadata.num_row_groups
        except Exception:  # noqa: BLE001 - not a local file: leave as read
            return df
        cores = self.spark.sparkContext.defaultParallelism
        return df.repartition(cores) if groups < cores else df

    def _build(self, name: str) -> DataFrame:
        text = _template(name, "spark")
        # spark.sql formats ``{df}`` arguments: escape literal braces first.
        text = text.replace("{", "{{").replace("}", "}}")
        refs = {}

        def ref(key):
            refs[key] = self.table(key)
            return "{" + key + "}"

        sql = _render(text, "spark", ref)
        return self.spark.sql(sql, **refs)
