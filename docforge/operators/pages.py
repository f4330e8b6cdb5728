"""Pages of converted documents, Word paragraphs and archive members.

Page-level state (retries, pending work, budgets) and document assembly.
Assembly collects the pages (or paragraphs) of one document: its output is
one text cell per document, so a document is the natural unit of work; the
array is always sorted by position, since ``collect_list`` order is not
defined.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from ..functions import text as T

# Fixed values (must equal the reference's for equal results):
# the legacy Word signature, the docx validity members, and the archive
# member markers tested in this order: theme, Word, Excel, PowerPoint.
LEGACY_DOC_MAGIC = "D0CF11E0A1B11AE1"
DOCX_CONTENT_TYPES = "[Content_Types].xml"
CONTAINER_MARKERS = [
    ("theme", "theme/theme"),
    ("word", "word/document.xml"),
    ("excel", "xl/workbook.xml"),
    ("powerpoint", "ppt/presentation.xml"),
]


# ---------------------------------------------------------------------------
# page state
# ---------------------------------------------------------------------------
def page_cost(pages: DataFrame, text: str = "text", width: str = "width", height: str = "height") -> DataFrame:
    """Request cost of a page: prompt tokens and image tokens, each
    truncated on its own (as the page loop estimates them separately)."""
    cost = T.estimate_tokens(F.col(text)) + T.estimate_tokens(None, F.col(width), F.col(height))
    return pages.withColumn("cost", cost.cast("bigint"))


def budget_pages(pages: DataFrame, budget: int | None = None, key: str = "doc_id",
                 pos: str = "page_no") -> DataFrame:
    """Per document in page order: a page is taken when the tokens used so
    far plus its cost stay within the budget; otherwise it is skipped and the
    next page is tried (a later, cheaper page may still fit).  No or zero
    budget takes every page.  Needs a ``cost`` column (see ``page_cost``); a page
    without a cost is skipped.  A task streams over the sorted pages of its
    documents, so a document of any length takes constant memory."""
    if not budget:
        return pages.select(key, pos, "cost", F.lit(True).alias("taken"))
    limit, rows = int(budget), pages.select(key, pos, F.col("cost").cast("bigint").alias("cost"))

    def spend(batches):
        # rows in order of document and page; only the tokens used so far are kept
        now, used = None, 0
        for batch in batches:
            taken = []
            for doc, cost in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if doc != now:
                    now, used = doc, 0
                fits = cost is not None and used + cost <= limit
                used += cost if fits else 0
                taken.append(fits)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(taken, pa.bool_())], [*batch.schema.names, "taken"])

    schema = T_.StructType([*rows.schema.fields, T_.StructField("taken", T_.BooleanType())])
    return rows.repartition(key).sortWithinPartitions(key, pos, "cost").mapInArrow(spend, schema)


def retry_outcome(attempts: DataFrame, pages: DataFrame | None = None, max_retries: int = 2,
                  key: str = "doc_id", pos: str = "page_no") -> DataFrame:
    """From an attempt log ``(key, pos, attempt, ok)``: a page is ``ok`` at its
    first success, ``failed`` after ``max_retries + 1`` failed attempts, else
    ``pending``.  With ``pages``, pages never tried are pending with 0."""
    g = attempts.groupBy(key, pos).agg(
        F.count(F.lit(1)).alias("attempts"),
        F.min(F.when(F.col("ok"), F.col("attempt"))).alias("ok_attempt"),
        F.count(F.when(~F.col("ok"), 1)).alias("_fails"))
    if pages is not None:
        g = pages.select(key, pos).join(g, [key, pos], "left")
    fails = F.coalesce(F.col("_fails"), F.lit(0))
    status = (F.when(F.col("ok_attempt").isNotNull(), "ok")
              .when(fails >= max_retries + 1, "failed").otherwise("pending"))
    return g.select(key, pos, F.coalesce(F.col("attempts"), F.lit(0)).cast("bigint").alias("attempts"),
                    F.col("ok_attempt").cast("bigint").alias("ok_attempt"), status.alias("status"))


def pending_pages(pages: DataFrame, progress: DataFrame, max_retries: int = 2,
                  key: str = "doc_id", pos: str = "page_no") -> DataFrame:
    """Pages with no saved result that may still be tried: failed attempts
    so far are carried over, and a page stays eligible while they are at most
    ``max_retries``."""
    done = progress.filter(F.col("ok")).select(key, pos)
    tries = progress.filter(~F.col("ok")).groupBy(key, pos).agg(F.count(F.lit(1)).alias("attempts"))
    todo = (pages.select(key, pos).join(done, [key, pos], "left_anti")
            .join(tries, [key, pos], "left")
            .withColumn("attempts", F.coalesce(F.col("attempts"), F.lit(0)).cast("bigint")))
    return todo.filter(F.col("attempts") <= max_retries)


def page_summary(pages: DataFrame, key: str = "doc_id", text: str = "text", status: str = "status") -> DataFrame:
    """Per document: pages, ok, failed, success %, and whether the document
    converted (some page has text)."""
    ok = F.col(status) == "ok"
    g = pages.groupBy(key).agg(
        F.count(F.lit(1)).alias("pages_total"),
        F.count(F.when(ok, 1)).alias("pages_ok"),
        F.count(F.when(~ok, 1)).alias("pages_failed"),
        F.max(ok & (F.coalesce(F.length(F.col(text)), F.lit(0)) > 0)).alias("doc_ok"))
    pct = F.when(F.col("pages_total") > 0,
                 F.col("pages_ok").cast("double") * F.lit(100.0) / F.col("pages_total").cast("double")).otherwise(0.0)
    return g.select(key, "pages_total", "pages_ok", "pages_failed", pct.alias("success_pct"), "doc_ok")


def assemble_pages(pages: DataFrame, key: str = "doc_id", pos: str = "page_no", text: str = "text",
                   status: str | None = "status") -> DataFrame:
    """Texts of the successful pages joined in page order by a blank line;
    documents without any successful page are absent (conversion failed)."""
    p = pages
    if status is not None:
        p = p.filter(F.col(status) == "ok")
    p = p.filter(F.coalesce(F.length(F.col(text)), F.lit(0)) > 0)
    arr = F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(text).alias("t"))))
    return p.groupBy(key).agg(F.array_join(F.transform(arr, lambda x: x["t"]), "\n\n").alias("text"))


# ---------------------------------------------------------------------------
# Word paragraphs
# ---------------------------------------------------------------------------
def assemble_paragraphs(paragraphs: DataFrame, styled: bool = False, key: str = "doc_id",
                        pos: str = "para_no") -> DataFrame:
    """Paragraph rows ``(text, style, alignment)`` to a Markdown document.

    Empty (after strip) paragraphs are skipped.  Text: centred gets two
    trailing spaces, right-aligned four leading spaces, a ``List*`` style a
    ``- `` prefix.  A blank line goes before a paragraph that follows a
    non-empty one or whose text starts with ``#``; an empty paragraph after a
    non-empty one adds one blank line.  Stripped, one final newline.

    ``styled=False`` is the effective behaviour (the raw text is used);
    ``styled=True`` uses the heading level from the style name's last digit
    (plain text when it has none).  "Previous paragraph empty" depends only on
    the previous row, so a ``lag`` suffices.
    """
    txt = F.col("text")
    empty = T.py_strip(F.coalesce(txt, F.lit(""))) == ""
    w = Window.partitionBy(key).orderBy(pos)
    prev_empty = F.coalesce(F.lag(empty.cast("int")).over(w), F.lit(1)) == 1
    if styled:
        level = F.substring(F.col("style"), -1, 1)
        heading = F.col("style").startswith("Heading") & level.rlike("^[0-9]$")
        base = F.when(heading, F.concat(F.repeat(F.lit("#"), level.cast("int")), F.lit(" "), T.py_strip(txt)))\
            .otherwise(txt)
    else:
        base = txt
    aligned = (F.when(F.col("alignment") == "center", F.concat(base, F.lit("  ")))
               .when(F.col("alignment") == "right", F.concat(F.lit("    "), base))
               .otherwise(base))
    md = F.when(F.col("style").startswith("List"), F.concat(F.lit("- "), aligned)).otherwise(aligned)
    piece = (F.when(~empty & (md.startswith("#") | ~prev_empty), F.concat(F.lit("\n"), md))
             .when(~empty, md)
             .when(~prev_empty, F.lit(""))
             .otherwise(F.lit(None)))
    rows = paragraphs.select(key, pos, piece.alias("_piece"))
    arr = F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), F.col("_piece").alias("t"))))
    joined = F.array_join(F.transform(arr, lambda x: x["t"]), "\n")
    # pieces that add no line are null and skipped by array_join; a document
    # of empty paragraphs still yields "\n"
    return rows.groupBy(key).agg(joined.alias("_t"))\
        .select(key, F.concat(T.py_strip(F.col("_t")), F.lit("\n")).alias("text"))


# ---------------------------------------------------------------------------
# archive members and magic bytes
# ---------------------------------------------------------------------------
def classify_containers(members: DataFrame, word_first: bool = False, path: str = "path",
                        member: str = "member") -> DataFrame:
    """Office Open XML kind of an archive from its member names, in this
    order: theme, Word, Excel, PowerPoint, unknown (``word_first`` tests Word
    before theme -- Word files normally contain a theme part)."""
    g = members.groupBy(path).agg(*[F.max(F.col(member).contains(marker)).alias("_" + label)
                                    for label, marker in CONTAINER_MARKERS])
    labels = [label for label, _ in CONTAINER_MARKERS]
    if word_first:
        labels = [labels[1], labels[0], *labels[2:]]
    kind = F.when(F.col("_" + labels[0]), labels[0])
    for label in labels[1:]:
        kind = kind.when(F.col("_" + label), label)
    return g.select(path, kind.otherwise("unknown").alias("kind"))


def valid_docx(members: DataFrame, path: str = "path", member: str = "member") -> DataFrame:
    """Valid when the member list has ``[Content_Types].xml`` exactly and a
    member containing ``word/document.xml``."""
    g = members.groupBy(path).agg(
        F.max(F.col(member) == DOCX_CONTENT_TYPES).alias("_ct"),
        F.max(F.col(member).contains(dict(CONTAINER_MARKERS)["word"])).alias("_doc"))
    return g.select(path, (F.col("_ct") & F.col("_doc")).alias("valid"))


def sniff_legacy_doc(files: DataFrame, name: str = "name", content: str = "content") -> DataFrame:
    """``.doc`` (case as written) files whose first 8 bytes are the OLE2
    signature."""
    head = F.hex(F.substring(F.col(content).cast("binary"), 1, 8))
    return files.withColumn("legacy_doc", F.col(name).endswith(".doc") & (head == LEGACY_DOC_MAGIC))
