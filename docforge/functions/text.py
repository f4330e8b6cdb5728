"""Text column expressions: Markdown stripping, table flattening, Markdown
normalisation, markup text extraction and decoding.

Everything here is a ``Column -> Column`` function built from Spark SQL
built-ins (regexp_replace, split, transform, filter, zip_with, trim), so it
runs inside whole-stage code generation with no Python worker.

Regex parity with Python's ``re``: Java needs ``(?d)`` (only ``\\n`` ends a
line, as in Python), ``(?U)`` (Unicode ``\\s`` and ``\\d``) and ``\\s``
widened by ``\\x1c-\\x1f``, which Python counts as white space.  Replacement
groups are ``$1``.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.strip()/str.isspace() set, derived from the rule itself.
PY_WHITESPACE = "".join(ch for ch in map(chr, range(sys.maxunicode + 1)) if ch.isspace())
WS = r"[\s\x1c-\x1f]"


def py_strip(c: Column) -> Column:
    """``str.strip()``: trims the full Unicode white-space set, linear time."""
    return F.trim(c, F.lit(PY_WHITESPACE))


def py_lstrip(c: Column) -> Column:
    return F.ltrim(c, F.lit(PY_WHITESPACE))


def py_rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(PY_WHITESPACE))


def fold_newlines(c: Column) -> Column:
    """Text-mode newline handling: ``\\r\\n`` and lone ``\\r`` become ``\\n``."""
    return F.regexp_replace(c, r"\r\n?", "\n")


# ---------------------------------------------------------------------------
# strip_markdown: the twelve rules, fixed order (fixed values of the cleaner).
# Each entry: (name, Java pattern, replacement).
# ---------------------------------------------------------------------------
MARKDOWN_RULES = [
    ("heading", r"(?dUm)^#+" + WS + "+", ""),
    ("bold_star", r"(?dU)\*\*(.*?)\*\*", "$1"),
    ("italic_star", r"(?dU)\*(.*?)\*", "$1"),
    ("bold_underscore", r"(?dU)__(.*?)__", "$1"),
    ("italic_underscore", r"(?dU)_(.*?)_", "$1"),
    ("inline_code", r"(?dU)`(.*?)`", "$1"),
    ("fenced_code", r"(?sU)```(?:.*?)\n(.*?)```", "$1"),
    ("link", r"(?dU)\[(.*?)\]\(.*?\)", "$1"),
    ("blockquote", r"(?dUm)^>" + WS + "+", ""),
    ("bullet", r"(?dUm)^" + WS + r"*[\-\*]" + WS + "+", "• "),
    ("ordered", r"(?dUm)^" + WS + r"*\d+\." + WS + "+", ""),
    ("rule", r"(?dUm)^" + WS + "*---" + WS + "*$", ""),
]


def strip_markdown(c: Column, rules=None) -> Column:
    """Apply the Markdown rules in order (callers may pass a reordered list)."""
    for _, pattern, repl in (rules or MARKDOWN_RULES):
        c = F.regexp_replace(c, F.lit(pattern), F.lit(repl))
    return c


# ---------------------------------------------------------------------------
# flatten_tables
#
# A separator line holds a pipe and "---" or "-+-".  After one, every further
# line that holds a pipe (up to the first pipe-free line) is a table row:
# separators are dropped, rows become their trimmed non-empty cells joined by
# " | ".  Lines of the block before its first separator stay as they are.
#
# One regex finds each region "separator + following pipe lines" (leftmost
# match = first separator of a block; greedy = to the block's end).  Each
# region carries the newline in front of it, so dropping a line drops its
# newline too.  ``split`` by the same regex gives the text between regions, and
# ``zip_with`` interleaves the two.  All linear, no explode, no shuffle.
# ---------------------------------------------------------------------------
_SEP_LINE = r"(?=[^\n]*\|)[^\n]*(?:---|-\+-)[^\n]*"
# The repeat is possessive: a plain one recurses once per table line.
_PIPE_LINE = r"[^\n|]*+\|[^\n]*+"
TABLE_REGION = r"\n" + _SEP_LINE + r"(?:\n" + _PIPE_LINE + r")*+"


def _is_separator(line: Column) -> Column:
    return line.contains("|") & (line.contains("---") | line.contains("-+-"))


def table_row_text(line: Column) -> Column:
    """A table row as its trimmed, non-empty cells joined by `` | ``."""
    cells = F.transform(F.split(line, r"\|", -1), py_strip)
    return F.array_join(F.filter(cells, lambda x: x != ""), " | ")


def _flatten_region(region: Column) -> Column:
    lines = F.split(region, "\n", -1)
    # element 0 is the empty text before the region's leading newline
    body = F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0)))
    rows = F.filter(body, lambda x: ~_is_separator(x))
    return F.array_join(F.transform(rows, lambda x: F.concat(F.lit("\n"), table_row_text(x))), "")


def flatten_tables(c: Column) -> Column:
    t = F.concat(F.lit("\n"), c)
    outside = F.split(t, TABLE_REGION, -1)
    regions = F.transform(F.regexp_extract_all(t, F.lit(TABLE_REGION), F.lit(0)), _flatten_region)
    joined = F.array_join(
        F.zip_with(outside, regions, lambda o, r: F.concat(o, F.coalesce(r, F.lit("")))), "")
    flat = F.substring(joined, 2, 2147483647)
    # Only texts with a separator line can change.
    return F.when(_is_separator(c), flat).otherwise(c)


def table_lines(c: Column) -> Column:
    """The lines of a text as an array of ``(line, is_sep, is_row)``."""
    t = F.concat(F.lit("\n"), c)

    def marked(part, in_region):
        lines = F.split(part, "\n", -1)   # element 0 is the empty text before the leading newline
        body = F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0)))
        return F.transform(body, lambda x: F.struct(
            x.alias("line"), _is_separator(x).alias("is_sep"),
            (F.lit(in_region) & ~_is_separator(x)).alias("is_row")))

    outside = F.transform(F.split(t, TABLE_REGION, -1), lambda p: marked(p, False))
    regions = F.transform(F.regexp_extract_all(t, F.lit(TABLE_REGION), F.lit(0)), lambda p: marked(p, True))
    none = F.slice(F.element_at(outside, 1), 1, 0)
    return F.flatten(F.zip_with(outside, regions, lambda o, r: F.concat(o, F.coalesce(r, none))))


def collapse_blank_runs(c: Column) -> Column:
    return F.regexp_replace(c, r"\n{3,}", "\n\n")


def clean_markdown(c: Column, rules=None) -> Column:
    """Rules, then tables, then runs of 3+ newlines to 2, then strip."""
    return py_strip(collapse_blank_runs(flatten_tables(strip_markdown(c, rules))))


# ---------------------------------------------------------------------------
# normalize_markdown: per-line normalisation of converter output.
# ---------------------------------------------------------------------------
# Fixed values of the normaliser: fence markers removed (in this order),
# the heading marker and the list markers whose indentation is kept.
FENCE_MARKERS = ["```markdown", "```"]
HEADING_MARKER = "#"
LIST_MARKERS = ["-", "*", "1."]


def _normalize_line(line: Column) -> Column:
    s = py_strip(line)
    defenced = line
    for marker in FENCE_MARKERS:
        defenced = F.replace(defenced, F.lit(marker), F.lit(""))
    line = F.when(s.startswith(FENCE_MARKERS[-1]), py_strip(defenced)).otherwise(line)
    s = py_strip(line)
    heading = F.when(F.instr(s, " ") > 0,
                     F.concat(F.substring_index(s, " ", 1), F.lit(" "),
                              py_lstrip(F.substr(s, F.instr(s, " ") + 1))))\
        .otherwise(s)
    indent = F.length(line) - F.length(py_lstrip(line))
    listed = F.concat(F.repeat(F.lit(" "), indent), s)
    piped = F.array_join(F.transform(F.split(line, r"\|", -1), py_strip), "|")
    is_list = F.lit(False)
    for marker in LIST_MARKERS:
        is_list = is_list | s.startswith(marker)
    return (F.when(s == "", F.lit(""))
            .when(s.startswith(HEADING_MARKER), heading)
            .when(is_list, listed)
            .when(F.instr(line, "|") > 0, piped)
            .otherwise(s))


def normalize_markdown(c: Column) -> Column:
    lines = F.transform(F.split(c, "\n", -1), _normalize_line)
    # Blank lines are exactly the empty outputs and other lines never become
    # empty, so "one blank line per run" is a newline-run collapse.
    joined = collapse_blank_runs(F.array_join(lines, "\n"))
    return F.concat(py_strip(joined), F.lit("\n"))


# ---------------------------------------------------------------------------
# extract_text_nodes: text between tags, trimmed, empties dropped, blank-line
# joined.
# ---------------------------------------------------------------------------
def extract_text_nodes(html: Column) -> Column:
    nodes = F.transform(F.regexp_extract_all(html, F.lit(r">([^<]+)<"), F.lit(1)), py_strip)
    return F.array_join(F.filter(nodes, lambda x: x != ""), "\n\n")


# ---------------------------------------------------------------------------
# decoding
# ---------------------------------------------------------------------------
def decode_utf8_replace(content: Column) -> Column:
    """UTF-8 with U+FFFD for malformed bytes (Python ``errors="replace"``)."""
    return F.make_valid_utf8(content.cast("string"))


def decode_with_fallback(content: Column) -> Column:
    """Strict UTF-8; if any byte is malformed the whole file is latin-1."""
    as_utf8 = content.cast("string")
    return F.when(F.is_valid_utf8(as_utf8), as_utf8).otherwise(F.decode(content, "ISO-8859-1"))


# ---------------------------------------------------------------------------
# token estimate: int(chars / 4 + min(width * height / 750, 4000))
# ---------------------------------------------------------------------------
def estimate_tokens(text: Column | None = None, width: Column | None = None,
                    height: Column | None = None) -> Column:
    total = F.lit(0.0)
    if text is not None:
        total = total + F.coalesce(F.length(text) / 4.0, F.lit(0.0))
    if width is not None and height is not None:
        img = F.least((width * height) / 750.0, F.lit(4000.0))
        total = total + F.coalesce(img, F.lit(0.0))
    return F.floor(total).cast("bigint")
