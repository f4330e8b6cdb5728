"""Main-text extraction from HTML by minimum-cut labelling of text blocks.

A page becomes a sequence of text blocks with their element path.  A linear
classifier gives each block the cost of either label; the costs are capacities
from the source (content) and to the sink (boilerplate).  Neighbouring blocks,
and neighbours under the same parent element, are joined by smoothness edges.
The minimum cut is the labelling of least total cost, and its source side is
the main text.

Class names count as whole names: ``sidebar`` is a sidebar, ``has-sidebar`` is
the layout of one.  An element that holds every article of the page, or a form
round its headings or navigation, wraps the page and is not judged by its name.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TAG = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>)")
_LOOSE_END = re.compile(r"</?([a-zA-Z][^\s/>]*)[^>]*>")
_ATTR = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?",
                   re.IGNORECASE)

# Element names of HTML by their role on a page.
RAW_TEXT = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
NOT_SHOWN = {"head", "noscript", "template", "svg", "math", "object", "canvas", "audio", "video", "map", "datalist"}
CONTROLS = {"form", "button", "select", "option", "fieldset", "label", "legend", "dialog", "input"}
CHROME = {"nav", "aside", "footer", "header", "menu"}
MAIN = {"article", "main"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
          "kbd", "mark", "nobr", "q", "ruby", "rb", "rt", "rp", "s", "samp", "small", "span", "strike", "strong",
          "sub", "sup", "time", "tt", "u", "var", "img", "wbr"}
CLOSES_P = {"p", "li", "dd", "dt"}
NEGATIVE_NAMES = {"ad", "ads", "adv", "advert", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs",
                  "comment", "comments", "consent", "cookie", "cookies", "disqus", "footer", "gdpr", "header", "masthead",
                  "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pager", "pagination",
                  "popup", "promo", "promotion", "related", "replies", "reply", "responses", "rss", "share", "sharing",
                  "sidebar", "sidenav", "skip", "social", "sponsor", "sponsored", "subscribe", "subscription", "tags",
                  "teaser", "toolbar", "topbar", "widget"}
POSITIVE_NAMES = {"article", "body", "content", "entry", "main", "post", "story", "text"}
LAYOUT_WORDS = {"has", "have", "hide", "hidden", "is", "layout", "no", "non", "not", "page", "show", "with", "without", "wrap",
                "wrapper"}
NEGATIVE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu",
                  "menubar", "toolbar"}
POSITIVE_ROLES = {"main", "article"}
# names of what is made of articles of its own, so holding the articles does not make it a wrapper
REPEATED_NAMES = {"comment", "comments", "disqus", "related", "replies", "reply", "responses", "teaser"}

# The classifier: log-odds in thousandths of "content" per feature of a block.
BIAS, IN_MAIN, IN_NAMED = -400, 6000, 1500
IN_CHROME, IN_NEGATIVE, IN_CONTROL = -16000, -16000, -30000
ENDS_NEGATIVE = -2000  # a name of several words that ends in a negative one, such as site-footer
PER_WORD, MOST_WORDS, ENDS_SENTENCE, HEADING, LINKS = 90, 30, 600, 300, -4000
ADJACENT, SAME_PARENT = 300, 400


class _Frame:
    __slots__ = ("name", "shown", "score", "ident", "doubt")

    def __init__(self, name, shown, score, ident, doubt=None):
        self.name, self.shown, self.score, self.ident, self.doubt = name, shown, score, ident, doubt


class _Doubt:
    """Negative log-odds of an element that may turn out to wrap the page."""

    __slots__ = ("around", "score", "form", "mains", "parts", "lifted")

    def __init__(self, around, score, form):
        self.around, self.score, self.form = around, score, form
        self.mains = self.parts = self.lifted = 0


def _element_score(name: str, attrs: str) -> tuple[int, bool, int, bool]:
    """Log-odds that an element adds to its blocks, whether it is shown, those
    of them that a wrapper of the page does not add, and whether it is a main
    element."""
    score, shown, doubt, main = 0, name not in NOT_SHOWN, 0, name in MAIN
    if name in MAIN:
        score += IN_MAIN
    elif name in CHROME:
        score += IN_CHROME
    elif name in CONTROLS:
        score += IN_CONTROL
        doubt = IN_CONTROL if name == "form" else 0
    if attrs and ("=" in attrs or "hidden" in attrs.lower()):
        worst, best, named = 0, 0, 0
        for m in _ATTR.finditer(attrs):
            key, value = m[1].lower(), html.unescape(m[2] or m[3] or m[4] or "").lower()
            if key == "hidden" or key == "aria-hidden" and value == "true":
                shown = False
            elif key == "style":
                shown = shown and not re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)
            elif key == "role":
                roles = set(value.split())
                worst = min(worst, IN_NEGATIVE if roles & NEGATIVE_ROLES else 0)
                best = max(best, IN_MAIN if roles & POSITIVE_ROLES else 0)
                main = main or bool(roles & POSITIVE_ROLES)
            else:
                whole = set(value.split())
                words = set(re.split(r"[^a-z]+", value))
                if name not in ("html", "body") and name not in MAIN:
                    if whole & NEGATIVE_NAMES:
                        worst = min(worst, IN_NEGATIVE)
                        named = 0 if whole & REPEATED_NAMES else IN_NEGATIVE
                    elif not words & (POSITIVE_NAMES | LAYOUT_WORDS) and any(
                            re.split(r"[^a-z]+", x)[-1] in NEGATIVE_NAMES for x in whole):
                        worst = min(worst, ENDS_NEGATIVE)
                        named = min(named, ENDS_NEGATIVE)
                best = max(best, IN_NAMED if words & POSITIVE_NAMES else 0)
        score += worst or best
        if named == worst and name not in CHROME:
            doubt += named
    return score, shown, doubt, main


def blocks(page: str) -> list[tuple[str, int, int, int, str]]:
    """``(text, log-odds of the elements around it, parent, link characters,
    element name)`` of every text block in page order; markup, comments and
    elements that are not shown give none."""
    out: list[tuple[str, int, int, int, str, _Doubt | None]] = []
    root = _Frame("#", True, 0, 0)
    stack, parts, linked, links, made, mains, doubts = [root], [], 0, 0, 0, 0, []
    opened: Counter[str] = Counter()                   # elements of the stack by name

    def flush():
        nonlocal parts, linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            top = stack[-1]
            if text and top.shown:
                owner = stack[-2].ident if len(stack) > 1 else 0
                out.append((text, top.score, owner, linked, top.name, top.doubt))
            parts, linked = [], 0

    def text(piece):
        nonlocal linked
        if piece and stack[-1].shown:
            parts.append(piece)
            if links:
                linked += len(piece)

    def close(depth):
        flush()
        for f in stack[depth:]:
            opened[f.name] -= 1
        del stack[depth:]

    pos, n = 0, len(page)
    while pos < n:
        at = page.find("<", pos)
        if at < 0:
            text(page[pos:])
            break
        text(page[pos:at])
        m = _TAG.match(page, at) or _LOOSE_END.match(page, at)
        if m is None:
            text("<")
            pos = at + 1
            continue
        if m.re is _TAG and m[1]:
            end = page.find("-->", at + 2)
            pos = n if end < 0 else end + 3
            continue
        if m.re is _TAG and m[2]:
            end = page.find(">", at)
            pos = n if end < 0 else end + 1
            continue
        pos = m.end()
        if m.re is _TAG:
            closing, name, attrs = m[3], m[4].lower(), m[5]
        else:
            closing, name, attrs = page.startswith("</", at), m[1].lower(), ""
        if name in INLINE:
            if name == "a":
                links = 0 if closing else 1
            if closing or not attrs or name in VOID:
                continue
            score, shown, _, _ = _element_score(name, attrs)
            if not shown or score < 0:
                name = f"#{name}"                  # an inline box of its own, such as a hidden or advert span
            else:
                continue
        if closing:
            key = next((k for k in (name, f"#{name}") if opened[k] > 0), None)
            if key:                                    # what lies above it is closed with it: linear over the page
                close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].name == key))
            elif name in ("p", "br"):
                flush()
            continue
        if name in RAW_TEXT:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.IGNORECASE).search(page, pos)
            if end is None:
                break
            tag_end = page.find(">", end.end())
            pos = n if tag_end < 0 else tag_end + 1
            continue
        if name == "br":
            text(" ")
            continue
        if name in VOID:
            if name == "hr":
                flush()
            continue
        if name == "body":
            close(1)
            links = 0
        elif name in CLOSES_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == name or stack[i].name == "p":
                    close(i)
                if stack[i - 1].name not in CLOSES_P:
                    break
        elif stack[-1].name == "p":
            close(len(stack) - 1)
        flush()
        score, shown, doubt, main = _element_score(name.lstrip("#"), attrs)
        made += 1
        top = stack[-1]
        inner = top.doubt
        if main and top.shown and shown:
            mains += 1
            if inner:
                inner.mains += 1
        if inner and (name in CHROME or name in ("h1", "h2")):
            inner.parts += 1
        if doubt:
            inner = _Doubt(inner, doubt, name == "form")
            doubts.append(inner)
        opened[name] += 1
        stack.append(_Frame(name, top.shown and shown, top.score + score, made, inner))
    flush()
    for d in reversed(doubts):
        if d.around:
            d.around.mains += d.mains
            d.around.parts += d.parts
    for d in doubts:
        wraps = mains > 0 and d.mains == mains or d.form and d.parts > 0
        d.lifted = (d.around.lifted if d.around else 0) + (d.score if wraps else 0)
    return [(t, around - (d.lifted if d else 0), owner, chars, name) for t, around, owner, chars, name, d in out]


def _log_odds(text: str, around: int, linked: int, name: str) -> int:
    words = text.count(" ") + 1
    score = BIAS + around + PER_WORD * min(words, MOST_WORDS) + LINKS * min(linked, len(text)) // len(text)
    if text[-1] in ".!?:;\"')”’»…。！？":
        score += ENDS_SENTENCE
    if name in ("h1", "h2", "h3", "h4", "h5", "h6"):
        score += HEADING
    return score


def min_cut(odds: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Labels of least cost: node ``i`` pays ``odds[i]`` when it is not content
    (``-odds[i]`` when it is, if negative), an edge ``(i, j, c)`` pays ``c``
    when its ends differ.  Shortest augmenting paths; ties go to boilerplate.

    When no path leads on from a node, what it reaches is on the content side
    for good, so later searches stay out of it."""
    excess = list(odds)
    near: list[dict[int, int]] = [{} for _ in odds]
    for i, j, c in edges:
        near[i][j] = near[i].get(j, 0) + c
        near[j][i] = near[j].get(i, 0) + c
    content = [False] * len(odds)
    for start in range(len(odds)):
        while excess[start] > 0 and not content[start]:
            come, queue, goal = {start: -1}, deque([start]), -1
            while queue and goal < 0:
                u = queue.popleft()
                for v, c in near[u].items():
                    if c > 0 and v not in come and not content[v]:
                        come[v] = u
                        if excess[v] < 0:
                            goal = v
                            break
                        queue.append(v)
            if goal < 0:
                for v in come:
                    content[v] = True
                break
            flow, v = min(excess[start], -excess[goal]), goal
            while come[v] >= 0:
                flow, v = min(flow, near[come[v]][v]), come[v]
            v = goal
            while come[v] >= 0:
                near[come[v]][v] -= flow
                near[v][come[v]] += flow
                v = come[v]
            excess[start] -= flow
            excess[goal] += flow
    return content


def main_text(page: str | None) -> str:
    """The text of the blocks on the content side of the cut, white space inside
    a block as one blank, blocks joined by one blank."""
    found = blocks(page) if page else []
    if not found:
        return ""
    odds = [_log_odds(text, around, linked, name) for text, around, _, linked, name in found]
    edges, last = [(i, i + 1, ADJACENT) for i in range(len(found) - 1)], {}
    for i, (_, _, parent, _, _) in enumerate(found):
        if parent in last:
            edges.append((last[parent], i, SAME_PARENT))
        last[parent] = i
    return " ".join(b[0] for b, keep in zip(found, min_cut(odds, edges), strict=True) if keep)


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                      html_col: str = "html") -> DataFrame:
    """One row per page: ``id_col, url_col, text, n_chars`` (code points).

    Null or empty pages, and pages without content blocks, have the empty
    text.  Rows are independent: repeated rows, null ids and ties need no
    rule.  Other columns are ignored; an empty table gives an empty result."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                        F.col(html_col).cast("string").alias("html"))

    def run(batches):
        for b in batches:
            for at in range(0, len(b), 256):
                part = b.slice(at, 256)
                texts = [main_text(x.as_py()) for x in part.column(2)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())],
                                                 ["id", "url", "text"])

    types = [rows.schema[c].dataType.simpleString() for c in ("id", "url")]
    out = rows.mapInArrow(run, f"id {types[0]}, url {types[1]}, text string")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text",
                      F.length("text").cast("long").alias("n_chars"))
