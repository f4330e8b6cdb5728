"""Line de-duplication by a log-template tree.

A line is parsed to a leaf of a tree of fixed depth: its token count, then its
leading tokens, runs of digits being variable fields.  Fields are only masked
in lines that say something without them (``tokens``): rows of numbers are
compared by their exact tokens.  In a leaf a token is a constant where enough
documents have it at its place; other tokens are variable fields.  A line of
constants is a template of its own, and a line that is constant but for a few
fields follows a template of its leaf.  Templates that recur across documents
are dropped, all but the first occurrence.

Only hashes of lines are shuffled, except for the lines that share a leaf with
different ones: those are compared token by token.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import reliable_checkpoint

FIELD = "0"  # stands for every run of digits, so no text of its own can look like a field


def tokens(line: Column) -> Column:
    """The tokens of a line, runs of digits being the variable field.

    A line keeps its numbers, as one token that equals only itself, unless half
    of its tokens hold a letter and it has two letters for every field."""
    plain = F.when(line.rlike(r"[\t\r\f]"), F.translate(line, "\t\r\f", "   ")).otherwise(line)
    words = F.array_remove(F.split(plain, " "), "")
    hidden = F.regexp_replace(plain, "[0-9]+", FIELD)
    masked = F.array_remove(F.split(hidden, " "), "")
    named = F.size(F.filter(masked, lambda x: x.rlike(r"\p{L}")))
    letters = F.length(F.regexp_replace(hidden, r"\P{L}+", ""))
    fields = F.length(F.regexp_replace(hidden, f"[^{FIELD}]+", ""))
    says = (2 * named >= F.size(masked)) & (letters >= 2 * fields)
    return F.when(line.rlike("[0-9]"), F.when(says, masked).otherwise(F.array(F.array_join(words, " ")))).otherwise(words)


def _key(id_col: str, text: Column) -> dict[str, Column]:
    return {"k1": F.xxhash64(F.col(id_col), text), "k2": F.hash(text)}


def recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 3,
                    leading: int = 3, similarity: float = 0.8) -> DataFrame:
    """``k1, k2, line_no`` of the lines to drop, once per document key."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("id"), *[c.alias(n) for n, c in _key(id_col, text).items()],
                        text.alias("text"))
    lines = (keyed.select("id", "k1", "k2", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
             .withColumn("t", tokens(F.col("line"))).where(F.size("t") > 0))
    slim = reliable_checkpoint(lines.select(
        F.xxhash64(F.size("t"), F.slice("t", 1, leading)).alias("leaf"), F.xxhash64("t").alias("full"),
        "id", "k1", "k2", "line_no"))
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "k1", "k2", "line_no")
    per_doc = slim.groupBy("leaf", "full", "id", "k1", "k2").agg(F.min("line_no").alias("line_no"))
    forms = reliable_checkpoint(per_doc.groupBy("leaf", "full").agg(
        F.count("*").alias("docs"), F.min(place).alias("first")))
    recurring = F.col("docs") >= min_docs

    # leaves of several forms, some of them too rare to be templates of their own
    mixed = (forms.groupBy("leaf").agg(F.count("*").alias("forms"), F.sum("docs").alias("all"),
                                       F.min("docs").alias("rarest"))
             .where((F.col("forms") > 1) & (F.col("all") >= min_docs) & (F.col("rarest") < min_docs)).select("leaf"))
    # their tokens, read from the first document of each form
    wanted = (forms.join(mixed, "leaf", "left_semi")
              .groupBy("first.k1", "first.k2")
              .agg(F.collect_list(F.struct("leaf", "full", "docs", "first.line_no")).alias("forms")))
    spelled = (keyed.select("k1", "k2", "text").join(wanted, ["k1", "k2"])
               .select("k1", "k2", F.split("text", "\n").alias("lines"), F.explode("forms").alias("f"))
               .select("f.leaf", "f.full", "f.docs", tokens(F.expr("lines[f.line_no]")).alias("t")))
    # rows of equal id and text spell the same form more than once
    # a field is neither alike nor different, so only the other tokens count
    plain = F.filter("t", lambda x: ~x.contains(FIELD))
    lead = F.size(F.filter(F.slice("t", 1, leading), lambda x: ~x.contains(FIELD)))
    places = (
        spelled.select("leaf", "full", "docs", F.size(plain).alias("n"), lead.alias("lead"),
                       F.posexplode("t").alias("place", "token"))
        .where(((F.col("place") >= leading) & ~F.col("token").contains(FIELD)) | (F.col("place") == 0))
        .select("leaf", "full", "docs", "n", "lead", "place", F.xxhash64("place", "token").alias("field")).distinct())
    constants = (places.where(F.col("place") >= leading).groupBy("leaf", "field").agg(F.sum("docs").alias("all"))
                 .where(F.col("all") >= min_docs).select("leaf", "field"))
    # how many of a rare form's later tokens are constants of the leaf
    rare = places.where(~recurring)
    fixed = (rare.where(F.col("place") >= leading).join(constants, ["leaf", "field"], "left_semi")
             .groupBy("leaf", "full").agg(F.count("*").alias("fixed")))
    same = (F.col("lead") + F.coalesce("fixed", F.lit(0))) / F.nullif(F.col("n"), F.lit(0))
    followers = (
        rare.where(F.col("place") == 0).select("leaf", "full", "n", "lead").join(fixed, ["leaf", "full"], "left")
        .where(same >= similarity).select("leaf", "full").join(forms, ["leaf", "full"]).select("leaf", "full", "first"))

    # the first line of a leaf among templates and followers stays, if it is a follower
    heads = forms.where(recurring).select("leaf", "first").unionAll(followers.select("leaf", "first"))
    heads = heads.groupBy("leaf").agg(F.min("first").alias("head"))
    stays = followers.join(heads, "leaf").select(
        "leaf", "full", F.when(F.col("first") == F.col("head"), F.col("head")).alias("stay"))
    dropped = forms.where(recurring).select("leaf", "full", F.col("first").alias("stay")).unionAll(stays)
    return (slim.select("leaf", "full", place.alias("at")).join(dropped, ["leaf", "full"])
            .where(~F.col("at").eqNullSafe(F.col("stay"))).select("at.k1", "at.k2", "at.line_no").distinct())


def drop_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 3,
                         leading: int = 3, similarity: float = 0.8, count_cols: tuple[str, str] | None =
                         ("n_lines", "n_dropped")) -> DataFrame:
    """``docs`` without the lines whose template recurs in ``min_docs`` or more
    documents, all but the template's first occurrence (smallest id, then line
    number; null ids last); ``count_cols`` names the counts of all and of
    dropped lines.

    Documents are counted by id and text, so repeated rows are one document and
    get the same result.  Blank lines are never dropped.  Null text stays null,
    with 0 lines; an empty text has one (blank) line.  Columns that are named
    like a new one are replaced, all others stay; an empty table gives an empty
    result."""
    gone = recurring_lines(docs, id_col, text_col, min_docs, leading, similarity)
    per_doc = gone.groupBy("k1", "k2").agg(F.sort_array(F.collect_set("line_no")).alias("_gone"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # the texts are shuffled by their key once, the other columns follow to the same place
    texts = docs.select(*[c.alias(n) for n, c in _key(id_col, text).items()], text.alias("text"))
    lines = texts.join(per_doc, ["k1", "k2"], "left").withColumn("_all", F.split("text", "\n"))
    # the runs of lines between dropped ones, each joined again
    runs = F.zip_with(
        F.concat(F.array(F.lit(0)), F.transform("_gone", lambda g: g + 1)),
        F.concat(F.col("_gone"), F.array(F.size("_all"))),
        lambda a, b: F.struct(a.alias("a"), (b - a).alias("n")))
    kept = F.array_join(F.transform(F.filter(runs, lambda r: r["n"] > 0),
                                    lambda r: F.array_join(F.slice("_all", r["a"] + 1, r["n"]), "\n")), "\n")
    rest = (lines.select("k1", "k2", F.when(F.col("_gone").isNull(), F.col("text")).otherwise(kept).alias("_text"),
                         F.size("_all").cast("long").alias("_n"),
                         F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("_dropped"))
            .dropDuplicates(["k1", "k2"]))
    names = [c for c in docs.columns if c not in (count_cols or ())]
    row = F.struct(*[F.col(c) for c in names if c != text_col], F.col(text_col).isNull().alias("_null"))
    others = docs.select(row.alias("_row"), *[c.alias(f"_{n}") for n, c in _key(id_col, text).items()])
    out = others.join(rest, (F.col("_k1") == F.col("k1")) & (F.col("_k2") == F.col("k2")))
    null = F.col("_row._null")
    columns = [F.when(~null, F.col("_text")).alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in names]
    if count_cols:
        columns += [F.when(null, F.lit(0)).otherwise(F.col("_n")).cast("long").alias(count_cols[0]),
                    F.col("_dropped").alias(count_cols[1])]
    return out.select(columns)
