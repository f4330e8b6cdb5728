"""Benchmark decontamination by SimHash over item-sized windows.

Documents are cut into windows of as many words as benchmark items have.  A
window can only reach the similarity to some item of its size if it holds that
share of shingles known from items of this size, so windows are taken where the
document has enough of them; this prunes without loss, because a window moved
on to its next known shingle loses none.  Which item a window resembles is left
to the index: windows and items get SimHash fingerprints, and blocks of their
bits are the index's keys; two fingerprints within the radius are equal in at
least one of ``radius + 1`` blocks.  Retrieved pairs within the radius are
verified by the weighted Jaccard similarity of their shingles, repeats counting.

All steps are DataFrame operations; windows of equal words are fingerprinted
and looked up once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import reliable_checkpoint
from .arrow_batches import free_name

NOT_WORD = r"[^\p{L}\p{N}]+"
BROADCAST_ROWS = 500_000  # most index rows (of 16 bytes) that are broadcast; beyond, the join shuffles


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits; null text has none."""
    return F.filter(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), NOT_WORD), lambda w: w != "")


def shingles_of(words: str, length: str) -> str:
    """SQL for the word shingles of an array, joined by blanks."""
    return (f"transform(sequence(1, size({words}) - {length} + 1), "
            f"i -> array_join(slice({words}, i, {length}), ' '))")


def fingerprint(shingles: str) -> str:
    """SQL for the 64-bit SimHash of an array of shingles, repeats counting.

    A shingle's bits are the first 64 of its MD5; a bit is set if it is set in
    over half of them."""
    halves = [f"cast(conv(substr(md5(s), {at}, 8), 16, 10) as bigint)" for at in (1, 9)]
    hashes = f"transform({shingles}, s -> shiftleft({halves[0]}, 32) | {halves[1]})"
    return (f"aggregate(transform(array({hashes}), hs -> aggregate(sequence(0, 63), 0L, (fp, b) -> "
            f"if(2 * aggregate(hs, 0L, (n, h) -> n + (shiftrightunsigned(h, b) & 1L)) > size(hs), "
            f"fp | shiftleft(1L, b), fp))), 0L, (x, y) -> y)")


def hamming_blocks(radius: int) -> str:
    """SQL for ``(block, bits)`` structs of the column ``fp``: 64 bits in
    ``radius + 1`` blocks."""
    count = radius + 1
    cuts = [64 * i // count for i in range(count + 1)]
    return "array({})".format(", ".join(
        f"struct({i} as block, shiftrightunsigned(fp, {a}) & {(1 << (b - a)) - 1}L as bits)"
        for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))))


def _items(benchmark: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``item_id, item, words, size, w`` of items with words; ``item`` is the
    digest of their words."""
    out = benchmark.select(F.col(id_col).alias("item_id"), words_of(F.col(text_col)).alias("words"))
    return out.where(F.size("words") > 0).select(
        "item_id", F.md5(F.concat_ws(" ", "words")).alias("item"), "words", F.size("words").alias("size"),
        F.least(F.size("words"), F.lit(shingle)).alias("w"))


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_id_col: str = "item_id", item_text_col: str = "text", shingle: int = 5,
                       min_similarity: float = 0.8, radius: int = 20) -> DataFrame:
    """``id_col, item_id_col, similarity, hamming, start``: the most similar
    window of every document and item at or over ``min_similarity``, by
    fingerprints at most ``radius`` bits apart; ``start`` counts words from 0
    (of equal windows, the first that begins at a shingle of an item of this
    size or ends the document).

    Words are lower-case runs of letters and digits.  Items of fewer than
    ``shingle`` words are one shingle; items and texts without words (null,
    empty) match nothing.  A document shorter than the item is one window.
    Rows of equal id and text are one document; rows of equal id and different
    text report their best; items of equal words are compared once and all
    reported; null ids are kept as they are.  Other columns are ignored; an
    empty table on either side gives an empty result."""
    items = reliable_checkpoint(_items(benchmark, item_id_col, item_text_col, shingle))
    unique = items.dropDuplicates(["item"]).select("item", "words", "size", "w")
    spelled = unique.select("item", "size", "w", F.explode(F.expr(shingles_of("words", "w"))).alias("shingle"))
    weights = spelled.groupBy("item", "size", "w", "shingle").agg(F.count("*").alias("n"))
    widths = sorted(r.w for r in items.select("w").distinct().collect())  # at most `shingle` values

    keyed = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).select(
        "id", F.xxhash64("id", "text").alias("k1"), F.hash("text").alias("k2"), words_of(F.col("text")).alias("words"))
    found = None
    for w in widths:
        index = weights.where(F.col("w") == w).select(
            F.xxhash64(*[F.split("shingle", " ")[i] for i in range(w)]).alias("key"),
            "size").distinct()
        if index.count() <= BROADCAST_ROWS:
            index = F.broadcast(index)
        at = keyed.where(F.size("words") >= w).select(
            "k1", "k2", "words", F.explode(F.sequence(F.lit(0), F.size("words") - w)).alias("pos"))
        at = at.select("k1", "k2", F.size("words").alias("n_words"), "pos",
                       F.xxhash64(*[F.col("words")[F.col("pos") + i] for i in range(w)]).alias("key"))
        part = at.join(index, "key").select("k1", "k2", "n_words", "pos", "size", F.lit(w).alias("w"))
        found = part if found is None else found.unionAll(part)
    if found is None:
        empty = docs.select(F.col(id_col)).crossJoin(benchmark.select(F.col(item_id_col))).where("false")
        return empty.withColumns({"similarity": F.lit(0.0), "hamming": F.lit(0), "start": F.lit(0)})

    # windows that begin at a known shingle and hold enough of them
    spots = found.groupBy("k1", "k2", "n_words", "size", "w").agg(
        F.sort_array(F.collect_set("pos")).alias("at"))
    need = f"cast(ceil({min_similarity!r}D * (size - w + 1)) as int)"
    begins = (f"array_distinct(transform(filter(sequence(0, size(at) - {need}), "
              f"i -> size(at) >= {need} and at[i + {need} - 1] <= at[i] + size - w), "
              f"i -> greatest(0, least(at[i], n_words - size))))")
    spots = (spots.where(F.expr(f"size(at) >= {need}")).withColumn("begins", F.expr(begins))
             .where(F.size("begins") > 0).select("k1", "k2", "size", "w", "begins"))
    spots = reliable_checkpoint(spots)
    source = keyed.select("id", "k1", "k2", "words").join(spots, ["k1", "k2"]).dropDuplicates(["k1", "k2", "size"])
    windows = source.select("id", "size", "w", F.explode("begins").alias("start"), "words").select(
        "id", "size", "w", "start", F.expr("slice(words, start + 1, size)").alias("window"))
    windows = reliable_checkpoint(windows.withColumn("win", F.md5(F.concat_ws(" ", "window"))))

    distinct = windows.groupBy("size", "w", "win").agg(F.min("window").alias("window"))
    prints = reliable_checkpoint(distinct.withColumn("shingles", F.expr(shingles_of("window", "w"))).withColumn(
        "fp", F.expr(fingerprint("shingles"))).select("size", "win", "shingles", "fp"))
    blocks = F.explode(F.expr(hamming_blocks(radius))).alias("b")
    left = prints.select("size", "fp").distinct().select("size", "fp", blocks).select("size", "fp", "b.*")
    right = (unique.withColumn("shingles", F.expr(shingles_of("words", "w")))
             .withColumn("fp", F.expr(fingerprint("shingles"))).select("item", "size", "fp", blocks)
             .select("item", "size", F.col("fp").alias("item_fp"), "b.*"))
    near = (left.join(right, ["size", "block", "bits"])
            .withColumn("hamming", F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))).cast("int"))
            .where(F.col("hamming") <= radius).select("size", "fp", "item", "hamming").distinct())
    close = reliable_checkpoint(prints.join(near, ["size", "fp"]).select("item", "win", "hamming", "shingles"))

    counts = (close.select("item", "win", F.explode("shingles").alias("shingle"))
              .groupBy("item", "win", "shingle").agg(F.count("*").alias("m")))
    common = (counts.join(weights.select("item", "shingle", "n"), ["item", "shingle"])
              .groupBy("item", "win").agg(F.sum(F.least("m", "n")).alias("both")))
    total = F.size("shingles") + F.col("size") - F.col("w") + 1 - F.col("both")
    verified = (close.join(common, ["item", "win"]).join(unique.select("item", "size", "w"), "item")
                .select("item", "win", "hamming", (F.col("both") / total).alias("similarity"))
                .where(F.col("similarity") >= min_similarity))
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"), (-F.col("hamming")).alias("near")))
    hits = (windows.select("id", "win", "start").join(verified, "win")
            .groupBy("id", "item").agg(best.alias("best")))
    return hits.join(items.select("item", "item_id").distinct(), "item").select(
        F.col("id").alias(id_col), F.col("item_id").alias(item_id_col), F.col("best.similarity").alias("similarity"),
        (-F.col("best.near")).alias("hamming"), (-F.col("best.back")).alias("start"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      **options) -> DataFrame:
    """``docs`` without the rows whose id has a contaminated text (null ids are
    compared null-safely); see ``find_contamination``."""
    name = free_name(docs, "_hit")
    hit = find_contamination(docs, benchmark, id_col, text_col, **options).select(F.col(id_col).alias(name)).distinct()
    return docs.join(hit, F.col(id_col).eqNullSafe(F.col(name)), "left_anti")
