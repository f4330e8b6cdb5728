"""Sharding by a hierarchical weighted hash tree (region, rack, shard).

A row descends from the root: at every level each child draws
``-ln(u) / weight`` with ``u`` from a hash of the child's path and the row key,
and the smallest draw wins.  A child that gains weight only attracts rows, one
that loses weight only gives rows away, and all other children keep theirs, so
movement stays inside the subtrees whose weights change.  A new shard is added
as a region of its own: it is then the only child whose draw is new, so rows
move into that shard and nowhere else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

Tree = dict[str, dict[str, dict[int, float]]]  # region -> rack -> shard -> weight


def uniform_tree(shards: int, racks_per_region: int = 2, shards_per_rack: int = 4) -> Tree:
    """``shards`` equal shards, numbered from 0, filled into racks and regions in order."""
    tree: Tree = {}
    for s in range(shards):
        rack = s // shards_per_rack
        region = f"region{rack // racks_per_region}"
        tree.setdefault(region, {}).setdefault(f"rack{rack}", {})[s] = 1.0
    return tree


def with_new_shard(tree: Tree, weight: float = 1.0) -> Tree:
    """The tree with one more shard, in a region and rack of its own."""
    new = 1 + max(s for racks in tree.values() for shards in racks.values() for s in shards)
    return {**tree, f"grown{new}": {f"rack-of-{new}": {new: weight}}}


def _race(key: str, entries: list[tuple[str, float]]) -> str:
    """SQL for the number of the entry ``(path, weight)`` with the smallest draw
    (ties: the earlier entry)."""
    if len(entries) == 1:
        return "0"
    draws = ", ".join(
        f"struct(-ln((shiftrightunsigned(xxhash64('{path}', {key}), 11) + 0.5D) / 9007199254740992D) / {float(w)!r}D, {i})"
        for i, (path, w) in enumerate(entries))
    return f"array_min(array({draws})).col2"


def _branch(choice: str, values: list[str], var: str) -> str:
    """SQL for the value numbered ``choice``, which is evaluated once."""
    if len(values) == 1:
        return values[0]
    cases = " ".join(f"when {i} then {v}" for i, v in enumerate(values))
    return f"transform(array({choice}), {var} -> case {var} {cases} end)[0]"


def shard_of(key: str, tree: Tree) -> Column:
    """The shard of the string column named ``key``.  Children of weight 0 or
    less take no rows.  Region and rack names are letters, digits and dashes."""
    regions = []
    for r, racks in tree.items():
        used = [(f"{r}/{k}", {s: w for s, w in ss.items() if w > 0}) for k, ss in racks.items()]
        if any(ss for _, ss in used):
            regions.append((r, [(p, ss) for p, ss in used if ss]))

    def in_rack(path, shards):
        return _branch(_race(key, [(f"{path}/{s}", w) for s, w in shards.items()]), [str(s) for s in shards], "z")

    def in_region(racks):
        return _branch(_race(key, [(p, sum(ss.values())) for p, ss in racks]),
                       [in_rack(p, ss) for p, ss in racks], "y")

    top = _race(key, [(r, sum(sum(ss.values()) for _, ss in racks)) for r, racks in regions])
    return F.expr(_branch(top, [in_region(racks) for _, racks in regions], "x")).cast("int")


def assign_shards(docs: DataFrame, tree: Tree, grown: Tree | None = None, id_col: str = "doc_id",
                  text_col: str = "text", slot_buckets: int = 1024) -> DataFrame:
    """One row per document: ``id_col, size, text_crc32, law, shard, slot, grown_shard``.

    ``size`` is the UTF-8 length of the text plus 16 (null text: 16, CRC of the
    empty string).  ``shard`` depends on the id and the tree alone; a null id is
    the key ``null``, repeated ids share their shard.  ``slot`` numbers the rows
    of a shard from 0 without gaps: rows are numbered within hash buckets of
    the shard (bucket from id and text checksum, so equal ids spread while
    their texts differ) and the buckets' counts, at most shards x
    ``slot_buckets`` rows, give the offsets.  Equal rows take neighbouring
    slots.  Other columns of ``docs`` are ignored; an empty table gives an
    empty result."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col), F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("_key"), F.col(text_col),
    ).select(
        F.col(id_col),
        (F.octet_length(text).cast("long") + 16).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of("_key", tree).alias("shard"),
        (shard_of("_key", grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
    ).withColumn("_bucket", F.pmod(F.xxhash64(F.col(id_col), "text_crc32"), F.lit(slot_buckets)).cast("int"))
    # at most shards x slot_buckets rows, whatever the input: safe to broadcast
    counts = rows.groupBy("shard", "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("shard", "_bucket").orderBy(F.col(id_col), "text_crc32", "size")
    numbered = rows.withColumn("_rn", F.row_number().over(inside))
    return (numbered.join(F.broadcast(offsets), ["shard", "_bucket"])
            .select(id_col, "size", "text_crc32", "law", "shard",
                    (F.col("_start") + F.col("_rn") - 1).alias("slot"), "grown_shard"))
