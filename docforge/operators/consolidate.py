"""Flattening a tree into one folder with collision-free names.

Sequential rule (per file in scan order): the first file keeps its base name;
a later one, or one whose name already exists in the target, gets the first
free ``base_N.ext`` with N = 1, 2, ...

Distributed exact plan.  Names form a tree: ``a_1.txt`` is slot 1 of
``a.txt`` (the name the rule would generate), ``a.txt`` is slot 0 of itself.
For a natural name n with occurrences o_0 < o_1 < ... (scan positions):

* occurrences take n's slots in increasing order, skipping blocked ones;
* slot k is blocked for ever from a moment on: from the start for a name that
  exists in the target, from the first arrival of the natural name n_k, or --
  for slot 0 -- from the start if n's parent claimed the name n first;
* with c_k = number of occurrences before that moment and s = slots skipped so
  far, slot k is skipped iff ``s <= k - c_k`` (n had not reached it by then).  A
  slot of a natural child that is not skipped was claimed by n before the child
  arrived, which blocks the child's own slot 0;
* occurrence j then takes slot j + (skipped slots up to it).

Occurrences, and the probes that count c_k, are ranked in buckets of their
unique positions.  The walk over the blocked slots of a name is a fold in
ranges of bounded rows: a run of blocked slots takes s to a step function of s,
so runs are walked at the same time once their entry counts are known.  Walks go by the
depth of a name (how many ``_N`` it ends with), parents before children; a walk
reads blocked slots, never occurrences.  So no task holds a name.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import split_ext, stem
from ..session import reliable_checkpoint
from .ranges import fold_in_ranges, in_ranges
from .ranking import running_sum

_CHILD = r"_([1-9][0-9]{0,17})$"
_SUFFIXES = r"(?:_[1-9][0-9]{0,17})+$"
_WIDTH = 1 << 16           # positions per bucket of the ranks


def parent_of(name: F.Column):
    """(parent name, slot) when ``name`` is what the rule generates from a
    parent, else nulls."""
    st, ex = stem(name), split_ext(name)
    is_child = st.rlike(_CHILD)
    parent = F.when(is_child, F.concat(F.regexp_replace(st, _CHILD, ""), ex))
    slot = F.when(is_child, F.regexp_extract(st, _CHILD, 1).cast("bigint"))
    return parent, slot


def _depth_of(name: F.Column) -> F.Column:
    """How many generated suffixes a name ends with; one more than its parent's."""
    return F.size(F.split(F.regexp_extract(stem(name), _SUFFIXES, 0), "_")) - 1


def _slot_name(natural: F.Column, slot: F.Column) -> F.Column:
    return F.when(slot == 0, natural).otherwise(
        F.concat(stem(natural), F.lit("_"), slot.cast("string"), split_ext(natural)))


# --- the walk over blocked slots ----------------------------------------------


def walk_steps(limits: list[int]) -> list[int]:
    """What a run of blocked slots does to the number ``s`` of skipped ones (a
    slot with limit ``d`` is skipped iff ``s <= d``), as sorted steps: it becomes
    ``s + len(limits)`` less the number of steps smaller than ``s``."""
    steps: list[int] = []
    for i, d in enumerate(limits):
        # the largest s that the slots so far take to d or less
        s = d - i
        while (after := d - i + bisect_right(steps, s)) != s:
            s = after
        insort(steps, s)
    return steps


def after_walk(steps: list[int], s: int) -> int:
    return s + len(steps) - bisect_left(steps, s)


def _walk(rows: pd.DataFrame, s: int | None) -> pd.DataFrame:
    """Per blocked slot, in order of name and slot: whether it is skipped and
    how many of the name are skipped before it."""
    skipped, before, s, last = [], [], s or 0, None
    for name, d in zip(rows["name"].tolist(), (rows["k"] - rows["c"]).tolist(), strict=True):
        if name != last and last is not None:
            s = 0
        last = name
        before.append(s)
        skipped.append(s <= d)
        s += s <= d
    return rows.assign(skipped=skipped, before=before)


def _walked(blocks: DataFrame) -> DataFrame:
    schema = "name string, k bigint, child string, skipped boolean, before bigint"
    return fold_in_ranges(in_ranges(blocks, ["name"], ["k"]), "name", ["k"],
                          lambda rows: walk_steps((rows["k"] - rows["c"]).tolist()),
                          lambda s, steps: after_walk(steps, s or 0), _walk, schema)


def allocate_names(files: DataFrame, taken: DataFrame | None = None, overwrite: bool = False,
                   name: str = "name", ord_col: str = "ord") -> DataFrame:
    """``files(ord, name, ...)`` -> the same rows with ``target_name``, by the
    plan of the module docstring.  ``taken(name)`` lists names already in the
    target folder.  A file without a name gets none."""
    spark = files.sparkSession
    if overwrite:
        # every file goes to its own name; the last in scan order wins
        last = files.groupBy(name).agg(F.max(ord_col).alias("_last"))
        return (files.join(last, name).withColumn("target_name", F.col(name))
                .withColumn("overwritten", F.col(ord_col) != F.col("_last")).drop("_last"))
    if taken is None:
        taken = spark.createDataFrame([], "name string")
    rows = files.schema.simpleString()
    occ = files.select(F.col(name).alias("name"), F.col(ord_col).cast("bigint").alias("at"), F.struct("*").alias("row"))
    # every distinct name once: its first arrival, whether it exists in the target, its parent and slot
    parent, slot = parent_of(F.col("name"))
    nothing = F.lit(None).cast("bigint")
    names = occ.select("name", "at", F.lit(False).alias("taken")).unionByName(
        taken.select("name", nothing.alias("at"), F.lit(True).alias("taken"))).where("name is not null")
    names = names.groupBy("name").agg(F.min("at").alias("first"), F.max("taken").alias("taken"))
    arrived = names.where("first is not null").select(F.col("name").alias("parent"), F.lit(True).alias("generated"))
    names = reliable_checkpoint(names.select("*", parent.alias("parent"), slot.alias("slot"), _depth_of(F.col("name")).alias("depth"))
                                .join(arrived, "parent", "left"))
    generated = names.where("generated")
    blocked = names.where("taken and first is not null")
    children = generated.where("not taken")
    levels = names.agg(
        F.collect_set(F.when(F.col("generated"), F.col("depth") - 1)).alias("parents"),
        F.collect_set(F.when(F.expr("taken and first is not null"), F.col("depth"))).alias("blocked"),
        F.collect_set(F.when(F.expr("generated and not taken"), F.col("depth"))).alias("children")).first()

    # the rank of every occurrence, and how many of its parent's come before a child arrives; scan
    # positions are unique, so buckets of positions are bounded in rows
    seq = occ.select("*", nothing.alias("slot"), F.lit(None).cast("string").alias("child"), F.lit(1).alias("one")).unionByName(
        children.select(F.col("parent").alias("name"), F.col("first").alias("at"), F.lit(None).cast(rows).alias("row"),
                        "slot", F.col("name").alias("child"), F.lit(0).alias("one")))
    ranked = reliable_checkpoint(running_sum(seq.withColumn("place", F.col("at") * 2 + F.col("one")), ["name"], "place",
                                             ["one"], _WIDTH).select("name", "row", "slot", "child", F.col("cum_one").alias("upto")))

    # blocked slots and the occurrences before each is blocked; their walks by depth, parents first
    zero, no_child = F.lit(0).cast("bigint"), F.lit(None).cast("string").alias("child")
    blocks = (generated.where("taken").select(F.col("parent").alias("name"), F.col("slot").alias("k"), zero.alias("c"), no_child)
              .unionByName(blocked.select("name", zero.alias("k"), zero.alias("c"), no_child))
              .unionByName(ranked.where("slot is not null").select("name", F.col("slot").alias("k"),
                                                                   F.col("upto").alias("c"), "child")))
    skips, done = [], None
    for depth in range(max([*levels.parents, *levels.blocked, *levels.children], default=-1) + 1):
        here = [blocks.where(_depth_of(F.col("name")) == depth)] if depth in [*levels.parents, *levels.blocked] else []
        if done is not None and depth in levels.children:
            # a slot that was claimed before the child arrived blocks the child's own slot 0
            here.append(done.where("not skipped and child is not null").select(
                F.col("child").alias("name"), zero.alias("k"), zero.alias("c"), no_child))
        done = reliable_checkpoint(_walked(reduce(DataFrame.unionByName, here))) if here else None
        if here:
            skips.append(done.where("skipped").select("name", (F.col("k") - F.col("before")).alias("j")))
    placed = ranked.where("slot is null").select("name", "row", (F.col("upto") - 1).alias("j"))
    if not skips:
        slots = placed.withColumn("slot", F.col("j"))
    else:
        # occurrence j passes a skipped slot k, the i-th of its name, iff j >= k - i
        marks = reduce(DataFrame.unionByName, skips).groupBy("name", "j").agg(F.count("*").alias("one"))
        both = marks.select("name", F.lit(None).cast(rows).alias("row"), "j", (F.col("j") * 2).alias("place"), "one").unionByName(
            placed.select("name", "row", "j", (F.col("j") * 2 + 1).alias("place"), F.lit(0).cast("bigint").alias("one")))
        passed = running_sum(both, ["name"], "place", ["one"], _WIDTH)
        slots = passed.where("row is not null").select("name", "row", (F.col("j") + F.col("cum_one")).alias("slot"))
    return slots.select("row.*", _slot_name(F.col("name"), F.col("slot")).alias("target_name"))
