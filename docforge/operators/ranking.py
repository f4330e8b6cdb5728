"""Ordered computations without one-task windows.

A window with no PARTITION BY, or over one huge partition, runs in a single
task.  These helpers split ordered work into bounded pieces:

* ``row_number_by_buckets``: row numbers from a window inside each bucket of
  a monotone bucket expression plus the counts of earlier buckets;
* ``running_sum``: inclusive running sums, the same two levels;
* ``forward_fill``: ``last(value, ignorenulls)`` up to each row, the same two
  levels (also the as-of lookup: merge probes into the ordered sequence);
* ``next_after``: the first later value after each probe time (a descending
  forward fill);
* ``sorted_positions``: 1-based positions in a total order from a
  range-partitioned sort, ids frozen by a checkpoint, and per-partition
  offsets (a table of one row per partition).

Callers bound the rows per bucket (for example by folding a unique position
into the bucket), so no task sees more than one bucket of a hot key.

Null partition keys are a partition of their own and null order values a bucket
of their own (the first): the carry tables are joined on a struct of the
partition and the bucket, which is never null and equals a struct with nulls at
the same places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import reliable_checkpoint


def _place(partition: list[str], bucket: Column) -> Column:
    return F.struct(*[F.col(c).alias(f"p{i}") for i, c in enumerate(partition)], bucket.alias("b"))


def _partition(partition: list[str]) -> list[str]:
    return [f"_place.p{i}" for i in range(len(partition))]


def row_number_by_buckets(df: DataFrame, order: list[Column], bucket: Column,
                          partition: list[str] | None = None, out: str = "row_no") -> DataFrame:
    part = list(partition or [])
    b = df.withColumn("_place", _place(part, bucket))
    counts = b.groupBy("_place").agg(F.count(F.lit(1)).alias("_n"))
    w = (Window.partitionBy(*_partition(part)) if part else Window).orderBy("_place.b")\
        .rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_place", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    local = b.withColumn("_local", F.row_number().over(Window.partitionBy("_place").orderBy(*order)))
    return (local.join(offsets, "_place")
            .withColumn(out, (F.col("_off") + F.col("_local")).cast("bigint"))
            .drop("_place", "_local", "_off"))


def forward_fill(df: DataFrame, partition: list[str], order: str, value: str, out: str,
                 width: int = 1 << 16) -> DataFrame:
    """``last(value, ignorenulls)`` over rows up to the current one, ordered by
    the integer column ``order`` inside ``partition`` -- computed in two
    levels so that a huge partition is cut into buckets of ``width`` order
    positions: a window inside each bucket, plus the last value of all earlier
    buckets (a table with one row per bucket).  The bucket window, the bucket
    aggregate and the final join share one hash partitioning."""
    b = df.withColumn("_place", _place(partition, F.floor(F.col(order) / F.lit(width))))
    w_in = Window.partitionBy("_place").orderBy(order)\
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    b = b.withColumn("_local", F.last(F.col(value), ignorenulls=True).over(w_in))
    # every bucket, with its own last value (null when it has none)
    per_bucket = b.groupBy("_place").agg(
        F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.col(order))).alias("_tail"))
    w_prev = Window.partitionBy(*_partition(partition)).orderBy("_place.b").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_bucket.select("_place", F.last("_tail", ignorenulls=True).over(w_prev).alias("_carry"))
    return (b.join(carry, "_place", "left")
            .withColumn(out, F.coalesce(F.col("_local"), F.col("_carry")))
            .drop("_place", "_local", "_carry"))


def sorted_positions(df: DataFrame, order: list[Column], out: str = "position") -> DataFrame:
    """1-based position of every row in a total order, without a one-task
    window: a range-partitioned sort, ids that increase within the sort
    (partition index in the high bits), frozen by a reliable checkpoint so
    that both uses below see the same ids, then per-partition counts (one row
    per partition, a bounded table) turned into offsets."""
    ided = df.sort(*order).withColumn("_mid", F.monotonically_increasing_id()).transform(reliable_checkpoint)
    part = F.shiftright(F.col("_mid"), 33)
    counts = ided.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    offs = counts.select("_p", F.coalesce(F.sum("_n").over(
        Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    local = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    return (ided.withColumn("_p", part).join(F.broadcast(offs), "_p")
            .withColumn(out, (F.col("_off") + local + 1).cast("bigint"))
            .drop("_p", "_off", "_mid"))


def running_sum(df: DataFrame, partition: list[str], order: str, values: list[str],
                width: int, prefix: str = "cum_") -> DataFrame:
    """Inclusive running sums of ``values`` ordered by the (unique within the
    partition) integer column ``order``, in two levels: a window inside each
    bucket of ``width`` order units, plus the totals of all earlier buckets
    (one row per bucket)."""
    b = df.withColumn("_place", _place(partition, F.floor(F.col(order) / F.lit(width))))
    w_in = Window.partitionBy("_place").orderBy(order)\
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for v in values:
        b = b.withColumn("_l_" + v, F.sum(v).over(w_in))
    tot = b.groupBy("_place").agg(*[F.sum(v).alias("_t_" + v) for v in values])
    w_prev = Window.partitionBy(*_partition(partition)).orderBy("_place.b").rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select("_place", *[F.coalesce(F.sum("_t_" + v).over(w_prev), F.lit(0)).alias("_o_" + v) for v in values])
    out = b.join(tot, "_place")
    for v in values:
        out = out.withColumn(prefix + v, F.col("_l_" + v) + F.col("_o_" + v)).drop("_l_" + v, "_o_" + v)
    return out.drop("_place")


def next_after(points: DataFrame, partition: list[str], ts: str, probes: DataFrame, at: str,
               out: str, width: int) -> DataFrame:
    """For each probe time ``at``: the smallest ``ts`` of ``points`` (same
    partition) strictly greater than it, or null -- an as-of lookup done as
    a two-level forward fill over the merged sequence in descending order."""
    real = points.select(*partition, (-(F.col(ts) * 2)).alias("_okey"),
                         F.col(ts).cast("bigint").alias("_v"), F.lit(None).cast("bigint").alias("_at"))
    prb = probes.select(*partition, (-(F.col(at) * 2 + 1)).alias("_okey"),
                        F.lit(None).cast("bigint").alias("_v"), F.col(at).cast("bigint").alias("_at"))
    filled = forward_fill(real.unionByName(prb), partition, "_okey", "_v", "_next", width=2 * width)
    return filled.filter(F.col("_at").isNotNull()).select(*partition, F.col("_at").alias(at),
                                                           F.col("_next").alias(out)).distinct()
