"""Ordered work in row-bounded ranges.

``in_ranges`` deals the rows of a table to ranges of their order (key, then
position), sampled by Spark so that every range holds about as many rows: a hot
key spreads over many ranges and small keys share one.  The number of ranges is
``spark.sql.shuffle.partitions``, or more to keep to a number of rows.  The
ranges are frozen, so that all passes see the same ones.

* ``running_sums``: inclusive running sums per key, a window inside each range
  plus the sums of the key's earlier ranges (one row per key and range).  Probe
  rows that add nothing read the sums up to their place (as-of lookups).
* ``fold_in_ranges``: a fold per key whose state depends on all earlier rows.
  A key that reaches over ranges is summarised once per range, as a function
  from the state at its start to the state at its end; a chain over these
  summaries (at most two rows per range, one state in memory) gives every range
  the state it starts with, and all ranges fold at the same time.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import reliable_checkpoint


def in_ranges(df: DataFrame, keys: list[str], order: list[str], most_rows: int | None = None) -> DataFrame:
    """``df`` with the column ``_range``; rows of a range are neighbours in the
    order ``keys``, ``order`` (nulls first), about ``most_rows`` at most if given
    (one pass more, to count them).  Frozen in the shared folder."""
    by = [F.col(c) for c in [*keys, *order]]
    if most_rows is None:
        dealt = df.repartitionByRange(*by)
    else:
        ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        dealt = df.repartitionByRange(max(ranges, -(-df.count() // most_rows)), *by)
    return reliable_checkpoint(dealt.withColumn("_range", F.spark_partition_id()))


def _struct(columns: list[str]) -> Column:
    """Never null and equal for equal columns, nulls included."""
    return F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(columns)])


def running_sums(ranged: DataFrame, keys: list[str], order: list[str], values: dict[str, str]) -> DataFrame:
    """Rows of ``in_ranges(df, keys, order)`` with the inclusive running sum of
    column ``v`` as ``out`` for every ``out: v`` of ``values``, per key in
    order.  Null keys are a key; ``_range`` goes."""
    placed = ranged.withColumn("_place", F.struct(_struct(keys).alias("key"), F.col("_range").alias("range")))
    inside = Window.partitionBy("_place").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy("_place.key").orderBy("_place.range").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("_place").agg(*[F.sum(v).alias(f"_sum_{out}") for out, v in values.items()])
    before = totals.select("_place", *[F.coalesce(F.sum(f"_sum_{out}").over(earlier), F.lit(0)).alias(f"_before_{out}")
                                       for out in values])
    summed = placed.select("*", *[F.sum(v).over(inside).alias(f"_in_{out}") for out, v in values.items()])
    return summed.join(before, "_place").select(
        *[F.col(c) for c in ranged.columns if c != "_range"],
        *[(F.coalesce(F.col(f"_in_{out}"), F.lit(0)) + F.col(f"_before_{out}")).cast("bigint").alias(out)
          for out in values])


def fold_in_ranges(ranged: DataFrame, key: str, order: list[str], summarize: Callable, advance: Callable,
                   fold: Callable, schema: str) -> DataFrame:
    """A fold per key over the rows of ``in_ranges(df, [key], order)``; ``key`` is never null.

    * ``summarize(rows)``: what the rows of a key in one range do to a state;
    * ``advance(state, summary)``: the state behind them (``state`` is None
      before the first row of the key);
    * ``fold(rows, state)``: the result rows (``schema``) of a whole range,
      ordered by key and order; ``state`` belongs to the first key, None if the
      range begins with its first row.

    Rows are pandas frames; summaries and states travel pickled."""
    key_type = ranged.schema[key].dataType.simpleString()
    link = f"`{key}` {key_type}, _range int, summary binary"

    def in_order(table: pa.Table) -> pd.DataFrame:
        return table.to_pandas().sort_values([key, *order], kind="stable", ignore_index=True)

    def ends(table: pa.Table) -> pa.Table:
        rows = in_order(table)
        first, last = rows[key].iloc[0], rows[key].iloc[-1]
        at = int(rows["_range"].iloc[0])
        links = [] if first == last else [{key: first, "_range": at, "summary": None}]
        links.append({key: last, "_range": at, "summary": pickle.dumps(summarize(rows[rows[key] == last]))})
        return pa.Table.from_pylist(links, pa.schema([table.schema.field(key), ("_range", pa.int32()), ("summary", pa.binary())]))

    def chain(batches) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            for i in range(len(batch)):
                own, at, summary = (batch.column(c)[i].as_py() for c in range(3))
                if own != now:
                    now, state = own, None
                if state is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([pickle.dumps(state)], pa.binary())],
                                                     ["_range", "state"])
                if summary is not None:
                    state = advance(state, pickle.loads(summary))

    result = to_arrow_schema(StructType.fromDDL(schema))

    def apply(table: pa.Table, states: pa.Table) -> pa.Table:
        state = pickle.loads(states.column("state")[0].as_py()) if len(states) else None
        return pa.Table.from_pandas(fold(in_order(table), state)[result.names], schema=result, preserve_index=False)

    entry = (ranged.groupBy("_range").applyInArrow(ends, link).repartition(key).sortWithinPartitions(key, "_range")
             .mapInArrow(chain, "_range int, state binary"))
    return ranged.groupBy("_range").cogroup(entry.groupBy("_range")).applyInArrow(apply, schema)
