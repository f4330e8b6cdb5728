"""Connected components of an edge table by alternating large and small stars.

Edges stay distributed; each round is two joins against a one-row-per-node
minimum, the edge table is cut with ``checkpoint()`` and only counters reach
the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import reliable_checkpoint


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.where("v > u").join(low, "u")
            .select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(low, "u")
    return (linked.select(F.col("v").alias("a"), F.col("m").alias("b"))
            .unionAll(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
            .where("a <> b").distinct())


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges(a, b)`` of long node ids -> ``(node, root)`` for every node that
    has an edge to another node; ``root`` is the smallest node reachable.

    Self edges and repeated edges are allowed; null ends are ignored.  An empty
    table gives an empty result.  Raises if the stars have not settled after
    ``max_rounds`` rounds (the number needed grows with the logarithm of the
    longest chain)."""
    cur = reliable_checkpoint(edges.select("a", "b").where("a <> b").distinct())
    before = None
    for _ in range(max_rounds):
        cur = reliable_checkpoint(_small_star(_large_star(cur)))
        # a star forest is a fixed point: its size and its sums no longer change
        now = cur.agg(F.count("*"), F.sum(F.col("a").cast("decimal(38,0)")),
                      F.sum(F.col("b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("connected components did not settle")
    return (cur.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .unionAll(cur.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct())
