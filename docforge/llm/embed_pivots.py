"""Embedding near-duplicates through a pivot-permutation index.

Every vector is described by its nearest reference points (pivots), nearest
first.  Vectors of a label meet in inverted lists of their pivots; a pair that
shares enough pivots is a candidate, and its cosine in double precision
decides.  A pair sharing ``shared`` of ``nearest`` pivots must share one of the
first ``nearest - shared + 1`` pivots in the list order, so only those lists
hold a vector, and the first shared list alone reports the pair.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import reliable_checkpoint
from .arrow_batches import Forest
from .components import connected_components

BLOCK = 2048  # most vectors on either side of a comparison held by one task


def _usable(vec: Column, label: Column) -> Column:
    finite = F.forall(vec, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    return label.isNotNull() & vec.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vec, lambda x: x != 0)


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def _matrix(col, dim: int) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return np.asarray(col.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dim)


def nearest_pivots(unit: np.ndarray, pivots: np.ndarray, nearest: int) -> np.ndarray:
    """The ``nearest`` pivots of every row, nearest first (ties: lower number)."""
    dim = unit.shape[1]
    p = np.zeros((len(pivots), dim))
    p[:, :min(dim, pivots.shape[1])] = pivots[:, :dim]
    return np.argsort(-(unit @ p.T), axis=1, kind="stable")[:, :nearest]


def pivot_links(classes: DataFrame, min_cosine: float = 0.93, nearest: int = 10, shared: int = 4) -> DataFrame:
    """``classes(node, label, n, vec)`` -> ``(node, links, root)`` rows, some for
    every linked node: ``links`` add up to the members (``n``) of its linked
    classes, ``(node, root)`` are links of a spanning forest."""
    total = classes.count()
    if total == 0:
        return classes.sparkSession.createDataFrame([], "node bigint, links bigint, root bigint")
    # reference points grow with the square root of the vectors: 64 to 1024, all the driver sees
    m = min(1024, max(64, 1 << round(math.log2(math.sqrt(total) / 4 + 1))))
    picked = classes.orderBy(F.xxhash64("node"), "node").select("vec").limit(m).collect()
    wide = max(len(r.vec) for r in picked)
    pivots = np.zeros((len(picked), wide))
    for i, r in enumerate(picked):
        pivots[i, :len(r.vec)] = r.vec
    pivots = _unit(pivots)
    k = min(nearest, len(pivots))
    t = min(shared, k)
    lists = k - t + 1
    vec_type = classes.schema["vec"].dataType.simpleString()

    def describe(batches):
        for b in batches:
            if not len(b):
                continue
            dims = np.asarray(b.column("vec").value_lengths().to_numpy(zero_copy_only=False))
            for d in np.unique(dims):
                part = b.take(pa.array(np.flatnonzero(dims == d)))
                near = nearest_pivots(_unit(_matrix(part.column("vec"), int(d))), pivots, k)
                first = np.sort(near, axis=1)[:, :lists]
                at = pa.array(np.repeat(np.arange(len(part)), lists))
                rep = part.take(at)
                yield pa.RecordBatch.from_arrays(
                    [rep.column("label"), pa.array(np.full(len(rep), d, np.int32)),
                     pa.array(first.ravel().astype(np.int32)), rep.column("node"), rep.column("n"), rep.column("vec"),
                     pa.array(list(near.astype(np.int16)), pa.list_(pa.int16())).take(at)],
                    ["label", "dim", "pivot", "node", "n", "vec", "near"])

    label_type = classes.schema["label"].dataType.simpleString()
    inverted = classes.select("node", "label", "n", "vec").mapInArrow(
        describe, f"label {label_type}, dim int, pivot int, node bigint, n bigint, vec {vec_type}, near array<smallint>")
    sizes = inverted.groupBy("label", "dim", "pivot").agg(F.count("*").alias("_c")).where("_c > 1")
    chunks = F.ceil(F.col("_c") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("_k").cast("bigint")).cast("int")
    blocks = (inverted.join(sizes, ["label", "dim", "pivot"]).withColumn("_k", chunks).withColumn("_own", own)
              .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
              .select("label", "dim", "pivot", "node", "n", "vec", "near", "_own",
                      F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j")))

    def compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        _, dim, pivot, i, j = (x.as_py() for x in key)
        node, n = table.column("node").to_numpy(), table.column("n").to_numpy()
        unit = _unit(_matrix(table.column("vec"), dim))
        member = np.zeros((len(node), len(pivots)), np.float32)
        near = np.asarray(table.column("near").combine_chunks().flatten()).reshape(len(node), -1)
        np.put_along_axis(member, near.astype(np.int64), 1, axis=1)
        side = table.column("_own").to_numpy()
        left, right = np.flatnonzero(side == i), np.flatnonzero(side == j)
        links, forest = np.zeros(len(node), np.int64), Forest(len(node))
        for at in range(0, len(left), 256):
            block = left[at:at + 256]
            found = member[block] @ member[right].T >= t
            found &= member[block][:, :pivot] @ member[right][:, :pivot].T == 0
            if i == j:
                found &= block[:, None] < right[None, :]
            x, y = np.nonzero(found)
            for cut in range(0, len(x), 1 << 16):
                a, b = block[x[cut:cut + (1 << 16)]], right[y[cut:cut + (1 << 16)]]
                same = np.einsum("ij,ij->i", unit[a], unit[b]) >= min_cosine
                a, b = a[same], b[same]
                np.add.at(links, a, n[b])
                np.add.at(links, b, n[a])
                forest.link(a, b)
        hit = np.flatnonzero(links)
        return pa.table({"node": node[hit], "links": links[hit], "root": node[forest.label[hit]]})

    return blocks.groupBy("label", "dim", "pivot", "_i", "_j").applyInArrow(
        compare, "node bigint, links bigint, root bigint")


def embedding_near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                              label_col: str = "label", min_cosine: float = 0.93,
                              nearest: int = 10, shared: int = 4) -> DataFrame:
    """One row per vector: ``id_col, n_links`` (other vectors linked directly),
    ``component_id`` (smallest id reachable by links) and ``kept``.

    Vectors of equal label (not null) and equal length are linked when their
    cosine, in double precision, is at least ``min_cosine`` and they share
    ``shared`` of their ``nearest`` pivots.  Null vectors, zero vectors and
    vectors with null or non-finite components link with nothing.  Equal
    vectors of a label are one class and link to each other.  Null ids take
    part: ``component_id`` is the smallest id that is not null; ``kept`` is
    null-safe equality of id and component.  Repeated rows count as vectors of
    their own.  Other columns are ignored; an empty table gives an empty
    result."""
    vec, label = F.col("vec"), F.col("label")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).alias("vec"))
    rows = rows.withColumn("node", F.when(_usable(vec, label), F.xxhash64(label, vec)))
    classes = reliable_checkpoint(rows.where("node is not null").groupBy("node").agg(
        F.first("label").alias("label"), F.count("*").alias("n"), F.min("id").alias("low"), F.first("vec").alias("vec")))
    found = reliable_checkpoint(pivot_links(classes, min_cosine, nearest, shared))
    roots = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    placed = (classes.select("node", "n", "low").join(links, "node", "left").join(roots, "node", "left")
              .select("node", "low", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                      F.coalesce("root", "node").alias("root")))
    lows = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    member = placed.join(lows, "root").select("node", "n_links", "component_id")
    out = rows.select("id", "node").join(member, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
