"""SimHash near-duplicates through a vantage-point tree over the fingerprints.

The upper levels of the tree are built on a bounded sample of the distinct
fingerprints and cut the Hamming space into shards.  A fingerprint lives in
one shard; as a query it visits the shards its ball of ``max_bits`` reaches,
by the triangle bound at every vantage point, so every pair within the
distance meets in a shard.  Inside a shard the same tree search goes on, level
by level over arrays, and hands out a spanning forest of the links found, not
the pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import reliable_checkpoint
from .arrow_batches import Forest, free_name, slices
from .components import connected_components

SAMPLE = 1 << 16      # most fingerprints the driver sees to place vantage points
HOME_BLOCK = 1 << 16  # most fingerprints of a shard that one task holds
VISIT_BLOCK = 1 << 18
SEED = 42


def fingerprint(text: bytes, words: int) -> int:
    """64-bit SimHash of the UTF-8 bytes of a text (see ``fingerprints``)."""
    tokens = text.lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    if len(tokens) <= words:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate([[0], ends[:-words] + 1])
    digest = xxhash.xxh64_intdigest
    n, ones, step = len(starts), np.zeros(64, np.int64), 1 << 16
    for at in range(0, n, step):
        spans = zip(starts[at:at + step].tolist(), ends[words - 1:][at:at + step].tolist(), strict=True)
        h = np.array([digest(joined[s:e], SEED) for s, e in spans], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int((np.uint64(1) << np.flatnonzero(2 * ones > n).astype(np.uint64)).sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """``id_col, text_hash, fp`` (both signed 64 bits) of every row.

    Letters A-Z are lower-cased, words are runs of characters other than blank
    and ``\\x09-\\x0D``, shingles are ``words`` words joined by one blank (fewer
    words: the whole sequence), hashed by XXH64 with seed 42; repeats count.  A
    bit is set if it is set in over half the hashes.  Null or empty texts and
    texts without words have fingerprint 0."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))

    def run(batches):
        for b in slices(batches, "text"):
            texts = b.column(2).cast(pa.large_binary())
            fps = np.fromiter((fingerprint(t.as_py() or b"", words) for t in texts), np.uint64, len(b))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))],
                                             ["id", "text_hash", "fp"])

    schema = f"id {rows.schema['id'].dataType.simpleString()}, text_hash bigint, fp bigint"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def _distance(a, b):
    return np.bitwise_count(a ^ b).astype(np.int16)


def build_tree(sample: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Vantage points and median radii of a complete tree, in heap order."""
    nodes = (1 << depth) - 1
    points, radii = np.zeros(nodes, np.uint64), np.zeros(nodes, np.int16)
    parts: dict[int, np.ndarray] = {0: sample}
    for node in range(nodes):
        own = parts.pop(node)
        pool = own if len(own) >= 8 else sample
        trial = pool[np.linspace(0, len(pool) - 1, min(8, len(pool))).astype(int)]
        spread = [(_distance(v, pool).std(), v) for v in trial]
        points[node] = max(spread)[1]
        d = _distance(points[node], pool)
        radii[node] = int(np.median(d)) if len(pool) else 32
        d = _distance(points[node], own)
        parts[2 * node + 1], parts[2 * node + 2] = own[d <= radii[node]], own[d > radii[node]]
    return points, radii


def route(fps: np.ndarray, points: np.ndarray, radii: np.ndarray, depth: int, reach: int):
    """``(row, leaf)`` pairs that a ball of radius ``reach`` around every row touches."""
    row, node = np.arange(len(fps)), np.zeros(len(fps), np.int64)
    for _ in range(depth):
        d = _distance(fps[row], points[node])
        inner, outer = d - reach <= radii[node], d + reach > radii[node]
        row = np.concatenate([row[inner], row[outer]])
        node = np.concatenate([2 * node[inner] + 1, 2 * node[outer] + 2])
    return row, node - ((1 << depth) - 1)


def _search(fps, home, visit, reach, forest, small=96):
    """Link ``visit`` (indexes) to the ``home`` indexes within ``reach``."""
    todo = [(home, visit)]
    while todo:
        h, v = todo.pop()
        if not len(h) or not len(v):
            continue
        if len(h) > small:
            vp = fps[h[len(h) // 2]]
            dh, dv = _distance(vp, fps[h]), _distance(vp, fps[v])
            mu = np.median(dh)
            hin = dh <= mu
            if not hin.all():
                near, far = v[dv - reach <= mu], v[dv + reach > mu]
                todo += [(h[hin], near), (h[~hin], far)]
                continue
        step = max(1, (1 << 21) // len(h))
        for at in range(0, len(v), step):
            block = v[at:at + step]
            x, y = np.nonzero(np.bitwise_count(fps[block][:, None] ^ fps[h][None, :]) <= reach)
            forest.link(block[x], h[y])


def similar_fingerprints(distinct: DataFrame, max_bits: int = 3) -> DataFrame:
    """Links ``(a, b)`` that join every two fingerprints of ``distinct(fp)``
    within ``max_bits`` bits (a spanning forest per shard, not all pairs)."""
    n = distinct.count()
    if n < 2:
        return distinct.sparkSession.createDataFrame([], "a bigint, b bigint")
    # shards grow with the square root of the fingerprints, the sample bounds them
    depth = max(0, min(int(math.log2(SAMPLE)) - 4, round(0.5 * math.log2(n)) - 3))
    picked = distinct.orderBy(F.xxhash64("fp"), "fp").limit(min(SAMPLE, 64 << depth)).collect()
    sample = np.array([r.fp for r in picked], np.int64).view(np.uint64)
    points, radii = build_tree(sample, depth)

    def spread(batches):
        for b in batches:
            fps = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            _, own = route(fps, points, radii, depth, 0)
            order, _ = route(fps, points, radii, depth, 0)
            home = np.empty(len(fps), np.int64)
            home[order] = own
            row, leaf = route(fps, points, radii, depth, max_bits)
            keep = leaf >= home[row]  # the pair meets in the later of its two homes
            row, leaf = row[keep], leaf[keep]
            yield pa.RecordBatch.from_arrays(
                [pa.array(leaf.astype(np.int32)), pa.array(fps[row].view(np.int64)), pa.array(leaf == home[row])],
                ["leaf", "fp", "home"])

    rows = distinct.select("fp").mapInArrow(spread, "leaf int, fp bigint, home boolean")
    # one row per shard, at most 2^12 of them: safe to broadcast
    sizes = rows.groupBy("leaf").agg(F.ceil(F.count_if("home") / HOME_BLOCK).cast("int").alias("kh"),
                                     F.ceil(F.count("*") / VISIT_BLOCK).cast("int").alias("kv")).where("kh > 0")
    blocks = rows.join(F.broadcast(sizes), "leaf")
    h, own = F.sequence(F.lit(0), F.col("kh") - 1), F.pmod(F.xxhash64("fp"), F.col("kh").cast("bigint")).cast("int")
    v, at = F.sequence(F.lit(0), F.col("kv") - 1), F.pmod(F.xxhash64("fp"), F.col("kv").cast("bigint")).cast("int")
    visits = blocks.select("leaf", "fp", F.explode(h).alias("i"), at.alias("j"), F.lit(False).alias("home"))
    homes = (blocks.where("home").select("leaf", "fp", own.alias("i"), F.explode(v).alias("j"), F.lit(True).alias("home")))

    def pairs(table: pa.Table) -> pa.Table:
        fp = table.column("fp").to_numpy().view(np.uint64)
        is_home = table.column("home").to_numpy()
        items, index = np.unique(fp, return_inverse=True)
        forest = Forest(len(items))
        _search(items, np.unique(index[is_home]), np.unique(index[~is_home]), max_bits, forest)
        linked = np.flatnonzero(forest.label != np.arange(len(items)))
        return pa.table({"a": items[linked].view(np.int64), "b": items[forest.label[linked]].view(np.int64)})

    return visits.unionAll(homes).groupBy("leaf", "i", "j").applyInArrow(pairs, "a bigint, b bigint")


def simhash_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                            words: int = 3, max_bits: int = 3) -> DataFrame:
    """One row per document: ``id_col, fingerprint`` (16 hex digits),
    ``component_id`` (smallest id reachable through links of at most
    ``max_bits`` differing bits, itself included), ``group_fp`` (a number per
    component) and ``text_hash``.

    Texts of equal fingerprint are one node of the search, so copies are never
    expanded.  Documents without words link to each other through fingerprint
    0.  Null ids take part; their ``component_id`` is the smallest id that is
    not null in the component, or null.  Repeated rows are returned as often
    as they come.  Other columns are ignored, an empty table gives an empty
    result."""
    fps = reliable_checkpoint(fingerprints(docs, id_col, text_col, words))
    nodes = fps.groupBy("fp").agg(F.min(id_col).alias("_low"))
    roots = connected_components(similar_fingerprints(nodes.select("fp"), max_bits))
    placed = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "_low", F.coalesce("root", "fp").alias("group_fp"))
    lows = placed.groupBy("group_fp").agg(F.min("_low").alias("component_id"))
    member = placed.join(lows, "group_fp").select("fp", "group_fp", "component_id")
    return fps.join(member, "fp").select(
        id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "group_fp", "text_hash")


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       words: int = 3, max_bits: int = 3) -> DataFrame:
    """The rows of ``docs`` that stay when every group of near-duplicates keeps
    one document: the one of smallest id (null ids last), ties broken by a hash
    of the text.  Of repeated rows one stays."""
    groups = simhash_near_duplicates(docs, id_col, text_col, words, max_bits)
    order = F.struct(F.col(id_col).isNull().alias("last"), F.col(id_col).alias("id"), "text_hash")
    kept_id, kept_hash, told = (free_name(docs, c) for c in ("_kept_id", "_kept_hash", "_text_hash"))
    kept = groups.groupBy("group_fp").agg(F.min(order).alias("k")).select(
        F.col("k.id").alias(kept_id), F.col("k.text_hash").alias(kept_hash))
    keyed = docs.withColumn(told, F.xxhash64(F.col(text_col).cast("string")))
    return (keyed.join(kept, F.col(id_col).eqNullSafe(F.col(kept_id)) & F.col(told).eqNullSafe(F.col(kept_hash)), "left_semi")
            .dropDuplicates([id_col, told]).drop(told))
