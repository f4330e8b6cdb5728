"""Prefix trie of conversations: ternary search trees per range shard.

Distinct turns get dictionary ids, a conversation becomes the list of its turn
ids, and equal lists are one sequence with the number of its conversations.
The sequences are range-partitioned in list order and every shard builds a
ternary search tree over its own, inserted median first so that the trees of
siblings are balanced; an iterative traversal accumulates members, leaves and
savings.

A node reaches over several shards exactly if it is a common prefix of the last
sequence of one and the first of the next.  Every shard knows the lengths of
these common prefixes (one number per shard).  It counts a node as a distinct
one (and as a child) only if no earlier shard has it, so that all measures of
such a boundary node are plain sums, or minima, over the shards; the node is
named by the first shard that has it and its depth.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_path

SHARD_TURNS = 1 << 18     # turns of distinct sequences that a shard is meant to hold
END_BLOCK = 1 << 16       # conversation ids that are joined to one text before they are digested
# fixed value: words are separated by ASCII blanks
WORD = r"[^\x20\x09-\x0D]+"


class TernaryTree:
    """Ternary search tree over rows of turn ids.  Arrays by node: ``low`` and
    ``high`` lead to siblings, ``down`` to a child; ``parent`` is the node of
    the prefix that is one turn shorter.  Node 0 is the root, the empty row."""

    def __init__(self):
        self.turn, self.words, self.depth, self.parent = [None], [0], [0], [-1]
        self.low, self.down, self.high = [-1], [-1], [-1]

    def insert(self, ids: list[int], words: list[int]) -> int:
        """The node of the whole row; ``words`` has the words of every turn."""
        turn, low, high = self.turn, self.low, self.high
        node = 0
        for want, said in zip(ids, words, strict=True):
            parent, side, place = node, self.down, node
            node = side[place]
            while node >= 0 and turn[node] != want:
                side, place = (low, node) if want < turn[node] else (high, node)
                node = side[place]
            if node < 0:
                node = side[place] = len(turn)
                turn.append(want)
                self.words.append(said)
                self.depth.append(self.depth[parent] + 1)
                self.parent.append(parent)
                for link in (low, self.down, high):
                    link.append(-1)
        return node

    def traverse(self) -> Iterator[int]:
        """The nodes below the root, every node before its children and siblings in order."""
        stack = [(self.down[0], False)]
        while stack:
            node, low_done = stack.pop()
            if node < 0:
                continue
            if low_done:
                yield node
                stack += [(self.high[node], False), (self.down[node], False)]
            else:
                stack += [(node, True), (self.low[node], False)]


def median_order(n: int) -> Iterator[int]:
    """0 to n - 1, the median of every range before its halves."""
    ranges = [(0, n)]
    while ranges:
        a, b = ranges.pop()
        if a < b:
            mid = (a + b) // 2
            yield mid
            ranges += [(mid + 1, b), (a, mid)]


def _clipped(entries: list[tuple[int, int]], n: int) -> list[tuple[int, int]]:
    """The entries up to depth ``n``."""
    out = []
    for depth, owner in entries:
        out.append((min(depth, n), owner))
        if depth >= n:
            break
    return out


def owners(shared: list[int], inner: list[int]) -> list[list[tuple[int, int]]]:
    """``shared[s]``: the turns that the first sequence of shard ``s`` shares
    with the last one of the shard before (-1: there is none), ``inner[s]``:
    those that the shard's first and last sequence share.  Per shard a list
    ``(depth, owner)`` in rising depth: the first shard that has the prefix of
    ``d`` turns of the first sequence is the ``owner`` of the first entry with a
    depth of ``d`` or more; longer prefixes are in no earlier shard."""
    out: list[list[tuple[int, int]]] = []
    for s, n in enumerate(shared):
        # what the last sequence of the shard before shares with its first one may be older
        out.append(_clipped([*_clipped(out[-1], inner[s - 1]), (n, s - 1)], n) if s else [])
    return out


def shard_nodes(ids: list[list[int]], words: list[list[int]], members: list[int], first: list[int],
                shard: int, after: int, owned: list[tuple[int, int]]) -> list[dict]:
    """The nodes of shard number ``shard``, the root first: what of each lies in
    this shard.  The rows of ``ids`` are distinct and in list order, at least one; ``members``
    and ``first`` are the number and the smallest id of their conversations;
    ``after`` is what the last row shares with the next shard's first (-1: no
    such shard), ``owned`` the shard's entry of ``owners``.

    ``owner`` names a node that other shards have too, ``parent_owner`` its
    parent if that is such a node, else ``parent_conv_id`` is the parent's id;
    ``end_id`` is the smallest id of the conversations that end in the node."""
    tree, at = TernaryTree(), [0] * len(ids)
    for k in median_order(len(ids)):
        at[k] = tree.insert(ids[k], words[k])
    n, up, depth, said = len(tree.turn), tree.parent, tree.depth, tree.words
    before = owned[-1][0] if owned else -1
    owner: list[int | None] = [None] * n             # of boundary nodes
    known = [False] * n                              # an earlier shard has the node
    node = at[-1]
    while node >= 0:
        if depth[node] <= after:
            owner[node] = shard
        node = up[node]
    node = at[0]
    while node >= 0:
        if depth[node] <= before:
            owner[node], known[node] = next(o for d, o in owned if d >= depth[node]), True
        node = up[node]
    convs, low, leaves, saved, children, end = [0] * n, [None] * n, [0] * n, [0] * n, [0] * n, [None] * n
    for k, node in enumerate(at):
        convs[node], low[node], end[node] = members[k], first[k], first[k]
        leaves[node] = int(tree.down[node] < 0)
    if after == len(ids[-1]):                        # the last row goes on in the next shard
        leaves[at[-1]] = 0
    order = list(tree.traverse())
    for i in reversed(order):
        saved[i] += said[i] * (convs[i] - (not known[i]))
        p = up[i]
        convs[p] += convs[i]
        leaves[p] += leaves[i]
        saved[p] += saved[i]
        children[p] += not known[i]
        low[p] = low[i] if low[p] is None else min(low[p], low[i])
    return [{"conv_id": low[i], "depth": depth[i], "owner": owner[i],
             "parent_conv_id": None if i == 0 or owner[up[i]] is not None else low[up[i]],
             "parent_owner": owner[up[i]] if i else None, "n_convs": convs[i], "n_children": children[i],
             "n_leaves": leaves[i], "saved_tokens": saved[i], "end_id": end[i]} for i in [0, *order]]


_NODE = ("conv_id bigint, depth bigint, owner int, parent_conv_id bigint, parent_owner int, n_convs bigint, "
         "n_children bigint, n_leaves bigint, saved_tokens bigint, end_id bigint")


def _frozen(df: DataFrame, base: str, name: str) -> DataFrame:
    """The table written to the shared folder and read back."""
    path = checkpoint_path(df.sparkSession, base, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered_turns(conversations: DataFrame, base: str) -> DataFrame:
    """``conv_id, pos, turn_id, n_words``: the turns in order and their dictionary ids."""
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    in_order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    told = F.concat_ws(":", F.octet_length("role").cast("string"), F.concat("role", "text"))
    turns = _frozen(rows.select(
        "conv_id", F.row_number().over(in_order).alias("pos"), F.unhex(F.sha2(told.cast("binary"), 256)).alias("told"),
        F.regexp_count("text", F.lit(WORD)).cast("int").alias("n_words")), base, "turns")
    names = _frozen(turns.select("told").distinct().withColumn("turn_id", F.monotonically_increasing_id()), base, "names")
    return turns.join(names, "told").select("conv_id", "pos", "turn_id", "n_words")


def rebuilt(turns: DataFrame, everyone: DataFrame, family: int = 20, shared: int = 4) -> DataFrame:
    """Every conversation ``c`` of ``everyone(conv_id)`` rebuilt: the first ``h``
    turns of conversation ``c - c % family``, then its own after its first
    ``h``, with ``h = crc32(c) % shared``.  ``conv_id, ids, words`` (lists)."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared).cast("int")
    own = turns.where(F.col("pos") > h)
    source = turns.where((F.col("conv_id") % family == 0) & (F.col("pos") < shared)).withColumnRenamed("conv_id", "source")
    takers = everyone.select("conv_id", (F.col("conv_id") - F.col("conv_id") % family).alias("source"), h.alias("h"))
    begin = takers.join(source, "source").where("pos <= h").select(*turns.columns)
    nothing = everyone.select("conv_id", *[F.lit(None).cast(turns.schema[c].dataType).alias(c) for c in turns.columns[1:]])
    turn = F.when(F.col("pos").isNotNull(), F.struct("pos", "turn_id", "n_words"))
    lists = own.unionByName(begin).unionByName(nothing).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(turn)).alias("turns"))
    return lists.select("conv_id", F.col("turns.turn_id").alias("ids"), F.col("turns.n_words").alias("words"))


def _digest_ends(convs: DataFrame) -> DataFrame:
    """``end_id, ends_sha256`` per distinct sequence: its smallest conversation id
    and the digest of all of them in order.  Ids are joined to texts block by
    block; a task streams over the blocks of its sequences."""
    blocks = convs.groupBy("sequence", F.shiftright("conv_id", END_BLOCK.bit_length() - 1).alias("block")).agg(
        F.array_sort(F.collect_list("conv_id")).alias("members"))
    blocks = blocks.select("sequence", "block", F.col("members")[0].alias("end_id"),
                           F.array_join(F.col("members").cast("array<string>"), ",").alias("told"))

    def digest(batches):
        now, end_id, state = None, None, None
        for b in batches:
            ids, digests = [], []
            for row in b.to_pylist():
                if row["sequence"] == now:
                    state.update(b"," + row["told"].encode())
                    continue
                if now is not None:
                    ids.append(end_id)
                    digests.append(state.hexdigest())
                now, end_id, state = row["sequence"], row["end_id"], hashlib.sha256(row["told"].encode())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(digests, pa.string())],
                                             ["end_id", "ends_sha256"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([end_id], pa.int64()), pa.array([state.hexdigest()])],
                                             ["end_id", "ends_sha256"])

    return (blocks.repartition("sequence").sortWithinPartitions("sequence", "block")
            .mapInArrow(digest, "end_id bigint, ends_sha256 string"))


def _common(a: str, b: str) -> Column:
    """How many leading elements two lists share (-1: the first is null)."""
    differ = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    return (F.when(F.col(a).isNull(), -1).when(differ == 0, F.size(a)).otherwise(differ - 1)).cast("int")


def trie_of(convs: DataFrame, base: str, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The trie over ``convs(conv_id, ids, words)``, one row per node; see
    ``conversation_trie``.  ``base`` names the folder of its tables."""
    spark = convs.sparkSession
    convs = _frozen(convs.withColumn("sequence", F.unhex(F.sha2(F.array_join("ids", ",").cast("binary"), 256))),
                    base, "conversations")
    rows = convs.groupBy("sequence").agg(F.any_value("ids").alias("ids"), F.any_value("words").alias("words"),
                                         F.count("*").alias("members"), F.min("conv_id").alias("first"))
    turns = rows.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0))).first()[0]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // shard_turns))
    rows = _frozen(rows.drop("sequence").repartitionByRange(parts, "ids")
                   .withColumn("part", F.spark_partition_id()), base, "sequences")

    # what neighbouring shards share: two numbers per shard reach the driver
    edges = rows.groupBy("part").agg(F.min("ids").alias("a"), F.max("ids").alias("b"))
    edges = edges.withColumn("z", F.lag("b").over(Window.orderBy("part")))
    edges = edges.select("part", _common("z", "a").alias("shared"), _common("a", "b").alias("inner")).orderBy("part").collect()
    owned = owners([e.shared for e in edges], [e.inner for e in edges])
    known = spark.sparkContext.broadcast({
        e.part: (s, edges[s + 1].shared if s + 1 < len(edges) else -1, owned[s]) for s, e in enumerate(edges)})

    def nodes_of(table):
        found = sorted(table.select(["ids", "words", "members", "first"]).to_pylist(), key=lambda r: r["ids"])
        columns = [[r[c] for r in found] for c in ("ids", "words", "members", "first")]
        nodes = shard_nodes(*columns, *known.value[table.column("part")[0].as_py()])
        return pa.Table.from_pylist(nodes, pa.schema([
            (f.split(" ")[0], pa.int32() if f.endswith(" int") else pa.int64()) for f in _NODE.split(", ")]))

    nodes = _frozen(rows.groupBy("part").applyInArrow(nodes_of, _NODE), base, "nodes")
    boundary = nodes.where("owner is not null").groupBy("owner", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.max("parent_conv_id").alias("parent_conv_id"),
        F.max("parent_owner").alias("parent_owner"),
        *[F.sum(c).cast("long").alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("end_id").alias("end_id"))
    whole = nodes.where("owner is null").unionByName(boundary)
    # ids of parents that several shards have
    above = boundary.select(F.col("owner").alias("parent_owner"), (F.col("depth") + 1).alias("depth"),
                            F.col("conv_id").alias("_parent"))
    whole = whole.where("parent_owner is null").unionByName(
        whole.where("parent_owner is not null").join(above, ["parent_owner", "depth"])
        .withColumn("parent_conv_id", F.col("_parent")).select(*whole.columns))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    none = hashlib.sha256(b"").hexdigest()
    return whole.where("end_id is null").select(*columns, F.lit(none).alias("ends_sha256")).unionByName(
        whole.where("end_id is not null").join(_digest_ends(convs), "end_id").select(*columns, "ends_sha256"))


def conversation_trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the prefix trie of the rebuilt conversations (see
    ``rebuilt``): ``conv_id`` (smallest member), ``depth, parent_conv_id``
    (root: null), ``n_convs, n_children, n_leaves, saved_tokens`` (long) and
    ``ends_sha256``, the digest of the comma-joined ids, in rising order, of the
    conversations that end in the node.

    ``conversations(conv_id, turn, role, text)``; a conversation is ordered by
    turn, null first; equal turn numbers are ordered by role and text.  Null
    role or text is empty, and equal turns are equal in both.  Rows without
    ``conv_id`` belong to no conversation.  Conversations without turns are
    members of the root.  Other columns are ignored; an empty table gives an
    empty result.

    A conversation's turn ids (not its texts) are one list, so the longest
    conversation must fit a task; no group holds the conversations of a turn, a
    prefix or a sequence."""
    base = f"turn-tries-{uuid.uuid4().hex}"
    turns = _frozen(numbered_turns(conversations, base), base, "numbered")
    return trie_of(rebuilt(turns, turns.select("conv_id").distinct()), base, shard_turns)
