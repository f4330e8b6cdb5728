"""SentencePiece encoding by forward-filtering backward-sampling, and decoding.

The pieces of a text form a lattice: nodes are byte positions, edges are
vocabulary pieces (or single bytes of characters outside the vocabulary).  The
forward filter gives every node the weight of all paths to it; walking back
from the end, each incoming edge is drawn in proportion to its share.  The
draws come from a hash of the row key and the byte position, so a row has the
same segmentation in every run, partitioning and batch.

No piece holds a blank after another character, so every path passes the node
before such a blank: the lattice factorises there without approximation, and
the forward filter runs once per distinct chunk of a slice of texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow_batches import binary_offsets, free_name, slices

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SLICE_BYTES = 1 << 20
_SHIFT, _SLOTS = np.uint64(48), 1 << 16  # slots of the lookup tables, by the top bits of a hash
_P = np.uint64(0x100000001B3)
_BASE = 0x9E3779B97F4A7C15
_NEVER = -(1 << 40)        # the power of a node that no path reaches


def spellings(model_bytes: bytes) -> tuple[list[bytes], list[int], int]:
    """The bytes of every piece, the ids of ordinary pieces, the id of byte 0."""
    sp = sentencepiece.SentencePieceProcessor(model_proto=model_bytes)
    size = sp.get_piece_size()
    pieces, ordinary = [b""] * size, []
    for i in range(size):
        if sp.is_byte(i):
            pieces[i] = bytes([int(sp.id_to_piece(i)[3:5], 16)])
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            pieces[i] = sp.id_to_piece(i).replace("▁", " ").encode()
            ordinary.append(i)
    return pieces, ordinary, sp.piece_to_id("<0x00>")


class PieceModel:
    """Pieces of a SentencePiece model as bytes (the blank sign as a blank) and
    the tables by which substrings are looked up.

    The weight of a piece is ``(rank + 10) ** -alpha`` with ``rank`` its place
    among the ordinary pieces; a byte piece weighs ``byte_weight``."""

    def __init__(self, model_bytes: bytes, alpha: float = 1.0, byte_weight: float = 1e-6):
        self.pieces, ordinary, self.first_byte = spellings(model_bytes)
        size = len(self.pieces)
        if any(b" " in p.lstrip(b" ") for p in map(self.pieces.__getitem__, ordinary)):
            raise ValueError("a piece holds a blank after another character")
        self.weight = np.zeros(size + 1)
        self.weight[ordinary] = (np.arange(len(ordinary)) + 10.0) ** -alpha
        self.byte_ids = self.first_byte + np.arange(256)
        self.weight[self.byte_ids] = byte_weight
        by_length: dict[int, list[int]] = {}
        for i in ordinary:
            by_length.setdefault(len(self.pieces[i]), []).append(i)
        self.longest = max(by_length)
        self.tables, self.leads_on = {}, {}
        for n in range(1, self.longest):             # strings of n bytes that begin a longer piece
            begins = sorted({self.pieces[i][:n] for i in ordinary if len(self.pieces[i]) > n})
            h = self.hashes(np.frombuffer(b"".join(begins), np.uint8), n)[::n]
            self.leads_on[n] = np.zeros(_SLOTS, bool)
            self.leads_on[n][(h >> _SHIFT).astype(np.int64)] = True
        for n, ids in sorted(by_length.items()):
            raw = np.frombuffer(b"".join(self.pieces[i] for i in ids), np.uint8)
            h = self.hashes(raw, n)[::n]
            # open slots by the top bits; pieces that meet there go to the next layer
            layers, rest, place = [], np.arange(len(ids)), (h >> _SHIFT).astype(np.int64)
            while len(rest):
                layer = np.full(_SLOTS, -1, np.int32)
                layer[place[rest]] = rest
                layers.append(layer)
                rest = rest[layer[place[rest]] != rest]
            self.tables[n] = (h, np.asarray(ids, np.int32), layers)

    @property
    def spelled(self) -> pa.Array:
        return pa.array(self.pieces, pa.large_binary())

    @staticmethod
    def hashes(raw: np.ndarray, n: int) -> np.ndarray:
        """A 64-bit hash of the ``n`` bytes from every position that has them."""
        if len(raw) < n:
            return np.zeros(0, np.uint64)
        h = np.zeros(len(raw) - n + 1, np.uint64)
        for k in range(n):
            h = h * _P + raw[k:k + len(h)] + np.uint64(1)
        return PieceModel._finish(h)

    @staticmethod
    def _finish(h: np.ndarray) -> np.ndarray:
        h = (h ^ (h >> np.uint64(29))) * np.uint64(_BASE)
        return h ^ (h >> np.uint64(32)) * np.uint64(0xBF58476D1CE4E5B9)


def _edges(model: PieceModel, raw: np.ndarray, offsets: np.ndarray):
    """All lattice edges of the chunks in a byte array, by end node: ``(end
    node, start node, length, piece)``.  A chunk of ``n`` bytes has ``n + 1``
    nodes, so the node at a byte is its position plus the chunk's number."""
    n = len(raw)
    chunk = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    left = (offsets[1:].astype(np.int32)[chunk] - np.arange(n, dtype=np.int32))
    starts, sizes, pieces = [], [], []
    lead = (raw & 0xC0) != 0x80                      # where a character begins
    begins = np.flatnonzero(lead)
    width = np.ones(n, np.int32)
    width[begins] = np.diff(np.append(begins, n))
    spelled = lead.copy()                            # characters that are no piece are spelled in bytes
    at, h = np.arange(n, dtype=np.int32), np.zeros(n, np.uint64)
    for size in range(1, model.longest + 1):
        on = left[at] >= size
        if size > 1:
            on &= model.leads_on[size - 1][(fin >> _SHIFT).astype(np.int32)]  # noqa: F821
        at, h = at[on], h[on]
        if not len(at):
            break
        h = h * _P + raw[at + (size - 1)] + np.uint64(1)
        fin = PieceModel._finish(h)
        if size in model.tables:
            keys, ids, layers = model.tables[size]
            place = (fin >> _SHIFT).astype(np.int32)
            for layer in layers:
                slot = layer[place]
                hit = np.flatnonzero((slot >= 0) & (keys[slot] == fin))
                found, slot = at[hit], slot[hit]
                starts.append(found)
                sizes.append(np.full(len(found), size, np.int32))
                pieces.append(ids[slot])
                spelled[found[width[found] == size]] = False
    spelled = spelled[np.maximum.accumulate(np.where(lead, np.arange(n), 0))]
    found = np.flatnonzero(spelled).astype(np.int32)
    starts.append(found)
    sizes.append(np.ones(len(found), np.int32))
    pieces.append(model.byte_ids[raw[found]].astype(np.int32))
    start, size, piece = (np.concatenate(x) for x in (starts, sizes, pieces))
    node_start = start + chunk[start]
    node_end = node_start + size
    order = np.argsort(node_end, kind="stable")
    return node_end[order], node_start[order], size[order], piece[order]


def forward_filter(model: PieceModel, raw: np.ndarray, offsets: np.ndarray):
    """``(first edge per node, edge start node, length, piece, cumulated share)``."""
    node_end, node_start, size, piece = _edges(model, raw, offsets)
    count = len(offsets) - 1
    nodes = len(raw) + count
    first = np.concatenate([[0], np.cumsum(np.bincount(node_end, minlength=nodes))]).astype(np.int32)
    weight = model.weight[piece] * 3.0 ** size      # the same factor on every path of a chunk
    sizes = np.diff(offsets)
    roots = offsets[:-1] + np.arange(count)
    # the weight of a node is alpha * 2 ** power: scaling by powers of two is exact, and no text is too long for it
    alpha, power = np.zeros(nodes), np.full(nodes, _NEVER, np.int64)
    alpha[roots], power[roots] = 1.0, 0
    share = np.zeros(len(piece))
    # edges by their end's distance from the chunk's start, then by node
    depth = node_end - np.repeat(roots, sizes + 1)[node_end]
    depth = depth.astype(np.uint16 if len(depth) == 0 or depth.max() < 1 << 16 else np.int64)
    order = np.argsort(depth, kind="stable")
    level = np.searchsorted(depth[order], np.arange(1, (int(sizes.max()) if count else 0) + 2))
    for t in range(1, len(level)):
        e = order[level[t - 1]:level[t]]
        if not len(e):
            continue
        end = node_end[e]
        new = np.ones(len(e), bool)
        new[1:] = end[1:] != end[:-1]
        heads = np.flatnonzero(new)
        scale = power[node_start[e]]
        highest, in_node = np.maximum.reduceat(scale, heads), np.diff(np.append(heads, len(e)))
        part = np.ldexp(alpha[node_start[e]] * weight[e],
                        np.maximum(scale - np.repeat(highest, in_node), -2000).astype(np.int32))
        # running sums edge by edge, so that a node's shares do not depend on what else is in the slice
        total = np.zeros(len(heads))
        on, k = np.arange(len(heads)), 0
        while len(on):
            total[on] += part[heads[on] + k]
            part[heads[on] + k] = total[on]
            k += 1
            on = on[in_node[on] > k]
        alpha[end[heads]], shift = np.frexp(total)
        power[end[heads]] = np.where(total > 0, highest + shift, _NEVER)
        with np.errstate(invalid="ignore", divide="ignore"):
            share[e] = np.nan_to_num(part / np.repeat(total, in_node))   # nodes that no path reaches
    return first, node_start, size, piece, share


def _uniform(key: np.ndarray, position: np.ndarray) -> np.ndarray:
    z = key + (position.astype(np.uint64) + np.uint64(1)) * np.uint64(_BASE)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) * 2.0 ** -53


def encode_slice(model: PieceModel, raw: np.ndarray, offsets: np.ndarray, keys: np.ndarray):
    """Sampled pieces of every text: ``(ids, offsets into ids)``.  Texts that
    are not empty are encoded with one blank before them.  A text much longer
    than a slice is encoded part by part, cut where its lattice factorises."""
    if len(offsets) == 2 and len(raw) > 2 * SLICE_BYTES:
        cuts, ids = [0], []
        while len(raw) - cuts[-1] > 2 * SLICE_BYTES:
            part = raw[cuts[-1] + SLICE_BYTES:]
            free = np.flatnonzero((part[1:] == 10) | (part[:-1] == 10) | ((part[1:] == 32) & (part[:-1] != 32)))
            if not len(free):
                break
            cuts.append(cuts[-1] + SLICE_BYTES + int(free[0]) + 1)
        for a, b in zip(cuts, [*cuts[1:], len(raw)], strict=True):
            ids.append(_encode(model, raw[a:b], np.array([0, b - a]), keys, a, a == 0)[0])
        ids = np.concatenate(ids)
        return ids, np.array([0, len(ids)])
    return _encode(model, raw, offsets, keys, 0, True)


def _encode(model: PieceModel, raw: np.ndarray, offsets: np.ndarray, keys: np.ndarray, at_byte: int, blank: bool):
    """``encode_slice`` of texts that begin at a byte of theirs, with a blank before them or not."""
    sizes = np.diff(offsets)
    full = (sizes > 0) & blank
    padded = np.insert(raw, offsets[:-1][full], 32) if blank else raw
    offsets = np.concatenate([[0], np.cumsum(sizes + full)])
    if not len(padded):
        return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
    cut = np.zeros(len(padded), bool)
    cut[1:] = (padded[1:] == 32) & (padded[:-1] != 32)
    cut[1:] |= (padded[:-1] == 10) | (padded[1:] == 10)   # no piece holds a line feed
    cut[offsets[:-1][sizes > 0]] = True
    begin = np.flatnonzero(cut)
    bounds = np.append(begin, len(padded))
    chunks = pa.Array.from_buffers(pa.large_binary(), len(begin),
                                   [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(padded)])
    coded = chunks.dictionary_encode()
    distinct, at = binary_offsets(coded.dictionary)
    which = coded.indices.to_numpy()
    first, start_of, size, piece, share = forward_filter(model, distinct, at)
    by_chunk = np.argsort(which, kind="stable")     # equal chunks together: near in memory
    which = which[by_chunk]
    row = np.searchsorted(offsets, begin, side="right")[by_chunk] - 1
    out = np.full(len(padded), -1, np.int32)
    end, key, base = bounds[1:][by_chunk], keys[row], offsets[row] - at_byte - (not blank)
    node = at[which + 1] + which
    root = at[which] + which
    while len(end):
        u = _uniform(key, end - base)
        e = first[node]
        last = first[node + 1] - 1
        open_ = np.flatnonzero((e < last) & (share[e] <= u))
        while len(open_):
            e[open_] += 1
            open_ = open_[(e[open_] < last[open_]) & (share[e[open_]] <= u[open_])]
        out[end - 1] = piece[e]
        end, node = end - size[e], start_of[e]
        more = node != root
        end, node, root, key, base = end[more], node[more], root[more], key[more], base[more]
    there = out >= 0
    seen = np.concatenate([[0], np.cumsum(there)])
    return out[there], seen[offsets]


def decode_slice(spelled: pa.Array, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The texts of encoded rows, given the bytes of every piece; byte pieces
    are joined, the first blank goes."""
    flat, at = binary_offsets(spelled.take(pa.array(ids)))
    begin, stop = at[offsets[:-1]], at[offsets[1:]]
    begin = begin + (stop > begin)
    raw = flat.tobytes()
    return pa.array([raw[a:b].decode("utf-8", "replace") for a, b in zip(begin.tolist(), stop.tolist(), strict=True)],
                    pa.string())


def _load(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


_MODELS: dict[tuple, PieceModel] = {}


def _model(data: bytes, alpha: float) -> PieceModel:
    """The model of a worker process, built once."""
    key = (xxhash.xxh64_intdigest(data), alpha)
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = PieceModel(data, alpha)
    return _MODELS[key]


def encode_sampled(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", out_col: str = "piece_ids",
                   model_path: str = DEFAULT_MODEL, alpha: float = 1.0, seed: int = 0,
                   decoded_col: str | None = None) -> DataFrame:
    """``docs`` with ``out_col`` (array of piece ids), a sampled segmentation of
    the whole text seeded by ``seed`` and the row's id; ``decoded_col`` names a
    further column with the text that the pieces spell, decoded in the same task.

    The driver reads the model from ``model_path`` and hands it to the tasks (a
    vocabulary file, about half a megabyte).  Null or empty text: no pieces;
    null ids count as the key ``null``; rows of equal id and text have equal
    pieces.  All other columns stay; one named ``out_col`` is replaced.  An
    empty table gives an empty result."""
    data = docs.sparkSession.sparkContext.broadcast(_load(model_path))
    rows = docs.drop(out_col, *([decoded_col] if decoded_col else []))
    key = free_name(rows, "_row_key")
    rows = rows.withColumn(key, F.xxhash64(F.lit(f"{seed}/"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))
    made = rows.drop(key).withColumn(out_col, F.lit(None).cast("array<int>"))
    schema = (made.withColumn(decoded_col, F.lit(None).cast("string")) if decoded_col else made).schema
    new = [out_col, decoded_col] if decoded_col else [out_col]

    def run(batches):
        model = _model(data.value, alpha)
        spelled = model.spelled if decoded_col else None
        for b in slices(batches, text_col, SLICE_BYTES):
            names = b.schema.names
            raw, offsets = binary_offsets(b.column(names.index(text_col)))
            keys = b.column(names.index(key)).to_numpy(zero_copy_only=False).view(np.uint64)
            ids, at = encode_slice(model, raw, offsets, keys)
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))
            keep = [i for i, c in enumerate(names) if c != key]
            made = [lists, decode_slice(spelled, ids, at)] if decoded_col else [lists]
            yield pa.RecordBatch.from_arrays([b.column(i) for i in keep] + made, [names[i] for i in keep] + new)

    return rows.mapInArrow(run, schema)


def decode_pieces(coded: DataFrame, ids_col: str = "piece_ids", out_col: str = "decoded",
                  model_path: str = DEFAULT_MODEL) -> DataFrame:
    """``coded`` with ``out_col``, the text its pieces spell (no pieces or null:
    empty text).  Decoding what ``encode_sampled`` made gives the text back.
    All other columns stay; an empty table gives an empty result."""
    data = coded.sparkSession.sparkContext.broadcast(_load(model_path))
    rows = coded.drop(out_col)
    schema = rows.withColumn(out_col, F.lit(None).cast("string")).schema

    def run(batches):
        spelled = pa.array(spellings(data.value)[0], pa.large_binary())
        for b in batches:
            for cut in range(0, len(b), 512):
                part = b.slice(cut, 512)
                lists = part.column(part.schema.names.index(ids_col)).fill_null([])
                counts = lists.value_lengths().to_numpy(zero_copy_only=False)
                text = decode_slice(spelled, lists.flatten().to_numpy(zero_copy_only=False),
                                    np.concatenate([[0], np.cumsum(counts)]))
                yield pa.RecordBatch.from_arrays([*part.columns, text], [*part.schema.names, out_col])

    return rows.mapInArrow(run, schema)
