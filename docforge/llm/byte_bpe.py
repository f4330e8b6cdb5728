"""Byte-level BPE encoding by overlapping chunks, and decoding.

A long text is cut into chunks that overlap their successors.  Every chunk is
pre-tokenised for itself, in parallel.  A match of the pattern depends only on
the text from its start to a few characters past its end, so two passes over
the same text agree from the first boundary they share: there a chunk hands
over to its successor.  A chunk therefore also walks the first characters of
the successor, which lie in its own overlap, and encodes its pieces up to the
boundary where the two walks meet; the successor's tokens before that boundary
are dropped when the chunks of a text are put together.  Where the walks do
not meet within the overlap (a piece longer than it), the text is walked on
from the last sure boundary when the chunks are put together, until it meets
the successor's boundaries.

Tokens are stored as little-endian unsigned 32-bit integers in one binary
value; decoding concatenates the bytes of the tokens.
"""

from __future__ import annotations

import base64
import re
import struct
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow_batches import binary_offsets, slices

DEFAULT_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# fixed value: the published pattern that splits text before the merges
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LOOK_AHEAD = 3          # characters past its end that a match of the pattern may depend on, and one
CHUNK_CHARS, OVERLAP_CHARS = 1 << 15, 1 << 10
CACHE_PIECES = 1 << 17  # distinct short pieces a worker remembers; more are encoded again
SLICE_BYTES = 1 << 20


def char_ranges(chars) -> str:
    """The characters as ranges inside a character class."""
    out: list[list[int]] = []
    for c in sorted(map(ord, set(chars))):
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out)


def every_character() -> str:
    return "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))


def character_classes() -> tuple[dict[str, str], str]:
    """The members of the classes of the pattern as the encoding library sees
    them, and the characters that ``regex`` puts into another class (its Unicode
    tables are of another version)."""
    every = every_character()
    single = {bytes([i]): i for i in range(256)}
    classes, rare = {}, set()
    for name in (r"\s", r"\p{L}", r"\p{N}"):
        matcher = tiktoken.Encoding(name, pat_str=name, mergeable_ranks=single, special_tokens={})
        members = bytes(matcher.encode_ordinary(every)).decode()
        rare |= set(members) ^ set(regex.findall(name, every))
        classes[name] = char_ranges(members)
    return classes, char_ranges(rare)


def explicit_pattern(pattern: str, classes: dict[str, str]) -> str:
    """The pattern with every class spelled out."""
    out, inside, i = [], False, 0
    while i < len(pattern):
        name = next((n for n in (*classes, r"\S") if pattern.startswith(n, i)), None)
        if name == r"\S":
            out.append(f"[^{classes[chr(92) + 's']}]")
        elif name:
            out.append(classes[name] if inside else f"[{classes[name]}]")
        else:
            inside = pattern[i] == "[" or inside and pattern[i] != "]"
            out.append(pattern[i])
        i += len(name or " ")
    return "".join(out)


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes and ids of a rank file."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}


class Encoder:
    """Pre-tokeniser and merges by rank, with a bounded memory of pieces.
    ``table``: token bytes and ids; ``classes``, ``rare``: see ``character_classes``."""

    def __init__(self, table: dict[bytes, int], pattern: str, classes: dict[str, str], rare: str):
        self._merges = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self._usual = regex.compile(pattern)
        self._rare = re.compile(f"[{rare}]") if rare else None
        self._explicit = re.compile(explicit_pattern(pattern, classes))
        self._known: dict[str, bytes] = {}
        by_id = [b""] * (max(table.values(), default=-1) + 1)
        for token, rank in table.items():
            by_id[rank] = token
        self.tokens = pa.array(by_id, pa.large_binary())

    def _pattern(self, text: str):
        odd = self._rare is not None and not text.isascii() and self._rare.search(text)
        return self._explicit if odd else self._usual

    def pieces(self, text: str) -> list[str]:
        """The pre-tokens of a text."""
        return self._pattern(text).findall(text)

    def ends(self, text: str) -> list[int]:
        """Where the pre-tokens of a text end."""
        return [m.end() for m in self._pattern(text).finditer(text)]

    def _learn(self, piece: str) -> bytes:
        ids = self._merges._encode_single_piece(piece)
        ids = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= 64:
            if len(self._known) >= CACHE_PIECES:
                self._known.clear()
            self._known[piece] = ids
        return ids

    def forget(self) -> None:
        """Empties the memory of pieces."""
        self._known.clear()

    def encode(self, pieces: list[str]) -> list[bytes]:
        """The ids of every piece, as bytes."""
        known = self._known.get
        return [known(p) or self._learn(p) for p in pieces]

    def decode(self, ids: pa.Array) -> pa.Array:
        """The bytes of rows of ids: the bytes of their tokens, joined."""
        raw, offsets = binary_offsets(ids)
        spelled, at = binary_offsets(self.tokens.take(pa.array(raw.view("<u4"))))
        return pa.Array.from_buffers(pa.large_binary(), len(ids), [
            None, pa.py_buffer(np.ascontiguousarray(at[offsets // 4])), pa.py_buffer(np.ascontiguousarray(spelled))])


def meeting(ends: list[int], others: list[int], length: int) -> int | None:
    """The first boundary that two walks over a text of ``length`` characters
    share and that no text behind it can move."""
    sure = length - LOOK_AHEAD
    return min((e for e in set(ends).intersection(others) if e <= sure), default=None)


def _between(text: str, ends: list[int]) -> list[str]:
    """The pieces of a text that end there."""
    return [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def chunk_tokens(encoder: Encoder, text: str, chunk_chars: int, last: bool) -> dict:
    """Of a chunk (``chunk_chars`` characters and the overlap): ``cut``, the
    boundary in the overlap at which the successor takes over (null: none was
    found); ``ids`` of the pieces up to there; ``ends`` and ``counts`` of the
    pieces, by which a predecessor's cut is found."""
    ends = encoder.ends(text)
    if last:
        cut = len(text)
    else:
        successor = [0, *encoder.ends(text[chunk_chars:])]
        cut = meeting(ends, [chunk_chars + e for e in successor], len(text))
    own = [e for e in ends if e <= (chunk_chars if cut is None else cut)]
    ids = encoder.encode(_between(text, own))
    return {"cut": cut, "ids": b"".join(ids), "ends": np.array(own, "<i4").tobytes(),
            "counts": np.array([len(i) >> 2 for i in ids], "<i4").tobytes()}


def _walk_on(encoder: Encoder, chunks: list[dict], k: int, at: int, chunk_chars: int) -> tuple[list[bytes], int, int]:
    """From the sure boundary ``at`` in chunk ``k``, whose walk and its
    successor's did not meet: the ids up to a boundary of a later chunk, that
    chunk and the boundary.  Twice as many chunks are joined on at each try, so
    the work stays in proportion to the text."""
    text, joined, more = chunks[k]["text"][at - k * chunk_chars:], k + 1, 1
    while True:
        stop = min(joined + more, len(chunks))
        text = text[:joined * chunk_chars - at] + "".join(
            [c["text"][:chunk_chars] for c in chunks[joined:stop - 1]] + [chunks[stop - 1]["text"]])
        ends = encoder.ends(text)
        for m in range(k + 1, stop):
            start = m * chunk_chars - at
            met = meeting([e for e in ends if e > start],
                          (start + np.frombuffer(chunks[m]["ends"], "<i4")).tolist(), len(text))
            if met is not None:
                return encoder.encode(_between(text, [e for e in ends if e <= met])), m, at + met
        if stop == len(chunks):
            return encoder.encode(_between(text, ends)), stop, at + len(text)
        joined, more = stop, 2 * more


def stitch(encoder: Encoder, chunks: list[dict], chunk_chars: int) -> bytes:
    """The ids of a text from its chunks in order (``text`` and what
    ``chunk_tokens`` found)."""
    out, at, k = [], 0, 0                            # ``at``: where the encoded part of the text ends
    while k < len(chunks):
        c, base = chunks[k], k * chunk_chars
        ends, counts = np.frombuffer(c["ends"], "<i4"), np.frombuffer(c["counts"], "<i4")
        done = int(np.searchsorted(ends, at - base, side="right"))
        out.append(c["ids"][4 * int(counts[:done].sum()):])
        at = max(at, base + int(ends[-1])) if len(ends) else at
        if c["cut"] is not None:
            k += 1
        else:
            ids, k, at = _walk_on(encoder, chunks, k, at, chunk_chars)
            out += ids
    return b"".join(out)


_ENCODERS: dict[int, Encoder] = {}


def _encoder(model: tuple) -> Encoder:
    """The encoder of a worker process, built once."""
    key = xxhash.xxh64_intdigest(repr(model[1:]).encode(), seed=xxhash.xxh64_intdigest(model[0]))
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(read_ranks(model[0]), *model[1:])
    return _ENCODERS[key]


def _share_model(spark, ranks_path: str, pattern: str):
    """The rank file (under a megabyte), the pattern and its classes, for all tasks."""
    with open(ranks_path, "rb") as f:
        return spark.sparkContext.broadcast((f.read(), pattern, *character_classes()))


def _cut(batches, chunk_chars: int, overlap: int) -> Iterator[pa.RecordBatch]:
    """Chunks of long texts, with a key of the row that a rerun of the task gives again."""
    part, seen = TaskContext.get().partitionId(), Counter()
    for batch in batches:
        for one in range(len(batch)):
            row = batch.slice(one, 1)
            text = row.column(1)[0].as_py()
            told = xxhash.xxh3_128_hexdigest(repr(row.column(0)[0].as_py()) + "/" + text)
            key = f"{part}/{told}/{seen[told]}"
            seen[told] += 1
            places = range(0, max(1, len(text) - overlap), chunk_chars)
            for first in range(0, len(places), 64):
                some = places[first:first + 64]
                yield pa.RecordBatch.from_arrays([
                    pa.array([key] * len(some)), pa.concat_arrays([row.column(0)] * len(some)),
                    pa.array([p // chunk_chars for p in some], pa.int32()),
                    pa.array([p == places[-1] for p in some]),
                    pa.array([text[p:] if p == places[-1] else text[p:p + chunk_chars + overlap] for p in some])],
                    ["row_key", "id", "chunk", "last", "text"])


def encode_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", out_col: str = "token_ids",
                 ranks_path: str = DEFAULT_RANKS, pattern: str = PATTERN, decoded_col: str | None = None,
                 chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """One row per document: ``id_col`` and ``out_col``, the ids of the whole
    text as little-endian unsigned 32-bit integers (binary), without special
    tokens; ``decoded_col`` names a further column with the bytes that the ids
    spell (binary).

    Texts of up to ``chunk_chars`` and ``overlap_chars`` characters are one
    chunk and are encoded where they are read; only chunks of longer texts are
    shuffled.  The driver reads ``ranks_path`` and hands it to the tasks.  A
    pattern whose matches depend on more than the ``LOOK_AHEAD`` characters past
    their end is not supported.  Null text is an empty text and has no tokens;
    null and repeated ids keep a row each.  Other columns are ignored.  An empty
    table gives an empty result."""
    if not 2 * LOOK_AHEAD < overlap_chars <= chunk_chars:
        raise ValueError("the overlap is larger than twice the look-ahead and no longer than a chunk")
    model = _share_model(docs.sparkSession, ranks_path, pattern)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    fits = F.length("text") <= chunk_chars + overlap_chars
    result = f"id {id_type}, ids binary" + (", decoded binary" if decoded_col else "")
    names = ["id", "ids"] + (["decoded"] if decoded_col else [])

    def made(encoder, ids_column, ids):
        ids = pa.array(ids, pa.binary())
        more = [encoder.decode(ids).cast(pa.binary())] if decoded_col else []
        return pa.RecordBatch.from_arrays([ids_column, ids, *more], names)

    def whole(batches):
        encoder = _encoder(model.value)
        for b in slices(batches, "text", SLICE_BYTES):
            texts = b.column(1).to_pylist()
            yield made(encoder, b.column(0), [b"".join(encoder.encode(encoder.pieces(t))) for t in texts])

    def cut(batches):
        yield from _cut(batches, chunk_chars, overlap_chars)

    def chunked(batches):
        encoder = _encoder(model.value)
        for b in slices(batches, "text", SLICE_BYTES):
            texts, last = b.column(4).to_pylist(), b.column(3).to_pylist()
            found = [chunk_tokens(encoder, t, chunk_chars, end) for t, end in zip(texts, last, strict=True)]
            new = pa.RecordBatch.from_pylist(found, pa.schema([("cut", pa.int32()), ("ids", pa.binary()),
                                                               ("ends", pa.binary()), ("counts", pa.binary())]))
            yield pa.RecordBatch.from_arrays([*b.columns, *new.columns], [*b.schema.names, *new.schema.names])

    def put_together(table):
        encoder = _encoder(model.value)
        chunks = sorted(table.to_pylist(), key=lambda c: c["chunk"])
        batch = made(encoder, table.column("id").slice(0, 1).combine_chunks(), [stitch(encoder, chunks, chunk_chars)])
        return pa.Table.from_batches([batch])

    chunk_row = f"row_key string, id {id_type}, chunk int, last boolean, text string"
    found = (rows.where(~fits).mapInArrow(cut, chunk_row).repartition("row_key", "chunk")
             .mapInArrow(chunked, chunk_row + ", cut int, ids binary, ends binary, counts binary"))
    out = rows.where(fits).mapInArrow(whole, result).unionByName(
        found.groupBy("row_key").applyInArrow(put_together, result))
    return out.toDF(id_col, out_col, *([decoded_col] if decoded_col else []))


def decode_bytes(coded: DataFrame, ids_col: str = "token_ids", out_col: str = "decoded",
                 ranks_path: str = DEFAULT_RANKS, pattern: str = PATTERN) -> DataFrame:
    """``coded`` with ``out_col``, the bytes that the ids of ``ids_col`` spell
    (null or no ids: no bytes).  All other columns stay; one named ``out_col``
    is replaced.  An empty table gives an empty result."""
    model = _share_model(coded.sparkSession, ranks_path, pattern)
    rows = coded.drop(out_col)
    schema = rows.withColumn(out_col, F.lit(None).cast("binary")).schema

    def run(batches):
        encoder = _encoder(model.value)
        for b in slices(batches, ids_col, SLICE_BYTES):
            ids = b.column(b.schema.names.index(ids_col))
            yield pa.RecordBatch.from_arrays([*b.columns, encoder.decode(ids).cast(pa.binary())],
                                             [*b.schema.names, out_col])

    return rows.mapInArrow(run, schema)
