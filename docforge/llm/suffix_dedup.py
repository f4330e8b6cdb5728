"""Exact removal of repeated byte strings with a distributed sparse suffix array.

A string of ``length`` bytes starts in two documents exactly if both hold the
same suffix start there.  Sorting every suffix of a large corpus would move its
text many times over, so suffixes are sampled by content: in every window of
``length`` bytes the ``GRAM``-byte string with the smallest hash is the
window's anchor.  Equal windows have equal anchors at equal offsets, so no
match is lost, and the anchors are about one position in eighteen.

The documents are dealt into slices of some megabytes and stay there.  Every slice
sends a message to nearly every bucket, so slices and buckets grow with the square
root of the corpus (``slice_count``) and the messages with the corpus alone.  Inside
a slice or a bucket the work is done in pieces and parts of bounded size.

1. Every slice sends fingerprints of its anchors to buckets.  Splitters sampled
   from the corpus range-partition the anchors by their leading bytes.
2. Buckets send back the anchors that occur in more than one document.
3. For those, slices send the bytes around the anchor once per distinct context,
   with the smallest document id that has it.
4. Buckets sort the windows by multikey quicksort over big-endian words, compare
   neighbours byte by byte and give every window the smallest id of its run.
   Equal leading bytes fall on one side of a splitter, so runs never straddle a
   boundary; a string shared by very many documents arrives once per slice.
   An anchor with more than ``MOST_CONTEXTS`` contexts in the corpus (16 blanks)
   is not one bucket's work: its windows are sent one by one, to buckets chosen
   by a hash of their bytes, where equal windows still meet.
5. Slices mark the covered bytes of each document.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow_batches import binary_offsets

GRAM = 16
SLICE_BYTES = 2 << 20    # text of a slice, and anchors' share of a bucket, at least
FEW_SLICES, MOST_TIMES = 80, 16  # slices of that size before they grow; how many times that size they get
PIECE_BYTES = 1 << 17    # text whose anchors are looked for at once
PART = 1 << 16           # contexts that are compared at once
SAMPLE_DOCS = 2000       # documents whose anchors place the splitters
MOST_CONTEXTS = 1 << 15  # of one anchor, in a bucket
BUSY, SPREAD = 4, 4      # contexts in a slice that are counted; buckets per slice for windows of frequent anchors
NO_ID = np.iinfo(np.int64).max
_TABLE = np.random.default_rng(20).integers(0, 1 << 64, 256, np.uint64)


def slice_count(total: int) -> int:
    """Slices, and as many buckets, of so many bytes of text: one per ``SLICE_BYTES``
    up to ``FEW_SLICES``, then as many that their pairs grow with the text, until a
    slice has ``MOST_TIMES`` times ``SLICE_BYTES``."""
    least = max(1, -(-total // SLICE_BYTES))
    return math.ceil(least / min(max(1.0, math.sqrt(least / FEW_SLICES)), MOST_TIMES))


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``GRAM`` bytes from every position."""
    h, span, power = _TABLE[raw], 1, 0x9E3779B97F4A7C15
    while span < GRAM:
        h = h[:-span] * np.uint64(power) + h[span:]
        power = power * power % (1 << 64)
        span *= 2
    return _mix(h)


def _sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        h = np.minimum(h[:-span], h[span:])
        span *= 2
    return np.minimum(h[:span - width], h[width - span:]) if span < width else h


def anchors(raw: np.ndarray, offsets: np.ndarray, length: int):
    """Anchors of the windows of ``length`` bytes inside the documents of a byte
    array: ``(position, first window, last window, document)``, each anchor with
    the run of windows it serves (leftmost of equal hashes)."""
    none = np.zeros(0, np.int64)
    width = length - GRAM + 1
    if len(raw) < length:
        return none, none, none, none
    h = gram_hashes(raw)
    low = _sliding_min(h, width)                    # of the window from every position
    start = np.zeros(len(low), bool)
    start[1:] = low[1:] != low[:-1]
    inside = np.zeros(len(low) + 1, np.int8)        # windows that do not cross documents
    sizes = np.diff(offsets)
    long_docs = np.flatnonzero(sizes >= length)
    first, last = offsets[long_docs], offsets[long_docs + 1] - length
    start[first] = True
    inside[first] += 1
    inside[last + 1] -= 1
    ok = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    begin = np.flatnonzero(start & ok)
    doc = long_docs[np.searchsorted(first, begin, side="right") - 1]
    stop = np.append(begin[1:], len(low)) - 1
    stop = np.minimum(stop, offsets[doc + 1] - length)
    view = np.lib.stride_tricks.sliding_window_view(h, width)
    out = []
    while len(begin):
        at = begin + width - 1                      # where the smallest hash has just come in
        look = np.flatnonzero((begin == 0) | (low[begin] >= low[begin - 1]))
        for cut in range(0, len(look), 1 << 14):
            some = look[cut:cut + (1 << 14)]
            at[some] = begin[some] + view[begin[some]].argmin(1)
        out.append((at, begin, np.minimum(stop, at), doc))
        rest = stop > at                            # equal hashes further right serve the rest
        begin, stop, doc = at[rest] + 1, stop[rest], doc[rest]
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (none,) * 4


def _pieces(offsets: np.ndarray):
    """Runs of documents with about ``PIECE_BYTES`` of text (a longer one is alone)."""
    start, n = 0, len(offsets) - 1
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + PIECE_BYTES, side="right")) - 1
        end = min(max(end, start + 1), n)
        yield start, end
        start = end


def slice_anchors(raw: np.ndarray, offsets: np.ndarray, length: int):
    """``anchors`` of a whole slice, piece by piece."""
    found = [(np.zeros(0, np.int64),) * 4]
    for i, j in _pieces(offsets):
        base = offsets[i]
        at, first, last, doc = anchors(raw[base:offsets[j]], offsets[i:j + 1] - base, length)
        found.append((at + base, first + base, last + base, doc + i))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _parts(key: np.ndarray):
    """Rows in the order of a 16-bit key, in parts of about ``PART`` rows that do not
    divide a key."""
    order = np.argsort(key, kind="stable")
    starts = np.append(np.flatnonzero(np.diff(key[order])) + 1, len(key))
    done = 0
    while done < len(key):
        end = starts[min(np.searchsorted(starts, done + PART), len(starts) - 1)]
        yield order[done:end]
        done = end


def _words(raw: np.ndarray, at: np.ndarray, count: int) -> np.ndarray:
    """``count`` big-endian words of the bytes from every position, zero-filled."""
    if not len(at) or at.max() + 8 * count > len(raw):
        raw = np.concatenate([raw, np.zeros(8 * count, np.uint8)])
    view = np.lib.stride_tricks.sliding_window_view(raw, 8 * count)
    return np.ascontiguousarray(view[at]).view(">u8").astype(np.uint64)


def _strings(padded: np.ndarray, at: np.ndarray, size: np.ndarray) -> bytes:
    """The ``size`` bytes from every position behind each other."""
    most = int(size.max())
    rows = np.lib.stride_tricks.sliding_window_view(padded, most)[at]
    return rows[np.arange(most) < size[:, None]].tobytes()


def bucket_of(lead: np.ndarray, splitters: np.ndarray) -> np.ndarray:
    """The range of every two-word leading string among the sorted splitters."""
    first = np.searchsorted(splitters[:, 0], lead[:, 0], side="left")
    after = np.searchsorted(splitters[:, 0], lead[:, 0], side="right")
    out = first.copy()
    tied = np.flatnonzero(after > first)
    for lo in np.unique(first[tied]):
        own = tied[first[tied] == lo]
        hi = after[own[0]]
        out[own] = lo + np.searchsorted(splitters[lo:hi, 1], lead[own, 1], side="right")
    return out


def multikey_order(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows by their words, first word first, and the start of
    every run of equal rows.  Only runs still tied and not constant in a word
    are sorted by it."""
    n = len(words)
    order = np.argsort(words[:, 0])
    new = np.ones(n, bool)
    new[1:] = words[order[1:], 0] != words[order[:-1], 0]
    for k in range(1, words.shape[1]):
        tied = ~new
        tied[:-1] |= ~new[1:]
        rows = np.flatnonzero(tied)
        key, head = words[order[rows], k], new[rows]
        differs = np.flatnonzero((key[1:] != key[:-1]) & ~head[1:]) + 1
        if len(differs):
            run = np.cumsum(head) - 1
            mixed = np.zeros(run[-1] + 1, bool)
            mixed[run[differs]] = True
            own = np.flatnonzero(mixed[run])
            key, run, rows = key[own], run[own], rows[own]
            sub = np.lexsort((key, run))
            order[rows] = order[rows][sub]
            key = key[sub]
            new[rows[1:]] |= key[1:] != key[:-1]
    return order, new


def _clipped(words: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Big-endian words with the bytes from ``size`` on set to zero."""
    used = size[:, None] - 8 * np.arange(words.shape[1])[None, :]
    shift = (np.clip(8 - used, 0, 8) * 8).astype(np.uint64)
    return np.where(shift >= 64, np.uint64(0), (words >> np.minimum(shift, 63)) << np.minimum(shift, 63))


def _window_minima(raw, start, windows, low, length):
    """Of every window of the contexts: ``(context, number in it, smallest id of
    all contexts that hold the same bytes)``."""
    mine = np.repeat(np.arange(len(windows)), windows)
    nth = np.arange(len(mine)) - np.repeat(np.cumsum(windows) - windows, windows)
    least = np.empty(len(mine), np.int64)
    if len(mine):
        words = _words(raw, start[mine] + nth, (length + 7) // 8)
        if length % 8:
            words[:, -1] &= np.uint64((1 << 64) - (1 << 8 * (8 - length % 8)))
        order, new = multikey_order(words)
        run_low = np.minimum.reduceat(low[mine[order]], np.flatnonzero(new))
        least[order] = run_low[np.cumsum(new) - 1]
    return mine, nth, least


def _covered(raw, start, windows, back, low, length):
    """Windows of contexts that a smaller id also has: ``(context, first window, last
    window, smallest id)``, a row for each run of windows with the same smallest id."""
    sizes = windows + length - 1
    # contexts that slices have in common, with the smallest id of all
    key = np.column_stack([_clipped(_words(raw, start, (2 * length - GRAM + 7) // 8), sizes),
                           (sizes * 128 + back).astype(np.uint64)])
    order, new = multikey_order(key)
    del key
    form = np.empty(len(order), np.int64)
    form[order] = np.cumsum(new) - 1
    rep = order[new]
    form_low = np.minimum.reduceat(low[order], np.flatnonzero(new))
    # only anchors with several contexts need their windows compared
    gram_order, gram_new = multikey_order(_words(raw, start[rep] + back[rep], GRAM // 8))
    gram = np.empty(len(rep), np.int64)
    gram[gram_order] = np.cumsum(gram_new) - 1
    shared = np.bincount(gram)[gram] > 1
    alone, several = np.flatnonzero(~shared), np.flatnonzero(shared)
    mine, nth, least = _window_minima(raw, start[rep[several]], windows[rep[several]], form_low[several], length)
    # runs of windows of a context with the same smallest id
    fresh = np.ones(len(mine), bool)
    fresh[1:] = (mine[1:] != mine[:-1]) | (least[1:] != least[:-1])
    heads = np.flatnonzero(fresh)
    tails = np.append(heads[1:], len(mine)) - 1 if len(heads) else heads
    run_form = np.concatenate([alone, several[mine[heads]]])
    run_first = np.concatenate([np.zeros(len(alone), np.int64), nth[heads]])
    run_last = np.concatenate([windows[rep[alone]] - 1, nth[tails]])
    run_low = np.concatenate([form_low[alone], least[heads]])
    # to every slice that has the context with a larger id
    by_form = np.argsort(run_form, kind="stable")
    held = np.searchsorted(run_form[by_form], np.arange(len(rep) + 1))
    n_runs = (held[1:] - held[:-1])[form]
    entry = np.repeat(np.arange(len(form)), n_runs)
    run = by_form[np.repeat(held[form] - np.cumsum(n_runs) + n_runs, n_runs) + np.arange(len(entry))]
    less = run_low[run] < low[entry]
    run = run[less]
    return entry[less], run_first[run], run_last[run], run_low[run]


def _slice_docs(table: pa.Table):
    ids = table.column("id").combine_chunks()
    keys = ids.fill_null(NO_ID).to_numpy(zero_copy_only=False)
    raw, offsets = binary_offsets(table.column("text").combine_chunks())
    return ids, keys, raw, offsets


def _short(h: np.ndarray) -> np.ndarray:
    """48-bit numbers as rows of six bytes."""
    return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])


def _long(blobs) -> np.ndarray:
    raw = np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, 6)
    return np.pad(raw, ((0, 0), (0, 2))).view("<u8").ravel()


def _gram_key(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """48 bits of a hash of the anchor's bytes: enough to pick candidates by."""
    w = _words(raw, at, 2)
    h = _mix(w[:, 0] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(11)) + w[:, 1] * np.uint64(0xD6E8FEB86659FD93)
    return _mix(h) & np.uint64((1 << 48) - 1)


def _pair_key(bucket: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """Bucket and 48-bit anchor key as rows that compare as one."""
    out = np.empty(len(gram), [("bucket", np.int64), ("gram", np.uint64)])
    out["bucket"], out["gram"] = bucket, gram
    return out


def _bytes_hash(words: np.ndarray) -> np.ndarray:
    h = np.zeros(len(words), np.uint64)
    for k in range(words.shape[1]):
        h = _mix((h ^ words[:, k]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k + 1))
    return h


def _text_hashes(raw, start, size, span, mark=None):
    """A hash of ``size`` bytes (``span`` at most) from every position, and of a mark of each."""
    h = np.empty(len(start), np.uint64)
    for k in range(0, len(start), PART):
        some = slice(k, k + PART)
        text = _clipped(_words(raw, start[some], (span + 7) // 8), size[some])
        h[some] = _bytes_hash(text if mark is None else np.column_stack([text, mark[some].astype(np.uint64)]))
    return h


def _context_counts(raw, at, first, last, group, length):
    """Distinct contexts (by a 64-bit hash) of every group of anchors."""
    size = last - first + length
    h = _text_hashes(raw, first, size, 2 * length - GRAM, size * 128 + (at - first))
    order = np.lexsort((h, group))
    new = np.ones(len(h), bool)
    new[1:] = (h[order[1:]] != h[order[:-1]]) | (group[order[1:]] != group[order[:-1]])
    return np.bincount(group[order[new]])


def _hot_pairs(buckets: list, blobs: list) -> np.ndarray:
    return _pair_key(np.repeat(np.asarray(buckets, np.int64), [len(x) // 6 for x in blobs]), _long(blobs))


def _by_bucket(bucket: np.ndarray):
    order = np.argsort(bucket, kind="stable")
    cut = np.flatnonzero(np.diff(bucket[order])) + 1
    return [part for part in np.split(order, cut) if len(part)]


def _rows(columns: dict, schema: pa.Schema) -> pa.Table:
    return pa.table({f.name: pa.array(columns[f.name], f.type) for f in schema}, schema=schema)


SENT = pa.schema([("bucket", pa.int32()), ("slice", pa.int32()), ("one", pa.binary()), ("many", pa.binary()),
                  ("busy", pa.binary()), ("contexts", pa.binary())])
BACK = pa.schema([("slice", pa.int32()), ("from", pa.int32()), ("grams", pa.binary()), ("hot", pa.binary())])
CONTEXT = pa.schema([("bucket", pa.int32()), ("slice", pa.int32()), ("n", pa.int32()), ("bytes", pa.binary()),
                     ("windows", pa.binary()), ("back", pa.binary()), ("low", pa.binary())])
COVER = pa.schema([("slice", pa.int32()), ("bucket", pa.int32()), ("entry", pa.binary()),
                   ("first", pa.binary()), ("last", pa.binary()), ("low", pa.binary())])


def _distinct(ids, raw, at, first, last, doc, span, length, key):
    """The distinct contexts of anchors (``span``: the most bytes one can have; ``key``:
    16 bits that are equal for equal contexts): the entry of every anchor, an anchor of
    every entry, its smallest id.  Entries are in the order of their parts and bytes."""
    size = last - first + length                     # bytes of the context, from the first window on

    def ranked(rows):
        text = _clipped(_words(raw, first[rows], (span + 7) // 8), size[rows])
        order, new = multikey_order(np.column_stack([text, (size[rows] * 128 + (at - first)[rows]).astype(np.uint64)]))
        rank = np.empty(len(rows), np.int64)
        rank[order] = np.cumsum(new) - 1
        return rank, rows[order[new]]

    entry, n, reps = np.empty(len(at), np.int64), 0, [np.zeros(0, np.int64)]
    for part in _parts(key):
        # a context may fill a part and more: distinct within runs of rows, then among those
        ranks, found = zip(*(ranked(part[k:k + 2 * PART]) for k in range(0, len(part), 2 * PART)), strict=True)
        merged, rep = ranked(np.concatenate(found)) if len(found) > 1 else (np.arange(len(found[0])), found[0])
        base = np.cumsum([0] + [len(x) for x in found])
        entry[part] = n + merged[np.concatenate([x + y for x, y in zip(ranks, base[:-1], strict=True)])]
        reps.append(rep)
        n += len(rep)
    rep = np.concatenate(reps)
    low = np.full(len(rep), NO_ID)
    np.minimum.at(low, entry, ids[doc])
    return entry, rep, low


def _gram_part(gram: np.ndarray) -> np.ndarray:
    return (gram >> np.uint64(32)).astype(np.uint16)


def _hash_part(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(48)).astype(np.uint16)


def _contexts(ids, raw, offsets, grams, hot, splitters, n_slices, length):
    """Occurrences of the candidate anchors (sorted ``grams``) and their distinct contexts, in an
    order that depends on the slice alone.  Occurrences of ``hot`` anchors (rows
    of ``_pair_key``) are cut into their windows, each a context of its own."""
    at, first, last, doc = slice_anchors(raw, offsets, length)
    gram = _gram_key(raw, at)
    place = np.searchsorted(grams, gram)
    keep = grams[np.minimum(place, len(grams) - 1)] == gram if len(grams) else np.zeros(len(gram), bool)
    at, first, last, doc, gram = at[keep], first[keep], last[keep], doc[keep], gram[keep]
    bucket = bucket_of(_words(raw, at, 2), splitters)
    cut = np.isin(_pair_key(bucket, gram), hot) if len(hot) else np.zeros(len(at), bool)
    windows = (last - first + 1)[cut]
    one = np.repeat(first[cut] - np.cumsum(windows) + windows, windows) + np.arange(windows.sum())
    at2, doc2 = np.repeat(at[cut], windows), np.repeat(doc[cut], windows)
    at, first, last, doc, bucket, gram = at[~cut], first[~cut], last[~cut], doc[~cut], bucket[~cut], gram[~cut]
    entry, rep, low = _distinct(ids, raw, at, first, last, doc, 2 * length - GRAM, length, _gram_part(gram))
    bucket = bucket[rep]
    if len(one):
        h = _text_hashes(raw, one, np.full(len(one), length), length)
        entry2, rep2, low2 = _distinct(ids, raw, at2, one, one, doc2, length, length, _hash_part(h))
        spread = n_slices + (h[rep2] % np.uint64(SPREAD * n_slices)).astype(np.int64)
        entry, rep = np.concatenate([entry, entry2 + len(rep)]), np.concatenate([rep, rep2 + len(at)])
        low, bucket = np.concatenate([low, low2]), np.concatenate([bucket, spread])
        at, first, last, doc = (np.concatenate(x) for x in ((at, at2), (first, one), (last, one), (doc, doc2)))
    return at, first, last, doc, entry, rep, low, bucket, last - first + length


def remove_repeated_strings(docs: DataFrame, length: int = 50, id_col: str = "doc_id",
                            text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col, n_bytes, n_removed, n_spans, kept`` (the
    bytes that stay, in order).

    Every byte covered by a ``length``-byte string of the text's UTF-8 bytes
    that also starts in a document with a smaller id is removed; strings are
    judged on the input and never cross documents.  Null text is empty.  Null
    ids sort after all others and do not match each other; rows of equal id do
    not match each other either; repeated rows are returned as often as they
    come.  ``id_col`` must be of an integer type.  Other columns are ignored;
    an empty table gives an empty result.

    ``length`` is from ``GRAM`` to ``GRAM + 127``, for places within a window are
    kept in seven bits; others are refused with a ``ValueError``."""
    if not GRAM <= length < GRAM + 128:
        raise ValueError(f"length must be from {GRAM} to {GRAM + 127}, not {length}")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), text.alias("text"))
    n_docs, total = rows.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    n_slices = slice_count(total or 0)

    def leads(batches):
        for b in batches:
            raw, offsets = binary_offsets(b.column("text"))
            at = anchors(raw, offsets, length)[0]
            at = at[np.linspace(0, len(at) - 1, min(len(at), 1 << 14)).astype(int)] if len(at) else at
            w = _words(raw, at, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(w[:, 0]), pa.array(w[:, 1])], ["a", "b"])

    sample = rows.sample(min(1.0, SAMPLE_DOCS / max(1, n_docs)), seed=7).select("text")
    picked = sample.mapInArrow(leads, "a bigint, b bigint").limit(1 << 17).toArrow()
    points = np.column_stack([picked.column(c).to_numpy() for c in "ab"]).astype(np.int64).view(np.uint64)
    points = points[np.lexsort((points[:, 1], points[:, 0]))]
    cuts = np.linspace(0, len(points) - 1, n_slices + 1)[1:-1].astype(int) if len(points) else []
    splitters = points[cuts].reshape(-1, 2)

    own = F.pmod(F.xxhash64("id", "text"), F.lit(n_slices)).cast("int")
    sliced = rows.select(own.alias("slice"), "id", "text")

    def send(table: pa.Table) -> pa.Table:
        _, _, raw, offsets = _slice_docs(table)
        number = table.column("slice")[0].as_py()
        at, first, last, doc = slice_anchors(raw, offsets, length)
        if not len(at):
            return SENT.empty_table()
        gram = _gram_key(raw, at)
        order = np.lexsort((doc, gram))
        gram, doc, at, first, last = gram[order], doc[order], at[order], first[order], last[order]
        new = np.ones(len(gram), bool)
        new[1:] = gram[1:] != gram[:-1]
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(gram)) - 1
        several = doc[starts] != doc[ends]
        bucket = bucket_of(_words(raw, at[starts], 2), splitters)
        short = _short(gram[starts])
        counts = np.ones(len(starts), np.int64)
        often = np.repeat(ends - starts + 1 >= BUSY, ends - starts + 1)
        if often.any():
            group = (np.cumsum(new) - 1)[often]
            found = _context_counts(raw, at[often], first[often], last[often], group, length)
            counts[:len(found)] = np.maximum(found, 1)
        out = {f.name: [] for f in SENT}
        for part in _by_bucket(bucket):
            out["bucket"].append(int(bucket[part[0]]))
            out["slice"].append(number)
            out["one"].append(short[part[~several[part]]].tobytes())
            out["many"].append(short[part[several[part]]].tobytes())
            busy = part[counts[part] >= BUSY]
            out["busy"].append(short[busy].tobytes())
            out["contexts"].append(counts[busy].astype(np.int32).tobytes())
        return _rows(out, SENT)

    def back(table: pa.Table) -> pa.Table:
        numbers = table.column("slice").to_numpy()
        one, many = table.column("one").to_pylist(), table.column("many").to_pylist()
        gram = _long([x for pair in zip(one, many, strict=True) for x in pair])
        sizes = np.array([len(x) // 6 for pair in zip(one, many, strict=True) for x in pair])
        several = np.repeat(np.arange(len(sizes)) % 2 == 1, sizes)
        row = np.repeat(np.arange(len(sizes)) // 2, sizes)
        order = np.argsort(gram, kind="stable")
        new = np.ones(len(gram), bool)
        new[1:] = gram[order[1:]] != gram[order[:-1]]
        heads = np.flatnonzero(new)
        common = (np.diff(np.append(heads, len(gram))) > 1) | np.logical_or.reduceat(several[order], heads)
        hit = np.zeros(len(gram), bool)
        hit[order] = common[np.cumsum(new) - 1]
        # contexts of every anchor: as counted, and less than BUSY in the other slices
        busy = _long(table.column("busy").to_pylist())
        known = np.frombuffer(b"".join(table.column("contexts").to_pylist()), np.int32).astype(np.int64)
        heads_gram = gram[order[heads]]
        contexts_ = (BUSY - 1) * np.diff(np.append(heads, len(gram)))
        np.add.at(contexts_, np.searchsorted(heads_gram, busy), known - (BUSY - 1))
        hot = np.zeros(len(gram), bool)
        hot[order] = (contexts_ > MOST_CONTEXTS)[np.cumsum(new) - 1]
        own = table.column("bucket")[0].as_py()
        out = {f.name: [] for f in BACK}
        for part in _by_bucket(np.where(hit, row, -1)):
            if hit[part[0]]:
                out["from"].append(own)
                out["hot"].append(_short(gram[part[hot[part]]]).tobytes())
                out["slice"].append(numbers[row[part[0]]])
                out["grams"].append(_short(gram[part]).tobytes())
        return _rows(out, BACK)

    def context(table: pa.Table, grams: pa.Table) -> pa.Table:
        if not len(table):
            return CONTEXT.empty_table()
        _, keys, raw, offsets = _slice_docs(table)
        number = table.column("slice")[0].as_py()
        wanted = np.sort(_long(grams.column("grams").to_pylist()))
        hot = _hot_pairs(grams.column("from").to_pylist(), grams.column("hot").to_pylist())
        at, first, last, _, _, rep, low, bucket, size = _contexts(
            keys, raw, offsets, wanted, hot, splitters, n_slices, length)
        at, first, last, size = at[rep], first[rep], last[rep], size[rep]
        pack = zstandard.ZstdCompressor(level=3)
        padded = np.concatenate([raw, np.zeros(2 * length, np.uint8)])
        out = {f.name: [] for f in CONTEXT}
        for part in _by_bucket(bucket):
            out["bucket"].append(int(bucket[part[0]]))
            out["slice"].append(number)
            out["n"].append(len(part))
            out["bytes"].append(pack.compress(_strings(padded, first[part], size[part])))
            out["windows"].append((last - first + 1)[part].astype(np.uint8).tobytes())
            out["back"].append((at - first)[part].astype(np.uint8).tobytes())
            out["low"].append(low[part].tobytes())
        return _rows(out, CONTEXT)

    def cover(table: pa.Table) -> pa.Table:
        unpack = zstandard.ZstdDecompressor()
        raw = np.frombuffer(b"".join(unpack.decompress(x) for x in table.column("bytes").to_pylist()), np.uint8)
        windows = np.frombuffer(b"".join(table.column("windows").to_pylist()), np.uint8).astype(np.int64)
        back_ = np.frombuffer(b"".join(table.column("back").to_pylist()), np.uint8).astype(np.int64)
        low = np.frombuffer(b"".join(table.column("low").to_pylist()), np.int64)
        sizes = windows + length - 1
        start = np.cumsum(sizes) - sizes
        # equal contexts, and those of one anchor, are in one part; windows sent one by one only have equals
        if table.column("bucket")[0].as_py() < n_slices:
            key = _gram_part(_gram_key(raw, start + back_))
        else:
            key = _hash_part(_text_hashes(raw, start, sizes, length))
        found = []
        for part in _parts(key):
            entry, *runs = _covered(raw, start[part], windows[part], back_[part], low[part], length)
            found.append((part[entry], *runs))
        entry, run_first, run_last, run_low = (np.concatenate(x) for x in zip(*found, strict=True))
        counts = np.asarray(table.column("n").to_pylist())
        row = np.repeat(np.arange(len(counts)), counts)
        base = np.cumsum(counts) - counts
        out = {f.name: [] for f in COVER}
        slices_, buckets = table.column("slice").to_pylist(), table.column("bucket").to_pylist()
        for part in _by_bucket(row[entry]):
            r = row[entry[part[0]]]
            out["slice"].append(slices_[r])
            out["bucket"].append(buckets[r])
            out["entry"].append((entry[part] - base[r]).astype(np.int32).tobytes())
            out["first"].append(run_first[part].astype(np.uint8).tobytes())
            out["last"].append(run_last[part].astype(np.uint8).tobytes())
            out["low"].append(run_low[part].tobytes())
        return _rows(out, COVER)

    def finish(table: pa.Table, grams: list, hot: np.ndarray, covers: dict) -> pa.Table:
        ids, keys, raw, offsets = _slice_docs(table)
        wanted = np.sort(_long(grams))
        _, first, last, doc, entry, rep, low, bucket, _ = _contexts(
            keys, raw, offsets, wanted, hot, splitters, n_slices, length)
        edge = np.zeros(len(raw) + 1, np.int32)
        mine = low[entry] < keys[doc]                # a smaller id in the same slice has the whole context
        np.add.at(edge, first[mine], 1)
        np.add.at(edge, last[mine] + length, -1)
        by_entry = np.argsort(entry, kind="stable")
        held = np.searchsorted(entry[by_entry], np.arange(len(rep) + 1))
        for part in _by_bucket(bucket):
            if (found := covers.get(int(bucket[part[0]]))) is None:
                continue
            e, a, b, least = found
            e = part[e]
            n = held[e + 1] - held[e]
            occ = by_entry[np.repeat(held[e] - np.cumsum(n) + n, n) + np.arange(n.sum())]
            less = np.repeat(least, n) < keys[doc[occ]]
            np.add.at(edge, (first[occ] + np.repeat(a, n))[less], 1)
            np.add.at(edge, (first[occ] + np.repeat(b, n) + length)[less], -1)
        out, open_ = [], 0                           # spans that reach over the start of a piece end there
        for i, j in _pieces(offsets):
            text, own = raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
            depth = np.cumsum(edge[offsets[i]:offsets[j]]) + open_
            open_ = depth[-1] if len(depth) else open_
            gone = depth > 0
            starts = gone.copy()
            starts[1:] &= ~gone[:-1]
            inner = own[:-1][own[:-1] < len(text)]
            starts[inner] = gone[inner]              # runs end with their document
            removed = np.concatenate([[0], np.cumsum(gone)])
            spans = np.concatenate([[0], np.cumsum(starts)])
            stays = text[~gone].tobytes()
            kept_at = own - removed[own]
            kept = [stays[a:b] for a, b in zip(kept_at[:-1], kept_at[1:], strict=True)]
            out.append(pa.table({
                "id": ids.slice(i, j - i), "n_bytes": np.diff(own), "n_removed": np.diff(removed[own]),
                "n_spans": np.diff(spans[own]).astype(np.int64), "kept": pa.array(kept, pa.binary())}))
        return pa.concat_tables(out)

    def finish_slice(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not len(table):
            return out_schema.empty_table()
        grams, origin, hot, covers = [], [], [], {}
        for r in replies.to_pylist():
            if r["grams"] is not None:
                grams.append(r["grams"])
                origin.append(r["from"])
                hot.append(r["hot"])
            else:
                covers[r["bucket"]] = (np.frombuffer(r["entry"], np.int32).astype(np.int64),
                                       np.frombuffer(r["first"], np.uint8).astype(np.int64),
                                       np.frombuffer(r["last"], np.uint8).astype(np.int64),
                                       np.frombuffer(r["low"], np.int64))
        return finish(table, grams, _hot_pairs(origin, hot), covers)

    out_schema = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                            ("n_spans", pa.int64()), ("kept", pa.binary())])
    sent = sliced.groupBy("slice").applyInArrow(
        send, "bucket int, slice int, one binary, many binary, busy binary, contexts binary")
    grams = sent.groupBy("bucket").applyInArrow(back, "slice int, from int, grams binary, hot binary")
    around = sliced.groupBy("slice").cogroup(grams.groupBy("slice")).applyInArrow(
        context, "bucket int, slice int, n int, bytes binary, windows binary, back binary, low binary")
    covers = around.groupBy("bucket").applyInArrow(
        cover, "slice int, bucket int, entry binary, first binary, last binary, low binary")
    replies = grams.select(
        "slice", "from", "grams", "hot", F.lit(None).cast("int").alias("bucket"), F.lit(None).cast("binary").alias("entry"),
        F.lit(None).cast("binary").alias("first"), F.lit(None).cast("binary").alias("last"),
        F.lit(None).cast("binary").alias("low"),
    ).unionByName(covers.withColumns({
        "from": F.lit(None).cast("int"), "grams": F.lit(None).cast("binary"), "hot": F.lit(None).cast("binary")}))
    done = sliced.groupBy("slice").cogroup(replies.groupBy("slice")).applyInArrow(
        finish_slice, "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
    return done.withColumnRenamed("id", id_col)
