"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad.  Its features are its own, those of the line before
and those of the line after; neighbouring labels are tied by transition
weights.  Forward-backward gives the probability that a line is good, and the
length-weighted mean over the lines is the quality of the document.  With two
labels a message is one number, the log-odds of good against bad.
"""

from __future__ import annotations

import pickle
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow_batches import binary_offsets, slices
from .language_id import held_out

OWN = 14                # features of a line; three times as many enter the field

_UPPER, _LOWER, _DIGIT, _SPACE, _STOP, _MARK, _HIGH, _BAR = (1 << i for i in range(8))
_CLASS = np.zeros(256, np.uint8)
_CLASS[33:127] = _MARK
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58] = _UPPER, _LOWER, _DIGIT
_CLASS[[9, 11, 12, 13, 32]] = _SPACE
_CLASS[[ord(c) for c in ".,;:?'\"()-"]] = _STOP
_CLASS[[ord(c) for c in "|<>{}[]\\=_^~`"]] = _MARK | _BAR
_CLASS[128:] = _HIGH


def _per(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[end] - total[begin]


def line_features(raw: np.ndarray, offsets: np.ndarray):
    """``(features, lengths in bytes, lines per text)``; an empty text is one
    empty line."""
    feeds = np.flatnonzero(raw == 10)
    text_of = np.searchsorted(offsets, feeds, side="right") - 1
    n = len(offsets) - 1
    counts = np.bincount(text_of, minlength=n) + 1
    first = np.cumsum(counts) - counts
    head, last = np.zeros(counts.sum(), bool), np.zeros(counts.sum(), bool)
    head[first], last[first + counts - 1] = True, True
    begin, end = np.empty(len(head), np.int64), np.empty(len(head), np.int64)
    begin[head], begin[~head] = offsets[:-1], feeds + 1
    end[last], end[~last] = offsets[1:], feeds
    size = (end - begin).astype(np.float64)
    kind = _CLASS[raw]
    per = {k: _per((kind & k) > 0, begin, end) for k in (_UPPER, _LOWER, _DIGIT, _SPACE, _STOP, _MARK, _HIGH, _BAR)}
    letter = (kind & (_UPPER | _LOWER | _HIGH)) > 0
    # words: runs of bytes that are not white space, told apart by length and a sum over their letters
    solid = (kind & _SPACE) == 0
    solid &= raw != 10
    starts = solid.copy()
    starts[1:] &= ~solid[:-1]
    own = offsets[:-1][offsets[:-1] < len(raw)]
    starts[own] = solid[own]
    at = np.flatnonzero(starts)
    line = np.searchsorted(begin, at, side="right") - 1
    letter_code = np.arange(256, dtype=np.int64) * 2654435761 % 1000003 + 7
    code_sum = np.concatenate([[0], np.cumsum(np.where(letter, letter_code[raw], 0))])
    stop = np.append(at[1:], len(raw)) if len(at) else at
    stop = np.minimum(stop, end[line]) if len(at) else stop
    code = (code_sum[stop] - code_sum[at]) * 64 + np.minimum(stop - at, 63)
    again = np.zeros(len(at))
    again[1:] = (code[1:] == code[:-1]) & (line[1:] == line[:-1])
    near = np.zeros(len(at))
    for back in (2, 3):
        near[back:] += (code[back:] == code[:-back]) & (line[back:] == line[:-back])
    caps = (kind[at] & _UPPER) > 0
    words = np.bincount(line, minlength=len(begin)).astype(np.float64)
    some, long_ = np.maximum(words, 1), np.maximum(size, 1)
    letters = per[_UPPER] + per[_LOWER] + per[_HIGH]
    tail = kind[np.maximum(end - 1, 0)] if len(raw) else np.zeros(len(end), np.uint8)
    x = np.column_stack([
        size == 0, np.log1p(size) / 6, letters / long_, per[_UPPER] / np.maximum(letters, 1), per[_DIGIT] / long_,
        per[_MARK] / long_, per[_MARK] / some, per[_BAR] / some, per[_STOP] / some, np.minimum(letters / some, 30) / 10,
        np.bincount(line, again, len(begin)) / some, np.bincount(line, near, len(begin)) / some,
        np.bincount(line, caps, len(begin)) / some, (size > 0) & ((tail & _STOP) > 0),
    ])
    return x, size + 1, counts


def with_neighbours(x: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Features of the line, the line before and the line after (zeros at ends)."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    first = np.cumsum(counts) - counts
    before[first] = 0
    after[first + counts - 1] = 0
    return np.column_stack([x, before, after, np.ones(len(x))])


def _pass(odds: np.ndarray, starts: np.ndarray, counts: np.ndarray, stay_good: float, stay_bad: float, back: bool):
    """Log-odds message into every line from one side (0 at the first line)."""
    into = np.zeros(len(odds))
    order = np.argsort(-counts, kind="stable")
    live, base = counts[order], starts[order]
    prior = None
    for t in range(1, int(live[0]) if len(live) else 0):
        n = int(np.searchsorted(-live, -t, side="left"))
        here = base[:n] + (live[:n] - 1 - t if back else t)
        frm = here + (1 if back else -1)
        r = odds[frm] + (into[frm] if prior is None else prior[:n])
        into[here] = np.logaddexp(r + stay_good, 0) - np.logaddexp(r, stay_bad)
        prior = into[here]
    return into


def marginals(odds: np.ndarray, counts: np.ndarray, stay_good: float, stay_bad: float):
    """Forward and backward messages; the sum of both and the line's own odds
    are the marginal log-odds."""
    starts = np.cumsum(counts) - counts
    return (_pass(odds, starts, counts, stay_good, stay_bad, False),
            _pass(odds, starts, counts, stay_good, stay_bad, True))


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


class LineField:
    """Weights of the field: log-odds of a line, and the two stay weights."""

    def __init__(self, weights: np.ndarray, stay_good: float, stay_bad: float):
        self.weights, self.stay_good, self.stay_bad = weights, stay_good, stay_bad

    def score(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        x, size, counts = line_features(raw, offsets)
        odds = with_neighbours(x, counts) @ self.weights
        fore, back = marginals(odds, counts, self.stay_good, self.stay_bad)
        good = _sigmoid(odds + fore + back)
        starts = np.cumsum(counts) - counts
        return np.add.reduceat(size * good, starts) / np.add.reduceat(size, starts) if len(starts) else good


def train(x: np.ndarray, counts: np.ndarray, labels: np.ndarray, rounds: int = 160, penalty: float = 1e-3) -> LineField:
    """The field of largest penalised likelihood when all lines of a document
    carry its label; the labels weigh alike, and a document weighs as one line."""
    z = with_neighbours(x, counts)
    doc = np.repeat(np.arange(len(counts)), counts)
    y = labels[doc].astype(np.float64)
    share = np.where(labels > 0, 0.5 / max(1, (labels > 0).sum()), 0.5 / max(1, (labels == 0).sum())) / counts
    weight = share[doc]
    starts = np.cumsum(counts) - counts
    inner = np.ones(len(z), bool)
    inner[starts] = False
    here = np.flatnonzero(inner)
    theta = np.zeros(z.shape[1] + 2)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        sg, sb = theta[-2], theta[-1]
        odds = z @ theta[:-2]
        fore, back = marginals(odds, counts, sg, sb)
        p = _sigmoid(odds + fore + back)
        # neighbours both good, both bad: from the messages into either
        a, b = odds[here - 1] + fore[here - 1], odds[here] + back[here]
        parts = np.column_stack([a + b + sg, np.full(len(here), sb), a, b])
        parts = np.exp(parts - parts.max(1, keepdims=True))
        parts /= parts.sum(1, keepdims=True)
        w = weight[here]
        grad = np.concatenate([z.T @ (weight * (p - y)),
                               [(w * (parts[:, 0] - y[here])).sum(), (w * (parts[:, 1] - (1 - y[here]))).sum()]])
        grad += penalty * theta * np.append(np.ones(len(theta) - 2), [20.0, 20.0])
        mean = 0.9 * mean + 0.1 * grad
        square = 0.99 * square + 0.01 * grad * grad
        theta -= 0.1 * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
    return LineField(theta[:-2], float(theta[-2]), float(theta[-1]))


def stretches(raw: np.ndarray, offsets: np.ndarray, most_lines: int):
    """The texts, those of more lines cut to ``most_lines`` consecutive ones
    from a place that a checksum of the text draws: ``(bytes, offsets)``."""
    parts = []
    for a, z in zip(offsets[:-1], offsets[1:], strict=True):
        text = raw[a:z]
        feeds = np.flatnonzero(text == 10)
        spare = len(feeds) + 1 - most_lines
        if spare > 0:
            ends = np.concatenate([[-1], feeds, [len(text)]])
            at = zlib.crc32(text) % (spare + 1)
            text = text[ends[at] + 1:ends[at + most_lines]]
        parts.append(text)
    return (np.concatenate(parts) if parts else raw[:0]), np.cumsum([0] + [len(p) for p in parts])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", most_rows: int = 3000, most_lines: int = 400) -> LineField | None:
    """A field from about ``most_rows`` labelled documents of any length, half of
    either label, chosen by a hash of the id; of a document with more than
    ``most_lines`` lines it learns a stretch of so many.  Labels other than 0
    and 1 are ignored; an id with several labels counts with its largest.
    None unless both labels occur.  One task learns from the sample, and the
    driver gets the weights only."""
    marked = labels.where(F.col(label_col).isin(0, 1)).groupBy(id_col).agg(F.max(label_col).cast("int").alias("_y"))
    counts = {r["_y"]: r["n"] for r in marked.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return None
    draw = F.pmod(F.xxhash64(id_col), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rate = F.when(F.col("_y") == 1, min(1.0, most_rows / 2 / counts[1])).otherwise(min(1.0, most_rows / 2 / counts[0]))
    # about most_rows rows, far under any broadcast bound
    chosen = F.broadcast(marked.where(draw < rate).limit(2 * most_rows))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    sample = (docs.select(id_col, text.alias("text")).join(chosen, id_col)
              .select("text", "_y").limit(2 * most_rows))

    def learn(batches):
        xs, counts, labels = [], [], []
        for b in slices(batches, "text"):
            x, _, n = line_features(*stretches(*binary_offsets(b.column(0)), most_lines))
            xs.append(x)
            counts.append(n)
            labels.append(b.column(1).to_numpy(zero_copy_only=False))
        y = np.concatenate(labels) if labels else np.zeros(0)
        if 0 < y.sum() < len(y):
            field = train(np.concatenate(xs), np.concatenate(counts), y)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(field)], pa.binary())], ["field"])

    got = sample.coalesce(1).mapInArrow(learn, "field binary").collect()
    return pickle.loads(got[0]["field"]) if got else None


def score_quality(docs: DataFrame, field: LineField | None, text_col: str = "text", out_col: str = "score",
                  default: float = 0.5) -> DataFrame:
    """``docs`` with ``out_col``, the length-weighted share of good lines (0 to 1).

    Null text is empty; an empty text is one empty line.  Without a field all
    rows get ``default``.  All other columns stay (one named ``out_col`` is
    replaced); rows are independent, so repeated rows and ties need no rule; an
    empty table gives an empty result."""
    rows = docs.drop(out_col)
    if field is None:
        return rows.withColumn(out_col, F.lit(default))
    schema = rows.withColumn(out_col, F.lit(0.0)).schema

    def run(batches):
        for b in slices(batches, text_col):
            s = field.score(*binary_offsets(b.column(b.schema.names.index(text_col))))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.clip(s, 0, 1))], [*b.schema.names, out_col])

    return rows.mapInArrow(run, schema)


def classify_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     label_col: str = "quality", parts: int = 4, part: int = 2, threshold: float = 0.7) -> DataFrame:
    """``id_col, held_out, score, predicted`` of every row of ``docs``: fitted on
    labelled rows that are not held out, scored from the text alone."""
    out = held_out(F.col(id_col), parts, part)
    field = fit(docs.where(~out), labels.where(~held_out(F.col(id_col), parts, part)), id_col, text_col, label_col)
    scored = score_quality(docs.select(id_col, text_col, out.alias("held_out")), field, text_col)
    return scored.select(id_col, "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
