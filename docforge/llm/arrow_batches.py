"""Small helpers for functions that run inside Arrow map tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no such column (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def binary_offsets(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string column; null counts as empty.  Offsets
    are relative to the returned byte array and have one entry more than rows."""
    col = col.cast(pa.large_binary()).fill_null(b"")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batches, column: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut incoming batches so that the text of a slice stays near ``max_bytes``
    (a single longer text is a slice of its own); bounds the numpy buffers made
    from it, whatever the batch size of the session."""
    for batch in batches:
        if not len(batch):
            continue
        _, offsets = binary_offsets(batch.column(batch.schema.get_field_index(column)))
        start = 0
        while start < len(batch):
            end = int(np.searchsorted(offsets, offsets[start] + max_bytes, side="right")) - 1
            end = min(max(end, start + 1), len(batch))
            yield batch.slice(start, end - start)
            start = end


class Forest:
    """Minimum labels of the links seen so far among ``n`` items."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        lab = self.label
        while len(i):
            a, b = lab[i], lab[j]
            open_ = a != b
            if not open_.any():
                break
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            np.minimum.at(lab, np.maximum(a, b), np.minimum(a, b))
            while True:
                nxt = lab[lab]
                if (nxt == lab).all():
                    break
                lab[:] = nxt
