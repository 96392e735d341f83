"""Whole texts in bounded slices, for operators that run in Python workers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: UTF-8 bytes of text handled at once (a longer text is a slice of its own).
SLICE_BYTES = 5 << 20


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES, fill: bool = True) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in order, cut so that no slice holds more than limit bytes of text
    unless it is one row. With fill, null texts become empty."""
    for batch in batches:
        text = batch.column(column)
        if fill and text.null_count:
            at = batch.schema.get_field_index(column)
            text = text.fill_null("")
            batch = pa.RecordBatch.from_arrays([text if i == at else c for i, c in enumerate(batch.columns)], batch.schema.names)
        ends = np.cumsum(lengths(text)) if len(text) else np.zeros(0, dtype=np.int64)
        start, base = 0, 0
        while start < len(ends):
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start, base = stop, int(ends[stop - 1])


def raw(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets): the UTF-8 bytes of a string array and where each text starts and ends."""
    offsets = np.frombuffer(text.buffers()[1], dtype=np.int32, count=len(text) + text.offset + 1)[text.offset :].astype(np.int64)
    data = text.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def lengths(text: pa.Array) -> np.ndarray:
    return np.diff(raw(text)[1])


def gather(table: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """table[starts[i] : starts[i] + counts[i]] for all i, one after the other."""
    total = int(counts.sum())
    if not total:
        return table[:0]
    kind = np.int32 if max(total, len(table)) < 1 << 31 else np.int64
    at = np.repeat((starts - (np.cumsum(counts) - counts)).astype(kind), counts)
    at += np.arange(total, dtype=kind)
    return table[at]


def blobs(data: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A string or binary array over data; ends are byte offsets, without the leading 0."""
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(kind, len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
