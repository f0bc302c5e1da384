"""Texts of an Arrow batch as bytes, for numpy code that works on many documents at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of a string column, and where each text starts and ends; null is empty."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)
    ends = ends[column.offset : column.offset + len(column) + 1].astype(np.int64)
    starts, ends = ends[:-1].copy(), ends[1:].copy()
    if column.null_count:
        ends = np.where(np.asarray(column.is_valid()), ends, starts)
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), starts, ends


def by_size(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Consecutive rows whose sizes sum to about ``most``; a larger row stands alone."""
    filled = np.cumsum(sizes)
    begin, n = 0, len(sizes)
    while begin < n:
        before = filled[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(filled, before + most, "right")))
        yield slice(begin, end)
        begin = end


def pieces(starts: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Texts cut into windows of ``width`` bytes: each window's text, start and end.

    An empty text has one empty window.
    """
    counts = np.maximum(1, -(-(ends - starts) // width))
    owner = np.repeat(np.arange(len(starts)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = starts[owner] + nth * width
    return owner, begin, np.minimum(begin + width, ends[owner])
