"""Rows of vectors packed into blocks, for fits that pass over them many times.

A block holds the entries of some ten thousand rows as numpy arrays, one behind the other. It takes a
fraction of the room of as many vector objects and is read without looking at single rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, functions as F

BLOCK_ROWS = 30_000
TASKS_PER_CORE = 3


@dataclass
class Block:
    """``pos`` and ``value`` of all stored entries, row by row; ``count`` entries belong to each row.

    ``extra`` holds further columns, one number per row.
    """

    count: np.ndarray
    pos: np.ndarray
    value: np.ndarray
    extra: dict[str, np.ndarray]

    def __len__(self) -> int:
        return len(self.count)

    def starts(self) -> np.ndarray:
        """Where the entries of every row begin."""
        return np.cumsum(self.count, dtype=np.int64) - self.count

    def entries(self, rows: np.ndarray) -> np.ndarray:
        """Where the entries of some rows are."""
        count = self.count[rows].astype(np.int64)
        ends = np.cumsum(count)
        return np.repeat(self.starts()[rows] - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)

    def take(self, rows: np.ndarray) -> Block:
        at = self.entries(rows)
        extra = {k: v[rows] for k, v in self.extra.items()}
        return Block(self.count[rows], self.pos[at], self.value[at], extra)


def join_blocks(blocks: list[Block]) -> Block:
    def together(parts: list[np.ndarray]) -> np.ndarray:
        return parts[0] if len(parts) == 1 else np.concatenate(parts)

    extra = {k: together([b.extra[k] for b in blocks]) for k in blocks[0].extra}
    return Block(
        together([b.count for b in blocks]), together([b.pos for b in blocks]), together([b.value for b in blocks]), extra
    )


def freeze(block: Block) -> bytes:
    plain = pickle.dumps((block.count, block.pos, block.value, block.extra), protocol=5)
    return len(plain).to_bytes(8, "little") + pa.compress(plain, codec="lz4", asbytes=True)


def thaw(frozen: bytes) -> Block:
    plain = pa.decompress(frozen[8:], int.from_bytes(frozen[:8], "little"), codec="lz4", asbytes=True)
    return Block(*pickle.loads(plain))


def _narrow(numbers: np.ndarray, top: int) -> np.ndarray:
    return numbers.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.int32)


def _of_batch(batch: pa.RecordBatch, width: int) -> Block:
    """A block of Arrow rows: ``indices`` (null for dense vectors), ``values`` and other columns."""
    indices, values = batch.column("indices"), batch.column("values")
    if values.null_count:
        raise ValueError("a row has no vector")
    count = values.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    value = values.flatten().to_numpy(zero_copy_only=False)
    pos = np.arange(len(value)) - np.repeat(np.cumsum(count) - count, count)
    sparse = ~indices.is_null().to_numpy(zero_copy_only=False)
    pos[np.repeat(sparse, count)] = indices.flatten().to_numpy(zero_copy_only=False)
    extra = {
        name: batch.column(name).to_numpy(zero_copy_only=False)
        for name in batch.schema.names
        if name not in ("indices", "values")
    }
    return Block(_narrow(count, width + 1), _narrow(pos, width), value, extra)


def regroup(blocks: Iterator[Block], rows: int | None = None) -> Iterator[Block]:
    """Blocks put together until they have ``rows`` rows or more."""
    held: list[Block] = []
    for block in blocks:
        held.append(block)
        if sum(map(len, held)) >= (rows or BLOCK_ROWS):
            yield join_blocks(held)
            held = []
    if held:
        yield join_blocks(held)


def pack(df: DataFrame, features: str, width: int, *extra: str) -> RDD:
    """The vectors of ``df`` as frozen blocks; ``width`` is their length, ``extra`` are number columns."""
    raw = F.unwrap_udt(features)
    sparse = F.when(raw["type"] == 0, raw["indices"])
    columns = df.select(sparse.alias("indices"), raw["values"].alias("values"), *extra)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in regroup(_of_batch(b, width) for b in batches if b.num_rows):
            yield pa.RecordBatch.from_pydict({"block": pa.array([freeze(block)], pa.binary())})

    return columns.mapInArrow(packed, "block binary").rdd.map(lambda row: bytes(row[0]))


@contextmanager
def kept(blocks: RDD) -> Iterator[RDD]:
    """Blocks kept for several passes, for the length of a ``with`` block."""
    blocks.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield blocks
    finally:
        blocks.unpersist()


def per_task(blocks: RDD, work: Callable[[Iterator[Block]], object]) -> RDD:
    """What ``work`` makes of the blocks of each task; few tasks, each with many blocks."""
    few = blocks.coalesce(TASKS_PER_CORE * blocks.context.defaultParallelism)
    return few.mapPartitions(lambda frozen: [work(map(thaw, frozen))])
