"""Bounded-space online packing of token ids into sequences of a fixed length.

Every partition packs its documents as they come. It keeps a fixed number of open windows; what a
document has beyond full windows goes to the fullest window it fits in. If it fits in none and no
more may be opened, the fullest window is topped up with the head of the piece and emitted. At the
end a partition pours its open windows together, so that at most one stays partly filled. These
leftovers, less than one window per partition, are merged in rounds of groups of partitions. The last
one is cut into sequences whose lengths are powers of two, so no sequence needs padding.

Nothing is ever gathered beyond the leftovers of ``MERGED_AT_ONCE`` partitions in one task.

Defined results: a null text is an empty one, and an empty one is the end token alone; null ids are
carried as null; repeated rows are packed each on their own; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tallyforge.llm.tables import written
from tallyforge.llm.tokens import Encoder, added_tokens

WINDOW = 1024
OPEN_WINDOWS = 32
END = 0
MERGED_AT_ONCE = 512
#: Rows of results that a task holds back before handing them on.
ROWS_OUT = 1024

#: document, ids before the piece, ids of the document, ids of the piece
Piece = tuple[object, int, int, bytes]


class Packer:
    """Open windows of one partition; full ones are handed to ``emit`` as lists of pieces."""

    def __init__(self, emit, size: int = WINDOW, limit: int = OPEN_WINDOWS):
        self.emit, self.size, self.limit = emit, size, limit
        self.open: list[tuple[int, int, list[Piece]]] = []  # room, number, pieces; least room first
        self.opened = 0

    def add(self, document: object, start: int, total: int, ids: bytes) -> None:
        """Pack the ids of a document, or a part of them that starts at ``start``."""
        whole = len(ids) // 4 // self.size * self.size
        for at in range(0, whole, self.size):
            self.emit([(document, start + at, total, ids[4 * at : 4 * (at + self.size)])])
        if 4 * whole < len(ids):
            self.place((document, start + whole, total, ids[4 * whole :]))

    def place(self, piece: Piece) -> None:
        n = len(piece[3]) // 4
        at = bisect.bisect_left(self.open, (n,))
        if at == len(self.open):
            if at < self.limit:
                self.opened += 1
                return self.put(self.size, self.opened, [], piece)
            piece = self.top_up(piece)
            return self.place(piece) if piece else None
        return self.put(*self.open.pop(at), piece)

    def put(self, room: int, number: int, pieces: list[Piece], piece: Piece) -> None:
        pieces.append(piece)
        room -= len(piece[3]) // 4
        if room:
            bisect.insort(self.open, (room, number, pieces))
        else:
            self.emit(pieces)

    def top_up(self, piece: Piece) -> Piece | None:
        """Fill the fullest window with the head of ``piece`` and emit it; what is left of the piece."""
        document, start, total, ids = piece
        room, _, pieces = self.open.pop(0)
        self.emit(pieces + [(document, start, total, ids[: 4 * room])])
        rest = ids[4 * room :]
        return (document, start + room, total, rest) if rest else None

    def pour(self) -> list[Piece]:
        """Pour the open windows together; the pieces of the one that stays partly filled."""
        while len(self.open) > 1:
            _, _, pieces = self.open.pop()  # the emptiest
            for piece in pieces:
                while piece is not None and self.open:
                    room, number, held = self.open[0]
                    if len(piece[3]) // 4 >= room:
                        piece = self.top_up(piece)
                    else:
                        self.put(*self.open.pop(0), piece)
                        piece = None
                if piece is not None:
                    self.place(piece)
        return self.open.pop()[2] if self.open else []


def power_cuts(pieces: list[Piece]) -> Iterator[list[Piece]]:
    """Pieces of fewer than a window's ids as sequences whose lengths are powers of two."""
    n = sum(len(p[3]) // 4 for p in pieces)
    queue = list(pieces)
    for bit in reversed(range(n.bit_length())):
        want, sequence = n & (1 << bit), []
        while want:
            document, start, total, ids = queue.pop(0)
            take = min(want, len(ids) // 4)
            sequence.append((document, start, total, ids[: 4 * take]))
            if 4 * take < len(ids):
                queue.insert(0, (document, start + take, total, ids[4 * take :]))
            want -= take
        if sequence:
            yield sequence


class Rows:
    """Collects sequences as rows of pieces and hands them on in batches."""

    def __init__(self, schema: pa.Schema, with_ids: bool):
        self.schema, self.with_ids, self.rows = schema, with_ids, []

    def add(self, pieces: list[Piece], number: int, origin: int, is_open: bool = False) -> None:
        offset = 0
        for document, start, total, ids in pieces:
            n = len(ids) // 4
            kept = np.frombuffer(ids, "<i4") if self.with_ids or is_open else None
            self.rows.append((document, start, n, zlib.crc32(ids), total, number, offset, kept, is_open, origin))
            offset += n

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) if self.rows else [[] for _ in self.schema]
        self.rows = []
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, self.schema)], schema=self.schema
        )


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    ranks_path: str,
    key: str = "doc_id",
    text: str = "text",
    size: int = WINDOW,
    open_windows: int = OPEN_WINDOWS,
    with_ids: bool = True,
) -> DataFrame:
    """The pieces of all documents and where they lie in the sequences.

    Columns: ``key``, ``start`` (ids of the document before the piece), ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id``, ``offset`` and, if asked for, ``ids``.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    schema = (
        f"key {dict(rows.dtypes)['key']}, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long, ids array<int>, open boolean, origin long"
    )
    arrow = pa.schema(
        [
            ("key", arrow_type(rows)),
            *[(n, pa.int64()) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")],
            ("ids", pa.list_(pa.int32())),
            ("open", pa.bool_()),
            ("origin", pa.int64()),
        ]
    )
    end, added = np.array([END], "<u4").tobytes(), added_tokens(tokenizer_path)

    def tokenised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer_path, ranks_path, added)
        origin = TaskContext.get().partitionId()
        out, number = Rows(arrow, with_ids), [origin << 32]

        def emit(pieces: list[Piece]) -> None:
            out.add(pieces, number[0], origin)
            number[0] += 1

        packer = Packer(emit, size, open_windows)
        for batch in batches:
            for document, body in zip(batch.column("key").to_pylist(), batch.column("body")):
                ids = encoder.ids(body.as_py()) + end
                packer.add(document, 0, len(ids) // 4, ids)
                if len(out.rows) >= ROWS_OUT:
                    yield out.take()
        encoder.close()
        left = packer.pour()
        if left:
            out.add(left, number[0], origin, is_open=True)
        yield out.take()

    packed = written(rows.mapInArrow(tokenised, schema), "packed")
    parts, left, step = [packed.where("not open")], packed.where("open"), 0
    last = left.agg(F.max("origin")).first()[0]
    while last is not None:
        step += 1
        final = last < MERGED_AT_ONCE
        merged = written(merge(left, schema, arrow, step, final, size, open_windows, with_ids), "merged")
        parts.append(merged.where("not open"))
        left, last = merged.where("open"), None if final else last // MERGED_AT_ONCE
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    columns = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    return result.select(F.col("key").alias(key), *columns)


def arrow_type(rows: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(rows.schema["key"].dataType)


def merge(
    left: DataFrame, schema: str, arrow: pa.Schema, step: int, final: bool, size: int, open_windows: int, with_ids: bool
) -> DataFrame:
    """Pack the leftovers of ``MERGED_AT_ONCE`` origins together; ``final`` leaves nothing open."""
    group = F.floor(F.col("origin") / MERGED_AT_ONCE)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, state = Rows(arrow, with_ids), {"group": None}

        def emit(pieces: list[Piece]) -> None:
            out.add(pieces, state["number"], state["group"])
            state["number"] += 1

        def close() -> None:
            pieces = state["packer"].pour()
            if final:
                for sequence in power_cuts(pieces):
                    emit(sequence)
            elif pieces:
                out.add(pieces, state["number"], state["group"], is_open=True)

        for batch in batches:
            for row in batch.to_pylist():
                origin = row["origin"] // MERGED_AT_ONCE
                if origin != state["group"]:
                    if state["group"] is not None:
                        close()
                    state.update(group=origin, number=(step << 56) + (origin << 32))
                    state["packer"] = Packer(emit, size, open_windows)
                ids = np.array(row["ids"], "<u4").tobytes()
                state["packer"].add(row["key"], row["start"], row["doc_tokens"], ids)
            if len(out.rows) >= ROWS_OUT:
                yield out.take()
        if state["group"] is not None:
            close()
        yield out.take()

    together = left.repartition(group).sortWithinPartitions("origin", "sequence_id", "offset")
    return together.mapInArrow(packed, schema)
