"""Removal of byte strings that also occur in a document with a smaller id, by suffix arrays.

Windows of ``MIN_BYTES`` bytes are dealt out so that equal ones always meet: each window belongs to
the least hashed 16-gram in it, its anchor, and neighbouring windows with the same anchor form one
stretch of text. Only anchors that occur in two documents go on. All stretches of an anchor meet in
one place; equal stretches are one class with its smallest document. The suffixes of the classes are
sorted, the common prefixes of neighbours give the interval tree of the suffix array, and a scan with
a stack visits every interval of at least ``MIN_BYTES`` common bytes. An interval whose suffixes are
preceded by different bytes, or begin a stretch, is a maximal repeat of its anchor; its occurrences
are all suffixes in it, not just neighbours, and each one in a document after the smallest is
removed. Removed pieces of neighbouring anchors join to longer runs.

An anchor with more than ``MOST_WINDOWS`` windows, such as a separator line between differing texts,
is not gathered. Its windows are dealt one by one by a hash of all their bytes, so equal ones still
meet; a lot of text sends each distinct window once, with its smallest and largest document. What is
known of a repeated window goes back to the parts of documents that have it, which look it up in
their texts. A removed string is a union of such windows, so the result is the same.

Exact copies of whole texts are set aside beforehand and are not compared byte by byte. No group is
gathered but the distinct stretches of one anchor; where very many documents share a stretch, it is
sent once per lot of text with the list of its places. Hashes have 64 bits, those of windows 128.

Defined results: a null text is empty; ids are integers, a null id is before all others; rows that
share an id never remove each other's bytes; repeated rows get the same result; texts shorter than
``MIN_BYTES`` stay as they are; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from tallyforge.llm.arrow_text import by_size, text_bytes
from tallyforge.llm.groups import group_chunks
from tallyforge.llm.tables import discard, join_weighted, release, small, written
from tallyforge.llm.word_hashes import mixed

MIN_BYTES = 50
GRAM = 16
LOT_BYTES = 1 << 19
#: Texts are dealt out in parts of about so many bytes.
PART_BYTES = 8 << 20
#: Entries that a task holds before it hands them on.
HELD = 1 << 20
#: The windows of an anchor, equal ones counted as well, up to which its suffixes are sorted.
MOST_WINDOWS = 1 << 18
MAX_BROADCAST_ROWS = 200_000
POSITION_BITS = np.uint64(30)
ODD = np.random.default_rng(50).integers(1, 1 << 63, 4, dtype=np.uint64) | np.uint64(1)


def part_of(document, parts: int):
    """The part a document is dealt to; the same for columns and arrays."""
    if isinstance(document, Column):
        return F.pmod(document.bitwiseXOR(F.shiftright(document, 7)), F.lit(parts)).cast("int")
    return np.mod(document ^ (document >> 7), parts).astype(np.int32)


def stretches(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of texts that lie back to back: each stretch's text, begin, end and anchor hash."""
    n = len(codes) - MIN_BYTES + 1
    if n <= 0:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    eight = np.ndarray((len(codes) - 7,), "<u8", buffer=codes, strides=(1,))
    grams = mixed(eight[: len(codes) - GRAM + 1] * ODD[0] + eight[8:] * ODD[1])
    least = (grams >> POSITION_BITS << POSITION_BITS) | np.arange(len(grams), dtype=np.uint64)
    span, wide = 1, MIN_BYTES - GRAM + 1
    while 2 * span <= wide:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < wide:
        least = np.minimum(least[: span - wide], least[wide - span :])
    anchor = (least & ((np.uint64(1) << POSITION_BITS) - np.uint64(1))).astype(np.int64)
    owner = np.repeat(np.arange(len(starts)), ends - starts)
    inside = owner[:n] == owner[MIN_BYTES - 1 :]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1] | (anchor[1:] != anchor[:-1]) | (owner[1:n] != owner[: n - 1])
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | (anchor[1:] != anchor[:-1]) | (owner[1:n] != owner[: n - 1])
    begin, end = np.flatnonzero(opens), np.flatnonzero(closes) + MIN_BYTES
    return owner[begin], begin, end, grams[anchor[begin]]


def lots(column: pa.Array) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """Consecutive texts with their bytes, and starts and ends within these."""
    data, starts, ends = text_bytes(column)
    for part in by_size(ends - starts, LOT_BYTES):
        first = int(starts[part][0])
        codes = np.ascontiguousarray(data[first : int(ends[part][-1])])
        yield part, codes, starts[part] - first, ends[part] - first


def dealt(bucket: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, list[bytes]]]:
    """Entries as one row of packed bytes per bucket."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    begins = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else []
    columns = [c[order] for c in columns]
    for begin, end in zip(begins, np.append(begins[1:], len(bucket))):
        yield int(bucket[begin]), [c[begin:end].tobytes() for c in columns]


def packed_rows(rows: list[tuple[int, list[bytes]]], *names: str) -> pa.RecordBatch:
    columns = list(zip(*[r[1] for r in rows])) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32())] + [pa.array(c, pa.binary()) for c in columns],
        names=["bucket", *names],
    )


def unpacked(table: pa.Table, name: str, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(table[name].to_pylist()), kind)


def copies_of_texts(rows: DataFrame) -> DataFrame:
    """Documents whose whole text is that of a document with a smaller id."""
    texts = written(
        rows.where(F.octet_length("body") >= MIN_BYTES).select("document", "content", F.md5("body").alias("digest")),
        "texts",
    )
    firsts = texts.groupBy("digest").agg(
        F.min("document").alias("first"), F.max("document").alias("last"), F.count("*").alias("n")
    )
    again = written(firsts.where("last > first").select("digest", "first", "n"), "repeated-texts")
    # A text that very many documents share is looked up by broadcast.
    later = join_weighted(texts, again, "digest").where(F.col("document") > F.col("first"))
    return written(later.select("document", "content").distinct(), "copies")


def shared_anchors(rows: DataFrame, parts: int) -> DataFrame:
    """Anchors that occur in two documents, as packed (documents, anchors) per part of documents.

    ``heavy`` tells for each whether the anchor has more than ``MOST_WINDOWS`` windows in all texts.
    """

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def handed() -> pa.RecordBatch:
            document, code, windows = (np.concatenate(c) for c in zip(*held))
            held.clear()
            bucket = (code % np.uint64(parts)).astype(np.int32)
            return packed_rows(list(dealt(bucket, document, code, windows)), "documents", "codes", "windows")

        for batch in batches:
            documents = batch.column("document").to_numpy()
            for part, codes, starts, ends in lots(batch.column("body")):
                owner, begin, end, code = stretches(codes, starts, ends)
                if not len(owner):
                    continue
                order = np.lexsort((code, owner))
                owner, code, windows = owner[order], code[order], (end - begin - MIN_BYTES + 1)[order]
                new = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (code[1:] != code[:-1])))
                held.append((documents[part][owner[new]], code[new], np.add.reduceat(windows, new)))
            if sum(len(h[0]) for h in held) > HELD:
                yield handed()
        if held:
            yield handed()

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def handed() -> pa.RecordBatch:
            document, code, heavy = (np.concatenate(c) for c in zip(*held))
            held.clear()
            return packed_rows(list(dealt(part_of(document, parts), document, code, heavy)), "documents", "codes", "heavy")

        for table, begins in group_chunks(batches, "bucket"):
            for begin, end in zip(begins[:-1], begins[1:]):
                group = table.slice(int(begin), int(end - begin))
                document, code = unpacked(group, "documents", np.int64), unpacked(group, "codes", np.uint64)
                order = np.argsort(code)
                document, code, windows = document[order], code[order], unpacked(group, "windows", np.int64)[order]
                opens = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
                sizes = np.diff(np.append(opens, len(code)))
                several = np.minimum.reduceat(document, opens) < np.maximum.reduceat(document, opens)
                chosen = np.repeat(several, sizes)
                heavy = np.repeat(np.add.reduceat(windows, opens) > MOST_WINDOWS, sizes)
                if chosen.any():
                    held.append((document[chosen], code[chosen], heavy[chosen]))
                if sum(len(h[0]) for h in held) > HELD:
                    yield handed()
        if held:
            yield handed()

    schema = "bucket int, documents binary, codes binary, {} binary"
    sent = rows.select("document", "body").mapInArrow(anchors, schema.format("windows"))
    grouped = sent.repartition("bucket").sortWithinPartitions("bucket")
    return written(grouped.mapInArrow(met, schema.format("heavy")), "anchors")


def stretches_of(rows: DataFrame, anchors: DataFrame, parts: int) -> DataFrame:
    """The stretches of shared anchors, each distinct text once per lot, packed per bucket of anchors.

    Of heavy anchors come the distinct windows of each lot, packed per bucket of windows in the last columns.
    """
    names = ("members", "documents", "contents", "begins", "codes", "digests", "sizes", "texts", *WINDOW_NAMES)

    def chosen(texts: pa.Table, wanted: pa.Table) -> pa.Table:
        out = []
        marks = None
        if wanted.num_rows and texts.num_rows:
            marks = mixed(unpacked(wanted, "codes", np.uint64) + ODD[2] * unpacked(wanted, "documents", np.int64).view(np.uint64))
            order = np.argsort(marks)
            marks, heavy = marks[order], unpacked(wanted, "heavy", bool)[order]
        for batch in texts.to_batches() if marks is not None else []:
            documents, contents = batch.column("document").to_numpy(), batch.column("content").to_numpy()
            for part, codes, starts, ends in lots(batch.column("body")):
                owner, begin, end, code = stretches(codes, starts, ends)
                mine = documents[part][owner]
                mark = mixed(code + ODD[2] * mine.view(np.uint64))
                at = np.minimum(np.searchsorted(marks, mark), len(marks) - 1)
                known = marks[at] == mark
                many = known & heavy[at]
                if many.any():
                    out.extend(send_windows(codes, begin[many], end[many], mine[many]))
                keep = known & ~heavy[at]
                if keep.any():
                    found = (owner[keep], begin[keep], end[keep], code[keep], mine[keep])
                    out.extend(send(codes, starts, contents[part], *found))
        return pa.Table.from_batches([packed_rows(out, *names)])

    def send(codes, starts, contents, owner, begin, end, code, document) -> Iterator[tuple[int, list[bytes]]]:
        digest = text_hashes(codes, begin, end)
        bucket = (code % np.uint64(parts)).astype(np.int32)
        order = np.lexsort((digest, bucket))
        new = np.append(True, (digest[order][1:] != digest[order][:-1]) | (bucket[order][1:] != bucket[order][:-1]))
        kind = np.cumsum(new) - 1  # the distinct text of each stretch, in this order
        first = order[new]
        at = begin - starts[owner]
        edges = np.append(np.flatnonzero(np.append(True, bucket[order][1:] != bucket[order][:-1])), len(order))
        for lo, hi in zip(edges[:-1], edges[1:]):
            rows = order[lo:hi]
            own = first[kind[lo] : kind[hi - 1] + 1]
            texts = b"".join(codes[b:e].tobytes() for b, e in zip(begin[own], end[own]))
            yield int(bucket[rows[0]]), [
                (kind[lo:hi] - kind[lo]).astype(np.int32).tobytes(),
                document[rows].tobytes(),
                contents[owner[rows]].tobytes(),
                at[rows].astype(np.int32).tobytes(),
                code[own].tobytes(),
                digest[own].tobytes(),
                (end[own] - begin[own]).astype(np.int32).tobytes(),
                zstandard.ZstdCompressor(level=1).compress(texts),
                *[b""] * len(WINDOW_NAMES),
            ]

    def send_windows(codes, begin, end, document) -> Iterator[tuple[int, list[bytes]]]:
        n = end - begin - MIN_BYTES + 1
        at = np.repeat(begin - np.cumsum(n) + n, n) + np.arange(n.sum())
        found = distinct_windows(*window_hashes(codes, at), *[np.repeat(document, n)] * 2)
        for bucket, columns in dealt((found[0] % np.uint64(parts)).astype(np.int32), *found):
            yield bucket, [b""] * (len(names) - len(WINDOW_NAMES)) + columns

    dealt_texts = rows.select("document", "content", "body", part_of(F.col("document"), parts).alias("bucket"))
    schema = "bucket int, " + ", ".join(f"{n} binary" for n in names)
    return dealt_texts.groupBy("bucket").cogroup(anchors.groupBy("bucket")).applyInArrow(chosen, schema)


def text_hashes(codes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each byte range, from running sums of weighted bytes."""
    weight = np.full(len(codes) + 1, ODD[3], np.uint64)
    weight[0] = 1
    weight = np.multiply.accumulate(weight)
    sums = np.append(np.uint64(0), np.cumsum(mixed(codes.astype(np.uint64) + ODD[2]) * weight[:-1], dtype=np.uint64))
    # Brought to the weights of a range at 0, so that equal ranges of different lots have one hash.
    back = np.full(len(codes) + 1, pow(int(ODD[3]), -1, 1 << 64), np.uint64)
    back[0] = 1
    back = np.multiply.accumulate(back)
    shifted = (sums[end] - sums[begin]) * back[begin]
    return mixed(shifted * ODD[0] + (end - begin).astype(np.uint64))


#: Two hashes of a window and the smallest and largest document that has it.
WINDOW_NAMES = ("ones", "twos", "leasts", "mosts")
WINDOW_TYPES = (np.uint64, np.uint64, np.int64, np.int64)


def second_hashes(codes: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """A hash of each window that is independent of :func:`text_hashes`, from words of eight bytes."""
    eight = np.ndarray((len(codes) - 7,), "<u8", buffer=codes, strides=(1,))
    out = np.zeros(len(begin), np.uint64)
    for at in (*range(0, MIN_BYTES - 8, 8), MIN_BYTES - 8):
        out = mixed((out + eight[begin + at]) * ODD[1] + ODD[0])
    return out


def window_hashes(codes: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return text_hashes(codes, begin, begin + MIN_BYTES), second_hashes(codes, begin)


def distinct_windows(one, two, least, most) -> tuple[np.ndarray, ...]:
    """Each window once, in order, with its smallest and largest document."""
    if not len(one):
        return one, two, least, most
    order = np.lexsort((two, one))
    one, two, least, most = one[order], two[order], least[order], most[order]
    opens = np.flatnonzero(np.append(True, (one[1:] != one[:-1]) | (two[1:] != two[:-1])))
    return one[opens], two[opens], np.minimum.reduceat(least, opens), np.maximum.reduceat(most, opens)


def repeated_windows(group: pa.Table, parts: int) -> tuple[np.ndarray, ...]:
    """Of the windows of one bucket: part of documents that removes some, hashes, smallest document."""
    one, two, low, high = (unpacked(group, n, t) for n, t in zip(WINDOW_NAMES, WINDOW_TYPES))
    order = np.lexsort((two, one))
    one, two, low, high = one[order], two[order], low[order], high[order]
    opens = np.flatnonzero(np.append(True, (one[1:] != one[:-1]) | (two[1:] != two[:-1])))
    least = np.repeat(np.minimum.reduceat(low, opens), np.diff(np.append(opens, len(one))))
    later = high > least
    part, one, two, least = part_of(low, parts)[later], one[later], two[later], least[later]
    order = np.lexsort((part, two, one))
    part, one, two, least = part[order], one[order], two[order], least[order]
    new = np.append(True, (one[1:] != one[:-1]) | (two[1:] != two[:-1]) | (part[1:] != part[:-1]))[: len(one)]
    return part[new], one[new], two[new], least[new]


def window_pieces(batches: list[pa.RecordBatch], gone: pa.Table) -> tuple[np.ndarray, ...]:
    """Ranges of texts whose windows are known to repeat: documents, contents, begins and ends."""
    one, two, low = (unpacked(gone, n, t) for n, t in zip(WINDOW_NAMES, WINDOW_TYPES[:3]))
    found = [tuple(np.zeros(0, np.int64) for _ in range(4))]
    if not len(one):
        return found[0]
    order = np.lexsort((two, one))
    one, two, low = one[order], two[order], low[order]
    marked = np.zeros(1 << 20, bool)
    marked[(one >> np.uint64(44)).astype(np.int64)] = True
    for batch in batches:
        documents, contents = batch.column("document").to_numpy(), batch.column("content").to_numpy()
        for part, codes, starts, ends in lots(batch.column("body")):
            at = np.arange(max(0, len(codes) - MIN_BYTES + 1))
            if not len(at):
                continue
            hashed = text_hashes(codes, at, at + MIN_BYTES)
            at = at[marked[(hashed >> np.uint64(44)).astype(np.int64)]]
            place = np.minimum(np.searchsorted(one, hashed[at]), len(one) - 1)
            same = one[place] == hashed[at]
            at, place = at[same], place[same]
            owner = np.searchsorted(ends, at, "right")
            same = (at + MIN_BYTES <= ends[owner]) & (two[place] == second_hashes(codes, at))
            same &= low[place] < documents[part][owner]
            at, owner = at[same], owner[same]
            if len(at):
                # Windows that follow each other byte by byte are one piece.
                opens = np.append(True, (at[1:] != at[:-1] + 1) | (owner[1:] != owner[:-1]))
                closes = np.append(opens[1:], True)
                begin, own = at[opens] - starts[owner[opens]], owner[opens]
                end = at[closes] - starts[own] + MIN_BYTES
                found.append((documents[part][own], contents[part][own], begin, end))
    return tuple(np.concatenate(c) for c in zip(*found))


def removed_pieces(sent: DataFrame, parts: int) -> DataFrame:
    """Removed byte ranges as packed (documents, contents, begins, ends) per part of documents.

    Of repeated windows of heavy anchors: hashes and smallest document, for each part that has them.
    """
    names = ("documents", "contents", "begins", "ends")
    window_names = WINDOW_NAMES[:3]

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def handed() -> pa.RecordBatch:
            document, *others = (np.concatenate(c) for c in zip(*held))
            held.clear()
            return sent_back(dealt(part_of(document, parts), document, *others), [], [b""] * len(window_names))

        def sent_back(rows, before, behind) -> pa.RecordBatch:
            return packed_rows([(b, [*before, *columns, *behind]) for b, columns in rows], *names, *window_names)

        for table, begins in group_chunks(batches, "bucket"):
            for begin, end in zip(begins[:-1], begins[1:]):
                group = table.slice(int(begin), int(end - begin))
                of_window = np.array([len(x.as_py()) > 0 for x in group["ones"]])
                if of_window.any():
                    windows = repeated_windows(group.filter(pa.array(of_window)), parts)
                    yield sent_back(dealt(*windows), [b""] * len(names), [])
                    group = group.filter(pa.array(~of_window))
                if group.num_rows:
                    pieces = bucket_pieces(group)
                    if len(pieces[0]):
                        held.append(pieces)
                if sum(len(h[0]) for h in held) > HELD:
                    yield handed()
        if held:
            yield handed()

    grouped = sent.repartition("bucket").sortWithinPartitions("bucket")
    schema = "bucket int, " + ", ".join(f"{n} binary" for n in (*names, *window_names))
    return written(grouped.mapInArrow(scanned, schema), "pieces")


def bucket_pieces(group: pa.Table) -> tuple[np.ndarray, ...]:
    """Removed ranges of the stretches of one bucket of anchors."""
    per_row = [len(c.as_py()) // 8 for c in group["codes"]]
    offset = np.repeat(np.cumsum(per_row) - per_row, [len(m.as_py()) // 4 for m in group["members"]])
    member = unpacked(group, "members", np.int32) + offset
    document, content = unpacked(group, "documents", np.int64), unpacked(group, "contents", np.int64)
    at, sizes = unpacked(group, "begins", np.int32), unpacked(group, "sizes", np.int32).astype(np.int64)
    code, digest = unpacked(group, "codes", np.uint64), unpacked(group, "digests", np.uint64)
    texts = b"".join(map(zstandard.ZstdDecompressor().decompress, group["texts"].to_pylist()))
    padded = np.frombuffer(texts + bytes(int(sizes.max()) + 8), np.uint8)
    # Equal stretches are one class; classes in order of their anchors.
    order = np.lexsort((digest, code))
    new = np.append(True, (code[order][1:] != code[order][:-1]) | (digest[order][1:] != digest[order][:-1]))
    of_text = np.empty(len(order), np.int64)
    of_text[order] = np.cumsum(new) - 1
    first = order[new]
    place = (np.cumsum(sizes) - sizes)[first]
    sizes, code, owner = sizes[first], code[first], of_text[member]
    least = np.full(len(first), np.iinfo(np.int64).max)
    np.minimum.at(least, owner, document)
    alone = np.append(True, code[1:] != code[:-1]) & np.append(code[1:] != code[:-1], True)
    # Each class is a repeat of its own members: a leaf of the interval tree. Classes that share an
    # anchor with others are sorted by their suffixes as well.
    entries = [(np.arange(len(first)), np.zeros(len(first), np.int64), sizes, least)]
    mixed_classes = np.flatnonzero(~alone)
    for lot in class_lots(mixed_classes, code, sizes):
        entries.append(maximal_repeats(padded, place, sizes, code, least, lot))
    kind, begin, length, smallest = (np.concatenate(c) for c in zip(*entries))
    # Every occurrence of every repeat: the members of its classes.
    by_class = np.argsort(owner, kind="stable")
    counts = np.bincount(owner, minlength=len(first))
    opens = np.cumsum(counts) - counts
    n = counts[kind]
    which = by_class[np.repeat(opens[kind] - np.cumsum(n) + n, n) + np.arange(n.sum())]
    entry = np.repeat(np.arange(len(kind)), n)
    gone = document[which] > smallest[entry]
    which, entry = which[gone], entry[gone]
    start = at[which].astype(np.int64) + begin[entry]
    return document[which], content[which], start, start + length[entry]


def class_lots(classes: np.ndarray, code: np.ndarray, sizes: np.ndarray, most: int = 1 << 15) -> Iterator[np.ndarray]:
    """Classes in lots of about ``most`` suffixes that keep the classes of an anchor together."""
    if not len(classes):
        return
    suffixes = np.cumsum(sizes[classes] - MIN_BYTES + 1)
    opens = np.flatnonzero(np.append(True, code[classes][1:] != code[classes][:-1]))
    begin = 0
    while begin < len(opens):
        before = suffixes[opens[begin] - 1] if opens[begin] else 0
        end = max(begin + 1, int(np.searchsorted(suffixes[opens - 1], before + most, "right")) if begin else 0)
        end = min(max(end, begin + 1), len(opens))
        stop = opens[end] if end < len(opens) else len(classes)
        yield classes[opens[begin] : stop]
        begin = end


def maximal_repeats(padded, place, sizes, code, least, classes) -> tuple[np.ndarray, ...]:
    """Repeats among the suffixes of classes: class, begin, length and smallest document of each.

    ``padded`` holds all texts and, behind them, as many more bytes as the longest has.
    """
    counts = sizes[classes] - MIN_BYTES + 1
    kind = np.repeat(classes, counts)
    begin = np.arange(len(kind)) - np.repeat(np.cumsum(counts) - counts, counts)
    length = sizes[kind] - begin
    wide = int(-(-length.max() // 8) * 8)
    suffixes = np.lib.stride_tricks.sliding_window_view(padded, wide)[place[kind] + begin]
    suffixes[np.arange(wide) >= length[:, None]] = 0
    words = suffixes.view(">u8").astype(np.uint64)
    group = np.repeat(np.cumsum(np.append(True, code[classes][1:] != code[classes][:-1])), counts)
    order = np.lexsort([length] + [words[:, i] for i in reversed(range(words.shape[1]))] + [group])
    # Common prefixes of neighbours in the suffix array, within an anchor.
    sorted_words, size = words[order], length[order]
    differs = sorted_words[1:] != sorted_words[:-1]
    word = np.where(differs.any(1), differs.argmax(1), words.shape[1] - 1)
    rows = np.arange(len(order) - 1)
    delta = sorted_words[rows + 1, word] ^ sorted_words[rows, word]
    same_bytes = 8 * word + np.where(delta > 0, leading_bytes(delta), 8)
    common = np.minimum(np.minimum(same_bytes, size[1:]), size[:-1])
    common[group[order][1:] != group[order][:-1]] = 0
    left = np.where(begin > 0, padded[np.maximum(place[kind] + begin - 1, 0)].astype(np.int64), -1 - np.arange(len(kind)))
    lo, hi, depth, smallest = scan_intervals(common, left[order], least[kind[order]])
    n = hi - lo + 1
    which = order[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())]
    return kind[which], begin[which], np.repeat(depth, n), np.repeat(smallest, n)


def leading_bytes(x: np.ndarray) -> np.ndarray:
    """How many leading bytes of 64-bit numbers are zero; not for 0."""
    n = np.zeros(len(x), np.int64)
    for shift, step in ((32, 4), (16, 2), (8, 1)):
        high = (x >> np.uint64(shift)) == 0
        n += np.where(high, step, 0)
        x = np.where(high, x, x >> np.uint64(shift))
    return n


def scan_intervals(common: np.ndarray, left: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, ...]:
    """All intervals of at least ``MIN_BYTES`` common bytes that cannot be extended to the left.

    ``common`` holds the common prefix of each suffix and the next, ``left`` the byte before each
    suffix (a negative number of its own if there is none). Returns first and last place, common
    length and smallest document of each interval.
    """
    found: list[tuple[int, int, int, int]] = []
    lasting = np.flatnonzero(common >= MIN_BYTES)
    if not len(lasting):
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    runs = np.split(lasting, np.flatnonzero(np.diff(lasting) > 1) + 1)
    for run in runs:
        first, last = int(run[0]), int(run[-1]) + 1
        depths = common[first:last].tolist() + [0]
        befores, documents = left[first : last + 1].tolist(), least[first : last + 1].tolist()
        # common length, first place, smallest document, byte before all suffixes or None
        stack: list[list] = []
        for i, depth in enumerate(depths):
            begin, smallest, before = i, documents[i], befores[i]
            while stack and stack[-1][0] > depth:
                length, begin, low, byte = stack.pop()
                smallest = low if low < smallest else smallest
                before = byte if byte == before else None
                if before is None or before < 0:
                    found.append((first + begin, first + i, length, smallest))
                if stack and stack[-1][0] >= depth:
                    under = stack[-1]
                    under[2] = min(under[2], smallest)
                    under[3] = under[3] if under[3] == before else None
            if depth:
                if stack and stack[-1][0] == depth:
                    top = stack[-1]
                    top[2] = min(top[2], smallest, documents[i + 1])
                    top[3] = top[3] if top[3] == before == befores[i + 1] else None
                else:
                    smallest = min(smallest, documents[i + 1])
                    before = before if before == befores[i + 1] else None
                    stack.append([depth, begin, smallest, before])
    return tuple(np.array(c, np.int64) for c in zip(*found)) if found else tuple(np.zeros(0, np.int64) for _ in range(4))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_bytes``, the removed ``spans`` (begin and end byte) and the ``kept`` bytes."""
    kind = docs.schema[key].dataType.typeName()
    if kind not in ("byte", "short", "integer", "long"):
        raise ValueError(f"ids must be integers, not {kind}")
    lowest = F.lit(-(1 << 63))
    rows = docs.select(
        F.col(key).alias("key"),
        F.coalesce(F.col(key).cast("long"), lowest).alias("document"),
        F.xxhash64(text).alias("content"),
        F.coalesce(F.col(text), F.lit("")).alias("body"),
    )
    copies = copies_of_texts(rows)
    known = small(copies.withColumn("is_copy", F.lit(True)), MAX_BROADCAST_ROWS)
    total = rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // PART_BYTES)) | 1
    marked = rows.join(known, ["document", "content"], "left")
    single = marked.where((F.octet_length("body") >= MIN_BYTES) & F.col("is_copy").isNull())
    anchors = shared_anchors(single, parts)
    release(docs.sparkSession)
    pieces = removed_pieces(stretches_of(single, anchors, parts), parts)
    discard(anchors)
    release(docs.sparkSession)

    def cut(texts: pa.Table, gone: pa.Table) -> pa.Table:
        spans = span_index(gone, window_pieces(texts.to_batches(), gone))
        out = []
        for batch in texts.to_batches():
            data, starts, ends = text_bytes(batch.column("body"))
            whole = batch.column("is_copy").to_pylist()
            begins, stops, keeps = [], [], []
            for i, row in enumerate(zip(batch.column("document").to_pylist(), batch.column("content").to_pylist())):
                codes = data[starts[i] : ends[i]]
                if whole[i]:
                    b, e = np.zeros(1, np.int64), np.array([len(codes)])
                else:
                    b, e = spans.get(row, (np.zeros(0, np.int64),) * 2)
                begins.append(b)
                stops.append(e)
                edges = np.concatenate([[0], np.stack([b, e], 1).ravel(), [len(codes)]])
                keeps.append(b"".join(codes[x:y].tobytes() for x, y in zip(edges[::2], edges[1::2])))
            counts = np.array([len(b) for b in begins])
            offsets = pa.array(np.append(0, np.cumsum(counts)).astype(np.int32))
            flat = pa.StructArray.from_arrays(
                [pa.array(np.concatenate(begins)), pa.array(np.concatenate(stops))], names=["begin", "end"]
            )
            out.append(
                pa.RecordBatch.from_arrays(
                    [
                        batch.column("key"),
                        pa.array(ends - starts),
                        pa.ListArray.from_arrays(offsets, flat),
                        pa.array(keeps, pa.binary()),
                    ],
                    names=["key", "n_bytes", "spans", "kept"],
                )
            )
        return pa.Table.from_batches(out) if out else empty

    empty = pa.table(
        {
            "key": pa.array([], {"byte": pa.int8(), "short": pa.int16(), "integer": pa.int32(), "long": pa.int64()}[kind]),
            "n_bytes": pa.array([], pa.int64()),
            "spans": pa.array([], pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
            "kept": pa.array([], pa.binary()),
        }
    )
    dealt_texts = marked.select("key", "document", "content", "body", "is_copy", part_of(F.col("document"), parts).alias("bucket"))
    result = dealt_texts.groupBy("bucket").cogroup(pieces.groupBy("bucket")).applyInArrow(
        cut, f"key {docs.schema[key].dataType.simpleString()}, n_bytes long, spans array<struct<begin:long,end:long>>, kept binary"
    )
    return result.withColumnRenamed("key", key)


def span_index(gone: pa.Table, more: tuple[np.ndarray, ...]) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
    """Removed ranges, and ``more`` of them, by document, joined where they touch or overlap."""
    names = ("documents", "contents", "begins", "ends")
    document, content, begin, end = (np.append(unpacked(gone, n, np.int64), m) for n, m in zip(names, more))
    if not len(document):
        return {}
    order = np.lexsort((begin, content, document))
    document, content, begin, end = (c[order] for c in (document, content, begin, end))
    new = np.append(True, (document[1:] != document[:-1]) | (content[1:] != content[:-1]))
    edges = np.append(np.flatnonzero(new), len(document))
    index = {}
    for lo, hi in zip(edges[:-1], edges[1:]):
        reach = np.maximum.accumulate(end[lo:hi])
        opens = np.append(True, begin[lo + 1 : hi] > reach[:-1])
        closes = np.append(opens[1:], True)
        index[int(document[lo]), int(content[lo])] = begin[lo:hi][opens], reach[closes]
    return index
