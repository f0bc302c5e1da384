"""Benchmark decontamination by winnowing.

Every benchmark item is a set of windows of 13 consecutive words; a shorter item is one window. In
each window the least hash of its word k-grams is its fingerprint, on both sides, so equal windows
have equal fingerprints at equal places: no shared window can be missed. Fingerprints of documents
and items are joined; around each hit the windows it can belong to are compared in full, by the hash
of all their words. Hashes have 64 bits.

Defined results: a null text has no words and is not contaminated; an item with a null text or no
word has no window; a null item id counts as an empty one; items that share an id count once; rows
of ``documents`` that share id and text share their result, and each gives one result row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyforge.llm.arrow_text import by_size, text_bytes
from tallyforge.llm.tables import small, unused, written
from tallyforge.llm.word_hashes import mixed, runs, words

WINDOW_WORDS = 13
GRAM_WORDS = 6
#: Tables of more rows than this are joined by a shuffle.
MAX_BROADCAST_ROWS = 200_000
#: Texts are read in lots of about so many bytes.
LOT_BYTES = 1 << 19


def gram(size: int) -> int:
    """Words per fingerprint in windows of ``size`` words."""
    return min(GRAM_WORDS, size)


def picks(hashes: np.ndarray, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all windows of ``size`` words within one text: places and hashes."""
    k = gram(size)
    grams = runs(hashes, k)
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    lowest, at = grams[:n].copy(), np.zeros(n, np.int64)
    for shift in range(1, size - k + 1):
        lower = grams[shift : shift + n] < lowest
        lowest[lower] = grams[shift : shift + n][lower]
        at[lower] = shift
    inside = owner[:n] == owner[size - 1 :]
    places = (np.arange(n) + at)[inside]
    places = places[np.append(True, places[1:] != places[:-1])] if len(places) else places
    return places, grams[places]


def salted(hashes: np.ndarray, size: int) -> np.ndarray:
    return mixed(hashes + np.uint64(size)).view(np.int64)


def lists(values: np.ndarray, owner: np.ndarray, n: int) -> pa.Array:
    """``values``, ordered by their owner, as one list per owner."""
    offsets = np.append(0, np.cumsum(np.bincount(owner, minlength=n))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def item_windows(benchmark: DataFrame, key: str, text: str, window: int) -> DataFrame:
    """All windows of all items: id, size, hash of the window and hash of its fingerprint."""

    def of_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts, ends = text_bytes(batch.column("body"))
            found: list[list] = [[], [], [], []]
            for i, item in enumerate(batch.column("item").to_pylist()):
                hashes, owner, _, _ = words(data, starts[i : i + 1], ends[i : i + 1])
                if not len(hashes):
                    continue
                size = min(window, len(hashes))
                grams = runs(hashes, gram(size))
                width = size - gram(size) + 1
                for at, whole in enumerate(runs(hashes, size)):
                    found[0].append(item)
                    found[1].append(size)
                    found[2].append(whole)
                    found[3].append(grams[at : at + width].min())
            sizes = np.array(found[1], np.int64)
            codes = [np.array(x, np.uint64) + sizes.astype(np.uint64) for x in found[2:]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(found[0], pa.string()),
                    pa.array(sizes.astype(np.int32)),
                    pa.array(mixed(codes[0]).view(np.int64)),
                    pa.array(mixed(codes[1]).view(np.int64)),
                ],
                names=["item", "size", "whole", "fingerprint"],
            )

    rows = benchmark.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("item"),
        F.coalesce(F.col(text), F.lit("")).alias("body"),
    )
    return rows.mapInArrow(of_items, "item string, size int, whole long, fingerprint long")


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW_WORDS,
    key: str = "doc_id",
) -> DataFrame:
    """Hit words and matched items of every document.

    Columns: ``key``, ``n_words``, ``n_hit`` and ``items``, the sorted ids of the items of which a
    window occurs.
    """
    windows = written(item_windows(benchmark, item_key, item_text, window), "item-windows")
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())  # at most 13
    rows = docs.select(
        F.col(key).alias("key"),
        F.xxhash64(text).alias("content"),
        F.coalesce(F.col(text), F.lit("")).alias("body"),
    )
    kind = dict(rows.dtypes)["key"]

    def fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts, ends = text_bytes(batch.column("body"))
            for part in by_size(ends - starts, LOT_BYTES):
                hashes, owner, _, counts = words(data, starts[part], ends[part])
                n = part.stop - part.start
                opens = np.cumsum(counts) - counts
                # The first entry of every document carries its number of words.
                own, at, code = [np.arange(n)], [counts], [np.arange(n, dtype=np.int64)]
                for size in sizes:
                    places, grams = picks(hashes, owner, size)
                    own.append(owner[places])
                    at.append(places - opens[owner[places]])
                    code.append(salted(grams, size))
                spread = np.concatenate(own)
                order = np.argsort(spread, kind="stable")
                chosen = [np.concatenate(x)[order] for x in (at, code)]
                which = np.concatenate([np.full(len(x), s, np.int32) for x, s in zip(own, [0, *sizes])])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").slice(part.start, n),
                        batch.column("content").slice(part.start, n),
                        lists(which[order], spread[order], n),
                        lists(chosen[0], spread[order], n),
                        lists(chosen[1], spread[order], n),
                    ],
                    names=["key", "content", "size", "at", "fingerprint"],
                )

    schema = f"key {kind}, content long, size array<int>, at array<long>, fingerprint array<long>"
    entries = rows.mapInArrow(fingerprints, schema).select(
        "key", "content", F.inline(F.arrays_zip("size", "at", "fingerprint"))
    )
    known = small(
        written(windows.select("size", "fingerprint").distinct().withColumn("known", F.lit(True)), "item-prints"),
        MAX_BROADCAST_ROWS,
    )
    # Rows of size 0 match nothing; their fingerprint only spreads them if the join shuffles.
    hits = written(
        entries.join(known, ["size", "fingerprint"], "left")
        .where("size = 0 or known")
        .select("key", "content", "size", "at"),
        "hits",
    )
    same = lambda a, b: a["key"].eqNullSafe(b["key"]) & a["content"].eqNullSafe(b["content"])
    candidates = written(
        hits.where("size > 0")
        .groupBy("key", "content")
        .agg(F.sort_array(F.collect_set(F.struct("size", "at"))).alias("hit")),
        "candidates",
    )
    near = small(candidates, MAX_BROADCAST_ROWS // 10)

    def extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts, ends = text_bytes(batch.column("body"))
            for i, hit in enumerate(batch.column("hit").to_pylist()):
                hashes, _, _, _ = words(data, starts[i : i + 1], ends[i : i + 1])
                found = []
                for size in {h["size"] for h in hit}:
                    at = np.array([h["at"] for h in hit if h["size"] == size])
                    begin = np.unique(at[:, None] - np.arange(size - gram(size) + 1))
                    begin = begin[(begin >= 0) & (begin + size <= len(hashes))]
                    whole = salted(runs(hashes, size)[begin], size)
                    found.append((np.full(len(begin), size, np.int32), begin, whole))
                size, begin, whole = (np.concatenate(x) for x in zip(*found))
                n = len(begin)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column("key")[i].as_py()] * n, batch.column("key").type),
                        pa.array(np.full(n, batch.column("content")[i].as_py())),
                        pa.array(size),
                        pa.array(begin),
                        pa.array(whole),
                    ],
                    names=["key", "content", "size", "begin", "whole"],
                )

    suspects = (
        rows.join(near, same(rows, near))
        .select(rows["key"], rows["content"], "body", "hit")
        .mapInArrow(extended, f"key {kind}, content long, size int, begin long, whole long")
    )
    contents = small(written(windows.select("size", "whole", "item").distinct(), "items"), MAX_BROADCAST_ROWS)
    shared = written(
        suspects.distinct().join(contents, ["size", "whole"]).select("key", "content", "size", "begin", "item"),
        "shared-windows",
    )
    before = Window.partitionBy("key", "content").orderBy("begin", "size").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.col("begin") + F.col("size")
    # Words of a window that no window before it covers.
    fresh = F.greatest(F.lit(0), reach - F.greatest("begin", F.coalesce(F.max(reach).over(before), F.lit(0))))
    spans = (
        shared.select("key", "content", "begin", "size")
        .distinct()
        .withColumn("fresh", fresh)
        .groupBy("key", "content")
        .agg(F.sum("fresh").alias("n_hit"))
    )
    items = shared.groupBy("key", "content").agg(F.sort_array(F.collect_set("item")).alias("items"))
    both = spans.join(items, same(spans, items)).select(spans["key"], spans["content"], "n_hit", "items")
    found = small(written(both, "contaminated"), MAX_BROADCAST_ROWS // 10)
    every = hits.where("size = 0").select("key", "content", F.col("at").alias("n_words"))
    return every.join(found, same(every, found), "left").select(
        every["key"].alias(key),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        every["content"].alias("content"),
    )


def contaminated():
    """A twentieth of the words or more are hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without those of which a twentieth or more is benchmark text."""
    found = contamination(docs, benchmark, text, key=key).where(contaminated())
    bad_key, bad_content = unused("bad_key", docs), unused("bad_content", docs)
    bad = found.select(F.col(key).alias(bad_key), F.col("content").alias(bad_content)).distinct()
    bad = small(written(bad, "contaminated-rows"), MAX_BROADCAST_ROWS)
    same = F.col(key).eqNullSafe(F.col(bad_key)) & (F.xxhash64(text) == F.col(bad_content))
    return docs.join(bad, same, "left_anti")
