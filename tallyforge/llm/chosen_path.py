"""Jaccard join of word n-gram sets by chosen paths.

A document is the set of its distinct shingles of five words. All documents with the same set are
one node. Nodes are split again and again: in each step every node draws two of its shingles by
minimum hashes that are seeded by the path to its bucket, and nodes of a bucket that drew the same
shingle stay together. A bucket of at most ``BRUTE_FORCE`` nodes is not split further; its nodes are
compared by sketches of their sets. The whole is repeated in independent runs. Two sets of
similarity s stay together in one draw with probability s, and the branches of a path are independent
of each other; with two draws per step and at most three steps a pair at the threshold of 0.8 is
missed by one run with probability 0.06 at most, and ``runs_for`` gives the number of runs for a target
recall.

Pairs that pass the sketches connect nodes into candidate groups, and within each group all pairs
are compared exactly, in blocks of bounded size; no pair is ever written out. The result is the
class of every document (connected by links of exact similarity at or above the threshold) and its
number of links to other documents.

Words are runs of digits, letters and characters beyond ASCII, with A to Z folded. A text of one to
four words is one shingle of all its words. Hashes have 64 bits.

Defined results: a text without a word (null or empty) is a class of its own without links; rows
with the same set are linked to each other, repeated rows included; a class is named by the least id
in it, null if all are null; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyforge.llm.arrow_text import by_size, text_bytes
from tallyforge.llm.components import components
from tallyforge.llm.groups import group_chunks, settled
from tallyforge.llm.tables import small, unused, written
from tallyforge.llm.word_hashes import mixed, runs as word_runs, words

SHINGLE = 5
THRESHOLD = 0.8
TARGET_RECALL = 0.99999
DRAWS = 2
STEPS = 3
BRUTE_FORCE = 2048
#: Sketches: least hash in each of so many parts of the hash range, 16 bits of it.
PARTS = 64
#: Exact comparison: sets, and shingles in them, per block.
BLOCK_SETS = 1024
BLOCK_SHINGLES = 1 << 21
MAX_BROADCAST_ROWS = 200_000
LOT_BYTES = 1 << 19
SEEDS = np.random.default_rng(99).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def runs_for(threshold: float, recall: float, draws: int = DRAWS, steps: int = STEPS) -> int:
    """Independent runs after which a pair at the threshold is found with probability ``recall``."""
    together = 1.0
    for _ in range(steps):
        together = 1 - (1 - threshold * together) ** draws
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - together)))


def shingle_sets(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, size: int = SHINGLE
) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for part in by_size(ends - starts, LOT_BYTES):
        hashes, owner, _, counts = words(data, starts[part], ends[part])
        full = word_runs(hashes, size, salt=size)
        opens = np.cumsum(counts) - counts
        for begin, n in zip(opens, counts):
            if n >= size:
                yield np.unique(full[begin : begin + n - size + 1])
            elif n:
                yield word_runs(hashes[begin : begin + n], int(n), salt=int(n))
            else:
                yield np.zeros(0, np.uint64)


def set_node(codes: np.ndarray) -> int:
    """One number for a whole set."""
    sums = np.array([mixed(codes).sum(), mixed(codes * SEEDS[0]).sum(), len(codes)], np.uint64)
    return int(mixed((sums * SEEDS[:3]).sum(keepdims=True)).view(np.int64)[0])


def sketch(codes: np.ndarray) -> np.ndarray:
    """16 bits of the least code in each of ``PARTS`` parts of the range; 0 for an empty part."""
    edges = (np.arange(PARTS, dtype=np.uint64) << np.uint64(58)).astype(np.uint64)
    at = np.searchsorted(codes, edges)
    stop = np.append(at[1:], len(codes))
    least = codes[np.minimum(at, len(codes) - 1)]
    return np.where(at < stop, (mixed(least) & np.uint64(0xFFFF)) | np.uint64(1), 0).astype(np.uint16)


def described(docs: DataFrame, key: str, text: str, seeds: int) -> DataFrame:
    """Node, set size, shingles drawn in the first step and sketch of every document.

    The node of no words is null.
    """
    rows = docs.select(
        F.col(key).alias("key"), F.xxhash64(text).alias("content"), F.coalesce(F.col(text), F.lit("")).alias("body")
    )

    def of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[], [], [], []]
            for codes in shingle_sets(*text_bytes(batch.column("body"))):
                if len(codes):
                    drawn = [int((codes * s).min() >> np.uint64(32)) for s in SEEDS[2 : 2 + seeds]]
                    entry = (set_node(codes), len(codes), np.array(drawn, np.uint32).view(np.int32), sketch(codes).tobytes())
                else:
                    entry = (None, 0, None, None)
                for column, value in zip(columns, entry):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("content")] + [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["key", "content", "node", "n", "drawn", "sketch"],
            )

    kind = dict(rows.dtypes)["key"]
    return rows.mapInArrow(of_texts, f"key {kind}, content long, node long, n long, drawn array<int>, sketch binary")


def blocks(rows: DataFrame, sizes: DataFrame, group: str, pieces: Column) -> DataFrame:
    """``rows`` with ``left`` and ``right``: the pair of blocks of its group that a row is compared in.

    ``sizes`` gives each group once; groups of more than one block (``pieces``) are cut into blocks
    by node, and every row goes to each pair of blocks that has its own.
    """
    large = sizes.withColumn("pieces", pieces.cast("int")).where("pieces > 1").select(group, "pieces")
    large = small(written(large, "large-groups"), MAX_BROADCAST_ROWS)
    own = F.pmod(F.xxhash64("node", F.lit("block")), F.col("pieces")).cast("int")
    cut = rows.join(large, group, "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
    cut = cut.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
    )
    return cut.select(
        *rows.columns, F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right"), "own"
    )


def redrawn(docs: DataFrame, over: DataFrame, nodes: DataFrame, key: str, text: str) -> DataFrame:
    """(``node``, ``bucket``) after one more step of nodes in crowded buckets: each draws anew per bucket.

    The shingles of such a node are taken from its text again; it is in a few buckets per run.
    """
    paths = over.groupBy("node").agg(F.collect_list("bucket").alias("paths")).join(nodes.select("node", "first_key"), "node")
    paths = small(written(paths.withColumnRenamed("first_key", "key"), "paths"), MAX_BROADCAST_ROWS)
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    texts = rows.join(paths, rows["key"].eqNullSafe(paths["key"])).select("node", "paths", "body")

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[list] = [[], []]
            lists = zip(batch.column("node").to_pylist(), batch.column("paths").to_pylist())
            for codes, (node, paths_) in zip(shingle_sets(*text_bytes(batch.column("body"))), lists):
                # Other documents may share the id; only the text that the node stands for counts.
                if not len(codes) or set_node(codes) != node:
                    continue
                for path in np.array(paths_, np.int64).view(np.uint64):
                    for nth in range(DRAWS):
                        least = mixed((codes ^ path) * SEEDS[nth]).min()
                        found[0].append(node)
                        found[1].append(int(mixed(np.array([least ^ path * SEEDS[DRAWS + nth]])).view(np.int64)[0]))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names=["node", "bucket"])

    return texts.mapInArrow(drawn, "node long, bucket long").distinct()


def buckets(docs: DataFrame, nodes: DataFrame, runs: int, brute_force: int, key: str, text: str) -> DataFrame:
    """(``bucket``, ``node``) of all buckets at which splitting ends and that have two nodes or more."""
    first = F.posexplode("drawn").alias("nth", "shingle")
    split = nodes.select("node", first).select("node", F.xxhash64("nth", "shingle").alias("bucket"))
    leaves = None
    for step in range(STEPS):
        split = written(split, "split")
        sizes = split.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
        shared = written(split.join(sizes, "bucket"), "buckets")
        last = step == STEPS - 1
        done = shared if last else shared.where(F.col("members") <= brute_force)
        done = done.select("bucket", "node", "members")
        leaves = done if leaves is None else leaves.unionByName(done)
        over = shared.where(F.col("members") > brute_force)
        if last or over.isEmpty():
            return leaves
        split = redrawn(docs, over, nodes, key, text)
    return leaves


def candidate_links(leaves: DataFrame, nodes: DataFrame, threshold: float, brute_force: int) -> DataFrame:
    """Links that connect, within each bucket, the nodes whose sketches may belong to similar sets."""
    with_sketch = leaves.join(nodes.select("node", "sketch"), "node").select("bucket", "node", "sketch", "members")
    sizes = leaves.where(F.col("members") > brute_force).groupBy("bucket").agg(F.count("*").alias("size"))
    rows = blocks(with_sketch, sizes, "bucket", F.ceil(F.col("size") / brute_force))
    # Far below the share of parts that similar sets agree in, whatever their size.
    enough = threshold * 0.6

    def agreeing(mine: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Which sketches of two equally long or broadcastable lists agree enough."""
        same = ((mine == other) & (mine > 0)).sum(-1, dtype=np.int16)
        used = ((mine > 0) | (other > 0)).sum(-1, dtype=np.int16)
        return same >= enough * used

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, begins in group_chunks(batches, "bucket", "left", "right"):
            node = table["node"].to_numpy()
            own = table["own"].to_numpy()
            sk = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint16).reshape(-1, PARTS)
            sizes = np.diff(begins)
            lefts, rights = [], []
            # Pairs of small groups all at once: each row with the rows up to 32 behind it.
            ends = np.repeat(begins[1:], sizes)
            few = np.repeat(sizes <= 32, sizes)
            for gap in range(1, 32):
                i = np.flatnonzero(few[:-gap] & (np.arange(len(node) - gap) + gap < ends[:-gap])) if gap < len(node) else []
                if not len(i):
                    break
                i = i[agreeing(sk[i], sk[i + gap])]
                lefts.append(i)
                rights.append(i + gap)
            for g in np.flatnonzero(sizes > 32):
                rows = np.arange(begins[g], begins[g + 1])
                two = own[rows].min() != own[rows].max()
                one = rows[own[rows] == own[rows].min()] if two else rows
                other = rows[own[rows] == own[rows].max()] if two else rows
                for part in np.array_split(one, -(-len(one) // 64)):
                    i, j = np.nonzero(agreeing_all(sk[part], sk[other], enough))
                    lefts.append(part[i])
                    rights.append(other[j])
                    # Keep what is held small: links that connect what is connected already add nothing.
                    if sum(map(len, lefts)) > 1 << 20:
                        label = settled(len(node), np.concatenate(lefts), np.concatenate(rights))
                        lefts, rights = [np.flatnonzero(label != np.arange(len(node)))], []
                        rights = [label[lefts[0]]]
            if not lefts:
                continue
            label = settled(len(node), np.concatenate(lefts), np.concatenate(rights))
            linked = np.flatnonzero(label != np.arange(len(node)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[linked]), pa.array(node[label[linked]])], names=["a", "b"]
            )

    grouped = rows.repartition("bucket", "left", "right").sortWithinPartitions("bucket", "left", "right")
    return grouped.mapInArrow(links, "a long, b long")


def agreeing_all(mine: np.ndarray, other: np.ndarray, enough: float) -> np.ndarray:
    """Each of ``mine`` against each of ``other``, one sketch part after the other."""
    same = np.zeros((len(mine), len(other)), np.int16)
    used = np.zeros_like(same)
    for k in range(PARTS):
        a, b = mine[:, k, None], other[None, :, k]
        same += (a == b) & (a > 0)
        used += (a > 0) | (b > 0)
    return same >= enough * used


def similar(codes: list[np.ndarray], n_one: int, two: bool, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of sets at or above the threshold: within the list, or across its first ``n_one`` and the rest."""
    sizes = np.array([len(c) for c in codes], np.int64)
    flat = np.concatenate(codes)
    _, place, counts = np.unique(flat, return_inverse=True, return_counts=True)
    shared = counts > 1
    column = np.cumsum(shared) - 1
    keep = shared[place]
    row, at = np.repeat(np.arange(len(codes)), sizes)[keep], column[place[keep]]
    width, n = int(shared.sum()), len(codes)
    a, b = (slice(0, n_one), slice(n_one, n)) if two else (slice(0, n), slice(0, n))
    common = np.zeros((a.stop, b.stop - b.start), np.float32)
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    for begin in range(0, width, 4096):
        lo, hi = np.searchsorted(at, [begin, begin + 4096])
        dense = np.zeros((n, min(4096, width - begin)), np.float32)
        dense[row[lo:hi], at[lo:hi] - begin] = 1
        common += dense[a] @ dense[b].T
    union = sizes[a, None] + sizes[None, b] - common
    i, j = np.nonzero(common >= threshold * union - 1e-6)
    j = j + b.start
    order = i < j
    yield i[order], j[order]


def exact_links(
    docs: DataFrame, members: DataFrame, nodes: DataFrame, key: str, text: str, threshold: float
) -> DataFrame:
    """Per node, the documents linked to it, and per link group a node it is connected to.

    ``members`` gives (``node``, ``root``) of the candidate groups. Columns: ``node``, ``linked``,
    ``to``; a node in several block pairs has a row for each.
    """
    group = members.join(nodes.select("node", "n", "copies", "first_key"), "node")
    group = written(group.select("node", "root", "n", "copies", F.col("first_key").alias("key")), "members")
    sizes = group.groupBy("root").agg(F.count("*").alias("sets"), F.sum("n").alias("shingles"))
    wanted = small(group.select("node", "root", "copies", "key"), MAX_BROADCAST_ROWS)
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    texts = rows.join(wanted, rows["key"].eqNullSafe(wanted["key"])).select("node", "root", "copies", "body")

    def with_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = list(shingle_sets(*text_bytes(batch.column("body"))))
            # Other documents may share the id; only the text that the node stands for counts.
            node = batch.column("node").to_pylist()
            right = [i for i, c in enumerate(codes) if len(c) and set_node(c) == node[i]]
            kept = batch.select(["node", "root", "copies"]).take(pa.array(right, pa.int64()))
            packed = pa.array([codes[i].tobytes() for i in right], pa.binary())
            yield pa.RecordBatch.from_arrays([*kept.columns, packed], names=["node", "root", "copies", "codes"])

    sets = texts.mapInArrow(with_codes, "node long, root long, copies long, codes binary")
    pieces = F.greatest(F.ceil(F.col("sets") / BLOCK_SETS), F.ceil(F.col("shingles") / BLOCK_SHINGLES))
    cut = blocks(sets, sizes, "root", F.greatest(pieces, F.lit(1)))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, begins in group_chunks(batches, "root", "left", "right"):
            out: list[list[np.ndarray]] = [[], [], []]
            node, own, copies = (table[c].to_numpy() for c in ("node", "own", "copies"))
            packed = table["codes"]
            for begin, end in zip(begins[:-1], begins[1:]):
                _, first = np.unique(node[begin:end], return_index=True)
                rows = begin + first  # a repeated row counts once; its copies are in the count
                rows = rows[np.argsort(own[rows], kind="stable")]
                two = table["left"][int(begin)].as_py() != table["right"][int(begin)].as_py()
                n_one = int((own[rows] == own[rows[0]]).sum())
                if two and n_one == len(rows) or len(rows) < 2:
                    continue
                codes = [np.frombuffer(packed[int(r)].as_py(), np.uint64) for r in rows]
                linked = np.zeros(len(rows), np.int64)
                label = np.arange(len(rows))
                for i, j in similar(codes, n_one, two, threshold):
                    np.add.at(linked, i, copies[rows[j]])
                    np.add.at(linked, j, copies[rows[i]])
                    label = settled(len(rows), i, j)
                some = np.flatnonzero(linked)
                for column, values in zip(out, (node[rows][some], linked[some], node[rows][label[some]])):
                    column.append(values)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=["node", "linked", "to"])

    grouped = cut.repartition("root", "left", "right").sortWithinPartitions("root", "left", "right")
    return grouped.mapInArrow(compared, "node long, linked long, to long")


def similarity_classes(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
    recall: float = TARGET_RECALL,
    brute_force: int = BRUTE_FORCE,
) -> DataFrame:
    """``key``, ``content`` (hash of the text), ``class_id`` and ``n_links`` of every document."""
    runs = runs_for(threshold, recall)
    texts = written(described(docs, key, text, runs * DRAWS), "sets")
    nodes = written(
        texts.where("node is not null")
        .groupBy("node")
        .agg(
            F.count("*").alias("copies"),
            F.min("key").alias("first_key"),
            F.first("n").alias("n"),
            F.first("drawn").alias("drawn"),
            F.first("sketch").alias("sketch"),
        ),
        "nodes",
    )
    leaves = buckets(docs, nodes, runs, brute_force, key, text)
    members = components(candidate_links(leaves, nodes, threshold, brute_force))
    links = written(exact_links(docs, members, nodes, key, text, threshold), "links")
    linked = links.groupBy("node").agg(F.sum("linked").alias("linked"))
    roots = components(links.select(F.col("node").alias("a"), F.col("to").alias("b")))
    placed = nodes.join(linked, "node", "left").join(roots, "node", "left").select(
        "node", "copies", "first_key", F.coalesce("linked", F.lit(0)).alias("linked"), F.coalesce("root", "node").alias("root")
    )
    names = placed.groupBy("root").agg(F.min("first_key").alias("class_id"))
    named = written(
        placed.join(names, "root").select(
            "node", "class_id", (F.col("copies") - 1 + F.col("linked")).alias("n_links")
        ),
        "classes",
    )
    named = small(named, MAX_BROADCAST_ROWS)
    return texts.select("key", "content", "node").join(named, "node", "left").select(
        F.col("key").alias(key),
        "content",
        F.when(F.col("node").isNull(), F.col("key")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def one_per_class(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each class: the one with the least id.

    Of repeated rows one stays. A row without an id cannot name a class unless no row of its class
    has an id; else it goes.
    """
    classes = written(similarity_classes(docs, key, text, threshold), "classes")
    first = F.col(key).eqNullSafe(F.col("class_id"))
    per_row = classes.groupBy(key, "content").agg(F.count("*").alias("rows"), F.max(first).alias("stays"))
    rare_key, rare_content, stays = (unused(n, docs) for n in ("rare_key", "rare_content", "stays"))
    rare = per_row.where("not stays or rows > 1").select(
        F.col(key).alias(rare_key), F.col("content").alias(rare_content), F.col("stays").alias(stays)
    )
    rare = small(written(rare, "not-single"), MAX_BROADCAST_ROWS)
    same = F.col(key).eqNullSafe(F.col(rare_key)) & (F.xxhash64(text) == F.col(rare_content))
    single = docs.join(rare, same, "left_anti")
    repeated = docs.join(rare.where(F.col(stays)), same, "left_semi")
    # Texts are compared whole here: a row is dropped only for another one with its id and text.
    return single.unionByName(repeated.dropDuplicates([key, text]))
