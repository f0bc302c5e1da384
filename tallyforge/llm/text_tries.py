"""Exact copies of texts by radix tries, and an audit of how five filters interact.

**Copies.** A compressed trie holds whole texts; its terminal keeps the least id of a text. Each task
first puts its own texts into tries, lot by lot: a row that is not the least of its text is known to
be a copy at once, so a text that a third of all rows share leaves each lot once. The remaining texts
are range-partitioned by prefixes that are as long as needed: a prefix that stands for too many bytes
is replaced by longer ones, until a prefix is light or stands for a single text. Then one trie per prefix
gives the least id of every text in the table.

**Audit.** Every document becomes a mask of the filters it fails. Masks are counted per part of the
table, at most 32 per part; the 120 orders in which five filters can be applied are worked out from
these counts.

Defined results: a null text counts as empty; a null part is named by the empty text; rows without an
id are never copies, nor do others become copies by them; rows with the same id and text are not copies
of each other; several labels of one id count as one that has all of them; an empty table gives no
row. Texts of any length are compared whole. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyforge.llm.tables import written

#: The filters, in the order of their bits, and their limits.
FILTERS = "ABCDE"
MIN_WORDS = 50
MIN_DISTINCT_PERCENT = 65
MAX_CAPITAL_PERCENT = 5
SYMBOLS = b"#$%&*|"
COPY = 1 << FILTERS.index("E")
#: Texts of a task are compared in lots of about so many bytes, with so many bytes added per row.
LOT_BYTES = 32 << 20
ROW_BYTES = 200
#: A prefix that stands for more bytes than this is replaced by longer ones. A trie holds one prefix.
PREFIX_BYTES = 8 << 20
#: A task takes a range of prefixes of about so many bytes, or less where there are idle tasks.
RANGE_BYTES = 128 << 20
#: At most so many prefixes are replaced per round; they stand for at least that share of all bytes each.
MAX_HEAVY = 1_000_000
#: Length of the first prefixes, and how much longer the next ones are.
FIRST_PREFIX, LONGER = 8, 4

_CAPITALS = bytes(range(65, 91))


class Node:
    """An edge of a trie with what follows it; ``rows`` are those of the least id of a text."""

    __slots__ = ("label", "children", "least", "rows")

    def __init__(self, label: bytes):
        self.label = label
        self.children: dict[int, Node] = {}
        self.least = None
        self.rows: dict | None = None


def shared(a: bytes, b: bytes, at: int) -> int:
    """How many bytes of ``a`` agree with ``b`` from ``at`` on; they differ somewhere."""
    low, high = 0, min(len(a), len(b) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if b.startswith(a[low:middle], at + low):
            low = middle
        else:
            high = middle - 1
    return low


class Trie:
    """Texts with the least id of each; larger ids come back as copies."""

    def __init__(self):
        self.root = Node(b"")

    def terminal(self, text: bytes) -> Node:
        """The node at which ``text`` ends, made if there is none."""
        node, at = self.root, 0
        while at < len(text):
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = Node(text[at:])
            elif not text.startswith(child.label, at):
                agreed = shared(child.label, text, at)
                fork = Node(child.label[:agreed])
                child.label = child.label[agreed:]
                fork.children[child.label[0]] = child
                node.children[text[at]] = fork
                child = fork
            node, at = child, at + len(child.label)
        return node

    def insert(self, text: bytes, number, rest, n: int) -> tuple[object, dict] | None:
        """Add ``n`` rows; what is now known to be a copy comes back as its id and its rows."""
        node = self.terminal(text)
        if node.rows is None or number < node.least:
            copies = None if node.rows is None else (node.least, node.rows)
            node.least, node.rows = number, {rest: n}
            return copies
        if number == node.least:
            node.rows[rest] = node.rows.get(rest, 0) + n
            return None
        return number, {rest: n}

    def texts(self) -> Iterator[tuple[bytes, object, dict]]:
        """All texts with their least id and its rows, depth first."""
        open_nodes = [(self.root, b"")]
        while open_nodes:
            node, before = open_nodes.pop()
            text = before + node.label
            if node.rows is not None:
                yield text, node.least, node.rows
            open_nodes.extend((child, text) for child in node.children.values())


def failures(raw: bytes, code_points: int) -> int:
    """Mask of the filters, but for copies, that a text fails."""
    words = raw.split()
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    return (
        (len(words) < MIN_WORDS)
        | (100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words)) << 1
        | (100 * capitals > MAX_CAPITAL_PERCENT * code_points) << 2
        | (len(raw.translate(None, SYMBOLS)) < len(raw)) << 3
    )


class Out:
    """Rows on their way out of a task."""

    def __init__(self, kind: pa.DataType, with_body: bool):
        self.kind, self.with_body = kind, with_body
        self.clear()

    def clear(self) -> None:
        self.columns = [], [], [], [], []
        self.size = 0

    def add(self, number, rows: dict, copies: bool, body: bytes | None = None) -> None:
        for (part, mask), n in rows.items():
            for column, value in zip(self.columns, (number, part, mask | COPY if copies else mask, n, body)):
                column.append(value)
            self.size += ROW_BYTES + len(body or b"")

    def batch(self) -> pa.RecordBatch:
        kinds = (self.kind, pa.string(), pa.int32(), pa.int64(), pa.binary())
        width = 5 if self.with_body else 4
        done = [pa.array(c, k) for c, k in list(zip(self.columns, kinds))[:width]]
        self.clear()
        return pa.RecordBatch.from_arrays(done, names=["id", "part", "mask", "n", "body"][:width])


def settled_and_open(docs: DataFrame, key: str, text: str, part: str) -> DataFrame:
    """Counted rows ``id, part, mask, n``; those whose text may have a smaller id elsewhere carry it."""
    rows = docs.select(
        F.col(key).alias("id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.char_length(text), F.lit(0)).alias("points"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body"),
    )

    def local_tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, trie, filled = None, Trie(), 0

        def flushed() -> Iterator[pa.RecordBatch]:
            for body, least, held in trie.texts():
                out.add(least, held, False, body)
                if out.size > LOT_BYTES // 8:
                    yield out.batch()
            yield out.batch()

        for batch in batches:
            out = out or Out(batch.column("id").type, True)
            for number, where, points, body in zip(*(batch.column(i).to_pylist() for i in range(4))):
                rest = where, failures(body, points)
                if number is None:
                    out.add(None, {rest: 1}, False)
                    continue
                copies = trie.insert(body, number, rest, 1)
                if copies:
                    out.add(*copies, True)
                filled += ROW_BYTES + len(body)
                if filled > LOT_BYTES:
                    yield from flushed()
                    trie, filled = Trie(), 0
            yield out.batch()
        if out:
            yield from flushed()

    kind = dict(rows.dtypes)["id"]
    found = rows.mapInArrow(local_tries, f"id {kind}, part string, mask int, n long, body binary")
    sized = found.withColumn("size", F.octet_length("body")).withColumn("digest", F.xxhash64("body"))
    return written(sized, "trie-rows")


def by_prefix(rows: DataFrame, most: int = PREFIX_BYTES) -> tuple[DataFrame, int]:
    """Rows with a ``prefix`` of their text that stands for about ``most`` bytes, and the bytes of all.

    Heavy prefixes are known by a hash, which costs 8 bytes each; a collision only makes a prefix
    longer than needed.
    """
    weight = F.col("size") + ROW_BYTES
    total = rows.agg(F.sum(weight)).first()[0] or 0
    limit = max(most, total // MAX_HEAVY)
    length, prefix = FIRST_PREFIX, F.substring("body", 1, FIRST_PREFIX)
    rows, still = rows.withColumn("prefix", prefix), F.lit(True)
    pending = rows
    while total > limit:
        crowded = (F.sum(weight) > limit) & (F.min("digest") != F.max("digest"))
        groups = pending.groupBy("prefix").agg(crowded.alias("crowded"))
        heavy = groups.where("crowded").select(F.xxhash64("prefix").alias("code"))
        codes = [r["code"] for r in heavy.collect()]  # at most total / limit
        if not codes:
            break
        known = F.broadcast(rows.sparkSession.createDataFrame([(c,) for c in codes], "code long").withColumn("hot", F.lit(True)))
        length *= LONGER
        longer = F.when(F.col("hot") & (F.length("prefix") < F.col("size")), F.substring("body", 1, length))
        rows = (
            rows.join(known, F.xxhash64("prefix") == F.col("code"), "left")
            .withColumn("prefix", F.coalesce(longer, "prefix"))
            .drop("code", "hot")
        )
        pending = rows.where(F.length("prefix") > length // LONGER)
    return rows, total


def masks(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """Filters that documents fail: ``id``, ``part``, ``mask`` (bits of ``FILTERS``) and ``n`` rows alike."""
    rows = settled_and_open(docs, key, text, part)
    kind = dict(rows.dtypes)["id"]
    names = ("id", "part", "mask", "n")

    def global_tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, trie, current = None, Trie(), None

        def flushed() -> Iterator[pa.RecordBatch]:
            for _, least, held in trie.texts():
                out.add(least, held, False)
                if out.size > LOT_BYTES // 8:
                    yield out.batch()

        for batch in batches:
            out = out or Out(batch.column("id").type, False)
            for number, where, mask, n, body, prefix in zip(*(c.to_pylist() for c in batch.columns)):
                if prefix != current:
                    yield from flushed()
                    trie, current = Trie(), prefix
                copies = trie.insert(body, number, (where, mask), n)
                if copies:
                    out.add(*copies, True)
            yield out.batch()
        if out:
            yield from flushed()
            yield out.batch()

    texts, total = by_prefix(rows.where("body is not null"))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, -(-total // RANGE_BYTES), min(tasks, -(-total // PREFIX_BYTES)))
    dealt = texts.select(*names, "body", "prefix").repartitionByRange(parts, "prefix").sortWithinPartitions("prefix")
    compared = dealt.mapInArrow(global_tries, f"id {kind}, part string, mask int, n long")
    return rows.where("body is null").select(*names).unionByName(compared)


def audit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source"
) -> DataFrame:
    """What every filter does at every step of every order, per part of the table."""
    marks = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("toxic"),
    )
    alike = masks(docs, key, text, part).groupBy("id", "part", "mask").agg(F.sum("n").alias("n"))
    counted = (
        alike.join(marks, "id", "left")
        .groupBy("part", "mask")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
            F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"),
        )
    )
    # At most 32 masks per part.
    parts = counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    orders = F.split(F.lit(" ".join(map("".join, permutations(FILTERS)))), " ")
    steps = (
        parts.select("part", "masks", F.explode(orders).alias("filter_order"))
        .select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
        .withColumn("letter", F.substring("filter_order", F.col("step"), F.lit(1)))
        .withColumn("before", F.substring("filter_order", F.lit(1), F.col("step") - 1))
    )
    for name, letters in (("own", "letter"), ("earlier", "before")):
        bits = sum(F.when(F.contains(F.col(letters), F.lit(f)), 1 << i).otherwise(0) for i, f in enumerate(FILTERS))
        steps = steps.withColumn(name, bits)

    def total(count, keep) -> Column:
        return F.aggregate(
            F.filter("masks", keep), F.lit(0).cast("long"), lambda sum_, m: sum_ + (count(m) if callable(count) else m[count])
        )

    here = lambda m: m["mask"].bitwiseAND(F.col("own")) != 0
    gone = lambda m: m["mask"].bitwiseAND(F.col("earlier")) != 0
    removed = lambda m: here(m) & ~gone(m)
    # A document that fails s filters is removed by each of them in 120 / s of the orders.
    per_order = lambda m: m["n"] * (F.lit(120) / F.bit_count(m["mask"])).cast("long")
    return steps.select(
        "part",
        "filter_order",
        "step",
        total("n", lambda m: ~here(m) & ~gone(m)).alias("kept"),
        total("n", removed).alias("removed"),
        total("n", lambda m: here(m) & gone(m)).alias("redundant"),
        total("n", lambda m: m["mask"] == F.col("own")).alias("unique_fails"),
        total("good", removed).alias("good_lost"),
        total("toxic", removed).alias("toxic_lost"),
        total(per_order, here).alias("shapley"),
    )
