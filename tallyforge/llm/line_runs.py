"""Removal of repeated runs of lines, by a suffix array over line sequences.

Every document is the sequence of its lines that have a word. The suffixes of all sequences are
sorted by distributed prefix doubling: ranks of runs of one line are paired with the ranks of the
runs behind them to give ranks of runs of two, four, eight lines and so on. Positions whose run is
not repeated are settled and drop out, so each round handles only what still has a common prefix
with another suffix; the rounds end when nothing has. The positions of one rank are an interval of
the suffix array.

How many lines a position exactly has in common with an earlier one follows from the stored ranks by
binary lifting. A run of any length between two levels is named by the ranks of two runs of the lower
level that cover it, so whether it also occurs earlier is a grouping by that name; from the highest
level with an earlier copy on, the length is settled bit by bit. Only positions whose run has different
lines before it in its interval are looked at: where all copies agree in the line before, the run that
begins there contains this one. That gives every maximal repeated run.

Deleted are the later copies: a line goes if it lies in a run of lines that also occurs earlier and has
``MIN_RUN_CHARS`` characters or more, whatever the number of its lines. Shorter runs repeat by chance.
Earlier means in a document with a smaller id, or further up in the same document. Lines are compared
by 128 bits of hash.

A line or run that is in a third of all documents is not joined in one task while the intervals are
made: frequent ones are looked up by broadcast.

Defined results: null texts stay null and have no lines; lines without a word are kept and do not
interrupt a run; rows that share id and text are one document and are treated alike; a null id comes
before all others; an empty table gives an empty result; a text of more than 2^24 lines with a word is an
error.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StringType

from tallyforge.llm.tables import discard, join_weighted, small, written

#: A repeated run must have so many characters, line ends not counted, to be deleted.
MIN_RUN_CHARS = 40
NOT_BLANK = r"[^\x20\x09-\x0D]"
#: Bits of a line's number in its document, and of the length of a run.
LINE_BITS = 24
MAX_ROUNDS = LINE_BITS
MAX_BROADCAST_ROWS = 200_000


def ranked(groups: DataFrame, *keys: str) -> tuple[DataFrame, int]:
    """``groups`` with ``rank``, their place in the order of ``keys``, and the sum of their column ``n``.

    Each group is given once. Sorted by range partitions; only the sizes of the partitions, one number
    each, are added up by the driver.
    """
    ordered = groups.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered = written(
        ordered.select(
            "*",
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("nth"),
        ),
        "ranked",
    )
    sizes = ordered.groupBy("part").agg(F.count("*").alias("rows"), F.sum("n").alias("n")).collect()
    offsets, before = [], 0
    for size in sorted(sizes):
        offsets.append((size["part"], before))
        before += size["rows"]
    known = groups.sparkSession.createDataFrame(offsets, "part int, offset long")
    named = ordered.join(F.broadcast(known), "part").select(  # one row per partition
        *groups.columns, (F.col("offset") + F.col("nth")).alias("rank")
    )
    return named, sum(size["n"] for size in sizes)


def identified(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(
        F.col(key).alias("key"), F.xxhash64(text).alias("content"), F.col(text).alias("body")
    )


def line_table(rows: DataFrame) -> DataFrame:
    """Every line with a word: document, place among such lines, characters and hash."""
    lines = F.filter(F.split("body", "\n"), lambda x: x.rlike(NOT_BLANK))
    too_long = F.raise_error(F.lit(f"a text has more than {1 << LINE_BITS} lines")).cast("int")
    return rows.select("key", "content", F.posexplode(lines).alias("at", "line")).select(
        "key",
        "content",
        F.when(F.col("at") < 1 << LINE_BITS, F.col("at")).otherwise(too_long).alias("at"),
        F.xxhash64("line").alias("one"),
        F.xxhash64("line", F.lit("line")).alias("two"),
        F.length("line").alias("chars"),
    )


def repeated_lines(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Lines that occur more than once, by position, and the documents they are in.

    A position is a document number and a line number of 24 bits. First table: ``pos``, the line's hashes,
    ``chars``, ``upto``, the characters of repeated lines of the document up to this one, and ``left``, a hash of
    the line before if that is repeated as well, else of the position. Second table: ``key``, ``content`` and
    ``number`` of each document that has such a line.
    """
    lines = line_table(identified(docs, key, text))
    groups = written(lines.groupBy("one", "two").agg(F.count("*").alias("n")).where("n > 1"), "line-groups")
    shared = written(join_weighted(lines, groups, "one", "two"), "shared-lines")
    per_document = shared.groupBy("key", "content").agg(F.count("*").alias("n"))
    numbers = ranked(per_document, "key", "content")[0].select("key", "content", F.col("rank").alias("number"))
    numbers = written(numbers, "numbers")
    near = small(numbers, MAX_BROADCAST_ROWS)
    same = shared["key"].eqNullSafe(near["key"]) & (shared["content"] == near["content"])
    so_far = Window.partitionBy(F.shiftright("pos", LINE_BITS)).orderBy("pos")  # the lines of one document
    before = [F.lag(c).over(so_far) for c in ("pos", "one", "two")]
    placed = (
        shared.join(near, same)
        .select((F.col("number") * (1 << LINE_BITS) + F.col("at")).alias("pos"), "one", "two", "chars")
        .distinct()
        .withColumn("upto", F.sum("chars").over(so_far))
        .withColumn("left", F.when(before[0] == F.col("pos") - 1, F.xxhash64(*before[1:])).otherwise(F.xxhash64("pos")))
    )
    return written(placed, "positions"), numbers


def intervals(positions: DataFrame) -> list[DataFrame]:
    """The suffix array's intervals of repeated runs of 1, 2, 4 … lines, one table each.

    Columns: ``lines`` (1, 2, 4 …), ``name`` (the run's rank among those of its length, made unique), ``pos``,
    ``left``, ``first`` (the earliest position of the run) and ``diverse`` (not all its positions have the same
    line before them).

    What differs from round to round is a column, not a constant, so that all rounds share their compiled code.
    """
    levels: list[DataFrame] = []
    active = positions.select("pos", "left", "one", "two", F.lit(1).cast("long").alias("lines"))
    for level in range(MAX_ROUNDS):
        found = active.groupBy("one", "two").agg(
            F.count("*").alias("n"), F.min("pos").alias("first"), (F.min("left") < F.max("left")).alias("diverse")
        )
        names, total = ranked(found.where("n > 1"), "one", "two")
        if not total:
            break
        interval = written(
            join_weighted(active, names, "one", "two", total=total).select(
                "lines",
                (F.col("rank") * (1 << LINE_BITS) + F.col("lines")).alias("name"),
                "pos",
                "left",
                "first",
                "diverse",
            ),
            "intervals",
        )
        if level:
            discard(active)
        levels.append(interval)
        behind = interval.select((F.col("pos") - F.col("lines")).alias("pos"), F.col("name").alias("two"))
        own = interval.select("pos", "left", F.col("name").alias("one"), (2 * F.col("lines")).alias("lines"))
        active = written(own.join(behind, "pos"), "runs")
    return levels


def longest_runs(levels: list[DataFrame]) -> DataFrame:
    """``pos`` and ``size`` of the longest run from a position on that also occurs earlier.

    Positions whose run is part of the one from the position before are left out.
    """
    union = levels[0]
    for interval in levels[1:]:
        union = union.unionByName(interval)
    # One table: the rounds read it several times each.
    every = written(union.select("lines", "name", "pos", "first", "diverse"), "all-intervals")
    for interval in levels:
        discard(interval)
    highest = F.max(F.struct("lines", "name", "diverse"))
    tops = every.where("first < pos").groupBy("pos").agg(highest.alias("top")).where("top.diverse")
    # ``jump``: by how many lines the run may still be longer, at the next try.
    half = F.shiftright("top.lines", 1)
    state = written(tops.select("pos", "top.name", F.col("top.lines").alias("size"), half.alias("jump")), "longest")
    for step in range(1, len(levels)):
        live = every.where(F.col("lines") >= 1 << step)  # shorter runs are settled
        asked = state.where("jump > 0").select("name", (F.col("size") + F.col("jump")).alias("wanted")).distinct()
        # All positions of an asked run, with the lower run that ends where the wanted one does.
        ends = live.select("lines", F.col("pos").alias("tail"), F.col("name").alias("end_name"))
        held = written(
            live.select("name", "lines", "pos")
            .join(asked, "name")
            .withColumn("tail", F.col("pos") + F.col("wanted") - F.col("lines"))
            .join(ends, ["lines", "tail"])
            .select("pos", "name", "wanted", "end_name"),
            "held",
        )
        run = ["name", "wanted", "end_name"]
        firsts = held.groupBy(*run).agg(F.min("pos").alias("first"), F.count("*").alias("n")).where("n > 1")
        reached = held.join(firsts, run).where("first < pos").select("pos", F.col("wanted").alias("reached"))
        # A position may have been asked for other lengths by the other positions of its run.
        own = (state["pos"] == reached["pos"]) & (F.col("reached") == F.col("size") + F.col("jump"))
        grown = state.join(reached, own, "left").select(
            state["pos"], "name", F.coalesce("reached", "size").alias("size"), F.shiftright("jump", 1).alias("jump")
        )
        following = written(grown, "longest")
        discard(state)
        discard(held)
        state = following
    discard(every)
    return state.select("pos", "size")


def deletions(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document with deleted lines: ``key``, ``content``, the maximal ``runs`` and ``longest``.

    ``runs`` is an array of first and last line, counting lines that have a word, of the runs that have an
    earlier copy and enough characters and are not part of a longer one; they may overlap. ``longest`` is
    the length of the longest, ``lines`` the number of lines in any of them.
    """
    positions, numbers = repeated_lines(docs, key, text)
    levels = intervals(positions)
    if not levels:
        nothing = numbers.select("key", "content", F.lit(None).cast("array<struct<first:long,last:long>>").alias("runs"))
        return nothing.withColumns({c: F.lit(0).cast("long") for c in ("longest", "lines")}).limit(0)
    runs = longest_runs(levels).withColumn("tail", F.col("pos") + F.col("size") - 1)
    begins = positions.select("pos", (F.col("upto") - F.col("chars")).alias("before"))
    ends = positions.select(F.col("pos").alias("tail"), "upto")
    deleted = runs.join(begins, "pos").join(ends, "tail").where(F.col("upto") - F.col("before") >= MIN_RUN_CHARS)
    line = lambda name: F.col(name).bitwiseAND((1 << LINE_BITS) - 1)
    in_order = Window.partitionBy("number").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("last").over(in_order), F.lit(-1))
    # A run that ends no later than one that begins before it is part of that one.
    maximal = (
        deleted.select(F.shiftright("pos", LINE_BITS).alias("number"), line("pos").alias("first"), line("tail").alias("last"))
        .withColumn("reached", reached)
        .where("last > reached")
    )
    fresh = F.col("last") - F.greatest(F.col("reached"), F.col("first") - 1)
    per_document = maximal.groupBy("number").agg(
        F.sort_array(F.collect_list(F.struct("first", "last"))).alias("runs"),
        F.max(F.col("last") - F.col("first") + 1).alias("longest"),
        F.sum(fresh).alias("lines"),
    )
    return written(per_document.join(numbers, "number").select("key", "content", "runs", "longest", "lines"), "deletions")


@F.pandas_udf(StringType())
def without_runs(texts: pd.Series, firsts: pd.Series, lasts: pd.Series) -> pd.Series:
    """Texts without the lines of the given runs; other lines are joined as they were."""

    def cut(text: str, first: Iterator[int], last: Iterator[int]) -> str:
        kept, at, spans = [], -1, iter(zip(first, last))
        begin, end = next(spans)
        for line in text.split("\n"):
            if line.strip(" \t\n\x0b\x0c\r"):
                at += 1
                while at > end:
                    begin, end = next(spans, (1 << 62, 1 << 62))
                if begin <= at:
                    continue
            kept.append(line)
        return "\n".join(kept)

    return pd.Series([None if t is None else cut(t, f, e) for t, f, e in zip(texts, firsts, lasts)], dtype=object)


def drop_repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the later copies of repeated lines gone from ``text``, and what was deleted.

    New columns: ``removed_runs``, ``n_removed`` and ``longest_run`` (0 where nothing is deleted).
    """
    gone = deletions(docs, key, text)
    near = small(gone, MAX_BROADCAST_ROWS)
    added = ("removed_runs", "n_removed", "longest_run")
    kept = [c for c in docs.columns if c not in added]
    rows = docs.select(F.struct(*kept).alias("row"), F.col(key).alias("key"), F.xxhash64(text).alias("content"))
    joined = rows.join(near, rows["key"].eqNullSafe(near["key"]) & (rows["content"] == near["content"]), "left")
    hit = F.col("runs").isNotNull()
    parts = lambda name: F.transform("runs", lambda r: r[name])
    cut = without_runs(F.when(hit, F.col("row")[text]), parts("first"), parts("last"))
    joined = joined.select("row", "runs", "longest", "lines", F.when(hit, cut).otherwise(F.col("row")[text]).alias("cut"))
    columns = [F.col("cut").alias(c) if c == text else F.col("row")[c].alias(c) for c in kept]
    return joined.select(
        *columns,
        F.coalesce("runs", F.array()).alias("removed_runs"),
        F.coalesce("lines", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("longest", F.lit(0)).cast("long").alias("longest_run"),
    )
