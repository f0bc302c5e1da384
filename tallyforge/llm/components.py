"""Connected components of an edge table, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyforge.llm import tables
from tallyforge.llm.tables import discard, join_weighted, written


def looked_up(rows: DataFrame, table: DataFrame, key: str, edges: int) -> DataFrame:
    """``rows`` with the column ``m`` of ``table``; heavy keys apart if there are enough edges for any."""
    if edges < tables.HEAVY_ROWS:
        return rows.join(table.drop("n"), key)
    return join_weighted(rows, written(table, "degrees"), key)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``a``, ``b`` pairs in, (``node``, ``root``) out: the least node of each node's component.

    Roots are listed as well; nodes without an edge are not. Every round replaces neighbours by the
    least node in reach, first from each node to its larger neighbours, then to its smaller ones;
    both steps are aggregations and joins by node, so no neighbourhood is gathered. A node with very
    many neighbours is looked up by broadcast, and its edges stay where they are.
    """
    edges = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    seen = None
    for _ in range(max_rounds):
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38)"))).first()
        if mark == seen:
            break
        seen = mark
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("n"))
        # To larger neighbours; the table holds each edge once, from its larger end.
        ends = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        large = looked_up(ends, least.withColumnRenamed("a", "u"), "u", mark[0])
        large = written(large.select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct(), "large")
        parent = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        small = looked_up(large, parent, "a", mark[0]).select(F.col("b").alias("a"), F.col("m").alias("b"))
        following = small.where("a <> b").unionByName(parent.select("a", F.col("m").alias("b"))).distinct()
        following = written(following, "edges")
        discard(edges)
        discard(large)
        edges = following
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
