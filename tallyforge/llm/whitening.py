"""Principal components and whitening of embeddings, from exact integer arithmetic.

Entries are put on a grid of 64ths, so that the scatter matrix of the distinct vectors is a matrix of
integers, summed exactly: ``n * sum(x x') - S S'``, which is ``n^2`` times the covariance and does not
depend on any constant added to all entries. ``exact_spectrum`` takes it from there. Partial sums are
split into limbs of 40 bits, which Spark adds up as ordinary numbers.

Defined results: rows without a vector, or with an entry that is null, not finite or too large for a
long on the grid, are left out, and so are rows whose vector has another length than most of the distinct
vectors (of two equally frequent lengths, the greater counts). Repeated vectors count once in the fit and
get their own rows in the result. A component without variance, as all are for a single vector, has
null ``whitened`` values and explains 0 (null if there is no variance at all); ``deviation`` is null beyond
the range of a long. No remaining row gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyforge.llm.exact_spectrum import FRACTION_BITS, largest_components
from tallyforge.llm.tables import written

#: Grid steps per unit, and how many components are kept.
GRID = 64
COMPONENTS = 16
#: Grid numbers are below this.
MAX_NUMBER = 1 << 62
#: Rows whose products are summed at once; with entries of ``DIGIT`` bits the sums stay exact.
LOT_ROWS = 1000
DIGIT_BITS = 20
LIMB_BITS = 40


def on_grid(embeddings: DataFrame, key: str, vector: str) -> DataFrame:
    """Usable rows as ``key`` and ``x``, the vector in whole grid steps."""
    entries = F.col(vector)
    usable = F.forall(entries, lambda c: F.abs(c.cast("double") * GRID) < float(MAX_NUMBER))
    return embeddings.where(entries.isNotNull() & F.coalesce(usable, F.lit(False))).select(
        F.col(key).alias("key"), F.transform(entries, lambda c: F.floor(c.cast("double") * GRID).cast("long")).alias("x")
    )


def matrix_of(column: pa.Array, d: int) -> np.ndarray:
    """Lists of equal length as the rows of a matrix."""
    return np.asarray(column.flatten()).reshape(-1, d)


def exact_products(x: np.ndarray) -> np.ndarray:
    """``x' x`` in whole numbers of any size, for at most ``LOT_ROWS`` rows."""
    digits, rest = [], x
    while len(digits) < 3 and np.abs(rest).max(initial=0) >= 1 << DIGIT_BITS:
        digits.append(rest & ((1 << DIGIT_BITS) - 1))
        rest = rest >> DIGIT_BITS
    digits = [part.astype(np.float64) for part in [*digits, rest]]
    total = np.zeros((x.shape[1],) * 2, object)
    for i, a in enumerate(digits):
        for j, b in enumerate(digits):
            total += (a.T @ b).astype(np.int64).astype(object) * (1 << (DIGIT_BITS * (i + j)))
    return total


def limbs(value: int) -> Iterator[tuple[int, int]]:
    """A number as (place, part): ``value`` is the sum of part times 2^(40 place)."""
    place = 0
    while not -(1 << LIMB_BITS) <= value < 1 << LIMB_BITS:
        yield place, value & ((1 << LIMB_BITS) - 1)
        value >>= LIMB_BITS
        place += 1
    yield place, value


def scatter(fit: DataFrame, d: int) -> tuple[int, list[int], list[list[int]]]:
    """Number of vectors, their sums, and ``n^2`` times their covariance, all exact."""

    def partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(d, object), np.zeros((d, d), object)
        for batch in batches:
            for at in range(0, batch.num_rows, LOT_ROWS):
                x = matrix_of(batch.column("x").slice(at, LOT_ROWS), d)
                n += len(x)
                sums += x.astype(object).sum(0)
                products += exact_products(x)
        if not n:
            return
        cells = [(-1, -1, n)] + [(-1, i, int(v)) for i, v in enumerate(sums)]
        cells += [(i, j, int(products[i, j])) for i in range(d) for j in range(i, d)]
        rows = [(i, j, place, part) for i, j, value in cells for place, part in limbs(value)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int32(), pa.int64()))],
            names=["i", "j", "place", "part"],
        )

    sums = fit.mapInArrow(partial_sums, "i int, j int, place int, part long").groupBy("i", "j", "place")
    cells: dict[tuple[int, int], int] = {}
    for row in sums.agg(F.sum("part").alias("part")).collect():  # a few per cell of the matrix
        cell = row["i"], row["j"]
        cells[cell] = cells.get(cell, 0) + (row["part"] << (LIMB_BITS * row["place"]))
    n, total = cells[-1, -1], [cells[-1, i] for i in range(d)]
    matrix = [[n * cells[min(i, j), max(i, j)] - total[i] * total[j] for j in range(d)] for i in range(d)]
    return n, total, matrix


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n x - S``, exact; as Python numbers where 64 bits do not hold it."""
    largest = max(int(np.abs(x).max(initial=0)) * n, max(map(abs, sums)))
    if largest < 1 << 61:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def squares(y: np.ndarray) -> pa.Array:
    """Sum of squares of every row, exact; null beyond the range of a long."""
    d = y.shape[1]
    if y.dtype != object and int(np.abs(y).max(initial=0)) ** 2 * d < 1 << 63:
        return pa.array((y * y).sum(1))
    sums = (y.astype(object) ** 2).sum(1)
    return pa.array([int(v) if v < 1 << 63 else None for v in sums], pa.int64())


def whiten(
    embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """One row per usable row and component.

    Columns: ``key``, ``component`` (from 1, by falling variance), ``n`` distinct vectors, ``deviation``
    (sum of squares of ``n x - S``), ``whitened``, ``explained`` and ``identity_error``, the largest entry by
    which the covariance of the whitened fit list departs from the identity (components without
    variance left out).
    """
    spark = embeddings.sparkSession
    rows = on_grid(embeddings, key, vector)
    kind = dict(rows.dtypes)["key"]
    schema = (
        f"key {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    fit = written(rows.select("x").distinct(), "fit-list")
    lengths = fit.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None or lengths["d"] == 0:
        return spark.createDataFrame([], schema).withColumnRenamed("key", key)
    d = lengths["d"]
    fit = fit.where(F.size("x") == d)
    n, sums, matrix = scatter(fit, d)
    trace = sum(matrix[i][i] for i in range(d))
    found = largest_components(spark, matrix, components)
    scale = 1 << FRACTION_BITS
    spread = [float(Fraction(root, scale)) for root, _ in found]
    explained = [float(Fraction(root, scale * trace)) if trace else None for root, _ in found]
    base = np.array([v for _, v in found]).T
    # The root is n^2 e, and n x - S is n times the centred x, so the n cancel.
    base = base / np.sqrt(np.where(np.array(spread) > 0, spread, np.nan))
    alive = int(np.isfinite(base[0]).sum())

    def whitened(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        y = centred(matrix_of(column, d), n, sums)
        return y, y.astype(np.float64) @ base

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((alive + 1, alive + 1))
        for batch in batches:
            w = whitened(batch.column("x"))[1][:, :alive]
            w = np.column_stack([np.ones(len(w)), w])
            total += w.T @ w
        i, j = np.triu_indices(alive + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "v"]
        )

    error = None
    if alive:
        # Rows are centred before they are multiplied; what is left of their mean is taken off as well.
        second = np.zeros((alive + 1, alive + 1))
        for r in fit.mapInArrow(moments, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
            second[r["i"], r["j"]] = second[r["j"], r["i"]] = r["v"] / n
        covariance = second[1:, 1:] - np.outer(second[0, 1:], second[0, 1:])
        error = float(np.abs(covariance - np.eye(alive)).max())

    def transformed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many = base.shape[1]
        for batch in batches:
            m = batch.num_rows
            y, w = whitened(batch.column("x"))
            each = pa.array(np.repeat(np.arange(m), many))
            values = w.ravel()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key").take(each),
                    pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * many, n)),
                    squares(y).take(each),
                    pa.array(values, mask=np.isnan(values)),
                    pa.array(explained * m, pa.float64()),
                    pa.array([error] * (m * many), pa.float64()),
                ],
                names=["key", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.where(F.size("x") == d).mapInArrow(transformed, schema).withColumnRenamed("key", key)
