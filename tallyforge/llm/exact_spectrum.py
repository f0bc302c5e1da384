"""Largest eigenvalues of an integer scatter matrix and their vectors, from its exact characteristic polynomial.

The polynomial is computed modulo many primes by reduction to Hessenberg form, one prime per row of a
Spark table, and put together by Chinese remaindering; its coefficients are bounded by the trace, so
the result is exact. All its roots are real, so by Descartes' rule the sign changes of the polynomial
moved to a point count the roots beyond it, with multiplicity. Bisection on these counts isolates the
largest roots, and bisection on signs refines each of them to ``FRACTION_BITS`` binary places. Vectors
come from inverse iteration in decimal arithmetic on the matrix less its root.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Context, Decimal, localcontext
from math import prod

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

#: The exact polynomial takes about the fourth power of this in time; wider vectors are refused.
MAX_DIMENSIONS = 512
#: Binary places of the roots; roots that still agree then are taken for a repeated one.
FRACTION_BITS = 128
#: Decimal digits of the linear systems beyond those of the matrix.
GUARD_DIGITS = 80

Matrix = list[list[int]]


def is_prime(n: int) -> bool:
    """Miller and Rabin's test; these bases decide it for all numbers below 3.4e14."""
    if n < 2 or any(n % p == 0 for p in (2, 3, 5, 7, 11, 13, 17)):
        return n in (2, 3, 5, 7, 11, 13, 17)
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7, 11, 13, 17):
        x = pow(base, odd, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_beyond(product: int) -> list[int]:
    """The largest primes below 2^31 whose product exceeds a number."""
    found, n, reached = [], (1 << 31) - 1, 1
    while reached <= product:
        if is_prime(n):
            found.append(n)
            reached *= n
        n -= 2
    return found


def polynomial_modulo(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of the characteristic polynomial modulo a prime below 2^31, constant first."""
    h = matrix % p
    d = len(h)
    for k in range(d - 2):
        below = np.flatnonzero(h[k + 1 :, k])
        if not len(below):
            continue
        r = k + 1 + below[0]
        h[[k + 1, r]] = h[[r, k + 1]]
        h[:, [k + 1, r]] = h[:, [r, k + 1]]
        times = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - times[:, None] * h[k + 1]) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * times % p).sum(1)) % p
    # Leading minors of x - h, each from those before it.
    minors = np.zeros((d + 1, d + 1), np.int64)
    minors[0, 0] = 1
    for k in range(1, d + 1):
        weights, chain = np.zeros(k, np.int64), 1
        for i in range(k - 1, -1, -1):
            weights[i] = int(h[i, k - 1]) * chain % p
            chain = chain * int(h[i, i - 1]) % p if i else 0
        minors[k, 1:] = minors[k - 1, :-1]
        minors[k] = (minors[k] - (weights[:, None] * minors[:k] % p).sum(0)) % p
    return minors[d]


def characteristic_polynomial(spark: SparkSession, matrix: Matrix) -> list[int]:
    """Exact coefficients, constant first, of a positive semidefinite integer matrix."""
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    # The elementary symmetric functions of nonnegative roots sum to at most (1 + trace / d) ^ d.
    bound = (trace // d + 2) ** d
    primes = primes_beyond(2 * bound)

    def images(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact = np.array(matrix, object)
        for batch in batches:
            chosen = batch.column("prime").to_pylist()
            rows = [polynomial_modulo((exact % p).astype(np.int64), p).tolist() for p in chosen]
            yield pa.RecordBatch.from_arrays([batch.column("prime"), pa.array(rows, pa.list_(pa.int64()))], names=["prime", "image"])

    table = spark.createDataFrame([(p,) for p in primes], "prime long")
    tasks = min(len(primes), spark.sparkContext.defaultParallelism)
    found = table.repartition(tasks, "prime").mapInArrow(images, "prime long, image array<long>").collect()
    whole = prod(primes)
    total = [0] * (d + 1)
    for row in found:
        others = whole // row["prime"]
        unit = others * pow(others, -1, row["prime"])
        total = [t + unit * c for t, c in zip(total, row["image"])]
    return [c - whole if (c := t % whole) > whole // 2 else c for t in total]


def roots_beyond(coefficients: list[int], place: int, bits: int) -> int:
    """How many roots, all of them real, exceed ``place / 2^bits``."""
    d = len(coefficients) - 1
    moved = [c << (bits * (d - i)) for i, c in enumerate(coefficients)]
    for i in range(d):
        for j in range(d - 1, i - 1, -1):
            moved[j] += place * moved[j + 1]
    signs = [c > 0 for c in moved if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def sign_at(coefficients: list[int], place: int, bits: int) -> int:
    value = 0
    d = len(coefficients) - 1
    for i in range(d, -1, -1):
        value = value * place + (coefficients[i] << (bits * (d - i)))
    return (value > 0) - (value < 0)


def largest_roots(coefficients: list[int], many: int, bits: int = FRACTION_BITS) -> list[tuple[int, int]]:
    """The largest roots as (numerator over ``2^bits``, multiplicity), falling, at least ``many`` if there are.

    The polynomial is monic with only real roots, none of them negative.
    """
    zeros = next(i for i, c in enumerate(coefficients) if c)
    rest = coefficients[zeros:]
    found: list[tuple[int, int]] = []
    have = 0
    if len(rest) > 1:
        top = (-rest[-2]).bit_length() + 1  # the roots sum to this coefficient
        # Intervals (low, high] as numerators over 2^depth, with the roots beyond each end; the highest last.
        waiting = [(0, 1 << top, 0, len(rest) - 1, 0)]
        while waiting and have < many:
            low, high, depth, beyond_low, beyond_high = waiting.pop()
            count = beyond_low - beyond_high
            if count == 0:
                continue
            if count == 1:
                found.append((refined(rest, low, high, depth, beyond_high, bits), 1))
                have += 1
                continue
            if high - low == 1 and depth == bits:
                found.append((high, count))
                have += count
                continue
            if high - low == 1:
                low, high, depth = low * 2, high * 2, depth + 1
            middle = (low + high) // 2
            beyond = roots_beyond(rest, middle, depth)
            waiting.append((low, middle, depth, beyond_low, beyond))
            waiting.append((middle, high, depth, beyond, beyond_high))
    if have < many and zeros:
        found.append((0, zeros))
    return found


def refined(coefficients: list[int], low: int, high: int, depth: int, beyond: int, bits: int) -> int:
    """The only root in ``(low, high]``, to ``bits`` binary places; ``beyond`` roots are larger."""
    while depth < bits or high - low > 1:
        if high - low == 1:
            low, high, depth = low * 2, high * 2, depth + 1
        middle = (low + high) // 2
        sign = sign_at(coefficients, middle, depth)
        if sign == 0:
            return middle << (bits - depth)
        if sign == (-1) ** (beyond + 1):  # one more root than beyond ``high`` lies beyond the middle
            low = middle
        else:
            high = middle
    return high


def null_vectors(matrix: Matrix, root: int, bits: int, many: int) -> list[list[float]]:
    """Orthonormal vectors that the matrix takes to ``root / 2^bits`` times themselves.

    Each vector's largest entry, the first of equals, is positive.
    """
    d = len(matrix)
    digits = len(str(max(abs(v) for row in matrix for v in row) + 1)) + bits * 3 // 10
    with localcontext(Context(prec=digits + GUARD_DIGITS)):
        shift = Decimal(root) / (Decimal(2) ** bits)
        rows = [[Decimal(v) - shift if i == j else Decimal(v) for j, v in enumerate(row)] for i, row in enumerate(matrix)]
        tiny = Decimal(10) ** -(digits // 2)
        order = list(range(d))
        lower: list[list[Decimal]] = [[] for _ in range(d)]
        for k in range(d):
            best = max(range(k, d), key=lambda i: abs(rows[i][k]))
            for swapped in (rows, order, lower):
                swapped[k], swapped[best] = swapped[best], swapped[k]
            if abs(rows[k][k]) < tiny:  # the root is exact here
                rows[k][k] = tiny
            for i in range(k + 1, d):
                times = rows[i][k] / rows[k][k]
                lower[i].append(times)
                if times:
                    above = rows[k]
                    rows[i][k:] = [v - times * a for v, a in zip(rows[i][k:], above[k:])]

        def solved(right: list[Decimal]) -> list[Decimal]:
            out = [right[i] for i in order]
            for i in range(d):
                out[i] -= sum((t * v for t, v in zip(lower[i], out)), Decimal(0))
            for i in range(d - 1, -1, -1):
                out[i] = (out[i] - sum((a * v for a, v in zip(rows[i][i + 1 :], out[i + 1 :])), Decimal(0))) / rows[i][i]
            return out

        def unit(vector: list[Decimal], others: list[list[Decimal]]) -> list[Decimal]:
            for other in others:
                along = sum(a * b for a, b in zip(vector, other))
                vector = [a - along * b for a, b in zip(vector, other)]
            length = sum(a * a for a in vector).sqrt()
            return [a / length for a in vector]

        draw = np.random.default_rng(7)
        basis = [[Decimal(int(v)) for v in draw.integers(1, 1 << 30, d)] for _ in range(many)]
        for _ in range(3):
            fresh: list[list[Decimal]] = []
            for vector in basis:
                fresh.append(unit(solved(vector), fresh))
            basis = fresh
        out = []
        for vector in basis:
            largest = max(vector, key=abs)
            out.append([float(v.copy_negate() if largest < 0 else v) for v in vector])
    return out


def largest_components(spark: SparkSession, matrix: Matrix, many: int) -> list[tuple[int, list[float]]]:
    """The ``many`` largest eigenvalues, as numerators over ``2^FRACTION_BITS``, with unit vectors.

    The matrix is symmetric, positive semidefinite and integer. Each root's vectors are one Spark row.
    """
    d = len(matrix)
    if d > MAX_DIMENSIONS:
        raise ValueError(f"vectors of {d} entries; at most {MAX_DIMENSIONS} are supported")
    many = min(many, d)
    roots = largest_roots(characteristic_polynomial(spark, matrix), many)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column("place").to_pylist()
            rows = [null_vectors(matrix, roots[i][0], FRACTION_BITS, min(roots[i][1], many)) for i in places]
            yield pa.RecordBatch.from_arrays(
                [batch.column("place"), pa.array(rows, pa.list_(pa.list_(pa.float64())))], names=["place", "vectors"]
            )

    table = spark.createDataFrame([(i,) for i in range(len(roots))], "place int")
    done = table.repartition(len(roots), "place").mapInArrow(vectors, "place int, vectors array<array<double>>").collect()
    found = [(roots[r["place"]][0], v) for r in sorted(done, key=lambda r: r["place"]) for v in r["vectors"]]
    return found[:many]
