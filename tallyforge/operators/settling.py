"""k-means that looks again only at rows whose cluster may still change.

The rounds are Lloyd's, as in MLlib. What a round needs of a cluster is the number and the sum of its rows.
A row whose second nearest centre is farther away than its nearest by more than twice ``reach`` keeps its
cluster while no centre moves by more than ``reach``; such rows are settled, their sums are kept, and the
next rounds read the others alone. If a centre moves farther, all rows are read again.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import ExitStack
from dataclasses import dataclass

import numpy as np
from pyspark import RDD, SparkContext
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.mllib.common import _py2java
from pyspark.mllib.linalg import Vectors
from pyspark.sql import DataFrame

from tallyforge.operators.blocks import Block, freeze, join_blocks, kept, pack, per_task, regroup, thaw

# Larger fits are left to MLlib: a task holds the sums of all clusters, and a row is compared with every centre.
MAX_CENTERS = 64
MAX_SUMS = 100_000
# Fewer rows than this are read again as quickly as they are told apart.
FEW_ROWS = 200_000
# How far centres may yet move, as multiples of the last move, and the share of rows worth reading alone.
REACHES = (4.0, 8.0, 16.0, 32.0, 64.0)
WORTH = 0.25
# Rounding of a distance, relative to the length of the vectors; errs towards rows that are not settled.
SLACK = 1e-7


@dataclass
class Sums:
    """Per cluster: rows, sum of vectors, sum of squared lengths; and how many rows each reach leaves open."""

    rows: np.ndarray
    vectors: np.ndarray
    squares: np.ndarray
    open: np.ndarray

    def __add__(self, other: Sums) -> Sums:
        return Sums(
            self.rows + other.rows, self.vectors + other.vectors, self.squares + other.squares, self.open + other.open
        )

    def less(self, other: Sums) -> Sums:
        return Sums(self.rows - other.rows, self.vectors - other.vectors, self.squares - other.squares, 0 * self.open)


@dataclass
class Level:
    """Rows that may change their cluster while no centre is farther than ``reach`` from where it was."""

    blocks: RDD
    centers: np.ndarray | None
    reach: float
    settled: Sums | None

    def holds(self, centers: np.ndarray) -> bool:
        return self.centers is None or float(np.linalg.norm(centers - self.centers, axis=1).max()) <= self.reach


def distances(block: Block, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances of rows to centres, and the squared lengths of the rows."""
    found, squares = np.empty((len(centers), len(block))), np.zeros(len(block))
    filled, pos = np.flatnonzero(block.count), block.pos.astype(np.intp)
    starts = block.starts()[filled]
    if len(filled):
        squares[filled] = np.add.reduceat(block.value * block.value, starts)
    for to, center in zip(found, centers):
        to[:] = squares + (center * center).sum()
        if len(filled):
            to[filled] -= 2 * np.add.reduceat(np.take(center, pos) * block.value, starts)
    return np.maximum(found, 0.0).T, squares


def margins(found: np.ndarray, squares: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """How much farther the second nearest centre is than the nearest, rounding taken off."""
    if found.shape[1] == 1:
        return np.full(len(found), np.inf)
    two = np.sqrt(np.partition(found, 1, axis=1)[:, :2])
    return two[:, 1] - two[:, 0] - SLACK * np.sqrt(squares + (centers * centers).sum(axis=1).max())


def _summed(centers: np.ndarray, reaches: np.ndarray):
    k, width = centers.shape

    def work(blocks: Iterator[Block]) -> Sums:
        total = Sums(np.zeros(k, np.int64), np.zeros((k, width)), np.zeros(k), np.zeros(len(reaches), np.int64))
        for block in blocks:
            found, squares = distances(block, centers)
            nearest = found.argmin(axis=1)
            at = np.repeat(nearest, block.count) * width + block.pos
            vectors = np.bincount(at, weights=block.value, minlength=k * width).reshape(k, width)
            near = np.sort(margins(found, squares, centers)) if len(reaches) else np.zeros(0)
            total += Sums(
                np.bincount(nearest, minlength=k),
                vectors,
                np.bincount(nearest, weights=squares, minlength=k),
                np.searchsorted(near, 2 * reaches, side="right"),
            )
        return total

    return work


def _sums(blocks: RDD, centers: np.ndarray, reaches: np.ndarray = np.zeros(0)) -> Sums:
    """Added up in the order of the tasks, so that the same clusters always give the same centres."""
    first, *others = per_task(blocks, _summed(centers, reaches)).collect()
    return sum(others, first)


def _open(blocks: RDD, centers: np.ndarray, reach: float) -> RDD:
    """The rows that are not settled."""

    def still(frozen: Iterator[bytes]) -> Iterator[bytes]:
        def some() -> Iterator[Block]:
            for block in map(thaw, frozen):
                rows = np.flatnonzero(margins(*distances(block, centers), centers) <= 2 * reach)
                if len(rows):
                    yield block.take(rows)

        return map(freeze, regroup(some()))

    return blocks.mapPartitions(still)


def _draw(blocks: RDD, seed: int, share):
    """Rows as dense vectors; ``share`` gives for a block and as many random numbers which rows are drawn."""

    def drawn(part: int, frozen: Iterator[bytes]) -> Iterator[tuple[float, np.ndarray]]:
        for i, block in enumerate(map(thaw, frozen)):
            luck = np.random.default_rng([seed, part, i]).random(len(block))
            for row in share(block, luck):
                one = block.take(np.array([row]))
                yield float(luck[row]), (one.pos, one.value)

    return blocks.mapPartitionsWithIndex(drawn)


def _dense(rows: list[tuple[np.ndarray, np.ndarray]], width: int) -> np.ndarray:
    found = np.zeros((len(rows), width))
    for to, (pos, value) in zip(found, rows):
        to[pos] = value
    return found


def random_rows(blocks: RDD, n: int, width: int, seed: int) -> np.ndarray:
    """``n`` rows drawn without replacement, each with the same probability."""
    drawn = _draw(blocks, seed, lambda block, luck: np.argsort(luck)[:n])
    chosen = drawn.takeOrdered(n, key=lambda pair: pair[0])
    return _dense([row for _, row in chosen], width)


def _cost(centers: np.ndarray):
    return lambda blocks: float(sum(distances(b, centers)[0].min(axis=1).sum() for b in blocks))


def parallel_start(blocks: RDD, k: int, width: int, steps: int, seed: int) -> np.ndarray:
    """k-means||: rows drawn in proportion to their distance, thinned out by k-means++ weighted by their rows."""
    centers = random_rows(blocks, 1, width, seed)
    for step in range(steps):
        cost = sum(per_task(blocks, _cost(centers)).collect())
        if cost == 0.0:
            break
        drawn = _draw(
            blocks,
            seed + step + 1,
            lambda block, luck, c=centers, cost=cost: np.flatnonzero(
                luck < 2.0 * k * distances(block, c)[0].min(axis=1) / cost
            ),
        )
        centers = np.concatenate([centers, _dense([row for _, row in drawn.collect()], width)])
    centers = np.unique(centers, axis=0)
    if len(centers) <= k:
        return centers
    return weighted_start(centers, _sums(blocks, centers).rows, k, seed)


def weighted_start(points: np.ndarray, weights: np.ndarray, k: int, seed: int, rounds: int = 30) -> np.ndarray:
    """k-means++ on a few weighted points, and Lloyd's rounds on them."""
    rng = np.random.default_rng(seed)
    centers = points[[rng.choice(len(points), p=weights / weights.sum())]]

    def gaps() -> np.ndarray:
        return ((points[:, None, :] - centers[None, :, :]) ** 2).sum(axis=2)

    while len(centers) < k:
        chance = weights * gaps().min(axis=1)
        if chance.sum() == 0.0:
            chance = gaps().min(axis=1)
        if chance.sum() == 0.0:
            break
        centers = np.concatenate([centers, points[[rng.choice(len(points), p=chance / chance.sum())]]])
    for _ in range(rounds):
        nearest = gaps().argmin(axis=1)
        before = centers.copy()
        for j in range(len(centers)):
            if weights[nearest == j].sum() > 0:
                centers[j] = np.average(points[nearest == j], axis=0, weights=weights[nearest == j])
        if (before == centers).all():
            break
    return centers


class SettlingKMeans(KMeans):
    """MLlib's k-means with rounds that leave out settled rows.

    Weighted rows, other distances than the Euclidean and very many centres are left to MLlib.
    """

    def _fit(self, dataset: DataFrame) -> KMeansModel:
        self._transfer_params_to_java()
        attributes = dataset.schema[self.getFeaturesCol()].metadata.get("ml_attr", {})
        width = int(attributes.get("num_attrs") or 0) or self._width(dataset)
        weighted = self.isDefined(self.weightCol) and self.getWeightCol()
        small = self.getK() <= MAX_CENTERS and self.getK() * width <= MAX_SUMS
        if weighted or self.getDistanceMeasure() != "euclidean" or not small or not width:
            return super()._fit(dataset)
        with kept(pack(dataset, self.getFeaturesCol(), width)) as blocks:
            found = per_task(blocks, _checked).collect()
            if not all(fine for fine, _ in found):
                raise ValueError("vectors must not contain NaN or infinite values")
            if not any(rows for _, rows in found):
                return super()._fit(dataset)
            return self._finished(dataset, *self._rounds(blocks, self._start(blocks, width)))

    def _width(self, dataset: DataFrame) -> int:
        first = dataset.select(self.getFeaturesCol()).first()
        return len(first[0]) if first and first[0] is not None else 0

    def _start(self, blocks: RDD, width: int) -> np.ndarray:
        seed = self.getSeed() % 2**32
        if self.getInitMode() == "random":
            return np.unique(random_rows(blocks, self.getK(), width, seed), axis=0)
        return parallel_start(blocks, self.getK(), width, self.getInitSteps(), seed)

    def _rounds(self, blocks: RDD, centers: np.ndarray) -> tuple[np.ndarray, float, int]:
        """Centres, cost before their last move and number of rounds."""
        levels, cost, rounds, move = [Level(blocks, None, np.inf, None)], 0.0, 0, 0.0
        with ExitStack() as held:
            scopes = [held]
            while rounds < self.getMaxIter():
                # A level lies within the ones before it, so all of them must hold.
                while not all(level.holds(centers) for level in levels):
                    levels.pop()
                    scopes.pop().close()
                top = levels[-1]
                reaches = np.array(REACHES) * move
                here = _sums(top.blocks, centers, reaches)
                total = here if top.settled is None else here + Sums(
                    top.settled.rows, top.settled.vectors, top.settled.squares, 0 * here.open
                )
                filled = total.rows > 0
                after = np.where(filled[:, None], total.vectors / np.maximum(total.rows, 1)[:, None], centers)
                cost = _cost_of(total, centers)
                rounds += 1
                last, move = move, float(np.linalg.norm(after - centers, axis=1).max())
                if move <= self.getTol():
                    return after, cost, rounds
                size = int(here.rows.sum())
                good = np.flatnonzero((here.open <= WORTH * size) & (reaches >= REACHES[0] / 2 * move))
                if last > 0 and size > FEW_ROWS and len(good):
                    reach = float(reaches[good[-1]])
                    scope = held.enter_context(ExitStack())
                    narrow = scope.enter_context(kept(_open(top.blocks, centers, reach)))
                    settled = total.less(_sums(narrow, centers))
                    levels.append(Level(narrow, centers, reach, settled))
                    scopes.append(scope)
                centers = after
        return centers, cost, rounds

    def _finished(self, dataset: DataFrame, centers: np.ndarray, cost: float, rounds: int) -> KMeansModel:
        """MLlib's model with these centres, and its summary."""
        context = SparkContext._active_spark_context
        jvm, made = context._jvm, context._gateway
        vectors = made.new_array(jvm.org.apache.spark.mllib.linalg.Vector, len(centers))
        for i, center in enumerate(centers):
            vectors[i] = _py2java(context, Vectors.dense(center))
        inner = jvm.org.apache.spark.mllib.clustering.KMeansModel(vectors, self.getDistanceMeasure(), cost, rounds)
        model = self._copyValues(KMeansModel(jvm.org.apache.spark.ml.clustering.KMeansModel(self.uid, inner)))
        model._transfer_params_to_java()
        names = self.getPredictionCol(), self.getFeaturesCol()
        scored = model._java_obj.transform(dataset._jdf)
        summary = jvm.org.apache.spark.ml.clustering.KMeansSummary(scored, *names, self.getK(), rounds, cost)
        model._java_obj.setSummary(jvm.scala.Some(summary))
        return model


def _checked(blocks: Iterator[Block]) -> tuple[bool, int]:
    fine, rows = True, 0
    for block in blocks:
        fine, rows = fine and bool(np.isfinite(block.value).all()), rows + len(block)
    return fine, rows


def _cost_of(total: Sums, centers: np.ndarray) -> float:
    """Squared distances of all rows to their clusters' centres."""
    lengths = (centers * centers).sum(axis=1)
    return float((total.squares - 2 * (total.vectors * centers).sum(axis=1) + total.rows * lengths).sum())
