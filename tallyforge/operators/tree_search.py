"""Cross-validation of decision trees whose fits pass over the rows together.

MLlib fits every fold and grid point on its own, each with its own copy of the rows. Here all of them grow
level by level from the same passes: a pass counts rows per node, feature value, fold and class, and what a
fold's trees learn from is the sum over the other folds; the tree for all rows grows beside them. Nodes
that several trees reach by the same splits are counted once. A tree of less depth is the upper part of the
deeper one with as many bins, so all depths are read off the deepest. Thresholds, gains, stopping and pruning
follow MLlib's trees.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark import RDD, SparkContext
from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import DataFrame, functions as F

from tallyforge.operators.blocks import Block, join_blocks, kept, pack, per_task, thaw, freeze

# Rows from which the thresholds of numbers are drawn, and the most bins for which that sample stays small.
MIN_SAMPLE = 10_000
MAX_BINS = 200
# Room in memory of one task for the counts of the nodes of a pass; more nodes are counted in further passes.
COUNT_BYTES = 64 << 20
# Classes as learned times classes as judged.
CLASSES = 4
EPSILON = 2.0**-52
# Stands for the fold of a tree that learns from all rows.
ALL = -1


@dataclass
class Layout:
    """Which items, ranges of a feature's values, there are; item numbers run on from feature to feature."""

    arity: list[int | None]
    cuts: list[np.ndarray | None]
    begin: np.ndarray
    zero: np.ndarray

    @classmethod
    def of(cls, arity: list[int | None], cuts: list[np.ndarray | None]) -> Layout:
        sizes = [a if c is None else len(c) + 1 for a, c in zip(arity, cuts)]
        begin = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        zero = [b if c is None else b + np.searchsorted(c, 0.0) for b, c in zip(begin, cuts)]
        return cls(arity, cuts, begin, np.array(zero, np.int64))

    def items(self, block: Block) -> np.ndarray:
        """The item of every stored entry."""
        pos = block.pos.astype(np.int64)
        found = self.begin[pos] + np.nan_to_num(block.value).astype(np.int64)
        for j, cuts in enumerate(self.cuts):
            if cuts is not None:
                at = np.flatnonzero(pos == j)
                found[at] = self.begin[j] + np.searchsorted(cuts, block.value[at])
        return found.astype(np.uint16 if self.begin[-1] < 1 << 16 else np.int32)


@dataclass
class Node:
    """A node that one or more trees reach: rows per fold and class, and the splits those trees chose.

    ``splits`` leads from a feature and its items on the left to the two nodes below.
    """

    depth: int
    rows: np.ndarray
    splits: dict[tuple[int, bytes], tuple[int, int]] = field(default_factory=dict)
    chosen: dict[tuple[int, int], tuple[int, bytes]] = field(default_factory=dict)


def learned(rows: np.ndarray, fold: int) -> np.ndarray:
    """Rows per class that the trees of a fold learn from; the first axes are fold and class."""
    others = rows.sum(axis=0) - (0 if fold == ALL else rows[fold])
    return np.stack([others[0] + others[1], others[2] + others[3]])


def judged(rows: np.ndarray, fold: int) -> np.ndarray:
    """Rows per class that the trees of a fold are judged by."""
    return np.array([rows[fold][0] + rows[fold][2], rows[fold][1] + rows[fold][3]])


def thresholds(values: np.ndarray, zeros: int, most: int) -> np.ndarray:
    """At most ``most`` thresholds between a sample's values: between all of them, or at equal strides."""
    distinct, n = np.unique(np.concatenate([values, np.zeros(zeros)]), return_counts=True)
    middles = (distinct[:-1] + distinct[1:]) / 2
    if len(middles) <= most:
        return middles
    stride = n.sum() / (most + 1)
    found, so_far, target = [], float(n[0]), stride
    for i, middle in enumerate(middles):
        before, so_far = so_far, so_far + n[i + 1]
        if abs(before - target) < abs(so_far - target):
            found.append(middle)
            target += stride
    return np.array(found)


def gini(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    n = np.maximum(a + b, 1)
    return 1.0 - (a / n) * (a / n) - (b / n) * (b / n)


def best_split(
    counts: np.ndarray, layout: Layout, allowed: list[np.ndarray | None], min_rows: int, min_gain: float
) -> tuple[int, bytes] | None:
    """The feature and its left items with the largest gain, the first one on ties, for counts per class and item."""
    best, top = None, 0.0
    whole = counts[:, layout.begin[0] : layout.begin[1]].sum(axis=1)
    impurity = gini(*whole)
    for j, cuts in enumerate(layout.cuts):
        of = counts[:, layout.begin[j] : layout.begin[j + 1]]
        order = np.arange(of.shape[1])
        if cuts is None:
            # Like MLlib's, by rows of class 1, values without rows last.
            order = np.argsort(np.where(of.sum(axis=0) > 0, of[1], np.inf), kind="stable")
        ends = order[:-1] if cuts is None else allowed[j]
        if not len(ends):
            continue
        left = np.cumsum(of[:, order], axis=1)[:, : len(ends)] if cuts is None else np.cumsum(of, axis=1)[:, ends]
        right = whole[:, None] - left
        n_left, n_right = left.sum(axis=0), right.sum(axis=0)
        gain = impurity - n_left / whole.sum() * gini(*left) - n_right / whole.sum() * gini(*right)
        gain[(n_left < min_rows) | (n_right < min_rows) | (gain < min_gain)] = -np.inf
        at = int(np.argmax(gain))
        if gain[at] > top:
            top = gain[at]
            mask = np.zeros(len(order), bool)
            mask[order[: at + 1] if cuts is None else order[: ends[at] + 1]] = True
            best = j, mask.tobytes()
    return best


def area_under_curve(leaves: list[tuple[float, int, int]]) -> float:
    """Area under ROC of ``(score, negatives, positives)``."""
    groups: dict[float, np.ndarray] = defaultdict(lambda: np.zeros(2, np.int64))
    for score, no, yes in leaves:
        groups[score] += (no, yes)
    steps = [groups[s] for s in sorted(groups, reverse=True) if groups[s].any()]
    so_far = np.cumsum([np.zeros(2, np.int64), *steps], axis=0)
    x, y = (np.append(c / c[-1] if c[-1] else c * 0.0, 1.0) for c in so_far.T)
    return float(np.sum(np.diff(x) * (y[1:] + y[:-1]) / 2))


def _prepared(layout: Layout, fold: str, classes: tuple[str, str]):
    """Blocks of items instead of values, with one number per row for fold and classes."""

    def of(frozen: bytes) -> bytes:
        block = thaw(frozen)
        kind = 2 * (block.extra[classes[0]] > 0.5) + (block.extra[classes[1]] > 0.5)
        group = (block.extra[fold] * CLASSES + kind).astype(np.int32)
        return freeze(Block(block.count, layout.items(block), np.zeros(0, np.uint8), {"group": group}))

    return of


def _counter(nodes: dict[int, dict], wanted: set[int], layout: Layout, groups: int):
    """Counts rows per group and item in each wanted node; ``nodes`` are the splits above them."""
    items = int(layout.begin[-1])
    owner = np.repeat(np.arange(len(layout.zero)), np.diff(layout.begin))

    def of(block: Block, found: dict[int, np.ndarray]) -> None:
        group = block.extra["group"].astype(np.int64)
        columns: dict[int, np.ndarray] = {}
        feature = owner[block.pos]
        row = np.repeat(np.arange(len(block)), block.count)

        def column(j: int) -> np.ndarray:
            if j not in columns:
                columns[j] = np.full(len(block), layout.zero[j] - layout.begin[j])
                at = np.flatnonzero(feature == j)
                columns[j][row[at]] = block.pos[at] - layout.begin[j]
            return columns[j]

        def visit(node: int, rows: np.ndarray | None) -> None:
            if node in wanted:
                at = slice(None) if rows is None else block.entries(rows)
                flat = group[row[at]] * items + block.pos[at]
                table = np.bincount(flat, minlength=groups * items).reshape(groups, items)
                n = np.bincount(group if rows is None else group[rows], minlength=groups)
                # A feature's rows without an entry have the value zero.
                table[:, layout.zero] += n[:, None] - np.add.reduceat(table, layout.begin[:-1], axis=1)
                found[node] = found[node] + table if node in found else table
            for (j, mask), below in nodes.get(node, {}).items():
                values = column(j) if rows is None else column(j)[rows]
                goes = np.frombuffer(mask, bool)[values]
                for side, child in zip((goes, ~goes), below):
                    part = np.flatnonzero(side) if rows is None else rows[side]
                    if len(part):
                        visit(child, part)

        visit(0, None)

    def work(blocks: Iterator[Block]) -> dict[int, np.ndarray]:
        found: dict[int, np.ndarray] = {}
        for block in blocks:
            of(block, found)
        return found

    return work


class SharedTreeSearch(CrossValidator):
    """A search over bins and depths of a tree for two classes, by area under ROC, with given folds.

    Any other search is left to MLlib's own.
    """

    def _fit(self, dataset: DataFrame) -> CrossValidatorModel:
        grown = self._grown(dataset)
        if grown is None:
            return super()._fit(dataset)
        nodes, layout = grown
        metrics, deviations = CrossValidator._gen_avg_and_std_metrics(self._scores(nodes))
        best = self._model(nodes, layout, int(np.argmax(metrics)))
        return self._copyValues(CrossValidatorModel(best, metrics, None, deviations))

    def _arity(self, dataset: DataFrame) -> list[int | None] | None:
        """Number of values of every feature that is a category, if the search is one to share."""
        tree, judge, grid = self.getEstimator(), self.getEvaluator(), self.getEstimatorParamMaps()
        if type(tree) is not DecisionTreeClassifier or type(judge) is not BinaryClassificationEvaluator:
            return None
        fine = (
            self.getFoldCol()
            and not self.getCollectSubModels()
            and judge.getMetricName() == "areaUnderROC"
            and judge.getNumBins() == 0
            and judge.getRawPredictionCol() == tree.getRawPredictionCol()
            and not any(p.isDefined(p.weightCol) and p.getOrDefault(p.weightCol) for p in (tree, judge))
            and tree.getImpurity() == "gini"
            and tree.getMinWeightFractionPerNode() == 0.0
            and all(set(point) <= {tree.maxBins, tree.maxDepth} for point in grid)
            and all(2 <= bins <= MAX_BINS and 0 <= depth <= 30 for bins, depth in self._points())
        )
        label = dataset.schema[tree.getLabelCol()].metadata.get("ml_attr", {})
        features = dataset.schema[tree.getFeaturesCol()].metadata.get("ml_attr", {})
        if not fine or len(label.get("vals", [])) != 2 or not features.get("num_attrs"):
            return None
        arity: list[int | None] = [None] * int(features["num_attrs"])
        for kind in ("nominal", "binary"):
            for slot in features.get("attrs", {}).get(kind, []):
                arity[slot["idx"]] = 2 if kind == "binary" else len(slot.get("vals", [])) or slot.get("num_vals", 0)
        known = [a for a in arity if a is not None]
        return None if any(a < 1 or a > min(b for b, _ in self._points()) for a in known) else arity

    def _points(self) -> list[tuple[int, int]]:
        """Bins and depth of every grid point."""
        tree = self.getEstimator()
        return [
            (point.get(tree.maxBins, tree.getMaxBins()), point.get(tree.maxDepth, tree.getMaxDepth()))
            for point in self.getEstimatorParamMaps()
        ]

    def _grown(self, dataset: DataFrame) -> tuple[list[Node], Layout] | None:
        """All trees of the search, or None if it cannot be shared."""
        arity = self._arity(dataset)
        if arity is None:
            return None
        tree, fold, folds = self.getEstimator(), self.getFoldCol(), self.getNumFolds()
        classes = tree.getLabelCol(), self.getEvaluator().getLabelCol()
        sizes = {r[0]: r[1] for r in dataset.groupBy(fold).agg(F.count("*")).collect()}
        if set(sizes) != set(range(folds)):
            return None
        columns = dict.fromkeys([*classes, fold])
        with kept(pack(dataset, tree.getFeaturesCol(), len(arity), *columns)) as values:
            layout, allowed = self._layout(values, arity, fold, sizes)
            with kept(values.map(_prepared(layout, fold, classes))) as items:
                items.foreach(len)
                values.unpersist()
                return self._grow(items, layout, allowed, folds), layout

    def _layout(
        self, values: RDD, arity: list[int | None], fold: str, sizes: dict[int, int]
    ) -> tuple[Layout, dict[tuple[int, int], list[np.ndarray | None]]]:
        """The items, and per fold and bins which ends of items are thresholds of its trees."""
        bins = sorted({b for b, _ in self._points()})
        total = sum(sizes.values())
        least = min(total - n for n in sizes.values())
        share = min(1.0, max(max(bins) ** 2, MIN_SAMPLE) / least)
        seed, numbers = self.getEstimator().getSeed() % 2**32, [j for j, a in enumerate(arity) if a is None]

        def draw(part: int, frozen: Iterator[bytes]) -> list[bytes]:
            drawn = []
            for i, block in enumerate(map(thaw, frozen)):
                luck = np.random.default_rng([seed, part, i]).random(len(block))
                drawn.append(block.take(np.flatnonzero(luck < share)))
            return [freeze(join_blocks(drawn))] if drawn else []

        sample = join_blocks([thaw(b) for b in values.mapPartitionsWithIndex(draw).collect()])
        row = np.repeat(np.arange(len(sample)), sample.count)
        own: dict[tuple[int, int], list[np.ndarray | None]] = {}
        for f in [*sizes, ALL]:
            inside = sample.extra[fold] != f
            entry = inside[row]
            for b in bins:
                own[f, b] = [None] * len(arity)
                for j in numbers:
                    found = sample.value[entry & (sample.pos == j)]
                    own[f, b][j] = thresholds(found, int(inside.sum()) - len(found), min(b, total - sizes.get(f, 0)) - 1)
        cuts = [None if a is not None else np.unique(np.concatenate([o[j] for o in own.values()])) for j, a in enumerate(arity)]
        allowed = {m: [None if t is None else np.searchsorted(c, t) for t, c in zip(o, cuts)] for m, o in own.items()}
        return Layout.of(arity, cuts), allowed

    def _grow(self, items: RDD, layout: Layout, allowed: dict[tuple[int, int], list], folds: int) -> list[Node]:
        """All trees, as one graph of nodes; the first node is the root of each."""
        tree = self.getEstimator()
        least, gain = tree.getMinInstancesPerNode(), tree.getMinInfoGain()
        deepest: dict[int, int] = defaultdict(int)
        for bins, depth in self._points():
            deepest[bins] = max(deepest[bins], depth)
        groups, width = folds * CLASSES, int(layout.begin[-1])
        at_once = max(1, COUNT_BYTES // (8 * groups * width))

        nodes = [Node(0, np.zeros((folds, CLASSES), np.int64))]
        # The root's rows are needed even if no tree may split it.
        waiting: dict[int, list[tuple[int, int]]] = {0: [m for m in allowed if deepest[m[1]] > 0]}
        while waiting:
            now = dict(list(waiting.items())[:at_once])
            waiting = {k: v for k, v in waiting.items() if k not in now}
            splits = {i: node.splits for i, node in enumerate(nodes) if node.splits}
            counted = per_task(items, _counter(splits, set(now), layout, groups)).flatMap(lambda found: found.items())

            def decide(node: int, counts: np.ndarray, models: dict = now) -> tuple:
                rows = counts[:, layout.begin[0] : layout.begin[1]].sum(axis=1).reshape(folds, CLASSES)
                table, choices = counts.reshape(folds, CLASSES, width), {}
                for fold, bins in models[node]:
                    split = best_split(learned(table, fold), layout, allowed[fold, bins], least, gain)
                    if split is not None:
                        choices[fold, bins] = split
                below = {}
                for j, mask in set(choices.values()):
                    of = table[:, :, layout.begin[j] : layout.begin[j + 1]]
                    left = of[:, :, np.frombuffer(mask, bool)].sum(axis=2)
                    below[j, mask] = left, rows - left
                return node, rows, choices, below

            parts = items.context.defaultParallelism
            decided = counted.reduceByKey(np.add, parts).map(lambda kv: decide(*kv)).collect()
            for number, rows, choices, below in sorted(decided, key=lambda d: d[0]):
                node = nodes[number]
                if number == 0:
                    node.rows = rows
                node.chosen = choices
                for split in sorted(below):
                    node.splits[split] = len(nodes), len(nodes) + 1
                    nodes += [Node(node.depth + 1, part) for part in below[split]]
                for model, split in sorted(choices.items()):
                    for child in node.splits[split]:
                        here = learned(nodes[child].rows, model[0])
                        if node.depth + 1 < deepest[model[1]] and gini(*here) >= EPSILON:
                            waiting.setdefault(child, []).append(model)
        return nodes

    def _scores(self, nodes: list[Node]) -> list[list[float]]:
        """Area under ROC per fold and grid point."""
        folds = range(self.getNumFolds())
        return [[area_under_curve(self._leaves(nodes, f, *point)) for point in self._points()] for f in folds]

    def _leaves(self, nodes: list[Node], fold: int, bins: int, depth: int) -> list[tuple[float, int, int]]:
        """Score, negatives and positives per leaf of one fold's tree, on the rows it has not learned from."""

        def leaves(number: int) -> list[tuple[int, float, int, int]]:
            node = nodes[number]
            rows = learned(node.rows, fold)
            own = [(int(np.argmax(rows)), float(rows[1]), *map(int, judged(node.rows, fold)))]
            split = node.chosen.get((fold, bins))
            if split is None or node.depth >= depth:
                return own
            left, right = map(leaves, node.splits[split])
            # Leaves that predict the same are one leaf, as in MLlib's trees.
            return own if len(left) == len(right) == 1 and left[0][0] == right[0][0] else left + right

        return [leaf[1:] for leaf in leaves(0)]

    def _model(self, nodes: list[Node], layout: Layout, point: int) -> DecisionTreeClassificationModel:
        """The tree that a grid point learns from all rows, as MLlib's model."""
        tree = self.getEstimator().copy(self.getEstimatorParamMaps()[point])
        bins, depth = self._points()[point]
        context = SparkContext._active_spark_context
        spark, made = context._jvm.org.apache.spark, context._gateway

        def doubles(values: np.ndarray):
            array = made.new_array(made.jvm.double, len(values))
            for i, value in enumerate(values):
                array[i] = float(value)
            return array

        def build(number: int) -> tuple:
            """A node, and what it predicts if it is a leaf."""
            node = nodes[number]
            rows = learned(node.rows, ALL)
            stats = spark.mllib.tree.impurity.GiniCalculator(doubles(rows), int(rows.sum()))
            predicted, impurity = int(np.argmax(rows)), float(gini(*rows))
            leaf = spark.ml.tree.LeafNode(float(predicted), impurity, stats), predicted
            split = node.chosen.get((ALL, bins))
            if split is None or node.depth >= depth:
                return leaf
            (left, left_is), (right, right_is) = map(build, node.splits[split])
            if left_is is not None and left_is == right_is:
                return leaf
            j, mask = split[0], np.frombuffer(split[1], bool)
            if layout.cuts[j] is None:
                rule = spark.ml.tree.CategoricalSplit(j, doubles(np.flatnonzero(mask)), layout.arity[j])
            else:
                rule = spark.ml.tree.ContinuousSplit(j, float(layout.cuts[j][mask.sum() - 1]))
            below = [learned(nodes[child].rows, ALL) for child in node.splits[split]]
            gain = impurity - sum(float(part.sum() / rows.sum() * gini(*part)) for part in below)
            return spark.ml.tree.InternalNode(float(predicted), impurity, gain, left, right, rule, stats), None

        model = spark.ml.classification.DecisionTreeClassificationModel(tree.uid, build(0)[0], len(layout.arity), 2)
        return tree._copyValues(DecisionTreeClassificationModel(model))
