import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from tallyforge.operators import blocks, classify, tree_search
from tallyforge.operators.blocks import freeze, join_blocks, pack, thaw
from tallyforge.operators.features import fit_label_reindex, fit_vector_index
from tallyforge.plans import catalogue, studies
from tallyforge.sources.tables import FLOW_KEY, flows


def odd_rows(spark, n=3000, seed=5, folds=3):
    """Noisy classes on numbers, sparse numbers, categories, a constant slot and negative values."""
    rng = np.random.default_rng(seed)
    values = np.stack(
        [
            rng.normal(size=n).round(2),
            np.where(rng.random(n) < 0.8, 0.0, rng.normal(size=n) * 5),
            rng.integers(0, 3, n),
            rng.integers(0, 2, n) + 4,
            np.ones(n),
            rng.integers(-20, 20, n),
            rng.random(n) < 0.05,
        ],
        axis=1,
    ).astype(float)
    yes = (values[:, 0] > 0.3) ^ (values[:, 2] == 1) ^ (rng.random(n) < 0.2) ^ (values[:, 1] > 2)
    rows = [
        (Vectors.dense(v) if i % 2 else Vectors.sparse(7, {j: x for j, x in enumerate(v) if x}), float(y), int(f))
        for i, (v, y, f) in enumerate(zip(values, yes, rng.integers(0, folds, n)))
    ]
    raw = spark.createDataFrame(rows, ["features", "label", "fold"])
    raw = raw.withColumn("fold", F.col("fold").cast("int")).repartition(5).cache()
    stages = [fit_label_reindex(raw), fit_vector_index(raw)]
    return PipelineModel(stages).transform(raw)


def plain(search):
    """The same search, fit by fit."""
    one = CrossValidator(
        estimator=search.getEstimator(),
        estimatorParamMaps=search.getEstimatorParamMaps(),
        evaluator=search.getEvaluator(),
        numFolds=search.getNumFolds(),
        parallelism=4,
    )
    return one.setFoldCol(search.getFoldCol())


@pytest.mark.parametrize("settings", [{}, {"minInfoGain": 0.01, "minInstancesPerNode": 40}])
def test_shared_search_scores_like_a_fit_for_every_fold_and_grid_point(spark, settings):
    rows = odd_rows(spark, folds=2)
    tree = classify.decision_tree(**settings)
    search = classify.cross_validator(tree, bins=(8, 70), depths=(1, 6), folds=2, fold_column="fold")
    ours, theirs = search.fit(rows), plain(search).fit(rows)
    assert len(set(np.round(theirs.avgMetrics, 6))) >= 3
    # Fold by fold the thresholds are drawn alike, as all rows are in the sample.
    assert ours.avgMetrics == pytest.approx(theirs.avgMetrics, abs=1e-9)
    best, other = ours.bestModel, theirs.bestModel
    assert best.toDebugString.split("\n")[1:] == other.toDebugString.split("\n")[1:]
    assert best.featureImportances.toArray() == pytest.approx(other.featureImportances.toArray(), abs=1e-9)
    assert [best.getOrDefault(p) for p in ("maxDepth", "maxBins")] == [other.getOrDefault(p) for p in ("maxDepth", "maxBins")]
    keep = ["features", "rawPrediction", "probability", "prediction"]
    a, b = (sorted(map(str, m.transform(rows).select(keep).collect())) for m in (ours, theirs))
    assert a == b
    nodes, others = (classify.tree_rules(m, m.transform(rows)).drop("gain", "impurity") for m in (best, other))
    assert sorted(map(str, nodes.collect())) == sorted(map(str, others.collect()))


def test_search_passes_over_the_rows_together(spark, data, monkeypatch):
    """Before, there was a fit for each fold and grid point, with passes of its own."""
    fits = []
    fit = DecisionTreeClassifier._fit
    monkeypatch.setattr(DecisionTreeClassifier, "_fit", lambda self, rows: fits.append(1) or fit(self, rows))
    records = flows(spark, data, spread=True)
    study = studies.tree_study(records, FLOW_KEY, bins=(65, 71), depths=(2, 4), folds=2)
    assert len(study.model.stages[-1].avgMetrics) == 4
    assert fits == []


def test_whole_tree_study_makes_no_fit_of_its_own(spark, data, monkeypatch):
    """Before, this query made 37 fits, one after the other."""
    monkeypatch.setattr(DecisionTreeClassifier, "_fit", lambda *_: pytest.fail("a fit of its own"))
    found = {r["metric"]: r["value"] for r in catalogue.QUERIES["cv_decision_tree"](spark, data).collect()}
    assert len(found) == 23 and all(found[f"auc bins={b} depth={d}"] == 1.0 for b in (65, 68, 71) for d in (4, 6, 8))


def test_nodes_beyond_the_room_of_a_pass_are_counted_in_further_passes(spark, monkeypatch):
    rows = odd_rows(spark, n=800)
    search = classify.cross_validator(classify.decision_tree(), bins=(8, 20), depths=(4,), folds=3, fold_column="fold")
    together = search._scores(search._grown(rows)[0])
    monkeypatch.setattr(tree_search, "COUNT_BYTES", 1)
    monkeypatch.setattr(blocks, "BLOCK_ROWS", 10)
    assert search._scores(search._grown(rows)[0]) == together


def test_searches_that_cannot_be_shared_are_left_to_mllib(spark):
    rows = odd_rows(spark, n=400)
    entropy = classify.decision_tree(impurity="entropy")
    search = classify.cross_validator(entropy, bins=(8,), depths=(2,), folds=3, fold_column="fold")
    assert search._grown(rows) is None
    assert search.fit(rows).avgMetrics == pytest.approx(plain(search).fit(rows).avgMetrics)
    wrong = rows.withColumn("fold", F.when(F.col("fold") == 1, 7).otherwise(F.col("fold")))
    search = classify.cross_validator(classify.decision_tree(), bins=(8,), depths=(2,), folds=3, fold_column="fold")
    with pytest.raises(Exception, match="Fold number must be in range"):
        search.fit(wrong)


def test_thresholds():
    assert list(tree_search.thresholds(np.array([1.0, 3.0, 3.0]), 1, 5)) == [0.5, 2.0]
    assert len(tree_search.thresholds(np.arange(1000.0), 0, 9)) == 9
    assert list(tree_search.thresholds(np.array([2.0, 2.0]), 0, 5)) == []


def test_area_under_curve_of_ties_and_missing_classes():
    assert tree_search.area_under_curve([(2.0, 0, 3), (1.0, 3, 0)]) == 1.0
    assert tree_search.area_under_curve([(1.0, 2, 2), (1.0, 1, 5)]) == 0.5
    assert tree_search.area_under_curve([(1.0, 4, 0), (0.0, 2, 0)]) == 0.0


def test_blocks_hold_dense_and_sparse_vectors(spark):
    rows = [(0, Vectors.sparse(300, {})), (1, Vectors.dense(range(300))), (2, Vectors.sparse(300, {7: 2.0, 299: 1.0}))]
    df = spark.createDataFrame(rows, ["id", "features"]).coalesce(1)
    block = join_blocks([thaw(b) for b in pack(df, "features", 300, "id").collect()])
    assert list(block.extra["id"]) == [0, 1, 2] and list(block.count) == [0, 300, 2]
    part = thaw(freeze(block.take(np.array([2, 0]))))
    assert list(part.pos) == [7, 299] and list(part.value) == [2.0, 1.0] and list(part.count) == [2, 0]
    with pytest.raises(Exception, match="no vector"):
        pack(df.select(F.when(F.col("id") > 0, F.col("features")).alias("features")), "features", 300).collect()


def test_packed_rows_are_those_of_the_table(spark):
    df = spark.range(2500, numPartitions=3).select("id", array_to_vector(F.array(F.col("id").cast("double"))).alias("features"))
    found = join_blocks([thaw(b) for b in pack(df, "features", 1, "id").collect()])
    assert sorted(found.extra["id"]) == list(range(2500)) and list(found.value) == list(found.extra["id"])
