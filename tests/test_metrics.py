import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tallyforge.operators import metrics, relational

from tests.conftest import tuples

SCHEMA = "prediction double, label double"
# 3 true positives, 4 true negatives, 2 false positives, 1 false negative
ROWS = [(1.0, 1.0)] * 3 + [(0.0, 0.0)] * 4 + [(1.0, 0.0)] * 2 + [(0.0, 1.0)]


def counted(spark, rows):
    return relational.contingency(spark.createDataFrame(rows, SCHEMA))


def test_agreement(spark):
    assert tuples(metrics.agreement(counted(spark, ROWS))) == [(10, 7, 3, 0.7, 0.3)]


def test_null_prediction_is_in_the_total_only(spark):
    rows = [(None, 1.0), (1.0, 1.0), (0.0, 1.0), (1.0, None)]
    assert tuples(metrics.agreement(counted(spark, rows))) == [(4, 1, 1, 0.25, 0.25)]


def test_agreement_of_nothing(spark):
    empty = counted(spark, [])
    assert tuples(metrics.agreement(empty)) == [(0, 0, 0, None, None)]
    assert tuples(metrics.confusion_over_total(empty, 1.0, 0.0)) == [(None,) * 4]


def test_accuracy_equals_the_evaluator(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    expected = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(df)
    accuracy, error = metrics.accuracy(relational.contingency(df)).first()
    assert accuracy == pytest.approx(expected)
    assert error == pytest.approx(1 - expected)


def test_confusion_over_total_for_either_positive_class(spark):
    counts = counted(spark, ROWS)
    assert tuples(metrics.confusion_over_total(counts, 1.0, 0.0)) == [(0.3, 0.4, 0.2, 0.1)]
    assert tuples(metrics.confusion_over_total(counts, 0.0, 1.0)) == [(0.4, 0.3, 0.1, 0.2)]


def test_confusion_by_class_name(spark):
    rows = [("normal", "normal"), ("attack", "normal"), ("attack", "attack"), ("attack", "attack")]
    counts = relational.contingency(spark.createDataFrame(rows, "prediction string, label string"))
    assert tuples(metrics.confusion_over_total(counts, "normal", "attack")) == [(0.25, 0.5, 0.0, 0.25)]


def test_crossed_denominators(spark):
    got = metrics.confusion_over_predicted(counted(spark, ROWS), 1.0, 0.0).first()
    assert tuple(got) == pytest.approx((3 / 5, 4 / 5, 2 / 5, 1 / 5))
    # One row predicted negative, three false positives: the crossed rate exceeds 1.
    lopsided = [(1.0, 0.0)] * 3 + [(0.0, 0.0)]
    assert metrics.confusion_over_predicted(counted(spark, lopsided), 1.0, 0.0).first()["fp_rate"] == 3.0


def test_nothing_predicted_positive(spark):
    counts = counted(spark, [(0.0, 0.0), (0.0, 1.0)])
    assert tuples(metrics.confusion_over_predicted(counts, 1.0, 0.0)) == [(None, 0.5, 0.0, None)]
    standard = metrics.confusion_standard(counts, 1.0, 0.0).first()
    assert standard["precision"] is None and standard["recall"] == 0.0


def test_standard_rates(spark):
    got = metrics.confusion_standard(counted(spark, ROWS), 1.0, 0.0).first()
    assert tuple(got) == pytest.approx((3 / 5, 3 / 4, 2 / 6, 1 / 4, 6 / 9))


def brute_auc(pairs):
    yes = [s for s, label in pairs if label == 1.0]
    no = [s for s, label in pairs if label == 0.0]
    return sum((a > b) + 0.5 * (a == b) for a in yes for b in no) / (len(yes) * len(no))


def test_auc_equals_pair_counting(spark):
    pairs = [(float((i * 7) % 11), float(i % 3 == 0)) for i in range(60)]
    df = spark.createDataFrame(pairs, "score double, label double")
    assert metrics.auc_roc(df, "score", bins=0) == pytest.approx(brute_auc(pairs))
    groups = relational.value_counts(df, "score", "label")
    assert metrics.auc_roc(groups, "score", bins=0, weight="n") == pytest.approx(brute_auc(pairs))


def test_auc_of_a_vector_uses_its_second_slot(spark):
    rows = [(Vectors.dense(-s, s), y) for s, y in [(0.1, 0.0), (0.4, 1.0), (0.35, 0.0), (0.8, 1.0)]]
    df = spark.createDataFrame(rows, ["rawPrediction", "label"])
    assert metrics.auc_roc(df) == BinaryClassificationEvaluator().evaluate(df) == 1.0


def test_majority_label_of_clusters(spark):
    rows = [(0, 5), (0, 5), (0, 7), (1, 7), (1, 5), (2, 7)]
    counts = relational.contingency(spark.createDataFrame(rows, "prediction int, label int"))
    assert dict(tuples(metrics.cluster_majority(counts))) == {0: 5, 1: 5, 2: 7}
    mapped = metrics.majority_counts(counts)
    assert tuples(metrics.agreement(mapped))[0][:3] == (6, 4, 2)


def test_metric_table(spark):
    wide = spark.createDataFrame([(1, 0.5)], "total long, share double")
    assert tuples(metrics.metric_table(wide)) == [("total", 1.0), ("share", 0.5)]


def test_measures_need_one_pass_over_rows(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    plan = metrics.agreement(relational.contingency(df))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_count") == 1


def test_clusters_numbered_by_size(spark):
    counts = spark.createDataFrame(
        [(7, 0.0, 5), (7, 1.0, 1), (2, 1.0, 9), (4, 2.0, 6), (None, 2.0, 1)], "prediction int, truth double, n bigint"
    )
    found = tuples(metrics.numbered_by_size(counts))
    assert sorted(found) == [(0.0, 1.0, 9), (1.0, 2.0, 6), (2.0, 0.0, 5), (2.0, 1.0, 1), (3.0, 2.0, 1)]
