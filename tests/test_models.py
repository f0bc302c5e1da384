import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from tallyforge import staging
from tallyforge.functions.recode import hash_bucket
from tallyforge.operators import classify
from tallyforge.operators.features import fit_features, vector_size
from tallyforge.operators.metrics import auc_roc
from tallyforge.plans import catalogue, studies
from tallyforge.plans.shared import binary_flows, encoded_flows
from tallyforge.sources.tables import FLOW_KEY, flows
from tallyforge.spec import connection_spec

from tests.conftest import tuples


def measures(study):
    return dict(tuples(study.measures))


def test_model_settings(spark):
    forest = classify.random_forest()
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getMaxBins()) == (5, 6, 68)
    search = classify.cross_validator(classify.decision_tree())
    assert len(search.getEstimatorParamMaps()) == 9
    assert search.getNumFolds() == 4


def test_net_is_as_wide_as_its_input(spark, data):
    _, rows = encoded_flows(spark, data, "ordinal")
    net = classify.perceptron(rows, 2)
    assert net.getLayers() == [vector_size(rows), 10, 10, 2]
    assert net.getBlockSize() == 128 and net.getMaxIter() == 100


def test_tree_finds_the_rule(spark, data):
    _, rows = encoded_flows(spark, data)
    model = classify.decision_tree("features", "label", maxBins=65).fit(rows.filter("train"))
    scored = classify.predict(model, rows.filter("not train"))
    assert scored.filter("prediction <> label").count() == 0
    used = classify.tree_summary(model, scored).filter("importance > 0")
    assert {s.split("_onehot")[0] for (_, s, _) in tuples(used)} == {"duration", "land"}


def test_saved_model_scores_alike(spark, data):
    features, rows = encoded_flows(spark, data)
    tree = classify.decision_tree("features", "label").fit(rows.filter("train"))
    model = Pipeline(stages=[*features.stages(), tree]).fit(rows)
    loaded = classify.roundtrip(model, rows)
    raw = binary_flows(spark, data)
    columns = [FLOW_KEY, "prediction", "label"]
    a, b = (m.transform(raw).select(columns) for m in (model, loaded))
    assert a.exceptAll(b).count() == 0 and a.count() == b.count()


def test_tree_study(spark, data):
    study = studies.tree_study(
        flows(spark, data, spread=True), FLOW_KEY, bins=(65, 71), depths=(4,), folds=2
    )
    got = measures(study)
    assert got["auc"] == 1.0 and got["error_rate"] == 0.0
    assert got["n_train"] + got["n_test"] == got["n_rows"] == 6000
    assert got["incorrect"] == got["fp"] == got["fn"] == 0
    assert got["tp"] + got["tn"] == pytest.approx(1.0)
    assert study.counts.agg(F.sum("n")).first()[0] == got["total"] == study.scored.count()


def test_curve_from_leaves_equals_the_curve_from_rows(spark, data):
    noisy = flows(spark, data, spread=True).withColumn(
        "class", F.when(hash_bucket(FLOW_KEY, 10) < 3, F.lit("smurf")).otherwise(F.col("class"))
    )
    noisy = noisy.withColumn(
        "class", F.when(hash_bucket(["service", FLOW_KEY], 10) < 2, F.lit("normal")).otherwise(F.col("class"))
    )
    study = studies.tree_study(noisy, FLOW_KEY, bins=(65,), depths=(4, 6), folds=2)
    got = measures(study)
    assert 0.5 < got["auc"] < 0.95
    assert got["auc"] == pytest.approx(auc_roc(study.scored))
    counts = {(p, t): n for p, t, n in tuples(study.counts)}
    assert got["fp"] == pytest.approx(counts[1.0, 0.0] / got["total"])
    assert got["fn"] == pytest.approx(counts[0.0, 1.0] / got["total"])
    truth = study.scored.filter("prediction = indexedLabel").count()
    assert got["correct"] == truth


def test_tree_study_with_categories_learned_from_training_rows(spark, data):
    records = flows(spark, data, spread=True)
    rare = records.withColumn(
        "service", F.when(~studies.in_training(FLOW_KEY), F.lit("new")).otherwise(F.col("service"))
    )
    study = studies.tree_study(rare, FLOW_KEY, bins=(65,), depths=(4,), folds=2, fit_on="train")
    assert "new" not in study.features.dictionaries.labels("service")
    assert measures(study)["incorrect"] == 0


def test_study_with_a_coin_toss_split(spark, data):
    records = flows(spark, data, spread=True)
    study = studies.formula_forest_study(records, FLOW_KEY, seed=1, subset="all", toss_seed=1)
    got = measures(study)
    assert got["n_train"] + got["n_test"] == got["n_rows"]
    assert abs(got["n_train"] / got["n_rows"] - 0.7) < 0.03
    assert got["incorrect"] == 0 and got["n_test"] == got["total"] == study.scored.count()
    with pytest.raises(ValueError):
        studies.tree_study(records, FLOW_KEY, fit_on="train", toss_seed=1)


def test_study_leaves_no_table_behind(spark, data, shared):
    study = studies.tree_study(
        flows(spark, data, spread=True), FLOW_KEY, bins=(65,), depths=(4,), folds=2
    )
    assert measures(study)["incorrect"] == 0
    assert list((shared / "tallyforge").iterdir()) == []
    assert study.scored.count() == measures(study)["n_test"]


def test_study_without_a_shared_folder(spark, data, monkeypatch):
    monkeypatch.setattr(staging, "shared_folder", lambda _: None)
    got = measures(studies.formula_cluster_study(flows(spark, data), FLOW_KEY, seed=3))
    assert got["n_train"] + got["n_test"] == got["n_rows"]


def test_perceptron_study_scaled(spark, data):
    got = measures(
        studies.perceptron_study(flows(spark, data, spread=True), FLOW_KEY, scale=True, seed=1)
    )
    assert got["accuracy"] > 0.95
    assert got["accuracy"] == pytest.approx(got["ratio_correct"])


def test_formula_perceptron_study(spark, data):
    study = studies.formula_perceptron_study(
        flows(spark, data, spread=True), FLOW_KEY, scale=True, seed=1
    )
    got = measures(study)
    assert got["ratio_correct"] > 0.95 and got["tp_rate"] > 0.9
    assert set(study.features.labels) == {"0.0", "1.0"}
    assert study.model.stages[-1].getLayers() == [9, 10, 10, 2]


def test_formula_forest_study(spark, data):
    study = studies.formula_forest_study(
        flows(spark, data, spread=True), FLOW_KEY, seed=1, subset="all"
    )
    got = measures(study)
    assert got["incorrect"] == 0 and got["tp"] < got["tn"]
    assert {r["decoded"] for r in study.scored.select("decoded").distinct().collect()} == {
        "normal",
        "attack",
    }


def test_cluster_studies(spark, data):
    records = flows(spark, data, spread=True)
    study = studies.cluster_study(records, FLOW_KEY)
    got = measures(study)
    assert len(study.model.clusterCenters()) == 4
    assert got["total"] == 6000 == got["correct"] + got["incorrect"]
    assert got["wssse"] <= study.model.summary.trainingCost * (1 + 1e-9)

    binary = studies.formula_cluster_study(records, FLOW_KEY, seed=3)
    assert len(binary.model.clusterCenters()) == 2
    assert binary.counts.agg(F.sum("n")).first()[0] == measures(binary)["n_test"]


def test_perceptron_summary(spark, data):
    features = fit_features(binary_flows(spark, data), connection_spec(key=[FLOW_KEY]), "ordinal")
    rows = features.transform(binary_flows(spark, data))
    model = classify.perceptron(rows, 2, iterations=1, seed=1).fit(rows)
    found = tuples(classify.perceptron_summary(model, rows))
    assert [v for item, _, v in found if item == "layer"] == [10, 10, 10, 2]
    assert found[-1][2] == 10 * 10 + 10 + 10 * 10 + 10 + 10 * 2 + 2


def test_measures_that_depend_on_the_start_are_returned(spark, data):
    """One cluster for all rows, or no measures at all, would not pass."""
    queries = catalogue.QUERIES
    counts = queries["kmeans_formula_contingency_table"](spark, data).collect()
    assert {r["truth"] for r in counts} == {"normal", "attack"} and len({r["prediction"] for r in counts}) > 1
    per_class = {r["truth"]: r["n"] for r in queries["kmeans_formula_contingency"](spark, data).collect()}
    assert {t: sum(r["n"] for r in counts if r["truth"] == t) for t in per_class} == per_class
    wanted = {
        "mlp_unscaled_measures": {"tp", "tn", "fp", "fn"},
        "mlp_formula_measures": {"tp_rate", "tn_rate", "fp_rate", "fn_rate"},
        "forest_formula_default_measures": {"tp", "tn", "fp", "fn"},
        "kmeans_study_measures": {"wssse"},
    }
    for name, names in wanted.items():
        found = dict(tuples(queries[name](spark, data)))
        assert names | {"correct", "incorrect", "ratio_correct"} <= set(found)
        assert found["correct"] + found["incorrect"] == found["total"] > 0


def test_clustering_study_compares_its_centres_with_the_column_means(spark, data):
    name = "centres weighted by size against column means"
    found = {r["metric"]: r["value"] for r in catalogue.QUERIES["kmeans_study"](spark, data).collect()}
    assert found[name] == 0.0
    assert name in catalogue.ORACLES["kmeans_study"]
