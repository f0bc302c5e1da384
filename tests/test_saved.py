"""Models and studies saved whole, and decoding with dictionaries held as tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.operators import classify, cluster, saved
from tallyforge.operators import features as ft
from tallyforge.operators.dictionaries import fit_dictionaries, value_by_join
from tallyforge.operators.split import in_training
from tallyforge.plans import studies
from tallyforge.plans.shared import SPEC, binary_flows
from tallyforge.sources.tables import FLOW_KEY, flows

from tests.conftest import tuples


def alike(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("size", [1000, 2])
def test_whole_tree_scores_raw_records_as_before(spark, data, shared, size):
    records = binary_flows(spark, data)
    features = ft.fit_features(records, SPEC, max_size=size)
    assert (features.classes, bool(features.dictionaries.large)) == (2, size == 2)
    rows = features.transform(records)
    whole = saved.WholeModel(features, classify.decision_tree("features", "label").fit(rows), "string")
    again = saved.load_whole(spark, saved.save_whole(whole, spark, str(shared / "kept")))
    raw = flows(spark, data).drop("class")
    columns = [FLOW_KEY, "duration", "prediction", "decoded"]
    a, b = (m.transform(raw).select(columns) for m in (whole, again))
    assert alike(a, b) and a.count() == 6000
    assert again.features.dictionaries.sizes == features.dictionaries.sizes
    assert set(again.features.dictionaries.large) == set(features.dictionaries.large)
    names = {(r["prediction"], r["decoded"]) for r in a.select("prediction", "decoded").distinct().collect()}
    assert names == {(0.0, "attack"), (1.0, "normal")}
    # Saving again replaces what is there.
    saved.save_whole(whole, spark, str(shared / "kept"))
    assert alike(saved.load_whole(spark, str(shared / "kept")).transform(raw).select(columns), a)


def test_whole_model_refuses_unseen_values_as_the_encoding_does(spark, data):
    records = binary_flows(spark, data)
    features = ft.fit_features(records.where("service <> 'svc1'"), SPEC, max_size=2)
    rows = features.transform(records.where("service <> 'svc1'"))
    whole = saved.roundtrip_whole(saved.WholeModel(features, classify.decision_tree("features", "label").fit(rows)), spark)
    with pytest.raises(Exception, match="svc1"):
        whole.transform(records).count()


def test_every_study_is_read_back_with_its_reports_and_scores_raw_records(spark, data, shared, size=2):
    records = flows(spark, data, spread=True)
    raw = flows(spark, data).where(~in_training(FLOW_KEY)).drop("class")
    made = {
        "tree": studies.tree_study(records, FLOW_KEY, bins=(65,), depths=(4,), folds=2, dictionary_size=size),
        "net": studies.formula_perceptron_study(records, FLOW_KEY, scale=True, seed=1, dictionary_size=size),
        "forest": studies.formula_forest_study(records, FLOW_KEY, seed=1, dictionary_size=size),
        "clusters": studies.formula_cluster_study(records, FLOW_KEY, seed=3, dictionary_size=size),
    }
    for name, study in made.items():
        again = studies.load_study(spark, studies.save_study(study, spark, str(shared / name)))
        assert again.scored is None and alike(again.measures, study.measures) and alike(again.counts, study.counts)
        assert set(again.tables) == set(study.tables)
        columns = [FLOW_KEY, "prediction"] + (["decoded"] if study.decoded else [])
        assert alike(again.score(raw).select(columns), study.scored.select(columns)), name


def test_k_means_comes_back_with_its_centres(spark, data, shared):
    study = studies.cluster_study(flows(spark, data, spread=True), FLOW_KEY, dictionary_size=2)
    assert study.features.classes == 4
    again = studies.load_study(spark, studies.save_study(study, spark, str(shared / "k")))
    assert cluster.model_centers(again.model) == cluster.model_centers(study.model)
    assert set(again.tables) == {"summary", "histogram", "classes"}
    assert alike(again.tables["summary"], study.tables["summary"])


@pytest.mark.parametrize("size", [1, 3, 100])
def test_decoding_by_join_equals_the_list(spark, size):
    values = spark.createDataFrame([(v,) for v in "c a a b c c c d e".split()], "v string")
    found = fit_dictionaries(values, ["v"], max_size=size)
    rows = [(i, float(i % 5)) for i in range(40)] + [(99, 3.0)] * 300
    df = spark.createDataFrame(rows, "id int, value double").repartition(3)
    out = tuples(found.decode(df, "v", "value", "name"))
    assert len(out) == 340 and all(n == "cabde"[int(v)] for _, v, n in out)
    with pytest.raises(Exception, match="null"):
        found.decode(df.withColumn("value", F.lit(None).cast("double")), "v", "value", "name").collect()
    assert (found.labels("v") == list("cabde")) if "v" in found.small else ("v" in found.large)


def test_decoding_an_unknown_index_is_an_error(spark):
    ranks = spark.createDataFrame([("x", 0.0), ("y", 1.0)], "value string, idx double")
    df = spark.createDataFrame([(5.0,)], "prediction double")
    for head in (1, 10):
        with pytest.raises(Exception, match="5.0"):
            value_by_join(df, "prediction", ranks, "out", head).collect()
    assert tuples(ft.decode_labels(df.select(F.lit(1.0).alias("prediction")), ranks)) == [(1.0, "y")]


def test_cold_values_of_a_dictionary_are_not_broadcast(spark):
    ranks = spark.range(50).selectExpr("concat('v', id) as value", "cast(id as double) as idx")
    df = spark.range(1000).selectExpr("cast(id % 50 as double) as prediction")
    plan = value_by_join(df.hint("merge"), "prediction", ranks, "out", 5, 50)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 2 and plan.count("strategy=broadcast") == 1


def test_tree_rules_are_the_tree(spark, data):
    records = binary_flows(spark, data)
    rows = ft.fit_features(records, SPEC).transform(records)
    tree = classify.decision_tree("features", "label", maxDepth=4).fit(rows)
    nodes = {r["id"]: r for r in classify.tree_rules(tree, rows).collect()}
    assert len(nodes) == tree.numNodes and nodes[0]["parent"] is None and nodes[0]["rows"] == 6000
    for r in nodes.values():
        below = [n for n in nodes.values() if n["parent"] == r["id"]]
        assert sorted(n["side"] for n in below) == (["left", "right"] if r["slot"] else [])
        if below:
            assert sum(n["rows"] for n in below) == r["rows"] and r["gain"] > 0
            assert (r["threshold"] is None) != (r["categories"] is None)
    slots = ft.slot_names(rows)
    for row in rows.select("features").limit(200).collect():
        node = nodes[0]
        while node["slot"]:
            value = row["features"][slots.index(node["slot"])]
            left = value in node["categories"] if node["categories"] else value <= node["threshold"]
            node = next(n for n in nodes.values() if n["parent"] == node["id"] and n["side"] == ("left" if left else "right"))
        assert node["prediction"] == tree.predict(row["features"])


def test_rules_of_a_forest_name_their_trees(spark, data):
    records = binary_flows(spark, data)
    rows = ft.fit_features(records, SPEC).transform(records)
    forest = classify.random_forest(trees=3, depth=2, seed=1).fit(rows)
    counts = dict(tuples(classify.tree_rules(forest, rows).groupBy("tree").count()))
    assert counts == {i: t.numNodes for i, t in enumerate(forest.trees)}


def test_weights_of_a_net_give_its_scores(spark, data):
    records = binary_flows(spark, data)
    rows = ft.fit_features(records, SPEC, "ordinal").transform(records)
    net = classify.perceptron(rows, 2, iterations=3, seed=1).fit(rows)
    weights = classify.perceptron_weights(net, rows)
    assert weights.count() == net.weights.size
    table = {(r["layer"], r["source"], r["target"]): r["value"] for r in weights.collect()}
    scored = net.transform(rows).withColumn("again", classify.perceptron_scores(weights, F.col("features")))
    for r in scored.limit(50).collect():
        x = r["features"].toArray()
        for layer, (wide, out) in enumerate(zip(net.getLayers(), net.getLayers()[1:]), 1):
            w = np.array([[table[layer, i, j] for j in range(out)] for i in range(wide)])
            x = x @ w + np.array([table[layer, None, j] for j in range(out)])
            x = 1 / (1 + np.exp(-x)) if layer < 3 else np.exp(x - x.max()) / np.exp(x - x.max()).sum()
        assert np.allclose(x, r["probability"].toArray()) and np.allclose(x, r["again"])
