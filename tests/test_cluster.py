import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.mllib.clustering import KMeans as RddKMeans, KMeansModel as RddKMeansModel
from pyspark.sql import functions as F

from tallyforge.operators import cluster
from tallyforge.sources.tables import table

from tests.conftest import tuples


def points(spark, n=400, d=3, seed=0):
    rng = np.random.default_rng(seed)
    values = rng.normal(size=(n, d)) + rng.integers(0, 3, size=(n, 1)) * 4
    rows = [(i, int(i % 3), [float(v) for v in row]) for i, row in enumerate(values)]
    return spark.createDataFrame(rows, "id int, g int, x array<double>"), values


def test_wssse_equals_brute_force_with_final_centres(spark):
    df, values = points(spark)
    vectors = df.select("id", array_to_vector("x").alias("features"))
    model = cluster.kmeans_parallel(3).setMaxIter(1).fit(vectors)
    scored = model.transform(vectors)
    centers = cluster.model_centers(model)
    by_hand = sum(
        ((values[r["id"]] - centers[r["prediction"]]) ** 2).sum() for r in scored.collect()
    )
    assert cluster.wssse(scored, centers).first()["wssse"] == pytest.approx(by_hand)
    # Stopped early, the summary's cost belongs to earlier centres.
    assert model.summary.trainingCost > by_hand


def test_wssse_of_sparse_vectors_and_single_members(spark):
    rows = [(0, Vectors.sparse(3, {0: 2.0})), (1, Vectors.dense(0.0, 1.0, 0.0)), (1, Vectors.sparse(3, {}))]
    df = spark.createDataFrame(rows, ["prediction", "features"])
    got = cluster.wssse(df, {0: [1.0, 0.0, 0.0], 1: [0.0, 0.0, 0.0]}).first()["wssse"]
    assert got == pytest.approx(1.0 + 1.0)


def test_warm_start_equals_mllib_with_an_initial_model(spark):
    df, values = points(spark)
    start = cluster.first_of_each(df, "g", "id", "x")
    assert start == {g: [float(v) for v in values[g]] for g in range(3)}
    ours = cluster.warm_start(df, "x", start, iterations=4)
    theirs = RddKMeans.train(
        spark.sparkContext.parallelize(values),
        3,
        maxIterations=4,
        epsilon=0.0,
        initialModel=RddKMeansModel([np.array(c) for c in start.values()]),
    )
    assert np.array([ours[k] for k in range(3)]) == pytest.approx(np.array(theirs.clusterCenters))


def test_cluster_without_rows_keeps_its_centre(spark):
    df, _ = points(spark)
    far = {0: [0.0, 0.0, 0.0], 1: [1e9, 1e9, 1e9]}
    moved = cluster.warm_start(df, "x", far, iterations=2)
    assert moved[1] == far[1] and moved[0] != far[0]


def test_nearest_prefers_the_smaller_id_on_ties(spark):
    df = spark.createDataFrame([([0.0],), ([3.0],)], "x array<double>")
    out = cluster.assign(df, "x", {0: [-1.0], 1: [1.0], 2: [2.5]})
    assert [r["prediction"] for r in out.collect()] == [0, 2]


def test_summary_lists_empty_clusters(spark):
    df, _ = points(spark)
    vectors = df.select(array_to_vector("x").alias("features"))
    model = cluster.kmeans_random(3, seed=2).fit(vectors)
    some = model.transform(vectors).filter("prediction = 0")
    sizes = dict(tuples(cluster.cluster_summary(model, some)))
    assert len(sizes) == 3 and sizes[1] == 0 and sizes[0] > 0


def test_centers_table(spark):
    out = cluster.centers_table(spark, {0: [1.0, 2.0], 1: [3.0, 4.0]})
    assert set(tuples(out)) == {(0, 0, 1.0), (0, 1, 2.0), (1, 0, 3.0), (1, 1, 4.0)}


def test_k_of_one_is_rejected(spark):
    df, _ = points(spark)
    with pytest.raises(Exception):
        cluster.kmeans_parallel(1).fit(df.select(array_to_vector("x").alias("features")))


def test_fit_settings(spark):
    fit = cluster.kmeans_parallel(5)
    assert (fit.getK(), fit.getSeed(), fit.getMaxIter(), fit.getInitMode()) == (5, 1, 10, "k-means||")
    assert cluster.kmeans_random(2).getInitMode() == "random"


def test_embeddings_assignment_is_the_nearest_centre(spark, data):
    df = table(spark, data, "embeddings")
    start = cluster.first_of_each(df, "label", "vec_id", "embedding")
    got = {r["vec_id"]: r["prediction"] for r in cluster.assign(df, "embedding", start).collect()}
    centers = np.array([start[k] for k in sorted(start)])
    for row in df.collect():
        gaps = ((centers - np.array(row["embedding"])) ** 2).sum(axis=1)
        assert gaps[got[row["vec_id"]]] == pytest.approx(gaps.min())


def test_moments_use_partial_aggregation(spark):
    df, _ = points(spark)
    vectors = df.select("g", array_to_vector("x").alias("features"))
    plan = cluster.cluster_moments(vectors, "g")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ObjectHashAggregate") == 2
    assert cluster.cluster_moments(vectors, "g").agg(F.sum("size")).first()[0] == 400


def test_summary_holds_k_sizes_and_centres(spark):
    df, _ = points(spark)
    vectors = df.select(array_to_vector("x").alias("features"))
    model = cluster.kmeans_parallel(3, iterations=4).fit(vectors)
    rows = cluster.kmeans_summary(model, model.transform(vectors)).collect()
    assert [r["value"] for r in rows if r["item"] == "k"] == [3.0]
    assert sum(r["value"] for r in rows if r["item"] == "size") == 400
    centers = {(r["cluster"], r["pos"]): r["value"] for r in rows if r["item"] == "center"}
    assert centers == {(k, i): v for k, c in cluster.model_centers(model).items() for i, v in enumerate(c)}


def test_too_many_groups_are_refused(spark):
    df, _ = points(spark)
    with pytest.raises(ValueError):
        cluster.first_of_each(df, "id", "id", "x", max_groups=10)


def test_too_many_given_centres_are_refused(spark):
    df, _ = points(spark)
    with pytest.raises(ValueError):
        cluster.assign(df, "x", {i: [0.0] * 1001 for i in range(100)})
