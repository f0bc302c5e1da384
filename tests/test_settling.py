import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tallyforge.operators import blocks, cluster, settling
from tallyforge.operators.blocks import pack
from tallyforge.plans import model_queries


def vectors(spark, n=6000, seed=3):
    """Numbers without gaps between the clusters, so that there are many rounds, and a few sparse slots."""
    rng = np.random.default_rng(seed)
    values = np.zeros((n, 6))
    values[:, 0] = rng.random(n) ** 2 * 1000
    values[:, 1] = rng.normal(size=n) * 30
    values[np.arange(n), rng.integers(2, 6, n)] = 1.0
    values[: n // 50] = 0.0
    rows = [
        (Vectors.dense(v) if i % 3 else Vectors.sparse(6, {j: x for j, x in enumerate(v) if x}),)
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, ["features"]).repartition(4).cache(), values


def lloyd(values, centers, rounds):
    for done in range(1, rounds + 1):
        found = ((values[:, None, :] - centers[None, :, :]) ** 2).sum(axis=2)
        nearest, before = found.argmin(axis=1), centers
        centers = np.stack([values[nearest == j].mean(axis=0) if (nearest == j).any() else c for j, c in enumerate(centers)])
        if (before == centers).all():
            break
    return centers, found.min(axis=1).sum(), done


@pytest.mark.parametrize("rounds", [3, 200])
def test_rounds_are_those_of_lloyd_and_read_settled_rows_no_more(spark, monkeypatch, rounds):
    df, values = vectors(spark)
    start = values[[100, 200, 300, 400]]
    read, sums = [], settling._sums
    monkeypatch.setattr(settling, "FEW_ROWS", 100)
    monkeypatch.setattr(blocks, "BLOCK_ROWS", 500)
    monkeypatch.setattr(settling, "_sums", lambda *a: read.append(sums(*a)) or read[-1])
    monkeypatch.setattr(settling.SettlingKMeans, "_start", lambda *_: start.copy())
    model = cluster.kmeans_parallel(4, iterations=rounds).setTol(0.0).fit(df)
    centers, cost, done = lloyd(values, start, rounds)
    assert np.array(model.clusterCenters()) == pytest.approx(centers, rel=1e-9, abs=1e-9)
    assert model.summary.trainingCost == pytest.approx(cost)
    assert done <= model.summary.numIter <= done + 3
    if rounds == 200:
        # Before, each round read all rows.
        assert done > 20 and sum(int(s.rows.sum()) for s in read) < done * len(values) / 2


@pytest.mark.parametrize("seed", [0, 4])
def test_levels_end_where_reading_all_rows_ends(spark, monkeypatch, seed):
    df, values = vectors(spark, n=3000, seed=seed)
    with blocks.kept(pack(df, "features", 6)) as packed:
        fit = cluster.kmeans_parallel(5, iterations=300).setTol(0.0)
        start = values[np.random.default_rng(seed).integers(100, 3000, 5)]
        monkeypatch.setattr(settling, "FEW_ROWS", 20)
        some = fit._rounds(packed, start.copy())
    centers, cost, done = lloyd(values, start, 300)
    assert some[0] == pytest.approx(centers, rel=1e-9, abs=1e-9)
    # A change of level rounds the sums anew, which may cost a round or two without a change of cluster.
    assert some[1] == pytest.approx(cost) and done <= some[2] <= done + 3


def test_a_level_holds_while_no_centre_is_beyond_its_reach():
    level = settling.Level(None, np.zeros((2, 3)), 1.0, None)
    assert level.holds(np.full((2, 3), 0.5)) and not level.holds(np.array([[0.0, 0, 0], [0, 2, 0]]))


def test_rows_drawn_at_random(spark):
    number = F.col("id").cast("double")
    df = spark.range(1000, numPartitions=7).select(array_to_vector(F.array(number)).alias("features"))
    packed = pack(df, "features", 1)
    first = settling.random_rows(packed, 100, 1, 5)
    assert len(np.unique(first)) == 100 and 300 < first.mean() < 700
    assert (first == settling.random_rows(packed, 100, 1, 5)).all()
    assert (first != settling.random_rows(packed, 100, 1, 6)).any()


def test_fewer_different_rows_than_clusters(spark):
    df = spark.createDataFrame([(Vectors.dense(x, 0.0),) for x in (1.0, 1.0, 5.0, 5.0)], ["features"])
    for fit in (cluster.kmeans_parallel(3), cluster.kmeans_random(4, seed=1)):
        assert sorted(c[0] for c in fit.fit(df).clusterCenters()) == [1.0, 5.0]


def test_vectors_without_values_are_refused(spark):
    for odd in (float("nan"), float("inf")):
        df = spark.createDataFrame([(Vectors.dense(1.0),), (Vectors.dense(odd),), (Vectors.dense(3.0),)], ["features"])
        with pytest.raises(Exception, match="NaN"):
            cluster.kmeans_parallel(2).fit(df)


@pytest.mark.parametrize("name", ["kmeans_parallel_features", "kmeans_random_features"])
def test_feature_queries_settle_rows(spark, data, monkeypatch, name):
    """The queries' fits leave settled rows out; before, all of up to 200 rounds read every row."""
    read, sums = [], settling._sums
    monkeypatch.setattr(settling, "FEW_ROWS", 100)
    monkeypatch.setattr(settling, "_sums", lambda *a: read.append(int((s := sums(*a)).rows.sum())) or s)
    found = {r["metric"]: r["value"] for r in getattr(model_queries, name)(spark, data).collect()}
    assert found == {"k": 4.0, "sum of sizes": 6000.0, "centres against means of members": 0.0}
    assert max(read) == 6000 and sum(read) < len(read) * 6000 / 2
