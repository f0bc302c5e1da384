"""k-means from random or given centres, and what is measured of a clustering."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.mllib.clustering import KMeans as StartedKMeans, KMeansModel as StartModel
from pyspark.mllib.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyforge.operators.settling import SettlingKMeans

# The clustering studies' settings.
KMEANS_ITERATIONS = 10
KMEANS_SEED = 1
# Centres are held by the driver and sent to every task.
MAX_CLUSTERS = 10_000
# Coordinates of given centres, all together, that may stand in an expression as constants.
MAX_COORDINATES = 100_000

Centers = Mapping[int, Sequence[float]]


def kmeans_parallel(
    k: int, features: str = "features", seed: int = KMEANS_SEED, iterations: int = KMEANS_ITERATIONS
) -> KMeans:
    """k-means with the scalable k-means|| start."""
    return SettlingKMeans(k=k, featuresCol=features, seed=seed, maxIter=iterations)


def kmeans_random(
    k: int,
    features: str = "features",
    seed: int | None = None,
    iterations: int = KMEANS_ITERATIONS,
) -> KMeans:
    """k-means started from randomly drawn rows."""
    fit = SettlingKMeans(k=k, featuresCol=features, maxIter=iterations, initMode="random")
    return fit if seed is None else fit.setSeed(seed)


def model_centers(model: KMeansModel) -> dict[int, list[float]]:
    return {i: [float(v) for v in c] for i, c in enumerate(model.clusterCenters())}


def centers_table(spark: SparkSession, centers: Centers) -> DataFrame:
    """Centres as ``(cluster, pos, value)`` rows."""
    rows = [(int(k), i, float(v)) for k, c in centers.items() for i, v in enumerate(c)]
    return spark.createDataFrame(rows, "cluster int, pos int, value double")


def cluster_moments(df: DataFrame, cluster: str, features: str = "features") -> DataFrame:
    """Size, mean vector and variance vector of every cluster in one aggregation."""
    summary = Summarizer.metrics("count", "mean", "variance").summary(F.col(features))
    return df.groupBy(F.col(cluster).alias("cluster")).agg(summary.alias("s")).select(
        F.col("cluster").cast("int").alias("cluster"),
        F.col("s.count").alias("size"),
        F.col("s.mean").alias("mean"),
        F.col("s.variance").alias("variance"),
    )


def cluster_costs(
    df: DataFrame, centers: Centers, cluster: str = "prediction", features: str = "features"
) -> DataFrame:
    """Squared distances of rows to their cluster's centre, added up per cluster.

    Rows are reduced to per-cluster moments first: the squared distances to a centre ``c`` add up
    to ``(n - 1) * variance + n * (mean - c)^2`` in every dimension.
    """
    known = centers_table(df.sparkSession, centers)
    moments = cluster_moments(df, cluster, features).select(
        "cluster",
        "size",
        F.posexplode(
            F.arrays_zip(
                vector_to_array("mean").alias("mean"),
                vector_to_array("variance").alias("variance"),
            )
        ).alias("pos", "m"),
    )
    part = (F.col("size") - 1) * F.col("m.variance") + F.col("size") * F.pow(
        F.col("m.mean") - F.col("value"), F.lit(2.0)
    )
    return moments.join(known, ["cluster", "pos"]).groupBy("cluster").agg(F.sum(part).alias("cost"))


def wssse(
    df: DataFrame, centers: Centers, cluster: str = "prediction", features: str = "features"
) -> DataFrame:
    """Within-set sum of squared errors of any assigned table, as one row.

    A fitted model's ``trainingCost`` belongs to the centres before its last update and differs
    from this when the fit stopped at its iteration limit.
    """
    return cluster_costs(df, centers, cluster, features).agg(F.sum("cost").alias("wssse"))


def kmeans_summary(model: KMeansModel, scored: DataFrame) -> DataFrame:
    """A fitted k-means in one table: k, size of every cluster and every coordinate of its centre.

    Rows are ``(item, cluster, pos, value)`` with the items ``k``, ``size`` and ``center``.
    """
    spark = scored.sparkSession
    centers = model_centers(model)
    rows = [("k", None, None, float(len(centers)))]
    rows += [("center", k, i, float(v)) for k, c in centers.items() for i, v in enumerate(c)]
    fixed = spark.createDataFrame(rows, "item string, cluster int, pos int, value double")
    sizes = cluster_summary(model, scored).select(
        F.lit("size").alias("item"),
        "cluster",
        F.lit(None).cast("int").alias("pos"),
        F.col("size").cast("double").alias("value"),
    )
    return fixed.unionByName(sizes)


def cluster_summary(model: KMeansModel, scored: DataFrame) -> DataFrame:
    """Size of every fitted cluster, empty ones included."""
    sizes = scored.groupBy(F.col(model.getPredictionCol()).alias("cluster")).agg(
        F.count("*").alias("size")
    )
    spark = scored.sparkSession
    ids = spark.range(len(model.clusterCenters())).select(F.col("id").cast("int").alias("cluster"))
    return ids.join(sizes, "cluster", "left").select(
        "cluster", F.coalesce("size", F.lit(0)).cast("bigint").alias("size")
    )


def first_of_each(
    df: DataFrame, group: str, order: str, vector: str, max_groups: int = MAX_CLUSTERS
) -> dict[int, list[float]]:
    """One starting centre per group: the vector of its row with the smallest ``order``.

    The groups become clusters 0, 1, … in ascending order; one row per group reaches the driver.
    More than ``max_groups`` groups are an error.
    """
    rows = (
        df.groupBy(group)
        .agg(F.min_by(vector, order).alias("start"))
        .orderBy(group)
        .select("start")
        .limit(max_groups + 1)
        .collect()
    )
    if len(rows) > max_groups:
        raise ValueError(f"more than {max_groups} groups of {group}")
    return {i: [float(v) for v in row["start"]] for i, row in enumerate(rows)}


def nearest(vector: Column, centers: Centers) -> Column:
    """Id of the nearest centre of an array column (ties: the smallest id).

    The centres are constants of the expression, so this is for few and short ones; more than
    ``MAX_COORDINATES`` numbers are refused. A fitted model's own ``transform`` has no such bound.
    """
    if sum(len(c) for c in centers.values()) > MAX_COORDINATES:
        raise ValueError(f"centres of more than {MAX_COORDINATES} numbers; use a fitted model instead")

    def distance(center: Sequence[float]) -> Column:
        gaps = F.zip_with(vector, F.lit(list(center)), lambda x, c: (x - c) * (x - c))
        return F.aggregate(gaps, F.lit(0.0), lambda total, gap: total + gap)

    options = [F.struct(distance(c).alias("d"), F.lit(k).alias("k")) for k, c in centers.items()]
    return F.array_min(F.array(*options))["k"]


def warm_start(
    df: DataFrame, vector: str, centers: Centers, iterations: int
) -> dict[int, list[float]]:
    """k-means from given centres, for small data.

    Only the engine's RDD interface takes starting centres, so the rows' vectors pass through
    Python once; they are kept for the rounds of the fit.
    """
    order = sorted(centers)
    start = StartModel([Vectors.dense(centers[k]) for k in order])
    points = df.select(F.col(vector).cast("array<double>").alias("x")).rdd.map(
        lambda row: Vectors.dense(row["x"])
    )
    points.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fitted = StartedKMeans.train(
            points, len(order), maxIterations=iterations, epsilon=0.0, initialModel=start
        )
    finally:
        points.unpersist()
    return {k: [float(v) for v in c] for k, c in zip(order, fitted.clusterCenters)}


def assign(
    df: DataFrame, vector: str, centers: Centers, output: str = "prediction"
) -> DataFrame:
    """Add the id of the nearest centre."""
    return df.withColumn(output, nearest(F.col(vector).cast("array<double>"), centers))
