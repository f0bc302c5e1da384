"""Classifiers, tuning and scoring on MLlib."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, functions as F

from tallyforge.operators.features import slot_names, vector_size
from tallyforge.operators.tree_search import SharedTreeSearch
from tallyforge.staging import delete_path, new_shared_path, settle

# The studies' model settings.
GRID_BINS = (65, 68, 71)
GRID_DEPTHS = (4, 6, 8)
CV_FOLDS = 4
FOREST_TREES = 5
FOREST_DEPTH = 6
FOREST_BINS = 68
HIDDEN_LAYERS = (10, 10)
PERCEPTRON_ITERATIONS = 100
PERCEPTRON_BLOCK = 128


def decision_tree(
    features: str = "indexedFeatures", label: str = "indexedLabel", **params: object
) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(featuresCol=features, labelCol=label, **params)


def random_forest(
    features: str = "features",
    label: str = "label",
    *,
    trees: int = FOREST_TREES,
    depth: int = FOREST_DEPTH,
    bins: int = FOREST_BINS,
    **params: object,
) -> RandomForestClassifier:
    return RandomForestClassifier(
        featuresCol=features,
        labelCol=label,
        numTrees=trees,
        maxDepth=depth,
        maxBins=bins,
        **params,
    )


def perceptron(
    train: DataFrame,
    classes: int,
    features: str = "features",
    label: str = "label",
    *,
    hidden: Sequence[int] = HIDDEN_LAYERS,
    iterations: int = PERCEPTRON_ITERATIONS,
    block: int = PERCEPTRON_BLOCK,
    **params: object,
) -> MultilayerPerceptronClassifier:
    """A net as wide as the vectors of ``train``, with one output per class."""
    return MultilayerPerceptronClassifier(
        featuresCol=features,
        labelCol=label,
        layers=[vector_size(train, features), *hidden, classes],
        maxIter=iterations,
        blockSize=block,
        **params,
    )


def cross_validator(
    tree: DecisionTreeClassifier,
    *,
    bins: Sequence[int] = GRID_BINS,
    depths: Sequence[int] = GRID_DEPTHS,
    folds: int = CV_FOLDS,
    fold_column: str | None = None,
    label: str = "label",
    parallelism: int = 1,
    seed: int | None = None,
) -> CrossValidator:
    """Search a bins × depth grid for the largest area under ROC.

    With a ``fold_column`` the folds follow the row keys and are the same on every run, and all fits of the
    search pass over the rows together; otherwise rows are assigned at random and fitted one by one.
    """
    grid = ParamGridBuilder().addGrid(tree.maxBins, list(bins)).addGrid(tree.maxDepth, list(depths))
    search = SharedTreeSearch(
        estimator=tree,
        estimatorParamMaps=grid.build(),
        evaluator=BinaryClassificationEvaluator(
            rawPredictionCol="rawPrediction", labelCol=label, metricName="areaUnderROC", numBins=0
        ),
        numFolds=folds,
        parallelism=parallelism,
    )
    if fold_column is not None:
        search.setFoldCol(fold_column)
    if seed is not None:
        search.setSeed(seed)
    return search


def predict(model: Model, df: DataFrame) -> DataFrame:
    """Score rows; every input column is kept, so scores stay attached to their rows."""
    return model.transform(df)


def tree_summary(model: Model, scored: DataFrame) -> DataFrame:
    """Importance of every feature slot of a fitted tree or forest."""
    importances = model.featureImportances.toArray()
    names = slot_names(scored, model.getFeaturesCol())
    rows = [(i, names[i], float(v)) for i, v in enumerate(importances)]
    return scored.sparkSession.createDataFrame(rows, "pos int, slot string, importance double")


def perceptron_summary(model: Model, df: DataFrame) -> DataFrame:
    """Layer sizes and weight count of a fitted net."""
    rows = [("layer", i, int(n)) for i, n in enumerate(model.getLayers())]
    rows.append(("weights", 0, int(model.weights.size)))
    return df.sparkSession.createDataFrame(rows, "item string, pos int, value bigint")


def tree_rules(model: Model, scored: DataFrame) -> DataFrame:
    """The nodes of a fitted tree or forest as a table, one row per node.

    ``tree`` and ``id`` name the node, ``parent`` the node above it and ``side`` which branch it is. An inner
    node sends a row left if its ``slot`` is at most ``threshold``, or has one of ``categories``. ``gain`` is
    what its split gains (null for leaves), ``rows`` the training rows that reached it.

    The nodes are read from the model's saved form, so their number is no burden for the driver.
    """
    spark = scored.sparkSession
    path = new_shared_path(spark, "tree-nodes")
    try:
        model.write().overwrite().save(path)
        saved = spark.read.parquet(f"{path}/data")
        if "nodeData" in saved.columns:
            saved = saved.select(F.col("treeID").alias("tree"), "nodeData.*")
        else:
            saved = saved.withColumn("tree", F.lit(0))
        inner = F.col("leftChild") >= 0
        categorical = F.col("split.numCategories") >= 0
        limits = F.col("split.leftCategoriesOrThreshold")
        nodes = saved.select(
            F.col("tree").cast("int").alias("tree"),
            F.col("id").cast("int").alias("id"),
            F.when(inner, F.col("split.featureIndex")).cast("int").alias("pos"),
            F.when(inner & ~categorical, F.try_element_at(limits, F.lit(1))).alias("threshold"),
            F.when(inner & categorical, F.array_sort(limits)).alias("categories"),
            F.when(inner, F.col("gain")).alias("gain"),
            "impurity",
            "prediction",
            F.col("rawCount").cast("bigint").alias("rows"),
        )
        links = saved.where(inner).select(
            F.col("tree").cast("int").alias("tree"),
            F.col("id").cast("int").alias("parent"),
            F.inline(
                F.array(
                    F.struct(F.col("leftChild").cast("int").alias("id"), F.lit("left").alias("side")),
                    F.struct(F.col("rightChild").cast("int").alias("id"), F.lit("right").alias("side")),
                )
            ),
        )
        names = slot_names(scored, model.getFeaturesCol())
        slots = spark.createDataFrame(list(enumerate(names)), "pos int, slot string")
        return settle(
            nodes.join(links, ["tree", "id"], "left")
            .join(slots, "pos", "left")
            .select(
                "tree", "id", "parent", "side", "slot", "threshold", "categories", "gain", "impurity", "prediction", "rows"
            )
        )
    finally:
        delete_path(spark, path)


def perceptron_weights(model: Model, df: DataFrame) -> DataFrame:
    """Every number of a fitted net as ``(layer, source, target, value)``.

    Layer 1 leads from the input slots to the first hidden nodes. A ``source`` of null stands for the
    constant that is added to the ``target`` node.
    """
    layers, weights = model.getLayers(), model.weights.toArray()
    rows, at = [], 0
    for layer, (wide, out) in enumerate(zip(layers, layers[1:]), 1):
        for source in [*range(wide), None]:
            rows += [(layer, source, target, float(weights[at + target])) for target in range(out)]
            at += out
    return df.sparkSession.createDataFrame(rows, "layer int, source int, target int, value double")


def perceptron_scores(weights: DataFrame, features: Column) -> Column:
    """Class scores of a vector column from a net's weights alone, as an array.

    The weights, as many as the model has, become constants of the expression.
    """
    nodes: dict[int, dict[int, list[float]]] = {}
    # Constants last: the input has one entry less than a node has weights, and counts as 1 there.
    for row in weights.orderBy("layer", "target", F.asc_nulls_last("source")).collect():
        nodes.setdefault(row["layer"], {}).setdefault(row["target"], []).append(row["value"])
    values = vector_to_array(features)
    for layer in sorted(nodes):
        values = _once(values, _layer([F.lit(w) for w in nodes[layer].values()]))
        if layer < len(nodes):
            values = F.transform(values, lambda v: 1 / (1 + F.exp(-v)))
    raised = _once(values, lambda x: F.transform(x, lambda v: F.exp(v - F.array_max(x))))
    return _once(raised, lambda x: F.transform(x, lambda v: v / F.aggregate(x, F.lit(0.0), lambda a, b: a + b)))


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` computed once per row."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _layer(nodes: list[Column]) -> Callable[[Column], Column]:
    """The weighted sums of all nodes of a layer, given the values before it."""

    def of(values: Column) -> Column:
        def weighted(weights: Column) -> Column:
            parts = F.zip_with(values, weights, lambda v, w: F.coalesce(v, F.lit(1.0)) * w)
            return F.aggregate(parts, F.lit(0.0), lambda a, b: a + b)

        return F.transform(F.array(*nodes), weighted)

    return of


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def roundtrip(model: PipelineModel, df: DataFrame) -> PipelineModel:
    """Save a model to the shared folder and read it back."""
    return load_model(save_model(model, new_shared_path(df.sparkSession, "model")))
