"""End-to-end studies: encode, split, fit, score once, measure.

Each study scans its input twice (once to count categories, once to encode) and works on the staged
feature table until its measures are known. Rows never reach the driver: what returns is a fitted
model and measures of a handful of rows.

Training rows are chosen by a hash of the row key, or with ``toss_seed`` by a toss per key; both fall
the same on every recomputation. Without a key (``key=None``) the content of the row takes its place,
so copies of a row stay together.

``Study.scored`` encodes and scores the input anew when it is used, which is a third scan.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyforge.functions.recode import class_binarize, class_to_numeric, coded_connection
from tallyforge.operators import classify, cluster, metrics, relational
from tallyforge.operators.dictionaries import MAX_DICTIONARY
from tallyforge.operators.features import (
    FeatureModel,
    fit_features,
    fit_label_reindex,
    fit_scaler,
    fit_vector_index,
    vector_size,
)
from tallyforge.operators.saved import WholeModel, load_whole, save_whole
from tallyforge.operators.split import fold_number, in_training, training_flag, with_row_key
from tallyforge.spec import ATTACK, NORMAL, connection_spec
from tallyforge.staging import settle, side_by_side, staged


@dataclass
class Study:
    """What a study leaves behind.

    ``measures`` is the ``(metric, value)`` table, ``counts`` the contingency table it came from and
    ``scored`` the scored rows, computed when asked for. ``tables`` holds what else a study reports:
    the clustering studies their ``summary`` (k, sizes and centres), the ``histogram`` of assigned
    clusters and the ``classes`` with their counts. A study read back from disk has no ``scored``
    rows; :meth:`score` works on any records.
    """

    model: Model
    features: FeatureModel
    measures: DataFrame
    counts: DataFrame
    scored: DataFrame | None
    tables: dict[str, DataFrame] = field(default_factory=dict)
    decoded: str | None = None
    recode: str | None = None

    def whole(self) -> WholeModel:
        """The study's model, from raw records to scores."""
        return WholeModel(self.features, self.model, self.decoded, self.recode)

    def score(self, df: DataFrame) -> DataFrame:
        """Score raw records as the study scored its test rows; they need no class."""
        return self.whole().transform(df)


def save_study(study: Study, spark: SparkSession, path: str) -> str:
    """Write a study: model, encoding, measures, counts and its other tables."""
    save_whole(study.whole(), spark, f"{path}/whole")
    reports = {"measures": study.measures, "counts": study.counts, **study.tables}
    for name, table in reports.items():
        table.write.mode("overwrite").parquet(f"{path}/reports/{name}")
    names = spark.createDataFrame([(n,) for n in reports], "name string")
    names.coalesce(1).write.mode("overwrite").text(f"{path}/names")
    return path


def load_study(spark: SparkSession, path: str) -> Study:
    """A study written by :func:`save_study`."""
    whole = load_whole(spark, f"{path}/whole")
    names = [r[0] for r in spark.read.text(f"{path}/names").collect()]
    reports = {n: spark.read.parquet(f"{path}/reports/{n}") for n in names}
    measures, counts = reports.pop("measures"), reports.pop("counts")
    return Study(whole.model, whole.features, measures, counts, None, reports, whole.decoded, whole.recode)


def _measures(*one_row_tables: DataFrame) -> DataFrame:
    """One-row measure tables, computed now, as one ``(metric, value)`` table."""
    spark = one_row_tables[0].sparkSession
    rows = [row for wide in one_row_tables for row in metrics.metric_table(wide).collect()]
    return spark.createDataFrame([tuple(r) for r in rows], "metric string, value double")


def _encode(
    df: DataFrame, features: FeatureModel, key: str, toss_seed: int | None, *extra: str | Column
) -> DataFrame:
    """Row key, training flag, vector and label of every row."""
    train = training_flag(key, toss_seed=toss_seed).alias("train")
    return features.transform(df).select(key, train, "features", "label", *extra)


def _test_part(rows: DataFrame) -> DataFrame:
    return rows.filter(~F.col("train"))


def _decoded_counts(scored: DataFrame, features: FeatureModel, kind: str = "string") -> DataFrame:
    """Rows per predicted and true class name: counted by index, so only the counts are decoded."""
    counts = relational.contingency(scored, truth="class")
    named = features.decode(counts).withColumn("prediction", F.col("decoded").cast(kind))
    return settle(named.select("prediction", "truth", "n"))


def _scalar(df: DataFrame, **values: float) -> DataFrame:
    return df.sparkSession.createDataFrame([tuple(values.values())], list(values))


def tree_study(
    df: DataFrame,
    key: str | None,
    *,
    folds: int = classify.CV_FOLDS,
    bins: tuple[int, ...] = classify.GRID_BINS,
    depths: tuple[int, ...] = classify.GRID_DEPTHS,
    parallelism: int = 4,
    fit_on: str = "all",
    toss_seed: int | None = None,
    tree: Mapping[str, object] | None = None,
    dictionary_size: int = MAX_DICTIONARY,
) -> Study:
    """Normal against attack with a decision tree tuned by cross-validation.

    All fits of the search grow from the same passes. Where that is not possible, up to ``parallelism`` fits
    run side by side where one alone leaves cores idle; each keeps its rows.

    ``tree`` holds further settings of the tree. Dictionaries beyond ``dictionary_size`` values, all
    columns together, are held as tables; so they are in the other studies.

    ``fit_on="all"`` learns categories before the split; ``"train"`` learns them from training rows
    only and gives categories unseen there an all-zero vector; it needs the split by key.
    """
    if fit_on not in ("all", "train") or (fit_on == "train" and toss_seed is not None):
        raise ValueError("fit_on is 'all', or 'train' with a split by key")
    data, key = with_row_key(df, key)
    data = data.withColumn("class", class_binarize("class"))
    spec = connection_spec(key=[key])
    if fit_on == "all":
        features = fit_features(data, spec, "onehot", max_size=dictionary_size)
    else:
        known = data.filter(in_training(key))
        features = fit_features(known, spec, "onehot", handle_invalid="keep", max_size=dictionary_size)
    encoded = _encode(data, features, key, toss_seed, fold_number(key, folds).alias("fold"))
    with staged(encoded.drop(key), "features", vector_size(encoded), ["train", "fold"]) as rows:
        search = classify.cross_validator(
            classify.decision_tree(**(tree or {})),
            bins=bins,
            depths=depths,
            folds=folds,
            fold_column="fold",
            parallelism=side_by_side(rows.filter("train"), parallelism),
        )
        learn_from = rows if fit_on == "all" else rows.filter("train")
        stages = [fit_label_reindex(learn_from), fit_vector_index(learn_from)]
        # The search caches every column it is given, fold by fold.
        indexed = PipelineModel(stages).transform(rows.filter("train"))
        found = search.fit(indexed.select("indexedFeatures", "indexedLabel", "label", "fold"))
        model = PipelineModel([*stages, found])
        # A tree has few leaves, so grouping by score gives a small table that serves both the
        # curve and the confusion cells: the test rows are scored exactly once.
        leaves = settle(
            classify.predict(model, _test_part(rows))
            .groupBy(
                vector_to_array("rawPrediction")[1].alias("score"),
                "prediction",
                "label",
                F.col("indexedLabel").alias("truth"),
            )
            .agg(F.count("*").alias("n"))
        )
        auc = metrics.auc_roc(leaves, "score", "label", weight="n")
        measures = _measures(
            relational.split_sizes(rows, F.col("train")),
            _scalar(df, auc=auc, error_rate=1.0 - auc),
            metrics.agreement(leaves),
            metrics.confusion_over_total(leaves, 1.0, 0.0),
        )
    counts = leaves.groupBy("prediction", "truth").agg(F.sum("n").alias("n"))
    scored = classify.predict(model, _test_part(encoded))
    return Study(model, features, measures, counts, scored)


def _fit_net(
    train: DataFrame, classes: int, scale: bool, seed: int | None
) -> PipelineModel:
    stages, inputs, column = [], train, "features"
    if scale:
        scaler = fit_scaler(train)
        stages, inputs, column = [scaler], scaler.transform(train), "scaledFeatures"
    net = classify.perceptron(inputs, classes, column)
    if seed is not None:
        net.setSeed(seed)
    return Pipeline(stages=[*stages, net]).fit(train)


def perceptron_study(
    df: DataFrame,
    key: str | None,
    *,
    scale: bool = False,
    seed: int | None = None,
    toss_seed: int | None = None,
    dictionary_size: int = MAX_DICTIONARY,
) -> Study:
    """Normal against attack with a neural net on numeric columns and category indices."""
    data, key = with_row_key(df, key)
    data = data.withColumn("class", class_binarize("class"))
    features = fit_features(data, connection_spec(key=[key]), "ordinal", max_size=dictionary_size)
    encoded = _encode(data, features, key, toss_seed)
    with staged(encoded.drop(key), "features", vector_size(encoded), ["train"]) as rows:
        model = _fit_net(rows.filter("train"), features.classes, scale, seed)
        counts = settle(relational.contingency(classify.predict(model, _test_part(rows))))
        measures = _measures(
            relational.split_sizes(rows, F.col("train")),
            metrics.accuracy(counts),
            metrics.agreement(counts),
            metrics.confusion_over_total(counts, 1.0, 0.0),
        )
    scored = classify.predict(model, _test_part(encoded))
    return Study(model, features, measures, counts, scored)


def _cluster_tables(model: Model, assigned: DataFrame, counts: DataFrame) -> dict[str, DataFrame]:
    return {
        "summary": settle(cluster.kmeans_summary(model, assigned)),
        "histogram": settle(relational.prediction_histogram(counts)),
    }


def cluster_study(
    df: DataFrame,
    key: str | None,
    *,
    drop_constant: bool = True,
    iterations: int = cluster.KMEANS_ITERATIONS,
    dictionary_size: int = MAX_DICTIONARY,
) -> Study:
    """k-means over all rows with one cluster per class, compared naively with the class index."""
    df, key = with_row_key(df, key)
    spec = connection_spec(key=[key], host_login=True)
    features = fit_features(df, spec, "onehot", drop_constant=drop_constant, max_size=dictionary_size)
    encoded = features.transform(df).select(key, "features", "label")
    with staged(encoded, "features", vector_size(encoded)) as rows:
        model = cluster.kmeans_parallel(features.classes, iterations=iterations).fit(rows)
        assigned = classify.predict(model, rows)
        # As many rows as classes times clusters, and there is one cluster per class.
        counts = settle(relational.contingency(assigned))
        measures = _measures(
            metrics.agreement(counts), cluster.wssse(assigned, cluster.model_centers(model))
        )
        tables = _cluster_tables(model, assigned, counts)
    classes = settle(relational.value_counts(df, "class"))
    tables["classes"] = classes
    return Study(model, features, measures, counts, classify.predict(model, encoded), tables)


def formula_forest_study(
    df: DataFrame,
    key: str | None,
    *,
    seed: int | None = None,
    subset: str = "auto",
    toss_seed: int | None = None,
    dictionary_size: int = MAX_DICTIONARY,
) -> Study:
    """Normal against attack with a random forest on ``class ~ .``; normal is the positive class."""
    df, key = with_row_key(df, key)
    data = df.drop("is_host_login").withColumn("class", class_binarize("class"))
    features = fit_features(data, connection_spec(key=[key]), "formula", max_size=dictionary_size)
    encoded = _encode(data, features, key, toss_seed, "class")
    forest = classify.random_forest(featureSubsetStrategy=subset)
    if seed is not None:
        forest.setSeed(seed)

    with staged(encoded.drop(key), "features", vector_size(encoded), ["train"]) as rows:
        model = forest.fit(rows.filter("train"))
        counts = _decoded_counts(classify.predict(model, _test_part(rows)), features)
        measures = _measures(
            relational.split_sizes(rows, F.col("train")),
            metrics.agreement(counts),
            metrics.confusion_over_total(counts, NORMAL, ATTACK),
        )
    scored = features.decode(classify.predict(model, _test_part(encoded)))
    return Study(model, features, measures, counts, scored, decoded="string")


def formula_cluster_study(
    df: DataFrame,
    key: str | None,
    *,
    seed: int | None = None,
    toss_seed: int | None = None,
    dictionary_size: int = MAX_DICTIONARY,
) -> Study:
    """k-means from random rows on ``class ~ .``, fitted on the training part."""
    df, key = with_row_key(df, key)
    data = df.drop("is_host_login").withColumn("class", class_binarize("class"))
    features = fit_features(data, connection_spec(key=[key]), "formula", max_size=dictionary_size)
    encoded = _encode(data, features, key, toss_seed, "class")
    with staged(encoded, "features", vector_size(encoded)) as rows:
        model = cluster.kmeans_random(features.classes, seed=seed).fit(rows.filter("train"))
        counts = settle(
            relational.contingency(classify.predict(model, _test_part(rows)), truth="class")
        )
        measures = _measures(relational.split_sizes(rows, F.col("train")))
        learned = classify.predict(model, rows.filter("train"))
        tables = {"summary": settle(cluster.kmeans_summary(model, learned))}
    scored = classify.predict(model, _test_part(encoded))
    return Study(model, features, measures, counts, scored, tables)


def formula_perceptron_study(
    df: DataFrame,
    key: str | None,
    *,
    scale: bool = False,
    seed: int | None = None,
    toss_seed: int | None = None,
    dictionary_size: int = MAX_DICTIONARY,
) -> Study:
    """Normal (1.0) against attack (0.0) with a neural net on hand-coded columns."""
    df, key = with_row_key(df, key)
    data = coded_connection(df.drop("is_host_login", "service")).withColumn("class", class_to_numeric("class"))
    features = fit_features(data, connection_spec(key=[key]), "formula", max_size=dictionary_size)
    encoded = _encode(data, features, key, toss_seed, "class")

    with staged(encoded.drop(key), "features", vector_size(encoded), ["train"]) as rows:
        model = _fit_net(rows.filter("train"), features.classes, scale, seed)
        counts = _decoded_counts(classify.predict(model, _test_part(rows)), features, "double")
        measures = _measures(
            relational.split_sizes(rows, F.col("train")),
            metrics.agreement(counts),
            metrics.confusion_over_predicted(counts, 1.0, 0.0),
        )
    scored = features.decode(classify.predict(model, _test_part(encoded)))
    scored = scored.withColumn("decoded", F.col("decoded").cast("double"))
    return Study(model, features, measures, counts, scored, decoded="double", recode="coded_connection")
