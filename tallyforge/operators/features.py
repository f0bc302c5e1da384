"""Turning a labelled table into feature vectors and indexed labels."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import (
    IndexToString,
    OneHotEncoder,
    RFormula,
    RFormulaModel,
    StandardScaler,
    StandardScalerModel,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
    VectorIndexer,
    VectorIndexerModel,
)
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType

from tallyforge.operators.dictionaries import (
    MAX_DICTIONARY,
    Dictionaries,
    fit_dictionaries,
    index_by_join,
    value_by_join,
)
from tallyforge.spec import FeatureSpec

ENCODINGS = ("onehot", "ordinal", "formula")
# Fixed value: slots with at most this many distinct values are treated as categories.
MAX_CATEGORIES = 4


@dataclass
class FeatureModel:
    """A fitted encoding: categories to indices, indices to vectors, label to a number."""

    spec: FeatureSpec
    dictionaries: Dictionaries
    indexed: list[str]
    indexers: list[StringIndexerModel]
    assembly: PipelineModel
    label_model: StringIndexerModel | None
    handle_invalid: str
    index_label: bool = True
    features_col: str = "features"
    label_col: str = "label"

    @property
    def labels(self) -> list[str]:
        """Class names in index order."""
        return self.dictionaries.labels(self.spec.label)

    @property
    def classes(self) -> int:
        """Number of classes, also where their names are held as a table."""
        return self.dictionaries.sizes[self.spec.label]

    def decode(self, df: DataFrame, column: str = "prediction", output: str = "decoded") -> DataFrame:
        """Put class names in place of label indices, however large the label's dictionary is."""
        return self.dictionaries.decode(df, self.spec.label, column, output)

    def stages(self, with_label: bool = True) -> list[Transformer]:
        """The fitted stages, for use inside a longer pipeline or for saving."""
        if self.dictionaries.large:
            raise ValueError("some dictionaries are tables; use save_features for them")
        labels = [self.label_model] if with_label and self.label_model else []
        return [*self.indexers, *self.assembly.stages, *labels]

    def transform(self, df: DataFrame, with_label: bool = True) -> DataFrame:
        """Add the feature vector and, unless told otherwise, the label index; rows keep all else."""
        keep = df.columns
        out = add_indices(df, self.indexed, self.dictionaries, self.indexers, self.handle_invalid)
        out = self.assembly.transform(out)
        added = [self.features_col]
        if with_label and self.index_label:
            models = [self.label_model] if self.label_model else []
            out = add_indices(out, [self.spec.label], self.dictionaries, models, "error", self.label_col)
            added.append(self.label_col)
        return out.select(*keep, *added)


def save_features(model: FeatureModel, spark: SparkSession, path: str) -> str:
    """Write a fitted encoding: its dictionaries as tables, its stages, and what is needed to apply it.

    The form is the same however large the dictionaries are.
    """
    found = model.dictionaries
    for i, column in enumerate(found.sizes):
        found.table(spark, column).write.mode("overwrite").parquet(f"{path}/dictionaries/{i}")
    model.assembly.write().overwrite().save(f"{path}/assembly")
    settings = {
        "spec": asdict(model.spec),
        "columns": list(found.sizes),
        "sizes": list(found.sizes.values()),
        "listed": list(found.small),
        "max_size": found.max_size,
        "indexed": model.indexed,
        "handle_invalid": model.handle_invalid,
        "index_label": model.index_label,
    }
    row = spark.createDataFrame([(json.dumps(settings),)], "settings string")
    row.coalesce(1).write.mode("overwrite").text(f"{path}/settings")
    return path


def load_features(spark: SparkSession, path: str) -> FeatureModel:
    """An encoding written by :func:`save_features`."""
    settings = json.loads(spark.read.text(f"{path}/settings").first()[0])
    columns = settings["columns"]
    found = Dictionaries(max_size=settings["max_size"], sizes=dict(zip(columns, settings["sizes"])))
    for i, column in enumerate(columns):
        ranks = spark.read.schema("value string, idx double").parquet(f"{path}/dictionaries/{i}")
        if column in settings["listed"]:  # within the bounds when it was fitted
            found.small[column] = [r["value"] for r in ranks.orderBy("idx").collect()]
        else:
            found.large[column] = ranks
    spec = FeatureSpec(**{k: tuple(v) if isinstance(v, list) else v for k, v in settings["spec"].items()})
    handle, label = settings["handle_invalid"], settings["index_label"]
    return FeatureModel(
        spec,
        found,
        settings["indexed"],
        small_indexers(settings["indexed"], found, handle),
        PipelineModel.load(f"{path}/assembly"),
        found.indexer(spec.label, "label") if label and spec.label in found.small else None,
        handle,
        label,
    )


def index_name(column: str) -> str:
    return f"{column}_index"


def onehot_name(column: str) -> str:
    return f"{column}_onehot"


def small_indexers(
    columns: Sequence[str], found: Dictionaries, handle_invalid: str
) -> list[StringIndexerModel]:
    return [
        found.indexer(c, index_name(c), handle_invalid) for c in columns if c in found.small
    ]


def add_indices(
    df: DataFrame,
    columns: Sequence[str],
    found: Dictionaries,
    indexers: Sequence[StringIndexerModel],
    handle_invalid: str,
    output: str | None = None,
) -> DataFrame:
    """Index columns: in place where the dictionary is small, by join where it is not."""
    for model in indexers:
        df = model.transform(df)
    for column in columns:
        if column in found.large:
            df = index_by_join(
                df,
                column,
                found.large[column],
                output or index_name(column),
                handle_invalid,
                found.max_size,
                found.sizes.get(column),
            )
    return df


def label_index(df: DataFrame, column: str, output: str = "label", max_size: int = MAX_DICTIONARY) -> DataFrame:
    """Number the classes of ``column`` by falling frequency, whatever their number."""
    found = fit_dictionaries(df, [column], max_size)
    models = [found.indexer(column, output)] if column in found.small else []
    return add_indices(df, [column], found, models, "error", output)


def string_index(
    df: DataFrame,
    columns: Sequence[str],
    fit_on: DataFrame | None = None,
    handle_invalid: str = "error",
    max_size: int = MAX_DICTIONARY,
) -> DataFrame:
    """Add ``<column>_index`` for every column: most frequent value first, ties by text."""
    found = fit_dictionaries(df if fit_on is None else fit_on, columns, max_size)
    indexers = small_indexers(columns, found, handle_invalid)
    return add_indices(df, columns, found, indexers, handle_invalid)


def one_hot(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``<column>_onehot`` from ``<column>_index``; the last category is all zeros."""
    encoder = OneHotEncoder(
        inputCols=[index_name(c) for c in columns], outputCols=[onehot_name(c) for c in columns]
    )
    return encoder.fit(df).transform(df)


def fit_features(
    df: DataFrame,
    spec: FeatureSpec,
    encoding: str = "onehot",
    *,
    handle_invalid: str = "error",
    numeric_invalid: str = "error",
    index_label: bool = True,
    drop_constant: bool = False,
    max_size: int = MAX_DICTIONARY,
) -> FeatureModel:
    """Learn an encoding of ``df`` with a single scan.

    ``onehot``
        numeric columns, then a one-hot vector per categorical column.
    ``ordinal``
        numeric columns, then the plain index of each categorical column.
    ``formula``
        all feature columns in table order, where only text columns are one-hot encoded; what
        ``RFormula("label ~ .")`` produces.

    A category with a single value cannot be one-hot encoded: it is an error, or left out with
    ``drop_constant``. ``handle_invalid`` is about nulls and unseen values of categories,
    ``numeric_invalid`` about nulls of numeric columns (``keep`` makes them NaN).
    """
    if encoding not in ENCODINGS:
        raise ValueError(f"encoding must be one of {ENCODINGS}")
    if encoding == "formula":
        order = spec.features(df.columns)
        texts = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
        indexed = [c for c in order if c in texts]
    else:
        indexed = list(spec.categorical)
        order = [*spec.numeric(df.columns), *indexed]
    labels = [spec.label] if index_label else []
    found = fit_dictionaries(df, [*indexed, *labels], max_size)
    if drop_constant:
        constant = {c for c in indexed if found.sizes[c] < 2}
        indexed = [c for c in indexed if c not in constant]
        order = [c for c in order if c not in constant]

    indexers = small_indexers(indexed, found, handle_invalid)
    ready = add_indices(df, indexed, found, indexers, handle_invalid)

    stages = []
    slot = {c: c for c in order}
    if encoding == "ordinal":
        slot.update({c: index_name(c) for c in indexed})
    elif indexed:
        slot.update({c: onehot_name(c) for c in indexed})
        stages.append(
            OneHotEncoder(
                inputCols=[index_name(c) for c in indexed],
                outputCols=[onehot_name(c) for c in indexed],
            )
        )
    stages.append(
        VectorAssembler(
            inputCols=[slot[c] for c in order], outputCol="features", handleInvalid=numeric_invalid
        )
    )
    # Category counts are in the index columns' metadata, so fitting the encoder reads no rows.
    assembly = Pipeline(stages=stages).fit(ready)
    label_model = None
    if index_label and spec.label in found.small:
        label_model = found.indexer(spec.label, "label")
    return FeatureModel(
        spec, found, indexed, indexers, assembly, label_model, handle_invalid, index_label
    )


def fit_formula(df: DataFrame, label: str, excluded: Sequence[str] = ()) -> RFormulaModel:
    """``label ~ .`` as MLlib's own formula transformer, one counting job per text column."""
    terms = "".join(f" - {c}" for c in excluded)
    return RFormula(formula=f"{label} ~ .{terms}", forceIndexLabel=True).fit(df)


def fit_vector_index(
    df: DataFrame, max_categories: int = MAX_CATEGORIES, column: str = "features"
) -> VectorIndexerModel:
    """Find vector slots with few distinct values and number those values."""
    return VectorIndexer(
        inputCol=column, outputCol="indexedFeatures", maxCategories=max_categories
    ).fit(df)


def vector_index_map(df: DataFrame, model: VectorIndexerModel) -> DataFrame:
    """The numbering as a table: one row per (slot, value) of every category slot."""
    rows = [
        (int(slot), float(value), int(index))
        for slot, values in model.categoryMaps.items()
        for value, index in values.items()
    ]
    return df.sparkSession.createDataFrame(rows, "pos int, value double, idx int")


def fit_label_reindex(df: DataFrame, column: str = "label") -> StringIndexerModel:
    """Index a numeric label once more by frequency; its values are compared as text on ties."""
    return StringIndexer(inputCol=column, outputCol="indexedLabel").fit(df)


def decode_labels(
    df: DataFrame, labels: Sequence[str] | DataFrame, column: str = "prediction", output: str = "decoded"
) -> DataFrame:
    """Put class names back in place of label indices.

    ``labels`` is the list of names in index order, or a dictionary table ``(value, idx)``.
    """
    if isinstance(labels, DataFrame):
        return value_by_join(df, column, labels, output)
    return IndexToString(inputCol=column, outputCol=output, labels=list(labels)).transform(df)


def fit_scaler(df: DataFrame, column: str = "features") -> StandardScalerModel:
    """Centre and scale every slot; worthwhile before a neural net."""
    return StandardScaler(
        inputCol=column, outputCol="scaledFeatures", withMean=True, withStd=True
    ).fit(df)


def vector_size(df: DataFrame, column: str = "features") -> int:
    """Length of a vector column, from its metadata (no rows are read)."""
    attributes = df.schema[column].metadata.get("ml_attr", {})
    if "num_attrs" not in attributes:
        raise ValueError(f"{column} carries no vector size")
    return int(attributes["num_attrs"])


def slot_names(df: DataFrame, column: str = "features") -> list[str]:
    """Names of the vector slots in order, from the column's metadata."""
    groups = df.schema[column].metadata["ml_attr"].get("attrs", {})
    named = {a["idx"]: a.get("name") for attrs in groups.values() for a in attrs}
    return [named.get(i) or f"{column}_{i}" for i in range(vector_size(df, column))]


def vector_entries(df: DataFrame, keys: Sequence[str], column: str = "features") -> DataFrame:
    """Nonzero slots of a vector column as ``(keys…, pos, value)`` rows.

    Sparse vectors are unpacked as stored, without filling in their zeros.
    """
    raw = F.unwrap_udt(column)
    positions = F.when(raw["type"] == 0, raw["indices"]).otherwise(
        F.sequence(F.lit(0), F.size(raw["values"]) - 1)
    )
    entry = F.explode(F.arrays_zip(positions.alias("pos"), raw["values"].alias("value")))
    return (
        df.select(*keys, entry.alias("entry"))
        .select(*keys, F.col("entry.pos").alias("pos"), F.col("entry.value").alias("value"))
        .filter(F.col("value") != 0.0)
    )
