"""Fitted models whole: from raw records to scores, in memory and on disk."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyforge.functions.recode import RECODES
from tallyforge.operators.features import FeatureModel, load_features, save_features
from tallyforge.staging import new_shared_path


@dataclass
class WholeModel:
    """Everything between a raw record and its score.

    ``recode`` names the entry of ``RECODES`` that the records pass first. ``decoded`` is the type in
    which class names come back, in a column called that beside ``prediction``; without it they do not.
    """

    features: FeatureModel
    model: Model
    decoded: str | None = None
    recode: str | None = None

    def transform(self, df: DataFrame) -> DataFrame:
        """Score raw records, which need not have the label column; they keep their other columns."""
        records = RECODES[self.recode](df) if self.recode else df
        scored = self.model.transform(self.features.transform(records, with_label=False))
        if self.decoded is None:
            return scored
        return self.features.decode(scored).withColumn("decoded", F.col("decoded").cast(self.decoded))


def save_whole(whole: WholeModel, spark: SparkSession, path: str) -> str:
    """Write a model with its encoding: dictionaries as tables, all stages, and how they are applied.

    The form is the same for every model and for dictionaries of any size. What lies at ``path`` is
    replaced.
    """
    save_features(whole.features, spark, f"{path}/features")
    model = whole.model
    stages = model if isinstance(model, PipelineModel) else PipelineModel(stages=[model])
    stages.write().overwrite().save(f"{path}/model")
    settings = {
        "single": stages is not model,
        "decoded": whole.decoded,
        "recode": whole.recode,
    }
    row = spark.createDataFrame([(json.dumps(settings),)], "settings string")
    row.coalesce(1).write.mode("overwrite").text(f"{path}/settings")
    return path


def load_whole(spark: SparkSession, path: str) -> WholeModel:
    """A model written by :func:`save_whole`; dictionaries that were tables stay tables."""
    settings = json.loads(spark.read.text(f"{path}/settings").first()[0])
    model = PipelineModel.load(f"{path}/model")
    return WholeModel(
        load_features(spark, f"{path}/features"),
        model.stages[0] if settings["single"] else model,
        settings["decoded"],
        settings["recode"],
    )


def roundtrip_whole(whole: WholeModel, spark: SparkSession) -> WholeModel:
    """Save a model to the shared folder and read it back."""
    return load_whole(spark, save_whole(whole, spark, new_shared_path(spark, "whole-model")))
