"""Catalogue: models saved whole and read back, and decoding with dictionaries held as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyforge.operators import classify, cluster, saved
from tallyforge.operators.dictionaries import fit_dictionaries
from tallyforge.operators.features import decode_labels, fit_features, index_name, string_index, vector_size
from tallyforge.operators.split import in_training
from tallyforge.plans import studies
from tallyforge.plans.registry import query
from tallyforge.plans.shared import FLOWS, GUESS, IN_TRAINING, RULE_ON_TEST, SPEC, binary_flows
from tallyforge.sources.tables import FLOW_KEY, flows
from tallyforge.spec import FeatureSpec
from tallyforge.staging import new_shared_path, staged

# So few values that nearly every dictionary becomes a table, the label's included.
FEW = 2


@query(RULE_ON_TEST)
def model_roundtrip_large(spark: SparkSession, folder: str) -> DataFrame:
    """Encoding with dictionaries as tables and a tree, saved whole, read back and applied to raw records."""
    data = binary_flows(spark, folder)
    features = fit_features(data, SPEC, max_size=FEW)
    rows = features.transform(data).where(in_training(FLOW_KEY)).select("features", "label")
    with staged(rows, "features", vector_size(rows)) as train:
        tree = classify.decision_tree("features", "label", maxBins=65, maxDepth=6).fit(train)
    whole = saved.roundtrip_whole(saved.WholeModel(features, tree), spark)
    test = flows(spark, folder).where(~in_training(FLOW_KEY)).drop("class")
    return whole.transform(test).select(FLOW_KEY, "prediction")


@query(
    f"""with {FLOWS}, test as (select * from flows where not ({IN_TRAINING}))
select flow_key, case when class = 'normal' then class else 'attack' end as decoded,
  (select count(*) from test)::double as total, 1.0::double as ratio_correct
from test"""
)
def study_roundtrip_large(spark: SparkSession, folder: str) -> DataFrame:
    """A whole forest study saved and read back: its measures, and its scores of raw records without a class."""
    study = studies.formula_forest_study(
        flows(spark, folder, spread=True), FLOW_KEY, seed=1, subset="all", dictionary_size=FEW
    )
    again = studies.load_study(spark, studies.save_study(study, spark, new_shared_path(spark, "study")))
    found = {r["metric"]: r["value"] for r in again.measures.collect()}
    test = flows(spark, folder).where(~in_training(FLOW_KEY)).drop("class")
    return again.score(test).select(
        FLOW_KEY, "decoded", *(F.lit(found[m]).alias(m) for m in ("total", "ratio_correct"))
    )


CLUMP_SPEC = FeatureSpec(categorical=("protocol_type", "service", "flag"), label="land", excluded=(FLOW_KEY,))
GAP = 1000


@query(
    f"""with {FLOWS} select land, count(*) as size, round(avg({GAP} * land + duration), 6) as center, true as same_centres
from flows group by land"""
)
def kmeans_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """k-means with its encoding saved whole and read back: clusters of raw records and their centres."""
    records = flows(spark, folder, spread=True).select(
        FLOW_KEY,
        "protocol_type",
        "service",
        "flag",
        "land",
        (F.lit(float(GAP)) * F.col("land") + F.col("duration")).alias("far"),
    )
    features = fit_features(records, CLUMP_SPEC, index_label=False, max_size=FEW)
    encoded = features.transform(records, with_label=False).select("features")
    with staged(encoded, "features", vector_size(encoded)) as rows:
        model = cluster.kmeans_parallel(2).fit(rows)
    again = saved.roundtrip_whole(saved.WholeModel(features, model), spark)
    centers = cluster.model_centers(again.model)
    place = F.create_map(*[F.lit(v) for k, c in centers.items() for v in (k, c[0])])
    return (
        again.transform(records)
        .groupBy("prediction", "land")
        .agg(F.count("*").alias("size"))
        .select(
            "land",
            "size",
            F.round(place[F.col("prediction")], 6).alias("center"),
            F.lit(centers == cluster.model_centers(model)).alias("same_centres"),
        )
    )


@query(f"with {FLOWS} select flow_key, service as decoded from flows")
def decoded_services(spark: SparkSession, folder: str) -> DataFrame:
    """Services numbered and named again: seven names by broadcast, the others by a shuffle join."""
    records = flows(spark, folder)
    found = fit_dictionaries(records, ["service"], max_size=7)
    indexed = string_index(records.select(FLOW_KEY, "service"), ["service"], max_size=7).drop("service")
    return found.decode(indexed, "service", index_name("service"), "decoded").select(FLOW_KEY, "decoded")


@query(
    f"""with {FLOWS}
select flow_key, case when {GUESS} then 'normal' else 'attack' end as decoded from flows"""
)
def decoded_predictions_large(spark: SparkSession, folder: str) -> DataFrame:
    """Class names in place of predicted indices, from a dictionary held as a table."""
    records = binary_flows(spark, folder)
    found = fit_dictionaries(records, ["class"], max_size=1)
    # Normal is the rarer class, so its index is 1.
    guess = F.when(F.expr(GUESS), F.lit(1.0)).otherwise(F.lit(0.0))
    rows = records.withColumn("prediction", guess)
    return decode_labels(rows, found.table(spark, "class")).select(FLOW_KEY, "decoded")
