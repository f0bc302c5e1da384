"""Catalogue: studies on records that have only one right answer, whatever a fit's random start.

The records are derived from the connection records. Each derivation is plain SQL for both engines.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyforge.operators import classify, metrics
from tallyforge.plans import studies
from tallyforge.plans.registry import query
from tallyforge.plans.shared import FLOWS, IN_TOSS, IN_TRAINING, IS_NORMAL
from tallyforge.sources.tables import FLOW_COLUMNS, FLOW_KEY, flows


def _derived(name: str, where: str | None = None, **changed: str) -> tuple[str, list[str], str | None]:
    """SQL CTE with some columns of the connection records changed, and the same as expressions."""
    columns = [f"{changed[c]} as {c}" if c in changed else c for c in FLOW_COLUMNS]
    condition = f" where {where}" if where else ""
    return f"{name} as (select {', '.join(columns)} from flows{condition})", columns, where


def _records(spark: SparkSession, folder: str, derived: tuple[str, list[str], str | None]) -> DataFrame:
    rows = flows(spark, folder, spread=True)
    return (rows.where(derived[2]) if derived[2] else rows).selectExpr(*derived[1])


def _measures(table: DataFrame, digits: int = 6) -> DataFrame:
    return table.select("metric", F.round("value", digits).alias("value"))


# Two classes with a wide gap between them in one small column: any net that has converged tells them apart.
SEPARABLE = _derived(
    "separable",
    "duration <= 20 or duration >= 30",
    service="concat('svc', cast(substring(service, 4) as int) % 3)",
    duration="duration / 10 - 2.5",
    src_bytes="src_bytes / 100000",
    **{"class": "case when duration >= 30 then 'normal' when land = 1 then 'neptune' else 'smurf' end"},
)
SEPARABLE_SUMS = f"""with {FLOWS}, {SEPARABLE[0]},
test as (select * from separable where not ({IN_TRAINING})),
all_sums as (select count(*) filter (class = 'normal') as yes, count(*) filter (class <> 'normal') as no from separable),
sums as (select count(*)::double as n, count(*) filter (class = 'normal')::double as yes from test)"""
SIZES = f"""select 'n_rows' as metric, count(*)::double as value from separable
union all select 'n_train', count(*) filter ({IN_TRAINING})::double from separable
union all select 'n_test', n from sums
union all select 'total', n from sums
union all select 'correct', n from sums
union all select 'incorrect', 0.0 from sums
union all select 'ratio_correct', 1.0 from sums
union all select 'ratio_incorrect', 0.0 from sums"""


@query(
    f"""with {FLOWS}, {SEPARABLE[0]} select flow_key, case when class = 'normal' then class else 'attack' end as decoded
from separable where not ({IN_TRAINING})"""
)
def mlp_separable(spark: SparkSession, folder: str) -> DataFrame:
    """The class a net on category indices gives every test row."""
    study = studies.perceptron_study(_records(spark, folder, SEPARABLE), FLOW_KEY, seed=1)
    return study.features.decode(study.scored).select(FLOW_KEY, "decoded")


@query(
    f"""with {FLOWS}, {SEPARABLE[0]} select flow_key, case when class = 'normal' then 1.0 else 0.0 end::double as decoded
from separable where not ({IN_TRAINING})"""
)
def mlp_formula_separable(spark: SparkSession, folder: str) -> DataFrame:
    """The class a net on coded columns gives every test row."""
    study = studies.formula_perceptron_study(_records(spark, folder, SEPARABLE), FLOW_KEY, seed=1)
    return study.scored.select(FLOW_KEY, "decoded")


@query(
    f"""{SEPARABLE_SUMS}, rare as (
  select n, case when (select yes < no or (yes = no and 'normal' > 'attack') from all_sums) then yes else n - yes end as rarer
  from sums)
{SIZES}
union all select 'accuracy', 1.0
union all select 'error_rate', 0.0
union all select 'tp', round(rarer / n, 6) from rare
union all select 'tn', round(1 - rarer / n, 6) from rare
union all select 'fp', 0.0
union all select 'fn', 0.0"""
)
def mlp_unscaled_measures(spark: SparkSession, folder: str) -> DataFrame:
    """All measures of the net study on unscaled columns; the rarer class is the positive one."""
    return _measures(studies.perceptron_study(_records(spark, folder, SEPARABLE), FLOW_KEY, seed=1).measures)


@query(
    f"""{SEPARABLE_SUMS}
{SIZES}
union all select 'tp_rate', 1.0
union all select 'tn_rate', 1.0
union all select 'fp_rate', 0.0
union all select 'fn_rate', 0.0"""
)
def mlp_formula_measures(spark: SparkSession, folder: str) -> DataFrame:
    """All measures of the net study on coded columns, crossed rates included."""
    return _measures(studies.formula_perceptron_study(_records(spark, folder, SEPARABLE), FLOW_KEY, seed=1).measures)


# Every column tells the class, so any subset of the columns that a split may look at finds it.
TELLING = _derived(
    "telling",
    protocol_type=f"case when {IS_NORMAL} then 'tcp' else 'udp' end",
    service=f"case when {IS_NORMAL} then 'svc1' else 'svc2' end",
    flag=f"case when {IS_NORMAL} then 'SF' else 'REJ' end",
    land=f"cast(case when {IS_NORMAL} then 1 else 0 end as int)",
    logged_in=f"cast(case when {IS_NORMAL} then 1 else 0 end as int)",
    is_guest_login=f"cast(case when {IS_NORMAL} then 0 else 1 end as int)",
    duration=f"case when {IS_NORMAL} then duration + 100 else duration end",
    src_bytes=f"case when {IS_NORMAL} then src_bytes + 1000000 else src_bytes end",
    serror_rate=f"case when {IS_NORMAL} then serror_rate else serror_rate + 1 end",
    rerror_rate=f"case when {IS_NORMAL} then rerror_rate else rerror_rate + 1 end",
)
TOSSED = IN_TOSS.format(seed=1)


@query(
    f"""with {FLOWS} select flow_key, case when class = 'normal' then class else 'attack' end as decoded
from flows where not ({TOSSED})"""
)
def forest_default_telling(spark: SparkSession, folder: str) -> DataFrame:
    """The class a forest at its default settings gives every test row."""
    records = _records(spark, folder, TELLING)
    study = studies.formula_forest_study(records, FLOW_KEY, seed=1, toss_seed=1)
    return study.scored.select(FLOW_KEY, "decoded")


@query(
    f"""with {FLOWS}, sums as (
  select count(*)::double as n, count(*) filter (class = 'normal')::double as yes from flows where not ({TOSSED}))
select 'n_rows' as metric, count(*)::double as value from flows
union all select 'n_train', count(*) filter ({TOSSED})::double from flows
union all select 'n_test', n from sums
union all select 'total', n from sums
union all select 'correct', n from sums
union all select 'incorrect', 0.0
union all select 'ratio_correct', 1.0
union all select 'ratio_incorrect', 0.0
union all select 'tp', round(yes / n, 6) from sums
union all select 'tn', round(1 - yes / n, 6) from sums
union all select 'fp', 0.0
union all select 'fn', 0.0"""
)
def forest_formula_default_measures(spark: SparkSession, folder: str) -> DataFrame:
    """All measures of the forest study at its default settings; normal is the positive class."""
    records = _records(spark, folder, TELLING)
    return _measures(studies.formula_forest_study(records, FLOW_KEY, seed=1, toss_seed=1).measures)


# Classes so far apart that every start of k-means ends with one cluster per class.
FAR = _derived(
    "far",
    duration="duration / 50",
    src_bytes=(
        "src_bytes / 100000 + case class when 'normal' then 0 when 'neptune' then 1000 when 'smurf' then 2000 else 3000 end"
    ),
)
FAR_SLOTS = ("duration", "src_bytes", "serror_rate", "rerror_rate")
FAR_CATEGORIES = ("protocol_type", "service", "flag", "land", "logged_in", "is_guest_login")
_far_values = " union all ".join(f"select class, '{c}' as name, {c}::varchar as value from far" for c in FAR_CATEGORIES)
_far_spread = " + ".join(f"var_pop({c}) * count(*)" for c in FAR_SLOTS)


@query(
    f"""with {FLOWS}, {FAR[0]}, long_far as ({_far_values}),
ranked as (
  select name, value, row_number() over (partition by name order by count(*) desc, value) as place,
    count(*) over (partition by name) as many from long_far group by name, value),
inside as (
  select class, name, value, count(*)::double as n from long_far group by class, name, value),
sizes as (select class, count(*)::double as size from far group by class),
bits as (
  select sum(n - n * n / size) as spread from inside join ranked using (name, value) join sizes using (class) where place < many),
numbers as (select sum(spread) as spread from (select {_far_spread} as spread from far group by class))
select 'total' as metric, count(*)::double as value from far
union all select 'correct', count(*)::double from far
union all select 'incorrect', 0.0
union all select 'ratio_correct', 1.0
union all select 'ratio_incorrect', 0.0
union all select 'wssse', round(bits.spread + numbers.spread, 2) from bits, numbers"""
)
def kmeans_study_measures(spark: SparkSession, folder: str) -> DataFrame:
    """The clustering study's measures: clusters numbered by size agree with classes numbered by frequency."""
    study = studies.cluster_study(_records(spark, folder, FAR), FLOW_KEY)
    cost = study.measures.where("metric = 'wssse'")
    matched = metrics.metric_table(metrics.agreement(metrics.numbered_by_size(study.counts)))
    return _measures(matched.unionByName(cost), 2)


@query(
    f"""with {FLOWS}, test as (
  select case when class = 'normal' then class else 'attack' end as truth from flows where not ({IN_TOSS.format(seed=3)}))
select (row_number() over (order by count(*) desc) - 1)::double as prediction, truth, count(*)::bigint as n from test group by truth"""
)
def kmeans_formula_contingency_table(spark: SparkSession, folder: str) -> DataFrame:
    """Test rows per cluster and class, for clusters found from random rows in tossed training rows."""
    apart = _derived("apart", src_bytes="src_bytes / 100000 + case class when 'normal' then 1000 else 0 end")
    study = studies.formula_cluster_study(_records(spark, folder, apart), FLOW_KEY, seed=3, toss_seed=3)
    return metrics.numbered_by_size(study.counts)


# The noisy rule's tree has three leaves: no land, and land with a short or a long duration.
@query(
    f"""with {FLOWS}, test as (select * from flows where {IN_TRAINING}),
r as (select land, duration, (land = 1 and duration > 10)::int as y from test),
limits as (
  select (max(duration) filter (duration <= 10) + min(duration) filter (duration > 10)) / 2 as t from r where land = 1),
rare as (select case when sum((land = 1 and duration > 10)::int) * 2 <= count(*) then 1 else 0 end as yes from flows)
select 0 as depth, 'land' as slot, null::double as threshold, count(*)::bigint as rows, false as leaf,
  max(case when (select 2 * sum(y) > count(*) from r) then yes else 1 - yes end)::double as prediction from r, rare
union all select 1, null, null, count(*)::bigint, true, max(1 - yes)::double from r, rare where land = 0
union all select 1, 'duration', round(max(t), 6), count(*)::bigint, false,
  max(case when (select 2 * sum(y) > count(*) from r where land = 1) then yes else 1 - yes end)::double
  from r, limits, rare where land = 1
union all select 2, null, null, count(*)::bigint, true, max(1 - yes)::double from r, rare where land = 1 and duration <= 10
union all select 2, null, null, count(*)::bigint, true, max(yes)::double from r, rare where land = 1 and duration > 10"""
)
def tree_rules(spark: SparkSession, folder: str) -> DataFrame:
    """The nodes of the tree study's tree, as a table."""
    rule = F.expr("land = 1 and duration > 10")
    records = flows(spark, folder, spread=True).withColumn("class", F.when(rule, "normal").otherwise("smurf"))
    study = studies.tree_study(records, FLOW_KEY, bins=(65,), depths=(2, 4), tree={"minInfoGain": 0.001})
    nodes = classify.tree_rules(study.model.stages[-1].bestModel, study.scored)
    above = nodes.select(F.col("id").alias("parent"), F.col("parent").alias("grandparent"))
    depth = F.when(F.col("parent").isNull(), 0).when(F.col("grandparent").isNull(), 1).otherwise(2)
    return nodes.join(above, "parent", "left").select(
        depth.alias("depth"),
        F.regexp_replace("slot", "_onehot_.*$", "").alias("slot"),
        F.round("threshold", 6).alias("threshold"),
        "rows",
        F.col("slot").isNull().alias("leaf"),
        "prediction",
    )


@query(
    f"""with {FLOWS}, layers(layer, sources, targets) as (values (1, 10, 10), (2, 10, 10), (3, 10, 2))
select layer, (sources * targets)::bigint as weights, targets::bigint as constants, true as scores_agree
from layers where exists (select 1 from flows)"""
)
def perceptron_weights(spark: SparkSession, folder: str) -> DataFrame:
    """A net's weights by layer, and whether they give the net's own scores back."""
    study = studies.perceptron_study(_records(spark, folder, SEPARABLE), FLOW_KEY, seed=1)
    weights = classify.perceptron_weights(study.model.stages[-1], study.counts)
    again = classify.perceptron_scores(weights, F.col("features"))
    gaps = F.zip_with(vector_to_array("probability"), again, lambda a, b: F.abs(a - b))
    largest = study.scored.agg(F.max(F.array_max(gaps))).first()[0]
    return weights.groupBy("layer").agg(
        F.count("source").alias("weights"),
        F.count_if(F.col("source").isNull()).alias("constants"),
        F.lit(largest < 1e-9).alias("scores_agree"),
    )
