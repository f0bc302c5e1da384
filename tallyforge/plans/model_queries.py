"""Catalogue: fitted models, on data whose right answer is known."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyforge.operators import classify, cluster, metrics, relational
from tallyforge.operators.features import fit_features, vector_size
from tallyforge.operators.split import in_training
from tallyforge.plans import studies
from tallyforge.plans.registry import query
from tallyforge.plans.shared import FLOWS, IN_TOSS, IN_TRAINING, IS_NORMAL, RULE_ON_TEST, encoded_flows
from tallyforge.sources.delimited import scan_csv, write_csv
from tallyforge.sources.tables import FLOW_KEY, flows, table
from tallyforge.spec import connection_spec
from tallyforge.staging import new_shared_path, settle, staged

def _fit_on_training_rows(
    spark: SparkSession, folder: str, estimator: Estimator
) -> tuple[Model, DataFrame]:
    """A fitted model and the encoded test rows it has not seen."""
    _, rows = encoded_flows(spark, folder)
    with staged(rows.filter("train").select("features", "label"), "features", vector_size(rows)) as train:
        model = estimator.fit(train)
    return model, rows.filter(~F.col("train"))


def _tree() -> Estimator:
    return classify.decision_tree("features", "label", maxBins=65, maxDepth=6)


@query(RULE_ON_TEST)
def decision_tree_predictions(spark: SparkSession, folder: str) -> DataFrame:
    model, test = _fit_on_training_rows(spark, folder, _tree())
    return classify.predict(model, test).select(FLOW_KEY, "prediction")


@query(RULE_ON_TEST)
def random_forest_rule(spark: SparkSession, folder: str) -> DataFrame:
    """A forest allowed to look at every feature finds the rule exactly."""
    forest = classify.random_forest(featureSubsetStrategy="all", seed=1)
    model, test = _fit_on_training_rows(spark, folder, forest)
    return classify.predict(model, test).select(FLOW_KEY, "prediction")


@query(RULE_ON_TEST)
def model_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Features and tree saved as one model, read back, and applied to raw records."""
    features, rows = encoded_flows(spark, folder)
    with staged(rows.filter("train").select("features", "label"), "features", vector_size(rows)) as train:
        tree = _tree().fit(train)
    # All stages are fitted already, so putting them together reads no rows.
    whole = Pipeline(stages=[*features.stages(with_label=False), tree]).fit(rows)
    model = classify.roundtrip(whole, rows)
    test = flows(spark, folder).filter(~in_training(FLOW_KEY))
    return classify.predict(model, test).select(FLOW_KEY, "prediction")


@query(f"with {FLOWS} select unnest(['duration', 'land']) as feature, min(true) as used from flows")
def tree_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The columns a fitted tree splits on."""
    model, test = _fit_on_training_rows(spark, folder, _tree())
    used = classify.tree_summary(model, test).filter(F.col("importance") > 0)
    names = used.select(F.regexp_replace("slot", "_onehot_.*$", "").alias("feature"))
    return names.distinct().withColumn("used", F.lit(True))


GRID = "(values (65, 4), (65, 6), (65, 8), (68, 4), (68, 6), (68, 8), (71, 4), (71, 6), (71, 8))"


@query(
    f"""with {FLOWS}, test as (select * from flows where not ({IN_TRAINING})),
sums as (
  select count(*)::double as n, count(*) filter (class = 'normal')::double as yes from test)
select 'n_rows' as metric, count(*)::double as value from flows
union all select 'n_train', count(*) filter ({IN_TRAINING})::double from flows
union all select 'n_test', n from sums
union all select 'auc', 1.0 from sums
union all select 'error_rate', 0.0 from sums
union all select 'total', n from sums
union all select 'correct', n from sums
union all select 'incorrect', 0.0 from sums
union all select 'ratio_correct', 1.0 from sums
union all select 'ratio_incorrect', 0.0 from sums
union all select 'tp', round(yes / n, 6) from sums
union all select 'tn', round(1 - yes / n, 6) from sums
union all select 'fp', 0.0 from sums
union all select 'fn', 0.0 from sums
union all select concat('auc bins=', b, ' depth=', d), 1.0 from sums, {GRID} g(b, d)"""
)
def cv_decision_tree(spark: SparkSession, folder: str) -> DataFrame:
    """The whole tree study: 37 fits, every grid point's score and the test measures."""
    study = studies.tree_study(flows(spark, folder, spread=True), FLOW_KEY)
    search = study.model.stages[-1]
    grid = [
        (" ".join(["auc", *sorted(f"{p.name[3:].lower()}={v}" for p, v in point.items())]), float(score))
        for point, score in zip(search.getEstimatorParamMaps(), search.avgMetrics)
    ]
    scores = spark.createDataFrame(grid, "metric string, value double")
    return study.measures.unionByName(scores).select("metric", F.round("value", 6).alias("value"))


@query(
    f"""with {FLOWS} select count(*) as n_test, true as nearly_all_correct
from flows where not ({IN_TRAINING})"""
)
def mlp_quality(spark: SparkSession, folder: str) -> DataFrame:
    """On scaled inputs the net learns the rule up to a few rows at the boundary."""
    study = studies.perceptron_study(
        flows(spark, folder, spread=True), FLOW_KEY, scale=True, seed=1
    )
    found = metrics.agreement(study.counts)
    return found.select(
        F.col("total").alias("n_test"),
        (F.col("ratio_correct") > 0.95).alias("nearly_all_correct"),
    )


# What holds exactly of a study whose model depends on a random start.
IDENTITIES = {
    "correct and incorrect are all": lambda m: m["correct"] + m["incorrect"] - m["total"],
    "ratios": lambda m: m["ratio_correct"] + m["ratio_incorrect"] - 1,
    "correct is ratio of total": lambda m: m["ratio_correct"] * m["total"] - m["correct"],
}


def _sizes_sql(rule: str) -> str:
    return f"""with {FLOWS}
select 'n_rows' as metric, count(*)::double as value from flows
union all select 'n_train', count(*) filter ({rule})::double from flows
union all select 'n_test', count(*) filter (not ({rule}))::double from flows
union all select 'total', count(*) filter (not ({rule}))::double from flows"""


def _zeros_sql(*names: str) -> str:
    return "".join(f" union all select '{n}', 0.0" for n in (*IDENTITIES, *names))


def _facts(study: studies.Study, **gaps: float) -> DataFrame:
    """Sizes, and the gaps of identities between the study's measures, rounded to six digits."""
    found = {r["metric"]: r["value"] for r in study.measures.collect()}
    facts = {k: found[k] for k in ("n_rows", "n_train", "n_test", "total")}
    facts |= {k: gap(found) for k, gap in IDENTITIES.items()}
    facts |= {k.replace("_", " "): v for k, v in gaps.items()}
    # Adding zero turns a negative zero into a plain one.
    rows = [(k, round(v, 6) + 0.0) for k, v in facts.items()]
    return study.measures.sparkSession.createDataFrame(rows, "metric string, value double")


def _cells_gap(study: studies.Study) -> float:
    """The four confusion cells over all rows add up to 1."""
    found = {r["metric"]: r["value"] for r in study.measures.collect()}
    return sum(found[k] for k in ("tp", "tn", "fp", "fn")) - 1


@query(_sizes_sql(IN_TRAINING) + _zeros_sql("cells"))
def mlp_unscaled(spark: SparkSession, folder: str) -> DataFrame:
    """The net on unscaled columns: sizes, and identities between its measures."""
    study = studies.perceptron_study(flows(spark, folder, spread=True), FLOW_KEY, seed=1)
    return _facts(study, cells=_cells_gap(study))


def _crossed_gap(study: studies.Study) -> float:
    """Crossed rates against the study's own counts, recomputed here."""
    found = {r["metric"]: r["value"] for r in study.measures.collect()}
    n = {(r["prediction"], r["truth"]): r["n"] for r in study.counts.collect()}
    yes = sum(v for (p, _), v in n.items() if p == 1.0)
    no = sum(v for (p, _), v in n.items() if p == 0.0)
    cells = {
        "tp_rate": (n.get((1.0, 1.0), 0), yes),
        "tn_rate": (n.get((0.0, 0.0), 0), no),
        "fp_rate": (n.get((1.0, 0.0), 0), no),
        "fn_rate": (n.get((0.0, 1.0), 0), yes),
    }
    wanted = {k: a / b if b else None for k, (a, b) in cells.items()}
    return sum(abs((found[k] or 0.0) - (v or 0.0)) for k, v in wanted.items())


@query(_sizes_sql(IN_TRAINING) + _zeros_sql("crossed rates"))
def mlp_formula(spark: SparkSession, folder: str) -> DataFrame:
    """The net on coded columns: sizes, identities, and the crossed rates of its own counts."""
    study = studies.formula_perceptron_study(flows(spark, folder, spread=True), FLOW_KEY, seed=1)
    return _facts(study, crossed_rates=_crossed_gap(study))


@query(
    f"""with {FLOWS}, test as (select * from flows where not ({IN_TRAINING})),
sums as (
  select count(*)::double as n, count(*) filter (class = 'normal')::double as yes from test)
select 'n_rows' as metric, count(*)::double as value from flows
union all select 'n_train', count(*) filter ({IN_TRAINING})::double from flows
union all select 'n_test', n from sums
union all select 'total', n from sums
union all select 'correct', n from sums
union all select 'incorrect', 0.0 from sums
union all select 'ratio_correct', 1.0 from sums
union all select 'ratio_incorrect', 0.0 from sums
union all select 'tp', round(yes / n, 6) from sums
union all select 'tn', round(1 - yes / n, 6) from sums
union all select 'fp', 0.0 from sums
union all select 'fn', 0.0 from sums"""
)
def forest_formula_rule(spark: SparkSession, folder: str) -> DataFrame:
    """The forest study with every feature open to each split, which makes its result exact."""
    study = studies.formula_forest_study(
        flows(spark, folder, spread=True), FLOW_KEY, seed=1, subset="all"
    )
    return study.measures.select("metric", F.round("value", 6).alias("value"))


@query(_sizes_sql(IN_TOSS.format(seed=1)) + _zeros_sql("cells"))
def forest_formula_default(spark: SparkSession, folder: str) -> DataFrame:
    """The forest at its default settings on tossed training rows: sizes and identities."""
    records = flows(spark, folder, spread=True)
    study = studies.formula_forest_study(records, FLOW_KEY, seed=1, toss_seed=1)
    return _facts(study, cells=_cells_gap(study))


# Two clumps of records far apart along one axis: any start converges to the same two clusters, so
# the centres, sizes and cost of a k-means fit are plain averages and counts.
GAP = 1_000_000
CLUMPS = f"""with {FLOWS}, clumps as (
  select land, {GAP} * land::double + src_bytes as a, duration as b from flows),
middle as (select land, avg(a) as a, avg(b) as b, count(*) as size from clumps group by land)
select m.size, round(m.a, 2) as center_a, round(m.b, 2) as center_b,
  round(sum((c.a - m.a) ** 2 + (c.b - m.b) ** 2) / m.size / 1e6, 4) as spread
from clumps c join middle m using (land) group by m.land, m.size, m.a, m.b"""


def _clumps(spark: SparkSession, folder: str) -> DataFrame:
    points = flows(spark, folder, spread=True).select(
        (F.lit(float(GAP)) * F.col("land") + F.col("src_bytes")).alias("a"),
        F.col("duration").alias("b"),
    )
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(points)
    return vectors.select("features")


def _clump_summary(fit: cluster.KMeans, points: DataFrame) -> DataFrame:
    with staged(points, "clumps", vector_size(points)) as rows:
        model = fit.fit(rows)
        return settle(_clump_table(model, classify.predict(model, rows)))


def _clump_table(model: cluster.KMeansModel, scored: DataFrame) -> DataFrame:
    sizes = cluster.cluster_summary(model, scored)
    centers = cluster.model_centers(model)
    wide = scored.sparkSession.createDataFrame(
        [(k, *c) for k, c in centers.items()], "cluster int, center_a double, center_b double"
    )
    # One row per cluster: its own share of the squared distances.
    costs = cluster.cluster_costs(scored, centers)
    return (
        sizes.join(wide, "cluster")
        .join(costs, "cluster")
        .select(
            "size",
            F.round("center_a", 2).alias("center_a"),
            F.round("center_b", 2).alias("center_b"),
            F.round(F.col("cost") / F.col("size") / 1e6, 4).alias("spread"),
        )
    )


@query(CLUMPS)
def kmeans_parallel(spark: SparkSession, folder: str) -> DataFrame:
    return _clump_summary(cluster.kmeans_parallel(2), _clumps(spark, folder))


@query(CLUMPS)
def kmeans_random(spark: SparkSession, folder: str) -> DataFrame:
    return _clump_summary(cluster.kmeans_random(2, seed=3), _clumps(spark, folder))


CONVERGED = f"""with {FLOWS}
select 'k' as metric, count(distinct class)::double as value from flows
union all select 'sum of sizes', count(*)::double from flows
union all select 'centres against means of members', 0.0"""


def _converged_fit(spark: SparkSession, folder: str, start: Callable[..., cluster.KMeans]) -> DataFrame:
    """k-means on the encoded features of all records, one cluster per class, once it has converged."""
    records = flows(spark, folder, spread=True)
    features = fit_features(records, connection_spec(key=[FLOW_KEY], host_login=True), "onehot", drop_constant=True)
    encoded = features.transform(records).select("features")
    with staged(encoded, "features", vector_size(encoded)) as rows:
        model = start(len(features.labels), seed=3, iterations=200).setTol(0.0).fit(rows)
        scored = classify.predict(model, rows)
        centers = cluster.model_centers(model)
        sizes = {r["cluster"]: r["size"] for r in cluster.cluster_summary(model, scored).collect()}
        gaps = [
            abs(mean - center) / max(1.0, abs(mean))
            for r in cluster.cluster_moments(scored, "prediction").collect()
            for mean, center in zip(r["mean"], centers[r["cluster"]])
        ]
    facts = [
        ("k", float(len(sizes))),
        ("sum of sizes", float(sum(sizes.values()))),
        ("centres against means of members", round(float(max(gaps)), 4)),
    ]
    return spark.createDataFrame(facts, "metric string, value double")


@query(CONVERGED)
def kmeans_parallel_features(spark: SparkSession, folder: str) -> DataFrame:
    return _converged_fit(spark, folder, cluster.kmeans_parallel)


@query(CONVERGED)
def kmeans_random_features(spark: SparkSession, folder: str) -> DataFrame:
    return _converged_fit(spark, folder, cluster.kmeans_random)


@query(
    f"""with {FLOWS}
select 'total' as metric, count(*)::double as value from flows
union all select 'clusters', count(distinct class)::double from flows
union all select 'sizes_add_up', 1.0 from flows having count(*) > 0
union all select 'correct_and_incorrect_add_up', 1.0 from flows having count(*) > 0
union all select 'cost_below_total_variation', 1.0 from flows having count(*) > 0"""
)
def kmeans_study_invariants(spark: SparkSession, folder: str) -> DataFrame:
    """What must hold for the clustering study over all features, wherever its centres fall."""
    records = flows(spark, folder, spread=True)
    study = studies.cluster_study(records, FLOW_KEY)
    measure = {r["metric"]: r["value"] for r in study.measures.collect()}
    sizes = cluster.cluster_summary(study.model, study.scored).agg(
        F.sum("size").alias("rows"), F.count("*").alias("clusters")
    ).first()
    whole = cluster.cluster_moments(study.scored.withColumn("one", F.lit(0)), "one").first()
    variation = (whole["size"] - 1) * sum(whole["variance"].toArray())
    rows = [
        ("total", measure["total"]),
        ("clusters", float(sizes["clusters"])),
        ("sizes_add_up", float(sizes["rows"] == measure["total"])),
        (
            "correct_and_incorrect_add_up",
            float(measure["correct"] + measure["incorrect"] == measure["total"]),
        ),
        ("cost_below_total_variation", float(measure["wssse"] < variation)),
    ]
    return spark.createDataFrame(rows, "metric string, value double")


@query(
    f"""with {FLOWS}
select 'class ' || class as metric, count(*)::double as value from flows group by class
union all select 'k', count(distinct class)::double from flows
union all select 'sum of sizes', count(*)::double from flows
union all select 'sum of histogram', count(*)::double from flows
union all select 'sizes against histogram', 0.0
union all select 'centres weighted by size against column means', 0.0
union all select 'correct against counts', 0.0
union all select 'ratios', 0.0"""
)
def kmeans_study(spark: SparkSession, folder: str) -> DataFrame:
    """The clustering study's tables, against each other and against the records.

    The mean of all rows is the mean of the clusters' means weighted by their sizes, whatever the
    clusters; k-means' centres are such means once it has converged.
    """
    study = studies.cluster_study(flows(spark, folder, spread=True), FLOW_KEY, iterations=200)
    found = {r["metric"]: r["value"] for r in study.measures.collect()}
    summary = study.tables["summary"].collect()
    sizes = {r["cluster"]: r["value"] for r in summary if r["item"] == "size"}
    histogram = {r["prediction"]: r["n"] for r in study.tables["histogram"].collect()}
    same = sum(r["n"] for r in study.counts.collect() if r["prediction"] == r["truth"])
    whole = cluster.cluster_moments(study.scored.withColumn("one", F.lit(0)), "one").first()
    centers = cluster.model_centers(study.model)
    gaps = []
    for pos, mean in enumerate(whole["mean"]):
        weighted = sum(n * centers[k][pos] for k, n in sizes.items()) / sum(sizes.values())
        gaps.append(abs(weighted - mean) / max(1.0, abs(mean)))
    rows = [(f"class {r['class']}", float(r["n"])) for r in study.tables["classes"].collect()]
    rows += [
        ("k", next(r["value"] for r in summary if r["item"] == "k")),
        ("sum of sizes", float(sum(sizes.values()))),
        ("sum of histogram", float(sum(histogram.values()))),
        ("sizes against histogram", float(sum(abs(n - histogram.get(k, 0)) for k, n in sizes.items()))),
        ("centres weighted by size against column means", round(float(max(gaps)), 4)),
        ("correct against counts", found["correct"] - same),
        ("ratios", round(found["ratio_correct"] + found["ratio_incorrect"] - 1, 6) + 0.0),
    ]
    return spark.createDataFrame(rows, "metric string, value double")


@query(
    f"""with {FLOWS} select case when class = 'normal' then class else 'attack' end as truth,
  count(*)::bigint as n from flows where not ({IN_TOSS.format(seed=3)}) group by 1"""
)
def kmeans_formula_contingency(spark: SparkSession, folder: str) -> DataFrame:
    """Clusters found in tossed training rows: the test rows per class, over all clusters."""
    records = flows(spark, folder, spread=True)
    study = studies.formula_cluster_study(records, FLOW_KEY, seed=3, toss_seed=3)
    return study.counts.groupBy("truth").agg(F.sum("n").alias("n"))


# Labels that follow a rule of two columns except for one row in ten: a tree that must gain something
# finds the three cells of the rule and nothing else, so its scores are counts per cell.
FLIP = "('0x' || substr(md5('flip' || flow_key), 1, 8))::bigint % 10 = 0"
FLIP_SPARK = "cast(conv(substr(md5(concat('flip', flow_key)), 1, 8), 16, 10) as bigint) % 10 = 0"
CELLS_RULE = "land = 1 and duration > 10"
NOISY = f"""noisy as (
  select flow_key, land, duration, {IN_TRAINING} as train,
    ('0x' || substr(md5(flow_key), 9, 8))::bigint % 4 as fold,
    (({CELLS_RULE}) <> ({FLIP}))::int as y
  from flows),
cells as (
  select *, land as cell1, case when land = 0 then 0 when duration <= 10 then 1 else 2 end as cell2 from noisy)"""


def _auc_sql(name: str, learned: str, judged: str, cell: str) -> str:
    """CTE with the area under ROC of cells of ``judged`` rows scored by their class 1 rows in ``learned``."""
    return f"""{name} as (
  with s as (select {cell} as c, sum(y)::double as score from cells where {learned} group by 1),
  j as (
    select score, sum(y)::double as p, sum(1 - y)::double as q
    from cells join s on s.c = {cell} where {judged} group by score),
  a as (select p, q, sum(p) over (order by score desc rows unbounded preceding) as so_far from j)
  select sum(q * (so_far - p / 2)) / (sum(p) * sum(q)) as auc from a)"""


_FOLD_AUC = ", ".join(
    _auc_sql(f"auc{d}_{f}", f"train and fold <> {f}", f"train and fold = {f}", f"cell{d}")
    for d in (1, 2)
    for f in range(4)
)
_MEAN_AUC = {
    d: "(" + " + ".join(f"(select auc from auc{d}_{f})" for f in range(4)) + ") / 4" for d in (1, 2)
}


@query(
    f"""with {FLOWS}, {NOISY}, {_FOLD_AUC}, {_auc_sql("test_auc", "train", "not train", "cell2")},
t as (select *, (cell2 = 2)::int as p from cells where not train)
select 'auc depth=1' as metric, round({_MEAN_AUC[1]}, 6) as value
union all select 'auc depth=2', round({_MEAN_AUC[2]}, 6)
union all select 'auc depth=5', round({_MEAN_AUC[2]}, 6)
union all select 'auc', round(auc, 6) from test_auc
union all select 'error_rate', round(1 - auc, 6) from test_auc
union all select 'tp', round(avg((p = 1 and y = 1)::int), 6) from t
union all select 'tn', round(avg((p = 0 and y = 0)::int), 6) from t
union all select 'fp', round(avg((p = 1 and y = 0)::int), 6) from t
union all select 'fn', round(avg((p = 0 and y = 1)::int), 6) from t
union all select 'ratio_correct', round(avg((p = y)::int), 6) from t
union all select 'best depth', 2.0
union all select 'importances', 1.0
union all select 'slots used', 2.0
union all select 'leaves', 3.0"""
)
def cv_noisy_tree(spark: SparkSession, folder: str) -> DataFrame:
    """The tree study where labels are noisy and grid points differ: every fold's score is checked."""
    noisy = F.expr(f"({CELLS_RULE}) <> ({FLIP_SPARK})")
    records = flows(spark, folder, spread=True).withColumn("class", F.when(noisy, "normal").otherwise("smurf"))
    study = studies.tree_study(
        records, FLOW_KEY, bins=(65,), depths=(1, 2, 5), tree={"minInfoGain": 0.02}
    )
    search = study.model.stages[-1]
    rows = [
        (f"auc depth={next(v for p, v in point.items() if p.name == 'maxDepth')}", float(score))
        for point, score in zip(search.getEstimatorParamMaps(), search.avgMetrics)
    ]
    best = search.bestModel
    used = [v for v in best.featureImportances.toArray() if v > 0]
    rows += [
        ("best depth", float(best.getOrDefault("maxDepth"))),
        ("importances", float(sum(used))),
        ("slots used", float(len(used))),
        ("leaves", float((best.numNodes + 1) // 2)),
    ]
    wanted = ["auc", "error_rate", "tp", "tn", "fp", "fn", "ratio_correct"]
    found = study.measures.where(F.col("metric").isin(wanted))
    every = found.unionByName(spark.createDataFrame(rows, "metric string, value double"))
    return every.select("metric", F.round("value", 6).alias("value"))


@query(
    f"""with {FLOWS} select 'n_rows' as metric, count(*)::double as value from flows
union all select 'train and test', count(*)::double from flows
union all select 'auc', 1.0 union all select 'ratio_correct', 1.0"""
)
def csv_study_without_key(spark: SparkSession, folder: str) -> DataFrame:
    """From delimited text without a row key to the measures of a tree study."""
    path = new_shared_path(spark, "records-csv")
    records = flows(spark, folder, spread=True).drop(FLOW_KEY)
    write_csv(records, path)
    read = scan_csv(spark, path, schema=records.schema, fail_fast=True)
    study = studies.tree_study(read, None, bins=(65,), depths=(4, 6))
    found = {r["metric"]: r["value"] for r in study.measures.collect()}
    rows = [
        ("n_rows", found["n_rows"]),
        ("train and test", found["n_train"] + found["n_test"]),
        ("auc", round(found["auc"], 6)),
        ("ratio_correct", round(found["ratio_correct"], 6)),
    ]
    return spark.createDataFrame(rows, "metric string, value double")


@query(
    f"""with {FLOWS} select * from (values ('layer', 0, 10), ('layer', 1, 10), ('layer', 2, 10), ('layer', 3, 2),
  ('weights', 0, 10 * 10 + 10 + 10 * 10 + 10 + 10 * 2 + 2)) as v(item, pos, value)
where exists (select 1 from flows)"""
)
def perceptron_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Layers and weights of a net fitted on the four numbers and six category indices."""
    study = studies.perceptron_study(flows(spark, folder), FLOW_KEY, scale=True, seed=1)
    found = classify.perceptron_summary(study.model.stages[-1], study.counts)
    return found.withColumn("value", F.col("value").cast("int"))


# Two rounds of k-means from one fixed example per label.
def _round(i: int) -> str:
    before = f"c{i - 1}"
    return f"""d{i} as (
  select vec_id, cluster, sum((x - value) ** 2) as d
  from points join {before} using (pos) group by vec_id, cluster),
a{i} as (
  select vec_id, cluster, d from d{i}
  qualify row_number() over (partition by vec_id order by d, cluster) = 1),
c{i} as (
  select cluster, pos, avg(x) as value from points join a{i} using (vec_id) group by cluster, pos)"""


LLOYD = f"""with points as (
  select vec_id, label, (generate_subscripts(embedding, 1) - 1)::int as pos,
    unnest(embedding)::double as x from embeddings),
starts as (
  select vec_id, (row_number() over (order by label) - 1)::int as cluster
  from (select label, min(vec_id) as vec_id from embeddings group by label)),
c0 as (select cluster, pos, x as value from points join starts using (vec_id)),
{_round(1)}, {_round(2)}, {_round(3)}"""
ROUNDS = 2


def _warm(spark: SparkSession, folder: str) -> tuple[DataFrame, dict[int, list[float]]]:
    points = table(spark, folder, "embeddings")
    start = cluster.first_of_each(points, "label", "vec_id", "embedding")
    return points, cluster.warm_start(points, "embedding", start, ROUNDS)


@query(f"{LLOYD} select vec_id, cluster as prediction from a3")
def kmeans_warm_start(spark: SparkSession, folder: str) -> DataFrame:
    points, centers = _warm(spark, folder)
    return cluster.assign(points, "embedding", centers).select("vec_id", "prediction")


@query(f"{LLOYD} select cluster, pos, round(value, 6) as value from c2")
def kmeans_centers(spark: SparkSession, folder: str) -> DataFrame:
    centers = cluster.centers_table(spark, _warm(spark, folder)[1])
    return centers.withColumn("value", F.round("value", 6))


@query(f"{LLOYD} select round(sum(d), 6) as wssse from a3")
def wssse(spark: SparkSession, folder: str) -> DataFrame:
    points, centers = _warm(spark, folder)
    vectors = cluster.assign(points, "embedding", centers).select(
        "prediction", array_to_vector("embedding").alias("features")
    )
    return cluster.wssse(vectors, centers).select(F.round("wssse", 6).alias("wssse"))


def _warm_counts(spark: SparkSession, folder: str) -> DataFrame:
    points, centers = _warm(spark, folder)
    return relational.contingency(cluster.assign(points, "embedding", centers))


@query(
    f"""{LLOYD} select a3.cluster as prediction, e.label as truth, count(*)::bigint as n
from a3 join embeddings e using (vec_id) group by 1, 2"""
)
def cluster_contingency(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per cluster and label where the assignments are known."""
    return _warm_counts(spark, folder)


@query(
    f"""{LLOYD}, joined as (select a3.cluster, e.label from a3 join embeddings e using (vec_id))
select count(*) as total, count(*) filter (cluster = label) as correct,
  count(*) filter (cluster <> label) as incorrect,
  round(count(*) filter (cluster = label)::double / count(*), 6) as ratio_correct,
  round(count(*) filter (cluster <> label)::double / count(*), 6) as ratio_incorrect from joined"""
)
def cluster_naive_match(spark: SparkSession, folder: str) -> DataFrame:
    found = metrics.agreement(_warm_counts(spark, folder))
    return found.withColumns(
        {c: F.round(c, 6) for c in ("ratio_correct", "ratio_incorrect")}
    )


@query(
    f"""{LLOYD}, joined as (
  select a3.cluster, e.label, count(*) as n from a3 join embeddings e using (vec_id) group by 1, 2),
best as (
  select cluster, label, n from joined
  qualify row_number() over (partition by cluster order by n desc, label) = 1)
select sum(j.n)::bigint as total, (select sum(n) from best)::bigint as correct,
  (sum(j.n) - (select sum(n) from best))::bigint as incorrect,
  round((select sum(n) from best)::double / sum(j.n), 6) as ratio_correct,
  round((sum(j.n) - (select sum(n) from best))::double / sum(j.n), 6) as ratio_incorrect
from joined j"""
)
def cluster_majority(spark: SparkSession, folder: str) -> DataFrame:
    found = metrics.agreement(metrics.majority_counts(_warm_counts(spark, folder)))
    return found.withColumns(
        {c: F.round(c, 6) for c in ("ratio_correct", "ratio_incorrect")}
    )


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Encode, split by key, fit one tree, score the test rows, confusion cells over the total."""
    model, test = _fit_on_training_rows(spark, folder, _tree())
    counts = relational.contingency(classify.predict(model, test))
    return metrics.confusion_over_total(counts, 1.0, 0.0)
