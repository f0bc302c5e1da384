import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tallyforge import staging
from tallyforge.operators import cluster
from tallyforge.operators.features import vector_size
from tallyforge.plans import catalogue, model_queries, studies
from tallyforge.sources.tables import FLOW_KEY, flows


def _bounded(monkeypatch, entries):
    """Tasks of at most a thousand rows."""
    monkeypatch.setattr(staging, "FIT_BYTES", 1000 * (staging.ROW_BYTES + 4 * entries))


def test_rows_of_a_fit_are_read_by_tasks_of_bounded_size(spark, shared, monkeypatch):
    _bounded(monkeypatch, 3)
    before = spark.conf.get(staging.OPEN_COST)
    table = spark.range(10_500, numPartitions=1).select("id", F.lit("x").alias("text"))
    with staging.staged(table, "fit", 3) as rows:
        sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 10_500 and max(sizes) <= 1000
        assert rows.select("id").distinct().count() == 10_500
    assert spark.conf.get(staging.OPEN_COST) == before


def test_open_cost_is_restored_after_an_error(spark, shared):
    before = spark.conf.get(staging.OPEN_COST)
    try:
        with staging.staged(spark.range(5), "fit", 3):
            raise RuntimeError
    except RuntimeError:
        pass
    assert spark.conf.get(staging.OPEN_COST) == before


def test_clustering_queries_fit_in_bounded_tasks(spark, shared, monkeypatch, data):
    points = model_queries._clumps(spark, data)
    _bounded(monkeypatch, vector_size(points))
    asked = []

    class Fit:
        def fit(self, rows):
            asked.append(max(r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()))
            return cluster.kmeans_parallel(2).fit(rows)

    model_queries._clump_summary(Fit(), points.coalesce(1))
    assert asked[0] <= 1000


def test_fits_run_side_by_side_only_where_one_leaves_cores_idle(spark):
    cores = spark.sparkContext.defaultParallelism
    vectors = spark.range(100).select(array_to_vector(F.array(F.col("id").cast("double"))).alias("features"))
    assert staging.side_by_side(vectors.repartition(cores), 4) == 4
    assert staging.side_by_side(vectors.repartition(2 * cores), 4) == 2
    assert staging.side_by_side(vectors.repartition(40 * cores), 4) == 1


def test_parts_of_a_staged_table_are_read_apart(spark, shared):
    before = spark.conf.get(staging.WRITERS)
    table = spark.range(4000, numPartitions=2).select(
        (F.col("id") % 3 > 0).alias("train"), (F.col("id") % 4).cast("int").alias("fold"), "id"
    )
    with staging.staged(table, "fit", 3, ["train", "fold"]) as rows:
        assert rows.dtypes == table.dtypes
        assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, table.collect()))
        tasks = [r.rdd.getNumPartitions() for r in (rows, rows.filter("train"), rows.filter("train and fold <> 1"))]
        assert tasks == [16, 8, 6]
    assert spark.conf.get(staging.WRITERS) == before


def test_parts_of_an_empty_table(spark, shared):
    table = spark.range(0).select((F.col("id") > 3).alias("train"), "id")
    with staging.staged(table, "fit", 3, ["train"]) as rows:
        assert rows.dtypes == table.dtypes and rows.count() == 0


class Seen(Exception):
    pass


def test_search_is_given_only_what_it_uses_and_runs_alone_on_many_tasks(spark, shared, monkeypatch, data):
    """The search caches every column, and each fit that runs beside another keeps all rows once more."""
    given = {}

    class Search:
        def fit(self, rows):
            given["columns"] = set(rows.columns)
            raise Seen

    def search(tree, **settings):
        given.update(settings)
        return Search()

    monkeypatch.setattr(studies.classify, "cross_validator", search)
    monkeypatch.setattr(staging, "FIT_BYTES", 1)  # the fewest rows a task may have
    records = flows(spark, data).union(flows(spark, data)).union(flows(spark, data)).union(flows(spark, data))
    records = records.union(records)  # 48,000 rows, so 48 tasks or more
    with pytest.raises(Seen):
        studies.tree_study(records, FLOW_KEY)
    assert given["columns"] == {"indexedFeatures", "indexedLabel", "label", "fold"}
    assert given["parallelism"] == max(1, 4 * spark.sparkContext.defaultParallelism // 48)


@pytest.mark.parametrize("name", ["csv_study_without_key", "cv_noisy_tree"])
def test_tree_queries_use_all_cores_on_a_table_of_few_splits(spark, monkeypatch, data, name):
    tasks = []

    def study(records, key, **settings):
        tasks.append(records.rdd.getNumPartitions())
        raise Seen

    monkeypatch.setattr(studies, "tree_study", study)
    if name == "csv_study_without_key":
        monkeypatch.setattr(model_queries, "write_csv", lambda df, path: study(df, None))
    with pytest.raises(Seen):
        catalogue.QUERIES[name](spark, data)
    assert tasks[0] >= spark.sparkContext.defaultParallelism


@pytest.mark.parametrize(
    "fit", [studies.tree_study, studies.perceptron_study, studies.formula_forest_study, studies.formula_perceptron_study]
)
def test_fits_stage_training_rows_apart_and_without_their_keys(spark, monkeypatch, data, fit):
    """A pass over the training rows need not read the test rows, and no pass reads a key."""
    given = []

    def keep(df, name, entries, parts=()):
        given.append((set(df.columns), list(parts)))
        raise Seen

    monkeypatch.setattr(studies, "staged", keep)
    with pytest.raises(Seen):
        fit(flows(spark, data), FLOW_KEY)
    columns, parts = given[0]
    assert FLOW_KEY not in columns and parts[0] == "train"
