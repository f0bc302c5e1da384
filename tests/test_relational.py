from pyspark.sql import functions as F

from tallyforge.operators import relational as rel

from tests.conftest import tuples


def classes(spark):
    return spark.createDataFrame([("a",), ("a",), (None,)], "class string")


def test_group_count_counts_null_and_distinct_count_does_not(spark):
    df = classes(spark)
    assert tuples(rel.group_cardinality(df, "class")) == [(2,)]
    assert tuples(rel.count_distinct(df, "class")) == [(1,)]


def test_value_counts_has_a_null_group(spark):
    assert set(tuples(rel.value_counts(classes(spark), "class"))) == {("a", 2), (None, 1)}


def test_distinct_values(spark):
    assert set(tuples(rel.distinct_values(classes(spark), "class"))) == {("a",), (None,)}


def test_null_neither_matches_nor_differs(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 0.0), (1.0, None), (None, None)], "p double, t double")
    assert tuples(rel.matching(df, "p", "t")) == [(1.0, 1.0)]
    assert tuples(rel.mismatching(df, "p", "t")) == [(1.0, 0.0)]


def test_where_equal_combines_conditions_in_one_filter(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 1.0), (0.0, 0.0)], "p double, t double")
    kept = rel.where_equal(df, p=1.0, t=0.0)
    assert tuples(kept) == [(1.0, 0.0)]


def test_preview_takes_the_smallest_in_order(spark):
    df = spark.range(100).repartition(5)
    top = rel.preview(df, 3, [F.col("id").desc()])
    assert tuples(top) == [(99,), (98,), (97,)]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_split_sizes_in_one_pass(spark):
    df = spark.range(10)
    assert tuples(rel.split_sizes(df, F.col("id") < 7)) == [(10, 7, 3)]


def test_constant_columns(spark):
    df = spark.createDataFrame(
        [(1, "x", None, 1), (2, "x", None, None)], "a int, b string, c string, d int"
    )
    assert rel.constant_columns(df, df.columns) == ["b", "c", "d"]
    assert rel.constant_columns(df, []) == []


def test_contingency_and_histogram(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 0.0), (0.0, 0.0)], "prediction double, label double")
    counts = rel.contingency(df)
    assert set(tuples(counts)) == {(1.0, 0.0, 2), (0.0, 0.0, 1)}
    assert set(tuples(rel.prediction_histogram(counts))) == {(1.0, 2), (0.0, 1)}


def test_projection_and_drop(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert rel.project(df, ["c", "a"]).columns == ["c", "a"]
    assert rel.drop_columns(df, ["b", "absent"]).columns == ["a", "c"]


def test_sketches_add_up_across_parts(spark):
    df = spark.range(60_000).selectExpr("concat('v', id % 20000) as v", "id % 7 as part", "id % 2 as half")
    parts = rel.distinct_sketches(df, "v", "part", "half")
    assert parts.count() == 14
    merged = {r["half"]: r["n_distinct"] for r in rel.sketched_distinct(rel.merge_sketches(parts, "half")).collect()}
    assert all(abs(n - 10_000) < 0.05 * 10_000 for n in merged.values())
    every = rel.sketched_distinct(rel.merge_sketches(parts)).first()["n_distinct"]
    assert abs(every - 20_000) < 0.05 * 20_000
    at_once = rel.sketched_distinct(rel.distinct_sketches(df, "v")).first()["n_distinct"]
    assert at_once == every


def test_sketches_ignore_nulls_and_count_few_values_exactly(spark):
    df = spark.createDataFrame([("a", 1), (None, 1), ("b", 1), ("a", 1), (None, 2)], "v string, g int")
    sketches = rel.distinct_sketches(df, "v", "g")
    assert dict(tuples(rel.sketched_distinct(sketches))) == {1: 2, 2: 0}
    assert rel.sketched_distinct(rel.merge_sketches(sketches)).first()["n_distinct"] == 2
    plan = sketches._jdf.queryExecution().executedPlan().toString()
    assert "partial_hll_sketch_agg" in plan
