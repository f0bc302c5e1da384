import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tallyforge.operators import dictionaries, features as ft
from tallyforge.sources.tables import FLOW_KEY, flows, table
from tallyforge.spec import FeatureSpec, connection_spec

from tests.conftest import tuples

TIED = ["b", "a", "a", "b", "c", "c", "c", "d"]


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v string")


def test_most_frequent_first_and_ties_by_text(spark):
    assert dictionaries.fit_dictionaries(texts(spark, TIED), ["v"]).labels("v") == ["c", "a", "b", "d"]


def test_order_equals_string_indexer_beyond_the_basic_plane(spark):
    # U+1F600 sorts after U+FF21 by code point and before it by UTF-16 unit.
    df = texts(spark, ["\U0001f600", "Ａ", "z"])
    expected = StringIndexer(inputCol="v", outputCol="i").fit(df).labels
    assert dictionaries.fit_dictionaries(df, ["v"]).labels("v") == expected
    joined = ft.string_index(df, ["v"], max_size=1)
    assert {v: int(i) for v, i in tuples(joined)} == {v: i for i, v in enumerate(expected)}


def test_numbers_are_indexed_as_text_and_nulls_ignored(spark):
    df = spark.createDataFrame([(10,), (2,), (2,), (None,)], "v int")
    assert dictionaries.fit_dictionaries(df, ["v"]).labels("v") == ["2", "10"]
    empty = dictionaries.fit_dictionaries(df.filter("false"), ["v"])
    assert empty.labels("v") == []


@pytest.mark.parametrize("size", [100, 2])
def test_unseen_and_null_values_are_errors(spark, size):
    for bad in ("zz", None):
        out = ft.string_index(
            texts(spark, [bad]), ["v"], fit_on=texts(spark, TIED), max_size=size
        )
        with pytest.raises(Exception):
            out.collect()


@pytest.mark.parametrize("size", [100, 2])
def test_unseen_values_kept_or_skipped(spark, size):
    seen, new = texts(spark, TIED), texts(spark, ["zz", "a", None])
    kept = ft.string_index(new, ["v"], fit_on=seen, handle_invalid="keep", max_size=size)
    assert set(tuples(kept)) == {("zz", 4.0), ("a", 1.0), (None, 4.0)}
    left = ft.string_index(new, ["v"], fit_on=seen, handle_invalid="skip", max_size=size)
    assert tuples(left) == [("a", 1.0)]


def test_large_dictionary_equals_string_indexer_under_skew(spark):
    # A third of the rows share one value; the rest is a long tail with many ties.
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .otherwise(F.concat(F.lit("v"), F.col("id") % 4001))
        .alias("v"),
        "id",
    )
    got = ft.string_index(df, ["v"], max_size=10)
    expected = StringIndexer(inputCol="v", outputCol="v_index").fit(df).transform(df)
    columns = ["id", "v", "v_index"]
    assert got.select(columns).exceptAll(expected.select(columns)).count() == 0
    assert got.count() == 30_000


def test_no_heavy_or_null_value_meets_in_one_task(spark):
    """Settled rows and nulls are spread in the join of the rest of a dictionary."""
    rows = [("hot",)] * 4000 + [(None,)] * 4000 + [(f"v{i}",) for i in range(200)]
    df = spark.createDataFrame(rows, "v string").withColumn("n", F.monotonically_increasing_id())
    found = dictionaries.fit_dictionaries(df, ["v"], max_size=2)
    joined = dictionaries.index_by_join(df, "v", found.large["v"], "i", "keep", head=2)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 2 * 8200 / 8


@pytest.mark.parametrize("columns", [["l_orderkey"], ["l_orderkey", "l_partkey"], ["l_orderkey", "l_partkey", "l_suppkey"]])
def test_the_source_is_read_once_for_any_number_of_large_columns(spark, data, columns):
    lines = table(spark, data, "lineitem")
    indexed = ft.string_index(lines, columns, max_size=5)
    leaves = indexed._jdf.queryExecution().optimizedPlan().collectLeaves().toString()
    assert leaves.count("l_linenumber") == 1


@pytest.mark.parametrize("handle", ["keep", "error", "skip"])
def test_both_forms_of_a_dictionary_give_the_same_metadata(spark, handle):
    seen = texts(spark, ["a", "b", "a", "c", "d"])
    listed = ft.string_index(seen, ["v"], handle_invalid=handle, max_size=100)
    joined = ft.string_index(seen, ["v"], handle_invalid=handle, max_size=2)
    sizes = []
    for df in (listed, joined):
        found = df.schema["v_index"].metadata["ml_attr"]
        assert found["type"] == "nominal" and found["name"] == "v_index"
        sizes.append(found.get("num_vals") or len(found["vals"]))
    assert sizes[0] == sizes[1] == 4 + (handle == "keep")
    encoded = [ft.vector_size(ft.one_hot(df, ["v"]), "v_onehot") for df in (listed, joined)]
    assert encoded[0] == encoded[1]


def test_dictionaries_are_bounded_together(spark):
    df = spark.createDataFrame([(str(i), str(i % 4), str(i % 3)) for i in range(12)], "a string, b string, c string")
    found = dictionaries.fit_dictionaries(df, ["a", "b", "c"], max_size=8)
    assert set(found.small) == {"b", "c"} and set(found.large) == {"a"}
    assert found.sizes == {"a": 12, "b": 4, "c": 3}


@pytest.mark.parametrize(("numeric", "rows"), [("error", None), ("keep", 2), ("skip", 1)])
def test_null_numerics_have_their_own_rule(spark, numeric, rows):
    df = spark.createDataFrame([("a", 1.0, "x"), ("b", None, "y")], "v string, n double, class string")
    model = ft.fit_features(df, FeatureSpec(("v",)), "ordinal", handle_invalid="keep", numeric_invalid=numeric)
    if rows is None:
        with pytest.raises(Exception, match="(?i)null"):
            model.transform(df).collect()
    else:
        assert len(model.transform(df).collect()) == rows


def test_long_values_count_against_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(dictionaries, "MAX_DICTIONARY_BYTES", 5)
    df = texts(spark, ["aaaa", "aaaa", "bbbb", "c"])
    found = dictionaries.fit_dictionaries(df, ["v"])
    assert "v" in found.large
    out = ft.string_index(df, ["v"])
    assert set(tuples(out)) == {("aaaa", 0.0), ("bbbb", 1.0), ("c", 2.0)}


def test_ranking_over_many_partitions(spark):
    counts = spark.range(5000).select(
        F.concat(F.lit("k"), F.col("id")).alias("value"), (F.col("id") % 7).alias("n")
    )
    ranks = dictionaries.rank_values(counts, partitions=16)
    expected = sorted(((-(i % 7), f"k{i}") for i in range(5000)))
    got = {v: int(i) for v, i in tuples(ranks)}
    assert got == {v: i for i, (_, v) in enumerate(expected)}


def test_one_hot_drops_the_last_category(spark):
    out = ft.one_hot(ft.string_index(texts(spark, TIED), ["v"]), ["v"])
    got = {r["v"]: list(r["a"]) for r in out.select("v", vector_to_array("v_onehot").alias("a")).collect()}
    assert got == {"c": [1, 0, 0], "a": [0, 1, 0], "b": [0, 0, 1], "d": [0, 0, 0]}


def test_constant_category_is_an_error_unless_dropped(spark):
    df = spark.createDataFrame([("x", 1.0, "a"), ("x", 2.0, "b")], "c string, x double, class string")
    spec = FeatureSpec(categorical=("c",))
    with pytest.raises(Exception):
        ft.fit_features(df, spec)
    model = ft.fit_features(df, spec, drop_constant=True)
    out = model.transform(df)
    assert ft.slot_names(out) == ["x"]
    assert out.columns == ["c", "x", "class", "features", "label"]


def test_numeric_columns_come_first_then_categories_in_list_order(spark):
    df = spark.createDataFrame(
        [("p", 1, 5.0, "u", "normal"), ("q", 2, 6.0, "u", "attack"), ("p", 3, 0.0, "w", "attack")],
        "b string, n int, x double, a string, class string",
    )
    spec = FeatureSpec(categorical=("b", "a"))
    onehot = ft.fit_features(df, spec).transform(df)
    assert ft.slot_names(onehot) == ["n", "x", "b_onehot_p", "a_onehot_u"]
    ordinal = ft.fit_features(df, spec, "ordinal").transform(df)
    assert ft.slot_names(ordinal) == ["n", "x", "b_index", "a_index"]
    formula = ft.fit_features(df, spec, "formula").transform(df)
    assert ft.slot_names(formula) == ["b_onehot_p", "n", "x", "a_onehot_u"]
    assert [r["label"] for r in onehot.collect()] == [1.0, 0.0, 0.0]
    with pytest.raises(ValueError):
        ft.fit_features(df, spec, "other")


def test_formula_equals_mllib(spark, data):
    records = flows(spark, data).drop("is_host_login")
    spec = connection_spec(key=[FLOW_KEY])
    ours = ft.vector_entries(
        ft.fit_features(records, spec, "formula").transform(records), [FLOW_KEY]
    )
    theirs = ft.vector_entries(
        ft.fit_formula(records, "class", [FLOW_KEY]).transform(records), [FLOW_KEY]
    )
    assert ours.exceptAll(theirs).count() == 0
    assert theirs.exceptAll(ours).count() == 0


def test_features_with_a_large_dictionary_equal_the_small_ones(spark, data):
    records = flows(spark, data)
    spec = connection_spec(key=[FLOW_KEY])
    small = ft.fit_features(records, spec)
    large = ft.fit_features(records, spec, max_size=7)
    assert "service" in large.dictionaries.large
    a = ft.vector_entries(small.transform(records), [FLOW_KEY])
    b = ft.vector_entries(large.transform(records), [FLOW_KEY])
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    with pytest.raises(ValueError):
        large.stages()


def test_encoding_reads_only_the_needed_columns_without_a_shuffle(spark, data):
    records = flows(spark, data)
    out = ft.fit_features(records, connection_spec(key=[FLOW_KEY])).transform(records)
    plan = out.select("features", "label")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "l_orderkey" not in plan.split("ReadSchema")[1]


def test_vector_index_keeps_zero_at_zero(spark):
    df = spark.createDataFrame(
        [(Vectors.dense(v, float(i)),) for i, v in enumerate([-1.0, 0.0, 5.0, 0.0, 5.0])], ["features"]
    )
    model = ft.fit_vector_index(df, max_categories=3)
    assert set(tuples(ft.vector_index_map(df, model))) == {(0, 0.0, 0), (0, -1.0, 1), (0, 5.0, 2)}


def test_label_reindex_breaks_ties_as_text(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)], ["label"])
    labels = ft.fit_label_reindex(df).labels
    assert labels.index("10.0") < labels.index("2.0")


def test_decode_labels(spark):
    df = spark.createDataFrame([(0.0,), (1.0,)], ["prediction"])
    assert [r["decoded"] for r in ft.decode_labels(df, ["attack", "normal"]).collect()] == [
        "attack",
        "normal",
    ]


def test_scaler_centres_and_scales(spark):
    df = spark.createDataFrame([(Vectors.dense(1.0),), (Vectors.dense(3.0),)], ["features"])
    out = ft.fit_scaler(df).transform(df)
    values = [r[0] for r in tuples(out.select(vector_to_array("scaledFeatures")[0]))]
    assert values == pytest.approx([-(0.5**0.5), 0.5**0.5])


def test_vector_entries_of_sparse_and_dense_vectors(spark):
    df = spark.createDataFrame(
        [("s", Vectors.sparse(5, {1: 2.0, 3: 0.0})), ("d", Vectors.dense(0.0, 7.0))], ["k", "features"]
    )
    assert set(tuples(ft.vector_entries(df, ["k"]))) == {("s", 1, 2.0), ("d", 1, 7.0)}


def test_vector_size_needs_metadata(spark):
    df = spark.createDataFrame([(Vectors.dense(1.0),)], ["features"])
    with pytest.raises(ValueError):
        ft.vector_size(df)
