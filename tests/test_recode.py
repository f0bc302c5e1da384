from tallyforge.functions import recode

from tests.conftest import tuples


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "v string").select(expression.alias("r")).first()["r"]


def test_binarize_keeps_normal_and_null(spark):
    binarize = recode.class_binarize("v")
    assert one(spark, "normal", binarize) == "normal"
    assert one(spark, "smurf", binarize) == "attack"
    assert one(spark, None, binarize) is None


def test_numeric_class_counts_null_as_normal(spark):
    numeric = recode.class_to_numeric("v")
    assert one(spark, "normal", numeric) == 1.0
    assert one(spark, "smurf", numeric) == 0.0
    assert one(spark, None, numeric) == 1.0


def test_protocol_codes(spark):
    code = recode.protocol_code("v")
    assert [one(spark, v, code) for v in ("tcp", "udp", "icmp", None)] == [0, 1, 2, 2]


def test_flag_codes(spark):
    code = recode.flag_code("v")
    names = "SF S0 S1 S2 S3 SH OTH REJ RSTO RSTOS0".split()
    assert [one(spark, v, code) for v in names] == list(range(10))
    assert [one(spark, v, code) for v in ("RSTR", "sf", "", None)] == [10] * 4


def test_code_maps_prefer_the_listed_name(spark):
    code = recode.map_codes("v", {"a": 7, "b": 8}, -1)
    assert [one(spark, v, code) for v in ("a", "b", "c", None)] == [7, 8, -1, -1]


def test_ratio_of_nothing_is_null(spark):
    df = spark.createDataFrame([(1, 4), (1, 0), (0, 0), (None, 3)], "a int, b int")
    assert tuples(df.select(recode.ratio("a", "b"))) == [(0.25,), (None,), (None,), (None,)]


def test_hash_bucket_ignores_partitioning(spark):
    df = spark.range(1000).selectExpr("cast(id as string) as k")
    one_way = df.repartition(3).select("k", recode.hash_bucket("k"))
    other = df.repartition(7).select("k", recode.hash_bucket("k"))
    assert sorted(tuples(one_way)) == sorted(tuples(other))
    assert {b for _, b in tuples(other)} == set(range(100))


def test_hash_bucket_over_several_columns_and_nulls(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None)], "x string, y string")
    buckets = [b for (b,) in tuples(df.select(recode.hash_bucket(["x", "y"], 10)))]
    assert all(0 <= b < 10 for b in buckets)
