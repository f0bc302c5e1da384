import pytest

from tallyforge import staging
from tallyforge.sources.delimited import scan_csv, write_csv
from tallyforge.sources.tables import flows, table
from tallyforge.spec import FeatureSpec, connection_spec

from tests.conftest import tuples

TEXT = "duration,rate,class\n0,0.5,normal\n7,1.0,smurf\n,,\n"


@pytest.fixture
def csv(tmp_path):
    path = tmp_path / "records"
    path.write_text(TEXT)
    return str(path)


def test_inferred_types(spark, csv):
    df = scan_csv(spark, csv, infer_schema=True)
    assert df.dtypes == [("duration", "int"), ("rate", "double"), ("class", "string")]
    assert tuples(df) == [(0, 0.5, "normal"), (7, 1.0, "smurf"), (None, None, None)]


def test_declared_types_and_plain_text(spark, csv):
    df = scan_csv(spark, csv, schema="duration bigint, rate double, class string")
    assert df.dtypes[0] == ("duration", "bigint")
    assert df.count() == 3
    assert {t for _, t in scan_csv(spark, csv).dtypes} == {"string"}


def test_header_in_another_order_is_an_error(spark, csv):
    df = scan_csv(spark, csv, schema="rate double, duration bigint, class string")
    with pytest.raises(Exception):
        df.collect()


def test_schema_and_inference_exclude_each_other(spark, csv):
    with pytest.raises(ValueError):
        scan_csv(spark, csv, schema="a int", infer_schema=True)


def test_bad_fields_are_null_an_error_or_kept_as_text(spark, tmp_path):
    path = tmp_path / "bad"
    path.write_text("duration,rate\n1,0.5\nx,0.25\n")
    schema = "duration int, rate double"
    assert tuples(scan_csv(spark, str(path), schema=schema)) == [(1, 0.5), (None, 0.25)]
    with pytest.raises(Exception, match="(?i)malformed"):
        scan_csv(spark, str(path), schema=schema, fail_fast=True).collect()
    kept = scan_csv(spark, str(path), schema=schema, corrupt_column="bad")
    assert tuples(kept) == [(1, 0.5, None), (None, 0.25, "x,0.25")]
    with pytest.raises(ValueError):
        scan_csv(spark, str(path), corrupt_column="bad")


def test_csv_round_trip(spark, data, tmp_path):
    records = flows(spark, data)
    write_csv(records, str(tmp_path / "out"))
    back = scan_csv(spark, str(tmp_path / "out"), schema=records.schema)
    assert back.exceptAll(records).count() == 0 and back.count() == records.count()


def test_flows_shape(spark, data):
    records = flows(spark, data)
    assert records.count() == table(spark, data, "lineitem").count()
    assert {r["class"] for r in records.select("class").distinct().collect()} == {
        "normal",
        "neptune",
        "smurf",
        "satan",
    }


def test_spreading_keeps_the_rows_and_the_pruned_scan(spark, data):
    wide = flows(spark, data, spread=True)
    assert wide.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert wide.exceptAll(flows(spark, data)).count() == 0
    plan = wide.select("duration")._jdf.queryExecution().executedPlan().toString()
    assert "l_orderkey" not in plan.split("ReadSchema")[1]
    many = spark.range(100).repartition(50)
    assert staging.widen(many) is many


def test_staging_persists_without_a_shared_folder(spark, monkeypatch):
    monkeypatch.setattr(staging, "shared_folder", lambda _: None)
    with staging.staged(spark.range(5)) as df:
        assert df.storageLevel.useMemory
    assert not df.storageLevel.useMemory


def test_staging_writes_to_the_shared_folder_and_cleans_up(spark, shared):
    with staging.staged(spark.range(5), "numbers") as df:
        assert not df.storageLevel.useMemory and df.count() == 5
        assert [p.name[:8] for p in (shared / "tallyforge").iterdir()] == ["numbers-"]
    assert list((shared / "tallyforge").iterdir()) == []
    with pytest.raises(ZeroDivisionError):
        with staging.staged(spark.range(5)):
            1 / 0
    assert list((shared / "tallyforge").iterdir()) == []


def test_settled_tables_stand_alone(spark, shared):
    with staging.staged(spark.range(5)) as df:
        kept = staging.settle(df.groupBy().count())
    assert tuples(kept) == [(5,)]


def test_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def get(self, name, default=None):
            return {"spark.master": "yarn"}.get(name, default)

    class Session:
        conf = Conf()

    with pytest.raises(ValueError):
        staging.new_shared_path(Session(), "x")


def test_column_roles():
    spec = FeatureSpec(categorical=("a", "b"), label="y", excluded=("k",))
    columns = ["k", "n", "a", "m", "b", "y"]
    assert spec.numeric(columns) == ["n", "m"]
    assert spec.features(columns) == ["n", "a", "m", "b"]
    assert spec.without(["a"]).numeric(columns) == ["n", "m"]
    assert "is_host_login" in connection_spec(host_login=True).categorical
    assert "is_host_login" not in connection_spec().categorical


def test_headers_of_all_files_are_compared_also_with_a_corrupt_column(spark, tmp_path):
    for name, text in (("1", "duration,rate\n1,0.5\nx,0.25\n"), ("2", "duration,rate\n2,0.5\n")):
        (tmp_path / f"{name}.csv").write_text(text)
    schema = "duration int, rate double"
    kept = scan_csv(spark, str(tmp_path), schema=schema, corrupt_column="bad")
    assert sorted(tuples(kept), key=str) == [(1, 0.5, None), (2, 0.5, None), (None, 0.25, "x,0.25")]
    (tmp_path / "3.csv").write_text("rate,duration\n0.5,3\n")
    for column in ("duration", "rate"):
        with pytest.raises(Exception, match="(?i)header"):
            scan_csv(spark, str(tmp_path), schema=schema, corrupt_column="bad").select(column).collect()
