"""Run catalogue queries next to their SQL oracles and compare rows, types and values."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
import pyarrow as pa

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def kind(t: pa.DataType) -> str:
    if pa.types.is_floating(t):
        return "float"
    if pa.types.is_integer(t):
        return f"int{t.bit_width}"
    if pa.types.is_string(t) or pa.types.is_large_string(t):
        return "text"
    return str(t)


def rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(zip(*columns), key=lambda r: tuple((v is None, str(v)) for v in r))


def same(a: object, b: object) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isclose(a, b, rel_tol=1e-9) or (a != a and b != b)
    return a == b


def difference(spark_table: pa.Table, sql_table: pa.Table) -> str | None:
    """What differs, or None."""
    got = {f.name: kind(f.type) for f in spark_table.schema}
    want = {f.name: kind(f.type) for f in sql_table.schema}
    if got != want:
        return f"schema {got} != {want}"
    left, right = rows(spark_table), rows(sql_table)
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)}"
    for a, b in zip(left, right):
        if not all(map(same, a, b)):
            return f"{a} != {b}"
    return None


def main(folder: str, names: list[str]) -> None:
    from pyspark.sql import SparkSession

    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as contract

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    oracles = contract.oracle_sql()
    bad = 0
    for name, run in contract.queries().items():
        if names and name not in names:
            continue
        start = time.perf_counter()
        try:
            result = run(spark, folder).toArrow()
            spent = time.perf_counter() - start
            if name in oracles:
                start = time.perf_counter()
                found = difference(result, con.sql(oracles[name]).to_arrow_table())
                sql = time.perf_counter() - start
                state = f"DIFF {found}" if found else f"ok (sql {sql:.1f}s)"
                bad += found is not None
            else:
                state = "rows only"
        except Exception as error:  # report and go on with the next query
            bad += 1
            spent, state = time.perf_counter() - start, f"FAIL {str(error)[:600]}"
            result = None
        print(f"{name:30s} {spent:6.1f}s {result.num_rows if result else 0:8d} {state}", flush=True)
        spark.catalog.clearCache()
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
