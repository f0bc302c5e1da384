"""The Parquet tables of a data folder and the connection records derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyforge.staging import widen

FLOW_KEY = "flow_key"

# One expression per column; the text is plain SQL so the same derivation runs on any engine.
FLOW_COLUMNS = {
    "flow_key": "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)",
    "protocol_type": (
        "case l_returnflag when 'A' then 'tcp' when 'N' then 'udp' else 'icmp' end"
    ),
    "service": "concat('svc', l_suppkey % 65)",
    "flag": (
        "case l_linenumber when 1 then 'SF' when 2 then 'S0' when 3 then 'S1' when 4 then 'REJ'"
        " when 5 then 'RSTO' when 6 then 'SH' else 'RSTR' end"
    ),
    "land": "cast(case when l_linestatus = 'O' then 1 else 0 end as int)",
    "logged_in": "cast(case when l_tax > 0.04 then 1 else 0 end as int)",
    "is_host_login": "cast(0 as int)",
    "is_guest_login": "cast(case when l_discount > 0.08 then 1 else 0 end as int)",
    "duration": "l_quantity",
    "src_bytes": "l_extendedprice",
    "serror_rate": "l_discount",
    "rerror_rate": "l_tax",
    "class": (
        "case when l_quantity > 25 and l_linestatus = 'O' then 'normal'"
        " when l_returnflag = 'A' then 'neptune' when l_returnflag = 'N' then 'smurf'"
        " else 'satan' end"
    ),
}
FLOWS_SELECT = ", ".join(f"{expr} as {name}" for name, expr in FLOW_COLUMNS.items())
FLOWS_SQL = f"select {FLOWS_SELECT} from lineitem"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def flows(spark: SparkSession, folder: str, spread: bool = False) -> DataFrame:
    """Connection records: one per line item, labelled by a fixed rule.

    ``spread`` evens out a file that has fewer splits than there are cores, which pays off before
    the many passes of a model fit.
    """
    lines = table(spark, folder, "lineitem")
    if spread:
        lines = widen(lines)
    return lines.selectExpr(*[f"{expr} as {name}" for name, expr in FLOW_COLUMNS.items()])
