"""Catalogue: scans, recodes, projections, filters, counts and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyforge.functions.recode import (
    class_binarize as binarize,
    class_to_numeric as to_numeric,
    flag_code as flag_to_code,
    hash_bucket,
    protocol_code as protocol_to_code,
    ratio,
)
from tallyforge.operators import relational
from tallyforge.operators.metrics import agreement, metric_table as as_metric_table
from tallyforge.operators.split import in_training, part_number, random_split
from tallyforge.plans.registry import query
from tallyforge.plans.shared import FLOWS, IN_TRAINING, SCORED, scored_flows
from tallyforge.sources.delimited import scan_csv, write_csv
from tallyforge.sources.tables import FLOW_COLUMNS, FLOW_KEY, flows, table
from tallyforge.staging import new_shared_path


@query("select p_partkey::int as p_partkey, p_name, p_brand, p_type, p_size, p_retailprice from part")
def csv_scan_inferred(spark: SparkSession, folder: str) -> DataFrame:
    path = new_shared_path(spark, "part-csv")
    write_csv(table(spark, folder, "part"), path)
    return scan_csv(spark, path, infer_schema=True)


@query(f"with {FLOWS} select * from flows")
def csv_scan_declared(spark: SparkSession, folder: str) -> DataFrame:
    records = flows(spark, folder)
    path = new_shared_path(spark, "flows-csv")
    write_csv(records, path)
    return scan_csv(spark, path, schema=records.schema)


@query(f"with {FLOWS} select * from flows order by flow_key, src_bytes, duration limit 10")
def preview_rows(spark: SparkSession, folder: str) -> DataFrame:
    return relational.preview(flows(spark, folder), 10, [FLOW_KEY, "src_bytes", "duration"])


@query("select count(*) as n_rows from lineitem")
def row_count(spark: SparkSession, folder: str) -> DataFrame:
    return flows(spark, folder).agg(F.count("*").alias("n_rows"))


@query(
    f"""with {FLOWS} select count(*) as n_rows,
  count(*) filter ({IN_TRAINING}) as n_train,
  count(*) filter (not ({IN_TRAINING})) as n_test from flows"""
)
def split_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return relational.split_sizes(flows(spark, folder), in_training(FLOW_KEY))


@query(
    f"""with {FLOWS} select flow_key, class, {IN_TRAINING} as train from flows"""
)
def hash_split_rows(spark: SparkSession, folder: str) -> DataFrame:
    return flows(spark, folder).select(FLOW_KEY, "class", in_training(FLOW_KEY).alias("train"))


THREE_PARTS = (0.6, 0.2, 0.2)
_BUCKET = "('0x' || substr(md5(flow_key), 1, 8))::bigint % 100"


@query(
    f"""with {FLOWS} select flow_key,
  case when {_BUCKET} < 60 then 0 when {_BUCKET} < 80 then 1 else 2 end::int as part from flows"""
)
def hash_split_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Training, validation and test part of every row, in one scan."""
    return flows(spark, folder).select(FLOW_KEY, part_number(FLOW_KEY, THREE_PARTS).alias("part"))


@query(
    """select count(*) as n_rows, true as every_row_once, true as share_as_asked from lineitem"""
)
def random_split_invariants(spark: SparkSession, folder: str) -> DataFrame:
    """Parts of a random split add up to the table, row contents included."""
    records = flows(spark, folder)
    parts = random_split(records, seed=3)

    def fingerprint(df: DataFrame, part: int) -> DataFrame:
        content = F.xxhash64(*df.columns).cast("decimal(38,0)")
        return df.agg(F.count("*").alias("n"), F.sum(content).alias("content")).withColumn(
            "part", F.lit(part)
        )

    sums = fingerprint(records, 0)
    for i, part in enumerate(parts, start=1):
        sums = sums.unionByName(fingerprint(part, i))

    def of(measure: str, which: F.Column) -> F.Column:
        return F.sum(F.when(which, F.col(measure)))

    whole, pieces = F.col("part") == 0, F.col("part") > 0
    return sums.agg(
        of("n", whole).alias("n_rows"),
        ((of("n", whole) == of("n", pieces)) & (of("content", whole) == of("content", pieces))).alias(
            "every_row_once"
        ),
        F.abs(ratio(of("n", F.col("part") == 1), of("n", whole)) - 0.7)
        .between(0.0, 0.02)
        .alias("share_as_asked"),
    )


@query(
    f"""with {FLOWS} select flow_key,
  case when class <> 'normal' then 'attack' else class end as class from flows"""
)
def class_binarize(spark: SparkSession, folder: str) -> DataFrame:
    return flows(spark, folder).select(FLOW_KEY, binarize("class").alias("class"))


@query(
    f"""with {FLOWS} select flow_key,
  (case when class <> 'normal' then 0.0 else 1.0 end)::double as class from flows"""
)
def class_to_numeric(spark: SparkSession, folder: str) -> DataFrame:
    return flows(spark, folder).select(FLOW_KEY, to_numeric("class").alias("class"))


@query(
    f"""with {FLOWS} select flow_key,
  (case protocol_type when 'tcp' then 0 when 'udp' then 1 else 2 end)::int as protocol_type
  from flows"""
)
def protocol_code(spark: SparkSession, folder: str) -> DataFrame:
    return flows(spark, folder).select(
        FLOW_KEY, protocol_to_code("protocol_type").alias("protocol_type")
    )


@query(
    f"""with {FLOWS} select flow_key,
  (case flag when 'SF' then 0 when 'S0' then 1 when 'S1' then 2 when 'S2' then 3 when 'S3' then 4
     when 'SH' then 5 when 'OTH' then 6 when 'REJ' then 7 when 'RSTO' then 8 when 'RSTOS0' then 9
     else 10 end)::int as flag from flows"""
)
def flag_code(spark: SparkSession, folder: str) -> DataFrame:
    return flows(spark, folder).select(FLOW_KEY, flag_to_code("flag").alias("flag"))


@query(f"with {FLOWS} select * exclude (is_host_login, service) from flows")
def drop_columns(spark: SparkSession, folder: str) -> DataFrame:
    return relational.drop_columns(flows(spark, folder), ["is_host_login", "service"])


@query(f"with {FLOWS} select flow_key, class, duration from flows")
def project(spark: SparkSession, folder: str) -> DataFrame:
    return relational.project(flows(spark, folder), [FLOW_KEY, "class", "duration"])


@query(
    f"with {FLOWS} "
    + " union all ".join(
        f"select '{c}' as name from flows having count(distinct {c}) <= 1" for c in FLOW_COLUMNS
    )
)
def constant_columns(spark: SparkSession, folder: str) -> DataFrame:
    records = flows(spark, folder)
    names = relational.constant_columns(records, records.columns)
    return spark.createDataFrame([(n,) for n in names], "name string")


@query(f"with {FLOWS}, {SCORED} select flow_key, prediction, truth from scored where prediction = truth")
def matching_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = scored_flows(spark, folder).select(FLOW_KEY, "prediction", "truth")
    return relational.matching(rows, "prediction", "truth")


@query(f"with {FLOWS}, {SCORED} select flow_key, prediction, truth from scored where prediction <> truth")
def mismatching_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = scored_flows(spark, folder).select(FLOW_KEY, "prediction", "truth")
    return relational.mismatching(rows, "prediction", "truth")


@query(
    f"""with {FLOWS}, {SCORED} select flow_key, prediction, truth from scored
  where prediction = 1.0 and truth = 0.0"""
)
def false_positive_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = scored_flows(spark, folder).select(FLOW_KEY, "prediction", "truth")
    return relational.where_equal(rows, prediction=1.0, truth=0.0)


@query(
    f"""with {FLOWS}, {SCORED} select count(*) filter (prediction = 1.0) as said_yes,
  count(*) filter (prediction = 0.0) as said_no,
  round(count(*) filter (prediction = 1.0)::double / count(*), 6) as yes_share from scored"""
)
def predicted_counts(spark: SparkSession, folder: str) -> DataFrame:
    yes = F.count_if(F.col("prediction") == 1.0)
    return scored_flows(spark, folder).agg(
        yes.alias("said_yes"),
        F.count_if(F.col("prediction") == 0.0).alias("said_no"),
        F.round(ratio(yes, F.count("*")), 6).alias("yes_share"),
    )


@query(f"with {FLOWS} select class, count(*) as n from flows group by class")
def class_counts(spark: SparkSession, folder: str) -> DataFrame:
    return relational.value_counts(flows(spark, folder), "class")


@query(f"with {FLOWS} select count(*) as n_groups from (select distinct class from flows)")
def class_cardinality(spark: SparkSession, folder: str) -> DataFrame:
    return relational.group_cardinality(flows(spark, folder), "class")


@query(f"with {FLOWS} select count(distinct class) as n_distinct from flows")
def class_count_distinct(spark: SparkSession, folder: str) -> DataFrame:
    return relational.count_distinct(flows(spark, folder), "class")


@query(
    f"""with {FLOWS} select protocol_type, count(distinct service) as n_distinct from flows group by protocol_type
union all select null, count(distinct service) from flows"""
)
def service_count_sketched(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct services per protocol in five parts of the table, from stored sketches that are added up.

    So few values are counted without error.
    """
    parts = flows(spark, folder).withColumn("part", hash_bucket(FLOW_KEY, 5))
    path = new_shared_path(spark, "sketches")
    relational.distinct_sketches(parts, "service", "part", "protocol_type").write.parquet(path)
    stored = spark.read.parquet(path)
    per_protocol = relational.sketched_distinct(relational.merge_sketches(stored, "protocol_type"))
    every = relational.sketched_distinct(relational.merge_sketches(stored))
    return per_protocol.unionByName(every.withColumn("protocol_type", F.lit(None).cast("string")))


@query(
    f"""with {FLOWS} select count(distinct flow_key) as n_exact, true as within_five_percent from flows"""
)
def key_count_sketched(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct keys, far more than a sketch has registers: the estimate is off by three standard errors at most."""
    records = flows(spark, folder)
    exact = records.agg(F.count_distinct(FLOW_KEY).alias("n_exact"))
    found = relational.sketched_distinct(relational.distinct_sketches(records, FLOW_KEY))
    both = exact.unionByName(found, allowMissingColumns=True).agg(
        F.max("n_exact").alias("n_exact"), F.max("n_distinct").alias("n_distinct")
    )
    close = F.abs(F.col("n_distinct") - F.col("n_exact")) <= 0.05 * F.col("n_exact")
    return both.select("n_exact", close.alias("within_five_percent"))


@query(f"with {FLOWS} select distinct flag from flows")
def distinct_flags(spark: SparkSession, folder: str) -> DataFrame:
    return relational.distinct_values(flows(spark, folder), "flag")


@query(
    f"""with {FLOWS}, {SCORED}, sums as (
  select count(*) as total, count(*) filter (prediction = truth) as correct,
    count(*) filter (prediction <> truth) as incorrect from scored)
select 'total' as metric, total::double as value from sums
union all select 'correct', correct::double from sums
union all select 'incorrect', incorrect::double from sums
union all select 'ratio_correct', round(correct::double / total, 6) from sums
union all select 'ratio_incorrect', round(incorrect::double / total, 6) from sums"""
)
def metric_table(spark: SparkSession, folder: str) -> DataFrame:
    """Measures written to a table and read back."""
    counts = relational.contingency(scored_flows(spark, folder), truth="truth")
    path = new_shared_path(spark, "metrics")
    as_metric_table(agreement(counts)).write.parquet(path)
    stored = spark.read.schema("metric string, value double").parquet(path)
    return stored.select("metric", F.round("value", 6).alias("value"))
