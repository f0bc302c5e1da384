"""Catalogue: category numbering, one-hot vectors, assembly and their relatives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyforge.operators import features as ft
from tallyforge.operators.dictionaries import fit_dictionaries
from tallyforge.plans.registry import query
from tallyforge.plans.shared import (
    FLOWS,
    GUESS,
    NUMERIC,
    SPEC,
    binary_flows,
    encoded_flows,
    long_values,
    ranks,
)
from tallyforge.sources.tables import FLOW_KEY, flows, table
from tallyforge.spec import ATTACK, NORMAL, FeatureSpec
from tallyforge.staging import new_shared_path

CATEGORICAL = SPEC.categorical
TEXT = ("protocol_type", "service", "flag")


def _numeric_entries(columns: tuple[str, ...], start: int) -> str:
    return " union all ".join(
        f"select flow_key, {start + i}::int as pos, {c}::double as value from flows where {c} <> 0"
        for i, c in enumerate(columns)
    )


def _offsets(columns: tuple[str, ...], start: int, width: str) -> str:
    """SQL CTE with the first slot of every column, in the order given."""
    order = ", ".join(f"('{c}', {i})" for i, c in enumerate(columns))
    return f"""sizes as (
  select name, ord, {width} as width from (values {order}) o(name, ord)
  join (select name, count(*) as n from ranks group by name) using (name)),
offsets as (
  select name, width, {start} + coalesce(sum(width) over (
    order by ord rows between unbounded preceding and 1 preceding), 0) as start from sizes)"""


ONEHOT = f"""{_numeric_entries(NUMERIC, 0)}
union all select flow_key, (start + idx)::int, 1.0::double
  from long_values join ranks using (name, value) join offsets using (name) where idx < width"""

ORDINAL = f"""{_numeric_entries(NUMERIC, 0)}
union all select flow_key, start::int, idx::double
  from long_values join ranks using (name, value) join offsets using (name) where idx > 0"""


@query(
    f"""with {FLOWS}, {ranks([*CATEGORICAL, "class"])}
select name, value, idx::int as idx from ranks"""
)
def string_index_labels(spark: SparkSession, folder: str) -> DataFrame:
    columns = [*CATEGORICAL, "class"]
    found = fit_dictionaries(flows(spark, folder), columns)
    rows = [(c, v, i) for c in columns for i, v in enumerate(found.labels(c))]
    return spark.createDataFrame(rows, "name string, value string, idx int")


_indexed = ", ".join(f"r_{c}.idx::double as {c}_index" for c in CATEGORICAL)
_joined = " ".join(
    f"join ranks r_{c} on r_{c}.name = '{c}' and r_{c}.value = f.{c}::varchar" for c in CATEGORICAL
)


@query(
    f"with {FLOWS}, {ranks(CATEGORICAL)} select flow_key, {_indexed} from flows f {_joined}"
)
def string_index_rows(spark: SparkSession, folder: str) -> DataFrame:
    out = ft.string_index(flows(spark, folder), CATEGORICAL)
    return out.select(FLOW_KEY, *[ft.index_name(c) for c in CATEGORICAL])


@query(
    """with counted as (
  select l_orderkey, row_number() over (order by count(*) desc, l_orderkey::varchar) - 1 as idx
  from lineitem group by l_orderkey)
select l_orderkey, l_linenumber, idx::double as l_orderkey_index
from lineitem join counted using (l_orderkey)"""
)
def string_index_many_values(spark: SparkSession, folder: str) -> DataFrame:
    """Numbering a column whose dictionary exceeds the bound set for broadcasting."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    return ft.string_index(lines, ["l_orderkey"], max_size=1000)


@query(
    f"""with {FLOWS}, {ranks(["class"])} select flow_key, class, idx::double as label
from flows f join ranks r on r.value = f.class"""
)
def label_index(spark: SparkSession, folder: str) -> DataFrame:
    return ft.label_index(flows(spark, folder), "class").select(FLOW_KEY, "class", "label")


@query(
    f"""with {FLOWS}, {ranks(["service"])} select flow_key, service, idx::double as label
from flows f join ranks r on r.value = f.service"""
)
def label_index_many_classes(spark: SparkSession, folder: str) -> DataFrame:
    """Numbering a label with more classes than are collected."""
    return ft.label_index(flows(spark, folder), "service", max_size=7).select(FLOW_KEY, "service", "label")


@query(
    """with orders_counted as (
  select l_orderkey, row_number() over (order by count(*) desc, l_orderkey::varchar) - 1 as idx
  from lineitem group by l_orderkey),
parts_counted as (
  select l_partkey, row_number() over (order by count(*) desc, l_partkey::varchar) - 1 as idx
  from lineitem group by l_partkey)
select l_orderkey, l_linenumber, l_partkey, o.idx::double as l_orderkey_index,
  p.idx::double as l_partkey_index
from lineitem join orders_counted o using (l_orderkey) join parts_counted p using (l_partkey)"""
)
def string_index_two_large(spark: SparkSession, folder: str) -> DataFrame:
    """Two columns whose dictionaries both exceed the bound: the table is still read once."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return ft.string_index(lines, ["l_orderkey", "l_partkey"], max_size=100)


@query(
    f"""with {FLOWS}, {ranks(["flag"])} select flow_key, idx::int as pos, 1.0::double as value
from flows f join ranks r on r.value = f.flag where idx < (select count(*) - 1 from ranks)"""
)
def one_hot_rows(spark: SparkSession, folder: str) -> DataFrame:
    indexed = ft.string_index(flows(spark, folder), ["flag"])
    return ft.vector_entries(ft.one_hot(indexed, ["flag"]), [FLOW_KEY], ft.onehot_name("flag"))


@query(
    f"""with {FLOWS}, {ranks(CATEGORICAL)}, {_offsets(CATEGORICAL, len(NUMERIC), "n - 1")} {ONEHOT}"""
)
def assembled_onehot(spark: SparkSession, folder: str) -> DataFrame:
    return ft.vector_entries(encoded_flows(spark, folder, "onehot")[1], [FLOW_KEY])


@query(f"""with {FLOWS}, {ranks(CATEGORICAL)}, {_offsets(CATEGORICAL, len(NUMERIC), "1")} {ORDINAL}""")
def assembled_ordinal(spark: SparkSession, folder: str) -> DataFrame:
    return ft.vector_entries(encoded_flows(spark, folder, "ordinal")[1], [FLOW_KEY])


# Services learned from a part of the records; the others are unseen when all are encoded.
KNOWN = "service < 'svc4'"
SERVICE_SPEC = FeatureSpec(categorical=("service",), excluded=(FLOW_KEY,))
KNOWN_RANKS = f"""known as (
  select service as value, row_number() over (order by count(*) desc, service) - 1 as idx
  from flows where {KNOWN} group by service)"""
UNSEEN_ONEHOT = f"""with {FLOWS}, {KNOWN_RANKS}
{_numeric_entries(NUMERIC, 0)}
union all select flow_key, ({len(NUMERIC)} + idx)::int, 1.0::double from flows join known on value = service"""
UNSEEN_ORDINAL = f"""with {FLOWS}, {KNOWN_RANKS}, placed as (
  select flow_key, coalesce(idx, (select count(*) from known))::double as value
  from flows left join known on known.value = service)
{_numeric_entries(NUMERIC, 0)}
union all select flow_key, {len(NUMERIC)}::int, value from placed where value <> 0"""


def _with_unseen(spark: SparkSession, folder: str, encoding: str, max_size: int, saved: bool = False) -> DataFrame:
    records = flows(spark, folder).select(FLOW_KEY, "service", *NUMERIC)
    model = ft.fit_features(
        records.where(KNOWN), SERVICE_SPEC, encoding, handle_invalid="keep", index_label=False, max_size=max_size
    )
    if saved:
        model = ft.load_features(spark, ft.save_features(model, spark, new_shared_path(spark, "features")))
    return ft.vector_entries(model.transform(records, with_label=False), [FLOW_KEY])


@query(UNSEEN_ONEHOT)
def onehot_unseen(spark: SparkSession, folder: str) -> DataFrame:
    """Unseen services get an all-zero block."""
    return _with_unseen(spark, folder, "onehot", 1000)


@query(UNSEEN_ONEHOT)
def onehot_unseen_large(spark: SparkSession, folder: str) -> DataFrame:
    """The same with a dictionary that is joined."""
    return _with_unseen(spark, folder, "onehot", 7)


@query(UNSEEN_ORDINAL)
def ordinal_unseen(spark: SparkSession, folder: str) -> DataFrame:
    """Unseen services share one more category."""
    return _with_unseen(spark, folder, "ordinal", 1000)


@query(UNSEEN_ORDINAL)
def ordinal_unseen_large(spark: SparkSession, folder: str) -> DataFrame:
    return _with_unseen(spark, folder, "ordinal", 7)


@query(UNSEEN_ONEHOT)
def features_roundtrip_large(spark: SparkSession, folder: str) -> DataFrame:
    """An encoding with a joined dictionary, saved and read back."""
    return _with_unseen(spark, folder, "onehot", 7, saved=True)


_formula_numeric = ("land", "logged_in", "is_guest_login", *NUMERIC)
FORMULA = f"""with {FLOWS}, {ranks(TEXT)}, {_offsets(TEXT, 0, "n - 1")},
numeric_entries as ({_numeric_entries(_formula_numeric, 0)})
select flow_key, (start + idx)::int as pos, 1.0::double as value
  from long_values join ranks using (name, value) join offsets using (name) where idx < width
union all
select flow_key, (pos + (select sum(width) from sizes))::int, value from numeric_entries"""


@query(FORMULA)
def formula_features(spark: SparkSession, folder: str) -> DataFrame:
    return ft.vector_entries(encoded_flows(spark, folder, "formula")[1], [FLOW_KEY])


@query(FORMULA)
def formula_features_mllib(spark: SparkSession, folder: str) -> DataFrame:
    """The same vectors from MLlib's formula transformer."""
    data = binary_flows(spark, folder).drop("is_host_login")
    model = ft.fit_formula(data, "class", [FLOW_KEY])
    return ft.vector_entries(model.transform(data), [FLOW_KEY])


_slots = " union all ".join(
    [f"select {i} as pos, {c}::double as value from flows" for i, c in enumerate(NUMERIC)]
    + [
        f"select {len(NUMERIC) + i}, idx::double from flows f "
        f"join ranks r on r.name = '{c}' and r.value = f.{c}::varchar"
        for i, c in enumerate(CATEGORICAL)
    ]
)


@query(
    f"""with {FLOWS}, {ranks(CATEGORICAL)}, slot_values as (select distinct pos, value from ({_slots})),
few as (select pos from slot_values group by pos having count(*) <= 4)
select pos::int as pos, value,
  (row_number() over (partition by pos order by value <> 0, value) - 1)::int as idx
from slot_values join few using (pos)"""
)
def vector_index_map(spark: SparkSession, folder: str) -> DataFrame:
    rows = encoded_flows(spark, folder, "ordinal")[1]
    return ft.vector_index_map(rows, ft.fit_vector_index(rows))


@query(
    f"""with {FLOWS}, {ranks(["class"])}, labelled as (
  select idx::double as label, count(*) as n from flows f join ranks r on r.value = f.class group by 1)
select label, n, (row_number() over (order by n desc, label::varchar) - 1)::double as "indexedLabel"
from labelled"""
)
def label_reindex(spark: SparkSession, folder: str) -> DataFrame:
    records = flows(spark, folder)
    labelled = fit_dictionaries(records, ["class"]).indexer("class", "label").transform(records)
    model = ft.fit_label_reindex(labelled)
    counted = labelled.groupBy("label").agg(F.count("*").alias("n"))
    return model.transform(counted).select("label", "n", "indexedLabel")


@query(
    f"""with {FLOWS}
select flow_key, case when {GUESS} then 'normal' else 'attack' end as decoded from flows"""
)
def decoded_predictions(spark: SparkSession, folder: str) -> DataFrame:
    guess = F.when(F.expr(GUESS), F.lit(1.0)).otherwise(F.lit(0.0))
    rows = flows(spark, folder).withColumn("prediction", guess)
    return ft.decode_labels(rows, [ATTACK, NORMAL]).select(FLOW_KEY, "decoded")


_moments = " union all ".join(
    f"select {i}::int as pos, round(avg(value), 3) as mean, round(stddev_samp(value), 3) as std "
    f"from (select {c}::double as value from flows)"
    for i, c in enumerate(NUMERIC)
)


@query(f"with {FLOWS} {_moments}")
def scale_features(spark: SparkSession, folder: str) -> DataFrame:
    """Mean and deviation the scaler learned for the numeric slots."""
    rows = encoded_flows(spark, folder, "ordinal")[1]
    model = ft.fit_scaler(rows)
    values = zip(model.mean.toArray()[: len(NUMERIC)], model.std.toArray())
    learned = [(i, round(float(m), 3), round(float(s), 3)) for i, (m, s) in enumerate(values)]
    return spark.createDataFrame(learned, "pos int, mean double, std double")
