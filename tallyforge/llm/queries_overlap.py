"""Queries over the whole ``documents`` table: benchmark passages and licence templates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyforge.llm.license_scan import CONTAINED, TEMPLATES, scan
from tallyforge.llm.registry import query
from tallyforge.llm.tables import table
from tallyforge.llm.winnowing import contaminated, contamination

CONTAMINATION_CTES = r"""
dw as (
  select row_number() over () as r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
  from documents),
iw as (
  select item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
  from benchmark),
iwin as (
  select distinct item_id, least(13, len(ws)) as size,
    unnest(list_transform(range(1, len(ws) - least(13, len(ws)) + 2),
      lambda i: array_to_string(ws[i:i + least(13, len(ws)) - 1], ' '))) as win
  from iw where len(ws) > 0),
sizes as (select distinct size from iwin),
dpos as (
  select r, size, unnest(range(1, len(ws) - size + 2)) as i, ws from dw, sizes where len(ws) >= size),
dwin as (select r, size, i, array_to_string(ws[i:i + size - 1], ' ') as win from dpos),
found as (select distinct r, i, dwin.size, item_id from dwin join iwin using (win) where dwin.size = iwin.size),
hit as (
  select r, count(distinct i + k)::bigint as n_hit
  from (select r, i, unnest(range(0, size)) as k from (select distinct r, i, size from found)) group by r),
items as (
  select r, count(distinct item_id)::bigint as n_items,
    array_to_string(list_sort(list_distinct(list(coalesce(item_id::varchar, '')))), ',') as ids
  from found group by r),
contamination as (
  select r, doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(ids, '')) as items_sha256,
    coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(ws) as contaminated
  from dw left join hit using (r) left join items using (r))"""


@query(
    f"""with {CONTAMINATION_CTES}
    select doc_id, n_words, n_hit, n_items, items_sha256, contaminated from contamination"""
)
def op3_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that lie in a window of a benchmark item."""
    found = contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


_quoted = lambda text: "'" + text.replace("'", "''") + "'"
TEMPLATE_VALUES = ", ".join(f"({_quoted(n)}, {_quoted(t)})" for n, t in TEMPLATES)
OP9_SQL = rf"""
with templates(name, body) as (values {TEMPLATE_VALUES}),
tw as (
  select name, regexp_extract_all(lower(body), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from templates),
ts as (
  select distinct name, unnest(list_transform(range(1, len(ws) - 1),
    lambda i: array_to_string(ws[i:i + 2], ' '))) as shingle
  from tw),
n as (select name, count(*) as n from ts group by name),
dw as (
  select row_number() over () as r, doc_id,
    regexp_extract_all(lower(coalesce(text, '')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
  from documents),
ds as (
  select distinct r, unnest(list_transform(range(1, len(ws) - 1),
    lambda i: array_to_string(ws[i:i + 2], ' '))) as shingle
  from dw where len(ws) > 2),
held as (
  select r, name from ds join ts using (shingle) join n using (name)
  group by r, name, n having count(*) >= {CONTAINED} * n),
per as (select r, list_sort(list(name)) as names from held group by r)
select doc_id, coalesce(array_to_string(names, ','), '') as licenses, coalesce(len(names), 0)::bigint as n_licenses
from dw left join per using (r)
"""


@query(OP9_SQL)
def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The licence templates that every document contains."""
    found = scan(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        F.array_join("licenses", ",").alias("licenses"),
        F.size("licenses").cast("long").alias("n_licenses"),
    )
