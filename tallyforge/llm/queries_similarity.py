"""Queries over the whole ``documents`` table: near copies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyforge.llm.chosen_path import similarity_classes
from tallyforge.llm.registry import query
from tallyforge.llm.tables import table

OP5_SQL = r"""
with recursive dw as (
  select row_number() over () as r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
  from documents),
s as (
  select distinct r, unnest(list_transform(range(1, len(ws) - least(5, len(ws)) + 2),
    lambda i: array_to_string(ws[i:i + least(5, len(ws)) - 1], ' '))) as shingle
  from dw where len(ws) > 0),
n as (select r, count(*) as n from s group by r),
common as (
  select a.r as a, b.r as b, count(*) as c from s a join s b on a.shingle = b.shingle and a.r < b.r group by 1, 2),
link as (
  select a, b from common join n x on x.r = a join n y on y.r = b where c >= 0.8 * (x.n + y.n - c) - 1e-6),
both_ways as (select a, b from link union all select b, a from link),
reach(r, other) as (
  select r, r from dw union select reach.r, b from reach join both_ways on other = a),
class as (select reach.r, min(doc_id) as class_id from reach join dw on dw.r = other group by reach.r),
links as (select a as r, count(*)::bigint as n_links from both_ways group by a)
select doc_id, class_id, coalesce(n_links, 0) as n_links
from dw join class using (r) left join links using (r)
"""


@query(OP5_SQL)
def op5_chosen_path(spark: SparkSession, folder: str) -> DataFrame:
    """Class and number of links of every document: five words, similarity of 0.8 or more."""
    return similarity_classes(table(spark, folder, "documents")).drop("content")
