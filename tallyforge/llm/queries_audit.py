"""Query over the whole ``documents`` table: what five filters remove in every order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyforge.llm.registry import query
from tallyforge.llm.tables import table
from tallyforge.llm.text_tries import audit

OP11_SQL = r"""
with d as (
  select row_number() over () as r, doc_id, coalesce(source, '') as part, coalesce(text, '') as body from documents),
w as (select r, regexp_extract_all(body, '[^\x20\x09-\x0D]+') as ws from d),
marks as (
  select doc_id, max((coalesce(quality, 0) = 1)::int) as good, max((coalesce(toxic, 0) = 1)::int) as toxic
  from labels where doc_id is not null group by doc_id),
fails as (
  select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
    len(ws) < 50 as a, 100 * len(list_distinct(ws)) < 65 * len(ws) as b,
    100 * (length(body) - length(regexp_replace(body, '[A-Z]', '', 'g'))) > 5 * length(body) as c,
    regexp_matches(body, '[#$%&*|]') as d,
    coalesce(min(doc_id) over (partition by body) < doc_id, false) as e
  from d join w using (r) left join marks using (doc_id)),
masks as (
  select part, a::int + 2 * b::int + 4 * c::int + 8 * d::int + 16 * e::int as mask, count(*) as n,
    sum(good) as good, sum(toxic) as toxic
  from fails group by all),
f(letter, bit) as (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders as (
  select p.letter || q.letter || r.letter || s.letter || t.letter as filter_order, [p.bit, q.bit, r.bit, s.bit, t.bit] as bits
  from f p, f q, f r, f s, f t where p.bit + q.bit + r.bit + s.bit + t.bit = 31
    and len(list_distinct([p.bit, q.bit, r.bit, s.bit, t.bit])) = 5),
steps as (
  select filter_order, step, bits[step] as own, coalesce(list_sum(bits[1:step - 1]), 0)::int as earlier
  from orders, unnest(range(1, 6)) as u(step)),
parts as (select distinct part from masks),
removals as (
  select part, own, sum(n) as shapley from masks, steps
  where mask & own > 0 and mask & earlier = 0 group by part, own)
select part, filter_order, step::int as step,
  coalesce(sum(n) filter (mask & (own | earlier) = 0), 0)::bigint as kept,
  coalesce(sum(n) filter (mask & own > 0 and mask & earlier = 0), 0)::bigint as removed,
  coalesce(sum(n) filter (mask & own > 0 and mask & earlier > 0), 0)::bigint as redundant,
  coalesce(sum(n) filter (mask = own), 0)::bigint as unique_fails,
  coalesce(sum(good) filter (mask & own > 0 and mask & earlier = 0), 0)::bigint as good_lost,
  coalesce(sum(toxic) filter (mask & own > 0 and mask & earlier = 0), 0)::bigint as toxic_lost,
  coalesce(any_value(shapley), 0)::bigint as shapley
from masks join steps on true left join removals using (part, own)
group by part, filter_order, step
"""


@query(OP11_SQL)
def op11_trie_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Documents kept, removed and lost by five filters, per source, order and step."""
    return audit(table(spark, folder, "documents"), table(spark, folder, "labels"))
