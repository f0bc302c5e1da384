"""Query over the whole ``documents`` table: host-level quality rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyforge.llm.host_rules import judge
from tallyforge.llm.registry import query
from tallyforge.llm.tables import table

OP6_SQL = r"""
with d as (select doc_id, source, coalesce(text, '') as body, row_number() over () as r from documents),
w as (
  select r, unnest(ws) as word, generate_subscripts(ws, 1) as i
  from (select r, regexp_extract_all(body, '[^\x20\x09-\x0D]+') as ws from d)),
t as (
  select r, i, word as a, lead(word) over o as b, lead(word, 2) over o as c
  from w window o as (partition by r order by i)),
twice as (
  select r, i, count(*) over (partition by r, a, b, c) as n from t where b is not null and c is not null),
hit as (
  select r, count(distinct i + k) as n from twice, (values (0), (1), (2)) as v(k) where n > 1 group by r),
word_counts as (select r, count(*) as n, sum(length(word)) as chars from w group by r),
counts as (
  select d.r, doc_id, source, coalesce(word_counts.n, 0)::bigint as n_words,
    coalesce(chars, 0)::bigint as word_chars,
    (length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
    (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines,
    coalesce(hit.n, 0)::bigint as n_repeat_words
  from (select *, list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls
        from d) d
  left join word_counts using (r) left join hit using (r)),
base as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from counts),
hosts as (
  select source, count(*) as host_docs, sum(base_failed::int)::bigint as host_failed
  from base where source is not null group by source),
prior as (
  select avg(p) as m, var_pop(p) - avg(p * (1 - p) / host_docs) as v
  from (select *, host_failed / host_docs as p from hosts)),
rates as (
  select source, host_docs, host_failed,
    case when v > 0 then (host_failed + greatest(m * (1 - m) / v - 1, 0) * m)
      / (host_docs + greatest(m * (1 - m) / v - 1, 0)) else m end as rate
  from hosts, prior)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not coalesce(rate > 0.5, false) as kept, host_docs, host_failed, round(rate, 6) as host_rate
from base left join rates using (source)
"""


@query(OP6_SQL)
def op6_host_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts and verdicts of all documents, and the verdict after looking at their hosts."""
    judged = judge(table(spark, folder, "documents"))
    return judged.withColumn("host_rate", F.round("host_rate", 6))
