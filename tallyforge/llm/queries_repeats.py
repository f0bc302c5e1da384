"""Queries over the whole ``documents`` table: repeated lines and repeated bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyforge.llm.line_runs import MIN_RUN_CHARS, NOT_BLANK, drop_repeated_lines
from tallyforge.llm.registry import query
from tallyforge.llm.repeat_intervals import remove_repeats
from tallyforge.llm.tables import table

LINE_CTES = rf"""
split_docs as (
  select row_number() over () as r, doc_id, text, coalesce(string_split(text, chr(10)), []) as all_lines from docs),
numbered as (
  select r, doc_id, text, all_lines,
    list_filter(all_lines, lambda x: regexp_matches(x, '{NOT_BLANK}')) as ls from split_docs),
places as (
  select r, doc_id, unnest(range(1, len(ls) + 1)) as i, unnest(ls) as line from numbered),
lines as (
  select r, i, line, md5(line) as k, dense_rank() over (order by doc_id, r) as doc_order,
    sum(length(line)) over (partition by r order by i) as upto from places),
-- Runs that occur more than once, grown by one line at a time.
runs(size, r, i, k, doc_order, earlier) as (
  select 1, r, i, k, doc_order, row_number() over (partition by k order by doc_order, i) > 1
  from (select *, count(*) over (partition by k) as n from lines) where n > 1
  union all
  select size, r, i, k, doc_order, row_number() over (partition by k order by doc_order, i) > 1
  from (
    select runs.size + 1 as size, runs.r, runs.i, md5(runs.k || lines.k) as k, runs.doc_order,
      count(*) over (partition by md5(runs.k || lines.k)) as n
    from runs join lines on lines.r = runs.r and lines.i = runs.i + runs.size)
  where n > 1),
later as (
  select runs.r, runs.size, runs.i
  from runs join lines a on a.r = runs.r and a.i = runs.i join lines z on z.r = runs.r and z.i = runs.i + runs.size - 1
  where runs.earlier and z.upto - a.upto + length(a.line) >= {MIN_RUN_CHARS}),
gone as (
  select r, list(distinct spot) as gone, max(size)::bigint as longest_run
  from (select r, size, unnest(range(i, i + size)) as spot from later) group by r),
flags as (
  select r, gone, longest_run,
    list_transform(all_lines, lambda x, j: case
      when not regexp_matches(x, '{NOT_BLANK}') then true
      else not list_contains(gone, len(list_filter(all_lines[1:j], lambda y: regexp_matches(y, '{NOT_BLANK}')))) end
    ) as stays, all_lines
  from numbered join gone using (r)),
cut as (
  select r, longest_run, len(gone)::bigint as n_removed,
    coalesce(array_to_string(list_transform(list_filter(list_zip(all_lines, stays), lambda z: z[2]), lambda z: z[1]), chr(10)), '')
      as kept_text
  from flags),
deduped as (
  select numbered.r, doc_id, len(ls)::bigint as n_lines, coalesce(n_removed, 0) as n_removed,
    coalesce(longest_run, 0) as longest_run, case when cut.r is null then text else kept_text end as kept_text
  from numbered left join cut using (r))"""


@query(
    f"""with recursive docs as (select * from documents), {LINE_CTES}
    select doc_id, n_lines, n_removed, longest_run, sha256(kept_text) as kept_sha256 from deduped"""
)
def op10_line_suffix_array(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of every document, those deleted as later copies, and a digest of what stays."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    lines = F.size(F.filter(F.split("text", "\n"), lambda x: x.rlike(NOT_BLANK)))
    counted = docs.withColumn("n_lines", F.when(F.col("text").isNull(), 0).otherwise(lines).cast("long"))
    return drop_repeated_lines(counted).select(
        "doc_id", "n_lines", "n_removed", "longest_run", F.sha2("text", 256).alias("kept_sha256")
    )


@query()
def op7_repeat_intervals(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes of every document that lie in a string of 50 bytes of a document with a smaller id."""
    cut = remove_repeats(table(spark, folder, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return cut.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
