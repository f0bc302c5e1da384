"""Query over the whole ``documents`` table: secrets and who holds them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyforge.llm.registry import query
from tallyforge.llm.secret_owners import LIVE_CHARS, MOST_OWNERS, find_secrets, listed, of_base
from tallyforge.llm.tables import table

_KEYWORDS = "|".join(
    "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)
    for word in ("password", "passwd", "secret", "token", "api_?key")
)
_PATTERNS = {
    "assign": rf"""(?:{_KEYWORDS})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""",
    "access": "AKIA[A-Z0-9]+",
    "hex": "[0-9a-f]+",
    "url": "[A-Za-z][A-Za-z0-9+.-]*://[A-Za-z0-9_.-]+:([A-Za-z0-9+_.=!$-]+)@",
    "bare": "[A-Za-z0-9+/_-]+",
}


def _matches(listed_at: int, kind: str, keep: str) -> str:
    """All matches of one kind: gaps between them give their places."""
    pattern, group = _PATTERNS[kind], 1 if "([" in _PATTERNS[kind] else 0
    # In an address only the password is the span; the part behind it is one character.
    begin, end = ("stop - 1 - length(val)", "stop - 1") if kind == "url" else ("stop - length(whole)", "stop")
    return f"""
  select r, {listed_at} as listed, '{kind}' as kind, {begin} as s, {end} as e, val
  from (
    select r, whole, val, sum(length(gap) + length(whole)) over (partition by r order by i) as stop
    from (
      select r, unnest(string_split_regex(body, '{pattern}')) as gap, unnest(regexp_extract_all(body, '{pattern}', 0)) as whole,
        unnest(regexp_extract_all(body, '{pattern}', {group})) as val,
        unnest(range(1, len(string_split_regex(body, '{pattern}')) + 1)) as i
      from d where regexp_matches(body, '{pattern}')))
  where whole is not null and {keep}"""


OP12_SQL = f"""
with d as (
  select row_number() over () as r, doc_id, coalesce(text, '') as body, coalesce(source, '') as repository,
    regexp_replace(coalesce(source, ''), '/[^/]*$', '') as owner
  from documents),
base as (
  {_matches(0, "assign", "length(val) >= 12")} union all {_matches(1, "access", "length(whole) >= 18")}
  union all {_matches(2, "hex", "length(whole) >= 16")}),
loose as (
  {_matches(3, "url", "length(val) >= 8")}
  union all {_matches(4, "bare", '''length(whole) >= 20 and length(regexp_replace(val, '[^0-9]', '', 'g')) >= 2
    and regexp_matches(val, '[a-z]') and regexp_matches(val, '[A-Z]') and len(list_distinct(string_split(val, ''))) >= 10''')}),
free as (
  select * from loose where not exists (select 1 from base where base.r = loose.r and base.s < loose.e and base.e > loose.s)),
single as (
  select * from free f where not exists (
    select 1 from free g where g.r = f.r and (g.e, g.listed) < (f.e, f.listed) and g.e > f.s)),
spans as (select * from base union all select * from single),
held as (
  select val, count(distinct owner) as owners, count(distinct repository) as repositories
  from spans join d using (r) group by val),
judged as (
  select spans.*, case when owners > {MOST_OWNERS} then 'copied'
      when len(list_distinct(string_split(val, ''))) >= {LIVE_CHARS}
        and not regexp_matches(lower(val), 'example|sample|dummy|changeme|placeholder|xxxx') then 'live'
      else 'plain' end as verdict
  from spans join held using (val)),
found as (select *, kind || ':' || s || ':' || e as said from judged where listed < 3 or verdict = 'live'),
per as (
  select r, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
    count(*) filter (kind = 'hex') as n_hex, count(*) filter (verdict = 'live') as n_live,
    count(*) filter (verdict = 'copied') as n_copied,
    string_agg(said, ',' order by s, listed) filter (listed < 3) as base_said,
    string_agg(said, ',' order by s, listed) as all_said
  from found group by r)
select doc_id, coalesce(n_assign, 0)::bigint as n_assign, coalesce(n_access, 0)::bigint as n_access,
  coalesce(n_hex, 0)::bigint as n_hex, sha256(coalesce(base_said, '')) as base_sha256, coalesce(all_said, '') as spans,
  coalesce(n_live, 0)::bigint as n_live, coalesce(n_copied, 0)::bigint as n_copied
from d left join per using (r)
"""


@query(OP12_SQL)
def op12_secret_owners(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every text, and which of them are live or widely copied."""
    found = find_secrets(table(spark, folder, "documents"))

    def many(name: str, value: str):
        return F.size(F.filter("findings", lambda f: f[name] == value)).cast("long")

    return found.select(
        "doc_id",
        *(many("kind", k).alias(f"n_{k}") for k in ("assign", "access", "hex")),
        F.sha2(listed(of_base(F.col("findings"))), 256).alias("base_sha256"),
        listed(F.col("findings")).alias("spans"),
        many("verdict", "live").alias("n_live"),
        many("verdict", "copied").alias("n_copied"),
    )
