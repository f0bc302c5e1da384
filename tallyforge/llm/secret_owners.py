"""Secrets in text, judged by how many owners hold the same one.

One pass over the texts finds candidates: assignments, access keys and hex runs, which are always
reported, and two looser kinds, passwords in addresses and bare mixed strings, which are reported only
if the corpus says so. Each candidate's value is hashed, and its hash is counted over the distinct
repositories and owners that hold it. A value that many owners hold is a copied example; one that few
hold and that looks random is a live credential.

Texts are read once; everything after that works on the candidates. A value in a third of all rows is
counted per task first and looked up by broadcast, with the other frequent ones; the rest are joined by
a shuffle in which no value is frequent.

Defined results: a null or empty text has no secret; a null repository counts as one named by the
empty text; values that differ only in case differ; rows that share an id, or have none, are kept
apart; repeated rows each count for their owner once; an empty table gives no row. Only the named
columns are read, so others may have any name. Positions are code points, whatever the text's length.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyforge.llm.tables import join_weighted, written

#: Kinds in the order in which spans at one place are listed; the first three are always reported.
KINDS = ("assign", "access", "hex", "url", "bare")
BASE_KINDS = KINDS[:3]
#: What the base kinds match, and how long a match must be.
ASSIGN = rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 12, 18, 16
ACCESS = rb"AKIA[A-Z0-9]+"
#: The looser kinds: a password in an address, and a run of these characters.
URL = rb"[A-Za-z][A-Za-z0-9+.-]*://[A-Za-z0-9_.-]+:([A-Za-z0-9+_.=!$-]+)@"
URL_CHARS, BARE_CHARS = 8, 20
BARE_DIGITS = 2
#: A value held by more owners than this is a copied example.
MOST_OWNERS = 3
#: A value looks live with so many different characters and none of these words.
LIVE_CHARS = 8
PLACEHOLDER = rb"(?i:example|sample|dummy|changeme|placeholder|xxxx)"

_HEX = bytes(49 if chr(b) in "0123456789abcdef" else 32 for b in range(256))
_BARE = bytes(49 if b < 128 and (chr(b).isalnum() or chr(b) in "+/_-") else 32 for b in range(256))
_assign, _access, _url, _placeholder = (re.compile(p) for p in (ASSIGN, ACCESS, URL, PLACEHOLDER))


def runs_of(raw: bytes, marks: bytes, least: int) -> Iterator[tuple[int, int]]:
    """Maximal runs of at least ``least`` bytes that ``marks`` maps to ``1``."""
    marked, wanted, at = raw.translate(marks), b"1" * least, 0
    while (begin := marked.find(wanted, at)) >= 0:
        end = marked.find(b" ", begin)
        at = end if end >= 0 else len(marked)
        yield begin, at


def is_mixed(value: bytes) -> bool:
    """Letters of both cases and some digits, not too repetitive."""
    digits = sum(value.count(d) for d in b"0123456789")
    return digits >= BARE_DIGITS and not value.islower() and not value.isupper() and len(set(value)) >= 10


def looks_live(value: bytes) -> bool:
    return len(set(value)) >= LIVE_CHARS and not _placeholder.search(value)


def candidates(raw: bytes) -> list[tuple[int, int, int, bytes]]:
    """Spans of one text as (start, kind, end, value), in bytes and in order."""
    found = []
    for m in _assign.finditer(raw):
        if len(m[1]) >= ASSIGN_CHARS:
            found.append((m.start(), 0, m.end(), m[1]))
    if b"AKIA" in raw:
        found += [(m.start(), 1, m.end(), m[0]) for m in _access.finditer(raw) if len(m[0]) >= ACCESS_CHARS]
    found += [(begin, 2, end, raw[begin:end]) for begin, end in runs_of(raw, _HEX, HEX_CHARS)]
    looser = []
    if b"://" in raw:
        looser += [(m.start(1), 3, m.end(1), m[1]) for m in _url.finditer(raw) if len(m[1]) >= URL_CHARS]
    for begin, end in runs_of(raw, _BARE, BARE_CHARS):
        if is_mixed(raw[begin:end]):
            looser.append((begin, 4, end, raw[begin:end]))
    return sorted(found + apart(looser, found)) if looser else sorted(found)


def apart(looser: list[tuple], base: list[tuple]) -> list[tuple]:
    """Looser spans that touch no base span and no looser span before them."""
    kept, taken = [], sorted((start, end) for start, _, end, _ in base)
    reach, at = 0, 0  # the furthest end of the base spans that start before the candidate's end
    last = 0
    for span in sorted(looser, key=lambda s: (s[2], s[1])):
        while at < len(taken) and taken[at][0] < span[2]:
            reach = max(reach, taken[at][1])
            at += 1
        if span[0] >= reach and span[0] >= last:
            kept.append(span)
            last = span[2]
    return kept


def in_characters(raw: bytes, places: list[int]) -> dict[int, int]:
    """Byte offsets as code point offsets, in one pass."""
    if raw.isascii():
        return {p: p for p in places}
    out, at, chars = {}, 0, 0
    for p in sorted(set(places)):
        chars += len(raw[at:p].decode("utf-8", "replace"))
        at = p
        out[p] = chars
    return out


def owner_of(repository: Column) -> Column:
    """What stands before the last slash of a repository's name, or the whole name."""
    return F.regexp_replace(repository, "/[^/]*$", "")


SPAN = "struct<start:long,kind:int,end:long,value:binary,live:boolean>"


def scanned(docs: DataFrame, key: str, text: str, repository: Column, owner: Column) -> DataFrame:
    """Candidates of every row; the table is written, so its row numbers stay."""
    rows = docs.select(
        F.col(key).alias("key"),
        F.coalesce(repository.cast("string"), F.lit("")).alias("repository"),
        F.coalesce(owner.cast("string"), F.lit("")).alias("owner"),
        F.col(text).cast("binary").alias("body"),
    )
    kind = dict(rows.dtypes)["key"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for body in batch.column("body"):
                raw = body.as_py() or b""
                found = candidates(raw)
                place = in_characters(raw, [p for start, _, end, _ in found for p in (start, end)]) if found else {}
                spans.append(
                    [
                        {
                            "start": place[start],
                            "kind": which,
                            "end": place[end],
                            "value": hashlib.blake2b(value, digest_size=16).digest(),
                            "live": looks_live(value),
                        }
                        for start, which, end, value in found
                    ]
                )
            shape = pa.list_(
                pa.struct(
                    [
                        ("start", pa.int64()),
                        ("kind", pa.int32()),
                        ("end", pa.int64()),
                        ("value", pa.binary()),
                        ("live", pa.bool_()),
                    ]
                )
            )
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("key", "repository", "owner")), pa.array(spans, shape)],
                names=["key", "repository", "owner", "spans"],
            )

    found = rows.mapInArrow(scan, f"key {kind}, repository string, owner string, spans array<{SPAN}>")
    return written(found.withColumn("row", F.monotonically_increasing_id()), "secret-candidates")


def ownership(entries: DataFrame) -> DataFrame:
    """Distinct owners and repositories, and the number of spans, of every value.

    Every step counts within its tasks first, so a value that all rows hold is never gathered.
    """
    held = entries.groupBy("value", "owner", "repository").agg(F.count("*").alias("n"))
    per_owner = held.groupBy("value", "owner").agg(F.count("*").alias("repositories"), F.sum("n").alias("n"))
    return per_owner.groupBy("value").agg(
        F.count("*").alias("owners"), F.sum("repositories").alias("repositories"), F.sum("n").alias("n")
    )


def find_secrets(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    repository: Column | None = None,
    owner: Column | None = None,
    most_owners: int = MOST_OWNERS,
) -> DataFrame:
    """Findings of every row: ``key`` and ``findings``, ordered by start and kind.

    A finding has ``start``, ``end``, ``kind``, the number of ``owners`` and ``repositories`` that hold
    its value, and a ``verdict``: ``copied`` (more than ``most_owners`` owners), ``live`` (few owners,
    looks random) or ``plain``. Spans of the looser kinds are findings only if they are live.
    """
    repository = F.col("source") if repository is None else repository
    owner = owner_of(repository) if owner is None else owner
    rows = scanned(docs, key, text, repository, owner)
    entries = rows.select("row", "key", "owner", "repository", F.inline("spans"))
    counts = written(ownership(entries), "secret-owners")
    judged = join_weighted(entries.drop("owner", "repository"), counts, "value")
    names = F.array(*map(F.lit, KINDS))
    verdict = (
        F.when(F.col("owners") > most_owners, "copied").when(F.col("live"), "live").otherwise("plain")
    )
    finding = F.struct(
        "start", F.col("kind").alias("listed"), "end", F.element_at(names, F.col("kind") + 1).alias("kind"),
        "owners", "repositories", verdict.alias("verdict"),
    )
    loose = F.col("listed.listed") >= len(BASE_KINDS)
    found = (
        judged.select("row", "key", finding.alias("listed"))
        .withColumn("listed", F.when(~loose | (F.col("listed.verdict") == "live"), F.col("listed")))
        .groupBy("row", "key")
        .agg(F.sort_array(F.collect_list("listed")).alias("findings"))  # as many as the text holds
    )
    none = rows.where(F.size("spans") == 0).select("row", "key", F.array().cast(found.schema["findings"].dataType).alias("findings"))
    return found.unionByName(none).select(F.col("key").alias(key), "findings")


def of_base(findings: Column) -> Column:
    """The findings that do not depend on the corpus."""
    return F.filter(findings, lambda f: f["listed"] < len(BASE_KINDS))


def listed(findings: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")


def masked(text: Column, findings: Column, mark: str = "*") -> Column:
    """``text`` with the characters of live findings replaced by ``mark``."""
    live = F.filter(findings, lambda f: f["verdict"] == "live")
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(state: Column, f: Column) -> Column:
        begin = F.greatest(state["at"], f["start"])
        end = F.greatest(begin, f["end"])
        kept = F.substring(text, (state["at"] + 1).cast("int"), (begin - state["at"]).cast("int"))
        return F.struct(
            F.concat(state["out"], kept, F.repeat(F.lit(mark), (end - begin).cast("int"))).alias("out"), end.alias("at")
        )

    done = F.aggregate(live, start, step)
    rest = F.substring(text, (done["at"] + 1).cast("int"), F.length(text))
    return F.when(F.size(live) == 0, text).otherwise(F.concat(done["out"], rest))
