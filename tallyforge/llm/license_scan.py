"""Licence scan by MinHash bands over overlapping text windows, in DataFrame functions only.

Texts are read in windows of ``WINDOW`` words, each overlapping the next by half, so that any part of
half a window lies whole in one of them. Templates are cut into parts of half a window. Both sides
are sets of shingles of three words. A window is signed once for each part that it shares a shingle
with, by the shingles of that part alone, so neighbouring notices do not matter. Windows and parts
that agree in one of ``BANDS`` minimum hashes make a template a candidate for a document, and a
candidate is kept if the document contains at least ``CONTAINED`` of the template's distinct shingles.

With one hash per band, a part of which a fraction J of the shingles is in a window is retrieved with
probability 1 - (1 - J) ** BANDS, whatever the part's length and whatever else is in the window: never
missed if all of it is there, and less than once in 10 ** 22 times if 80 % is. Where a text breaks a part up
so that no window holds much of it, J is lower. A verdict is about the whole template, so every part
of it would have to be missed.

Defined results: a null or empty text has no licence; rows that share id and text share their result
and each gives one result row; an empty table gives an empty result; without templates no document
has a licence. A template needs three words.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyforge.llm.license_texts import LICENSE_TEXTS
from tallyforge.llm.tables import let, small, written

SHINGLE = 3
WINDOW = 48
BANDS = 32
CONTAINED = 0.8
#: Templates are meant to be a few thousand texts at most; their shingles become part of the plan.
MAX_TEMPLATE_SHINGLES = 50_000
MAX_BROADCAST_ROWS = 20_000
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Licence notices as their texts ask for them, opening sentences of licences, and whole licences.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0-notice",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at",
    ),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    (
        "BSD-conditions",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0-notice",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version.",
    ),
    ("MIT", "Released under the MIT License."),
    (
        "MIT-permission",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction',
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    *LICENSE_TEXTS,
)


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def shingles(ws: Column) -> Column:
    """The place and hash of every run of three words of a bound array."""
    places = F.when(F.size(ws) < SHINGLE, F.array().cast("array<int>")).otherwise(
        F.sequence(F.lit(0), F.size(ws) - SHINGLE)
    )
    return F.transform(
        places,
        lambda i: F.struct(i.alias("at"), F.xxhash64(*[F.get(ws, i + k) for k in range(SHINGLE)]).alias("code")),
    )


def template_table(spark: SparkSession, templates: Sequence[tuple[str, str]]) -> DataFrame:
    """The templates as (name, shingles)."""
    rows = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(t).alias("body")) for n, t in templates])
    return spark.range(1).select(F.inline(rows)).select("name", let(words(F.col("body")), shingles).alias("all"))


def signatures(rows: DataFrame, *group: str) -> DataFrame:
    """One row per group and band: the band's number and the least hash of the group's codes."""
    least = F.array(*[F.min(F.xxhash64("code", F.lit(j))) for j in range(BANDS)])
    return rows.groupBy(*group).agg(least.alias("least")).select(*group, F.posexplode("least").alias("band", "value"))


def scan(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    key: str = "doc_id",
    text: str = "text",
    contained: float = CONTAINED,
) -> DataFrame:
    """``key`` and the sorted names of the templates that each text contains."""
    spark = docs.sparkSession
    if not templates:
        return docs.select(key, F.array().cast("array<string>").alias("licenses"))
    known = template_table(spark, templates).collect()  # a parameter, bounded below
    sets = {r["name"]: sorted({s["code"] for s in r["all"]}) for r in known}
    if not all(sets.values()):
        raise ValueError(f"a template needs {SHINGLE} words")
    vocabulary = sorted({c for codes in sets.values() for c in codes})
    if len(vocabulary) > MAX_TEMPLATE_SHINGLES:
        raise ValueError(f"more than {MAX_TEMPLATE_SHINGLES} template shingles")

    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("content"), F.col(text).alias("body"))
    found = let(words(F.col("body")), shingles)
    hits = written(
        rows.select("key", "content", F.filter(found, lambda s: s["code"].isin(vocabulary)).alias("hits")),
        "licence-hits",
    )
    step = WINDOW // 2
    mine = hits.where(F.size("hits") > 0)
    # A shingle lies in the window that starts in its half window, and in the one before if it ends there.
    slot = F.floor(F.col("at") / step)
    both = F.when(F.col("at") + SHINGLE <= (slot + 1) * step, F.array(slot, slot - 1)).otherwise(F.array(slot))
    windows = mine.select("key", "content", F.inline("hits")).withColumn("slot", F.explode(both))

    # Parts of half a window; a shingle across two parts belongs to the whole template only.
    parts = template_table(spark, templates).select("name", F.inline("all")).withColumn("slot", F.floor(F.col("at") / step))
    whole = parts.where((F.col("at") + SHINGLE) <= (F.col("slot") + 1) * step)
    whole = whole.select("name", F.col("slot").alias("part"), "code").distinct()
    retrieved = signatures(whole, "name", "part")  # BANDS rows per template part
    bands = signatures(windows.join(F.broadcast(whole), "code"), "key", "content", "slot", "name", "part")
    candidates = (
        bands.join(F.broadcast(retrieved), ["name", "part", "band", "value"])
        .select("key", "content", "name")
        .distinct()
    )
    same = lambda a, b: a["key"].eqNullSafe(b["key"]) & a["content"].eqNullSafe(b["content"])
    pairs = small(
        written(candidates.groupBy("key", "content").agg(F.collect_set("name").alias("names")), "licence-candidates"),
        MAX_BROADCAST_ROWS,
    )
    codes = F.array_distinct(F.transform("hits", lambda s: s["code"]))
    template_sets = F.create_map(
        *[x for n, c in sets.items() for x in (F.lit(n), F.lit(c).cast("array<long>"))]
    )

    def verified(name: Column) -> Column:
        template = F.element_at(template_sets, name)
        return F.size(F.array_intersect(template, F.col("codes"))) >= contained * F.size(template)

    return (
        hits.join(pairs, same(hits, pairs), "left")
        .select(hits["key"].alias(key), codes.alias("codes"), "names")
        .select(key, F.sort_array(F.coalesce(F.filter("names", verified), F.array())).alias("licenses"))
    )
