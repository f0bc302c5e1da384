"""Nulls, empty and long texts, repeated rows, ties, empty tables and clashing column names."""

from __future__ import annotations

import pytest
from pyspark.sql import Row, functions as F

from tallyforge.llm import boosted_toxicity, byte_cnn, chosen_path, host_rules, license_scan, line_runs
from tallyforge.llm import neighbour_quality, packing, repeat_intervals, tables, winnowing
from tallyforge.llm.components import components
from tallyforge.llm.queries_packing import RANKS, TOKENIZER
from tests.llm.test_queries import check_packing, removed

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, key string, content string, body string, "
    "node string, row string, text_to_score string, quality_score string, kept string, n_removed string, "
    "bad_key string, rare_key string, hit string, bucket string"
)
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()
PROSE = " ".join(WORDS[i % 19] + str(i % 23) for i in range(120))
OTHER = " ".join(WORDS[(i * 7) % 19] + str(i % 29) for i in range(90))


def frame(spark, *rows):
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    full = [(d, t, "en" if i % 2 else "xx", s, len(t or ""), *(["clash"] * (len(names) - 5))) for i, (d, t, s) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Rows that operators may stumble over."""
    return frame(
        spark,
        (1, PROSE, "a"),
        (2, None, "a"),
        (3, "", None),
        (4, " \n\t \n", "b"),
        (5, PROSE, "b"),
        (5, PROSE, "b"),
        (None, OTHER, "b"),
        (None, OTHER, None),
        (6, "one two", "a"),
        (7, "!?$ %", "a"),
        (8, "long " + "word " * 60_000, "a"),
        (9, "x" * 200_000, "a"),
        (10, "漢字 🤦🏼‍♂️ é\u0000ñ", "a"),
    ).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark).limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (5, 1, 1), (6, 0, 1), (7, None, None), (None, 1, 1), (99, 1, 1), (8, 0, 0), (2, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def ids(rows):
    return sorted(r["doc_id"] if r["doc_id"] is not None else -1 for r in rows)


EVERY = sorted([1, 2, 3, 4, 5, 5, -1, -1, 6, 7, 8, 9, 10])


def test_languages(spark, odd, empty):
    rows = byte_cnn.identify(odd).collect()
    assert ids(rows) == EVERY
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (2, 3, 4, 7)} == {"und"}
    assert len({(r["lang_pred"], r["score"]) for r in rows if r["doc_id"] == 5}) == 1
    assert not [r for r in rows if r["doc_id"] is None and r["held_out"]]
    assert byte_cnn.identify(empty).collect() == []
    unlearned = byte_cnn.predict_languages(odd, None).collect()
    assert {(r["lang_pred"], r["score"]) for r in unlearned} == {("und", 0.0)}


def test_quality(spark, odd, empty, labels):
    rows = neighbour_quality.score_quality(odd, labels).collect()
    assert ids(rows) == EVERY and all(0 <= r["score"] <= 1 for r in rows)
    # 2 has an empty text and label 0: so have all texts without a trigram.
    assert {r["score"] for r in rows if r["doc_id"] in (2, 3)} == {0.0}
    assert neighbour_quality.score_quality(empty, labels).collect() == []
    none = labels.limit(0)
    assert {r["score"] for r in neighbour_quality.score_quality(odd, none).collect()} == {0.0}
    voted = neighbour_quality.vote(odd, None)
    assert set(voted.columns) == set(odd.columns) and voted.count() == 13


def test_toxicity(spark, odd, empty, labels):
    rows = boosted_toxicity.score_toxicity(odd, labels).collect()
    assert ids(rows) == EVERY and all(0 <= r["score"] <= 1 for r in rows)
    assert boosted_toxicity.score_toxicity(empty, labels).collect() == []
    one_class = labels.where("toxic = 1")
    assert {r["score"] for r in boosted_toxicity.score_toxicity(odd, one_class).collect()} == {1.0}
    assert {r["score"] for r in boosted_toxicity.score_toxicity(odd, labels.limit(0)).collect()} == {0.0}
    kept = boosted_toxicity.score_texts(odd, boosted_toxicity.ToxicityModel([], [], None, ([], []), 0.5))
    assert kept.columns == [*odd.columns, "toxicity"]


def test_host_rules(spark, odd, empty):
    rows = host_rules.judge(odd).collect()
    assert ids(rows) == EVERY
    by_id = {r["doc_id"]: r for r in rows}
    for i in (2, 3, 4):
        assert (by_id[i]["n_words"], by_id[i]["kept"]) == (0, False)
    assert by_id[3]["host_docs"] is None and by_id[1]["host_docs"] == 7
    assert by_id[8]["n_repeat_words"] == 60_000 and by_id[8]["base_failed"]
    assert by_id[9]["n_words"] == 1 and by_id[9]["word_chars"] == 200_000
    assert host_rules.judge(empty).collect() == []
    assert host_rules.judge(odd, keep=("doc_id", "kept")).columns.count("kept") == 1


def test_host_verdict_rejects_documents_of_failing_hosts(spark):
    good = " ".join(f"word{i}" for i in range(80))
    rows = [(i, good, "fine") for i in range(60)] + [(100 + i, "bad", "spam") for i in range(59)] + [(200, good, "spam")]
    rows += [(300, good, None), (301, "bad", "new"), (302, good, "new")]
    got = {r["doc_id"]: r["kept"] for r in host_rules.judge(frame(spark, *rows)).collect()}
    assert not got[200] and got[300] and all(got[i] for i in range(60)) and not got[301]


@pytest.mark.parametrize("text", ["a b c a b c", "a a a a a", "a b c d a b c", "a b", "a b c b c a b c b", ""])
def test_repeated_words(spark, text):
    ws = text.split()
    starts = [tuple(ws[i : i + 3]) for i in range(len(ws) - 2)]
    want = len({i + k for i, s in enumerate(starts) if starts.count(s) > 1 for k in range(3)})
    assert host_rules.judge(frame(spark, (1, text, "a"))).first()["n_repeat_words"] == want


def test_many_repeated_runs_are_sorted(spark):
    text = " ".join(f"w{i}" for i in range(40)) + " x " + " ".join(f"w{i}" for i in range(40))
    assert host_rules.judge(frame(spark, (1, text, "a"))).first()["n_repeat_words"] == 80


def test_packing_of_odd_rows(spark, odd, empty):
    distinct = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    texts = {r["doc_id"]: r["text"] for r in distinct.collect()}
    rows = packing.pack(distinct, TOKENIZER, RANKS).collect()
    assert check_packing(rows, texts) == 0
    every = packing.pack(odd, TOKENIZER, RANKS, with_ids=False).collect()
    assert sum(r["doc_tokens"] for r in every if r["start"] == 0 and r["doc_id"] is None) > 0
    assert packing.pack(empty, TOKENIZER, RANKS).collect() == []


def test_packer_is_bounded_and_loses_nothing():
    import numpy as np

    rng, out = np.random.default_rng(4), []
    packer = packing.Packer(out.append, 64, 4)
    lengths = [int(n) for n in rng.integers(1, 200, 300)]
    for d, n in enumerate(lengths):
        packer.add(d, 0, n, np.arange(n, dtype="<u4").tobytes())
        assert len(packer.open) <= 4
    left = packer.pour()
    assert all(sum(len(p[3]) // 4 for p in s) == 64 for s in out)
    tail = list(packing.power_cuts(left))
    assert all((n := sum(len(p[3]) // 4 for p in s)) & (n - 1) == 0 for s in tail)
    found = {}
    for s in out + tail:
        for d, start, _, ids in s:
            found.setdefault(d, []).extend(range(start, start + len(ids) // 4))
            assert np.frombuffer(ids, "<u4").tolist() == list(range(start, start + len(ids) // 4))
    assert {d: sorted(v) for d, v in found.items()} == {d: list(range(n)) for d, n in enumerate(lengths)}


def test_leftovers_of_many_partitions_merge_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(packing, "MERGED_AT_ONCE", 3)
    docs = spark.range(60).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text")).repartition(30)
    rows = packing.pack(docs, TOKENIZER, RANKS, size=16).collect()
    assert check_packing(rows, {i: f"text {i}" for i in range(60)}, 16) == 0


def words_of(text):
    import re

    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_contamination_against_brute_force(spark, odd, empty):
    items = [
        (1, " ".join(PROSE.split()[20:60])),
        (2, "one TWO"),
        (3, None),
        (4, "?!"),
        (None, " ".join(OTHER.split()[3:18])),
        (1, "漢字"),
        (5, " ".join(OTHER.split()[:8])),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = odd.unionByName(frame(spark, (20, "zero one two, three. One Two", "c"), (21, OTHER.upper(), "c")))
    rows = winnowing.contamination(docs, benchmark).collect()
    want = []
    for r in docs.collect():
        ws, hit, found = words_of(r["text"]), set(), set()
        for item, text in items:
            iw = words_of(text)
            size = min(13, len(iw))
            windows = {tuple(iw[i : i + size]) for i in range(len(iw) - size + 1)} if iw else set()
            for i in range(len(ws) - size + 1 if iw else 0):
                if tuple(ws[i : i + size]) in windows:
                    hit.update(range(i, i + size))
                    found.add("" if item is None else str(item))
        want.append((str(r["doc_id"]), len(ws), len(hit), sorted(found)))
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["items"]) for r in rows) == sorted(want)
    assert winnowing.contamination(empty, benchmark).collect() == []
    assert {r["n_hit"] for r in winnowing.contamination(odd, benchmark.limit(0)).collect()} == {0}
    kept = winnowing.clean_documents(odd, benchmark)
    assert kept.columns == odd.columns and 6 not in {r["doc_id"] for r in kept.collect()}


def test_licenses(spark, odd, empty):
    notice = dict(license_scan.TEMPLATES)["MIT-permission"]
    docs = odd.unionByName(
        frame(spark, (20, f"{PROSE} {notice} {PROSE}", "c"), (21, "RELEASED under the mit license", "c"), (22, notice[:60], "c"))
    )
    rows = license_scan.scan(docs).collect()
    got = {r["doc_id"]: r["licenses"] for r in rows if r["licenses"]}
    assert len(rows) == 16 and got == {20: ["MIT-permission"], 21: ["MIT"]}
    assert license_scan.scan(empty).collect() == []
    assert {len(r["licenses"]) for r in license_scan.scan(odd, []).collect()} == {0}
    with pytest.raises(ValueError):
        license_scan.scan(odd, [("short", "two words")])


def test_classes(spark, odd, empty):
    near = PROSE.replace("gamma2", "changed", 1)
    docs = odd.unionByName(frame(spark, (20, near, "c"), (21, "One, two!", "c")))
    rows = chosen_path.similarity_classes(docs).collect()
    got = {}
    for r in rows:
        got.setdefault(r["doc_id"], set()).add((r["class_id"], r["n_links"]))
    assert len(rows) == 15
    assert got[1] == got[5] == got[20] == {(1, 3)}
    assert got[6] == got[21] == {(6, 1)} and got[None] == {(None, 1)}
    assert got[2] == {(2, 0)} and got[3] == {(3, 0)} and got[7] == {(7, 0)}
    assert chosen_path.similarity_classes(empty).collect() == []
    kept = chosen_path.one_per_class(docs)
    assert kept.columns == docs.columns
    assert ids(kept.collect()) == sorted([1, 2, 3, 4, -1, 6, 7, 8, 9, 10])


def test_large_groups_are_compared_in_blocks(spark, monkeypatch):
    """Buckets and groups beyond the limits, cut into blocks, give the same result."""
    monkeypatch.setattr(chosen_path, "BLOCK_SETS", 20)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(base[:57] + [f"t{i}", f"u{i % 3}", "end"]), "a") for i in range(90)]
    docs = frame(spark, *rows)
    got = chosen_path.similarity_classes(docs, brute_force=16).collect()
    sets = [{tuple(t.split()[i : i + 5]) for i in range(56)} for _, t, _ in rows]
    links = [sum(len(a & b) >= 0.8 * len(a | b) for j, b in enumerate(sets) if j != i) for i, a in enumerate(sets)]
    assert {r["doc_id"]: r["n_links"] for r in got} == dict(enumerate(links))
    assert {r["class_id"] for r in got} == {0}


def test_runs_reach_the_target_recall():
    runs = chosen_path.runs_for(0.8, 0.99999)
    together = 1.0
    for _ in range(chosen_path.STEPS):
        together = 1 - (1 - 0.8 * together) ** chosen_path.DRAWS
    assert (1 - together) ** runs <= 1e-5 < (1 - together) ** (runs - 1)
    assert runs * chosen_path.DRAWS + 2 <= len(chosen_path.SEEDS)


def near_pairs(n, size=200, common=178):
    """Pairs of texts that share ``common`` of ``size`` shingles: a similarity of 0.80."""
    rows = []
    for i in range(n):
        a = [f"p{i}w{j}" for j in range(size + 4)]
        b = a[: common + 4] + [f"q{i}w{j}" for j in range(size - common)]
        rows += [(2 * i, " ".join(a), "s"), (2 * i + 1, " ".join(b), "s")]
    return rows


def test_recall_of_planted_pairs_at_the_threshold(spark):
    """All pairs by the runs for the target; by a single run, always of three steps, the share promised."""
    rows = near_pairs(400)
    sets = [{tuple(t.split()[i : i + 5]) for i in range(200)} for _, t, _ in rows[:2]]
    assert 0.8 <= len(sets[0] & sets[1]) / len(sets[0] | sets[1]) < 0.81
    docs = frame(spark, *rows)
    found = {r["doc_id"]: r["n_links"] for r in chosen_path.similarity_classes(docs, brute_force=1).collect()}
    assert set(found.values()) == {1}
    assert chosen_path.runs_for(0.8, 0.9) == 1
    once = chosen_path.similarity_classes(docs, recall=0.9, brute_force=1).collect()
    share = sum(r["n_links"] for r in once) / len(rows)
    together = 1.0
    for _ in range(chosen_path.STEPS):
        together = 1 - (1 - 0.8 * together) ** chosen_path.DRAWS
    deviation = (together * (1 - together) / 400) ** 0.5
    assert share > together - 3 * deviation and share > 0.9


def test_a_star_of_many_nodes_settles(spark):
    """One node with 10^5 neighbours, of a size at which heavy nodes are looked up apart."""
    edges = spark.range(1, 100_001).selectExpr("id as a", "cast(0 as long) as b")
    chain = spark.range(200_000, 200_100).selectExpr("id as a", "id + 1 as b")
    roots = components(edges.unionByName(chain)).groupBy("root").count().collect()
    assert {r["root"]: r["count"] for r in roots} == {0: 100_001, 200_000: 101}


def test_components_against_union_find(spark):
    import random

    rnd = random.Random(3)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    want = {x: find(x) for x in {v for e in edges if e[0] != e[1] for v in e}}
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want


def test_whole_licences_and_their_relatives(spark):
    texts = dict(license_scan.TEMPLATES)
    gpl = (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {} "
        "Public License as published by the Free Software Foundation; either version {} of the License, or (at your "
        "option) any later version."
    )
    wrapped = texts["MIT-text"].upper().replace(" ", "\n * ")
    cut = " ".join(texts["ISC-text"].split()[:60])
    docs = frame(
        spark,
        (1, f"{PROSE}\n{wrapped}\n{OTHER}", "a"),
        (2, f"{texts['BSD-2-Clause-text']} {PROSE}", "a"),
        (3, f"{texts['BSD-2-Clause-text']} {texts['BSD-3-Clause-endorsement']}", "a"),
        (4, f"{PROSE} {gpl.format('General', 2)}", "a"),
        (5, f"{gpl.format('Lesser General', 3)} {PROSE}", "a"),
        (6, gpl.format("Affero General", 3), "a"),
        (7, texts["Zlib-text"] + texts["Unlicense-text"] + texts["BSL-1.0-text"], "a"),
        (8, cut, "a"),
    )
    got = {r["doc_id"]: set(r["licenses"]) for r in license_scan.scan(docs).collect()}
    assert got[1] == {"MIT-permission", "MIT-text"}
    assert got[2] == {"BSD-conditions", "BSD-2-Clause-text"}
    assert got[3] == {"BSD-conditions", "BSD-2-Clause-text", "BSD-3-Clause-endorsement"}
    assert {"GNU-version-2-or-later", "GPL-terms"} <= got[4] and not {"GNU-version-3-or-later", "LGPL-terms"} & got[4]
    assert {"GNU-version-3-or-later", "LGPL-terms"} <= got[5] and "GPL-terms" not in got[5]
    assert {"GNU-version-3-or-later", "AGPL-3.0-terms"} <= got[6] and not {"GPL-terms", "LGPL-terms"} & got[6]
    assert got[7] == {"Zlib-text", "Unlicense-text", "BSL-1.0-text"} and got[8] == set()


LINES = [f"line number {i} with enough letters to be kept apart" for i in range(6)]


def cut_lines(rows):
    """Brute force: every run of lines, of any length, that occurs earlier and has 40 characters."""
    seq = {}
    for d, t, _ in rows:
        seq[d] = [x for x in (t or "").split("\n") if x.strip(" \t\x0b\x0c\r")]
    places = [(d, i) for d in sorted(seq) for i in range(len(seq[d]))]
    gone, longest = {d: set() for d in seq}, dict.fromkeys(seq, 0)
    for at, (d, i) in enumerate(places):
        size = 0
        for e, j in places[:at]:
            n = 0
            while i + n < len(seq[d]) and j + n < len(seq[e]) and seq[d][i + n] == seq[e][j + n]:
                n += 1
            size = max(size, n)
        if sum(map(len, seq[d][i : i + size])) >= 40:
            gone[d].update(range(i, i + size))
            longest[d] = max(longest[d], size)
    out = {}
    for d, t, _ in rows:
        kept, at = [], -1
        for x in (t or "").split("\n"):
            if x.strip(" \t\x0b\x0c\r"):
                at += 1
                if at in gone[d]:
                    continue
            kept.append(x)
        out[d] = (t if t is None or not gone[d] else "\n".join(kept), len(gone[d]), longest[d])
    return out


@pytest.mark.parametrize("heavy", [10_000, 5])
def test_line_runs_against_brute_force(spark, empty, monkeypatch, heavy):
    import random

    monkeypatch.setattr(tables, "HEAVY_ROWS", heavy)
    rnd, rows = random.Random(8), []
    for d in range(40):
        pick = lambda: rnd.choice(["a", "b", "c", "twelve chars", "", " ", *LINES, f"own {d} {rnd.random()}"])
        rows.append((d, "\n".join(pick() for _ in range(rnd.randrange(12))), "s"))
    short = [f"line {i % 4}" for i in range(30)]
    rows += [(50, None, "s"), (51, "a\na\na\na", "s"), (52, "\n".join(LINES * 3), "s")]
    rows += [(60 + i, "\n".join([f"own {i}", *short[i : i + 5 + 3 * i], f"end {i}"]), "s") for i in range(8)]
    rows += [(70, "Yes\nNo", "s"), (71, "Yes\nNo\nown", "s"), (72, "\n".join("x" * 50), "s"), (73, "\n".join("x" * 41), "s")]
    docs = frame(spark, *rows)
    result = line_runs.drop_repeated_lines(docs).collect()
    got = {r["doc_id"]: (r["text"], r["n_removed"], r["longest_run"]) for r in result}
    assert got == cut_lines(rows)
    assert got[71] == ("Yes\nNo\nown", 0, 0)
    for r in result:
        lines = {i for run in r["removed_runs"] for i in range(run["first"], run["last"] + 1)}
        assert len(lines) == r["n_removed"]
        assert max([run["last"] - run["first"] + 1 for run in r["removed_runs"]], default=0) == r["longest_run"]
    assert line_runs.drop_repeated_lines(empty).collect() == []


def test_a_repeated_run_of_three_lines_counts_three(spark):
    run = "one of three lines\ntwo of three lines\nthree of three lines"
    docs = frame(spark, (1, f"head\n{run}\ntail", "a"), (2, f"{run}\nother", "a"), (3, f"x\n{run}", "b"))
    rows = {r["doc_id"]: r for r in line_runs.drop_repeated_lines(docs).collect()}
    assert [rows[i]["longest_run"] for i in (1, 2, 3)] == [0, 3, 3]
    assert [(r["first"], r["last"]) for r in rows[3]["removed_runs"]] == [(1, 3)] and rows[2]["text"] == "other"


def test_too_many_lines_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(line_runs, "LINE_BITS", 3)
    with pytest.raises(Exception, match="more than 8 lines"):
        line_runs.drop_repeated_lines(frame(spark, (1, "\n".join("abcdefghi"), "a"), (2, "i", "a"))).collect()


def test_broadcast_is_bounded_by_rows_and_bytes(spark):
    wide = spark.range(100).selectExpr("id", "transform(sequence(1, 1000), x -> struct(x as a, id as b)) as list", "repeat('x', 50) as s")
    bytes_per_row = wide.select(tables.row_bytes(wide)).first()[0]
    assert 32_000 < bytes_per_row < 40_000
    hinted = lambda df: "strategy=broadcast" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(tables.small(wide, 100)) and not hinted(tables.small(wide, 99))
    assert not hinted(tables.small(wide, 100, max_bytes=50 * bytes_per_row))
    assert hinted(tables.small(wide.limit(0), 1))


def test_repeated_rows_do_not_remove_their_own_lines(spark, odd):
    rows = line_runs.drop_repeated_lines(odd).collect()
    got = [(r["doc_id"], r["text"], r["n_removed"]) for r in rows if r["doc_id"] in (1, 5)]
    assert sorted(got) == [(1, PROSE, 0), (5, "", 1), (5, "", 1)]
    assert ids(rows) == EVERY


def test_repeated_bytes_of_odd_rows(spark, odd, empty):
    rows = repeat_intervals.remove_repeats(odd).collect()
    assert ids(rows) == EVERY
    got = {(r["doc_id"], r["n_bytes"], bytes(r["kept"])) for r in rows}
    assert (1, len(PROSE), PROSE.encode()) in got and (5, len(PROSE), b"") in got
    assert (None, len(OTHER), OTHER.encode()) in got
    assert repeat_intervals.remove_repeats(empty).collect() == []
    with pytest.raises(ValueError):
        repeat_intervals.remove_repeats(odd.withColumn("doc_id", F.col("doc_id").cast("string")))


def test_equal_stretches_of_different_lots_have_one_hash():
    import numpy as np

    rule = b"-" * 60
    codes = [np.frombuffer(before + rule + behind, np.uint8) for before, behind in ((b"", b"x"), (b"abc", b"other"))]
    hashes = [repeat_intervals.text_hashes(c, np.array([at]), np.array([at + 60])) for c, at in zip(codes, (0, 3))]
    assert hashes[0] == hashes[1]


def test_separator_between_differing_texts_is_not_sorted_in_one_place(spark, monkeypatch):
    """Every text has its own words around a line of dashes: one anchor, and all stretches differ."""
    import random

    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefgh ") for _ in range(90))
    texts = {d: word() + "-" * rnd.randrange(50, 90) + word() for d in range(300)}
    texts |= {d: texts[d - 300][30:] + "-" * 70 + texts[d - 299][:120] for d in range(300, 330)}
    docs = frame(spark, *[(d, t, "s") for d, t in texts.items()]).repartition(4)
    got = {}
    for most in (1 << 18, 200):
        monkeypatch.setattr(repeat_intervals, "MOST_WINDOWS", most)
        rows = repeat_intervals.shared_anchors(
            docs.select(F.col("doc_id").alias("document"), F.col("text").alias("body")), 3
        ).collect()
        assert any(any(r["heavy"]) for r in rows) == (most == 200)
        rows = repeat_intervals.remove_repeats(docs).collect()
        got[most] = {r["doc_id"]: bytes(r["kept"]) for r in rows}
        want = removed(texts)
        import hashlib

        assert {d: hashlib.sha256(k).hexdigest() for d, k in got[most].items()} == {d: w[3] for d, w in want.items()}


@pytest.mark.parametrize("most", [0, 60])
def test_repeated_bytes_of_random_texts_with_heavy_anchors(spark, monkeypatch, most):
    monkeypatch.setattr(repeat_intervals, "MOST_WINDOWS", most)
    test_repeated_bytes_of_random_texts(spark, monkeypatch)


def test_repeated_bytes_of_random_texts(spark, monkeypatch):
    """Few letters, shared parts, overlaps with themselves, and lots and parts of a few bytes."""
    import hashlib
    import random

    for name, value in (("LOT_BYTES", 700), ("PART_BYTES", 3000), ("HELD", 50)):
        monkeypatch.setattr(repeat_intervals, name, value)
    rnd = random.Random(5)
    parts = ["".join(rnd.choice("ab ") for _ in range(rnd.randrange(20, 120))) for _ in range(12)]
    texts = {}
    for d in range(60):
        chosen = [rnd.choice(parts) if rnd.random() < 0.6 else str(rnd.random()) for _ in range(rnd.randrange(7))]
        texts[d] = "".join(chosen) or None
    texts[70] = "é" * 60
    texts[71] = "xé" + "é" * 40
    texts[72] = "a" * 300
    texts[73] = "a" * 49 + "b" + "a" * 60
    docs = frame(spark, *[(d, t, "s") for d, t in texts.items()])
    got = {}
    for r in repeat_intervals.remove_repeats(docs).collect():
        gone = sum(s["end"] - s["begin"] for s in r["spans"])
        got[r["doc_id"]] = (r["n_bytes"], gone, len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest())
    assert got == removed(texts)


def test_quality_stage_keeps_all_without_labelled_texts(spark, odd, labels, monkeypatch):
    import corpus_pipeline

    unusable = labels.where("quality is null or doc_id is null")
    monkeypatch.setattr(corpus_pipeline, "table", lambda *_: unusable)
    kept = corpus_pipeline.quality(spark, odd, "")
    assert kept.columns == odd.columns and ids(kept.collect()) == EVERY


def test_short_licences_in_windows_dense_with_others(spark):
    """Every five words of a text are a template, so each window holds many others."""
    words = [f"w{i}x{i * i % 7}" for i in range(160)]
    templates = [(f"t{i:03}", " ".join(words[i : i + 5])) for i in range(len(words) - 4)]
    docs = frame(spark, (1, " ".join(words), "a"), (2, " ".join(reversed(words)), "a"))
    found = {r["doc_id"]: r["licenses"] for r in license_scan.scan(docs, templates).collect()}
    # A template across the borders of windows of 48 words that start every 24 words lies in one at least.
    assert found == {1: [n for n, _ in templates], 2: []}
