"""Copies by tries and the filter audit against plain Python."""

from __future__ import annotations

import re
from itertools import permutations

import pytest
from hypothesis import given, settings, strategies as st

from tallyforge.llm import text_tries
from tallyforge.llm.text_tries import Trie, audit, masks

SCHEMA = "doc_id long, text string, source string, id string, mask string, part string, n string, prefix string"
LONG = "boilerplate header " * 5000


def brute_masks(rows):
    """(id, part, mask) of all rows, by comparing every two texts."""
    out = []
    for doc_id, text, source in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        copy = doc_id is not None and any(
            i is not None and i < doc_id and (t or "") == text for i, t, _ in rows
        )
        fails = (
            len(words) < 50,
            100 * len(set(words)) < 65 * len(words),
            100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            bool(re.search(r"[#$%&*|]", text)),
            copy,
        )
        out.append((doc_id, source or "", sum(f << i for i, f in enumerate(fails))))
    return out


def brute_audit(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    found = brute_masks(rows)
    out = {}
    for part in {p for _, p, _ in found}:
        mine = [(d, m) for d, p, m in found if p == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = list(mine)
            for step, letter in enumerate(order, 1):
                bit = 1 << "ABCDE".index(letter)
                gone = [(d, m) for d, m in left if m & bit]
                left = [(d, m) for d, m in left if not m & bit]
                total[letter] += len(gone)
                out[part, order, step] = [
                    len(left),
                    len(gone),
                    sum(bool(m & bit) for _, m in mine) - len(gone),
                    sum(m == bit for _, m in mine),
                    sum(d in good for d, _ in gone),
                    sum(d in toxic for d, _ in gone),
                    letter,
                ]
        for key in out:
            if key[0] == part:
                out[key][-1] = total[out[key][-1]]
    return out


ROWS = [
    (1, LONG + "one", "a"),
    (2, LONG + "two", "a"),
    (3, LONG + "one", "b"),
    (4, None, None),
    (5, "", "a"),
    (6, "", ""),
    (7, "SHOUT # loud", "a"),
    (7, "SHOUT # loud", "a"),
    (7, "SHOUT # loud", "b"),
    (8, "SHOUT # loud", "b"),
    (8, "SHOUT # lou", "b"),
    (None, "SHOUT # loud", "a"),
    (None, "SHOUT # loud", None),
    (9, " ".join(f"w{i}" for i in range(60)), "c"),
    (10, " ".join(f"w{i}" for i in range(60)), "c"),
    (0, "漢字 🤦🏼‍♂️ é\u0000ñ\x1c\x85\xa0x", "c"),
    *[(20 + i, "hot text that a third of all rows share", "h") for i in range(40)],
]
LABELS = [(3, 1, 0), (3, 0, 1), (7, 1, 1), (8, None, 1), (None, 1, 1), (20, 1, 0), (25, 1, 0), (999, 1, 1)]


@pytest.fixture(scope="module")
def docs(spark):
    clash = ("x",) * 5
    return spark.createDataFrame([(*r, *clash) for r in ROWS], SCHEMA).repartition(5)


@pytest.mark.parametrize(("prefix_bytes", "lot"), [(48 << 20, 32 << 20), (500, 600)])
def test_masks_equal_brute_force(docs, monkeypatch, prefix_bytes, lot):
    """With small limits prefixes grow to whole texts of 95,000 bytes, and lots hold few rows."""
    monkeypatch.setattr(text_tries, "PREFIX_BYTES", prefix_bytes)
    monkeypatch.setattr(text_tries, "LOT_BYTES", lot)
    monkeypatch.setattr(text_tries.by_prefix, "__defaults__", (prefix_bytes,))
    got = [(r["id"], r["part"], r["mask"]) for r in masks(docs).collect() for _ in range(r["n"])]
    assert sorted(map(str, got)) == sorted(map(str, brute_masks(ROWS)))


def test_audit_equals_brute_force(spark, docs):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    columns = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    rows = audit(docs, labels).collect()
    got = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in columns] for r in rows}
    assert len(rows) == len(got) and got == brute_audit(ROWS, LABELS)
    assert audit(docs.limit(0), labels).collect() == []
    unlabelled = audit(docs, labels.limit(0)).collect()
    assert len(unlabelled) == len(rows) and {r["good_lost"] for r in unlabelled} == {0}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("ab", max_size=6), st.integers(0, 5)), max_size=30))
def test_trie_holds_every_text_with_its_least_id(rows):
    trie, copies = Trie(), 0
    for text, number in rows:
        found = trie.insert(text.encode(), number, "x", 1)
        copies += sum(found[1].values()) if found else 0
    held = {text.decode(): (least, sum(n.values())) for text, least, n in trie.texts()}
    assert {t: least for t, (least, _) in held.items()} == {
        t: min(i for u, i in rows if u == t) for t in {t for t, _ in rows}
    }
    assert copies + sum(n for _, n in held.values()) == len(rows)
