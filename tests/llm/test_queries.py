"""The registered queries on the small tables, against SQL or plain Python."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tallyforge.llm import queries
from tallyforge.llm.neighbour_quality import ACCEPT
from tallyforge.llm.queries_packing import RANKS, TOKENIZER
from tallyforge.llm.tables import table
from tallyforge.llm.tokens import Encoder, added_tokens
from tests.compare import connect, difference
from tests.conftest import DATA

LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(DATA)


@pytest.mark.parametrize("name", queries.ORACLES)
def test_query_matches_sql(spark, duck, name):
    result = queries.QUERIES[name](spark, DATA).toArrow()
    assert difference(result, duck.sql(queries.ORACLES[name]).to_arrow_table()) is None


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def test_languages_are_recognised_on_held_out_texts(spark):
    rows = queries.QUERIES["op1_language_cnn"](spark, LARGER).collect()
    lang = {r["doc_id"]: r["lang"] for r in table(spark, LARGER, "documents").collect()}
    assert {r["doc_id"] for r in rows} == set(lang) and len(rows) == len(lang)
    assert all(r["held_out"] == (crc(r["doc_id"]) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    held = [r["lang_pred"] == lang[r["doc_id"]] for r in rows if r["held_out"]]
    assert np.mean(held) > 0.97


@pytest.mark.parametrize(
    ("name", "label", "parts", "part", "least"),
    [("op4_boosted_toxicity", "toxic", 4, 2, 0.93), ("op8_neighbour_quality", "quality", 5, 0, 0.95)],
)
def test_labels_are_predicted_on_held_out_texts(spark, name, label, parts, part, least):
    rows = queries.QUERIES[name](spark, LARGER).collect()
    labels = {r["doc_id"]: r[label] for r in table(spark, LARGER, "labels").collect()}
    assert len(rows) == table(spark, LARGER, "documents").count()
    assert all(r["held_out"] == (crc(r["doc_id"]) % parts == part) for r in rows)
    assert all(r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in rows)
    held = [r["predicted"] == labels[r["doc_id"]] for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean(held) > least


def check_packing(rows, texts, size=1024):
    """Every id of every text lies in exactly one place; returns the padding."""
    tokenizer = Tokenizer.from_file(TOKENIZER)
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(texts)
    for doc_id, pieces in by_doc.items():
        ids = [*tokenizer.encode(texts[doc_id] or "", add_special_tokens=False).ids, 0]
        at = 0
        for p in sorted(pieces, key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            part = np.array(ids[at : at + p["length"]], "<u4")
            assert p["ids_crc32"] == zlib.crc32(part.tobytes())
            at += p["length"]
        assert at == len(ids)
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    return padding


def test_packing_round_trip_without_padding(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, DATA, "documents").collect()}
    rows = queries.QUERIES["op2_bounded_packing"](spark, DATA).collect()
    assert check_packing(rows, texts) == 0


def removed(texts, size=50):
    """Brute force over all strings of ``size`` bytes."""
    first = {}
    for doc_id, text in sorted(texts.items()):
        raw = (text or "").encode()
        for i in range(len(raw) - size + 1):
            first.setdefault(raw[i : i + size], doc_id)
    out = {}
    for doc_id, text in texts.items():
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - size + 1):
            if first[raw[i : i + size]] < doc_id:
                gone[i : i + size] = b"\1" * size
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out[doc_id] = (len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def test_repeated_bytes_against_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, DATA, "documents").collect()}
    rows = queries.QUERIES["op7_repeat_intervals"](spark, DATA).collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows}
    assert len(rows) == len(texts) and got == removed(texts)


def test_pipeline_stage_by_stage(spark):
    """Each stage against SQL or Python over its own input."""
    docs = table(spark, DATA, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "line_dedup", "near_duplicates", "decontamination", "packing"]

    def frozen(name, given):
        rows = stages[name](spark, given, DATA)
        if name != "packing":
            assert rows.columns == docs.columns
        return spark.createDataFrame(rows.toPandas(), rows.schema)

    def sql(ctes, select, given):
        con = connect(DATA)
        con.register("given", given.toArrow())
        con.execute("create or replace view documents as select * from given")
        return con.sql(f"with {ctes} {select}").fetchall()

    good = frozen("quality", docs)
    score = {r["doc_id"]: r["score"] for r in queries.QUERIES["op8_neighbour_quality"](spark, DATA).collect()}
    assert {r["doc_id"] for r in good.collect()} == {d for d, s in score.items() if s >= ACCEPT}
    labels = {r["doc_id"]: r["quality"] for r in table(spark, DATA, "labels").collect()}
    assert {d for d, q in labels.items() if q} <= {r["doc_id"] for r in good.collect()}

    from tallyforge.llm.queries_overlap import CONTAMINATION_CTES
    from tallyforge.llm.queries_repeats import LINE_CTES
    from tallyforge.llm.queries_similarity import OP5_SQL

    lines = frozen("line_dedup", good)
    want = sql(
        f"recursive docs as (select * from documents), {LINE_CTES}",
        "select doc_id, kept_text from deduped where n_removed = 0 or regexp_matches(kept_text, '[^\\x20\\x09-\\x0D]')",
        good,
    )
    assert sorted((r["doc_id"], r["text"]) for r in lines.collect()) == sorted(want)
    assert all(r["n_chars"] == len(r["text"]) for r in lines.collect())

    single = frozen("near_duplicates", lines)
    want = {r[0] for r in sql("classes as (" + OP5_SQL + ")", "select doc_id from classes where doc_id = class_id", lines)}
    assert {r["doc_id"] for r in single.collect()} == want

    clean = frozen("decontamination", single)
    want = {r[0] for r in sql(CONTAMINATION_CTES, "select doc_id from contamination where not contaminated", single)}
    assert {r["doc_id"] for r in clean.collect()} == want

    packed = frozen("packing", clean).collect()
    assert check_packing(packed, {r["doc_id"]: r["text"] for r in clean.collect()}) == 0
    assert all(len(r["ids"]) == r["length"] for r in packed)


def test_pipeline_run(spark):
    rows = corpus_pipeline.run(spark, DATA)
    assert rows.count() > 0 and "sequence_id" in rows.columns


def test_cached_words_give_the_tokenizer_s_ids():
    encoder = Encoder(TOKENIZER, RANKS, added_tokens(TOKENIZER))
    alphabet = " \t\n\r\x0b\x0c\x1c\x85\xa0   　'sStTllremvd019²½Ⅷé漢字🤦🏼‍♂️_-#$%ñ​|<>"
    rng = np.random.default_rng(1)
    for _ in range(1500):
        text = "".join(alphabet[i] for i in rng.integers(0, len(alphabet), rng.integers(0, 30)))
        want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == want
    for text in ("a<|endoftext|>b", "x" * 20_000, "", "it's we'll  I'M"):
        want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == want


@pytest.mark.parametrize(
    "change", [{"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"pre_tokenizer": None}]
)
def test_tokenizers_that_split_otherwise_are_refused(tmp_path, change):
    import json

    with open(TOKENIZER, encoding="utf-8") as file:
        settings = json.load(file)
    settings["model"]["vocab"], settings["model"]["merges"] = {}, []
    other = tmp_path / "tokenizer.json"
    other.write_text(json.dumps(settings))
    assert added_tokens(str(other)) == added_tokens(TOKENIZER)
    other.write_text(json.dumps(settings | change))
    with pytest.raises(ValueError, match="byte-level"):
        added_tokens(str(other))
