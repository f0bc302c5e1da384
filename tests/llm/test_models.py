"""Learned operators against plain computation: every weight, feature and vote."""

from __future__ import annotations

import math
import re
import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.llm import boosted_toxicity, byte_cnn, neighbour_quality
from tallyforge.llm.arrow_text import pieces
from tallyforge.llm.byte_cnn import DIMS, FILTERS, WIDTHS, ByteCnn, filter_mask, slopes
from tallyforge.llm.neighbour_quality import NEIGHBOURS, SHARPNESS, STEPS, TERMS, TRIGRAMS, Voters, trigram_counts
from tests.conftest import DATA


def network(languages=3, seed=0):
    rng = np.random.default_rng(seed)
    many = len(WIDTHS) * FILTERS
    return ByteCnn(
        [f"l{i}" for i in range(languages)],
        rng.normal(size=(256, DIMS)),
        rng.normal(size=(max(WIDTHS) * DIMS, many)) * filter_mask(),
        rng.normal(size=many),
        rng.normal(size=(many, languages)),
        rng.normal(size=languages),
    )


def by_loops(net, codes):
    """Convolution, maximum and softmax, one number at a time."""
    out = []
    for x in codes:
        hidden = []
        for f in range(len(net.bias)):
            width = WIDTHS[f // FILTERS]
            best = -math.inf
            for at in range(len(x) - max(WIDTHS) + 1):
                total = 0.0
                for k in range(width):
                    for dim in range(DIMS):
                        total += net.embedding[x[at + k], dim] * net.filters[k * DIMS + dim, f]
                best = max(best, total)
            hidden.append(max(best + net.bias[f], 0.0))
        scores = [sum(h * net.dense[i, c] for i, h in enumerate(hidden)) + net.offset[c] for c in range(len(net.offset))]
        e = [math.exp(s - max(scores)) for s in scores]
        out.append([v / sum(e) for v in e])
    return np.array(out)


def test_network_equals_loops():
    net = network()
    codes = np.random.default_rng(1).integers(0, 256, (3, 12)).astype(np.uint8)
    assert np.allclose(net.probabilities(codes), by_loops(net, codes))


def test_slopes_equal_differences():
    net = network(seed=2)
    rng = np.random.default_rng(3)
    codes, target = rng.integers(0, 256, (5, 10)).astype(np.uint8), rng.integers(0, 3, 5)
    loss = lambda: -np.log(net.probabilities(codes)[np.arange(5), target]).mean()
    found = slopes(net, codes, target)
    for name, slope in found.items():
        weights = getattr(net, name)
        used = np.argwhere(np.abs(slope) > 1e-4)
        assert len(used)
        for at in map(tuple, used[rng.permutation(len(used))[:12]]):
            before, step = weights[at], 1e-5
            weights[at] = before + step
            above = loss()
            weights[at] = before - step
            below = loss()
            weights[at] = before
            assert slope[at] == pytest.approx((above - below) / (2 * step), rel=1e-3, abs=1e-6), name
    assert not found["filters"][filter_mask() == 0].any()


def test_languages_are_means_over_all_windows(spark):
    net = network()
    text = "abc é " * 100 + "end"
    docs = spark.createDataFrame([(1, text), (2, "ab"), (3, "!!")], "doc_id long, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in byte_cnn.predict_languages(docs, net, lot=2).collect()}
    raw = np.frombuffer(text.encode(), np.uint8)
    _, begin, end = pieces(np.array([0]), np.array([len(raw)]), byte_cnn.WINDOW)
    assert len(begin) > 2
    each = by_loops(net, byte_cnn.windows(raw, begin, end, byte_cnn.WINDOW))
    mean = (each * (end - begin)[:, None]).sum(0) / (end - begin).sum()
    assert got[1] == (f"l{mean.argmax()}", pytest.approx(mean.max(), abs=1e-6)) and got[3] == ("und", 0.0)


def plain_features(text, lexicon, stems):
    """The features in words and counts."""
    text = text or ""
    words = [w for w in re.split(r"[^\w@$*']+|_+", text.lower()) if w]
    plain = lambda w: w.translate(str.maketrans(boosted_toxicity.DISGUISE, boosted_toxicity.PLAIN)) if re.search("[0-9@$]", w) else w
    hits = [i for i, w in enumerate(words) if plain(w) in lexicon]
    stemmed = sum(w[: boosted_toxicity.STEM_LETTERS] in stems for w in words)
    you = set(boosted_toxicity.SECOND_PERSON)
    near = [i for i in hits if you & set(words[max(i - 3, 0) : max(i - 3, 0) + 7])]
    n, chars = max(len(words), 1), max(len(text), 1)
    return [
        100 * len(hits) / n,
        len({plain(words[i]) for i in hits}),
        min(len(hits), 50),
        100 * stemmed / n,
        min(stemmed, 50),
        100 * len(near) / n,
        100 * sum(w in you for w in words) / n,
        sum(c.isupper() for c in text) / chars,
        100 * len(re.findall("[A-ZÉÑÜ]{3,}", text)) / n,
        100 * text.count("!") / n,
        100 * text.count("?") / n,
        100 * len(re.findall("[#*$%&|<>]", text)) / n,
        100 * len(re.findall(r"[^\W\d_][0-9@$*]+[^\W\d_]", text)) / n,
        math.log1p(len(words)),
    ]


def test_every_toxicity_feature_equals_plain_python(spark):
    lexicon, stems = ["fool", "idiot", "trash"], ["stupid"]
    texts = [
        "",
        None,
        "You are a F00L and an idiot! your tr@sh",
        "nothing of that kind, is there? no",
        "idiot " * 70,
        "stupidity STUPIDLY stupid ÉÉÉ ABC a#b %$& you",
        "one two three fool five six seven eight you nine",
        "fool one two you three four five you fool",
        "ñandú él été naïve s4d p@in b*d 4 you",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    rows = docs.select("i", boosted_toxicity.features(F.col("text"), lexicon, stems).alias("f")).collect()
    for r in rows:
        want = plain_features(texts[r["i"]], set(lexicon), set(stems))
        got = [r["f"][name] for name in boosted_toxicity.FEATURES]
        assert got == pytest.approx(want), (texts[r["i"]], dict(zip(boosted_toxicity.FEATURES, zip(got, want))))


def test_calibration_is_linear_between_its_points(spark):
    model = boosted_toxicity.ToxicityModel([], [], None, ([0.1, 0.3, 0.3, 0.8], [0.0, 0.2, 0.5, 0.9]), 0.0)
    rows = [(float(x),) for x in (0, 0.1, 0.2, 0.3, 0.55, 0.8, 1)]
    out = spark.createDataFrame(rows, "raw double").select(model.calibrated(F.col("raw")).alias("y")).collect()
    assert [r["y"] for r in out] == pytest.approx([0.0, 0.0, 0.1, 0.5, 0.7, 0.9, 0.9])


def test_trigram_counts_equal_loops():
    texts = ["ab", "", "abcabc", "the the cat cat cat sat", "ééé"]
    raw = [t.encode() for t in texts]
    ends = np.cumsum([len(r) for r in raw])
    counts = trigram_counts(np.frombuffer(b"".join(raw), np.uint8), ends - [len(r) for r in raw], ends)
    for row, r, text in zip(counts, raw, texts):
        want = np.zeros(TERMS)
        for i in range(len(r) - 2):
            code = r[i] << 16 | r[i + 1] << 8 | r[i + 2]
            want[(code * 2654435761 % (1 << 32)) >> 20] += 1
        words = text.split()
        want[TRIGRAMS] = sum(a == b for a, b in zip(words, words[1:])) / max(len(words), 1)
        assert np.allclose(row, want)


def test_votes_equal_a_loop_over_all_voters_with_ties_by_id():
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(90, 8)).astype(np.float32)
    vectors[30:60] = vectors[:30]  # exact copies: similarities tie
    vectors[60:] = vectors[3]
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    labels = rng.integers(0, 2, 90).astype(np.float64)
    panel = Voters(np.ones(TERMS, np.float32), np.zeros((TERMS, 8), np.float32), vectors, labels, 0.25)
    asked = np.vstack([vectors[[0, 3, 17]], rng.normal(size=(20, 8)).astype(np.float32), np.zeros((1, 8), np.float32)])
    asked = asked / np.maximum(np.linalg.norm(asked, axis=1, keepdims=True), 1e-9)
    panel.place = lambda counts: counts
    got = panel.scores(asked.astype(np.float32))
    for x, score in zip(asked.astype(np.float32), got):
        near = sorted((-round(float(np.dot(x, v)) * STEPS), i) for i, v in enumerate(vectors))[:NEIGHBOURS]
        votes = [(max(-s, 0) / STEPS) ** SHARPNESS for s, _ in near]
        want = sum(v * labels[i] for v, (_, i) in zip(votes, near)) / sum(votes) if sum(votes) > 0 else 0.25
        assert score == pytest.approx(want, abs=1e-4)
    # The order in which texts arrive changes nothing.
    assert (panel.scores(asked[::-1].astype(np.float32))[::-1] == got).all()


def test_quality_learns_from_ids_of_any_type(spark):
    rows = [(f"d{i}", ("good words in a row " if i % 2 else "bad bad bad bad ") * 5 + str(i)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    labels = spark.createDataFrame([(f"d{i}", i % 2, 0) for i in range(60)], "doc_id string, quality int, toxic int")
    got = neighbour_quality.score_quality(docs, labels).collect()
    assert len(got) == 60 and all(r["predicted"] == int(r["doc_id"][1:]) % 2 for r in got)
    assert all(r["held_out"] == (zlib.crc32(r["doc_id"].encode()) % 5 == 0) for r in got)


def test_executors_need_not_have_the_package(tmp_path):
    """From another folder, with the repository on the driver's path alone."""
    root = Path(__file__).resolve().parents[2]
    code = f"""
import sys
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "2").config("spark.ui.showConsoleProgress", "false").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
def absent(rows):
    try:
        import tallyforge
        yield 0
    except ImportError:
        yield 1
assert spark.sparkContext.parallelize(range(2), 2).mapPartitions(absent).collect() == [1, 1]
sys.path.insert(0, {str(root)!r})
from tallyforge.llm.queries import QUERIES
for name in ("op1_language_cnn", "op8_neighbour_quality", "op11_trie_audit", "op12_secret_owners", "op13_exact_whitening"):
    assert QUERIES[name](spark, {DATA!r}).count() > 0
"""
    environment = {"PATH": "/usr/bin:/bin", "HOME": str(tmp_path), "PYSPARK_PYTHON": sys.executable}
    import os

    environment |= {k: v for k, v in os.environ.items() if k in ("JAVA_HOME", "PATH", "SPARK_HOME")}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=environment, check=True, timeout=300)


