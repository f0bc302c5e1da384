"""Toxicity scores by gradient-boosted trees over a few dense features, with isotonic calibration.

The features are computed from the whole text in DataFrame functions: densities of a lexicon that is
learned from the labels, closeness of its words to the second person, capitals, punctuation, and
words with characters swapped to hide them. Trees and calibration are fitted by MLlib to separate
parts of a bounded sample of labelled texts.

Defined results: a null text counts as empty and is scored like any other; with fewer than two
classes of usable labels every score is the mean label (0 without labels). Labels other than 0 and 1
are ignored. Repeated rows each get their own result; an empty table gives an empty result. Texts of any
length are described whole. Words that speak equally for label 1 are listed in alphabetical order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, functions as F

from tallyforge.llm.tables import let, split_of

#: Labelled texts learned from, at most about.
SAMPLE = 12000
LEXICON = 400
MIN_TEXTS = 4
#: Word beginnings that are listed as well, for insults with many endings.
STEMS = 64
STEM_LETTERS = 6
MIN_STEM_TEXTS = 10
ACCEPT = 0.3

# Second-person words of English, French, German and Spanish.
SECOND_PERSON = (
    "you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine euch ihr "
    "ti tus usted ustedes vosotros"
).split()

#: Letters, digits and the characters that stand in for letters.
NOT_WORD = r"[^\p{L}\p{N}@$*']+"
DISGUISED = r"\p{L}[0-9@$*]+\p{L}"
# Characters and the letters they stand in for.
DISGUISE, PLAIN = "013457@$", "oleastas"

FEATURES = (
    "lexicon_rate",
    "lexicon_kinds",
    "lexicon_hits",
    "stem_rate",
    "stem_hits",
    "address_rate",
    "person_rate",
    "capital_rate",
    "shout_rate",
    "exclamation_rate",
    "question_rate",
    "symbol_rate",
    "disguise_rate",
    "log_words",
)


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def undisguised(word: Column) -> Column:
    return F.when(word.rlike("[0-9@$]"), F.translate(word, DISGUISE, PLAIN)).otherwise(word)


def stem(word: Column) -> Column:
    return F.substring(word, 1, STEM_LETTERS)


def features(text: Column, lexicon: list[str], stems: list[str]) -> Column:
    """One struct of ``FEATURES`` for a text."""
    plain = F.coalesce(text, F.lit(""))
    per = lambda n, of: (n / F.greatest(of, F.lit(1))).cast("double")
    count = lambda pattern: F.regexp_count(plain, F.lit(pattern))
    listed = lambda w: undisguised(w).isin(lexicon) if lexicon else F.lit(False)

    def of_hits(ws: Column, hits: Column) -> Column:
        n, chars = F.size(ws), F.length(plain)
        stemmed = F.size(F.filter(ws, lambda w: stem(w).isin(stems))) if stems else F.lit(0)
        # A hit counts as an address if a second-person word is within three words of it.
        near = F.filter(
            hits,
            lambda i: F.arrays_overlap(
                F.slice(ws, F.greatest(i - 2, F.lit(1)), F.lit(7)), F.array(*map(F.lit, SECOND_PERSON))
            ),
        )
        kinds = F.size(F.array_distinct(F.transform(hits, lambda i: undisguised(F.get(ws, i)))))
        columns = (
            per(100 * F.size(hits), n),
            kinds.cast("double"),
            F.least(F.size(hits), F.lit(50)).cast("double"),
            per(100 * stemmed, n),
            F.least(stemmed, F.lit(50)).cast("double"),
            per(100 * F.size(near), n),
            per(100 * F.size(F.filter(ws, lambda w: w.isin(SECOND_PERSON))), n),
            per(count(r"\p{Lu}"), chars),
            per(100 * count(r"\p{Lu}{3,}"), n),
            per(100 * count("!"), n),
            per(100 * count(r"\?"), n),
            per(100 * count("[#*$%&|<>]"), n),
            per(100 * count(DISGUISED), n),
            F.log1p(n).cast("double"),
        )
        return F.struct(*[c.alias(name) for c, name in zip(columns, FEATURES)])

    places = lambda ws: F.filter(
        F.transform(ws, lambda w, i: F.when(listed(w), i)), lambda i: i.isNotNull()
    )
    return let(tokens(text), lambda ws: let(places(ws), lambda hits: of_hits(ws, hits)))


def learn_lexicon(labelled: DataFrame, size: int = LEXICON) -> list[str]:
    """The words whose presence speaks most for label 1, by smoothed log odds."""
    seen = labelled.select("label", F.explode(F.array_distinct(tokens(F.col("text")))).alias("word"))
    totals = labelled.agg(
        F.sum(F.col("label")).alias("bad"), F.sum(1 - F.col("label")).alias("good")
    ).first()
    bad, good = totals["bad"] or 0, totals["good"] or 0
    counts = seen.groupBy(undisguised(F.col("word")).alias("word")).agg(
        F.sum("label").alias("in_bad"), F.sum(1 - F.col("label")).alias("in_good")
    )
    odds = F.log((F.col("in_bad") + 0.5) / (bad + 1)) - F.log((F.col("in_good") + 0.5) / (good + 1))
    # Words of few texts and words that only lean towards label 1 are left out.
    strong = counts.where((F.col("in_bad") >= MIN_TEXTS) & (odds > 2.5))
    best = strong.orderBy((odds * F.sqrt("in_bad")).desc(), "word").limit(size)
    return [r["word"] for r in best.select("word").collect()]


def learn_stems(labelled: DataFrame, size: int = STEMS) -> list[str]:
    """The word beginnings that are much more frequent, by occurrence, in texts of label 1."""
    words = labelled.select("label", F.explode(tokens(F.col("text"))).alias("word"))
    totals = words.agg(F.sum("label").alias("bad"), F.sum(1 - F.col("label")).alias("good")).first()
    bad, good = totals["bad"] or 0, totals["good"] or 0
    texts = (
        labelled.where("label = 1")
        .select(F.explode(F.array_distinct(F.transform(tokens(F.col("text")), stem))).alias("stem"))
        .groupBy("stem")
        .agg(F.count("*").alias("texts"))
        .where(F.col("texts") >= MIN_STEM_TEXTS)
    )
    counts = (
        words.where(F.length("word") >= STEM_LETTERS)
        .groupBy(stem(F.col("word")).alias("stem"))
        .agg(F.sum("label").alias("in_bad"), F.sum(1 - F.col("label")).alias("in_good"))
    )
    odds = F.log((F.col("in_bad") + 0.5) / (bad + 1)) - F.log((F.col("in_good") + 0.5) / (good + 1))
    best = counts.join(texts, "stem").where(odds > 1.2).orderBy((odds * F.sqrt("in_bad")).desc(), "stem")
    return [r["stem"] for r in best.limit(size).select("stem").collect()]


@dataclass
class ToxicityModel:
    lexicon: list[str]
    stems: list[str]
    trees: GBTClassificationModel | None
    steps: tuple[list[float], list[float]]
    mean: float

    def calibrated(self, raw: Column) -> Column:
        """The calibration curve at ``raw``: linear between its points, flat outside them."""
        xs, ys = (F.lit([float(v) for v in s]) for s in self.steps)
        last = len(self.steps[0])

        def between(i: Column) -> Column:
            x0, x1, y0, y1 = F.get(xs, i - 1), F.get(xs, i), F.get(ys, i - 1), F.get(ys, i)
            inside = y0 + (raw - x0) / (x1 - x0) * (y1 - y0)
            return F.when(i == 0, F.get(ys, F.lit(0))).when(i == last, F.get(ys, F.lit(last - 1))).otherwise(inside)

        return let(F.size(F.filter(xs, lambda x: x <= raw)), between)


def vectors(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=[f"f.{n}" for n in FEATURES], outputCol="features").transform(rows)


def fit_toxicity(labels: DataFrame, docs: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> ToxicityModel:
    """Lexicon, trees and calibration from at most about ``sample`` labelled texts."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    share = min(1.0, sample / max(1, usable.count()))
    drawn = (
        usable.where(F.pmod(F.xxhash64("doc_id", F.lit(label)), F.lit(1 << 20)) < share * (1 << 20))
        .select("doc_id", F.col(label).cast("int").alias("label"))
        .limit(2 * sample)
    )
    known = (
        docs.select("doc_id", "text")
        .join(F.broadcast(drawn), "doc_id")  # at most 2 * sample rows
        .limit(4 * sample)
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        mean = known.agg(F.avg("label")).first()[0]
        if mean is None or mean in (0, 1):
            return ToxicityModel([], [], None, ([], []), mean or 0.0)
        # Words and trees are learned from one part, the calibration from the other.
        for_trees = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(10)) < 7
        lexicon, stems = learn_lexicon(known.where(for_trees)), learn_stems(known.where(for_trees))
        described = known.select(
            "doc_id",
            "label",
            for_trees.alias("for_trees"),
            features(F.col("text"), lexicon, stems).alias("f"),
        )
        rows = vectors(described).select("doc_id", "label", "for_trees", "features")
        rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            trees = GBTClassifier(
                featuresCol="features", labelCol="label", maxIter=20, maxDepth=3, stepSize=0.2, seed=5
            ).fit(rows.where("for_trees"))
            judged = trees.transform(rows.where("not for_trees")).select(
                vector_to_array("probability")[1].alias("raw"), F.col("label").cast("double").alias("label")
            )
            if judged.isEmpty():
                return ToxicityModel(lexicon, stems, trees, ([0.0, 1.0], [0.0, 1.0]), mean)
            curve = IsotonicRegression(featuresCol="raw", labelCol="label").fit(judged)
            steps = (list(curve.boundaries), list(curve.predictions))
            return ToxicityModel(lexicon, stems, trees, tuple([float(v) for v in s] for s in steps), mean)
        finally:
            rows.unpersist()
    finally:
        known.unpersist()


def score_texts(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """``docs`` with the column ``toxicity``, between 0 and 1."""
    if model.trees is None:
        return docs.withColumn("toxicity", F.lit(float(model.mean)))
    columns = [c for c in docs.columns if c != "toxicity"]
    rows = docs.select(F.struct(*columns).alias("row"), features(F.col(text), model.lexicon, model.stems).alias("f"))
    judged = model.trees.transform(vectors(rows))
    raw = vector_to_array("probability")[1]
    return (
        judged.select("row", raw.alias("raw"))
        .select("row.*", F.least(F.greatest(model.calibrated(F.col("raw")), F.lit(0.0)), F.lit(1.0)).alias("toxicity"))
    )


def score_toxicity(docs: DataFrame, labels: DataFrame, parts: int = 4, part: int = 2) -> DataFrame:
    """Learn from labels outside the held-out part; score every document."""
    held = F.coalesce(split_of(F.col("doc_id"), parts) == part, F.lit(False))
    model = fit_toxicity(labels.where(~held), docs)
    return score_texts(docs.select("doc_id", "text"), model).select(
        "doc_id",
        held.alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= ACCEPT).cast("int").alias("predicted"),
    )
