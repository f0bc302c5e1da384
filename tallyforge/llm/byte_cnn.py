"""Language identification by a small convolutional network over bytes, trained in numpy.

Bytes are embedded, filters of several widths slide over them, each filter keeps its largest
response in a window, and a softmax layer turns the responses into language probabilities. A text
is cut into windows of a fixed length, all of which are scored in batches; the text's probabilities
are the mean over its windows, weighted by their length.

Defined results: null texts and texts without a letter are ``und`` with score 0; so is everything if
there is no labelled text to learn from. Rows with a null id are never learned from and not held
out. Repeated rows each get their own result. Of equally likely languages the first by name is
taken. Texts of any length are read whole, window by window. Only the named columns are read, so
others may have any name; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyforge.llm.arrow_text import pieces, text_bytes
from tallyforge.llm.tables import modest_batches, split_of

WIDTHS = (2, 3, 4)
FILTERS = 12
DIMS = 8
WINDOW = 256
#: Training windows are shorter, so that short texts are learned as well.
TRAIN_WINDOW = 96
#: Labelled texts learned from, per language, and windows taken from each.
TEXTS_PER_LANGUAGE = 600
WINDOWS_PER_TEXT = 3
MAX_LANGUAGES = 1000
UNKNOWN = "und"

#: A to Z are read as a to z; zero is the padding.
FOLDED = np.arange(256, dtype=np.uint8)
FOLDED[65:91] += 32


@dataclass
class ByteCnn:
    """Weights of the network; all filters share one matrix, narrow ones end in zeros."""

    languages: list[str]
    embedding: np.ndarray  # 256 x DIMS
    filters: np.ndarray  # max(WIDTHS) * DIMS x len(WIDTHS) * FILTERS
    bias: np.ndarray
    dense: np.ndarray
    offset: np.ndarray

    def patches(self, codes: np.ndarray) -> np.ndarray:
        """Embedded byte runs of the largest width, at each position of each window."""
        wide = max(WIDTHS)
        embedded = self.embedding[codes].reshape(len(codes), -1)
        views = np.lib.stride_tricks.sliding_window_view(embedded, wide * DIMS, axis=1)
        return np.ascontiguousarray(views[:, ::DIMS])

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        patches = self.patches(codes)
        n, at, size = patches.shape
        responses = (patches.reshape(-1, size) @ self.filters).reshape(n, at, -1).max(1)
        return softmax(np.maximum(responses + self.bias, 0) @ self.dense + self.offset)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def windows(data: np.ndarray, begin: np.ndarray, end: np.ndarray, width: int) -> np.ndarray:
    """The bytes of the given ranges as rows of ``width`` codes, padded with zeros."""
    at = begin[:, None] + np.arange(width)
    inside = at < end[:, None]
    return np.where(inside, FOLDED[data[np.where(inside, at, 0)]] if len(data) else 0, 0).astype(np.uint8)


def filter_mask() -> np.ndarray:
    rows = np.arange(max(WIDTHS) * DIMS)[:, None]
    return (rows < np.repeat(WIDTHS, FILTERS)[None, :] * DIMS).astype(np.float32)


def slopes(model: ByteCnn, x: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
    """The mean cross-entropy's derivative by each weight, for windows ``x`` of languages ``target``."""
    wide, n_filters = max(WIDTHS), len(model.bias)
    patches = model.patches(x)
    responses = (patches.reshape(-1, patches.shape[2]) @ model.filters).reshape(len(x), patches.shape[1], -1)
    where = responses.argmax(1)  # windows x filters
    rows = np.arange(len(x))[:, None]
    raw = responses[rows, where, np.arange(n_filters)] + model.bias
    hidden = np.maximum(raw, 0)
    error = softmax(hidden @ model.dense + model.offset)
    error[np.arange(len(x)), target] -= 1
    error /= len(x)
    back = (error @ model.dense.T) * (raw > 0)
    chosen = patches[rows, where]  # windows x filters x patch
    into = (back[:, :, None] * model.filters.T[None]).reshape(len(x), n_filters, wide, DIMS)
    byte_at = x[rows[:, :, None], where[:, :, None] + np.arange(wide)]
    to_bytes = np.zeros_like(model.embedding)
    np.add.at(to_bytes, byte_at.ravel(), into.reshape(-1, DIMS))
    return {
        "embedding": to_bytes,
        "filters": np.einsum("bf,bfp->pf", back, chosen) * filter_mask(),
        "bias": back.sum(0),
        "dense": hidden.T @ error,
        "offset": error.sum(0),
    }


def train(codes: np.ndarray, target: np.ndarray, languages: list[str], epochs: int = 8) -> ByteCnn:
    """Fit the network to windows of bytes by Adam steps on the cross-entropy."""
    rng = np.random.default_rng(7)
    mask, n_filters = filter_mask(), len(WIDTHS) * FILTERS
    draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
    model = ByteCnn(
        languages,
        draw(256, DIMS, scale=0.5),
        draw(max(WIDTHS) * DIMS, n_filters, scale=0.25) * mask,
        np.zeros(n_filters, np.float32),
        draw(n_filters, len(languages), scale=0.2),
        np.zeros(len(languages), np.float32),
    )
    names = ("embedding", "filters", "bias", "dense", "offset")
    first = {k: np.zeros_like(getattr(model, k)) for k in names}
    second = {k: np.zeros_like(getattr(model, k)) for k in names}
    step, size = 0, 64
    for _ in range(epochs):
        order = rng.permutation(len(codes))
        for lot in (order[i : i + size] for i in range(0, len(order), size)):
            step += 1
            for k, g in slopes(model, codes[lot], target[lot]).items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                scaled = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                getattr(model, k)[...] -= 0.01 * scaled
    return model


def fit_languages(
    labelled: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    texts_per_language: int = TEXTS_PER_LANGUAGE,
) -> ByteCnn | None:
    """Train on a sample of about ``texts_per_language`` texts of each language.

    The sample is drawn by a hash of key and text, so it is the same on every run. None if there is
    no labelled text with a letter.
    """
    rows = labelled.select(
        F.col(key).alias("key"), F.col(text).alias("body"), F.col(lang).alias("language")
    ).where("language is not null and body rlike '\\\\p{L}'")
    counts = {
        r["language"]: r["count"] for r in rows.groupBy("language").count().limit(MAX_LANGUAGES + 1).collect()
    }
    if not counts:
        return None
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    share = F.create_map(
        *[F.lit(x) for k, n in sorted(counts.items()) for x in (k, min(1.0, texts_per_language / n))]
    )
    drawn = F.pmod(F.xxhash64("key", "body"), F.lit(1 << 20)) < F.element_at(share, F.col("language")) * (1 << 20)
    length = F.length("body")
    # Windows begin at places spread over the whole text.
    parts = F.array(
        *[
            F.substring(
                "body",
                (F.pmod(F.xxhash64("key", "body", F.lit(i)), F.greatest(length - TRAIN_WINDOW, F.lit(1))) + 1).cast("int"),
                F.lit(TRAIN_WINDOW),
            )
            for i in range(WINDOWS_PER_TEXT)
        ]
    )
    sample = (
        rows.where(drawn)
        .select("key", "language", parts.alias("parts"))
        .limit(2 * texts_per_language * len(counts))
        .toArrow()
        .to_pylist()
    )
    sample.sort(key=lambda r: (str(r["key"]), r["language"], r["parts"]))
    languages = sorted(counts)
    texts = [p.encode()[:TRAIN_WINDOW] for r in sample for p in r["parts"]]
    target = np.array([languages.index(r["language"]) for r in sample for _ in r["parts"]])
    lengths = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    begin = np.cumsum(lengths) - lengths
    return train(windows(data, begin, begin + lengths, TRAIN_WINDOW), target, languages)


def predict_languages(
    docs: DataFrame,
    model: ByteCnn | None,
    key: str = "doc_id",
    text: str = "text",
    lot: int = 128,
) -> DataFrame:
    """``key``, the likeliest language of each whole text and its probability."""
    rows = docs.select(
        F.col(key).alias("key"),
        F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("has_letter"),
        F.col(text).alias("body"),
    )
    kind = dict(rows.dtypes)["key"]
    modest_batches(docs.sparkSession)
    # Plain arrays and lists, which executors without this package can read.
    shared = docs.sparkSession.sparkContext.broadcast(None if model is None else vars(model))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = None if shared.value is None else ByteCnn(**shared.value)
        for batch in batches:
            data, starts, ends = text_bytes(batch.column("body"))
            letters = np.asarray(batch.column("has_letter"), dtype=bool)
            names = np.full(len(letters), UNKNOWN, dtype=object)
            best = np.zeros(len(letters))
            if net is not None and letters.any():
                which = np.flatnonzero(letters)
                owner, begin, end = pieces(starts[which], ends[which], WINDOW)
                total = np.zeros((len(which), len(net.languages)))
                for i in range(0, len(owner), lot):
                    part = slice(i, i + lot)
                    codes = windows(data, begin[part], end[part], WINDOW)
                    weighted = net.probabilities(codes) * (end[part] - begin[part])[:, None]
                    np.add.at(total, owner[part], weighted)
                total /= total.sum(1, keepdims=True)
                names[which] = np.array(net.languages, dtype=object)[total.argmax(1)]
                best[which] = total.max(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(names, pa.string()), pa.array(np.round(np.minimum(best, 1.0), 6))],
                names=["key", "lang_pred", "score"],
            )

    return rows.mapInArrow(score, f"key {kind}, lang_pred string, score double").withColumnRenamed("key", key)


def identify(docs: DataFrame, parts: int = 4, held_out_part: int = 2) -> DataFrame:
    """Learn from the rows outside the held-out part and predict the language of every row."""
    held = F.coalesce(split_of(F.col("doc_id"), parts) == held_out_part, F.lit(False))
    model = fit_languages(docs.where(F.col("doc_id").isNotNull() & ~held))
    return predict_languages(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")
