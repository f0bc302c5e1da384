"""Quality scores by a vote of the nearest labelled texts in a latent semantic space.

Texts are counted as hashed byte trigrams, weighted by term and document frequency, joined by one
term for words that repeat the word before them, and projected to a few latent dimensions found by a
truncated singular value decomposition of labelled texts. The
labelled vectors, a bounded set, are broadcast; every document is compared with all of them by
blocked matrix products, and its nearest ones vote with their similarity. Similarities are rounded to
five digits, and of equally near texts those with the smaller id vote.

Defined results: a null text counts as empty; a text without a trigram gets the mean label of the
labelled texts that have none either, or 0 if there are none; without labelled texts every score is
0. Labels other than 0 and 1 are ignored. Repeated rows each get their own result. Texts of any length are
counted whole; an empty table gives an empty result. Ids may have any type that can be ordered.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyforge.llm.arrow_text import by_size, text_bytes
from tallyforge.llm.tables import modest_batches, split_of, unused

TRIGRAMS = 4096
#: The hashed trigrams and the share of words that repeat the word before them.
TERMS = TRIGRAMS + 1
#: Weight of that share beside the trigrams, which have length 1 together.
ECHO_WEIGHT = 3.0
DIMS = 48
NEIGHBOURS = 15
#: Similarities are told apart in so many steps.
STEPS = 100_000
#: Similarity is raised to this power, so that close neighbours count for much more.
SHARPNESS = 8
#: Labelled texts that vote, at most about.
VOTERS = 3000
ACCEPT = 0.3


def trigram_counts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How often each hashed byte trigram occurs in each of a few texts, which lie back to back."""
    first, sizes = int(starts[0]), ends - starts
    codes = data[first : int(ends[-1])].astype(np.uint32)
    counts = np.zeros((len(starts), TERMS), np.float32)
    if len(codes) < 3:
        return counts
    hashed = (codes[:-2] << 16 | codes[1:-1] << 8 | codes[2:]) * np.uint32(2654435761) >> np.uint32(20)
    owner = np.repeat(np.arange(len(starts)), sizes)[:-2]
    whole = np.arange(len(hashed)) + 3 <= (ends - first)[owner]
    size = len(starts) * TRIGRAMS
    found = np.bincount(owner[whole] * TRIGRAMS + hashed[whole], minlength=size)
    counts[:, :TRIGRAMS] = found.reshape(-1, TRIGRAMS)
    counts[:, TRIGRAMS] = echo_share(data[first : int(ends[-1])], starts - first, ends - first)
    return counts


def echo_share(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The share of each text's words that equal the word before them."""
    inside = codes > 32
    fresh = np.zeros(len(codes) + 1, bool)
    fresh[starts] = True
    opens = inside & (fresh[:-1] | ~np.append(False, inside[:-1]))
    begin = np.flatnonzero(opens)
    if not len(begin):
        return np.zeros(len(starts), np.float32)
    place = np.arange(len(codes), dtype=np.uint32)
    place -= np.repeat(np.append(0, begin).astype(np.uint32), np.diff(np.concatenate([[0], begin, [len(codes)]])))
    signs = np.where(inside, BYTE_MARKS[codes] * (2 * place + 1) * (place + 7), np.uint32(0))
    word = np.add.reduceat(signs, begin, dtype=np.uint32)
    owner = np.searchsorted(ends, begin, "right")
    same = (word[1:] == word[:-1]) & (owner[1:] == owner[:-1])
    n = np.bincount(owner, minlength=len(starts))
    return (np.bincount(owner[1:][same], minlength=len(starts)) / np.maximum(n, 1)).astype(np.float32)


#: A random number for each byte, to tell words apart.
BYTE_MARKS = np.random.default_rng(3).integers(1, 1 << 32, 256, dtype=np.uint32)


def counted(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, most: int = 1 << 19) -> Iterator:
    """Counts of consecutive texts in lots of about ``most`` bytes; nulls have been made empty."""
    for part in by_size(np.maximum(ends - starts, most // 256), most):
        if (ends[part] - starts[part]).sum() == 0:
            yield part, np.zeros((part.stop - part.start, TERMS), np.float32)
        else:
            yield part, trigram_counts(data, starts[part], ends[part])


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[int, np.ndarray]:
    """The number of texts, and of those that contain each hashed trigram; over all texts."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, texts = np.zeros(TERMS, np.int64), 0
        for batch in batches:
            for _, counts in counted(*text_bytes(batch.column(0))):
                total += (counts > 0).sum(0)
                texts += len(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(TERMS + 1)), pa.array(np.append(total, texts))], names=["term", "n"]
        )

    rows = (
        docs.select(F.coalesce(F.col(text), F.lit("")).alias("body"))
        .mapInArrow(partial, "term long, n long")
        .groupBy("term")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    found = np.zeros(TERMS + 1, np.int64)
    found[rows["term"].to_numpy()] = rows["n"].to_numpy()
    return int(found[-1]), found[:-1]


@dataclass
class Voters:
    """Labelled latent vectors and what is needed to place other texts among them."""

    weights: np.ndarray  # inverse document frequency of each term
    basis: np.ndarray  # TERMS x DIMS
    vectors: np.ndarray  # voters x DIMS, of length 1
    labels: np.ndarray
    empty_score: float

    def place(self, counts: np.ndarray) -> np.ndarray:
        return unit(weighted(counts, self.weights) @ self.basis)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        vectors = self.place(counts)
        near = np.rint((vectors @ self.vectors.T) * STEPS).astype(np.int64)
        many = near.shape[1]
        k = min(NEIGHBOURS, many)
        # Voters are in the order of their ids; the smaller one counts as nearer.
        place = near * many + np.arange(many)[::-1]
        top = np.sort(np.argpartition(-place, k - 1, axis=1)[:, :k], axis=1)
        votes = (np.maximum(np.take_along_axis(near, top, 1), 0) / STEPS) ** SHARPNESS
        total = votes.sum(1)
        score = (votes * self.labels[top]).sum(1) / np.where(total > 0, total, 1)
        # Rounded, since sums in another order differ in the last digits.
        return np.round(np.where(total > 0, np.clip(score, 0, 1), self.empty_score), 6)


def unit(x: np.ndarray) -> np.ndarray:
    length = np.sqrt((x * x).sum(1, keepdims=True))
    return x / np.where(length > 0, length, 1)


def weighted(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    placed = np.empty_like(counts)
    placed[:, :TRIGRAMS] = unit(np.log1p(counts[:, :TRIGRAMS]) * weights[:TRIGRAMS])
    placed[:, TRIGRAMS] = ECHO_WEIGHT * counts[:, TRIGRAMS]
    return unit(placed)


def latent_basis(x: np.ndarray, dims: int = DIMS) -> np.ndarray:
    """The leading right singular vectors of ``x``, by randomised subspace iteration."""
    draws = np.random.default_rng(11).normal(size=(x.shape[1], dims + 16)).astype(np.float32)
    for _ in range(4):
        span, _ = np.linalg.qr(x @ draws)
        draws, _ = np.linalg.qr(x.T @ span)
    _, _, right = np.linalg.svd(x @ draws, full_matrices=False)
    return np.ascontiguousarray((draws @ right.T)[:, :dims].astype(np.float32))


def labelled_counts(labels: DataFrame, docs: DataFrame, label: str, voters: int) -> tuple[np.ndarray, np.ndarray]:
    """Trigram counts and labels of a sample of labelled texts, drawn by a hash of their id."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    share = min(1.0, voters / max(1, usable.count()))
    drawn = (
        usable.where(F.pmod(F.xxhash64("doc_id", F.lit(label)), F.lit(1 << 20)) < share * (1 << 20))
        .select("doc_id", F.col(label).cast("int").alias("label"))
        .limit(2 * voters)
    )

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, found = [], []
            for _, counts in counted(*text_bytes(batch.column("body"))):
                for row in counts:
                    at = np.flatnonzero(row)
                    terms.append(at.astype(np.int32))
                    found.append(row[at])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("label"),
                    pa.array(terms, pa.list_(pa.int32())),
                    pa.array(found, pa.list_(pa.float32())),
                ],
                names=["doc_id", "label", "terms", "counts"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    rows = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("body"))
        .join(F.broadcast(drawn), "doc_id")  # at most 2 * voters rows
        .select("doc_id", "label", "body")
        .limit(4 * voters)
        .mapInArrow(sparse, f"doc_id {kind}, label int, terms array<int>, counts array<float>")
        .toArrow()
        .sort_by([("doc_id", "ascending"), ("label", "ascending")])
    )
    x = np.zeros((rows.num_rows, TERMS), np.float32)
    for i, (terms, counts) in enumerate(zip(rows["terms"].to_pylist(), rows["counts"].to_pylist())):
        x[i, terms] = counts
    return x, rows["label"].to_numpy()


def fit_voters(labels: DataFrame, docs: DataFrame, label: str = "quality", voters: int = VOTERS) -> Voters | None:
    """Latent vectors of at most about ``voters`` labelled texts; statistics from all ``docs``."""
    modest_batches(docs.sparkSession)
    texts, frequencies = document_frequencies(docs)
    x, y = labelled_counts(labels, docs, label, voters)
    if not len(y):
        return None
    weights = np.log((1 + texts) / (1 + frequencies)).astype(np.float32) + np.float32(0.1)
    full = x.any(1)
    basis = latent_basis(weighted(x[full], weights)) if full.any() else np.zeros((TERMS, DIMS), np.float32)
    empty = float(y[~full].mean()) if (~full).any() else 0.0
    return Voters(weights, basis, unit(weighted(x[full], weights) @ basis), y[full].astype(np.float64), empty)


def vote(docs: DataFrame, voters: Voters | None, text: str = "text") -> DataFrame:
    """``docs`` with the column ``quality_score``, between 0 and 1."""
    modest_batches(docs.sparkSession)
    # Plain arrays, which executors without this package can read.
    shared = docs.sparkSession.sparkContext.broadcast(None if voters is None else vars(voters))
    kept = docs.drop("quality_score")
    to_score = unused("text_to_score", kept)
    plain = kept.withColumn(to_score, F.coalesce(F.col(text), F.lit("")))
    schema = ", ".join(f"`{n}` {t}" for n, t in kept.dtypes)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        panel = None if shared.value is None else Voters(**shared.value)
        for batch in batches:
            at = batch.schema.get_field_index(to_score)
            scores = np.zeros(batch.num_rows)
            if panel is not None:
                for part, counts in counted(*text_bytes(batch.column(at))):
                    scores[part] = panel.scores(counts) if len(panel.labels) else panel.empty_score
            kept = [i for i in range(batch.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in kept] + [pa.array(scores)],
                names=[batch.schema.names[i] for i in kept] + ["quality_score"],
            )

    return plain.mapInArrow(score, f"{schema}, quality_score double")


def held_out(parts: int = 5, part: int = 0):
    return F.coalesce(split_of(F.col("doc_id"), parts) == part, F.lit(False))


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from labels outside the held-out part; score every document."""
    voters = fit_voters(labels.where(~held_out()), docs)
    scored = vote(docs.select("doc_id", "text"), voters)
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= ACCEPT).cast("int").alias("predicted"),
    )
