"""Quality by a regularised quadratic discriminant over statistics of the text.

Each document is described by transformed shares and logarithms (STATISTICS): how long it is, how much
of it is capitals, digits, signs or white space, how its words look and how much they repeat. Both
classes get their own normal distribution over these, with the covariance shrunk towards a multiple of
the identity (after the statistics are standardised), and the score is the probability of class 1 by
Bayes' rule: the difference of the two log densities, which are Mahalanobis distances from Cholesky
factors computed once, and the classes' shares.

All labelled rows given are used; only sums per class (counts, sums, products) reach the driver.

Cases: null, empty and blank-only texts have all statistics zero and get the score that this has. Null
labels and labels of missing documents are ignored; a document with several labels counts with each.
If a class has fewer than two rows, the score is the share of label 1 (0.5 without labels). Statistics
that do not vary are left out by their weight of zero.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.common import written
from tidemart.llm.hashing import WORDS, gram_hashes, span_hashes, text_blocks, word_spans

STATISTICS = (
    "words", "word_length", "capitals", "digits", "signs", "calls", "stops", "lines", "sign_words",
    "bare_signs", "long_words", "distinct_words", "doubled_words", "top_word", "repeated_runs", "capital_words",
)
SHRINKAGE = 0.1
FEW_WORDS, FEW_CHARS = 8, 40

UPPER, LOWER, DIGIT, SIGN, CALL, STOP, BLANK, LINE, OTHER = range(9)
CLASSES = np.full(256, SIGN, np.uint8)
CLASSES[65:91], CLASSES[97:123], CLASSES[48:58], CLASSES[128:] = UPPER, LOWER, DIGIT, OTHER
CLASSES[[*b"!?"]], CLASSES[[*b".,;:'\"()-"]] = CALL, STOP
CLASSES[[0x20, *range(0x09, 0x0E)]], CLASSES[0x0A] = BLANK, LINE


def share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """A share on the arcsine scale, where small and large ones spread out.

    The caller adds a constant to the whole, so that a few words or characters make no extreme share.
    """
    return np.arcsin(np.sqrt(np.clip(part / whole, 0, 1)))


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of STATISTICS per text."""
    texts = len(offsets) - 1
    lengths = np.diff(offsets)
    owner = np.repeat(np.arange(texts), lengths)
    kinds = np.bincount(owner * 9 + CLASSES[data], minlength=texts * 9).reshape(texts, 9)
    folded, starts, ends, first = word_spans(data, offsets, WORDS)
    hashes = span_hashes(folded, starts, ends)
    words = np.diff(first)
    of = np.repeat(np.arange(texts), words)
    count = lambda mask: np.bincount(of[mask], minlength=texts)

    length = ends - starts
    last = CLASSES[data[ends - 1]]
    head = CLASSES[data[starts]]
    middle = CLASSES[data[np.minimum(starts + 1, ends - 1)]]
    same_text = of[1:] == of[:-1]
    doubled = np.zeros(len(hashes), bool)
    doubled[1:] = same_text & (hashes[1:] == hashes[:-1])

    # Distinct words and the most frequent one, per text.
    order = np.lexsort((hashes, of))
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (of[order][1:] != of[order][:-1])
    runs = np.diff(np.append(np.flatnonzero(new), len(order)))
    top = np.zeros(texts, np.int64)
    np.maximum.at(top, of[order][new], runs)
    distinct = np.bincount(of[order][new], minlength=texts)

    # Runs of three words that were there before in the text.
    grams = gram_hashes(hashes, 3)
    inside = of[2:] == of[: len(grams)] if len(grams) else np.zeros(0, bool)
    grams, gram_of = grams[inside], of[: len(inside)][inside]
    order = np.lexsort((grams, gram_of))
    new = np.ones(len(order), bool)
    new[1:] = (grams[order][1:] != grams[order][:-1]) | (gram_of[order][1:] != gram_of[order][:-1])
    repeated = np.bincount(gram_of[order][~new], minlength=texts)

    letters = kinds[:, UPPER] + kinds[:, LOWER] + FEW_CHARS
    lengths, many = lengths + FEW_CHARS, words + FEW_WORDS
    return np.stack(
        [
            np.log1p(words),
            np.log1p(np.bincount(of, length, texts) / np.maximum(words, 1)),
            share(kinds[:, UPPER], letters),
            share(kinds[:, DIGIT], lengths),
            share(kinds[:, SIGN], lengths),
            share(kinds[:, CALL], lengths),
            share(kinds[:, STOP], lengths),
            share(kinds[:, LINE], lengths),
            share(count((last == SIGN) & (length > 1)), many),
            share(count((last == SIGN) & (length == 1)), many),
            share(count(length > 20), many),
            np.log(distinct + FEW_WORDS) - np.log(many),
            share(count(doubled), many),
            share(np.maximum(top - 1, 0), many),
            share(repeated, many),
            share(count((head == UPPER) & (middle == UPPER) & (length > 1)), many),
        ],
        axis=1,
    )


def describe(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of every document."""

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data, offsets in text_blocks(batch):
                rows = statistics(data, offsets)
                values = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), len(STATISTICS))
                yield pa.RecordBatch.from_arrays(
                    [block.column(0), values.cast(pa.list_(pa.float64()))], names=["doc_id", "statistics"]
                )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        described, "doc_id bigint, statistics array<double>"
    )


@dataclass(frozen=True)
class Discriminant:
    """Two normal distributions over standardised statistics, or just a share where there are not two."""

    prior: float
    center: np.ndarray
    scale: np.ndarray
    means: tuple[np.ndarray, np.ndarray] | None = None
    factors: tuple[np.ndarray, np.ndarray] | None = None

    @classmethod
    def fit(cls, moments: dict[int, tuple[float, np.ndarray, np.ndarray]], shrinkage: float = SHRINKAGE) -> Discriminant:
        """From each class's count, sums and sums of products."""
        size = len(STATISTICS)
        empty = (0.0, np.zeros(size), np.zeros((size, size)))
        parts = [moments.get(label, empty) for label in (0, 1)]
        total = sum(n for n, _, _ in parts)
        prior = parts[1][0] / total if total else 0.5
        center = sum(s for _, s, _ in parts) / max(total, 1)
        spread = np.diag(sum(p for _, _, p in parts)) / max(total, 1) - center**2
        scale = np.where(spread > 1e-12, 1 / np.sqrt(np.maximum(spread, 1e-12)), 0.0)
        if min(n for n, _, _ in parts) < 2:
            return cls(prior, center, scale)
        means, factors = [], []
        for n, sums, products in parts:
            mean = sums / n
            covariance = (products / n - np.outer(mean, mean)) * np.outer(scale, scale)
            ridge = max(np.trace(covariance) / size, 1e-3)
            covariance = (1 - shrinkage) * covariance + shrinkage * ridge * np.eye(size)
            means.append((mean - center) * scale)
            factors.append(np.linalg.cholesky(covariance))
        return cls(prior, center, scale, tuple(means), tuple(factors))

    def log_density(self, rows: np.ndarray, label: int) -> np.ndarray:
        """Up to a constant that both classes share."""
        away = np.linalg.solve(self.factors[label], (rows - self.means[label]).T)
        return -0.5 * (away**2).sum(axis=0) - np.log(np.diag(self.factors[label])).sum()

    def score(self, rows: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(rows), self.prior)
        rows = (rows - self.center) * self.scale
        margin = self.log_density(rows, 1) - self.log_density(rows, 0) + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def class_moments(rows: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Count, sums and sums of products of the statistics per label, summed in tasks first."""
    size = len(STATISTICS)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, 1 + size + size * size))
        for batch in batches:
            labels = batch.column(1).to_numpy(zero_copy_only=False)
            values = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            for label in (0, 1):
                own = values[labels == label]
                totals[label] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat([0, 1], totals.shape[1])),
                pa.array(np.tile(np.arange(totals.shape[1]), 2)),
                pa.array(totals.ravel()),
            ],
            names=["label", "place", "total"],
        )

    sums = rows.select("statistics", "label").mapInArrow(summed, "label bigint, place bigint, total double")
    found = {}
    for row in sums.groupBy("label", "place").agg(F.sum("total").alias("total")).collect():
        found.setdefault(row.label, np.zeros(1 + size + size * size))[row.place] = row.total
    return {k: (v[0], v[1 : 1 + size], v[1 + size :].reshape(size, size)) for k, v in found.items()}


def quality(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, shrinkage: float = SHRINKAGE
) -> tuple[DataFrame, Discriminant]:
    """doc_id and score of every document, learnt from ``labels`` (doc_id, quality) that may be learnt from."""
    described = written(spark, describe(docs), "quality-statistics")
    known = labels.where("quality in (0, 1)").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("bigint").alias("label")
    )
    model = Discriminant.fit(class_moments(described.join(known, "doc_id")), shrinkage)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(values))], names=["doc_id", "score"])

    return described.mapInArrow(scored, "doc_id bigint, score double"), model


def with_score(docs: DataFrame, model: Discriminant, column: str = "quality_score") -> DataFrame:
    """``docs`` with all its columns and the score of each row in ``column``, a new name."""
    if column in docs.columns:
        raise ValueError(f"there is a column {column} already")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data, offsets in text_blocks(batch):
                yield block.append_column(column, pa.array(model.score(statistics(data, offsets))))

    return docs.mapInArrow(scored, T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())]))
