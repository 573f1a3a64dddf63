"""Toxicity by a weighted lexicon, matched with Aho-Corasick in folded text.

Folding undoes what hides a word: case, accents, full-width and look-alike letters, invisible
characters, and digits or signs that stand for letters inside a word ("1d10t", "st@pid"). What is not a
letter then separates words.

The lexicon is learnt from labelled documents: its entries are word beginnings of 3 to 12 letters and
whole words, so that one entry covers a stem with all its endings. An entry's weight is the log of how
much likelier it is in toxic documents than in others; it must also be significant. In each word of a
text the longest entry counts. Exception phrases are pairs of neighbouring words, learnt as those with
an entry that occur in other documents only, or given by the caller; inside them nothing counts.

A document's sum of weights is normalised by its number of words, and a logistic function of the
normalised and the plain sum, fitted to the labelled documents, gives the score. Texts are read whole;
no other column is an input.

Learning takes at most ``learn_rows`` labelled documents of each class (those with the smallest hashes
of their ids), which also bounds what is collected: the lexicon, the exceptions and three numbers per
such document.

Cases: null, empty and wordless texts have sum 0 and get the score that this has. Labels that are null,
or whose document is missing, are ignored; a document with several labels counts with each. Without
labels of both classes the lexicon is empty and the score is the share of toxic labels (0 without any).
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import written

LEARN_ROWS = 20_000
SHORTEST, LONGEST = 3, 12

# Letters of other scripts that look like Latin ones (after accents are gone).
LOOK_ALIKES = str.maketrans(
    "абвгдезіјклмнорԛѕтухԝуαβεζηικνορτυχωıłøđ",
    "abbrde3ijkmhhopqstyxwyabezniknoptuxwilod",
)
# Digits and signs that stand for letters inside words.
STAND_INS = str.maketrans("0134578@$!|", "oieastbasii")
INSIDE = re.compile(r"(?<=[^\W\d_])[0134578@$!|]+(?=[^\W\d_])|\b[0134578]+(?=[^\W\d_]\w)|[@$](?=[^\W\d_]{2})")
APART = re.compile(r"[\W\d_]+")
UNSEEN = re.compile("[̀-ͯ­​-‏⁠﻿]")


def fold(text: str) -> str:
    """Folded words, each between single blanks, with a blank at both ends."""
    text = text.lower()
    if not text.isascii():
        text = UNSEEN.sub("", unicodedata.normalize("NFKD", text)).lower().translate(LOOK_ALIKES)
    text = INSIDE.sub(lambda found: found[0].translate(STAND_INS), text)
    return f" {APART.sub(' ', text).strip()} "


@dataclass
class Lexicon:
    """Entries (``" stem"`` or ``" word "``) with weights, exception phrases, and the fitted score."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    prior: float = 0.0
    coefficients: tuple[float, ...] | None = None

    def automaton(self) -> ahocorasick.Automaton:
        built = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            built.add_word(entry, (len(entry), weight))
        for phrase in self.exceptions:
            built.add_word(f" {phrase} ", (len(phrase) + 2, None))
        if len(built):
            built.make_automaton()
        return built


def matches(automaton: ahocorasick.Automaton, text: str) -> list[tuple[int, float]]:
    """Start and weight of each word's longest entry in folded ``text``, outside of exceptions."""
    if not len(automaton):
        return []
    longest: dict[int, tuple[int, float]] = {}
    spared = []
    for end, (length, weight) in automaton.iter(text):
        start = end - length + 1
        if weight is None:
            spared.append((start, end))
        elif start not in longest or length > longest[start][0]:
            longest[start] = (length, weight)
    # Both lists are in order of their starts: one walk over them.
    spared.sort()
    found, reach, at = [], -1, 0
    for start, (_, weight) in sorted(longest.items()):
        while at < len(spared) and spared[at][0] <= start:
            reach = max(reach, spared[at][1])
            at += 1
        if reach <= start:
            found.append((start, weight))
    return found


def features(sums: np.ndarray, words: np.ndarray) -> np.ndarray:
    """A column of ones, the sum of weights per 100 words (log), and the plain sum (log)."""
    sums, words = np.maximum(np.asarray(sums, float), 0), np.asarray(words, float)
    return np.stack([np.ones_like(sums), np.log1p(100 * sums / (words + 10)), np.log1p(sums)], axis=1)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Newton's method; the ridge keeps separable classes finite."""
    beta = np.zeros(x.shape[1])
    penalty = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve(
            (x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ beta
        )
        beta = beta + step
        if np.abs(step).max() < 1e-9:
            break
    return beta


def _sample(labels: DataFrame, learn_rows: int) -> DataFrame:
    rows = labels.where("doc_id is not null and toxic is not null").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), (F.col("toxic") != 0).alias("toxic")
    )
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    return rows.where("toxic").orderBy(*order).limit(learn_rows).union(
        rows.where("not toxic").orderBy(*order).limit(learn_rows)
    )


def _rows(batch: pa.RecordBatch, name: str, found: Callable[[str], set[str]]) -> pa.RecordBatch:
    """One row ``(name, toxic)`` for each string that ``found`` gives for a text."""
    strings, toxic = [], []
    for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        got = sorted(found(fold(text or "")))
        strings.extend(got)
        toxic.extend([int(label)] * len(got))
    return pa.RecordBatch.from_arrays([pa.array(strings, pa.string()), pa.array(toxic, pa.int64())], names=[name, "toxic"])


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield _rows(batch, "word", lambda text: set(text.split()))


def learn_entries(texts: DataFrame) -> dict[str, float]:
    """Entries with weights from ``(text, toxic)`` rows."""
    words = texts.mapInArrow(_words, "word string, toxic long").groupBy("word").agg(
        F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")
    )
    length = F.least(F.length("word"), F.lit(LONGEST))
    starts = F.when(
        length >= SHORTEST,
        F.transform(F.sequence(F.lit(SHORTEST), length), lambda n: F.concat(F.lit(" "), F.substring(F.col("word"), F.lit(1), n))),
    ).otherwise(F.array().cast("array<string>"))
    whole = F.concat(F.lit(" "), "word", F.lit(" "))
    entries = words.select(F.explode(F.array_append(starts, whole)).alias("entry"), "bad", "good")
    entries = entries.groupBy("entry").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    totals = words.agg(F.sum("bad"), F.sum("good")).first()
    if not totals[0] or not totals[1]:
        return {}
    ratio = F.lit(totals[0] / totals[1])
    weight = F.log((F.col("bad") + 0.5) / ((F.col("good") + 0.5) * ratio))
    expected = (F.col("good") + 1) * ratio
    strength = (F.col("bad") - expected) / F.sqrt(expected)
    kept = entries.withColumn("weight", weight).withColumn("strength", strength).where(
        "bad >= 5 and weight >= 1.5 and strength >= 6"
    )
    return {row.entry: row.weight for row in kept.orderBy(F.desc("strength"), "entry").collect()}


def learn_exceptions(texts: DataFrame, weights: dict[str, float], learn: bool = True) -> tuple[str, ...]:
    """Phrases of two words with an entry, in at least three documents that are not toxic and no toxic one."""
    if not weights or not learn:
        return ()
    lexicon = Lexicon(weights)

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()

        def around(text: str) -> set[str]:
            found = set()
            for start, _ in matches(automaton, text):
                word_end = text.index(" ", start + 1)
                before = text.rfind(" ", 0, start) if start else -1
                after = text.find(" ", word_end + 1)
                if before >= 0:
                    found.add(text[before + 1 : word_end])
                if after >= 0:
                    found.add(text[start + 1 : after])
            return found

        for batch in batches:
            yield _rows(batch, "phrase", around)

    counted = texts.mapInArrow(phrases, "phrase string, toxic long").groupBy("phrase").agg(
        F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")
    )
    kept = counted.where("bad = 0 and good >= 3").orderBy(F.desc("good"), "phrase")
    return tuple(row.phrase for row in kept.collect())


def sums(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id, the sum of weights and the number of words of every document."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            weights, words = [], []
            for text in batch.column(1):
                text = fold(text.as_py() or "")
                weights.append(float(sum(weight for _, weight in matches(automaton, text))))
                words.append(text.count(" ") - 1 if text.strip() else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(weights, pa.float64()), pa.array(words, pa.int64())],
                names=["doc_id", "weight", "words"],
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        summed, "doc_id bigint, weight double, words bigint"
    )


def toxicity(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    learn_rows: int = LEARN_ROWS,
    exceptions: tuple[str, ...] = (),
) -> tuple[DataFrame, Lexicon]:
    """Scores of ``docs`` learnt from ``labels`` (doc_id, toxic); give only labels that may be learnt from.

    Returns doc_id, score, weight and words per document, and what was learnt.
    """
    sample = written(spark, _sample(labels, learn_rows), "toxic-sample")
    # At most 2 * learn_rows ids.
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).join(
        F.broadcast(sample), "doc_id"
    )
    texts = written(spark, texts.select("text", "toxic"), "toxic-texts")
    weights = learn_entries(texts)
    learnt = learn_exceptions(texts, weights) + tuple(fold(phrase).strip() for phrase in exceptions)
    lexicon = Lexicon(weights, learnt)
    rows = written(spark, sums(docs, lexicon), "toxic-sums")
    known = rows.join(F.broadcast(sample), "doc_id").select("weight", "words", "toxic").toPandas()
    y = known["toxic"].to_numpy(dtype=float)
    # A sample of even classes would see toxic documents too often; their true share sets the level.
    shares = labels.where("toxic is not null").agg(F.avg((F.col("toxic") != 0).cast("int"))).first()[0]
    lexicon.prior = float(shares or 0.0)
    if 0 < y.sum() < len(y):
        beta = fit_logistic(features(known["weight"], known["words"]), y)
        drawn = y.mean()
        beta[0] += np.log(lexicon.prior / (1 - lexicon.prior)) - np.log(drawn / (1 - drawn))
        lexicon.coefficients = tuple(float(b) for b in beta)
        b = lexicon.coefficients
        total = F.greatest("weight", F.lit(0.0))
        margin = (
            F.lit(b[0]) + F.lit(b[1]) * F.log1p(100 * total / (F.col("words") + 10)) + F.lit(b[2]) * F.log1p(total)
        )
        score = 1 / (1 + F.exp(-F.greatest(F.least(margin, F.lit(30.0)), F.lit(-30.0))))
    else:
        score = F.lit(lexicon.prior)
    return rows.select("doc_id", score.alias("score"), "weight", "words"), lexicon
