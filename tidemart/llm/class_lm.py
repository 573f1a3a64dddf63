"""Scores of a Brown class-based bigram model.

The model gives a token w after w' the probability

    (count(w) + 1) * (weight * P(class(w) | class(w')) / D(class(w)) + (1 - weight) / (N + V + classes))

where D(c) is the sum of count + 1 over the words of class c, and one more for words never seen, so
that both parts add up to one. P(c | c') is smoothed by the classes' own shares. Every text ends with an
end token, which also stands before its first word.

Classes come from exchange clustering, which moves one type at a time to the class that raises the
likelihood of the class bigrams most. The types are the WORD_TYPES most frequent words, and, for all
others, their endings (a hash of the last three bytes); so every word, seen or not, has a class. The
bigrams of types are counted over all training texts; tasks exchange their own types against the state
of the last round, and rounds follow each other until few types move.

Counts of all words are one table over all training texts, keyed by a 64-bit hash. The most frequent
CORE words of it go to every task (16 bytes each, a fixed bound); the other words of the texts to be
scored meet their counts by a join on the hash, which no frequent word takes part in. As the count is a
factor of both parts above, only the sum of log(count + 1) has to come from there.

Cases: a null or empty text is just the end token. Without training texts all counts are zero and the
classes equally likely. Rows that repeat are scored each. A null id is kept. Words are cut at white
space, A-Z folded; texts are read whole; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import settled, written
from tidemart.llm.hashing import WORDS, mix, signed, span_hashes, text_blocks, word_spans

CLASSES = 64
WORD_TYPES = 4096
ENDING_TYPES = 1024
TYPES = WORD_TYPES + ENDING_TYPES
CORE = 1 << 18
WEIGHT = 0.9
PRIOR = 64.0
ROUNDS = 8
EXCHANGE_TASKS = 4
END = np.uint64(0x5EED0FE2D0C5E2D1)
END_ENDING = 0


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and endings of all tokens, an end after each text, and per text its first token (n + 1)."""
    folded, starts, ends, first = word_spans(data, offsets, WORDS)
    texts = len(offsets) - 1
    words = np.full(len(starts) + texts, END, np.uint64)
    endings = np.full(len(words), END_ENDING, np.int64)
    place = np.arange(len(starts)) + np.repeat(np.arange(texts), np.diff(first))
    words[place] = span_hashes(folded, starts, ends)
    last = np.zeros(len(starts), np.uint64)
    for k in (1, 2, 3):
        at = ends - k
        last = (last << np.uint64(8)) | np.where(at >= starts, folded[np.maximum(at, 0)], 0).astype(np.uint64)
    endings[place] = (mix(last) % np.uint64(ENDING_TYPES)).astype(np.int64)
    return words, endings, first + np.arange(texts + 1)


def tallied(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places and counts of the distinct rows of the columns."""
    order = np.lexsort(columns)
    new = np.zeros(len(order), bool)
    new[:1] = True
    for column in columns:
        new[1:] |= column[order][1:] != column[order][:-1]
    at = np.flatnonzero(new)
    return order[at], np.diff(np.append(at, len(order)))


@dataclass(frozen=True)
class Core:
    """The most frequent words: sorted hashes, their counts, and types (-1: that of the ending)."""

    words: np.ndarray
    counts: np.ndarray
    types: np.ndarray

    def look_up(self, words: np.ndarray, endings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts (-1 outside the core) and types."""
        types = WORD_TYPES + endings
        if not len(self.words):
            return np.full(len(words), -1), types
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        known = self.words[at] == words
        types = np.where(known & (self.types[at] >= 0), self.types[at], types)
        return np.where(known, self.counts[at], -1), types


@dataclass(frozen=True)
class ClassModel:
    core: Core
    total: int
    distinct: int
    classes: np.ndarray
    table: np.ndarray

    """``table[c', c]`` is the factor of (count + 1) in the probability of a word of c after c'."""


def learn_counts(train: DataFrame) -> DataFrame:
    """``(word, ending, n)`` of all words of the training texts."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [tokens(data, offsets)[:2] for _, data, offsets in text_blocks(batch)]
            if found:
                words, endings = (np.concatenate(x) for x in zip(*found))
                at, n = tallied(words)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(words[at])), pa.array(endings[at].astype(np.int16)), pa.array(n)],
                    names=["word", "ending", "n"],
                )

    rows = train.mapInArrow(counted, "word bigint, ending smallint, n bigint")
    rows = rows.groupBy("word").agg(F.first("ending").alias("ending"), F.sum("n").alias("n"))
    return written(train.sparkSession, rows, "word-counts")


def learn_core(counts: DataFrame) -> Core:
    """The CORE most frequent words, ties by hash."""
    rows = counts.orderBy(F.desc("n"), "word").limit(CORE).select("word", "n").toArrow()
    words, n = rows["word"].to_numpy().view(np.uint64), rows["n"].to_numpy()
    types = np.where(np.arange(len(words)) < WORD_TYPES, np.arange(len(words)), -1)
    order = np.argsort(words)
    return Core(words[order], n[order], types[order])


def learn_bigrams(train: DataFrame, core: Core) -> DataFrame:
    """``(type, other, side, n)``: how often ``other`` stands after (side 1) or before (0) the type."""
    shared = train.sparkSession.sparkContext.broadcast(core)

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = []
            for _, data, offsets in text_blocks(batch):
                words, endings, first = tokens(data, offsets)
                types = shared.value.look_up(words, endings)[1]
                end = shared.value.look_up(np.array([END]), np.array([END_ENDING]))[1][0]
                before = np.concatenate([[end], types[:-1]])
                pairs.append(before * TYPES + types)
            if pairs:
                keys, n = np.unique(np.concatenate(pairs), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["pair", "n"])

    pairs = train.mapInArrow(paired, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    pairs = written(
        train.sparkSession,
        pairs.select(F.expr(f"cast(pair div {TYPES} as int)").alias("one"), F.expr(f"cast(pair % {TYPES} as int)").alias("two"), "n"),
        "type-bigrams",
    )
    both = pairs.select(F.col("one").alias("type"), F.col("two").alias("other"), F.lit(1).alias("side"), "n").union(
        pairs.select(F.col("two").alias("type"), F.col("one").alias("other"), F.lit(0).alias("side"), "n")
    )
    return written(train.sparkSession, both.repartition(EXCHANGE_TASKS, "type").sortWithinPartitions("type"), "type-contexts")


def entropy_term(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-12))


def class_bigrams(contexts: DataFrame, classes: np.ndarray) -> np.ndarray:
    """Counts of class pairs, from the side-1 rows; at most CLASSES squared rows reach the driver."""
    lookup = contexts.sparkSession.sparkContext.broadcast(classes)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES * CLASSES)
        for batch in batches:
            one, two, side, n = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            own = side == 1
            total += np.bincount(
                lookup.value[one[own]] * CLASSES + lookup.value[two[own]], n[own], CLASSES * CLASSES
            )
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["pair", "n"])

    rows = contexts.mapInArrow(summed, "pair bigint, n double").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    found = np.zeros(CLASSES * CLASSES)
    for row in rows:
        found[row.pair] = row.n
    return found.reshape(CLASSES, CLASSES)


class Exchange:
    """The state of the exchange in one task: classes of all types and counts of class pairs."""

    def __init__(self, classes: np.ndarray, pairs: np.ndarray):
        self.classes, self.pairs = classes.copy(), pairs.copy()

    def move(self, type_: int, others: np.ndarray, sides: np.ndarray, n: np.ndarray) -> None:
        """Take the type out of its class, and put it where the likelihood is highest."""
        own = others == type_
        self_n = n[own & (sides == 1)].sum()
        after = np.bincount(self.classes[others[~own & (sides == 1)]], n[~own & (sides == 1)], CLASSES)
        before = np.bincount(self.classes[others[~own & (sides == 0)]], n[~own & (sides == 0)], CLASSES)
        old = self.classes[type_]
        pairs = self.pairs
        pairs[old] -= after
        pairs[:, old] -= before
        pairs[old, old] -= self_n
        # Wherever the type goes, the margins of its neighbours' classes get its pairs with them.
        left, right = pairs.sum(axis=1) + before, pairs.sum(axis=0) + after
        gain = (entropy_term(pairs + after) - entropy_term(pairs)).sum(axis=1)
        gain += (entropy_term(pairs + before[:, None]) - entropy_term(pairs)).sum(axis=0)
        # The class's own cell gets both parts and the type's pairs with itself.
        cell = np.diag(pairs)
        gain += entropy_term(cell + after + before + self_n) - entropy_term(cell + after)
        gain -= entropy_term(cell + before) - entropy_term(cell)
        # Each margin of its own class gets all pairs with the type on that side.
        out, into = after.sum() + self_n, before.sum() + self_n
        gain -= entropy_term(left + out) - entropy_term(left)
        gain -= entropy_term(right + into) - entropy_term(right)
        new = old if gain[old] >= gain.max() - 1e-9 else int(gain.argmax())
        pairs[new] += after
        pairs[:, new] += before
        pairs[new, new] += self_n
        self.classes[type_] = new


def exchange_round(contexts: DataFrame, classes: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Each task exchanges its own types once; the new classes of all types.

    A task holds the contexts of its types, all tasks together at most twice TYPES squared rows.
    """
    shared = contexts.sparkSession.sparkContext.broadcast((classes, pairs))

    def exchanged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        types, others, sides, n = (c.to_numpy() for c in table.columns)
        state = Exchange(*shared.value)
        order = np.argsort(types, kind="stable")
        types, others, sides, n = types[order], others[order], sides[order], n[order].astype(float)
        at = np.flatnonzero(np.diff(types, prepend=-1))
        ends = np.append(at[1:], len(types))
        # The most frequent types first: they shape the classes.
        weight = np.add.reduceat(n, at)
        for k in np.argsort(-weight, kind="stable"):
            state.move(types[at[k]], others[at[k] : ends[k]], sides[at[k] : ends[k]], n[at[k] : ends[k]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(types[at]), pa.array(state.classes[types[at]])], names=["type", "class"]
        )

    rows = contexts.mapInArrow(exchanged, "type int, class bigint").toArrow()
    found = classes.copy()
    found[rows["type"].to_numpy()] = rows["class"].to_numpy()
    return found


def learn(train: DataFrame) -> tuple[ClassModel, DataFrame]:
    """The model of the training texts, and the counts of all their words."""
    counts = learn_counts(train)
    total, distinct = (int(x or 0) for x in counts.agg(F.sum("n"), F.count(F.lit(1))).first())
    core = learn_core(counts)
    contexts = learn_bigrams(train, core)
    classes = np.arange(TYPES, dtype=np.int64) % CLASSES
    pairs = class_bigrams(contexts, classes)
    for _ in range(ROUNDS):
        moved = exchange_round(contexts, classes, pairs)
        changed = int((moved != classes).sum())
        classes, pairs = moved, class_bigrams(contexts, moved)
        if changed < TYPES // 100:
            break

    # Sums of count + 1 by type: the most frequent words are types themselves, the others by ending.
    own = core.types >= 0
    by_type = np.zeros(TYPES)
    by_type[core.types[own]] = core.counts[own] + 1
    for row in counts.groupBy("ending").agg(F.sum(F.col("n") + 1).alias("n")).collect():
        by_type[WORD_TYPES + row.ending] += row.n
    for ending, n in zip(_endings(counts, core), (core.counts[own] + 1)):
        by_type[WORD_TYPES + ending] -= n
    emission = np.bincount(classes, by_type, CLASSES) + 1
    share = (pairs.sum(axis=0) + 1) / (pairs.sum() + CLASSES)
    follow = (pairs + PRIOR * share) / (pairs.sum(axis=1, keepdims=True) + PRIOR)
    table = WEIGHT * follow / emission + (1 - WEIGHT) / (total + distinct + CLASSES)
    return ClassModel(core, total, distinct, classes, table), counts


def _endings(counts: DataFrame, core: Core) -> list[int]:
    """The endings of the words that are types, in the order of the core."""
    words = signed(core.words[core.types >= 0])
    listed = counts.sparkSession.createDataFrame(pa.table({"word": pa.array(words)}))
    # At most WORD_TYPES words.
    found = {r.word: r.ending for r in counts.join(F.broadcast(listed), "word").select("word", "ending").collect()}
    return [found[int(w)] for w in words]


def score(docs: DataFrame, model: ClassModel, counts: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score of every document."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        logs = np.log10(model.table)
        base = -np.log10(model.total + model.distinct + 1)
        row = TaskContext.get().partitionId() << 40
        names = ["row", "doc_id", "n_tokens", "n_known", "base_score", "score", "word", "n"]
        for batch in batches:
            for block, data, offsets in text_blocks(batch):
                words, endings, first = tokens(data, offsets)
                known, types = model.core.look_up(words, endings)
                classes = model.classes[types]
                before = np.concatenate([[0], classes[:-1]])
                end = model.core.look_up(np.array([END]), np.array([END_ENDING]))[1][0]
                before[first[:-1]] = model.classes[end]
                texts = block.num_rows
                of = np.repeat(np.arange(texts), np.diff(first))
                core_logs = np.where(known >= 0, np.log10(np.maximum(known, 0) + 1.0), 0.0)
                core_sum = np.bincount(of, core_logs, texts)
                n_tokens = np.diff(first)
                rows = row + np.arange(texts)
                row += texts
                none = pa.nulls(texts, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rows),
                        block.column(0),
                        pa.array(n_tokens),
                        pa.array(np.bincount(of, known > 0, texts).astype(np.int64)),
                        pa.array(core_sum + base * n_tokens),
                        pa.array(core_sum + np.bincount(of, logs[before, classes], texts)),
                        none,
                        none,
                    ],
                    names=names,
                )
                rare = np.flatnonzero(known < 0)
                at, n = tallied(words[rare], of[rare])
                at = rare[at]
                none, nothing = pa.nulls(len(at), pa.int64()), pa.nulls(len(at), pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[of[at]]), none, none, none, nothing, nothing, pa.array(signed(words[at])), pa.array(n)],
                    names=names,
                )

    schema = (
        "row bigint, doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double,"
        " word bigint, n bigint"
    )
    rows = written(spark, docs.mapInArrow(scored, schema), "lm-scores")
    # Words outside the core: those that were counted add the logarithm of their count + 1.
    seen = rows.where("word is not null").select("row", "word", F.col("n").alias("times")).join(
        counts.select("word", F.col("n").alias("count")), "word"
    )
    added = seen.groupBy("row").agg(
        F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("count") + F.lit(1.0))).alias("added")
    )
    found = rows.where("word is null").select("row", "doc_id", "n_tokens", "n_known", "base_score", "score")
    more, plus = F.coalesce("more", F.lit(0)), F.coalesce("added", F.lit(0.0))
    return found.join(added, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + more).alias("n_known"), F.lit(model.total).cast("bigint").alias("train_tokens"),
        (F.col("base_score") + plus).alias("base_score"), (F.col("score") + plus).alias("score"),
    )


def score_documents(spark: SparkSession, docs: DataFrame, train: DataFrame) -> DataFrame:
    """Scores of ``docs`` (doc_id, text) by the model of the texts of ``train``."""
    columns = (F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def scores() -> DataFrame:
        model, counts = learn(train.select(columns[1]))
        return score(docs.select(*columns), model, counts)

    return settled(spark, scores, "lm-result")
