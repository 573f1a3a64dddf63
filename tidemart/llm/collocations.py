"""Collocations: phrases whose words come together more often than their parts would by chance.

Phrases are counted over a prefix-free parse of the corpus. A hash of WINDOW neighbouring words that is a
multiple of PERIOD ends a chunk: the chunk goes up to the last of these words and the next one begins with the
first of them, so chunks overlap by WINDOW words and depend on their content alone. Equal stretches of text, wherever they
are, give equal chunks: the dictionary of distinct chunks, with how often each occurs in the parse, is what
everything is counted on. As chunks overlap by one word less than the longest phrase, each occurrence of a
phrase lies in some chunk as a whole; it belongs to the chunk in which it starts before the last
WINDOW words (the last chunk of a text owns all its words), so it is counted once, with its chunk's frequency.

Counting goes by length: a phrase that occurs often enough has a beginning and an end, one word shorter, that do
too. Hashes of phrases are summed for those only whose two parts may be frequent, by a Bloom filter. Hashes
choose what may be frequent; the texts of these are then counted exactly. Scores follow from the counts by joins.

A text is split into pieces at PIECE_ENDS and these into words at blanks and tabs; phrases do not cross
pieces, languages are apart, and A-Z is lower-cased.

Bounds: the filter has FILTER_BITS at most, whatever the corpus, and only spares rows a shuffle. Tasks keep TALLY hashes at
a time. A chunk is at most as long as its text. Counts are combined before each shuffle; the best of
each language are chosen in SPREAD parts first, so that no task ranks a language's whole list.

Cases: null, empty and wordless texts have no words. A null lang is UNKNOWN, as a lang of that name is. Rows that repeat
an id or a text all count; ids are not read. Other columns are ignored. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.llm.bloom import filter_words, may_hold
from tidemart.llm.common import settled, written
from tidemart.llm.hashing import gram_hashes, mix, signed, span_hashes, text_blocks

UNKNOWN = "und"
LONGEST = 5
WINDOW = LONGEST - 1
PERIOD = 32
FILTER_BITS = 1 << 28
TALLY = 1 << 20
SPREAD = 64
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"

# Byte -> A-Z folded; byte -> 0 inside words, 1 blank, 2 end of a piece.
FOLDED = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
KIND = np.array([2 if b in PIECE_ENDS else 1 if b in BLANKS else 0 for b in range(256)], np.uint8)


class Words:
    """The words of a block of texts.

    ``starts`` and ``ends`` are their places in ``folded``, ``opens`` whether a piece begins with the word,
    ``first`` per text its first word (n + 1).
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.folded = FOLDED[data]
        kind = KIND[data]
        inside = kind == 0
        begins, closes = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        # Neighbouring texts touch in the buffer: a word ends where its text ends.
        edges = np.unique(offsets[1:-1])
        edges = edges[(edges > 0) & (edges < len(data))]
        begins[edges], closes[edges - 1] = inside[edges], inside[edges - 1]
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.starts, offsets)
        cuts = np.concatenate([[0], np.cumsum(kind == 2)])
        self.opens = np.ones(len(self.starts), bool)
        self.opens[1:] = cuts[self.starts[1:]] > cuts[self.ends[:-1]]
        self.opens[self.first[:-1][self.first[:-1] < len(self.starts)]] = True
        self.hashes = span_hashes(self.folded, self.starts, self.ends)

    def __len__(self) -> int:
        return len(self.starts)

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def spelled(self) -> tuple[bytes, np.ndarray]:
        """All words, one sign before each: a line feed before a piece, else a blank; and where each word starts."""
        lengths = self.ends - self.starts + 1
        at = np.concatenate([[0], np.cumsum(lengths)])
        source = np.arange(at[-1]) + np.repeat(self.starts - 1 - at[:-1], lengths)
        signs = self.folded[source]
        signs[at[:-1]] = np.where(self.opens, 10, 32)
        return signs.tobytes(), at + 1


def cut_chunks(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last word + 1 of each chunk, and whether it is the last one of its text."""
    if not len(words):
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, bool),)
    first = words.first
    marked = mix(words.hashes ^ (words.opens.astype(np.uint64) << np.uint64(32)))
    hits = np.flatnonzero(gram_hashes(marked, WINDOW) % np.uint64(PERIOD) == 0)
    owner = words.owner()
    hits = hits[owner[hits] == owner[hits + WINDOW - 1]]
    begins = np.unique(np.concatenate([hits, first[:-1][np.diff(first) > 0]]))
    follows = np.append(begins[1:], len(words))
    last = np.append(owner[begins[1:]] != owner[begins[:-1]], True)
    return begins, np.where(last, first[owner[begins] + 1], follows + WINDOW), last


def language_hashes(languages: pa.Array) -> np.ndarray:
    known: dict[str, int] = {}
    return np.array([known.setdefault(x, xxhash.xxh64_intdigest(x)) for x in languages.to_pylist()], np.uint64)


class Phrases:
    """Hashes of the phrases that the chunks of a batch own, with their frequencies.

    ``grams[k]`` has the hashes of k + 1 words from each word on, for the sizes up to ``longest``.
    """

    def __init__(self, block: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, longest: int):
        self.words = words = Words(data, offsets)
        chunk = words.owner()
        last = block.column(2).to_numpy(zero_copy_only=False)
        own = words.first[1:] - np.where(last, 0, WINDOW)
        self.mine = np.arange(len(words)) < own[chunk]
        self.chunk, self.times = chunk, block.column(3).to_numpy()[chunk]
        opens = np.append(np.flatnonzero(words.opens), len(words))
        # The word after each word's piece.
        self.until = opens[np.searchsorted(opens, np.arange(len(words)), "right")] if len(words) else opens
        salt = language_hashes(block.column(0))[chunk]
        self.grams = [mix(gram_hashes(words.hashes, size) ^ salt[: max(0, len(words) - size + 1)]) for size in range(1, longest + 1)]

    def at(self, size: int) -> np.ndarray:
        """Where owned phrases of ``size`` words start."""
        count = max(0, len(self.words) - size + 1)
        start = np.arange(count)
        return start[self.mine[:count] & (start + size <= self.until[:count])]


def spelled_out(
    block: pa.RecordBatch, phrases: Phrases, at: np.ndarray, size: int, spelled: bytes, place: np.ndarray
) -> pa.RecordBatch:
    """The phrases that start ``at`` these words, as texts, equal ones of the block as one row.

    Two hashes decide what is equal here; where they part, a phrase has several rows, which sum up the same.
    """
    first = phrases.grams[size - 1][at]
    second = gram_hashes(mix(phrases.words.hashes + np.uint64(size)), size)[at]
    order = np.argsort(first, kind="stable")
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(first[order]) != 0) | (np.diff(second[order]) != 0)
    heads = np.flatnonzero(new)
    n = np.add.reduceat(phrases.times[at[order]], heads) if len(heads) else np.zeros(0, np.int64)
    at = at[order[heads]]
    texts = [spelled[a:b] for a, b in zip(place[at], place[at + size] - 1)]
    return pa.RecordBatch.from_arrays(
        [
            block.column(0).take(pa.array(phrases.chunk[at])),
            pa.array(texts, pa.binary()).cast(pa.string()),
            pa.array(np.full(len(at), size, np.int32)),
            pa.array(n),
        ],
        names=["lang", "phrase", "size", "n"],
    )


class Collocations:
    """The collocations of ``docs`` (text, lang)."""

    def __init__(self, spark: SparkSession, docs: DataFrame, min_count: int = 100, keep_ratio: int = 100, best: int = 2000):
        """``keep_ratio``: a phrase with at least so many hundredths of its occurrences inside a longer one goes."""
        self.spark, self.min_count, self.keep_ratio, self.best = spark, min_count, keep_ratio, best
        self.docs = docs.select(
            F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col("text").cast("string").alias("text")
        )

    def dictionary(self) -> DataFrame:
        """``(lang, chunk, last, times, words)``: distinct chunks; ``words`` counts those they own in all the parse."""

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block, data, offsets in text_blocks(batch):
                    words = Words(data, offsets)
                    begins, ends, last = cut_chunks(words)
                    spelled, at = words.spelled()
                    chunks = [spelled[a:b] for a, b in zip(at[begins], at[ends] - 1)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            block.column(0).take(pa.array(words.owner()[begins])),
                            pa.array(chunks, pa.binary()).cast(pa.string()),
                            pa.array(last),
                            pa.array(ends - begins - np.where(last, 0, WINDOW)),
                        ],
                        names=["lang", "chunk", "last", "words"],
                    )

        parsed = self.docs.mapInArrow(rows, "lang string, chunk string, last boolean, words bigint")
        parsed = parsed.groupBy("lang", "chunk", "last").agg(F.count(F.lit(1)).alias("times"), F.sum("words").alias("words"))
        return written(self.spark, parsed, "phrase-chunks")

    def frequent(self, chunks: DataFrame, size: int, shorter: np.ndarray | None) -> DataFrame:
        """``(gram)`` of phrases of ``size`` words that may occur ``min_count`` times; ``shorter`` is the filter of those one word shorter."""
        known = self.spark.sparkContext.broadcast(shorter)

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            waiting: list[tuple[np.ndarray, np.ndarray]] = []

            def tally() -> pa.RecordBatch:
                grams, times = (np.concatenate(part) for part in zip(*waiting))
                waiting.clear()
                grams, place = np.unique(grams, return_inverse=True)
                n = np.zeros(len(grams), np.int64)
                np.add.at(n, place, times)
                return pa.RecordBatch.from_arrays([pa.array(signed(grams)), pa.array(n)], names=["gram", "n"])

            for batch in batches:
                for block, data, offsets in text_blocks(batch, "chunk"):
                    phrases = Phrases(block, data, offsets, size)
                    at = phrases.at(size)
                    if known.value is not None:
                        parts = phrases.grams[size - 2]
                        at = at[may_hold(known.value, parts[at])]
                        at = at[may_hold(known.value, parts[at + 1])]
                    waiting.append((phrases.grams[size - 1][at], phrases.times[at]))
                    if sum(len(grams) for grams, _ in waiting) > TALLY:
                        yield tally()
            if waiting:
                yield tally()

        counted = chunks.select("lang", "chunk", "last", "times").mapInArrow(rows, "gram bigint, n bigint")
        counted = counted.groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") >= self.min_count).select("gram")
        return written(self.spark, counted, f"phrases-{size}")

    def counts(self, chunks: DataFrame) -> DataFrame:
        """``(lang, phrase, size, f)`` of all phrases of up to LONGEST words with at least ``min_count`` occurrences."""
        filters: list[np.ndarray] = []
        for size in range(1, LONGEST + 1):
            grams = self.frequent(chunks, size, filters[-1] if filters else None)
            filters.append(filter_words(grams, F.col("gram"), FILTER_BITS))
        known = self.spark.sparkContext.broadcast(filters)

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block, data, offsets in text_blocks(batch, "chunk"):
                    phrases = Phrases(block, data, offsets, LONGEST)
                    spelled, place = phrases.words.spelled()
                    for size in range(1, LONGEST + 1):
                        at = phrases.at(size)
                        grams = phrases.grams[size - 1]
                        at = at[may_hold(known.value[size - 1], grams[at])]
                        yield spelled_out(block, phrases, at, size, spelled, place)

        counted = chunks.select("lang", "chunk", "last", "times").mapInArrow(
            rows, "lang string, phrase string, size int, n bigint"
        )
        counted = counted.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("f"))
        return written(self.spark, counted.where(F.col("f") >= self.min_count), "phrase-counts")

    def scored(self, counts: DataFrame, totals: DataFrame) -> DataFrame:
        """``(lang, phrase, a, l, r, n, score)`` of each candidate, by its lowest-scoring cut."""
        candidates = counts.where("size > 1").withColumnRenamed("f", "a")
        cuts = candidates.select("*", F.explode(F.expr("sequence(1, size - 1)")).alias("k"))
        head, tail = F.expr("substring_index(phrase, ' ', k)"), F.expr("substring_index(phrase, ' ', k - size)")
        cuts = cuts.select("*", head.alias("head"), tail.alias("tail"))
        heads = counts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
        tails = counts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
        met = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(totals, "lang")
        score = exact("a") * 1000 * exact("n")
        met = met.withColumn("score", F.call_function("div", score, exact("l") * exact("r")))
        lowest = met.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        return lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")

    def inside_longer(self, counts: DataFrame) -> DataFrame:
        """``(lang, phrase, longer)``: the most occurrences that a phrase of one word more has around it.

        Those of still longer ones have no more, so one word more is enough to look at.
        """
        longer = counts.where("size > 2")
        parts = F.array(F.expr("substring_index(phrase, ' ', size - 1)"), F.expr("substring_index(phrase, ' ', 1 - size)"))
        inside = longer.select("lang", F.explode(parts).alias("phrase"), "f")
        return inside.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))

    def ranked(self) -> DataFrame:
        """``(lang, rank, phrase, a, l, r, n, score)``."""
        chunks = self.dictionary()
        totals = written(self.spark, chunks.groupBy("lang").agg(F.sum("words").alias("n")), "language-words")
        counts = self.counts(chunks)
        scored = self.scored(counts, totals).join(self.inside_longer(counts), ["lang", "phrase"], "left")
        kept = scored.where(F.coalesce(F.col("longer") * 100 < F.col("a") * self.keep_ratio, F.lit(True)))
        order = (F.desc("score"), F.desc("a"), F.col("phrase"))
        part = F.pmod(F.xxhash64("phrase"), F.lit(SPREAD))
        kept = kept.withColumn("part", part)
        kept = kept.withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
        kept = kept.where(F.col("place") <= self.best)
        kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
        return kept.where(F.col("rank") <= self.best).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def exact(count: str) -> Column:
    """A count whose products with another one and 1000 keep all digits."""
    return F.col(count).cast("decimal(17,0)")


def collocations(spark: SparkSession, docs: DataFrame, min_count: int = 100, keep_ratio: int = 100, best: int = 2000) -> DataFrame:
    """Each language's ``best`` collocations; the dictionary and all counts are deleted at the end."""
    return settled(spark, Collocations(spark, docs, min_count, keep_ratio, best).ranked, "collocations")
