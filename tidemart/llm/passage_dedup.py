"""Repeated passages of whole texts, wherever they begin and end: winnowed seeds, exact runs, spans.

A run is a stretch of RUN words of a text, line breaks being white space like any other. Every run that
occurs more than once is found, exactly: each run picks a seed, the SEED words at the least 5-word hash
of its window (winnowing), so equal runs have equal seeds, and on average one word in sixteen starts a
seed. Only runs whose seed may occur more than once are compared, by their hash over all RUN words. The runs
of one seed's place are a chunk; equal chunks are compared once. Runs that follow each other, in a text and
at their first occurrences, grow to spans.

Of equal runs the first occurrence, by doc_id, text and place, stays. No pairs of occurrences are made:
all are compared with the first one by an aggregate and a join.

Cases: null and empty texts, and texts of fewer words than RUN, have no runs. Rows that repeat an id and
text are judged alike. A null id is larger than any other. Runs may overlap those that they repeat, as
in text of one repeated word. An empty table gives no rows. Texts are read whole; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemart.llm.bloom import filter_words, may_hold
from tidemart.llm.common import settled, whole_text, written
from tidemart.llm.hashing import BASE, gram_hashes, mix, signed, text_blocks, word_hashes

RUN = 50
# A bit more than Bloom filters have elsewhere: 32 MB at most for seeds that occur more than once.
FILTER_BITS = 1 << 28
SEED = 20
GRAM = 5


def seeded_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Hashes of all words, per text its first word, and the first words and the seeds' places of all runs."""
    words, first = word_hashes(data, offsets)
    if len(words) < RUN:
        return words, first, np.zeros(0, np.int64), np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.flatnonzero(owner[: len(words) - RUN + 1] == owner[RUN - 1 :])
    windows = np.lib.stride_tricks.sliding_window_view(gram_hashes(words, GRAM), RUN - SEED + 1)
    return words, first, at, at + windows[: len(words) - RUN + 1].argmin(axis=1)[at]


class PassageDedup:
    """Repeated passages of ``docs`` (doc_id, text)."""

    def __init__(self, spark: SparkSession, docs: DataFrame):
        self.spark = spark
        self.docs = docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            F.xxhash64(whole_text(F.col("text"))).alias("text_hash"),
            F.col("text").cast("string").alias("text"),
        )

    def seeds(self) -> DataFrame:
        """``(seed)`` of those that occur at several places."""

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for _, data, offsets in text_blocks(batch):
                    words, _, _, places = seeded_runs(data, offsets)
                    seeds = gram_hashes(words, SEED)[np.unique(places)]
                    keys, n = np.unique(seeds, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(signed(keys)), pa.array(n)], names=["seed", "n"])

        found = self.docs.select("text").mapInArrow(rows, "seed bigint, n bigint")
        found = found.groupBy("seed").agg(F.sum("n").alias("n")).where("n > 1").select("seed")
        return written(self.spark, found, "passage-seeds")

    def chunks(self, seeds: DataFrame) -> DataFrame:
        """``(doc_id, text_hash, start, chunk, runs)``: the runs of each place of a seed that may be repeated."""
        known = self.spark.sparkContext.broadcast(filter_words(seeds, F.col("seed"), FILTER_BITS))

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block, data, offsets in text_blocks(batch):
                    words, first, at, places = seeded_runs(data, offsets)
                    some = may_hold(known.value, gram_hashes(words, SEED)[places])
                    at, places = at[some], places[some]
                    new = np.flatnonzero((np.diff(places, prepend=-1) != 0) | (np.diff(at, prepend=-1) != 1))
                    bounds = np.append(new, len(at))
                    # The words from the first to the last run, by their hashes at both ends and the length.
                    runs = gram_hashes(words, RUN)[at]
                    name = mix(runs[new] * np.uint64(BASE) + runs[bounds[1:] - 1] + np.diff(bounds).astype(np.uint64))
                    text = np.searchsorted(first, at[new], "right") - 1
                    of = pa.array(text)
                    yield pa.RecordBatch.from_arrays(
                        [
                            block.column(0).take(of),
                            block.column(1).take(of),
                            pa.array((at[new] - first[text]).astype(np.int64)),
                            pa.array(signed(name)),
                            pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(signed(runs))),
                        ],
                        names=["doc_id", "text_hash", "start", "chunk", "runs"],
                    )

        schema = "doc_id bigint, text_hash bigint, start bigint, chunk bigint, runs array<bigint>"
        return written(self.spark, self.docs.mapInArrow(rows, schema), "passage-chunks")

    def repeated(self, chunks: DataFrame) -> DataFrame:
        """``(chunk, keep_doc_id, keep_hash, shift, low, high, n)``: stretches of runs and where they occur first.

        ``shift`` is the place of the first occurrence less that in the chunk, ``low`` to ``high``.
        """
        place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "start")
        named = chunks.groupBy("chunk").agg(
            F.min(place).alias("at"), F.first("runs").alias("runs"), F.count(F.lit(1)).alias("n")
        )
        named = written(self.spark, named, "chunks-named")
        listed = named.select("chunk", "at", "n", F.posexplode("runs").alias("nth", "run"))
        word = (F.col("at.start") + F.col("nth")).alias("word")
        firsts = listed.select("run", "n", F.struct("at.none", "at.doc_id", "at.text_hash", word).alias("at"))
        firsts = firsts.groupBy("run").agg(F.min("at").alias("keep"), F.sum("n").alias("n")).where("n > 1")
        firsts = written(self.spark, firsts, "repeated-runs")
        met = listed.select("chunk", "nth", "run").join(firsts, "run").select(
            "chunk", "nth", "n", F.col("keep.doc_id").alias("keep_doc_id"), F.col("keep.text_hash").alias("keep_hash"),
            (F.col("keep.word") - F.col("nth")).alias("shift"),
        )
        # A chunk has at most RUN - SEED + 1 runs: a bit each.
        met = met.groupBy("chunk", "keep_doc_id", "keep_hash", "shift").agg(
            F.bit_or(F.expr("shiftleft(1L, nth)")).alias("bits"), F.max("n").alias("n")
        )
        ends = [
            F.expr(f"filter(sequence(0, {RUN - SEED}), k -> (shiftright(bits & ~{shift}, k) & 1) = 1)")
            for shift in ("shiftleft(bits, 1)", "shiftright(bits, 1)")
        ]
        met = met.withColumn("part", F.explode(F.arrays_zip(ends[0].alias("low"), ends[1].alias("high"))))
        return written(
            self.spark, met.select("chunk", "keep_doc_id", "keep_hash", "shift", "part.low", "part.high", "n"), "repeated-chunks"
        )

    def spans(self) -> DataFrame:
        """Every span of words that is repeated, the first ones too.

        doc_id, text_hash, first_word (from 0), n_words, keep_doc_id, keep_word, occurrences (the most of
        any run in it) and kept.
        """
        return settled(self.spark, self._spans, "passage-result")

    def _spans(self) -> DataFrame:
        chunks = self.chunks(self.seeds())
        found = chunks.drop("runs").join(self.repeated(chunks), "chunk").select(
            "doc_id", "text_hash", "keep_doc_id", "keep_hash", (F.col("shift") - F.col("start")).alias("shift"),
            (F.col("start") + F.col("low")).alias("low"), (F.col("start") + F.col("high")).alias("high"), "n",
        )
        same = ["doc_id", "text_hash", "keep_doc_id", "keep_hash", "shift"]
        here = Window.partitionBy("doc_id", "text_hash").orderBy(*same[2:], "low", "high")
        line = F.struct("keep_doc_id", "keep_hash", "shift")
        before = F.lag(F.struct(line.alias("line"), "high")).over(here)
        found = found.withColumn("before", before)
        joins = F.col("before.line").eqNullSafe(line) & (F.col("low") <= F.col("before.high") + 1)
        found = found.withColumn("island", F.sum(F.when(joins, 0).otherwise(1)).over(here.rowsBetween(Window.unboundedPreceding, 0)))
        spans = found.groupBy(*same, "island").agg(
            F.min("low").alias("first_word"), (F.max("high") - F.min("low") + RUN).alias("n_words"),
            (F.min("low") + F.col("shift")).alias("keep_word"), F.max("n").alias("occurrences"),
        )
        own = F.col("doc_id").eqNullSafe(F.col("keep_doc_id")) & (F.col("text_hash") == F.col("keep_hash"))
        return spans.select(
            "doc_id", "text_hash", "first_word", "n_words", "keep_doc_id", "keep_word", "occurrences",
            (own & (F.col("shift") == 0)).alias("kept"),
        )
