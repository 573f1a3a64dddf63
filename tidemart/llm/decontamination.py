"""Benchmark decontamination by spaced seeds.

Texts are cut into tokens of letters and digits, lower-cased, so that punctuation and layout do not
matter. A seed is the hash of some of the tokens in a short stretch: the fixed MASKS say which, and the
others are free to differ. Seeds of the benchmark and of the documents are joined, and around each hit
the two texts are laid on each other and compared token by token: a document is contaminated by an item
if WINDOW aligned tokens agree in all but ALLOWED. Items shorter than a window must agree as a whole
with fewer differences (``allowed``). The masks hit every such pair (a test tries all placements of the
differences), so nothing is lost between them.

Benchmark items are the small side, but nothing rests on it: documents drop seeds that a Bloom filter of
bounded size rules out, and the rest is joined by shuffle. What documents send along is only stretches
of token hashes around such seeds, once each. A passage that very many documents share is one row per
document and alignment.

Cases: items with fewer than SHORTEST tokens never match; null, empty and tokenless texts neither match
nor are contaminated. Rows that repeat are judged alike. A null doc_id or item_id is kept as such in the
result. An empty table on either side gives no overlaps. Texts are read whole; other columns may have
any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.bloom import filter_words, may_hold
from tidemart.llm.common import settled, whole_text, written
from tidemart.llm.hashing import BASE, LETTERS, mix, signed, text_blocks, word_hashes

# The positions that a seed looks at; the first mask also fits the shortest items.
MASKS = (
    (0, 1, 2, 3, 5, 6, 7),
    (0, 1, 2, 7, 9, 10, 11),
    (0, 1, 2, 3, 6, 7, 8),
    (0, 1, 3, 4, 7, 8, 9),
)
SHORTEST = 8
# Tokens of a document that alignments are met with at a time.
PIECE = 512
WINDOW = 20
ALLOWED = 3
# (tokens of the item, differences allowed) below a full window.
SHORT_ALLOWED = ((14, 2), (12, 1), (SHORTEST, 0))


def allowed(tokens: Column) -> Column:
    """Differences allowed in an overlap of so many tokens, at most WINDOW."""
    found = F.when(tokens >= WINDOW, F.lit(ALLOWED))
    for least, differences in SHORT_ALLOWED:
        found = found.when(tokens >= least, F.lit(differences))
    return found


def seeds(tokens: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """For each mask: the seeds at all positions, whether the position's mask stays in its text, its span."""
    ends = np.repeat(first[1:], np.diff(first))
    for number, mask in enumerate(MASKS):
        span = mask[-1] + 1
        places = max(0, len(tokens) - span + 1)
        total = np.full(places, number + 1, np.uint64)
        for k in mask:
            total = total * np.uint64(BASE) + tokens[k : k + places]
        yield mix(total), np.arange(places) + span <= ends[:places], span


def benchmark_items(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Items ``(item, item_id, tokens)`` long enough to match, and their seeds ``(seed, item, at)``.

    ``item`` numbers distinct texts by their hash, so equal items are compared once and both reported.
    """

    def tokenised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data, offsets in text_blocks(batch):
                tokens, first = word_hashes(data, offsets, LETTERS)
                found = [[] for _ in range(block.num_rows)]
                for hashes, inside, _ in seeds(tokens, first):
                    at = np.flatnonzero(inside)
                    owner = np.searchsorted(first, at, "right") - 1
                    for row, place, key in zip(owner, at - first[owner], signed(hashes[at])):
                        found[row].append({"seed": key, "at": place})
                texts = [signed(tokens[a:b]) for a, b in zip(first, first[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        block.column(0),
                        pa.array(texts, pa.list_(pa.int64())),
                        pa.array(found, pa.list_(pa.struct([("seed", pa.int64()), ("at", pa.int32())]))),
                    ],
                    names=["item_id", "tokens", "seeds"],
                )

    rows = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    rows = rows.mapInArrow(tokenised, "item_id bigint, tokens array<bigint>, seeds array<struct<seed: bigint, at: int>>")
    rows = rows.where(F.size("tokens") >= SHORTEST).withColumn("item", F.xxhash64("tokens"))
    rows = written(items.sparkSession, rows, "benchmark")
    distinct = rows.dropDuplicates(["item"])
    listed = distinct.select("item", F.explode("seeds").alias("s")).select("s.seed", "item", "s.at")
    return rows.select("item", "item_id", "tokens"), written(items.sparkSession, listed, "benchmark-seeds")


def stretches(docs: DataFrame, words: np.ndarray) -> DataFrame:
    """Stretches of documents around seeds that the Bloom filter lets pass.

    ``(stretch, doc_id, text_hash, start, tokens, hits)``: the number of the first token, token hashes
    with a window's margin at both ends, and the seeds with their place in the stretch.
    """
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        names = ["stretch", "doc_id", "text_hash", "start", "tokens", "hits"]
        hit_type = pa.list_(pa.struct([("seed", pa.int64()), ("at", pa.int32())]))
        for batch in batches:
            for block, data, offsets in text_blocks(batch):
                tokens, first = word_hashes(data, offsets, LETTERS)
                places, keys = [], []
                for hashes, inside, _ in seeds(tokens, first):
                    at = np.flatnonzero(inside)
                    at = at[may_hold(shared.value, hashes[at])]
                    places.append(at)
                    keys.append(hashes[at])
                places, keys = np.concatenate(places), np.concatenate(keys)
                if not len(places):
                    continue
                order = np.argsort(places, kind="stable")
                places, keys = places[order], keys[order]
                owner = np.searchsorted(first, places, "right") - 1
                cut = np.flatnonzero((np.diff(places) > 2 * WINDOW) | (np.diff(owner) > 0)) + 1
                bounds = np.concatenate([[0], cut, [len(places)]])
                row = owner[bounds[:-1]]
                start = np.maximum(first[row], places[bounds[:-1]] - WINDOW)
                end = np.minimum(first[row + 1], places[bounds[1:] - 1] + 2 * WINDOW)
                at = (places - np.repeat(start, np.diff(bounds))).astype(np.int32)
                hits = pa.StructArray.from_arrays([pa.array(signed(keys)), pa.array(at)], fields=list(hit_type.value_type))
                of = pa.array(row)
                numbers = number + np.arange(len(row))
                number += len(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(numbers, pa.int64()),
                        block.column(0).take(of),
                        block.column(1).take(of),
                        pa.array((start - first[row]).astype(np.int64)),
                        pa.array([signed(tokens[a:b]) for a, b in zip(start, end)], pa.list_(pa.int64())),
                        pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), hits),
                    ],
                    names=names,
                )

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(whole_text(F.col("text"))).alias("text_hash"),
        F.col("text").cast("string").alias("text"),
    )
    schema = (
        "stretch bigint, doc_id bigint, text_hash bigint, start bigint, tokens array<bigint>,"
        " hits array<struct<seed: bigint, at: int>>"
    )
    return written(docs.sparkSession, rows.mapInArrow(found, schema), "stretches")


def overlaps(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Verified overlaps, one row per document row, item and alignment.

    doc_id, text_hash, item_id, doc_start (first token of the overlap), item_start, n_tokens, n_equal
    (equal tokens in it) and best_window (most equal tokens in a window).
    """
    return settled(spark, lambda: _overlaps(spark, docs, benchmark), "overlap-result")


def _overlaps(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    items, listed = benchmark_items(benchmark)
    around = stretches(docs, filter_words(listed, F.col("seed")))
    hits = around.select("stretch", F.explode("hits").alias("h")).select("stretch", "h.seed", F.col("h.at").alias("place"))
    laid = hits.join(listed, "seed").select("stretch", "item", (F.col("place") - F.col("at")).alias("shift")).distinct()
    laid = laid.withColumn("piece", F.expr(f"greatest(shift, 0) div {PIECE}"))
    laid = written(spark, laid, "alignments")

    # An alignment takes the piece of its stretch that it starts in, with all that the longest item can reach.
    reach = items.agg(F.max(F.size("tokens"))).first()[0] or 0
    texts = around.select(
        "stretch", "doc_id", "text_hash", "start", "tokens",
        F.explode(F.expr(f"sequence(0L, greatest(size(tokens) - 1, 0) div {PIECE})")).alias("piece"),
    )
    texts = texts.select(
        "stretch", "piece", "doc_id", "text_hash", (F.col("start") + F.col("piece") * PIECE).alias("start"),
        F.slice("tokens", (F.col("piece") * PIECE + 1).cast("int"), F.lit(PIECE + reach)).alias("own"),
    )
    met = laid.join(texts, ["stretch", "piece"]).withColumn("shift", F.col("shift") - (F.col("piece") * PIECE).cast("int"))
    met = met.join(items.select("item", F.col("tokens").alias("theirs")).dropDuplicates(["item"]), "item")
    # Aligned tokens: from item_start of the item, which lies shift tokens into the stretch.
    met = met.withColumn("item_start", F.greatest(F.lit(0), -F.col("shift")))
    met = met.withColumn("own_start", F.col("item_start") + F.col("shift"))
    met = met.withColumn(
        "n_tokens", F.least(F.size("theirs") - F.col("item_start"), F.size("own") - F.col("own_start"))
    )
    met = met.withColumn(
        "equal",
        F.zip_with(
            F.slice("own", F.col("own_start") + 1, F.greatest("n_tokens", F.lit(0))),
            F.slice("theirs", F.col("item_start") + 1, F.greatest("n_tokens", F.lit(0))),
            lambda a, b: (a == b).cast("int"),
        ),
    )
    window = F.least(F.lit(WINDOW), F.size("theirs"))
    met = met.withColumn("window", window).where(F.col("n_tokens") >= F.col("window"))
    sums = F.transform(
        F.sequence(F.lit(1), F.col("n_tokens") - F.col("window") + 1),
        lambda k: F.aggregate(F.slice("equal", k, F.col("window")), F.lit(0), lambda total, x: total + x),
    )
    met = met.withColumn("best_window", F.array_max(sums))
    met = met.where(F.col("best_window") >= F.col("window") - allowed(F.col("window")))
    met = met.select(
        "item", "doc_id", "text_hash", (F.col("start") + F.col("own_start")).alias("doc_start"), "item_start", "n_tokens",
        F.aggregate("equal", F.lit(0), lambda total, x: total + x).alias("n_equal"), "best_window",
    )
    met = written(spark, met, "overlaps")
    named = items.select("item", "item_id")
    return met.join(named, "item").drop("item").select(
        "doc_id", "text_hash", "item_id", "doc_start", "item_start", "n_tokens", "n_equal", "best_window"
    )


def decontaminate(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without contaminated ones, with all their columns."""
    bad = overlaps(spark, docs, benchmark).select(F.col("doc_id").alias("bad_id"), "text_hash").distinct()
    bad = written(spark, bad, "contaminated")
    kept = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"),
        F.col("doc_id").cast("bigint").alias("own_id"),
        F.xxhash64(whole_text(F.col("text"))).alias("own_hash"),
    ).join(bad, F.col("own_id").eqNullSafe(F.col("bad_id")) & (F.col("own_hash") == F.col("text_hash")), "left_anti")
    return kept.select(*(F.col(f"doc.`{c}`").alias(c) for c in docs.columns))
