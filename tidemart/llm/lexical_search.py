"""Ranked lexical search by one scan of the documents: an Aho-Corasick automaton of all items' terms.

Terms are runs of letters, digits and all that is not ASCII, with A-Z lower-cased. Everything else becomes a
blank, and each term goes into the automaton between two blanks, so that it is found as a whole word only;
neighbouring words share the blank between them. One scan gives every document's number of terms and how often each
item term occurs in it. There is no index of the documents: the counts are written, the number of documents
that hold each term is summed up from them, and a second pass over the counts alone scores documents through
the list of items that each term leads to.

A document's score for an item is a sum over the item's terms, repeats included, in 64-bit integers (see
``weights`` and ``Search.scored``). Each task keeps the K best documents of each item, of all that it saw; the best of
those are the best of all, so nothing is lost by it.

Bounds: the automaton, its terms' weights and their items go to all tasks. Items are therefore
taken in blocks of about ITEM_BYTES of text, measured first, one scan for each block; a task holds one
block's automaton, K rows per item, and MATRIX scores at a time. A document is read whole.

Cases: a null or empty text has no terms, and neither does one of punctuation only: such documents count nowhere, such items get no
rows. Rows that repeat an id or a text are documents, and items, of their own: a repeated item_id has ranks for
each of its rows. A null doc_id ranks behind all others of its score. Columns other than id and text
are ignored. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.llm.common import settled, written
from tidemart.llm.hashing import text_bytes

BEST = 20
ITEM_BYTES = 2 << 20
MATRIX = 1 << 21
LAST = np.iinfo(np.int64).max

# Bytes of a text: A-Z folded, digits, letters and everything beyond ASCII kept, all others blank.
TERM_BYTES = bytes(
    b if b >= 128 or chr(b).isalnum() else 0x20 for b in (x + 32 if 65 <= x <= 90 else x for x in range(256))
)
# Fixed values of the score: length normalisation in hundredths, saturation, and the scales of both factors.
SLOPE, SATURATION, UNIT, SCALE = 25, 12, 1000, 1_000_000_000


def terms(text: str | None) -> list[bytes]:
    """A text's terms in order, as UTF-8."""
    return (text or "").encode().translate(TERM_BYTES).split()


@dataclass
class Items:
    """A block of items: their ids, all their distinct terms, and which items a term leads to, how often.

    The items of term t are ``items[first[t]:first[t + 1]]``.
    """

    ids: list[int | None]
    terms: list[bytes]
    first: np.ndarray
    items: np.ndarray
    times: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[int | None, str | None]]) -> Items:
        leads: dict[bytes, list[tuple[int, int]]] = {}
        for number, (_, text) in enumerate(rows):
            for term, times in Counter(terms(text)).items():
                leads.setdefault(term, []).append((number, times))
        flat = [lead for leads_to in leads.values() for lead in leads_to]
        return cls(
            [item_id for item_id, _ in rows],
            list(leads),
            np.cumsum([0, *map(len, leads.values())]),
            np.array([number for number, _ in flat], np.int64),
            np.array([times for _, times in flat], np.int64),
        )

    def automaton(self) -> ahocorasick.Automaton:
        """Finds a term's number at each whole occurrence; bytes are taken as characters."""
        built = ahocorasick.Automaton()
        for number, term in enumerate(self.terms):
            built.add_word(f" {term.decode('latin-1')} ", number)
        built.make_automaton()
        return built


def weights(holders: np.ndarray, documents: int) -> np.ndarray:
    """Each term's weight from the number of documents that hold it."""
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in holders], np.int64)


class Ranking:
    """The best documents of each item among those shown so far: by score, then the smaller id."""

    def __init__(self, items: int, best: int):
        self.best = best
        self.kept = [np.zeros(0, np.int64) for _ in range(3)]
        self.waiting: list[list[np.ndarray]] = []
        self.floor = np.zeros(items, np.int64)
        self.floor_id = np.full(items, np.iinfo(np.int64).min)
        self.size = 0

    def show(self, scores: np.ndarray, ids: np.ndarray) -> None:
        """``scores`` of documents by items; ``ids`` has LAST for null."""
        better = (scores > self.floor) | ((scores == self.floor) & (ids[:, None] < self.floor_id))
        rows, items = np.nonzero(better)
        self.waiting.append([items, scores[rows, items], ids[rows]])
        self.size += len(rows)
        if self.size > MATRIX:
            self.settle()

    def settle(self) -> list[np.ndarray]:
        """Items, scores and ids of the best, in order."""
        item, score, doc = (np.concatenate(part) for part in zip(self.kept, *self.waiting))
        order = np.lexsort((doc, -score, item))
        item, score, doc = item[order], score[order], doc[order]
        starts = np.searchsorted(item, item)
        place = np.arange(len(item)) - starts
        kept = place < self.best
        full = place == self.best - 1
        self.floor[item[full]], self.floor_id[item[full]] = score[full], doc[full]
        self.kept, self.waiting, self.size = [item[kept], score[kept], doc[kept]], [], 0
        return self.kept


class Search:
    """Ranks ``docs`` (doc_id, text) for each of ``items`` (item_id, text)."""

    def __init__(self, spark: SparkSession, docs: DataFrame, items: DataFrame, best: int = BEST):
        self.spark, self.best = spark, best
        self.docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
        self.items = items.select(
            F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")
        ).where("text is not null")

    def blocks(self) -> Iterator[Items]:
        """The items in blocks of bounded size, by a hash of id and text."""
        size = self.items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        count = max(1, math.ceil(size / ITEM_BYTES))
        for block in range(count):
            of_block = self.items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == block)
            found = Items.of(sorted(((r.item_id, r.text) for r in of_block.collect()), key=lambda r: (r[0] is None, r)))
            if found.terms:
                yield found

    def counted(self, items: Items) -> DataFrame:
        """``(doc_id, n, terms, tf)`` of every document that has a term: its length, and the item terms in it."""
        known = self.spark.sparkContext.broadcast(items)

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = known.value.automaton()
            number = itemgetter(1)
            for batch in batches:
                data, offsets = text_bytes(batch.column(1))
                data = data.tobytes().translate(TERM_BYTES)
                lengths, found = [], []
                for start, end in zip(offsets[:-1], offsets[1:]):
                    text = data[start:end]
                    lengths.append(len(text.split()))
                    found.append(Counter(map(number, automaton.iter(f" {text.decode('latin-1')} "))))
                bounds = np.cumsum([0, *map(len, found)]).astype(np.int32)
                numbers = np.fromiter((t for f in found for t in f.keys()), np.int32, bounds[-1])
                times = np.fromiter((t for f in found for t in f.values()), np.int64, bounds[-1])
                out = pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(lengths, pa.int64()),
                        pa.ListArray.from_arrays(bounds, numbers),
                        pa.ListArray.from_arrays(bounds, times),
                    ],
                    names=["doc_id", "n", "terms", "tf"],
                )
                yield out.filter(pa.array(np.array(lengths, np.int64) > 0))

        schema = "doc_id bigint, n bigint, terms array<int>, tf array<bigint>"
        return written(self.spark, self.docs.mapInArrow(rows, schema), "search-counts")

    def scored(self, items: Items, counts: DataFrame) -> DataFrame:
        """``(item, score, doc_id)``: each task's best documents of each item of the block."""
        documents, total = counts.agg(F.count(F.lit(1)), F.sum("n")).first()
        holders = np.zeros(len(items.terms), np.int64)
        for row in counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            holders[row[0]] = row[1]
        known = self.spark.sparkContext.broadcast((items, weights(holders, documents)))
        best = self.best

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items, weight = known.value
            ranking = Ranking(len(items.ids), best)
            step = max(1, MATRIX // len(items.ids))
            for batch in batches:
                for start in range(0, batch.num_rows, step):
                    part = batch.slice(start, step)
                    ranking.show(scores(part, items, weight, documents, total), part.column(0).fill_null(LAST).to_numpy())
            item, score, doc = ranking.settle()
            yield pa.RecordBatch.from_arrays(
                [pa.array(item.astype(np.int32)), pa.array(score), pa.array(doc, mask=doc == LAST)],
                names=["item", "score", "doc_id"],
            )

        return counts.where(F.size("terms") > 0).mapInArrow(rows, "item int, score bigint, doc_id bigint")

    def ranked(self) -> DataFrame:
        """``(item_id, rank, doc_id, score)``."""
        found = []
        for items in self.blocks():
            top = written(self.spark, self.scored(items, self.counted(items)), "search-best")
            order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
            top = top.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= self.best)
            ids = self.spark.createDataFrame(list(enumerate(items.ids)), "item int, item_id bigint")
            found.append(top.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score"))
        if not found:
            return self.spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
        return reduce(DataFrame.union, found)


def scores(batch: pa.RecordBatch, items: Items, weight: np.ndarray, documents: int, total: int) -> np.ndarray:
    """Scores of a batch of ``(doc_id, n, terms, tf)`` by items, in 64-bit integers."""
    n = batch.column(1).to_numpy()
    held, times = batch.column(2).flatten().to_numpy(), batch.column(3).flatten().to_numpy()
    lengths = batch.column(2).value_lengths().to_numpy()
    of = np.repeat(np.arange(batch.num_rows), lengths)
    m = 100 - SLOPE + SLOPE * n * documents // total
    part = weight[held] * (SCALE * times // (UNIT * times + SATURATION * m[of]))
    # Every (document, term) meets the items that the term leads to.
    reach = items.first[held + 1] - items.first[held]
    at = np.arange(reach.sum()) + np.repeat(items.first[held] - (np.cumsum(reach) - reach), reach)
    found = np.zeros(batch.num_rows * len(items.ids), np.int64)
    np.add.at(found, np.repeat(of, reach) * len(items.ids) + items.items[at], np.repeat(part, reach) * items.times[at])
    return found.reshape(batch.num_rows, len(items.ids))


def lexical_search(spark: SparkSession, docs: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """Each item's ``best`` documents as ``(item_id, rank, doc_id, score)``; the counts are deleted at the end."""
    return settled(spark, Search(spark, docs, items, best).ranked, "lexical-search")
