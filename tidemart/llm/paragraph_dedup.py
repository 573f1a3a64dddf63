"""Substring deduplication: MinHash bands over overlapping paragraphs of whole texts, exact Jaccard, components, spans.

A paragraph is a stretch of STRETCH words, wherever it lies in a text: inside a line or across line breaks. Paragraphs
start at the least 5-word hash of every window of WINDOW words, so equal passages have equal paragraphs, whatever is around
them, and each run of WINDOW + STRETCH + 3 equal words holds one at least. A paragraph's set are its distinct 5-word shingles.
Bands of their hashes are so laid that every two paragraphs of the threshold's similarity share one. Paragraphs that share a band
are compared exactly, and links are closed to clusters.

At the threshold two paragraphs of 16 shingles differ in one shingle each at most (``tuned_bands``). Such a shingle lies at an end,
so that a band is the run of all shingles but the first, or but the last: a paragraph that differs in an edge word, or begins a word
later, has one of them too. Only where a paragraph has the same three words twice can shingles be met in another order, or a shingle
come twice; then both paragraphs have three equal words twice, or share a run, or are equal (a shingle that is not in the other
joins two places there only if three words of these are equal). Such paragraphs also have bands of one value, their least MinHash values, as many as two
sets may differ in plus one. With lower thresholds all paragraphs have these.

A cluster's paragraphs are all met with its first occurrence, by doc_id and place. Paragraphs of a text that
have an earlier occurrence are joined to spans: those that touch or overlap, and those up to GAP words apart whose
first occurrences are as far apart in one text, up to SLACK words more or less. A span then grows word by word at
both ends as far as a first occurrence of its paragraphs goes on alike. It is a repeated passage if it has ``min_words`` words or more and at least num / den of them are in
its paragraphs or grown. These ``remove_repeats`` cuts from their texts. In the same way, paragraphs that are first
occurrences give the passages that are kept.

Only paragraphs are listed that share a band with another place (a paragraph's neighbour that begins a word later is none), by a Bloom filter of a size with a fixed
bound, which spares the rest the shuffle. No pairs of occurrences are made; equal sets are one node, and a
band's nodes are compared with its most central one first, and only where components are still apart with others
(see ``linking``).

Cases: null and empty texts, and those with fewer words than a window, have no paragraphs. Rows that repeat an id and
text are judged alike. A null id is larger than any other. A passage that repeats within one text is removed there
too, unless it overlaps itself. An empty table gives no rows. Texts are read whole. Extra columns pass through
``remove_repeats``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemart.llm.bloom import filter_words, may_hold
from tidemart.llm.common import WORD, settled, whole_text, written
from tidemart.llm.hashing import BASE, gram_hashes, mix, signed, text_blocks, word_hashes
from tidemart.llm.linking import Linker, bitmap

MIN_WORDS = 50
STRETCH = 20
WINDOW = 24
SIZE = 5
SHINGLES = STRETCH - SIZE + 1
# Equal words at two places that let shingles be met in another order.
THREE = SIZE - 2
# Words beside a paragraph that spans may grow into; what is further away has a paragraph of its own.
MARGIN = WINDOW + SIZE - 1
GAP = 10
SLACK = 3
# A bit more than Bloom filters have elsewhere: 32 MB at most.
FILTER_BITS = 1 << 28


def tuned_bands(threshold: float) -> int:
    """How many shingles of a paragraph hold one at least that is in any other of this similarity, if no shingle comes twice."""
    return SHINGLES - math.ceil(2 * SHINGLES * threshold / (1 + threshold) - 1e-9) + 1


class Paragraphs:
    """The paragraphs of a block of texts.

    ``places`` are their first words among the block's, ``first`` per text its first word (n + 1), and ``shingles``
    has a column of SHINGLES hashes for each.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.words, self.first = word_hashes(data, offsets)
        self.grams = gram_hashes(self.words, SIZE)
        owner = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        reach = WINDOW + SIZE - 1
        if len(self.words) < max(reach, STRETCH):
            self.places = np.zeros(0, np.int64)
        else:
            inside = np.flatnonzero(owner[: len(owner) - reach + 1] == owner[reach - 1 :])
            windows = np.lib.stride_tricks.sliding_window_view(self.grams, WINDOW)
            places = np.unique(inside + windows.argmin(axis=1)[inside])
            places = places[places + STRETCH <= len(self.words)]
            places = places[owner[places] == owner[places + STRETCH - 1]]
            # Text of one repeated word has a paragraph at every word; each STRETCH-th of them says the same.
            last = places + SHINGLES - 1
            same = (np.diff(places, prepend=-2) == 1) & (self.grams[places] == self.grams[places - 1])
            same &= self.grams[last] == self.grams[last - 1]
            nth = np.arange(len(places))
            self.places = places[(nth - np.maximum.accumulate(np.where(same, 0, nth))) % STRETCH == 0]
        self.owner = owner[self.places]
        self.shingles = self.grams[self.places + np.arange(SHINGLES)[:, None]]

    def looping(self) -> np.ndarray:
        """Per paragraph whether it has the same THREE words twice."""
        grams = gram_hashes(self.words, THREE)
        # Paragraphs that begin from the last place that still holds the second of two up to the first: +1 and -1.
        steps = np.zeros(len(self.words) + 1, np.int64)
        for apart in range(1, STRETCH - THREE + 1):
            second = np.flatnonzero(grams[apart:] == grams[:-apart]) + apart
            np.add.at(steps, np.maximum(second + THREE - STRETCH, 0), 1)
            np.add.at(steps, second - apart + 1, -1)
        return np.cumsum(steps)[self.places] > 0

    def bands(self, bands: int) -> np.ndarray:
        """Per paragraph the values of its ``bands`` runs of shingles, each as long as the number leaves room for."""
        rows = SHINGLES - bands + 1
        mixed = mix(self.shingles + np.uint64(2))
        return mix(np.stack([mixed[k : k + rows].sum(axis=0, dtype=np.uint64) for k in range(bands)], axis=1))

    def keys(self, num: int, den: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All bands as ``(paragraph, value)``, and whether the value is the one of a neighbour that begins a word earlier."""
        every = np.arange(len(self.places))
        if num * (SHINGLES + 2) <= den * (SHINGLES - 2):
            # Similar sets may differ in two shingles each.
            runs, some = np.zeros((len(every), 0), np.uint64), every
        else:
            runs, some = self.bands(2), np.flatnonzero(self.looping())
        again = np.zeros(runs.shape, bool)
        if runs.shape[1]:
            again[1:, 0] = (np.diff(self.places) == 1) & (self.owner[1:] == self.owner[:-1])
            again[some, 0] = False
        # The least values of sets: as many as may be missing in a set of the threshold's similarity, and one more.
        hashed = np.sort(mix(self.shingles[:, some] + np.uint64(3)), axis=0)
        new = np.ones(hashed.shape, bool)
        new[1:] = hashed[1:] != hashed[:-1]
        size = new.sum(axis=0)
        wanted = size + 1 - (size * num + den - 1) // den
        rank, of = np.nonzero(new & (np.cumsum(new, axis=0) <= wanted))
        paragraph = np.concatenate([np.repeat(every, runs.shape[1]), some[of]])
        values = np.concatenate([runs.reshape(-1), mix(hashed[rank, of])])
        return paragraph, values, np.concatenate([again.reshape(-1), np.zeros(len(of), bool)])

    def nodes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Names of the paragraphs' sets, their sorted shingles, and which of these are the first of their value."""
        ordered = np.sort(self.shingles, axis=0)
        new = np.ones(ordered.shape, bool)
        new[1:] = ordered[1:] != ordered[:-1]
        total = np.where(new, mix(ordered + np.uint64(1)), np.uint64(0)).sum(axis=0, dtype=np.uint64)
        return (mix(total) >> np.uint64(1)).astype(np.int64), ordered, new

    def beside(self, step: int) -> np.ndarray:
        """Per paragraph the MARGIN words behind it (``step`` 1) or before it, nearest first (-1), as 15 bits; 0 beyond the text."""
        start = self.places + STRETCH if step > 0 else self.places - 1
        at = start[:, None] + step * np.arange(MARGIN)
        inside = (at >= self.first[self.owner][:, None]) & (at < self.first[self.owner + 1][:, None])
        words = (self.words[np.clip(at, 0, max(len(self.words) - 1, 0))] >> np.uint64(49)).astype(np.int16) | 1
        return np.where(inside, words, 0).astype(np.int16)


def _lists(values: np.ndarray) -> pa.ListArray:
    """Rows of a matrix as lists."""
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.reshape(-1)))


def _grouped(owner: np.ndarray, values: np.ndarray, n: int) -> pa.ListArray:
    """The values of each of ``n`` owners as lists."""
    order = np.argsort(owner, kind="stable")
    offsets = np.searchsorted(owner[order], np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values[order]))


class ParagraphDedup:
    """Repeated passages of ``docs`` (doc_id, text)."""

    def __init__(self, spark: SparkSession, docs: DataFrame, min_words: int = MIN_WORDS, num: int = 80, den: int = 100):
        self.spark, self.docs = spark, docs
        self.min_words, self.num, self.den = min_words, num, den
        self.light = docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            F.xxhash64(whole_text(F.col("text"))).alias("text_hash"),
            F.col("text").cast("string").alias("text"),
        )

    def shared(self) -> DataFrame:
        """``(signature)`` of the bands that occur at several places."""
        num, den = self.num, self.den

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for _, data, offsets in text_blocks(batch):
                    _, values, again = Paragraphs(data, offsets).keys(num, den)
                    keys, n = np.unique(values[~again], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(signed(keys)), pa.array(n)], names=["signature", "n"])

        found = self.light.select("text").mapInArrow(rows, "signature bigint, n bigint")
        found = found.groupBy("signature").agg(F.sum("n").alias("n")).where("n > 1").select("signature")
        return written(self.spark, found, "shared-bands")

    def listed(self, shared: DataFrame) -> DataFrame:
        """``(doc_id, text_hash, start, node, again, bands, before, after)`` of the paragraphs with a shared band.

        ``again``: whether it is in the cluster of a neighbour that begins a word earlier, with which it is one occurrence.
        """
        num, den = self.num, self.den
        known = self.spark.sparkContext.broadcast(filter_words(shared, F.col("signature"), FILTER_BITS))

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block, data, offsets in text_blocks(batch):
                    found = Paragraphs(data, offsets)
                    paragraph, values, again = found.keys(num, den)
                    held = may_hold(known.value, values)
                    some, nth = np.unique(paragraph[held], return_inverse=True)
                    of = pa.array(found.owner[some])
                    yield pa.RecordBatch.from_arrays(
                        [
                            block.column(0).take(of),
                            block.column(1).take(of),
                            pa.array((found.places - found.first[found.owner])[some]),
                            pa.array(found.nodes()[0][some]),
                            pa.array(np.isin(some, paragraph[held & again])),
                            _grouped(nth, signed(values[held]), len(some)),
                            _lists(found.beside(-1)[some]),
                            _lists(found.beside(1)[some]),
                        ],
                        names=["doc_id", "text_hash", "start", "node", "again", "bands", "before", "after"],
                    )

        schema = (
            "doc_id bigint, text_hash bigint, start bigint, node bigint, again boolean, bands array<bigint>, "
            "before array<smallint>, after array<smallint>"
        )
        return written(self.spark, self.light.mapInArrow(rows, schema), "paragraphs")

    def sets(self, nodes: DataFrame) -> DataFrame:
        """``(node, rep, elements, bits)`` of the nodes asked for."""
        known = self.spark.sparkContext.broadcast(filter_words(nodes, F.col("node")))

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for _, data, offsets in text_blocks(batch):
                    names, ordered, new = Paragraphs(data, offsets).nodes()
                    keys, at = np.unique(names, return_index=True)
                    some = may_hold(known.value, keys.view(np.uint64))
                    sets = [ordered[new[:, k], k] for k in at[some]]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(keys[some]),
                            pa.array([signed(s) for s in sets], pa.list_(pa.int64())),
                            pa.array([bitmap(s) for s in sets], pa.list_(pa.int64())),
                        ],
                        names=["node", "elements", "bits"],
                    )

        found = self.light.select("text").mapInArrow(rows, "node bigint, elements array<bigint>, bits array<bigint>")
        found = found.dropDuplicates(["node"]).join(nodes, "node", "left_semi")
        return written(self.spark, found.select("node", F.col("node").alias("rep"), "elements", "bits"), "paragraph-sets")

    def targets(self, listed: DataFrame) -> DataFrame:
        """``(node, to, occurrences)``: the first place of all paragraphs that are equal or linked to the node's, and their number.

        The tables of the way there, the larger part of the disk that is used, are deleted before it is joined.
        """
        return settled(self.spark, lambda: self._targets(listed), "paragraph-targets")

    def _targets(self, listed: DataFrame) -> DataFrame:
        place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "start", "before", "after")
        nodes = listed.groupBy("node").agg(
            F.first("bands").alias("bands"), F.min(place).alias("at"), F.count(F.lit(1)).alias("n"), F.count_if("again").alias("again")
        )
        nodes = written(self.spark, nodes, "paragraph-nodes")
        banded = nodes.select("node", F.explode("bands").alias("signature"))
        met = banded.groupBy("signature").agg(F.min("node").alias("leader"), F.max("node").alias("last"))
        met = written(self.spark, met.where("leader < last").select("signature", "leader"), "bands-met")
        groups = written(self.spark, banded.join(met, "signature").where("node <> leader"), "band-groups")
        paired = groups.select(F.explode(F.array("leader", "node")).alias("node")).distinct()
        sets = self.sets(written(self.spark, paired, "paired-nodes"))
        reps = nodes.select("node", F.col("node").alias("rep"))
        labels = Linker(self.spark, self.num, self.den).components(groups, reps, sets)
        labels = written(self.spark, labels, "paragraph-labels")

        # Few nodes are linked with others; all others are their cluster.
        alone = nodes.join(labels, "node", "left_anti").where("n > 1")
        linked = written(self.spark, nodes.join(labels, "node").select("node", "component", "at", (F.col("n") - F.col("again")).alias("n")), "linked-nodes")
        firsts = linked.groupBy("component").agg(F.min("at").alias("to"), F.sum("n").alias("occurrences"))
        linked = linked.select("node", "component").join(firsts, "component")
        return linked.select("node", "to", "occurrences").union(
            alone.select("node", F.col("at").alias("to"), F.col("n").alias("occurrences"))
        )

    def links(self) -> DataFrame:
        """Every paragraph with the first occurrence of its cluster, where that is another one.

        doc_id, text_hash, start, to_doc, to_hash, to_start, occurrences, and how many words before and behind both agree.
        """
        listed = self.listed(self.shared())
        met = listed.drop("bands", "again").join(self.targets(listed), "node")
        same = F.col("doc_id").eqNullSafe(F.col("to.doc_id")) & (F.col("text_hash") == F.col("to.text_hash"))
        apart = F.abs(F.col("start") - F.col("to.start")) >= STRETCH
        met = met.where(~same | apart).select(
            "doc_id", "text_hash", "start", F.col("to.doc_id").alias("to_doc"), F.col("to.text_hash").alias("to_hash"),
            F.col("to.start").alias("to_start"), "occurrences",
            grown(F.col("before"), F.col("to.before")).alias("left"),
            grown(F.col("after"), F.col("to.after")).alias("right"),
        )
        return written(self.spark, met, "paragraph-links")

    def spans(self) -> DataFrame:
        """Every passage of ``min_words`` words or more that repeats, the first ones too.

        doc_id, text_hash, first_word (from 0), n_words, n_equal (words in equal or similar paragraphs, or grown), keep_doc_id and
        keep_word (where its first paragraph is met), occurrences, and kept: true where the passage comes again later, false where it came
        before. One that did and does has two rows.
        """
        return settled(self.spark, self._spans, "passages")

    def _spans(self) -> DataFrame:
        links = self.links()
        # The first occurrences, each with one of those that come again.
        firsts = links.groupBy("to_doc", "to_hash", "to_start").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "start")).alias("again"),
            F.max("left").alias("left"), F.max("right").alias("right"), F.max("occurrences").alias("occurrences"),
        )
        links = links.withColumn("end", F.lit(0)).unionByName(
            firsts.select(
                F.col("to_doc").alias("doc_id"), F.col("to_hash").alias("text_hash"), F.col("to_start").alias("start"),
                F.col("again.doc_id").alias("to_doc"), F.col("again.text_hash").alias("to_hash"),
                F.col("again.start").alias("to_start"), "occurrences", "left", "right", F.lit(1).alias("end"),
            )
        )
        text = ["doc_id", "text_hash", "end"]
        here = Window.partitionBy(*text).orderBy("start")
        step, to_step = (F.col(c) - F.lag(c).over(here) for c in ("start", "to_start"))
        with_same = F.lag("to_doc").over(here).eqNullSafe(F.col("to_doc")) & (F.lag("to_hash").over(here) == F.col("to_hash"))
        links = links.withColumns({"step": step, "to_step": to_step, "with_same": with_same})
        in_line = F.col("with_same") & (F.col("to_step") >= 0) & (F.abs(F.col("step") - F.col("to_step")) <= SLACK)
        follows = (F.col("step") <= STRETCH) | in_line & (F.col("step") <= STRETCH + GAP)
        links = links.withColumn("new", F.when(follows, 0).otherwise(1))
        links = links.withColumn("span", F.sum("new").over(here.rowsBetween(Window.unboundedPreceding, 0)))
        own = F.when(F.col("new") == 1, STRETCH).otherwise(F.least("step", F.lit(STRETCH)))
        # Any of its paragraphs may let a span grow.
        spans = links.withColumn("own", own).groupBy(*text, "span").agg(
            F.min_by(F.struct("start", "to_doc", "to_start"), "start").alias("low"),
            F.max("start").alias("last"),
            F.min(F.col("start") - F.col("left")).alias("first_word"),
            F.max(F.col("start") + STRETCH + F.col("right")).alias("end_word"),
            F.sum("own").alias("own"),
            F.max("occurrences").alias("occurrences"),
        )
        spans = spans.withColumn("n_words", F.col("end_word") - F.col("first_word"))
        ends = F.col("n_words") - (F.col("last") + STRETCH - F.col("low.start"))
        spans = spans.withColumn("n_equal", F.col("own") + ends)
        spans = spans.where((F.col("n_words") >= self.min_words) & (F.col("n_equal") * self.den >= F.col("n_words") * self.num))
        return spans.select(
            "doc_id", "text_hash", "first_word", "n_words", "n_equal", F.col("low.to_doc").alias("keep_doc_id"),
            (F.col("low.to_start") - F.col("low.start") + F.col("first_word")).alias("keep_word"), "occurrences", (F.col("end") == 1).alias("kept"),
        )

    def remove_repeats(self) -> DataFrame:
        """``docs`` with all their columns, without the passages that repeat earlier ones."""
        gone = self.spans().where("not kept").groupBy("doc_id", "text_hash").agg(
            F.collect_set(F.struct("first_word", (F.col("first_word") + F.col("n_words")).alias("end"))).alias("gone")
        )
        gone = written(self.spark, gone, "removed-passages").select(
            F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash"),
            F.col("gone.first_word").alias("starts"), F.col("gone.end").alias("ends"),
        )
        columns = self.docs.columns
        rows = self.docs.select(
            F.struct(*(F.col(f"`{c}`") for c in columns)).alias("doc"),
            F.col("doc_id").cast("bigint").alias("own_id"),
            F.xxhash64(whole_text(F.col("text"))).alias("own_hash"),
        ).join(gone, F.col("own_id").eqNullSafe(F.col("gone_id")) & (F.col("own_hash") == F.col("gone_hash")), "left")
        cut = F.pandas_udf(lambda *given: pd.Series([without(*row) for row in zip(*given)], dtype=object), "string")
        text = F.when(F.col("starts").isNull(), F.col("doc.text")).otherwise(cut("doc.text", "starts", "ends"))
        rows = rows.select("doc", text.alias("new_text"))
        return rows.select(*(F.col("new_text" if c == "text" else f"doc.`{c}`").alias(c) for c in columns))


def grown(own: Column, other: Column) -> Column:
    """How many words of two lists agree from their start on."""
    agrees = F.zip_with(own, other, lambda x, y: (x == y) & (x != 0))
    first = F.array_position(agrees, False)
    return F.when(first == 0, F.size(own)).otherwise((first - 1).cast("int"))


def without(text: str | None, starts: list[int] | None, ends: list[int] | None) -> str | None:
    """A text without the words from each start up to the end, and the white space behind them."""
    if text is None or starts is None:
        return text
    places = [found.start() for found in re.finditer(WORD, text)] + [len(text)]
    kept, at = [], 0
    for start, end in sorted(zip(starts, ends)):
        if end > at:
            kept.append(text[(places[at] if at else 0) : places[max(start, at)]])
            at = end
    return "".join(kept) + text[(places[at] if at else 0) :]
