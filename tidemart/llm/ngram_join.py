"""Similarity join of documents on their word n-grams, by signatures of parts of the shingle domain.

Two documents link when the Jaccard similarity of their sets of distinct n-word shingles reaches the
threshold t (a fraction num / den). The join is exact and never looks at all pairs:

* **Bands.** Sets are grouped by size, doubling from band to band. A pair is found in the band of its
  larger set, so a set also signs in the next band when it could have a partner there.
* **Parts.** In each band the domain of shingles is cut by a hash into a fixed number of parts. Two sets
  with at most d different elements differ in at most d parts, and similarity t bounds d by their sizes.
  A signature is a part's number and the hash of the set's elements in it, so the pair has all
  signatures but d in common. Parts outnumber the greatest d of their band.
* **Prefixes.** PartEnum would enumerate subsets of parts; single parts do here. Of each set only d + 1 signatures are needed, if all sets choose by one order: with all
  but d in common, the first d + 1 of either must share one. The order puts signatures known to be
  frequent last, those of parts with more elements first, and empty parts last of all. So passages that
  very many documents share cost next to nothing. The frequent ones come from lossy counting over all
  documents (a count per task, kept from two on); they only steer the order, never the result.

Equal sets are joined to one node first. Signatures with several nodes are found in one sorted pass, in
which frequent ones are dealt over sub-groups first, and whose nodes are then linked (see ``linking``):
similarities are counted exactly, and links are closed to components.

Cases: null, empty and blank-only texts have no shingles and link with nothing; a text with fewer words
than n has its whole sequence as its one shingle. Rows without an id are linked like others and take the component
of the documents that they reach, or null. Repeated rows are linked like copies, and rows that share an id are one
document, with the links of all its texts. Texts are read whole. Extra columns are
ignored; an empty table gives no rows.
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
from tidemart.llm.hashing import mix, shingle_sets, signed, text_blocks, word_hashes
from tidemart.llm.linking import Linker, bitmap, set_node

# A signature counts as frequent from this many documents on, and so many are remembered at most:
# the bound on what is sent to every task (16 bytes each).
FREQUENT = 32
FREQUENT_MAX = 1 << 20
LOSSY_CHUNK = 1 << 20
SEEN = 1 << 18
SUB_GROUPS = 64
SMALL_BAND = 5


def most_different(n: int, partner: int, num: int, den: int) -> int:
    """The most elements in which sets of at most these sizes differ at similarity num / den or more.

    With i common elements and d different ones, den * i >= num * (i + d) and n + partner = 2i + d.
    """
    return (n + partner) * (den - num) // (den + num)


class Signatures:
    """Chooses the signatures of sets."""

    def __init__(self, num: int, den: int, frequent: tuple[np.ndarray, np.ndarray] | None = None):
        self.num, self.den = num, den
        self.keys, self.counts = frequent or (np.zeros(0, np.uint64), np.zeros(0, np.int64))

    def parts(self, band: int) -> int:
        """More parts than the greatest difference in the band; in small bands one per element, as good as."""
        high = (2 << band) - 1
        most = most_different(high, high, self.num, self.den)
        return 1 << 16 if band < SMALL_BAND else most + 1 + max(most // 3, 8)

    def bands(self, n: int) -> list[tuple[int, int]]:
        """The bands in which a set of ``n`` elements signs, each with the most differences there."""
        band = n.bit_length() - 1
        high = (2 << band) - 1
        largest = n * self.den // self.num
        found = [(band, most_different(n, min(high, largest), self.num, self.den))]
        if largest > high:
            found.append((band + 1, most_different(n, largest, self.num, self.den)))
        return found

    def of_parts(self, elements: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray]:
        """The signatures of a set's non-empty parts, and the number of elements in each."""
        parts = self.parts(band)
        part = (mix(elements ^ np.uint64(0xA5A5 + band)) % np.uint64(parts)).astype(np.int64)
        value = mix(elements + np.uint64(band))
        low = np.bincount(part, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), parts)
        high = np.bincount(part, (value >> np.uint64(32)).astype(np.float64), parts)
        count = np.bincount(part, minlength=parts)
        used = np.flatnonzero(count)
        total = low[used].astype(np.uint64) + mix(high[used].astype(np.uint64))
        place = (used + (band << 40)).astype(np.uint64)
        return mix(total ^ mix(place)), count[used]

    def chosen(self, elements: np.ndarray) -> np.ndarray:
        """The signatures to sign with, over all bands of the set."""
        found = []
        for band, most in self.bands(len(elements)):
            keys, count = self.of_parts(elements, band)
            rank = np.minimum(count, 255).astype(np.uint64)
            order = ((np.uint64(255) - rank) << np.uint64(48)) | (keys >> np.uint64(16))
            if len(self.keys):
                at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
                seen = np.where(self.keys[at] == keys, self.counts[at], 0)
                order |= np.ceil(np.log2(seen + 1)).astype(np.uint64) << np.uint64(56)
            if len(keys) > most + 1:
                keys = keys[np.argpartition(order, most)[: most + 1]]
            elif len(keys) < most + 1:
                # Empty parts sign too, last in the order: needed only if a set has too few others.
                empty = np.setdiff1d(np.arange(self.parts(band)), self._used(elements, band))
                empty = empty[: most + 1 - len(keys)]
                keys = np.concatenate([keys, mix(mix((empty + (band << 40)).astype(np.uint64)))])
            found.append(keys)
        return np.concatenate(found) if found else np.zeros(0, np.uint64)

    def _used(self, elements: np.ndarray, band: int) -> np.ndarray:
        return np.unique(mix(elements ^ np.uint64(0xA5A5 + band)) % np.uint64(self.parts(band))).astype(np.int64)


def text_sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for block, data, offsets in text_blocks(batch):
            yield block, shingle_sets(*word_hashes(data, offsets), size)


def batch_of(names: list[str], *columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns), names=names)


class NgramJoin:
    """The join over ``docs`` with columns doc_id and text."""

    def __init__(self, spark: SparkSession, docs: DataFrame, size: int = 5, num: int = 80, den: int = 100):
        self.spark = spark
        self.docs = docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            F.xxhash64(whole_text(F.col("text"))).alias("text_hash"),
            F.col("text").cast("string").alias("text"),
        )
        self.size, self.num, self.den = size, num, den

    def prints(self) -> DataFrame:
        """Per document its set's size and names; and, as rows without them, each task's repeated signatures."""
        size, signatures = self.size, Signatures(self.num, self.den)

        def printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[int] = set()
            pending: list[np.ndarray] = []
            held = 0

            def flush() -> pa.RecordBatch:
                keys, counts = np.unique(np.concatenate(pending), return_counts=True)
                keys, counts = keys[counts > 1], counts[counts > 1]
                none = pa.nulls(len(keys), pa.int64())
                return batch_of(names, none, none, none, none, none, pa.array(signed(keys)), pa.array(counts))

            names = ["doc_id", "text_hash", "n_shingles", "node", "check", "signature", "docs"]
            for block, sets in text_sets(batches, size):
                named = [set_node(s) for s in sets]
                none = pa.nulls(len(sets), pa.int64())
                yield batch_of(
                    names,
                    block.column(0),
                    block.column(1),
                    pa.array([len(s) for s in sets], pa.int64()),
                    *(pa.array([pair[k] for pair in named], pa.int64()) for k in (0, 1)),
                    none,
                    none,
                )
                for elements, (node, _) in zip(sets, named):
                    if len(elements) and node not in seen:
                        seen.add(node)
                        for band, _ in signatures.bands(len(elements)):
                            pending.append(signatures.of_parts(elements, band)[0])
                            held += len(pending[-1])
                if held > LOSSY_CHUNK:
                    yield flush()
                    pending, held = [], 0
                    seen.clear()
            if pending:
                yield flush()

        schema = "doc_id bigint, text_hash bigint, n_shingles bigint, node bigint, check bigint, signature bigint, docs bigint"
        return written(self.spark, self.docs.mapInArrow(printed, schema), "ngram-prints")

    def frequent(self, prints: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """The most frequent signatures and their counts, FREQUENT_MAX at most, sorted by signature."""
        rows = (
            prints.where("signature is not null")
            .groupBy("signature")
            .agg(F.sum("docs").alias("docs"))
            .where(F.col("docs") >= FREQUENT)
            .orderBy(F.desc("docs"), "signature")
            .limit(FREQUENT_MAX)
            .toArrow()
        )
        keys, counts = rows["signature"].to_numpy().view(np.uint64), rows["docs"].to_numpy()
        order = np.argsort(keys)
        return keys[order], counts[order]

    def groups(self, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
        """``(signature, leader, node)``: each node beside the smallest of its signature's (sub-)group."""
        size, num, den = self.size, self.num, self.den
        shared = self.spark.sparkContext.broadcast(frequent)

        def signing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            signatures = Signatures(num, den, shared.value)
            keys_known = shared.value[0]
            # Copies sign once per task, but for those further apart than SEEN different sets.
            seen: set[int] = set()
            for _, sets in text_sets(batches, size):
                nodes, keys = [], []
                for elements in sets:
                    node = set_node(elements)[0] if len(elements) else 0
                    if not len(elements) or node in seen:
                        continue
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(node)
                    keys.append(signatures.chosen(elements))
                    nodes.append(np.full(len(keys[-1]), node, np.int64))
                if not keys:
                    continue
                keys, nodes = np.concatenate(keys), np.concatenate(nodes)
                deal = np.zeros(len(keys), np.int32)
                if len(keys_known):
                    at = np.minimum(np.searchsorted(keys_known, keys), len(keys_known) - 1)
                    deal = np.where(keys_known[at] == keys, 1 + nodes % SUB_GROUPS, 0).astype(np.int32)
                yield batch_of(["signature", "deal", "node"], pa.array(signed(keys)), pa.array(deal), pa.array(nodes))

        signed_rows = self.docs.select("text").mapInArrow(signing, "signature bigint, deal int, node bigint")
        # A running minimum in order of the nodes: the group's first row, without holding the group.
        group = Window.partitionBy("signature", "deal").orderBy("node")
        led = signed_rows.withColumn("leader", F.first("node").over(group))
        first = led.where((F.col("node") != F.col("leader")) | (F.col("deal") > 0)).distinct()
        first = written(self.spark, first, "ngram-groups")
        leaders = first.where("deal > 0").select("signature", F.col("leader").alias("node")).distinct()
        whole = Window.partitionBy("signature").orderBy("node")
        leaders = leaders.withColumn("leader", F.first("node").over(whole))
        both = first.select("signature", "leader", "node").union(leaders.select("signature", "leader", "node"))
        return both.where("node <> leader")

    def sets(self, nodes: DataFrame, reps: DataFrame) -> DataFrame:
        """``(node, rep, elements, bits)`` of the nodes asked for; a Bloom filter keeps other texts from moving."""
        size = self.size
        words = self.spark.sparkContext.broadcast(filter_words(nodes, F.col("node")))

        def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block, sets in text_sets(batches, size):
                named = np.array([set_node(s) for s in sets], np.int64).reshape(-1, 2)
                some = np.flatnonzero(may_hold(words.value, named[:, 0].view(np.uint64)))
                yield batch_of(
                    ["doc_id", "node", "elements", "bits"],
                    block.column(0).take(pa.array(some)),
                    pa.array(named[some, 0]),
                    pa.array([signed(sets[k]) for k in some], pa.list_(pa.int64())),
                    pa.array([bitmap(sets[k]) for k in some], pa.list_(pa.int64())),
                )

        rows = self.docs.mapInArrow(kept, "doc_id bigint, node bigint, elements array<bigint>, bits array<bigint>")
        # One row per set: that of its first document. Rows without an id meet by their sets.
        named = reps.select("rep", "own_id", F.col("node").alias("rep_node"))
        rows = rows.where("size(elements) > 0").join(
            named, (F.col("node") == F.col("rep_node")) & F.col("doc_id").eqNullSafe(F.col("own_id"))
        )
        rows = rows.select("rep", "node", "elements", "bits").dropDuplicates(["rep", "node"])
        return written(self.spark, rows, "ngram-sets")

    def run(self) -> DataFrame:
        """One row per document: doc_id, text_hash, n_shingles and component_id."""
        return settled(self.spark, self._run, "ngram-result")

    def _run(self) -> DataFrame:
        prints = self.prints()
        docs = prints.where("node is not null").select("doc_id", "text_hash", "n_shingles", "node", "check")
        reps = docs.where("n_shingles > 0").groupBy("node", "check", "n_shingles").agg(F.min("doc_id").alias("own_id"))
        # Sets of rows without an id take part under numbers behind all ids. Texts that share an id are one vertex.
        highest = max(docs.agg(F.max("doc_id")).first()[0] or 0, 0)
        reps = reps.withColumn("rep", F.coalesce("own_id", F.monotonically_increasing_id() + (highest + 1)))
        reps = written(self.spark, reps, "ngram-sets-named")

        groups = written(self.spark, self.groups(self.frequent(prints)), "ngram-led")
        nodes = groups.select(F.explode(F.array("leader", "node")).alias("node")).distinct()
        sets = self.sets(nodes, reps)
        labels = Linker(self.spark, self.num, self.den).components(groups, reps.select("node", "rep"), sets)

        final = reps.join(labels, reps["rep"] == labels["node"], "left").select(
            reps["node"], "check", "n_shingles", F.coalesce("component", "rep").alias("component_id")
        )
        final = final.withColumn("component_id", F.when(F.col("component_id") <= highest, F.col("component_id")))
        final = written(self.spark, final, "ngram-components")
        found = docs.where("n_shingles > 0").join(final, ["node", "check", "n_shingles"])
        alone = docs.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
        columns = ["doc_id", "text_hash", "n_shingles", "component_id"]
        return found.select(*columns).union(alone.select(*columns))


def ngram_components(spark: SparkSession, docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    return NgramJoin(spark, docs, size, num, den).run().drop("text_hash")


def keep_one(spark: SparkSession, docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row of each component of ``docs``, with all its columns: that of the smallest doc_id.

    Rows without shingles, and rows without an id that are linked with none that has one, stay, but for
    repeats of the same id and text. Rows that share an id are one document: of several texts under the
    smallest id of a component, that of the smallest hash stays.
    """
    found = NgramJoin(spark, docs, size, num, den).run()
    linked = F.col("component_id").isNotNull() & (F.col("n_shingles") > 0)
    first = found.where(linked & F.col("doc_id").isNotNull()).groupBy("component_id").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("first")
    )
    stay = first.select("first.*").union(found.where(~linked).select("doc_id", "text_hash")).distinct()
    stay = written(spark, stay.select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash")), "ngram-kept")
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"),
        F.col("doc_id").cast("bigint").alias("own_id"),
        F.xxhash64(whole_text(F.col("text"))).alias("own_hash"),
    ).join(stay, F.col("own_id").eqNullSafe(F.col("kept_id")) & (F.col("own_hash") == F.col("kept_hash")), "left_semi")
    same = Window.partitionBy("own_id", "own_hash").orderBy(F.lit(1))
    rows = rows.withColumn("nth", F.row_number().over(same)).where("nth = 1").select("doc")
    return rows.select(*(F.col(f"doc.`{c}`").alias(c) for c in docs.columns))
