"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents are put in a shuffled order that a seed fixes and seen as one stream of words,
cut into blocks of equal length. A schedule of slots is laid over the sources: slot i stands at the
fractional part of (i + 1) times the golden ratio, and the cumulative weights say whose slot that is, so
every stretch of the mix has the sources in about their shares. The k-th slot of a source takes block
k, starting over after its last one. A source gets as many slots as its target needs, and the last one
is cut to the word; what the points leave open at the end (a few slots per source) is appended.

Nothing here is ordered in one task: positions are running sums within hash buckets plus the buckets'
own sums, slot ranks are counted within chunks of slots plus the chunks' own counts. Only one row per
source and one per source and bucket (or chunk) go through wider windows.

Targets: sources in code-point order, nulls last, have the weights in turn, again and again. They share
``share`` times all words; a source's target stops at ``most`` times its words, and the excess goes to
the others by weight until none is above.

Cases: a null text has no words; documents and sources without words take part with nothing taken. A
null source is a source of its own. Rows that repeat are separate rows of the stream. An empty table
gives no rows. Other columns may have any names.
"""

from __future__ import annotations

from decimal import Decimal, getcontext

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.llm.common import WORD, written, whole_text

WEIGHTS = (3, 1, 2)
BLOCK_WORDS = 256
BUCKET_DOCS = 4096
CHUNK_SLOTS = 1 << 16

getcontext().prec = 60
GOLDEN = (Decimal(5).sqrt() - 1) / 2
LOW_STEP = float(GOLDEN)
HIGH_STEP = float(GOLDEN * (1 << 20) % 1)


def word_count(text: Column) -> Column:
    return F.regexp_count(whole_text(text), F.lit(WORD)).cast("bigint")


def golden_point(number: Column) -> Column:
    """The fractional part of (number + 1) * golden ratio, kept precise for large numbers."""
    n = number + F.lit(1)
    turns = F.expr("1048576")
    high, low = F.floor(n / turns), F.pmod(n, turns)
    return F.pmod(high * F.lit(HIGH_STEP) + low * F.lit(LOW_STEP), F.lit(1.0))


def source_targets(
    sizes: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS
) -> DataFrame:
    """Adds source_no, weight and target to one row per source (source, source_size).

    In order of the weight at which a source reaches its limit, the limited ones come first: with
    those before it set to their limits, a source is limited if its part of the rest is above its own.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    listed = F.array(*(F.lit(w) for w in weights))
    rows = sizes.withColumn("source_no", F.row_number().over(by_name) - 1)
    rows = rows.withColumn("weight", F.get(listed, F.pmod("source_no", F.lit(len(weights)))).cast("double"))
    rows = rows.withColumn("limit", F.col("source_size") * F.lit(float(most)))
    rows = rows.withColumn("reached", F.col("limit") / F.col("weight"))
    before = Window.orderBy("reached", "source_no").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    rows = rows.withColumn("spent", F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
    rows = rows.withColumn("past", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    rows = rows.withColumn("words", F.sum("source_size").over(everything) * F.lit(float(share)))
    rows = rows.withColumn("level", (F.col("words") - F.col("spent")) / (F.sum("weight").over(everything) - F.col("past")))
    rows = rows.withColumn("open_level", F.min(F.when(F.col("level") <= F.col("reached"), F.struct("reached", "source_no", "level"))).over(everything))
    limited = F.col("open_level").isNull() | (F.struct("reached", "source_no") < F.struct("open_level.reached", "open_level.source_no"))
    target = F.when(limited, F.col("limit")).otherwise(F.col("open_level.level") * F.col("weight"))
    return rows.withColumn("target", target).select("source", "source_no", "source_size", "weight", "target")


class Mix:
    """The mix of ``docs`` (doc_id, text, source)."""

    def __init__(
        self,
        spark: SparkSession,
        docs: DataFrame,
        share: float = 1.5,
        most: float = 2.0,
        weights: tuple[int, ...] = WEIGHTS,
        block_words: int = BLOCK_WORDS,
        seed: int = 0,
    ):
        self.spark, self.docs, self.block, self.seed = spark, docs, block_words, seed
        doc_id = F.col("doc_id").cast("bigint")
        text_hash = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
        self.described = docs.select(
            doc_id.alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            F.xxhash64(F.lit(seed), doc_id, text_hash).alias("place"),
            F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"),
        )
        # The counted words are written once; the texts stay where they are.
        light = docs.select(
            doc_id.alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            F.xxhash64(F.lit(seed), doc_id, text_hash).alias("place"),
            word_count(F.col("text")).alias("size"),
        )
        self.light = written(spark, light, "mix-sizes")
        stats = self.light.groupBy("source").agg(
            F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs")
        )
        stats = written(spark, stats, "mix-sources")
        targets = source_targets(stats.select("source", "source_size"), share, most, weights)
        self.sources = written(spark, self._needs(targets), "mix-targets")
        total = stats.agg(F.sum("docs")).first()[0] or 0
        self.buckets = max(1, -(-total // BUCKET_DOCS))
        sums = self._bucketed(self.light).groupBy("source_no", "bucket").agg(F.sum("size").alias("words"))
        before = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        self.offsets = written(
            spark,
            sums.select("source_no", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("bucket_start")),
            "mix-buckets",
        )

    def _needs(self, targets: DataFrame) -> DataFrame:
        """With the blocks and slots of each source and its stretch of all slots."""
        block = F.lit(self.block)
        rows = targets.withColumn("take", F.round("target").cast("bigint"))
        rows = rows.withColumn("blocks", F.ceil(F.col("source_size") / block))
        rows = rows.withColumn("rounds", F.when(F.col("source_size") > 0, F.expr("take div source_size")).otherwise(F.lit(0)))
        rest = F.col("take") - F.col("rounds") * F.col("source_size")
        rows = rows.withColumn("slots", F.col("rounds") * F.col("blocks") + F.ceil(rest / block))
        upto = Window.orderBy("source_no")
        return rows.withColumn("last_slot", F.sum("slots").over(upto)).withColumn(
            "first_slot", F.col("last_slot") - F.col("slots")
        )

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        named = self.sources.select(F.col("source").alias("named"), "source_no", "source_size", "target")
        bucket = F.shiftright(F.shiftrightunsigned("place", 33) * F.lit(self.buckets), 31)
        return rows.join(named, F.col("source").eqNullSafe(F.col("named"))).withColumn("bucket", bucket)

    def positions(self, rows: DataFrame) -> DataFrame:
        """With ``start``, the words before the row in its source's stream."""
        order = Window.partitionBy("source_no", "bucket").orderBy("place", "doc_id").rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        summed = self._bucketed(rows).withColumn("upto", F.sum("size").over(order))
        return summed.join(self.offsets, ["source_no", "bucket"]).withColumn(
            "start", F.col("bucket_start") + F.col("upto") - F.col("size")
        )

    def schedule(self) -> DataFrame:
        """``(slot, source_no, round, block, take)``: the block that each slot of the mix takes."""
        total = self.sources.agg(F.max("last_slot"), F.count(F.lit(1))).first()
        slots, sources = total[0] or 0, total[1]
        # Which stretch a point falls in: an equi-join on cells of the line, a few per source.
        cell = max(1, slots // (8 * max(1, sources)))
        stretches = self.sources.where("slots > 0").withColumn(
            "cell", F.explode(F.sequence(F.expr(f"first_slot div {cell}"), F.expr(f"(last_slot - 1) div {cell}")))
        )
        points = self.spark.range(slots).select(
            F.col("id").alias("slot"),
            F.least(F.floor(golden_point(F.col("id")) * F.lit(float(slots))), F.lit(max(0, slots - 1))).alias("point"),
        )
        points = points.withColumn("cell", F.expr(f"point div {cell}"))
        met = points.join(stretches.select("cell", "source_no", "first_slot", "last_slot"), "cell")
        met = met.where("first_slot <= point AND point < last_slot").select(
            "slot", "source_no", F.expr(f"slot div {CHUNK_SLOTS}").alias("chunk")
        )
        met = written(self.spark, met, "mix-slots")
        counts = met.groupBy("source_no", "chunk").agg(F.count(F.lit(1)).alias("slots"))
        before = Window.partitionBy("source_no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
        counts = written(self.spark, counts.withColumn("base", F.coalesce(F.sum("slots").over(before), F.lit(0))), "mix-chunks")
        within = Window.partitionBy("source_no", "chunk").orderBy("slot")
        ranked = met.withColumn("nth", F.row_number().over(within) - 1).join(
            counts.select("source_no", "chunk", "base"), ["source_no", "chunk"]
        ).select("slot", "source_no", (F.col("base") + F.col("nth")).alias("rank"))
        got = counts.groupBy("source_no").agg(F.sum("slots").alias("got"))
        short = self.sources.join(got, "source_no", "left").withColumn("got", F.coalesce("got", F.lit(0)))
        short = short.where("got < slots").select(
            F.lit(slots).cast("bigint").alias("slot"), "source_no", F.explode(F.expr("sequence(got, slots - 1)")).alias("rank")
        )
        ranked = ranked.union(short).join(
            self.sources.select("source_no", "slots", "blocks", "source_size", F.col("take").alias("wanted")), "source_no"
        ).where("rank < slots")
        ranked = ranked.withColumn("round", F.expr("rank div blocks")).withColumn("block", F.expr("rank % blocks"))
        left = F.col("wanted") - F.col("round") * F.col("source_size") - F.col("block") * F.lit(self.block)
        length = F.least(F.lit(self.block), F.col("source_size") - F.col("block") * F.lit(self.block))
        return ranked.select("slot", "source_no", "round", "block", F.least(length, left).alias("take"))

    def taken(self) -> DataFrame:
        """``(slot, source_no, start, round, words)``: the words that a slot takes of a document.

        A document is named by its source and where it starts in the stream. Within a round, its
        words are taken from its front.
        """
        end = F.col("start") + F.col("size")
        block = self.block
        pieces = self.positions(self.light).where("size > 0").select(
            "source_no", "start", end.alias("end"),
            F.explode(F.sequence(F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}"))).alias("block"),
        )
        front = F.col("block") * F.lit(block)
        met = pieces.join(self.schedule(), ["source_no", "block"])
        words = F.least("end", front + F.col("take")) - F.greatest("start", front)
        return met.withColumn("words", words).where("words > 0").select("slot", "source_no", "start", "round", "words")

    def counts(self) -> DataFrame:
        """Per document: doc_id, size, source_size, target and the words taken."""
        sums = self.taken().groupBy("source_no", "start").agg(F.sum("words").alias("taken"))
        sums = written(self.spark, sums, "mix-taken")
        rows = self.positions(self.light).select("doc_id", "source", "size", "source_size", "target", "source_no", "start")
        # Documents without words share their start with the next one.
        met = rows.where("size > 0").join(sums, ["source_no", "start"], "left")
        columns = ["doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")]
        none = rows.where("size = 0").withColumn("taken", F.lit(0))
        return met.select(*columns).union(none.select(*columns))

    def documents(self) -> DataFrame:
        """The mixed documents: the rows of ``docs``, one for each round that takes words of them.

        A document cut by the end of its source's share has its first words, joined by single blanks.
        """
        parts = self.taken().groupBy("source_no", "start", "round").agg(F.sum("words").alias("words"))
        parts = written(self.spark, parts, "mix-parts")
        rows = self.positions(self.described.withColumn("size", word_count(F.col("doc.text")))).where("size > 0")
        rows = rows.select("source_no", "start", "size", "doc").join(parts, ["source_no", "start"])
        cut = F.array_join(F.slice(F.regexp_extract_all("doc.text", F.lit(WORD), F.lit(0)), 1, F.col("words").cast("int")), " ")
        text = F.when(F.col("words") == F.col("size"), F.col("doc.text")).otherwise(cut)
        columns = [F.col(f"doc.`{c}`").alias(c) for c in self.docs.columns if c not in ("text", "n_chars")]
        mixed = rows.withColumn("new_text", text).select(
            *columns, F.col("new_text").alias("text"), F.length("new_text").cast("bigint").alias("n_chars")
        )
        return mixed.select(*self.docs.columns)
