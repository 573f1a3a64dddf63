"""Exact deduplication against a persistent digest index.

The index is a table with one row per distinct text: ``digest`` (SHA-256 of the text after white
space is folded), ``keep_id`` (the id that stays) and ``batch``. It is bucketed and sorted by the
digest, so a batch is shuffled into the index's buckets and met by sort-merge joins, and the index
itself is never shuffled. A batch is added in three steps: one row per digest of the batch (combined
before the shuffle, so a text with any number of copies is one row per task), a sort-merge anti-join
with the index, and an append of the digests that were new.

Running a batch again after a failure is safe: what was already appended is found in the index with
the ids it was appended with, so the decisions are the same.

Cases: a null text is the empty text; empty and blank-only texts are texts like any other (blank-only
ones fold to one blank). Rows that repeat an id and its text all name the same ``keep_id`` and are all
``kept``. A null id loses against any other id; when every copy has a null id, ``keep_id`` is null and
all of them are kept. Other columns pass through; they may have any names but those of the result.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import BLANKS, whole_text, written
from tidemart.session import scratch_dir

INDEX_SCHEMA = "digest binary, keep_id bigint, batch string"


def text_digest(text: Column) -> Column:
    """SHA-256 (32 bytes) of the text with each run of white space as one blank."""
    folded = F.regexp_replace(whole_text(text), BLANKS, " ")
    return F.unhex(F.sha2(folded.cast("binary"), 256))


@dataclass(frozen=True)
class DigestIndex:
    """A digest index: a catalog table over files in ``path``.

    ``buckets`` is fixed when the index is made; choose it so that one bucket of the finished index
    fits a task (32 million digests are about 2 GB).
    """

    spark: SparkSession
    name: str
    path: str
    buckets: int = 64

    @classmethod
    def create(
        cls, spark: SparkSession, path: str | None = None, name: str | None = None, buckets: int = 64
    ) -> DigestIndex:
        """A new, empty index, by default under the shared scratch folder."""
        index = cls(
            spark,
            name or f"digest_index_{uuid.uuid4().hex}",
            path or scratch_dir(spark, "digest-index"),
            buckets,
        )
        index._append(spark.createDataFrame([], INDEX_SCHEMA))
        return index

    @classmethod
    def open(cls, spark: SparkSession, path: str, name: str, buckets: int) -> DigestIndex:
        """An index made by an earlier session, under its files' path."""
        if not spark.catalog.tableExists(name):
            spark.sql(
                f"CREATE TABLE {name} (digest BINARY, keep_id BIGINT, batch STRING) USING parquet"
                f" CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS"
                f" LOCATION '{path}'"
            )
        return cls(spark, name, path, buckets)

    def rows(self) -> DataFrame:
        """The index, bucketed and sorted by digest."""
        return self.spark.table(self.name)

    def _append(self, frame: DataFrame) -> None:
        (
            frame.repartition(self.buckets, "digest")
            .write.format("parquet")
            .mode("append")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .option("path", self.path)
            .saveAsTable(self.name)
        )

    def add(self, batch: DataFrame, batch_name: str = "") -> DataFrame:
        """Add ``(doc_id, text)`` rows; returns doc_id, digest, keep_id, group_size and kept per row.

        ``keep_id`` is the smallest id of the first batch that had the text, ``group_size`` the
        number of rows of this batch with it.
        """
        digests = written(
            self.spark,
            batch.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_digest(F.col("text")).alias("digest")),
            "digests",
        )
        groups = digests.groupBy("digest").agg(
            F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
        )
        fresh = groups.join(self.rows().select("digest").hint("merge"), "digest", "left_anti")
        # Written before it is appended: a table cannot be read and appended to in one job.
        fresh = written(
            self.spark, fresh.select("digest", "keep_id", F.lit(batch_name).alias("batch")), "fresh-digests"
        )
        self._append(fresh)
        settled = written(
            self.spark,
            groups.select("digest", "group_size").join(
                self.rows().select("digest", "keep_id").hint("merge"), "digest"
            ),
            "settled-digests",
        )
        # Both sides are shuffled here, so a text with very many copies is split over tasks.
        return digests.join(settled, "digest").select(
            "doc_id",
            "digest",
            "keep_id",
            "group_size",
            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        )
