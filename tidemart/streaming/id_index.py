"""The ids that a stream has taken in, kept for good: a table bucketed and sorted by id, one partition per micro-batch.

A watermark lets a stream forget ids; this table does not. A batch's ids are met with it by a join that leaves the
table where it lies: Spark broadcasts the batch's ids when they are measured to be small, and joins bucket with
bucket otherwise. Each look-up reads the id column once, so batches should not be small against the table; choose the
trigger accordingly. ``fold`` keeps the number of files down.

A batch's partition is overwritten when the batch runs again, and look-ups see earlier batches only, so
a batch that was cut off half-way decides the same the second time.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.session import scratch_dir
from tidemart.sinks.files import Files
from tidemart.sinks.lake import STREAM_BATCH


class IdIndex:
    """The ids under ``path``, in ``buckets`` buckets; the number stays what it is at the first start.

    Take no fewer buckets than the session has shuffle partitions: Spark shuffles a table with fewer again.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.table = "known_ids_" + re.sub(r"\W", "_", path)[-60:].lower() + f"_{abs(hash_text(path)):x}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (event_id STRING, {STREAM_BATCH} BIGINT) USING parquet"
            f" PARTITIONED BY ({STREAM_BATCH}) CLUSTERED BY (event_id) SORTED BY (event_id) INTO {buckets} BUCKETS"
            f" LOCATION '{path}'"
        )
        self.files = Files(spark, path)
        # The catalog may not know what earlier applications wrote.
        if self.files.exists(path):
            spark.sql(f"ALTER TABLE {self.table} RECOVER PARTITIONS")

    def before(self, batch: int) -> DataFrame:
        """``(event_id)`` of all earlier batches; an id may come more than once."""
        # Folded partitions have the number of their last batch, less one and negated.
        last = F.when(F.col(STREAM_BATCH) < 0, -F.col(STREAM_BATCH) - 1).otherwise(F.col(STREAM_BATCH))
        return self.spark.table(self.table).where(last < batch).select("event_id")

    def split(self, rows: DataFrame, batch: int, asked: DataFrame | None = None) -> DataFrame:
        """``rows`` with a column ``known``: whether their id came in an earlier batch. A null id is never known.

        The ids are read once more for the look-up: from ``asked``, where a frame that has all of them (and maybe
        more) is cheaper to read than ``rows``.
        """
        asked = (rows if asked is None else asked).select("event_id").distinct()
        known = self.before(batch).join(asked, "event_id", "left_semi").distinct().withColumn("known", F.lit(True))
        return rows.join(known, "event_id", "left").withColumn("known", F.coalesce("known", F.lit(False)))

    def add(self, ids: DataFrame, batch: int) -> None:
        """Take in a batch's ids, in place of what the same batch wrote before."""
        self._write(ids.where("event_id is not null"), batch)

    def _write(self, ids: DataFrame, partition: int) -> None:
        rows = ids.select("event_id").distinct().repartition(self.buckets, "event_id").sortWithinPartitions("event_id")
        view = f"{self.table}_new"
        rows.createOrReplaceTempView(view)
        try:
            # Run in the frame's own session, which is the one that knows the view.
            ids.sparkSession.sql(
                f"INSERT OVERWRITE TABLE {self.table} PARTITION ({STREAM_BATCH} = {partition}) SELECT event_id FROM {view}"
            )
        finally:
            ids.sparkSession.catalog.dropTempView(view)

    def partitions(self) -> list[int]:
        rows = self.spark.sql(f"SHOW PARTITIONS {self.table}").collect()
        return sorted(int(row.partition.removeprefix(f"{STREAM_BATCH}=")) for row in rows)

    def fold(self, before: int) -> None:
        """Write the partitions of all batches before this one as a single partition.

        The new one is complete before the old ones go. If the run ends between, ids are in both, which
        changes no look-up. Not for a batch that may still run again.
        """
        old = [part for part in self.partitions() if (part if part >= 0 else -part - 1) < before]
        if len(old) > 1:
            work = scratch_dir(self.spark, "known-ids")
            self.before(before).write.parquet(work)
            self._write(self.spark.read.parquet(work), -before)
            for part in old:
                if part != -before:
                    self.spark.sql(f"ALTER TABLE {self.table} DROP PARTITION ({STREAM_BATCH} = {part})")
                    self.files.delete(f"{self.path}/{STREAM_BATCH}={part}")
            self.files.delete(work)

    def forget(self) -> None:
        """Take the table out of the catalog; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def hash_text(text: str) -> int:
    """A number that is the same in every process."""
    found = 0
    for byte in text.encode():
        found = (found * 131 + byte) % (1 << 61)
    return found
