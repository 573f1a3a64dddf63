"""Stream sinks for Bronze, Silver and Quarantine, and batch writes of Silver and Gold."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemart.sinks.releases import published


@dataclass(frozen=True)
class LakePaths:
    """Where the layers live. The stream's Silver and the rebuilt Silver are apart: a stream
    sink keeps its own file log, which a batch overwrite of the same folder would contradict."""

    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/user_events"

    @property
    def stream_silver(self) -> str:
        return f"{self.root}/silver/user_events"

    @property
    def rebuilt_silver(self) -> str:
        return f"{self.root}/silver_rebuilt/user_events"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine/user_events"

    @property
    def late(self) -> str:
        return f"{self.root}/late/user_events"

    @property
    def known_ids(self) -> str:
        return f"{self.root}/known_ids/user_events"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"

    def checkpoint(self, layer: str) -> str:
        return f"{self.root}/checkpoints/streaming/{layer}_user_events"


def _append(frame: DataFrame, path: str, checkpoint: str, name: str, trigger: dict) -> StreamingQuery:
    return (
        frame.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("event_date")
        .outputMode("append")
        .queryName(name)
        .trigger(**trigger)
        .start()
    )


# Fixed values below: the names of the stream queries.
def bronze_sink(bronze: DataFrame, paths: LakePaths, trigger: dict) -> StreamingQuery:
    return _append(
        bronze, paths.bronze, paths.checkpoint("bronze"), "write_bronze_user_events", trigger
    )


def silver_sink(silver: DataFrame, paths: LakePaths, trigger: dict) -> StreamingQuery:
    return _append(
        silver, paths.stream_silver, paths.checkpoint("silver"), "write_silver_user_events", trigger
    )


def quarantine_sink(invalid: DataFrame, paths: LakePaths, trigger: dict) -> StreamingQuery:
    return _append(
        invalid,
        paths.quarantine,
        paths.checkpoint("quarantine"),
        "write_quarantine_user_events",
        trigger,
    )


STREAM_BATCH = "stream_batch"


def write_batch(frame: DataFrame, path: str, batch: int) -> None:
    """Write a micro-batch's rows under their dates, in folders of its own.

    The folders carry the batch's number, so a batch that is run again replaces what it wrote before
    and nothing else.
    """
    (
        frame.withColumn(STREAM_BATCH, F.lit(batch).cast("bigint"))
        .hint("rebalance", F.col("event_date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date", STREAM_BATCH)
        .parquet(path)
    )


def overwrite_by_date(frame: DataFrame, path: str, only_dates: bool = False) -> None:
    """Replace a plain date-partitioned folder, or with ``only_dates`` just the dates in the frame.

    For folders that others write to as well, such as Bronze; what the batch jobs own is released in versions
    instead (``published``).
    """
    (
        frame.hint("rebalance", F.col("event_date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if only_dates else "static")
        .partitionBy("event_date")
        .parquet(path)
    )


def gold_write(
    frame: DataFrame,
    gold_root: str,
    name: str,
    only_dates: bool = False,
    start: date | None = None,
    end: date | None = None,
) -> str:
    """Release a mart under ``gold_root`` and return its path: all of it, the dates in the frame, or
    the range from ``start`` to ``end``, in which a day without rows is gone afterwards."""
    path = f"{gold_root}/{name}"
    published(frame, path, only_dates, start, end)
    return path
