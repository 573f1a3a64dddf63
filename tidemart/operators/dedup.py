"""Deduplication on ``event_id``: arbitrary row, latest row, and bounded-state streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def batch_dedup_any(events: DataFrame) -> DataFrame:
    """One arbitrary row per ``event_id``, cut to one per task before the shuffle."""
    any_order = Window.partitionBy("event_id").orderBy(F.lit(1))
    return (
        events.withColumn("copy", F.row_number().over(any_order))
        .filter(F.col("copy") == 1)
        .drop("copy")
    )


def dedup_latest(events: DataFrame) -> DataFrame:
    """The row with the latest ``ingest_time`` per ``event_id``.

    Ties go to the higher topic offset where there is one, then to a hash of the whole row, so a
    rerun picks the same row. Spark turns ``row_number() = 1`` into a group limit that runs
    before the shuffle, so a much-repeated id travels once per task, not once per copy.
    """
    order = [F.col("ingest_time").desc()]
    if "offset" in events.columns:
        order.append(F.col("offset").desc())
    hashed = [name for name in events.columns if name != "stream_ingest_time"]
    order.append(F.xxhash64(*hashed).desc())
    newest_first = Window.partitionBy("event_id").orderBy(*order)
    return (
        events.withColumn("copy", F.row_number().over(newest_first))
        .filter(F.col("copy") == 1)
        .drop("copy")
    )


def event_time_watermark(events: DataFrame, minutes: int) -> DataFrame:
    """Bound a stream's lateness; a static frame passes through unchanged."""
    if not events.isStreaming:
        return events
    return events.withWatermark("event_time", f"{minutes} minutes")


def stream_dedup(events: DataFrame, watermark_minutes: int) -> DataFrame:
    """First row per ``event_id``; on a stream, ids are forgotten once the watermark passes them.

    On a static frame this is the plain batch form. All copies of one id meet in one state partition.
    """
    if not events.isStreaming:
        return batch_dedup_any(events)
    bounded = event_time_watermark(events, watermark_minutes)
    return bounded.dropDuplicatesWithinWatermark(["event_id"])
