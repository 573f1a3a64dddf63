"""Topic records to Bronze, and events to topic records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.schema import FIELD_NAMES


def bronze_projection(records: DataFrame) -> DataFrame:
    """Topic records as Bronze rows: text key and payload, coordinates, topic-time date."""
    return records.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("raw_payload"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
        F.current_timestamp().alias("stream_ingest_time"),
        F.to_date("timestamp").alias("event_date"),
    )


def event_date_fallback() -> Column:
    """The event's own date, or the topic's where the event time is unusable."""
    return F.coalesce(F.to_date("event_time"), F.to_date("kafka_timestamp"))


def topic_encode(events: DataFrame) -> DataFrame:
    """Events as topic records: key is the event id, value is JSON with nulls kept.

    Times keep their microseconds, as UTC with offset.
    """
    options = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"}
    payload = F.to_json(F.struct(*FIELD_NAMES), options)
    return events.select(
        F.col("event_id").cast("binary").alias("key"), payload.cast("binary").alias("value")
    )
