"""Hand-made events and topic records for the unit tests."""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.operators.ingest import bronze_projection
from tidemart.schema import (
    EVENT_FIELDS,
    EVENT_SCHEMA,
    FIELD_NAMES,
    OPTIONAL_FIELDS,
    TIME_FIELDS,
    TOPIC_SCHEMA,
)
from tidemart.sources.adapters import CHANNELS, COUNTRIES, DEVICES, STAGE_OF

START = datetime(2025, 1, 1, 10, tzinfo=timezone.utc)


def plain_event() -> dict:
    """A product view in the adapter's vocabulary; ids are named after their field."""
    view = {
        "event_type": STAGE_OF["view"],
        "device_type": DEVICES[0],
        "traffic_source": CHANNELS[0],
        "country_code": COUNTRIES[0],
    }
    for name, dtype in EVENT_FIELDS:
        if name in TIME_FIELDS:
            view[name] = (START + timedelta(seconds=TIME_FIELDS.index(name))).isoformat()
        elif name.endswith("_id") and name not in OPTIONAL_FIELDS:
            view[name] = name.replace("_id", "-a")
        else:
            view.setdefault(name, 1 if isinstance(dtype, T.IntegerType) else None)
    return {name: view[name] for name in FIELD_NAMES}


def instant(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def payload(**changes) -> dict:
    return plain_event() | changes


def event(**changes) -> tuple:
    row = payload(**changes)
    for name in ("event_time", "ingest_time"):
        if isinstance(row[name], str):
            row[name] = datetime.fromisoformat(row[name])
    return tuple(row[name] for name in FIELD_NAMES)


def silver(spark: SparkSession, *rows: tuple) -> DataFrame:
    frame = spark.createDataFrame(list(rows), EVENT_SCHEMA)
    return frame.withColumn("event_date", F.to_date("event_time"))


def topic(spark: SparkSession, *payloads) -> DataFrame:
    """Topic records, one per payload (a dict, or raw text), a second apart."""
    start = datetime(2025, 1, 1, 10, 0, 1, tzinfo=timezone.utc)
    rows = []
    for offset, body in enumerate(payloads):
        text = json.dumps(body) if isinstance(body, dict) else body
        value = None if text is None else bytearray(text, "utf-8")
        stamp = start + timedelta(seconds=offset)
        rows.append((bytearray(b"key"), value, "user_events_v1", 0, offset, stamp))
    return spark.createDataFrame(rows, TOPIC_SCHEMA)


def bronze(spark: SparkSession, *payloads) -> DataFrame:
    return bronze_projection(topic(spark, *payloads))
