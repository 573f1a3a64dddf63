"""One topic stream into three tables, with bounded deduplication and late-row reporting."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemart.operators.dedup import stream_dedup
from tidemart.operators.ingest import bronze_projection
from tidemart.operators.validate import RULE_SETS, route_quarantine, route_valid
from tidemart.schema import BRONZE_SCHEMA
from tidemart.sinks.lake import LakePaths, bronze_sink, quarantine_sink, silver_sink

DEFAULT_WATERMARK_MINUTES = 15
LAYERS = ("bronze", "silver", "quarantine")
AVAILABLE_NOW = {"availableNow": True}


def watermark_minutes() -> int:
    """Allowed lateness: 15 minutes unless ``TIDEMART_WATERMARK_MINUTES`` says otherwise."""
    return int(os.environ.get("TIDEMART_WATERMARK_MINUTES", DEFAULT_WATERMARK_MINUTES))


def silver_stream(bronze: DataFrame, minutes: int, rules: str = "contract") -> DataFrame:
    """Valid rows, first one per id."""
    return stream_dedup(route_valid(RULE_SETS[rules](bronze)), minutes)


def quarantine_stream(bronze: DataFrame, rules: str = "contract") -> DataFrame:
    return route_quarantine(RULE_SETS[rules](bronze))


def start_lakehouse(
    records: DataFrame,
    paths: LakePaths,
    trigger: dict,
    rules: str = "contract",
    minutes: int | None = None,
    layers: tuple[str, ...] = LAYERS,
) -> list[StreamingQuery]:
    """Start the layers' queries on one topic stream; each reads the topic by itself."""
    bronze = bronze_projection(records)
    queries = []
    if "bronze" in layers:
        queries.append(bronze_sink(bronze, paths, trigger))
    if "silver" in layers:
        silver = silver_stream(bronze, watermark_minutes() if minutes is None else minutes, rules)
        queries.append(silver_sink(silver, paths, trigger))
    if "quarantine" in layers:
        queries.append(quarantine_sink(quarantine_stream(bronze, rules), paths, trigger))
    return queries


def start_from_bronze(
    spark: SparkSession,
    paths: LakePaths,
    trigger: dict,
    rules: str = "contract",
    minutes: int | None = None,
    files_per_trigger: int | None = None,
) -> list[StreamingQuery]:
    """Silver and Quarantine as streams over the Bronze table, so the topic is read once.

    The form to prefer: run ``start_lakehouse`` with ``layers=("bronze",)`` beside it.
    ``files_per_trigger`` bounds a batch, and drops nothing.
    """
    reader = spark.readStream.schema(BRONZE_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    bronze = reader.parquet(paths.bronze)
    lateness = watermark_minutes() if minutes is None else minutes
    return [
        silver_sink(silver_stream(bronze, lateness, rules), paths, trigger),
        quarantine_sink(quarantine_stream(bronze, rules), paths, trigger),
    ]


def await_queries(queries: list[StreamingQuery]) -> None:
    """Wait until all have ended; when one fails, stop the others and raise its error.

    A query that had failed before, or fails between two looks, raises too.
    """
    try:
        while all(query.exception() is None for query in queries):
            running = [query for query in queries if query.isActive]
            if not running:
                break
            running[0].awaitTermination(1)
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
    for query in queries:
        if query.exception() is not None:
            raise query.exception()


def late_rows_dropped(query: StreamingQuery) -> int:
    """Rows behind the watermark that the query's recent batches dropped.

    Spark keeps the latest ``spark.sql.streaming.numRecentProgressUpdates`` batches; ``LateRows`` counts
    over a stream's whole run.
    """
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )


class LateRows(StreamingQueryListener):
    """Adds up the rows that each query dropped behind the watermark, over all its batches.

    Register it with ``spark.streams.addListener`` before the queries start. Spark reports batches a
    moment after they end.
    """

    def __init__(self):
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        late = sum(operator.numRowsDroppedByWatermark for operator in event.progress.stateOperators)
        query = str(event.progress.id)
        self.dropped[query] = self.dropped.get(query, 0) + late

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
