"""Real streams over landed topic files, drained with ``availableNow``."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F

from tests.samples import payload, topic
from tidemart.operators.dedup import event_time_watermark, stream_dedup
from tidemart.plans.rebuild import rebuild_silver_from_bronze
from tidemart.session import stream_session
from tidemart.sinks.lake import LakePaths
from tidemart.sinks.releases import dataset
from tidemart.sources.topic import landed_topic_source, topic_options, topic_source
from tidemart.streaming.lakehouse import (
    AVAILABLE_NOW,
    LateRows,
    await_queries,
    late_rows_dropped,
    start_from_bronze,
    start_lakehouse,
    watermark_minutes,
)


def at(event_id: str, clock: str, **changes) -> dict:
    return payload(event_id=event_id, event_time=f"2025-01-01T{clock}:00+00:00", **changes)


class Delivery:
    """A topic folder that gets one file per delivery, oldest first."""

    def __init__(self, spark, root):
        self.spark, self.folder, self.stamp = spark, f"{root}/topic", 1_700_000_000
        self.session = stream_session(spark)
        self.paths = LakePaths(f"{root}/lake")

    def send(self, *payloads):
        before = set(self._files())
        topic(self.spark, *payloads).coalesce(1).write.mode("append").parquet(self.folder)
        for name in set(self._files()) - before:
            self.stamp += 60
            os.utime(f"{self.folder}/{name}", (self.stamp, self.stamp))

    def _files(self):
        if not os.path.isdir(self.folder):
            return []
        return [name for name in os.listdir(self.folder) if name.endswith(".parquet")]

    def run(self, **options):
        records = landed_topic_source(self.session, self.folder, files_per_trigger=1)
        queries = start_lakehouse(records, self.paths, AVAILABLE_NOW, **options)
        await_queries(queries)
        return queries

    def ids(self, path):
        return sorted(row.event_id for row in dataset(self.spark, path).collect())


@pytest.fixture
def delivery(spark, tmp_path):
    return Delivery(spark, str(tmp_path))


def test_three_tables_and_restart(delivery):
    delivery.send(at("a", "10:00"), at("b", "10:01"), payload(user_id=None))
    delivery.run()
    delivery.send(at("b", "10:01"), at("c", "10:02"), "{broken")
    delivery.run()
    spark, paths = delivery.spark, delivery.paths
    assert delivery.ids(paths.stream_silver) == ["a", "b", "c"]
    assert spark.read.parquet(paths.bronze).count() == 6
    bad = spark.read.parquet(paths.quarantine)
    assert sorted(row.validation_errors[0] for row in bad.collect()) == [
        "malformed_json",
        "user_id is required",
    ]
    assert "raw_payload" in bad.columns
    silver = spark.read.parquet(paths.stream_silver)
    assert "raw_payload" not in silver.columns and "stream_ingest_time" in silver.columns


def test_stream_rules_stay_selectable(delivery):
    delivery.send(at("a", "10:00", device_type="  "))
    delivery.run(rules="stream")
    assert delivery.ids(delivery.paths.stream_silver) == ["a"]


def test_silver_and_quarantine_from_bronze(delivery):
    delivery.send(at("a", "10:00"), at("a", "10:00"), "{broken")
    delivery.run(layers=("bronze",))
    await_queries(start_from_bronze(delivery.session, delivery.paths, AVAILABLE_NOW))
    assert delivery.ids(delivery.paths.stream_silver) == ["a"]
    assert delivery.spark.read.parquet(delivery.paths.quarantine).count() == 1


def test_late_row_is_dropped_counted_and_rebuilt(delivery):
    delivery.send(at("a", "10:00"))
    delivery.send(at("b", "12:00"))
    delivery.send(at("c", "12:01"))
    delivery.send(at("late", "10:05"), at("d", "12:02"))
    delivery.send(at("e", "16:06"))
    queries = delivery.run(layers=("bronze", "silver"), minutes=15)
    paths = delivery.paths
    assert delivery.ids(paths.stream_silver) == ["a", "b", "c", "d", "e"]
    assert late_rows_dropped(queries[1]) == 1
    rebuild_silver_from_bronze(delivery.spark, paths.bronze, paths.rebuilt_silver)
    assert delivery.ids(paths.rebuilt_silver) == ["a", "b", "c", "d", "e", "late"]


def test_state_is_released_behind_the_watermark(delivery):
    for hour in range(10, 15):
        delivery.send(at(f"id-{hour}", f"{hour}:00"))
    (query,) = delivery.run(layers=("silver",), minutes=15)
    rows_held = query.lastProgress["stateOperators"][0]["numRowsTotal"]
    assert rows_held <= 1


def test_a_failing_query_stops_the_others(delivery):
    delivery.send(at("a", "10:00"))
    records = landed_topic_source(delivery.session, delivery.folder)
    broken = records.select(F.raise_error(F.lit("boom")).alias("event_date"))
    bad = (
        broken.withColumn("x", F.lit(1))
        .writeStream.format("noop")
        .option("checkpointLocation", f"{delivery.paths.root}/bad")
        .start()
    )
    steady = (
        records.writeStream.format("noop")
        .option("checkpointLocation", f"{delivery.paths.root}/steady")
        .start()
    )
    with pytest.raises(Exception, match="boom"):
        await_queries([steady, bad])
    assert not steady.isActive and not bad.isActive


def test_partial_rebuild_replaces_only_its_dates(delivery):
    first, second = at("a", "10:00"), payload(event_id="b", event_time="2025-01-02T10:00:00Z")
    delivery.send(first, second)
    delivery.run(layers=("bronze",))
    spark, paths = delivery.spark, delivery.paths
    rebuild_silver_from_bronze(spark, paths.bronze, paths.rebuilt_silver)
    delivery.send(at("c", "23:59"))
    delivery.run(layers=("bronze",))
    day = spark.sql("SELECT DATE'2025-01-02'").first()[0]
    rebuild_silver_from_bronze(spark, paths.bronze, paths.rebuilt_silver, day, day)
    assert delivery.ids(paths.rebuilt_silver) == ["a", "b"]
    rebuild_silver_from_bronze(spark, paths.bronze, paths.rebuilt_silver)
    assert delivery.ids(paths.rebuilt_silver) == ["a", "b", "c"]


def test_static_frames_pass_through(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 1)], "event_id string, x int")
    assert event_time_watermark(frame, 15) is frame
    assert stream_dedup(frame, 15).count() == 1


def test_watermark_minutes_from_environment(monkeypatch):
    assert watermark_minutes() == 15
    monkeypatch.setenv("TIDEMART_WATERMARK_MINUTES", "40")
    assert watermark_minutes() == 40


def test_topic_options(spark):
    options = topic_options("broker:9092", "user_events_v1", max_offsets_per_trigger=1000)
    assert options == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "user_events_v1",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "1000",
    }
    # No connector package here: Spark must say so, not something else.
    with pytest.raises(Exception, match="(?i)kafka"):
        topic_source(spark, options)


def failing(delivery, name, after=0):
    """A memory-less stream that raises once it has seen ``after`` batches."""

    def write(batch, number):
        if number >= after:
            raise ValueError(f"{name} broke")

    records = landed_topic_source(delivery.session, delivery.folder, files_per_trigger=1)
    return records.writeStream.foreachBatch(write).trigger(availableNow=True).start()


@pytest.mark.parametrize("after", [0, 2])
def test_a_failure_is_always_raised(delivery, after):
    for k in range(4):
        delivery.send(at(f"e{k}", "10:00"))
    records = landed_topic_source(delivery.session, delivery.folder, files_per_trigger=1)
    good = start_lakehouse(records, delivery.paths, AVAILABLE_NOW, layers=("bronze", "quarantine"))
    bad = failing(delivery, "third", after)
    if not after:
        with pytest.raises(Exception):
            bad.awaitTermination()
    with pytest.raises(Exception, match="third broke"):
        await_queries([*good, bad])
    assert not any(query.isActive for query in good)


def test_no_lateness_is_no_lateness(delivery):
    delivery.send(at("a", "10:00"))
    queries = delivery.run(minutes=0, layers=("silver",))
    assert queries[0].lastProgress["eventTime"]["watermark"].startswith("2025-01-01T10:00:00")


def test_late_rows_are_counted_over_all_batches(delivery):
    counter = LateRows()
    delivery.spark.streams.addListener(counter)
    delivery.session.streams.addListener(counter)
    delivery.session.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        delivery.send(at("a", "10:00"))
        delivery.send(at("b", "12:00"))
        delivery.send(at("late", "09:00"))
        for k in range(5):
            delivery.send(at(f"c{k}", "12:00"))
        query = delivery.run(layers=("silver",))[0]
        for _ in range(50):
            if counter.dropped.get(str(query.id)):
                break
            time.sleep(0.2)
        assert counter.dropped[str(query.id)] == 1 and late_rows_dropped(query) == 0
    finally:
        delivery.session.streams.removeListener(counter)
        delivery.spark.streams.removeListener(counter)
        delivery.session.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def test_state_partitions_are_the_callers_choice(spark):
    assert stream_session(spark, 5).conf.get("spark.sql.shuffle.partitions") == "5"
    assert stream_session(spark).conf.get("spark.sql.shuffle.partitions") == "8"
