"""One query for all layers: kills between steps, ids for good, late rows and counts over restarts."""

from __future__ import annotations

import glob
from datetime import datetime

import pytest

from tests.test_streaming import Delivery, at
from tests.samples import payload
from tidemart.operators.dedup import batch_dedup_any
from tidemart.plans import registry
from tidemart.plans.rebuild import rebuild_silver_changes, rebuild_silver_from_bronze
from tidemart.schema import TOPIC_SCHEMA
from tidemart.sinks.lake import STREAM_BATCH
from tidemart.sinks.releases import dataset
from tidemart.sources.topic import landed_topic_source
from tidemart.streaming.id_index import IdIndex
from tidemart.streaming.lakehouse import AVAILABLE_NOW, await_queries
from tidemart.streaming.one_query import batch_progress, late_rows, start_lakehouse_once, stream_counts

STEPS = ("bronze", "judged", "quarantine", "silver", "late", "ids", "progress")


class Killed(RuntimeError):
    pass


class OneQuery(Delivery):
    def run(self, **options):
        records = landed_topic_source(self.session, self.folder, files_per_trigger=1)
        query = start_lakehouse_once(records, self.paths, AVAILABLE_NOW, minutes=15, buckets=4, **options)
        await_queries([query])

    def layer(self, path):
        return sorted((r.event_id, r.event_time) for r in self.spark.read.parquet(path).collect())

    def late(self):
        return sorted(r.event_id for r in late_rows(self.spark, self.paths).collect())


@pytest.fixture
def delivery(spark, tmp_path):
    found = OneQuery(spark, str(tmp_path))
    yield found
    IdIndex(found.session, found.paths.known_ids, 4).forget()


def deliveries(delivery):
    delivery.send(at("a", "10:00"), at("b", "10:01"), payload(user_id=None), "{broken")
    delivery.send(at("a", "10:00"), at("c", "12:00"), at("c", "12:00"))
    # Behind the watermark: an id that came before, and a new one.
    delivery.send(at("b", "10:01"), at("late", "09:00"), at("d", "12:05"))
    # An id that comes again with a fresh time, long after the watermark has passed it.
    delivery.send(at("a", "13:00"), at("late", "12:30"), at("e", "12:40"))


def check(delivery):
    spark, paths = delivery.spark, delivery.paths
    assert delivery.ids(paths.stream_silver) == ["a", "b", "c", "d", "e"]
    assert delivery.late() == ["late"]
    assert spark.read.parquet(paths.bronze).count() == 13
    assert spark.read.parquet(paths.quarantine).count() == 2
    assert stream_counts(spark, paths) == {"records": 13, "quarantine": 2, "silver": 5, "late": 1, "repeated": 5}
    # The ids of a rebuild from Bronze, each once.
    rebuild_silver_from_bronze(spark, paths.bronze, paths.rebuilt_silver)
    both = delivery.ids(paths.stream_silver) + delivery.late()
    assert sorted(both) == delivery.ids(paths.rebuilt_silver)


def test_ids_are_known_for_good(delivery):
    deliveries(delivery)
    delivery.run()
    check(delivery)
    marks = [batch["watermark"] for batch in batch_progress(delivery.spark, delivery.paths)]
    assert marks == sorted(marks) and len(marks) == 4


@pytest.mark.parametrize("step", STEPS)
def test_a_kill_between_two_steps_gives_no_row_twice(delivery, step):
    """The second batch is cut off behind a step, then the stream starts again from its checkpoint."""
    deliveries(delivery)
    done = []

    def after(name):
        done.append(name)
        if done.count(step) == 3 and name == step:
            raise Killed(step)

    with pytest.raises(Exception, match="Killed|FOREACH"):
        delivery.run(after=after)
    delivery.run()
    check(delivery)


def test_restarts_between_deliveries(delivery):
    delivery.send(at("a", "10:00"), at("b", "12:00"))
    delivery.run()
    before = stream_counts(delivery.spark, delivery.paths)
    delivery.send(at("late", "10:05"), at("b", "15:00"))
    delivery.run()
    assert delivery.late() == ["late"] and delivery.ids(delivery.paths.stream_silver) == ["a", "b"]
    after = stream_counts(delivery.spark, delivery.paths)
    assert before["late"] == 0 and after == {"records": 4, "quarantine": 0, "silver": 2, "late": 1, "repeated": 1}


def test_bronze_is_ready_for_incremental_rebuilds(delivery):
    delivery.send(at("a", "10:00"))
    delivery.run()
    rebuild_silver_changes(delivery.spark, delivery.paths.bronze, delivery.paths.rebuilt_silver)
    delivery.send(at("b", "10:01"), at("a", "10:02"))
    delivery.run()
    rebuild_silver_changes(delivery.spark, delivery.paths.bronze, delivery.paths.rebuilt_silver)
    assert delivery.ids(delivery.paths.rebuilt_silver) == ["a", "b"]
    assert "stream_batch" not in dataset(delivery.spark, delivery.paths.rebuilt_silver).columns


def test_only_invalid_rows_keep_their_payload_in_the_work_table(delivery):
    deliveries(delivery)
    found = {}

    def after(step):
        if step == "judged":
            for folder in glob.glob(f"{delivery.paths.root}/work/*/judged"):
                rows = delivery.spark.read.parquet(folder).collect()
                found[folder] = [(bool(r.validation_errors), r.raw_payload is not None) for r in rows]

    delivery.run(after=after)
    rows = [row for folder in found.values() for row in folder]
    assert len(rows) == 13 and all(invalid == kept for invalid, kept in rows)
    shown = delivery.spark.read.parquet(delivery.paths.quarantine).collect()
    assert len(shown) == 2 and all(r.raw_payload for r in shown) and "{broken" in [r.raw_payload for r in shown]


def test_the_one_query_takes_the_configured_partitions(spark, monkeypatch):
    """A fixed number would give each task a share that grows with the input."""
    started = []

    def start(records, paths, trigger, buckets):
        started.append((records.sparkSession.conf.get("spark.sql.shuffle.partitions"), buckets))
        return start_lakehouse_once(records, paths, trigger, buckets=buckets)

    monkeypatch.setattr(registry, "start_lakehouse_once", start)
    feed = spark.createDataFrame([(b"a", b"{", "t", 0, 0, datetime(2024, 1, 1))], TOPIC_SCHEMA)
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    try:
        paths, _ = registry._one_query(spark, feed)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert started == [("11", 11)]
    assert spark.read.parquet(paths.quarantine).count() == 1


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "event_id string")


def test_the_index_survives_and_folds(spark, tmp_path):
    index = IdIndex(spark, f"{tmp_path}/ids", 4)
    try:
        index.add(ids(spark, "a", "a", None), 0)
        index.add(ids(spark, "b"), 1)
        index.add(ids(spark, "c", "d"), 2)
        index.add(ids(spark, "c"), 2)

        def known(batch):
            rows = index.split(ids(spark, "a", "b", "c", "d", "e", None), batch).collect()
            assert len(rows) == 6
            return sorted(r.event_id for r in rows if r.known)

        assert [known(b) for b in range(4)] == [[], ["a"], ["a", "b"], ["a", "b", "c"]]
        index.fold(2)
        assert index.partitions() == [-2, 2] and known(2) == ["a", "b"] and known(3) == ["a", "b", "c"]
        index.forget()
        # A session that has never seen the table finds what is in its folder.
        index = IdIndex(spark, f"{tmp_path}/ids", 4)
        assert index.partitions() == [-2, 2] and known(3) == ["a", "b", "c"]
        index.fold(3)
        assert index.partitions() == [-3] and known(3) == ["a", "b", "c"]
    finally:
        index.forget()


def test_a_look_up_does_not_work_out_its_rows_twice(spark, tmp_path):
    index = IdIndex(spark, f"{tmp_path}/ids", 4)
    try:
        index.add(ids(spark, "a"), 0)
        arrived = ids(spark, "a", "b", "b", None)
        first = batch_dedup_any(arrived)
        split = index.split(first, 1, asked=arrived)
        assert sorted((r.event_id or "", r.known) for r in split.collect()) == [("", False), ("a", True), ("b", False)]
        plan = index.split(first, 1, asked=arrived)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Window [") == 1
    finally:
        index.forget()


def test_a_large_batch_leaves_the_index_where_it_lies(spark, tmp_path):
    index = IdIndex(spark, f"{tmp_path}/ids", 8)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        index.add(ids(spark, *(f"e{k}" for k in range(100))), 0)
        asked = ids(spark, *(f"e{k}" for k in range(90, 110))).distinct()
        known = index.before(1).join(asked, "event_id", "left_semi")
        plan = known._jdf.queryExecution().executedPlan().toString()
        # One exchange, that of the batch's ids.
        assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1
        assert known.count() == 10 and STREAM_BATCH not in known.columns
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        index.forget()
