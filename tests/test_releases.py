"""Datasets that change in one step, with a failure between any two steps of a write."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.samples import event, silver
from tests.test_tables import daily_inputs, two_days
from tidemart.plans import daily
from tidemart.plans.daily import daily_run
from tidemart.plans.rebuild import changed_bronze, rebuild_silver_changes, rebuild_silver_from_bronze
from tidemart.operators.ingest import bronze_projection
from tidemart.schema import MART_TABLES, SESSION_METRICS_TABLE
from tidemart.sinks import warehouse as warehouse_module
from tidemart.sinks.files import Files
from tidemart.sinks.lake import STREAM_BATCH, LakePaths, gold_write, write_batch
from tidemart.sinks.releases import UNDATED, ReleaseConflict, Releases, dataset, published
from tidemart.sinks.warehouse import Warehouse, warehouse_namespaces, warehouse_write
from tests.samples import payload, topic

DAY1, DAY2, DAY3 = date(2025, 1, 1), date(2025, 1, 2), date(2025, 1, 3)


def rows(spark, values):
    return spark.createDataFrame(values, "x int, event_date date")


def content(frame):
    return sorted((r.x, r.event_date) for r in frame.collect())


def test_whole_dates_and_ranges(spark, tmp_path):
    path = f"{tmp_path}/things"
    published(rows(spark, [(1, DAY1), (2, DAY2), (3, None)]), path)
    assert sorted((r.x, str(r.event_date)) for r in dataset(spark, path).collect()) == [(1, str(DAY1)), (2, str(DAY2)), (3, "None")]
    published(rows(spark, [(4, DAY2)]), path, only_dates=True)
    assert {(r.x, r.event_date) for r in dataset(spark, path).collect()} == {(1, DAY1), (4, DAY2), (3, None)}
    # A range without end takes the days behind its start, and leaves rows without a date alone.
    published(rows(spark, [(5, DAY3)]), path, start=DAY2)
    assert {(r.x, r.event_date) for r in dataset(spark, path).collect()} == {(1, DAY1), (5, DAY3), (3, None)}
    with pytest.raises(ValueError, match="2025-01-01"):
        published(rows(spark, [(6, DAY1)]), path, start=DAY2)
    with pytest.raises(ValueError, match=UNDATED):
        published(rows(spark, [(6, None)]), path, start=DAY2)
    assert dataset(spark, path).count() == 3
    published(rows(spark, []), path)
    assert dataset(spark, path).columns == ["x", "event_date"] and dataset(spark, path).count() == 0


def test_only_the_days_asked_for_are_listed(spark, tmp_path):
    path = f"{tmp_path}/things"
    published(rows(spark, [(1, DAY1), (2, DAY2), (3, DAY3)]), path)
    frame = dataset(spark, path, DAY2, DAY2)
    assert content(frame) == [(2, DAY2)] and all("2025-01-02" in name for name in frame.inputFiles())


def test_a_reader_keeps_its_release(spark, tmp_path):
    path = f"{tmp_path}/things"
    published(rows(spark, [(1, DAY1)]), path)
    before = dataset(spark, path)
    published(rows(spark, [(2, DAY1)]), path)
    assert content(before) == [(1, DAY1)] and content(dataset(spark, path)) == [(2, DAY1)]


def test_of_two_writers_one_is_refused(spark, tmp_path):
    path = f"{tmp_path}/things"
    published(rows(spark, [(1, DAY1)]), path)
    releases = Releases(spark, str(tmp_path))
    since = releases.release()
    mine = releases.stage(rows(spark, [(2, DAY2)]), "things", only_dates=True)
    published(rows(spark, [(3, DAY3)]), path, only_dates=True)
    with pytest.raises(ReleaseConflict):
        releases.publish([mine], since)
    assert content(dataset(spark, path)) == [(1, DAY1), (3, DAY3)]


def test_cleaning_leaves_what_is_named_or_young(spark, tmp_path):
    path = f"{tmp_path}/things"
    for x in range(4):
        published(rows(spark, [(x, DAY1)]), path)
    releases = Releases(spark, str(tmp_path))
    young = releases.stage(rows(spark, [(9, DAY2)]), "things", only_dates=True)
    assert len(releases.files.names(path)) == 5
    gone = releases.clean(keep=2)
    assert [name.rsplit("/", 1)[1] for name in gone] == ["000000000001.json", "000000000002.json"]
    releases.clean(keep=2, older_than_hours=-1)
    assert releases.files.names(path) == sorted(f"batch={releases.release(v).datasets['things']['days'][str(DAY1)]}" for v in (3, 4))
    assert f"batch={young.batch}" not in releases.files.names(path)
    assert content(dataset(spark, path)) == [(3, DAY1)]


class Broken(RuntimeError):
    pass


def breaking_at(monkeypatch, owner, name, call):
    """Let the ``call``-th use of a function fail, before it does anything."""
    real, calls = getattr(owner, name), []

    def fake(*args, **kwargs):
        calls.append(name)
        if len(calls) == call:
            raise Broken(name)
        return real(*args, **kwargs)

    monkeypatch.setattr(owner, name, fake)
    return calls


def test_a_write_that_fails_changes_nothing(spark, tmp_path, monkeypatch):
    path = gold_write(rows(spark, [(1, DAY1), (2, DAY2)]), str(tmp_path), "mart")
    broken = rows(spark, [(8, DAY1)]).withColumn("x", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        gold_write(broken, str(tmp_path), "mart", start=DAY1)
    for owner, name in ((Releases, "stage"), (Releases, "publish"), (Files, "write_text")):
        with monkeypatch.context() as patch:
            breaking_at(patch, owner, name, 1)
            with pytest.raises(Broken):
                gold_write(rows(spark, [(9, DAY2)]), str(tmp_path), "mart", start=DAY1)
        assert content(dataset(spark, path)) == [(1, DAY1), (2, DAY2)]
    gold_write(rows(spark, [(9, DAY2)]), str(tmp_path), "mart", start=DAY1)
    assert content(dataset(spark, path)) == [(9, DAY2)]


def test_warehouse_tables_change_in_one_step(spark, tmp_path, monkeypatch):
    target = Warehouse("staging_w", "analytics_w", str(tmp_path))
    warehouse_namespaces(spark, target)
    from tidemart.operators import marts

    mart = marts.session_metrics(two_days(spark))
    name = warehouse_write(mart, "analytics_w", SESSION_METRICS_TABLE)
    before = spark.table(name).collect()
    assert len(before) == 2
    later = mart.where(F.col("event_date") == DAY2).withColumn("event_count", F.lit(77))
    for step in ("stage_table", "publish_tables", "_show"):
        with monkeypatch.context() as patch:
            breaking_at(patch, warehouse_module, step, 1)
            with pytest.raises(Broken):
                warehouse_write(later, "analytics_w", SESSION_METRICS_TABLE, start=DAY1, end=DAY2)
        assert spark.table(name).collect() == before
    for _ in range(3):
        warehouse_write(later, "analytics_w", SESSION_METRICS_TABLE, start=DAY1, end=DAY2)
        assert [(r.event_date, r.event_count) for r in spark.table(name).collect()] == [(DAY2, 77)]
    versions = [r.tableName for r in spark.sql("SHOW TABLES IN analytics_w").collect() if "__v" in r.tableName]
    assert len(versions) == 2
    with pytest.raises(ValueError, match="without event_date"):
        warehouse_write(mart.withColumn("event_date", F.lit(None).cast("date")), "analytics_w", SESSION_METRICS_TABLE)


def state(spark, gold, target):
    marts = {c.name: sorted(map(repr, dataset(spark, f"{gold}/{c.name}").collect())) for c in MART_TABLES}
    tables = {c.name: sorted(map(repr, spark.table(f"{target.analytics}.{c.name}").collect())) for c in MART_TABLES}
    staged = sorted(map(repr, spark.table(f"{target.staging}.user_events_silver").collect()))
    return marts, tables, staged


def test_a_daily_run_that_fails_leaves_each_layer_whole(spark, tmp_path, monkeypatch):
    silver_path, products_path = daily_inputs(spark, tmp_path)
    gold, target = str(tmp_path / "gold"), Warehouse("staging_f", "analytics_f", str(tmp_path / "wh"))
    daily_run(spark, silver_path, products_path, gold, target)
    old = state(spark, gold, target)
    moved = silver(spark, event(event_id="e3", event_time="2025-01-01T09:00:00+00:00"), event(event_id="e1"))
    published(moved, silver_path, start=DAY1, end=DAY2)
    steps = [(Releases, "stage", 2), (daily, "stage_table", 3), (Releases, "publish", 1), (daily, "publish_tables", 1)]
    steps += [(daily, "publish_tables", 2), (warehouse_module, "_show", 3), (daily, "run_checks", 1)]
    seen = []
    for owner, name, call in steps:
        with monkeypatch.context() as patch:
            breaking_at(patch, owner, name, call)
            with pytest.raises(Broken):
                daily_run(spark, silver_path, products_path, gold, target, start=DAY1, end=DAY2)
        seen.append(state(spark, gold, target))
        if name in ("stage", "stage_table") or (owner, name) == (Releases, "publish"):
            assert seen[-1] == old
    daily_run(spark, silver_path, products_path, gold, target, start=DAY1, end=DAY2)
    new = state(spark, gold, target)
    assert new != old
    # Whatever step failed, Gold is as a whole the old or the new one, and so is every table.
    for marts, tables, staged in seen:
        assert marts in (old[0], new[0]) and staged in (old[2], new[2])
        assert all(tables[name] in (old[1][name], new[1][name]) for name in tables)


def test_a_rebuild_that_fails_leaves_silver(spark, tmp_path, monkeypatch):
    paths = LakePaths(str(tmp_path))
    write_batch(bronze_projection(topic(spark, payload(event_id="a"))), paths.bronze, 0)
    rebuild_silver_from_bronze(spark, paths.bronze, paths.rebuilt_silver)
    write_batch(bronze_projection(topic(spark, payload(event_id="b"))), paths.bronze, 1)
    for run in (
        lambda: rebuild_silver_from_bronze(spark, paths.bronze, paths.rebuilt_silver, DAY1, DAY1),
        lambda: rebuild_silver_from_bronze(spark, paths.bronze, paths.rebuilt_silver),
        lambda: rebuild_silver_changes(spark, paths.bronze, paths.rebuilt_silver),
    ):
        for owner, name in ((Releases, "stage"), (Releases, "publish")):
            with monkeypatch.context() as patch:
                breaking_at(patch, owner, name, 1)
                with pytest.raises(Broken):
                    run()
            assert [r.event_id for r in dataset(spark, paths.rebuilt_silver).collect()] == ["a"]


# Incremental rebuilds


def events(spark, *changes):
    return bronze_projection(topic(spark, *(payload(**change) for change in changes)))


def timed(event_id, event_time, ingest):
    return {"event_id": event_id, "event_time": f"{event_time}+00:00", "ingest_time": f"2025-01-09T{ingest}:00+00:00"}


DELIVERIES = [
    [timed("a", "2025-01-01T10:00:00", "01:00"), timed("b", "2025-01-02T10:00:00", "01:00"), timed("c", "2025-01-03T10:00:00", "01:00")],
    # b moves to another day, c comes again with an older ingest time, d is new and late.
    [timed("b", "2025-01-04T10:00:00", "02:00"), timed("c", "2025-01-05T10:00:00", "00:30"), timed("d", "2025-01-01T09:00:00", "02:00")],
    [],
    # Twice in one delivery; a tie with an earlier one.
    [timed("a", "2025-01-06T10:00:00", "03:00"), timed("a", "2025-01-07T10:00:00", "02:30"), timed("d", "2025-01-01T08:00:00", "02:00")],
]


def silver_rows(frame):
    return sorted((r.event_id, r.event_time, r.ingest_time, r.event_date) for r in frame.collect())


def test_changes_give_what_a_whole_rebuild_gives(spark, tmp_path):
    paths, whole = LakePaths(f"{tmp_path}/lake"), f"{tmp_path}/whole/silver"
    offset = 0
    for batch, delivery in enumerate(DELIVERIES):
        if delivery:
            frame = events(spark, *delivery).withColumn("offset", F.col("offset") + offset)
            offset += len(delivery)
            write_batch(frame, paths.bronze, batch)
        release = rebuild_silver_changes(spark, paths.bronze, paths.rebuilt_silver)
        rebuild_silver_from_bronze(spark, paths.bronze, whole)
        assert silver_rows(dataset(spark, paths.rebuilt_silver)) == silver_rows(dataset(spark, whole))
        days = release.datasets["user_events"]["days"]
        assert set(days) == {str(r.event_date) for r in dataset(spark, whole).collect()}
    # Days that nothing touched still lie in their old files.
    assert days["2025-01-03"] != days["2025-01-06"] and release.datasets["user_events"]["note"] == {"bronze_batch": 3}
    assert rebuild_silver_changes(spark, paths.bronze, paths.rebuilt_silver) == release


def test_only_new_batches_of_bronze_are_read(spark, tmp_path):
    paths = LakePaths(str(tmp_path))
    for batch in range(3):
        write_batch(events(spark, timed(f"e{batch}", "2025-01-01T10:00:00", "01:00")), paths.bronze, batch)
    changes = changed_bronze(spark.read.parquet(paths.bronze), 1, 2)
    plan = changes._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({STREAM_BATCH}" in plan and changes.count() == 1
    scan = [line for line in changes._jdf.queryExecution().toString().split("\n") if "FileScan" in line]
    assert scan and "InMemoryFileIndex" in scan[0]
