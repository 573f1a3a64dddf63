"""Readers, batch writers, contracts, checks and the daily run."""

from __future__ import annotations

import json
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.samples import event, payload, silver
from tidemart.operators import checks, marts
from tidemart.operators.dedup import batch_dedup_any
from tidemart.operators.conform import conform, contract_breaches
from tidemart.operators.ingest import bronze_projection, topic_encode
from tidemart.operators.validate import validate_contract_rules
from tidemart.plans.daily import daily_run
from tidemart.schema import (
    DAILY_KPIS_TABLE,
    FIELD_NAMES,
    MART_TABLES,
    PRODUCT_SCHEMA,
    SESSION_METRICS_TABLE,
    SILVER_TABLE,
)
from tidemart.session import scratch_dir
from tidemart.sinks.lake import gold_write, overwrite_by_date
from tidemart.sinks.releases import dataset, published
from tidemart.sinks.warehouse import Warehouse, jdbc_options, warehouse_namespaces, warehouse_write
from tidemart.sources.adapters import events_as_silver
from tidemart.sources.lake import event_json_array_scan, product_dim_scan, silver_scan

SF_DIR = "/root/testdata/sf0.001"


def two_days(spark):
    return silver(
        spark,
        event(event_id="e1"),
        event(event_id="e2", event_type="purchase", order_id="o", order_amount=10.0),
        event(event_id="e3", event_time="2025-01-02T09:00:00+00:00"),
    )


def test_json_array_file_over_many_lines(spark, tmp_path):
    events = [payload(), payload(event_id="event-b", event_type="purchase", order_amount=19.0)]
    (tmp_path / "events.json").write_text(json.dumps(events, indent=2))
    rows = event_json_array_scan(spark, str(tmp_path)).orderBy("event_id").collect()
    assert [row.event_id for row in rows] == ["event-a", "event-b"]
    assert (rows[0].order_amount, rows[1].order_amount) == (None, 19.0)
    assert rows[0].event_time is not None and rows[0].schema_version == 1


def test_json_arrays_one_per_line(spark, tmp_path):
    line = json.dumps([payload(), payload(event_id="event-b")])
    (tmp_path / "events.json").write_text(f"{line}\n{line}\n")
    assert event_json_array_scan(spark, str(tmp_path), array_per_line=True).count() == 4


def test_product_csv_is_all_text(spark, tmp_path):
    (tmp_path / "products.csv").write_text("product_id,category,price_band\n007,apparel,low\n")
    scanned = product_dim_scan(spark, str(tmp_path))
    assert scanned.schema == PRODUCT_SCHEMA
    assert scanned.first().product_id == "007"


def test_silver_scan_prunes_partitions_and_recomputes_the_date(spark, tmp_path):
    path = str(tmp_path / "silver")
    overwrite_by_date(events_as_silver(spark, SF_DIR), path)
    day = date(2024, 1, 10)
    scanned = silver_scan(spark, path, day, day)
    expected = events_as_silver(spark, SF_DIR).filter(F.col("event_date") == day)
    assert scanned.count() == expected.count() > 0
    plan = scanned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_gold_round_trip_and_partial_overwrite(spark, tmp_path):
    mart = marts.session_metrics(two_days(spark))
    path = gold_write(mart, str(tmp_path), "session_metrics")
    back = dataset(spark, path)
    assert sorted(back.select(*mart.columns).collect()) == sorted(mart.collect())
    one_day = mart.filter(F.col("event_date") == date(2025, 1, 1)).withColumn(
        "total_revenue", F.lit(99.0)
    )
    gold_write(one_day, str(tmp_path), "session_metrics", only_dates=True)
    revenue = {row.event_date.day: row.total_revenue for row in dataset(spark, path).collect()}
    assert revenue == {1: 99.0, 2: 0.0}


def test_conform_gives_the_declared_types(spark):
    typed = conform(marts.daily_kpis(two_days(spark)), DAILY_KPIS_TABLE)
    assert typed.columns == DAILY_KPIS_TABLE.column_names
    assert typed.schema["total_revenue"].dataType == T.DecimalType(12, 2)
    assert typed.schema["total_events"].dataType == T.IntegerType()
    silver_typed = conform(two_days(spark).withColumn("stream_ingest_time", F.lit(1)), SILVER_TABLE)
    assert silver_typed.columns == [*FIELD_NAMES, "event_date"]


def test_contract_breaches_are_counted(spark):
    rows = silver(
        spark, event(), event(), event(user_id=None), event(event_id="x", order_amount=1e12)
    )
    found = {row.rule: row.breaches for row in contract_breaches(rows, SILVER_TABLE).collect()}
    assert found["unique:event_id"] == 2
    assert found["not_null:user_id"] == 1
    assert found["fits:order_amount"] == 1
    assert "not_null:order_id" not in found
    two_users = silver(spark, event(), event(event_id="b", user_id="u2"))
    sessions = contract_breaches(marts.session_metrics(two_users), SESSION_METRICS_TABLE)
    assert {r.rule: r.breaches for r in sessions.collect()}["unique:event_date,session_id"] == 1


def test_each_check_can_fail(spark):
    kpis = marts.daily_kpis(two_days(spark))
    assert checks.check_daily_kpis_not_empty(kpis).first().passed
    assert not checks.check_daily_kpis_not_empty(kpis.limit(0)).first().passed
    assert checks.check_non_negative_revenue(kpis).first().passed
    negative = kpis.withColumn("total_revenue", F.lit(-1.0))
    assert not checks.check_non_negative_revenue(negative).first().passed
    assert checks.check_no_duplicate_event_ids(two_days(spark)).first().passed
    twice = silver(spark, event(), event())
    assert not checks.check_no_duplicate_event_ids(twice).first().passed
    assert not checks.check_product_metrics_not_empty(kpis.limit(0)).first().passed


def test_enforce_collects_all_failures(spark):
    kpis = marts.daily_kpis(two_days(spark))
    verdicts = checks.run_checks(silver(spark, event(), event()), kpis, kpis.limit(0))
    with pytest.raises(checks.QualityCheckError) as caught:
        checks.enforce(verdicts)
    assert str(caught.value) == (
        "quality checks failed: no_duplicate_event_ids: "
        "staging.user_events_silver must not contain duplicate event_id values; "
        "product_metrics_not_empty: "
        "analytics.product_daily_metrics must contain at least one row"
    )


def test_checks_from_sql_files(spark, tmp_path):
    two_days(spark).createOrReplaceTempView("some_events")
    (tmp_path / "02_second.sql").write_text("SELECT 'second' AS n, false AS p, 'no' AS d;\n")
    (tmp_path / "01_first.sql").write_text(
        "SELECT 'first' AS n, EXISTS (SELECT 1 FROM some_events) AS p, 'rows' AS d;\n"
    )
    verdicts = checks.sql_file_checks(spark, str(tmp_path))
    assert [tuple(row) for row in verdicts.collect()] == [
        ("first", True, "rows"),
        ("second", False, "no"),
    ]


def test_topic_encode_round_trip(spark):
    events = two_days(spark)
    records = topic_encode(events).select(
        "*",
        F.lit("t").alias("topic"),
        F.lit(0).alias("partition"),
        F.lit(0).cast("long").alias("offset"),
        F.lit("2025-01-01").cast("timestamp").alias("timestamp"),
    )
    first = records.orderBy("key").first()
    assert bytes(first.key) == b"e1"
    assert json.loads(bytes(first.value))["order_id"] is None
    back = validate_contract_rules(bronze_projection(records))
    assert sorted(back.select(*FIELD_NAMES).collect()) == sorted(
        events.select(*FIELD_NAMES).collect()
    )


def test_jdbc_options_keep_the_table(spark):
    options = jdbc_options("jdbc:x://host/db", "analytics.daily_kpis", "u", "p", "some.Driver")
    assert options["truncate"] == "true" and options["dbtable"] == "analytics.daily_kpis"
    assert "numPartitions" not in options
    assert jdbc_options("u", "t", "u", "p", "d", 3)["numPartitions"] == "3"


def daily_inputs(spark, tmp_path):
    silver_path, products_path = str(tmp_path / "silver"), str(tmp_path / "products.csv")
    published(two_days(spark).union(two_days(spark).limit(1)), silver_path)
    (tmp_path / "products.csv").write_text(
        "product_id,category,price_band\nproduct-a,accessories,low\n"
    )
    return silver_path, products_path


def test_daily_run_writes_and_checks_everything(spark, tmp_path):
    silver_path, products_path = daily_inputs(spark, tmp_path)
    target = Warehouse("staging_t1", "analytics_t1", str(tmp_path / "warehouse"))
    verdicts = daily_run(spark, silver_path, products_path, str(tmp_path / "gold"), target)
    assert all(row.passed for row in verdicts.collect())
    assert spark.table("staging_t1.user_events_silver").count() == 3
    kpis = spark.table("analytics_t1.daily_kpis").orderBy("event_date").collect()
    assert [float(row.total_revenue) for row in kpis] == [10.0, 0.0]
    for contract in MART_TABLES:
        table = spark.table(f"analytics_t1.{contract.name}")
        assert table.count() == dataset(spark, f"{tmp_path}/gold/{contract.name}").count() > 0
        assert {f.name: f.dataType for f in table.schema} == dict(contract.columns)

    # A second run for one day leaves the other day alone.
    day = date(2025, 1, 2)
    published(
        silver(spark, event(event_id="e9", event_time="2025-01-02T08:00:00+00:00"),
               event(event_id="e8", event_time="2025-01-02T08:30:00+00:00")),
        silver_path, only_dates=True,
    )
    daily_run(
        spark, silver_path, products_path, str(tmp_path / "gold"), target, start=day, end=day
    )
    kpis = spark.table("analytics_t1.daily_kpis").orderBy("event_date").collect()
    assert [row.total_events for row in kpis] == [2, 2]
    assert spark.table("staging_t1.user_events_silver").count() == 4


def test_daily_run_without_a_warehouse(spark, tmp_path):
    silver_path, products_path = daily_inputs(spark, tmp_path)
    verdicts = daily_run(
        spark, silver_path, products_path, str(tmp_path / "gold"), load_warehouse=False
    )
    assert verdicts.count() == 4
    assert dataset(spark, f"{tmp_path}/gold/daily_kpis").count() == 2


def test_namespaces_are_created_once(spark, tmp_path):
    target = Warehouse("staging_t2", "analytics_t2", str(tmp_path))
    warehouse_namespaces(spark, target)
    warehouse_namespaces(spark, target)
    assert spark.catalog.databaseExists("analytics_t2")
    name = warehouse_write(marts.daily_kpis(two_days(spark)), "analytics_t2", DAILY_KPIS_TABLE)
    assert spark.table(name).count() == 2


def test_scratch_is_under_the_shared_folder(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir") + "/x-")


def test_topic_encode_keeps_microseconds(spark):
    stamp = datetime(2025, 1, 1, 10, 0, 0, 123456, tzinfo=timezone.utc)
    text = topic_encode(silver(spark, event(event_time=stamp))).first().value.decode()
    assert json.loads(text)["event_time"] == "2025-01-01T10:00:00.123456+00:00"


def test_product_columns_are_found_by_header(spark, tmp_path):
    (tmp_path / "p.csv").write_text("category,extra,product_id,price_band\naccessories,1,product-a,low\n")
    row = product_dim_scan(spark, str(tmp_path)).first()
    assert (row.product_id, row.category, row.price_band) == ("product-a", "accessories", "low")
    (tmp_path / "p.csv").write_text("category,product_id\naccessories,product-a\n")
    with pytest.raises(ValueError, match="price_band"):
        product_dim_scan(spark, str(tmp_path))


def test_values_that_do_not_fit_raise(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_any_row_per_id_is_cut_before_the_shuffle(spark):
    frame = batch_dedup_any(silver(spark, event(), event(), event(event_id="b")))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert frame.count() == 2 and "WindowGroupLimit" in plan and "SortAggregate" not in plan


def test_daily_run_reports_an_empty_window(spark, tmp_path):
    silver_path, products_path = daily_inputs(spark, tmp_path)
    target = Warehouse("staging_e", "analytics_e", str(tmp_path / "wh"))
    with pytest.raises(Exception, match="(?i)check"):
        daily_run(
            spark, silver_path, products_path, str(tmp_path / "gold"), target,
            start=date(2030, 1, 1), work_path=str(tmp_path / "work"),
        )
    assert not (tmp_path / "work").exists()


def test_daily_run_refuses_broken_keys_before_publishing(spark, tmp_path):
    silver_path, products_path = daily_inputs(spark, tmp_path)
    twice = silver(spark, event(event_id="a", user_id="u1"), event(event_id="b", user_id="u2"))
    published(twice, silver_path)
    target = Warehouse("staging_k", "analytics_k", str(tmp_path / "wh"))
    gold = tmp_path / "gold"
    with pytest.raises(ValueError, match="session_metrics unique:"):
        daily_run(spark, silver_path, products_path, str(gold), target)
    assert not gold.exists()
    rule = "unique:" + ",".join(SESSION_METRICS_TABLE.key)
    daily_run(spark, silver_path, products_path, str(gold), target, accepted_breaches=(rule,))
    assert spark.table("analytics_k.session_metrics").count() == 2


def test_a_range_is_replaced_with_all_its_days(spark, tmp_path):
    """An event moves from one day of the range to another; its old day is gone everywhere."""
    silver_path, products_path = daily_inputs(spark, tmp_path)
    gold = str(tmp_path / "gold")
    target = Warehouse("staging_r", "analytics_r", str(tmp_path / "wh"))
    daily_run(spark, silver_path, products_path, gold, target)
    before = {str(r.event_date) for r in spark.table("analytics_r.daily_kpis").collect()}
    assert before == {"2025-01-01", "2025-01-02"}
    moved = silver(spark, event(event_id="e3", event_time="2025-01-01T09:00:00+00:00"), event(event_id="e1"))
    published(moved, silver_path, start=date(2025, 1, 1), end=date(2025, 1, 2))
    assert {str(r.event_date) for r in dataset(spark, silver_path).collect()} == {"2025-01-01"}
    for _ in range(2):
        daily_run(spark, silver_path, products_path, gold, target, start=date(2025, 1, 1), end=date(2025, 1, 2))
        for frame in (
            spark.table("analytics_r.daily_kpis"), spark.table("staging_r.user_events_silver"), dataset(spark, f"{gold}/daily_kpis"),
        ):
            assert {str(r.event_date) for r in frame.collect()} == {"2025-01-01"}
        assert spark.table("staging_r.user_events_silver").count() == 2


def test_ranged_rebuild_query_makes_its_feed_once(spark, monkeypatch):
    """What is dated late is judged from the Bronze that was written, and its days are not found by judging it again."""
    from tidemart.plans import registry

    made, judged = [], []
    feed, rules = registry.raw_topic_feed, registry.validate_contract_rules
    monkeypatch.setattr(registry, "raw_topic_feed", lambda *given: made.append(1) or feed(*given))
    monkeypatch.setattr(registry, "validate_contract_rules", lambda rows: judged.append(rows.inputFiles()) or rules(rows))
    rows = registry.QUERIES["rebuild_silver_range"](spark, "/root/testdata/sf0.001")
    assert len(made) == 1 and len(judged) == 1
    assert all("/bronze/" in file for file in judged[0]) and rows.count() > 0
