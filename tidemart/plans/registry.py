"""One query per operator, over the whole test tables.

Shown columns are made comparable across engines: instants as ``timestamp_ntz``, error lists as
text, run-time stamps left out. Queries that test a writer or a stream write under the shared
scratch folder and return what a reader finds there.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemart.operators import checks, marts, reports
from tidemart.operators.conform import all_breaches, conform
from tidemart.operators.dedup import batch_dedup_any, dedup_latest
from tidemart.operators.ingest import bronze_projection, event_date_fallback, topic_encode
from tidemart.operators.quality import data_quality_report
from tidemart.operators.validate import (
    coerce_events,
    parse_payload,
    route_quarantine,
    route_valid,
    validate_contract_rules,
    validate_stream_rules,
)
from tidemart.plans.daily import daily_run
from tidemart.plans.day_state import DayState
from tidemart.plans.oracles import check_texts
from tidemart.plans.rebuild import rebuild_silver_changes, rebuild_silver_from_bronze
from tidemart.schema import (
    CONVERSION_FUNNEL_TABLE,
    DAILY_KPIS_TABLE,
    EVENT_SCHEMA,
    FIELD_NAMES,
    PRODUCT_METRICS_TABLE,
    SESSION_METRICS_TABLE,
    SILVER_TABLE,
    TableContract,
)
from tidemart.session import scratch_dir, stream_session, tune
from tidemart.sinks.lake import STREAM_BATCH, LakePaths, gold_write, overwrite_by_date, write_batch
from tidemart.sinks.releases import dataset, published
from tidemart.sinks.warehouse import Warehouse, warehouse_namespaces, warehouse_write
from tidemart.sinks.topic import LandedTopic
from tidemart.sources.adapters import (
    REDELIVERY_OFFSET,
    TOPIC,
    TOPIC_PARTITIONS,
    events_as_silver,
    parts_as_products,
    raw_topic_feed,
)
from tidemart.sources.json_array import json_array_scan, write_json_array
from tidemart.sources.lake import bronze_scan, event_json_array_scan, product_dim_scan, silver_scan
from tidemart.sources.topic import landed_topic_source
from tidemart.streaming.id_index import IdIndex
from tidemart.streaming.lakehouse import AVAILABLE_NOW, await_queries, start_lakehouse
from tidemart.streaming.one_query import late_rows, start_lakehouse_once, stream_counts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
STATE_PARTITIONS = 8


def query(name: str) -> Callable[[Query], Query]:
    """Register a function as query ``name``, run under the settings results depend on."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(tune(spark), sf_dir)

        QUERIES[name] = run
        return function

    return register


def shown(frame: DataFrame) -> DataFrame:
    """The frame in comparable types."""
    columns = []
    for field in frame.schema.fields:
        column = F.col(field.name)
        if field.name == "stream_ingest_time":
            continue
        if isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.concat_ws("|", column)
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("string")
        columns.append(column.alias(field.name))
    return frame.select(*columns)


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_projection(raw_topic_feed(spark, sf_dir))


# Sources


def _landed_feed(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_dir(spark, "topic")
    raw_topic_feed(spark, sf_dir).write.parquet(path)
    return path


@query("topic_source")
def _topic_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed topic, read as a stream into a table."""
    root = scratch_dir(spark, "topic-copy")
    records = landed_topic_source(spark, _landed_feed(spark, sf_dir))
    copy = (
        records.writeStream.format("parquet")
        .option("path", f"{root}/records")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(**AVAILABLE_NOW)
        .start()
    )
    await_queries([copy])
    landed = spark.read.parquet(f"{root}/records")
    return shown(landed.withColumns({c: F.col(c).cast("string") for c in ("key", "value")}))


@query("silver_scan")
def _silver_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "silver")
    published(events_as_silver(spark, sf_dir), path)
    return shown(silver_scan(spark, path))


@query("product_dim_scan")
def _product_dim_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_dim_scan(spark, _products_csv(spark, sf_dir))


def _products_csv(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_dir(spark, "products")
    parts_as_products(spark, sf_dir).write.option("header", True).csv(path)
    return path


@query("event_json_array_scan")
def _event_json_array_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event in a JSON array of its own; events on the hour's first half come twice."""
    path = scratch_dir(spark, "json-arrays")
    event = F.struct(*FIELD_NAMES)
    twice = F.minute("event_time") < 30
    events_as_silver(spark, sf_dir).select(
        F.to_json(
            F.when(twice, F.array(event, event)).otherwise(F.array(event)),
            {
                "ignoreNullFields": "false",
                "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
            },
        )
    ).write.text(path)
    return shown(event_json_array_scan(spark, path, array_per_line=True))


# Projections, parsing, validation, routing


@query("bronze_projection")
def _bronze_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(bronze(spark, sf_dir))


@query("parse_payload")
def _parse_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(parse_payload(bronze(spark, sf_dir)))


@query("event_date_fallback")
def _event_date_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_payload(bronze(spark, sf_dir)).select(
        "partition", "offset", event_date_fallback().alias("event_date")
    )


def _verdicts(validated: DataFrame) -> DataFrame:
    return shown(validated.select("partition", "offset", "event_id", "validation_errors"))


@query("validate_stream_rules")
def _validate_stream_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _verdicts(validate_stream_rules(bronze(spark, sf_dir)))


@query("validate_contract_rules")
def _validate_contract_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _verdicts(validate_contract_rules(bronze(spark, sf_dir)))


@query("coerce_events")
def _coerce_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(coerce_events(bronze(spark, sf_dir)))


@query("route_quarantine")
def _route_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(route_quarantine(validate_stream_rules(bronze(spark, sf_dir))))


@query("route_valid")
def _route_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(route_valid(validate_stream_rules(bronze(spark, sf_dir))))


@query("topic_encode")
def _topic_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events encoded as topic records and parsed back."""
    records = topic_encode(events_as_silver(spark, sf_dir)).select(
        "key",
        "value",
        F.lit("user_events_v1").alias("topic"),
        F.lit(0).alias("partition"),
        F.lit(0).cast("long").alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )
    parsed = parse_payload(bronze_projection(records))
    return shown(parsed.select(*FIELD_NAMES))


@query("topic_sink")
def _topic_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written to a landed topic in two batches, read back and parsed."""
    topic = LandedTopic(scratch_dir(spark, "topic"), TOPIC, TOPIC_PARTITIONS)
    silver = events_as_silver(spark, sf_dir)
    early = F.minute("event_time") < 30
    topic.write(silver.where(early), 0)
    topic.write(silver.where(~early), 1)
    return shown(parse_payload(bronze_projection(topic.read(spark))).select(*FIELD_NAMES))


@query("event_json_array_split")
def _event_json_array_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events from one file that holds a single array."""
    path = scratch_dir(spark, "json-array")
    options = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    events = events_as_silver(spark, sf_dir).select(F.to_json(F.struct(*FIELD_NAMES), options).alias("event"))
    write_json_array(events, path)
    return shown(json_array_scan(spark, path, EVENT_SCHEMA))


# Joins and marts


@query("product_left_join")
def _product_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = events_as_silver(spark, sf_dir)
    return shown(marts.product_left_join(silver, parts_as_products(spark, sf_dir)))


@query("daily_kpis")
def _daily_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.daily_kpis(events_as_silver(spark, sf_dir))


@query("daily_kpis_merged")
def _daily_kpis_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily KPIs from states that were merged: all events but those of two parts of each hour, then these."""
    silver = events_as_silver(spark, sf_dir)
    root = scratch_dir(spark, "day-state")
    state = DayState(spark, f"{root}/days", f"{root}/numbers", STATE_PARTITIONS)
    minute = F.minute("event_time")
    for rows in (silver.where(minute < 30), silver.where(minute >= 45), silver.where(minute.between(30, 44))):
        state.add(rows)
    return state.kpis()


@query("conversion_funnel")
def _conversion_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.conversion_funnel(events_as_silver(spark, sf_dir))


def _session_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.session_metrics(events_as_silver(spark, sf_dir))


@query("session_metrics")
def _session_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_session_mart(spark, sf_dir))


@query("product_daily_metrics")
def _product_daily_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = events_as_silver(spark, sf_dir)
    return marts.product_daily_metrics(silver, parts_as_products(spark, sf_dir))


@query("daily_kpis_from_raw")
def _daily_kpis_from_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.daily_kpis_from_raw(coerce_events(bronze(spark, sf_dir)))


@query("session_metrics_from_raw")
def _session_metrics_from_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.session_metrics_from_raw(coerce_events(bronze(spark, sf_dir)))


@query("data_quality_report")
def _data_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data_quality_report(bronze(spark, sf_dir))


# Deduplication


@query("batch_dedup_any")
def _batch_dedup_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kept row is arbitrary, so only what all copies share is shown."""
    kept = batch_dedup_any(coerce_events(bronze(spark, sf_dir)))
    return shown(kept.drop("ingest_time", "partition", "offset"))


@query("dedup_latest")
def _dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(dedup_latest(coerce_events(bronze(spark, sf_dir))))


# Reports


@query("report_daily_kpis")
def _report_daily_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.report_daily_kpis(_daily_kpis(spark, sf_dir))


@query("report_conversion_funnel")
def _report_conversion_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.report_conversion_funnel(_conversion_funnel(spark, sf_dir))


@query("report_session_metrics")
def _report_session_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.report_session_metrics(_session_mart(spark, sf_dir))


@query("report_product_daily_metrics")
def _report_product_daily_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.report_product_daily_metrics(_product_daily_metrics(spark, sf_dir))


# Checks


@query("check_daily_kpis_not_empty")
def _check_daily_kpis_not_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.check_daily_kpis_not_empty(_daily_kpis(spark, sf_dir))


@query("check_no_duplicate_event_ids")
def _check_no_duplicate_event_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On the redelivered feed before deduplication, where the check must fail."""
    return checks.check_no_duplicate_event_ids(coerce_events(bronze(spark, sf_dir)))


@query("check_non_negative_revenue")
def _check_non_negative_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.check_non_negative_revenue(_daily_kpis(spark, sf_dir))


@query("check_product_metrics_not_empty")
def _check_product_metrics_not_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.check_product_metrics_not_empty(_product_daily_metrics(spark, sf_dir))


@query("run_checks")
def _run_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.run_checks(
        events_as_silver(spark, sf_dir),
        _daily_kpis(spark, sf_dir),
        _product_daily_metrics(spark, sf_dir),
    )


@query("run_checks_sql")
def _run_checks_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same checks from a folder of SQL files."""
    events_as_silver(spark, sf_dir).createOrReplaceTempView("silver")
    _daily_kpis(spark, sf_dir).createOrReplaceTempView("daily_kpis")
    _product_daily_metrics(spark, sf_dir).createOrReplaceTempView("product_daily_metrics")
    # Read by the driver at once, like any folder of checks that is deployed with it.
    with tempfile.TemporaryDirectory() as folder:
        for number, text in enumerate(check_texts("silver")):
            Path(folder, f"{number:02d}.sql").write_text(f"{text};\n", encoding="utf-8")
        return checks.sql_file_checks(spark, folder)


# Contracts and batch sinks


_CONTRACT_FRAMES: list[tuple[Query, TableContract]] = [
    (events_as_silver, SILVER_TABLE),
    (_daily_kpis, DAILY_KPIS_TABLE),
    (_conversion_funnel, CONVERSION_FUNNEL_TABLE),
    (_session_mart, SESSION_METRICS_TABLE),
    (_product_daily_metrics, PRODUCT_METRICS_TABLE),
]


@query("mart_conform")
def _mart_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Breaches of all five table contracts."""
    return all_breaches([(build(spark, sf_dir), table) for build, table in _CONTRACT_FRAMES])


def _conformed(build: Query, table: TableContract) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return shown(conform(build(spark, sf_dir), table))

    return run


for _build, _table in _CONTRACT_FRAMES:
    query(f"mart_conform_{_table.name}")(_conformed(_build, _table))


@query("gold_write")
def _gold_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "gold")
    path = gold_write(_session_mart(spark, sf_dir), root, SESSION_METRICS_TABLE.name)
    return shown(dataset(spark, path))


def _scratch_warehouse(spark: SparkSession) -> Warehouse:
    location = scratch_dir(spark, "warehouse")
    suffix = location.rsplit("-", 1)[1][:12]
    return Warehouse(f"staging_{suffix}", f"analytics_{suffix}", location)


def _written_tables(spark: SparkSession, sf_dir: str) -> tuple[Warehouse, list[str]]:
    warehouse = _scratch_warehouse(spark)
    warehouse_namespaces(spark, warehouse)
    names = []
    for build, contract in _CONTRACT_FRAMES:
        staging = contract is SILVER_TABLE
        namespace = warehouse.staging if staging else warehouse.analytics
        names.append(warehouse_write(build(spark, sf_dir), namespace, contract))
    return warehouse, names


@query("warehouse_write")
def _warehouse_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The session mart as read back from its warehouse table."""
    warehouse = _scratch_warehouse(spark)
    warehouse_namespaces(spark, warehouse)
    mart = _session_mart(spark, sf_dir)
    return shown(spark.table(warehouse_write(mart, warehouse.analytics, SESSION_METRICS_TABLE)))


@query("warehouse_namespaces")
def _warehouse_namespaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables found in the two namespaces after a load, with their row counts."""
    warehouse, names = _written_tables(spark, sf_dir)
    labels = {warehouse.staging: "staging", warehouse.analytics: "analytics"}
    counts = [
        spark.table(name).agg(
            F.lit(labels[name.split(".")[0]]).alias("namespace"),
            F.lit(name.split(".")[1]).alias("table_name"),
            F.count("*").alias("row_count"),
        )
        for name in names
    ]
    return reduce(DataFrame.unionByName, counts)


@query("daily_run")
def _daily_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily run over the deduplicated feed, then its KPI table."""
    lake = scratch_dir(spark, "lake")
    warehouse = _scratch_warehouse(spark)
    silver_path = f"{lake}/silver"
    valid = route_valid(validate_contract_rules(bronze(spark, sf_dir)))
    published(valid, silver_path)
    daily_run(spark, silver_path, _products_csv(spark, sf_dir), f"{lake}/gold", warehouse)
    return shown(spark.table(f"{warehouse.analytics}.{DAILY_KPIS_TABLE.name}"))


def _ranged_run(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A daily run over events that were dated a day late, then one for the whole range once they are right."""
    lake = scratch_dir(spark, "lake")
    warehouse = _scratch_warehouse(spark)
    silver_path, products, gold = f"{lake}/silver", _products_csv(spark, sf_dir), f"{lake}/gold"
    valid = route_valid(validate_contract_rules(bronze(spark, sf_dir)))
    published(_a_day_late(valid), silver_path)
    daily_run(spark, silver_path, products, gold, warehouse)
    start, end = valid.agg(F.min("event_date"), F.date_add(F.max("event_date"), 1)).first()
    published(valid, silver_path, start=start, end=end)
    daily_run(spark, silver_path, products, gold, warehouse, start, end)
    return warehouse


@query("daily_run_range")
def _daily_run_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The KPI table after a ranged run."""
    warehouse = _ranged_run(spark, sf_dir)
    return shown(spark.table(f"{warehouse.analytics}.{DAILY_KPIS_TABLE.name}"))


def _ranged_table(table: TableContract) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        warehouse = _ranged_run(spark, sf_dir)
        namespace = warehouse.staging if table is SILVER_TABLE else warehouse.analytics
        return shown(spark.table(f"{namespace}.{table.name}"))

    return run


for _, _table in _CONTRACT_FRAMES:
    query(f"daily_run_{_table.name}")(_ranged_table(_table))


def _a_day_late(silver: DataFrame) -> DataFrame:
    later = silver.withColumn("event_time", F.col("event_time") + F.expr("INTERVAL 1 DAY"))
    return later.withColumn("event_date", F.to_date("event_time"))


# Streams


def _stream_layers(spark: SparkSession, sf_dir: str, *layers: str) -> LakePaths:
    """The feed run through the named layers' queries to its end."""
    paths = LakePaths(scratch_dir(spark, "lake"))
    records = landed_topic_source(stream_session(spark, STATE_PARTITIONS), _landed_feed(spark, sf_dir))
    await_queries(start_lakehouse(records, paths, AVAILABLE_NOW, layers=layers))
    return paths


@query("bronze_sink")
def _bronze_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(spark.read.parquet(_stream_layers(spark, sf_dir, "bronze").bronze))


@query("silver_sink")
def _silver_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver as streamed; of an id's copies the kept one varies, so ingest time is left out."""
    paths = _stream_layers(spark, sf_dir, "silver")
    return shown(spark.read.parquet(paths.stream_silver).drop("ingest_time"))


@query("quarantine_sink")
def _quarantine_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(spark.read.parquet(_stream_layers(spark, sf_dir, "quarantine").quarantine))


@query("lakehouse_stream")
def _lakehouse_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per layer and date, from the one query that reads the topic and judges its records once."""
    paths, _ = _one_query(spark, raw_topic_feed(spark, sf_dir))
    layers = {
        "bronze": paths.bronze,
        "silver": paths.stream_silver,
        "quarantine": paths.quarantine,
    }
    dates = [
        spark.read.parquet(path).select(F.lit(layer).alias("layer"), "event_date")
        for layer, path in layers.items()
    ]
    return (
        reduce(DataFrame.unionByName, dates)
        .groupBy("layer", "event_date")
        .agg(F.count("*").alias("row_count"))
    )


def _one_query(spark: SparkSession, *deliveries: DataFrame) -> tuple[LakePaths, SparkSession]:
    """The one-query form over a topic, restarted from its checkpoint for each delivery."""
    paths = LakePaths(scratch_dir(spark, "lake"))
    topic = scratch_dir(spark, "topic")
    # This form keeps no state in partitions: as many as are configured, so that a task's share does not grow.
    session = stream_session(spark)
    buckets = int(session.conf.get("spark.sql.shuffle.partitions"))
    for delivery in deliveries:
        delivery.write.mode("append").parquet(topic)
        records = landed_topic_source(session, topic)
        await_queries([start_lakehouse_once(records, paths, AVAILABLE_NOW, buckets=buckets)])
    IdIndex(session, paths.known_ids, buckets).forget()
    return paths, session


@query("stream_known_ids")
def _stream_known_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver and late rows of a stream that forgets no id: all originals, then all redeliveries, then all again."""
    feed = raw_topic_feed(spark, sf_dir)
    again = F.col("offset") >= REDELIVERY_OFFSET
    paths, _ = _one_query(spark, feed.filter(~again), feed.filter(again), feed)
    both = spark.read.parquet(paths.stream_silver).drop(STREAM_BATCH).unionByName(late_rows(spark, paths))
    return shown(both)


@query("lakehouse_counts")
def _lakehouse_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts that the one-query form keeps beside its checkpoint, over a restart; late rows come last."""
    feed = raw_topic_feed(spark, sf_dir)
    late = F.minute("timestamp").between(30, 35)
    paths, session = _one_query(spark, feed.filter(~late), feed.filter(late))
    counts = stream_counts(session, paths)
    return spark.createDataFrame(sorted(counts.items()), "counter string, row_count bigint")


def _two_deliveries(
    spark: SparkSession, first: DataFrame, second: DataFrame, *layers: str
) -> tuple[LakePaths, list[StreamingQuery]]:
    """Run the stream over ``first``, then restart it from its checkpoint with ``second`` added."""
    paths = LakePaths(scratch_dir(spark, "lake"))
    topic = scratch_dir(spark, "topic")
    session = stream_session(spark, STATE_PARTITIONS)
    for delivery in (first, second):
        delivery.write.mode("append").parquet(topic)
        records = landed_topic_source(session, topic)
        queries = start_lakehouse(records, paths, AVAILABLE_NOW, layers=layers)
        await_queries(queries)
    return paths, queries


@query("stream_dedup")
def _stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver after all originals and then all redeliveries: the originals remain."""
    feed = raw_topic_feed(spark, sf_dir)
    again = F.col("offset") >= REDELIVERY_OFFSET
    paths, _ = _two_deliveries(spark, feed.filter(~again), feed.filter(again), "silver")
    return shown(spark.read.parquet(paths.stream_silver))


@query("event_time_watermark")
def _event_time_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the watermark stands once the feed has been read."""
    paths = LakePaths(scratch_dir(spark, "lake"))
    records = landed_topic_source(stream_session(spark, STATE_PARTITIONS), _landed_feed(spark, sf_dir))
    queries = start_lakehouse(records, paths, AVAILABLE_NOW, layers=("silver",))
    await_queries(queries)
    reached = queries[0].lastProgress["eventTime"]["watermark"]
    return spark.read.parquet(paths.stream_silver).agg(
        F.lit(reached).cast("timestamp").cast("timestamp_ntz").alias("watermark"),
        F.count("*").alias("silver_rows"),
    )


@query("late_data")
def _late_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that arrive after the watermark has passed them: the stream's own side output. Records
    stamped from minute 30 to 35 of any hour arrive last."""
    feed = raw_topic_feed(spark, sf_dir)
    late = F.minute("timestamp").between(30, 35)
    paths, _ = _one_query(spark, feed.filter(~late), feed.filter(late))
    return shown(late_rows(spark, paths))


@query("rebuild_silver_from_bronze")
def _rebuild_silver_from_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = LakePaths(scratch_dir(spark, "lake"))
    overwrite_by_date(bronze(spark, sf_dir), paths.bronze)
    rebuild_silver_from_bronze(spark, paths.bronze, paths.rebuilt_silver)
    return shown(dataset(spark, paths.rebuilt_silver))


@query("rebuild_silver_range")
def _rebuild_silver_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver that was dated a day late, rebuilt for its whole range of days: the last one is gone."""
    paths = LakePaths(scratch_dir(spark, "lake"))
    overwrite_by_date(bronze(spark, sf_dir), paths.bronze)
    valid = route_valid(validate_contract_rules(bronze_scan(spark, paths.bronze)))
    published(_a_day_late(valid), paths.rebuilt_silver)
    # The days of the valid rows and the one after them, from the days that were written.
    late = dataset(spark, paths.rebuilt_silver)
    start, end = late.agg(F.date_sub(F.min("event_date"), 1), F.max("event_date")).first()
    rebuild_silver_from_bronze(spark, paths.bronze, paths.rebuilt_silver, start, end)
    return shown(dataset(spark, paths.rebuilt_silver))


@query("rebuild_silver_changes")
def _rebuild_silver_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver rebuilt before the last records came, then brought up to date: what a whole rebuild gives."""
    paths = LakePaths(scratch_dir(spark, "lake"))
    feed = raw_topic_feed(spark, sf_dir)
    last = F.minute("timestamp").between(30, 35) | (F.col("offset") >= REDELIVERY_OFFSET)
    for batch, delivery in enumerate((feed.filter(~last), feed.filter(last))):
        write_batch(bronze_projection(delivery), paths.bronze, batch)
        rebuild_silver_changes(spark, paths.bronze, paths.rebuilt_silver)
    return shown(dataset(spark, paths.rebuilt_silver))
