"""The daily run: Silver to marts, Gold, warehouse and checks.

Three of the four marts are sums over the same (day, session, user) grain, so Silver is shuffled
to that grain once and the marts are built from the written result. Together with the order count
and the product mart that makes three column-pruned scans of Silver.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions.columns import amount_or_zero, as_money, is_purchase, purchase_amount
from tidemart.operators.checks import enforce, run_checks
from tidemart.operators.conform import ContractWatch
from tidemart.operators.dedup import dedup_latest
from tidemart.operators.marts import (
    distinct_per_day,
    funnel_from_user_days,
    join_day_counts,
    orders_per_day,
    product_daily_metrics,
    stage_mask,
    whole_seconds_apart,
)
from tidemart.schema import (
    CONVERSION_FUNNEL_TABLE,
    DAILY_KPIS_TABLE,
    MART_TABLES,
    PRODUCT_METRICS_TABLE,
    SESSION_METRICS_TABLE,
    SILVER_TABLE,
)
from tidemart.session import scratch_dir, together
from tidemart.sinks.releases import Releases
from tidemart.sinks.warehouse import (
    Warehouse,
    jdbc_options,
    jdbc_write,
    namespace_release,
    publish_tables,
    stage_table,
    warehouse_namespaces,
)
from tidemart.sources.lake import product_dim_scan, silver_scan

log = logging.getLogger(__name__)


def session_rollup(silver: DataFrame) -> DataFrame:
    """One row per (day, session, user) with all that the day, funnel and session marts sum."""
    bought = F.coalesce(is_purchase(), F.lit(False))
    return silver.groupBy("event_date", "session_id", "user_id").agg(
        F.min("event_time").alias("session_start_time"),
        F.max("event_time").alias("session_end_time"),
        F.count("*").alias("event_count"),
        F.count_if(bought).alias("purchase_count"),
        F.sum(amount_or_zero()).alias("revenue"),
        F.sum(purchase_amount()).alias("purchase_revenue"),
        F.bit_or(stage_mask()).alias("stages"),
    )


def session_metrics_from_rollup(rollup: DataFrame) -> DataFrame:
    return rollup.withColumn("total_revenue", as_money(F.col("revenue"))).select(
        "event_date",
        "session_id",
        "user_id",
        "session_start_time",
        "session_end_time",
        "event_count",
        "purchase_count",
        "total_revenue",
        whole_seconds_apart().alias("session_duration_seconds"),
    )


def conversion_funnel_from_rollup(rollup: DataFrame) -> DataFrame:
    return funnel_from_user_days(
        rollup.groupBy("event_date", "user_id").agg(F.bit_or("stages").alias("stages"))
    )


def daily_kpis_from_rollup(rollup: DataFrame, silver: DataFrame) -> DataFrame:
    """Daily KPIs from the rollup; only the order count goes back to Silver's purchases."""
    known_user = F.col("user_id").isNotNull()
    users = (
        rollup.groupBy("event_date", "user_id")
        .agg(
            F.sum("event_count").alias("events"),
            F.sum("purchase_revenue").alias("revenue"),
            F.sum("purchase_count").alias("purchases"),
        )
        .groupBy("event_date")
        .agg(
            F.count_if(known_user).alias("daily_active_users"),
            F.sum("events").alias("total_events"),
            as_money(F.sum("revenue")).alias("total_revenue"),
            F.count_if(known_user & (F.col("purchases") > 0)).alias("purchase_users"),
        )
    )
    return join_day_counts(users, distinct_per_day(rollup, "session_id"), orders_per_day(silver))


@dataclass(frozen=True)
class JdbcTarget:
    """Where the optional database copy goes."""

    url: str
    user: str
    password: str
    driver: str
    connections: int | None = None


def daily_run(
    spark: SparkSession,
    silver_path: str,
    products_path: str,
    gold_root: str,
    warehouse: Warehouse = Warehouse(),
    start: date | None = None,
    end: date | None = None,
    load_warehouse: bool = True,
    jdbc: JdbcTarget | None = None,
    accepted_breaches: tuple[str, ...] = (),
    work_path: str | None = None,
) -> DataFrame:
    """Build, write and check everything; returns the verdicts, raises when one fails.

    Repeated ids are resolved before anything is counted. Without dates the whole of Gold and the
    warehouse is rebuilt, otherwise the given days are replaced. ``load_warehouse`` off leaves the
    marts in Gold alone; the checks then run on Gold. Gold's marts change together in one step, and so do those
    of a warehouse namespace: a run that fails before leaves all of them as they were.

    Silver and the marts are held against the table contracts before anything is published: a breach
    raises, unless its rule (such as ``unique:event_date,session_id``) is in ``accepted_breaches``. Work
    tables are under ``work_path``, or the shared scratch folder, and removed at the end, also of a run
    that fails.
    """
    work = work_path or scratch_dir(spark, "daily-run")
    try:
        return _daily_run(
            spark, silver_path, products_path, gold_root, warehouse, start, end, load_warehouse, jdbc, accepted_breaches, work
        )
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(work)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _daily_run(
    spark: SparkSession,
    silver_path: str,
    products_path: str,
    gold_root: str,
    warehouse: Warehouse,
    start: date | None,
    end: date | None,
    load_warehouse: bool,
    jdbc: JdbcTarget | None,
    accepted_breaches: tuple[str, ...],
    work: str,
) -> DataFrame:
    gold = Releases(spark, gold_root)
    gold_before = gold.release()
    products = product_dim_scan(spark, products_path)
    latest = dedup_latest(silver_scan(spark, silver_path, start, end))

    def kept(frame: DataFrame, name: str) -> DataFrame:
        """Written as the tasks hold it: no one reads work tables by date."""
        frame.write.parquet(f"{work}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{work}/{name}")

    # Silver is deduplicated and written once, with amounts as they came, and everything after
    # reads the columns it needs from there; the warehouse table rounds amounts to cents. Its rows and
    # those of the marts are held against their contracts while they are written.
    watches = {SILVER_TABLE.name: ContractWatch(latest, SILVER_TABLE)}
    silver = kept(watches[SILVER_TABLE.name].watched, "silver")
    rollup = kept(session_rollup(silver), "session_rollup")
    marts = {
        DAILY_KPIS_TABLE.name: daily_kpis_from_rollup(rollup, silver),
        CONVERSION_FUNNEL_TABLE.name: conversion_funnel_from_rollup(rollup),
        SESSION_METRICS_TABLE.name: session_metrics_from_rollup(rollup),
        PRODUCT_METRICS_TABLE.name: product_daily_metrics(silver, products),
    }
    watches |= {contract.name: ContractWatch(marts[contract.name], contract) for contract in MART_TABLES}
    written = together([partial(kept, watches[name].watched, f"mart-{name}") for name in marts])
    marts = dict(zip(marts, written))
    frames = {SILVER_TABLE.name: silver, **marts}
    repeated = together([partial(watch.repeated, frames[name]) for name, watch in watches.items()])
    breaches = [row for watch, more in zip(watches.values(), repeated) for row in watch.breaches(more)]
    refuse_breaches(breaches, accepted_breaches)

    # All files are written first; then one step makes the marts of Gold count, and one those of a namespace.
    jobs = [partial(gold.stage, mart, name, start=start, end=end) for name, mart in marts.items()]
    if load_warehouse:
        warehouse_namespaces(spark, warehouse)
        before = {space: namespace_release(spark, space) for space in (warehouse.staging, warehouse.analytics)}
        jobs.append(partial(stage_table, silver, warehouse.staging, SILVER_TABLE, start=start, end=end))
        jobs += [partial(stage_table, marts[c.name], warehouse.analytics, c, start=start, end=end) for c in MART_TABLES]
    files = together(jobs)
    gold_now = gold.publish(files[: len(marts)], gold_before)
    checked = {name: gold.read(name, release=gold_now) for name in marts}
    staged = silver
    if load_warehouse:
        tables = files[len(marts) :]
        (name,) = publish_tables(spark, warehouse.staging, [(tables[0], SILVER_TABLE)], before[warehouse.staging])
        staged = spark.table(name)
        loaded = list(zip(tables[1:], MART_TABLES))
        names = publish_tables(spark, warehouse.analytics, loaded, before[warehouse.analytics])
        checked = {contract.name: spark.table(name) for contract, name in zip(MART_TABLES, names)}
    if jdbc:
        copy_to_database(staged, checked, warehouse, jdbc)
    verdicts = run_checks(
        staged, checked[DAILY_KPIS_TABLE.name], checked[PRODUCT_METRICS_TABLE.name]
    )
    verdicts = enforce(verdicts)
    # The verdicts outlive the work tables they were counted from.
    return spark.createDataFrame(verdicts.collect(), verdicts.schema)


def refuse_breaches(found: list[tuple[str, str, int]], accepted: tuple[str, ...] = ()) -> None:
    """Raise if a table's contract is broken by a rule that is not accepted; log all breaches."""
    found = [breach for breach in found if breach[2]]
    for breach in found:
        log.warning("%s: %s, %d rows", *breach)
    refused = [f"{table} {rule} ({count})" for table, rule, count in found if rule not in accepted]
    if refused:
        raise ValueError("contract breaches: " + "; ".join(refused))


def copy_to_database(
    silver: DataFrame, marts: dict[str, DataFrame], warehouse: Warehouse, target: JdbcTarget
) -> None:
    """Copy Silver and the marts, as already written, to the database."""
    copies = [(silver, warehouse.staging, SILVER_TABLE)]
    copies += [(marts[table.name], warehouse.analytics, table) for table in MART_TABLES]
    for frame, namespace, contract in copies:
        options = jdbc_options(
            target.url,
            f"{namespace}.{contract.name}",
            target.user,
            target.password,
            target.driver,
            target.connections,
        )
        jdbc_write(frame, contract, options)
