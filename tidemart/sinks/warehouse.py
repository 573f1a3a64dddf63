"""Warehouse tables in the Spark catalog, and a copy to a JDBC database."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tidemart.operators.conform import conform
from tidemart.schema import TableContract
from tidemart.sinks.releases import UNDATED, Release, Releases, Staged


@dataclass(frozen=True)
class Warehouse:
    """Namespace names, and the folder for their tables (the catalog's default when unset)."""

    staging: str = "staging"
    analytics: str = "analytics"
    location: str | None = None


def warehouse_namespaces(spark: SparkSession, warehouse: Warehouse) -> None:
    """Create both namespaces where absent."""
    for name in (warehouse.staging, warehouse.analytics):
        place = f" LOCATION '{warehouse.location}/{name}'" if warehouse.location else ""
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name}{place}")


def _releases(spark: SparkSession, namespace: str) -> Releases:
    return Releases(spark, spark.catalog.getDatabase(namespace).locationUri)


def namespace_release(spark: SparkSession, namespace: str) -> Release:
    """What a namespace's tables are at present."""
    return _releases(spark, namespace).release()


def stage_table(
    frame: DataFrame,
    namespace: str,
    contract: TableContract,
    only_dates: bool = False,
    start: date | None = None,
    end: date | None = None,
) -> Staged:
    """Write a contract table's next rows in its types; nobody sees them before ``publish_tables``."""
    rows = conform(frame, contract)
    staged = _releases(frame.sparkSession, namespace).stage(rows, contract.name, only_dates, start, end)
    if UNDATED in staged.days:
        raise ValueError(f"{namespace}.{contract.name}: rows without event_date")
    return staged


def publish_tables(
    spark: SparkSession, namespace: str, tables: list[tuple[Staged, TableContract]], since: Release | None = None
) -> list[str]:
    """Release the staged tables of a namespace together, then point the catalog's names at them.

    A name is a view over a table of the release, whose partitions are the release's folders. Nothing is
    copied or dropped: the view changes in one step, and what came before stays for those who read it. If
    a run ends between two views, each of them shows a whole release, and the next run shows the newest.
    """
    releases = _releases(spark, namespace)
    release = releases.publish([staged for staged, _ in tables], since)
    return [_show(spark, namespace, contract, releases, release) for _, contract in tables]


def _show(spark: SparkSession, namespace: str, contract: TableContract, releases: Releases, release: Release) -> str:
    name, version = f"{namespace}.{contract.name}", f"{contract.name}__v"
    table = f"{namespace}.{version}{release.version}"
    columns = [f"`{column}` {dtype.simpleString()}" for column, dtype in contract.columns if column != "event_date"]
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(columns)}, event_date date) USING parquet"
        f" PARTITIONED BY (event_date) LOCATION '{releases.root}/{contract.name}'"
    )
    folders = releases.folders(contract.name, release)
    if folders:
        parts = " ".join(f"PARTITION (event_date = DATE '{day}') LOCATION '{path}'" for day, path in folders.items())
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {', '.join(contract.column_names)} FROM {table}")
    found = [row.tableName for row in spark.sql(f"SHOW TABLES IN {namespace} LIKE '{version}*'").collect()]
    numbers = sorted(int(other.removeprefix(version)) for other in found if other.removeprefix(version).isdigit())
    for number in numbers[:-2]:
        spark.sql(f"DROP TABLE IF EXISTS {namespace}.{version}{number}")
    return name


def warehouse_write(
    frame: DataFrame,
    namespace: str,
    contract: TableContract,
    only_dates: bool = False,
    start: date | None = None,
    end: date | None = None,
) -> str:
    """Replace a contract table, with ``only_dates`` the dates in the frame, or with ``start`` or
    ``end`` that range of dates, in one step; its name."""
    since = namespace_release(frame.sparkSession, namespace)
    staged = stage_table(frame, namespace, contract, only_dates, start, end)
    return publish_tables(frame.sparkSession, namespace, [(staged, contract)], since)[0]


def jdbc_options(
    url: str, table: str, user: str, password: str, driver: str, connections: int | None = None
) -> dict[str, str]:
    """Options of the JDBC copy: keep the table and its keys on overwrite. ``connections`` is the
    caller's bound on connections at a time, which are also the tasks; unset, each partition of the
    frame has its own."""
    bound = {"numPartitions": str(connections)} if connections else {}
    return bound | {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "driver": driver,
        "truncate": "true",
        "batchsize": "10000",
    }


def jdbc_write(frame: DataFrame, contract: TableContract, options: dict[str, str]) -> None:
    """Overwrite a database table with the frame in the contract's columns and types."""
    conform(frame, contract).write.format("jdbc").options(**options).mode("overwrite").save()
