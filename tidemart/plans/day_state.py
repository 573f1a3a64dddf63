"""Daily KPIs that new rows change without a rescan of their days: exact distinct counts as bitmaps that merge.

Users, sessions and orders get numbers for good (``IdNumbers``). A day's state has, per kind of id and stretch of
32,768 numbers, a bitmap of those that occur on it, and its sums of events and revenue. Late rows make a small state of their own;
the states of their days are joined to it by OR and sum, and only these days are released again. Counting
bits gives what ``count(DISTINCT)`` over all rows gives.

Rows must be new: a state cannot take back what it has counted. A stream that knows its ids for good
(``streaming.one_query``) gives such rows, each event once, in Silver and Late; where the latest of several versions
of an event is to count instead, rebuild the day.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.functions.columns import EXACT_AMOUNT, as_money, is_purchase, purchase_amount
from tidemart.schema import DAILY_KPIS_TABLE
from tidemart.session import scratch_dir
from tidemart.sinks.files import Files
from tidemart.sinks.releases import Releases, split_path

# The ids that a day counts: kind -> the kind whose numbers it has, its column, and whether only purchases count.
KINDS = {
    "user": ("user", "user_id", False),
    "session": ("session", "session_id", False),
    "order": ("order", "order_id", True),
    "buyer": ("user", "user_id", True),
}
SUMS = "sums"
PART = "part"


class IdNumbers:
    """Numbers of ids under ``path``, in parts of files that are only ever added.

    An id's number is its hash bucket and its place among the bucket's ids, so that numbers are given in
    ``buckets`` tasks and stay dense. ``buckets`` is fixed at the first start.
    """

    SCHEMA = "kind string, id string, number bigint, part bigint"

    def __init__(self, spark: SparkSession, path: str, buckets: int = 256):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.files = Files(spark, path)

    def before(self, part: int) -> DataFrame:
        """``(kind, id, number)`` of the parts before this one."""
        if not self.files.exists(self.path):
            return self.spark.createDataFrame([], self.SCHEMA).drop(PART)
        return self.spark.read.schema(self.SCHEMA).parquet(self.path).where(F.col(PART) < part).drop(PART)

    def add(self, ids: DataFrame, part: int) -> DataFrame:
        """Number the ids ``(kind, id)`` that have none, as this part, in place of what it had; all numbers up to it."""
        known = self.before(part)
        new = ids.join(known, ["kind", "id"], "left_anti").distinct()
        bucket = F.pmod(F.xxhash64("kind", "id"), F.lit(self.buckets))
        taken = known.groupBy("kind", F.pmod("number", F.lit(self.buckets)).alias("bucket")).agg(F.count("*").alias("taken"))
        here = Window.partitionBy("kind", "bucket").orderBy("id")
        new = new.withColumn("bucket", bucket).withColumn("place", F.row_number().over(here) - 1)
        new = new.join(taken, ["kind", "bucket"], "left")
        number = (F.col("place") + F.coalesce("taken", F.lit(0))) * self.buckets + F.col("bucket")
        folder = f"{self.path}/{PART}={part}"
        new.select("kind", "id", number.alias("number")).write.mode("overwrite").parquet(folder)
        return self.before(part + 1)


def _ids(rows: DataFrame, kind: str) -> DataFrame:
    """``(event_date, kind, id)`` of the days' distinct ids of a kind."""
    _, column, purchases = KINDS[kind]
    counted = rows.where(is_purchase()) if purchases else rows
    counted = counted.where(F.col(column).isNotNull())
    return counted.select("event_date", F.lit(kind).alias("kind"), F.col(column).alias("id")).distinct()


def state_of(rows: DataFrame, numbers: DataFrame) -> DataFrame:
    """``(event_date, kind, stretch, bits, events, revenue)`` of Silver rows."""
    amounts = rows.groupBy("event_date").agg(F.count("*").alias("events"), F.sum(purchase_amount()).alias("revenue"))
    sums = amounts.select(
        "event_date", F.lit(SUMS).alias("kind"), F.lit(0).cast("bigint").alias("stretch"),
        F.lit(None).cast("binary").alias("bits"), "events", "revenue",
    )
    states = [sums]
    for kind, (named, _, _) in KINDS.items():
        found = _ids(rows, kind).join(numbers.where(F.col("kind") == named).drop("kind"), "id")
        found = found.groupBy("event_date", "kind", F.bitmap_bucket_number("number").alias("stretch"))
        bits = found.agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))
        states.append(
            bits.select("*", F.lit(0).cast("bigint").alias("events"), F.lit(0).cast(EXACT_AMOUNT).alias("revenue"))
        )
    return reduce(DataFrame.unionByName, states)


def merged(states: DataFrame) -> DataFrame:
    """One state of several of the same days."""
    return states.groupBy("event_date", "kind", "stretch").agg(
        F.bitmap_or_agg(F.coalesce("bits", F.lit(bytearray(0)))).alias("bits"),
        F.sum("events").alias("events"),
        F.sum("revenue").cast("decimal(38,6)").alias("revenue"),
    )


def kpis_of(state: DataFrame) -> DataFrame:
    """The KPI row of each day, as ``daily_kpis`` gives it."""

    def ids(kind: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.bitmap_count("bits"))), F.lit(0)).cast("bigint")

    return state.groupBy("event_date").agg(
        ids("user").alias("daily_active_users"),
        F.sum("events").cast("bigint").alias("total_events"),
        ids("session").alias("total_sessions"),
        ids("order").alias("total_orders"),
        as_money(F.sum("revenue")).alias("total_revenue"),
        ids("buyer").alias("purchase_users"),
    ).select(*DAILY_KPIS_TABLE.column_names)


class DayState:
    """The released states of all days at ``path``, with the numbers of their ids in a folder of their own."""

    def __init__(self, spark: SparkSession, path: str, numbers: str, buckets: int = 256):
        root, self.name = split_path(path)
        self.spark, self.releases = spark, Releases(spark, root)
        self.numbers = IdNumbers(spark, numbers, buckets)

    def add(self, rows: DataFrame) -> None:
        """Count new Silver rows in; only the days that they fall on are written.

        A run that fails leaves the state as it was; the numbers it gave are given again.
        """
        before = self.releases.release()
        known = self.name in before.datasets
        part = before.datasets[self.name]["note"]["parts"] if known else 0
        asked = reduce(
            DataFrame.union, [_ids(rows, kind).select(F.lit(named).alias("kind"), "id") for kind, (named, _, _) in KINDS.items()]
        )
        numbers = self.numbers.add(asked.distinct(), part)
        work = scratch_dir(self.spark, "day-state")
        try:
            merged(state_of(rows, numbers)).write.parquet(work)
            fresh = self.spark.read.parquet(work)
            # One row for each touched day.
            days = {str(row[0]) for row in fresh.select("event_date").distinct().collect()}
            if known:
                fresh = merged(self.releases.read(self.name, release=before, days=days).unionByName(fresh))
            staged = self.releases.stage(fresh, self.name, only_dates=True, note={"parts": part + 1})
            self.releases.publish([staged], before)
        finally:
            Files(self.spark, work).delete(work)

    def kpis(self) -> DataFrame:
        return kpis_of(self.releases.read(self.name))
