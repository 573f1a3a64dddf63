"""Rebuild Silver from Bronze: the batch pass that corrects late and repeated events."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.operators.dedup import dedup_latest
from tidemart.operators.validate import RULE_SETS, route_valid
from tidemart.session import scratch_dir
from tidemart.sinks.files import Files
from tidemart.sinks.lake import STREAM_BATCH
from tidemart.sinks.releases import Release, Releases, published, split_path
from tidemart.sources.lake import bronze_scan

# What Silver's manifest says about the Bronze it was built from.
READ_TO = "bronze_batch"


def rebuilt_silver(bronze: DataFrame, rules: str = "contract") -> DataFrame:
    """Valid events of Bronze, the latest row per id; payloads stay out of the shuffle."""
    if STREAM_BATCH in bronze.columns:
        bronze = bronze.drop(STREAM_BATCH)
    valid = route_valid(RULE_SETS[rules](bronze), keep=("partition", "offset"))
    return dedup_latest(valid).drop("partition", "offset")


def _newest_batch(bronze: DataFrame, after: int = -1) -> int | None:
    """The number of the last micro-batch in Bronze; None where Bronze has no (later) batches."""
    if STREAM_BATCH not in bronze.columns:
        return None
    return bronze.where(F.col(STREAM_BATCH) > after).agg(F.max(STREAM_BATCH)).first()[0]


def rebuild_silver_from_bronze(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    start: date | None = None,
    end: date | None = None,
    bronze_since: date | None = None,
    rules: str = "contract",
) -> None:
    """Write rebuilt Silver, all of it or the event dates from ``start`` to ``end``.

    Bronze is dated by topic time and an event may arrive on any later day, so a partial rebuild
    reads Bronze to its end. ``bronze_since`` lets a caller who knows how far producers' clocks
    run ahead skip older Bronze days; unset, all of Bronze is read and the result is exact. The whole
    range is replaced in one step, so an event that moved to another day of it leaves nothing on its old
    one, and a run that fails leaves Silver as it was.
    """
    bronze = bronze_scan(spark, bronze_path, bronze_since)
    newest = _newest_batch(bronze)
    if newest is not None:
        bronze = bronze.where(F.col(STREAM_BATCH) <= newest)
    silver = rebuilt_silver(bronze, rules)
    if start:
        silver = silver.filter(F.col("event_date") >= F.lit(start))
    if end:
        silver = silver.filter(F.col("event_date") <= F.lit(end))
    whole = not (start or end or bronze_since)
    note = ({} if newest is None else {READ_TO: newest}) if whole else None
    published(silver, silver_path, start=start, end=end, note=note)


def changed_bronze(bronze: DataFrame, after: int, newest: int) -> DataFrame:
    """Bronze of the micro-batches behind ``after``; the batch number is a folder, so the rest is not read."""
    return bronze.where((F.col(STREAM_BATCH) > after) & (F.col(STREAM_BATCH) <= newest))


def rebuild_silver_changes(spark: SparkSession, bronze_path: str, silver_path: str, rules: str = "contract") -> Release:
    """Bring rebuilt Silver up to date with Bronze, reading only what came since; the release that it is now.

    Silver's manifest says which micro-batch of Bronze it was built to. The batches behind that are judged, and their
    event days are touched, together with the days on which Silver has rows of the same ids (one scan of its id
    column). The touched days are merged and released in one step: of an id's old and new row the later one
    by ``ingest_time`` stays, and the new one if they are equal, as a topic that keeps an id's records in
    one partition gives it the higher offset. That is what a whole rebuild gives. A Silver that
    no whole rebuild has noted a batch for is rebuilt as a whole, and so is one over a Bronze without batches.
    """
    root, name = split_path(silver_path)
    releases = Releases(spark, root)
    before = releases.release()
    bronze = bronze_scan(spark, bronze_path)
    read_to = before.datasets.get(name, {"note": {}})["note"].get(READ_TO)
    if read_to is None or STREAM_BATCH not in bronze.columns:
        rebuild_silver_from_bronze(spark, bronze_path, silver_path, rules=rules)
        return releases.release()
    newest = _newest_batch(bronze, read_to)
    if newest is None:
        return before

    work = scratch_dir(spark, "silver-changes")
    try:
        fresh = rebuilt_silver(changed_bronze(bronze, read_to, newest), rules)
        fresh.write.parquet(work)
        fresh = spark.read.schema(fresh.schema).parquet(work)
        silver = releases.read(name, release=before)
        met = silver.join(fresh.select("event_id"), "event_id", "left_semi")
        # One row for each touched day.
        touched = {str(row[0]) for row in fresh.select("event_date").union(met.select("event_date")).distinct().collect()}
        old = releases.read(name, release=before, days=touched).withColumn("fresh", F.lit(0))
        later_first = Window.partitionBy("event_id").orderBy(F.desc("ingest_time"), F.desc("fresh"))
        merged = (
            old.unionByName(fresh.withColumn("fresh", F.lit(1)))
            .withColumn("copy", F.row_number().over(later_first))
            .where("copy = 1")
            .drop("copy", "fresh")
        )
        staged = releases.stage(merged, name, only_dates=True, note={READ_TO: newest})
        return releases.publish([replace(staged, emptied=tuple(sorted(touched)))], before)
    finally:
        Files(spark, work).delete(work)
