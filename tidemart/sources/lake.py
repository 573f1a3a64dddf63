"""Lake readers: Silver and Bronze tables, the product CSV and JSON array files."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.schema import EVENT_SCHEMA, PRODUCT_SCHEMA
from tidemart.sinks.releases import dataset


def silver_scan(
    spark: SparkSession, path: str, start: date | None = None, end: date | None = None
) -> DataFrame:
    """Silver with ``event_date`` recomputed from ``event_time``, optionally for some days.

    The days are first cut on the stored partition column, one day wider at each end so that a
    partition written under another time zone is still read, then exactly on the recomputed date. Of a
    released dataset only the folders of these days are listed.
    """
    day = timedelta(days=1)
    silver = dataset(spark, path, start - day if start else None, end + day if end else None)
    partitioned = "event_date" in silver.columns
    if partitioned and start:
        silver = silver.filter(F.col("event_date") >= F.date_sub(F.lit(start), 1))
    if partitioned and end:
        silver = silver.filter(F.col("event_date") <= F.date_add(F.lit(end), 1))
    silver = silver.withColumn("event_date", F.to_date("event_time"))
    if start:
        silver = silver.filter(F.col("event_date") >= F.lit(start))
    if end:
        silver = silver.filter(F.col("event_date") <= F.lit(end))
    return silver


def bronze_scan(spark: SparkSession, path: str, since: date | None = None) -> DataFrame:
    """Bronze, optionally from a topic date on (the partition column, so files are pruned)."""
    bronze = spark.read.parquet(path)
    return bronze.filter(F.col("event_date") >= F.lit(since)) if since else bronze


def product_dim_scan(spark: SparkSession, path: str) -> DataFrame:
    """The product dimension from CSV files, its columns found by their header; all are text.

    Other columns are ignored, and a file without one of the dimension's columns raises.
    """
    rows = spark.read.option("header", True).option("inferSchema", False).csv(path)
    absent = [name for name in PRODUCT_SCHEMA.fieldNames() if name not in rows.columns]
    if absent:
        raise ValueError(f"{path} has no column {', '.join(absent)}")
    return rows.select(*PRODUCT_SCHEMA.fieldNames())


def event_json_array_scan(
    spark: SparkSession, path: str, array_per_line: bool = False
) -> DataFrame:
    """Events from files that hold JSON arrays of event objects.

    By default each file is one array, laid out over any number of lines; such a file is read by
    one task. With ``array_per_line`` every line is an array of its own and files can be split.
    """
    reader = spark.read.schema(EVENT_SCHEMA)
    return reader.option("multiLine", not array_per_line).json(path)
