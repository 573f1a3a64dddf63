"""Topic streams: the Kafka source, and landed topic files with the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemart.schema import TOPIC_SCHEMA


def topic_options(
    servers: str, topic: str, max_offsets_per_trigger: int | None = None
) -> dict[str, str]:
    """Options of the Kafka source; reads start at the earliest offset."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def topic_source(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """The topic as a stream (needs the Kafka connector package on the cluster)."""
    return spark.readStream.format("kafka").options(**options).load()


def landed_topic_source(
    spark: SparkSession, path: str, files_per_trigger: int | None = None
) -> DataFrame:
    """Topic records landed as Parquet files, as a stream."""
    reader = spark.readStream.schema(TOPIC_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)
