"""Topic records out of events: key, value and partition rules, written in batches and as a stream.

Kafka's own writer takes the frame as it is (``write_topic`` with format "kafka"); the file form is the same records landed as
Parquet, with the offsets that a topic would have given, which ``sources.topic`` reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemart.operators.ingest import topic_encode
from tidemart.schema import TOPIC_SCHEMA
from tidemart.sinks.files import Files


def partition_of(key: Column, partitions: int) -> Column:
    """The partition of a key: all records of a key are in one, so they keep their order."""
    return F.pmod(F.xxhash64(key), F.lit(partitions)).cast("int")


def topic_records(events: DataFrame, partitions: int) -> DataFrame:
    """``(key, value, partition)``: events encoded, with their partition. An event without an id raises."""
    encoded = topic_encode(events)
    no_id = F.raise_error(F.lit("an event without event_id has no key")).cast("binary")
    return encoded.select(
        F.when(F.col("key").isNull(), no_id).otherwise(F.col("key")).alias("key"),
        "value",
        partition_of(F.col("key"), partitions).alias("partition"),
    )


def kafka_options(servers: str, topic: str) -> dict[str, str]:
    """Options of Kafka's writer: acknowledged by all replicas, and a retried send is not doubled."""
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.enable.idempotence": "true",
    }


def kafka_write(events: DataFrame, options: dict[str, str], partitions: int) -> None:
    """Write events to a topic (needs the Kafka connector package on the cluster)."""
    topic_records(events, partitions).write.format("kafka").options(**options).save()


def kafka_stream(events: DataFrame, options: dict[str, str], partitions: int, checkpoint: str, trigger: dict) -> StreamingQuery:
    """Write a stream of events to a topic; Kafka gets each at least once."""
    records = topic_records(events, partitions).writeStream.format("kafka").options(**options)
    return records.option("checkpointLocation", checkpoint).trigger(**trigger).start()


class LandedTopic:
    """A topic landed as Parquet files under ``path``: the stand-in for a broker, with its partitions and offsets.

    Batches of records are folders. A batch's offsets go on from those of the batches before it, in
    the order of event time and id, and a batch that is written again replaces itself.
    """

    def __init__(self, path: str, topic: str, partitions: int):
        self.path, self.topic, self.partitions = path.rstrip("/"), topic, partitions

    def write(self, events: DataFrame, batch: int) -> None:
        spark = events.sparkSession
        files = Files(spark, self.path)
        folder = f"{self.path}/batch={batch:012d}"
        records = topic_records(events, self.partitions)
        here = Window.partitionBy("partition").orderBy(F.get_json_object(F.col("value").cast("string"), "$.event_time"), "key", "value")
        records = records.withColumn("nth", F.row_number().over(here))
        before = [name for name in files.names(self.path) if name.startswith("batch=") and name < f"batch={batch:012d}"]
        if before:
            earlier = spark.read.schema(TOPIC_SCHEMA).parquet(*(f"{self.path}/{name}" for name in before))
            taken = earlier.groupBy("partition").agg((F.max("offset") + 1).alias("taken"))
            records = records.join(taken, "partition", "left")
        else:
            records = records.withColumn("taken", F.lit(None).cast("bigint"))
        landed = records.select(
            "key",
            "value",
            F.lit(self.topic).alias("topic"),
            "partition",
            (F.coalesce("taken", F.lit(0)) + F.col("nth") - 1).cast("bigint").alias("offset"),
            F.current_timestamp().alias("timestamp"),
        )
        landed.write.mode("overwrite").parquet(folder)

    def start(self, events: DataFrame, checkpoint: str, trigger: dict) -> StreamingQuery:
        """Write a stream of events, each micro-batch as a batch of its number: exactly once."""
        writer = events.writeStream.foreachBatch(self.write).option("checkpointLocation", checkpoint)
        return writer.trigger(**trigger).start()

    def read(self, spark) -> DataFrame:
        return spark.read.schema(TOPIC_SCHEMA).parquet(f"{self.path}/batch=*")
