"""All layers from one stream query: the topic is read once and every record is judged once.

Each micro-batch goes through these steps, and each step can be run again:

1. Bronze: the records, written from the topic.
2. The batch's Bronze files are read back and judged; the verdicts are a work table.
3. Quarantine: rows with errors.
4. Silver: valid rows whose id no earlier batch had, the latest one per id, unless they are late.
5. Late: the same for rows behind the watermark that the earlier batches had reached.
6. The ids of both are added to the index of known ids.
7. Progress: the watermark and the counts of each layer, a file per batch beside the checkpoint.

All of them write in folders that carry the batch's number. Spark runs a batch that was cut off again, with the same
records and number: it then replaces what it wrote, so no layer has a row twice, wherever the cut was. Ids stay
known for good: Silver and Late together have every id once, as a rebuild from Bronze has.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemart.operators.dedup import dedup_latest
from tidemart.operators.ingest import bronze_projection
from tidemart.operators.validate import RULE_SETS, route_quarantine, route_valid
from tidemart.schema import BRONZE_SCHEMA, SILVER_SCHEMA
from tidemart.sinks.files import Files
from tidemart.sinks.lake import STREAM_BATCH, LakePaths, write_batch
from tidemart.streaming.id_index import IdIndex
from tidemart.streaming.lakehouse import watermark_minutes

LAYER = "lakehouse"
COUNTS = ("records", "quarantine", "silver", "late", "repeated")
FOLD_EVERY = 50
TASK_BYTES = "16m"


def _progress_folder(paths: LakePaths) -> str:
    return f"{paths.checkpoint(LAYER)}/progress"


def batch_progress(spark: SparkSession, paths: LakePaths) -> list[dict]:
    """What each batch has counted, and the watermark that it has reached (UTC microseconds), in order."""
    files = Files(spark, paths.root)
    folder = _progress_folder(paths)
    names = [name for name in files.names(folder) if name.endswith(".json") and name[0] != "."]
    return [json.loads(files.read_text(f"{folder}/{name}")) for name in names]


def stream_counts(spark: SparkSession, paths: LakePaths) -> dict[str, int]:
    """Rows per layer since the stream's first start, over all restarts."""
    batches = batch_progress(spark, paths)
    return {name: sum(batch[name] for batch in batches) for name in COUNTS}


def late_rows(spark: SparkSession, paths: LakePaths) -> DataFrame:
    """Valid rows that came behind the watermark, one per id."""
    return spark.read.schema(_stored(SILVER_SCHEMA)).parquet(paths.late).drop(STREAM_BATCH)


def _stored(schema: T.StructType) -> T.StructType:
    """A layer's schema with the batch number; with it, a layer without rows can be read too."""
    return T.StructType([*schema.fields, T.StructField(STREAM_BATCH, T.LongType())])


class BatchWriter:
    """The steps of a micro-batch; ``after`` is called with each step's name when it is done."""

    def __init__(self, spark: SparkSession, paths: LakePaths, rules: str, minutes: int, buckets: int = 64, after=None):
        self.paths, self.rules, self.minutes = paths, rules, minutes
        self.index = IdIndex(spark, paths.known_ids, buckets)
        self.after = after or (lambda step: None)

    def _progress_file(self, batch: int) -> str:
        return f"{_progress_folder(self.paths)}/{batch:012d}.json"

    def reached(self, spark: SparkSession, batch: int) -> int | None:
        """The watermark when this batch began."""
        files = Files(spark, self.paths.root)
        before = self._progress_file(batch - 1)
        return json.loads(files.read_text(before))["watermark"] if batch and files.exists(before) else None

    def __call__(self, records: DataFrame, batch: int) -> None:
        spark, paths = records.sparkSession, self.paths
        work = f"{paths.root}/work/{LAYER}-batch-{batch:012d}"
        # In the query's own session: judging is slow for its bytes, so tasks of the usual size would end far apart.
        spark.conf.set("spark.sql.files.maxPartitionBytes", TASK_BYTES)
        write_batch(bronze_projection(records), paths.bronze, batch)
        self.after("bronze")

        bronze = spark.read.schema(_stored(BRONZE_SCHEMA)).parquet(paths.bronze)
        judged = RULE_SETS[self.rules](bronze.where(F.col(STREAM_BATCH) == batch).drop(STREAM_BATCH))
        # Of the rows that are read from here on, only Quarantine's show their payload.
        invalid = F.size("validation_errors") > 0
        judged = judged.withColumn("raw_payload", F.when(invalid, F.col("raw_payload")))
        judged.write.mode("overwrite").parquet(f"{work}/judged")
        judged = spark.read.schema(judged.schema).parquet(f"{work}/judged")
        self.after("judged")

        write_batch(route_quarantine(judged), paths.quarantine, batch)
        self.after("quarantine")

        reached = self.reached(spark, batch)
        valid = route_valid(judged, keep=("partition", "offset"))
        late = F.lit(False) if reached is None else F.unix_micros("event_time") <= reached
        first = dedup_latest(valid).drop("partition", "offset").withColumn("late", late)
        new = self.index.split(first, batch, asked=valid).where("not known").drop("known")
        new.write.mode("overwrite").parquet(f"{work}/valid")
        new = spark.read.schema(new.schema).parquet(f"{work}/valid")
        write_batch(new.where("not late").drop("late"), paths.stream_silver, batch)
        self.after("silver")
        write_batch(new.where("late").drop("late"), paths.late, batch)
        self.after("late")
        self.index.add(new, batch)
        self.after("ids")

        self._note(spark, batch, judged, new, reached)
        self.after("progress")
        if batch and batch % FOLD_EVERY == 0:
            self.index.fold(batch)
        Files(spark, paths.root).delete(work)

    def _note(self, spark: SparkSession, batch: int, judged: DataFrame, new: DataFrame, reached: int | None) -> None:
        valid = F.size("validation_errors") == 0
        # To whole milliseconds, as Spark's own watermarks are.
        newest = F.unix_millis(F.max(F.when(valid, F.col("event_time")))) * 1000
        records, accepted, newest = judged.agg(F.count("*"), F.count_if(valid), newest).first()
        silver, behind = new.agg(F.count_if(~F.col("late")), F.count_if("late")).first()
        marks = [mark for mark in (reached, None if newest is None else newest - self.minutes * 60_000_000) if mark is not None]
        noted = {
            "batch": batch,
            "watermark": max(marks, default=None),
            "records": records,
            "quarantine": records - accepted,
            "silver": silver,
            "late": behind,
            "repeated": accepted - silver - behind,
        }
        Files(spark, self.paths.root).write_text(self._progress_file(batch), json.dumps(noted), replace=True)


def start_lakehouse_once(
    records: DataFrame,
    paths: LakePaths,
    trigger: dict,
    rules: str = "contract",
    minutes: int | None = None,
    buckets: int = 64,
    after=None,
) -> StreamingQuery:
    """Start the one query that feeds all layers. ``buckets`` is fixed at the first start."""
    lateness = watermark_minutes() if minutes is None else minutes
    writer = BatchWriter(records.sparkSession, paths, rules, lateness, buckets, after)
    return (
        records.writeStream.foreachBatch(writer)
        .option("checkpointLocation", f"{paths.checkpoint(LAYER)}/query")
        .queryName("write_lakehouse_user_events")
        .trigger(**trigger)
        .start()
    )
