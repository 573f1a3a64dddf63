"""Event-shaped views of the star-schema test tables (``events``, ``part``).

``events_as_silver`` is the clean stream; ``raw_topic_feed`` is the same stream as topic records
with a known share of every fault the validators must find, plus redeliveries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.schema import FIELD_NAMES, PURCHASE, TOPIC_SCHEMA

TOPIC = "user_events_v1"
TOPIC_PARTITIONS = 3
REDELIVERY_OFFSET = 1_000_000_000_000

# How the test table's event types map onto the funnel.
STAGE_OF = {
    "signup": "home_view",
    "view": "product_view",
    "click": "add_to_cart",
    "error": "checkout_start",
    "purchase": "purchase",
}
DEVICES = ("mobile", "desktop", "tablet")
CHANNELS = ("organic", "paid_search", "email", "social")
COUNTRIES = ("US", "IN", "GB", "DE", "SG")
# Listed products start at this number, so the lower ones find no match in the dimension.
FIRST_LISTED_PRODUCT = 10


def _pick(values: tuple[str, ...]) -> Column:
    options = F.array(*(F.lit(value) for value in values))
    return F.get(options, (F.col("n") % len(values)).cast("int"))


def _numbered(prefix: str, column: Column) -> Column:
    return F.concat(F.lit(prefix), column.cast("string"))


def _numbered_silver(spark: SparkSession, sf_dir: str, delays: Column | None = None) -> DataFrame:
    """Silver rows plus the source's row number ``n`` and amount ``value``; with ``delays``, an array made from
    ``n``, one row per ``delay`` in it. Rows are multiplied first, so that a filter on ``delay`` comes before the texts.
    """
    stages = F.create_map(*(F.lit(item) for pair in STAGE_OF.items() for item in pair))
    base = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("event_id").alias("n"),
        F.col("ts").cast("timestamp").alias("event_time"),
        "user_id",
        "value",
        F.get_json_object("props", "$.k").alias("k"),
        F.element_at(stages, F.col("event_type")).alias("event_type"),
    )
    if delays is not None:
        base = base.withColumn("delay", F.explode(delays))
    purchase = F.col("event_type") == PURCHASE
    noon_day = F.date_format(F.col("event_time") - F.expr("INTERVAL 12 HOURS"), "yyyyMMdd")
    return base.select(
        _numbered("evt-", F.col("n")).alias("event_id"),
        _numbered("user-", F.col("user_id")).alias("user_id"),
        F.concat_ws("-", F.lit("session"), "user_id", noon_day).alias("session_id"),
        "event_type",
        "event_time",
        (F.col("event_time") + F.expr("INTERVAL 1 SECOND")).alias("ingest_time"),
        _numbered("sku-", F.col("k")).alias("product_id"),
        F.when(purchase, _numbered("order-", F.expr("n div 2"))).alias("order_id"),
        F.when(purchase | (F.col("n") % 50 == 0), F.col("value")).alias("order_amount"),
        _pick(DEVICES).alias("device_type"),
        _pick(CHANNELS).alias("traffic_source"),
        _pick(COUNTRIES).alias("country_code"),
        F.lit(1).alias("schema_version"),
        F.to_date("event_time").alias("event_date"),
        "n",
        "value",
        *([] if delays is None else ["delay"]),
    )


def events_as_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table in the Silver schema (no ``stream_ingest_time``)."""
    return _numbered_silver(spark, sf_dir).drop("n", "value")


def parts_as_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``part`` table as the product dimension."""
    size = F.col("p_size")
    return spark.read.parquet(f"{sf_dir}/part.parquet").select(
        _numbered("sku-", F.col("p_partkey") + FIRST_LISTED_PRODUCT).alias("product_id"),
        F.lower("p_type").alias("category"),
        F.when(size <= 15, "low").when(size <= 35, "medium").otherwise("high").alias("price_band"),
    )


def _quoted(column: Column) -> Column:
    # The adapter's texts hold nothing that needs escaping.
    return F.concat(F.lit('"'), column, F.lit('"'))


def _iso(column: Column) -> Column:
    return F.concat(F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def raw_topic_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic records for every event, with faults by ``event_id % 100`` and redeliveries."""
    residue = F.col("n") % 100

    def fault(*residues: int) -> Column:
        return residue.isin(*residues)

    delays = F.when(fault(10, 11, 12), F.array(F.lit(0), F.lit(5))).otherwise(F.array(F.lit(0)))
    sent = _numbered_silver(spark, sf_dir, delays)
    sent = sent.withColumn(
        "ingest_time", F.col("ingest_time") + F.make_interval(secs=F.col("delay"))
    )

    order_text = _quoted(_numbered("order-", F.expr("n div 2")))
    amount_text = F.col("value").cast("string")
    fragment = {name: _quoted(F.col(name)) for name in FIELD_NAMES}
    fragment["user_id"] = F.when(~fault(1), fragment["user_id"])
    fragment["event_type"] = (
        F.when(fault(2), F.lit('"signup_bonus"'))
        .when(fault(6, 7, 8, 14), F.lit('"purchase"'))
        .otherwise(fragment["event_type"])
    )
    fragment["event_time"] = F.when(fault(3), F.lit('"not-a-time"')).otherwise(
        _quoted(_iso(F.col("event_time")))
    )
    fragment["ingest_time"] = F.when(~fault(9), _quoted(_iso(F.col("ingest_time"))))
    fragment["order_id"] = (
        F.when(fault(6), F.lit(None))
        .when(fault(7, 8), order_text)
        .when(fault(14), F.lit('""'))
        .otherwise(fragment["order_id"])
    )
    fragment["order_amount"] = (
        F.when(fault(6, 14), amount_text)
        .when(fault(7), F.lit("0"))
        .when(fault(8), F.lit('"abc"'))
        .otherwise(F.col("order_amount").cast("string"))
    )
    fragment["device_type"] = F.when(fault(5), F.lit('"   "')).otherwise(fragment["device_type"])
    fragment["schema_version"] = (
        F.when(fault(4), F.lit("0")).when(fault(15), F.lit('"1"')).otherwise(F.lit("1"))
    )
    members = [
        F.concat(F.lit(f'"{name}":'), F.coalesce(text, F.lit("null")))
        for name, text in fragment.items()
    ]
    members[0] = F.when(~fault(13), members[0])
    payload = F.when(fault(0), F.lit('{"event_id": "evt-')).otherwise(
        F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))
    )
    offset = F.expr(f"n div {TOPIC_PARTITIONS}") + F.when(
        F.col("delay") > 0, F.lit(REDELIVERY_OFFSET)
    ).otherwise(F.lit(0))
    return sent.select(
        F.col("event_id").cast("binary").alias("key"),
        payload.cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        (F.col("n") % TOPIC_PARTITIONS).cast("int").alias("partition"),
        offset.cast("long").alias("offset"),
        F.col("ingest_time").alias("timestamp"),
    ).to(TOPIC_SCHEMA)
