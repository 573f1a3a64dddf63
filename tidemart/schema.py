"""Event schema, enum and the column contracts of the warehouse tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The event fields and their types, in payload order.
EVENT_FIELDS = (
    ("event_id", T.StringType()),
    ("user_id", T.StringType()),
    ("session_id", T.StringType()),
    ("event_type", T.StringType()),
    ("event_time", T.TimestampType()),
    ("ingest_time", T.TimestampType()),
    ("product_id", T.StringType()),
    ("order_id", T.StringType()),
    ("order_amount", T.DoubleType()),
    ("device_type", T.StringType()),
    ("traffic_source", T.StringType()),
    ("country_code", T.StringType()),
    ("schema_version", T.IntegerType()),
)
OPTIONAL_FIELDS = ("order_id", "order_amount")
TIME_FIELDS = ("event_time", "ingest_time")

# The event type enum, in funnel order.
FUNNEL_STAGES = ("home_view", "product_view", "add_to_cart", "checkout_start", "purchase")
PURCHASE = "purchase"

FIELD_NAMES = tuple(name for name, _ in EVENT_FIELDS)
REQUIRED_FIELDS = tuple(name for name in FIELD_NAMES if name not in OPTIONAL_FIELDS)
EVENT_SCHEMA = T.StructType([T.StructField(name, dtype) for name, dtype in EVENT_FIELDS])

# A topic record as the Kafka source delivers it.
TOPIC_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

BRONZE_SCHEMA = T.StructType(
    [
        T.StructField("kafka_key", T.StringType()),
        T.StructField("raw_payload", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("kafka_timestamp", T.TimestampType()),
        T.StructField("stream_ingest_time", T.TimestampType()),
        T.StructField("event_date", T.DateType()),
    ]
)

# Silver as the streams and the rebuild write it.
SILVER_SCHEMA = T.StructType(
    [
        *EVENT_SCHEMA.fields,
        T.StructField("stream_ingest_time", T.TimestampType()),
        T.StructField("event_date", T.DateType()),
    ]
)

PRODUCT_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("product_id", "category", "price_band")]
)

MONEY = T.DecimalType(12, 2)
RATE = T.DecimalType(10, 4)


@dataclass(frozen=True)
class TableContract:
    """What a warehouse table promises: typed columns, nullability and a unique key."""

    name: str
    columns: tuple[tuple[str, T.DataType], ...]
    key: tuple[str, ...]
    nullable: tuple[str, ...] = ()

    @property
    def column_names(self) -> list[str]:
        return [name for name, _ in self.columns]


def _ints(*names: str) -> tuple[tuple[str, T.DataType], ...]:
    return tuple((name, T.IntegerType()) for name in names)


# Names, columns, types and keys of the warehouse tables.
SILVER_TABLE = TableContract(
    name="user_events_silver",
    columns=tuple(
        (name, MONEY if name == "order_amount" else dtype) for name, dtype in EVENT_FIELDS
    )
    + (("event_date", T.DateType()),),
    key=("event_id",),
    nullable=OPTIONAL_FIELDS,
)
DAILY_KPIS_TABLE = TableContract(
    name="daily_kpis",
    columns=(("event_date", T.DateType()),)
    + _ints("daily_active_users", "total_events", "total_sessions", "total_orders")
    + (("total_revenue", MONEY),)
    + _ints("purchase_users"),
    key=("event_date",),
)
CONVERSION_FUNNEL_TABLE = TableContract(
    name="conversion_funnel",
    columns=(("event_date", T.DateType()),)
    + _ints(*(f"{stage}_users" for stage in FUNNEL_STAGES))
    + (
        ("product_view_to_purchase_rate", RATE),
        ("add_to_cart_to_purchase_rate", RATE),
        ("checkout_to_purchase_rate", RATE),
    ),
    key=("event_date",),
)
SESSION_METRICS_TABLE = TableContract(
    name="session_metrics",
    columns=(
        ("event_date", T.DateType()),
        ("session_id", T.StringType()),
        ("user_id", T.StringType()),
        ("session_start_time", T.TimestampType()),
        ("session_end_time", T.TimestampType()),
    )
    + _ints("event_count", "purchase_count")
    + (("total_revenue", MONEY),)
    + _ints("session_duration_seconds"),
    key=("event_date", "session_id"),
)
PRODUCT_METRICS_TABLE = TableContract(
    name="product_daily_metrics",
    columns=(
        ("event_date", T.DateType()),
        ("product_id", T.StringType()),
        ("category", T.StringType()),
        ("price_band", T.StringType()),
    )
    + _ints("views", "add_to_carts", "purchases")
    + (("revenue", MONEY),),
    key=("event_date", "product_id"),
    nullable=("category", "price_band"),
)
MART_TABLES = (
    DAILY_KPIS_TABLE,
    CONVERSION_FUNNEL_TABLE,
    SESSION_METRICS_TABLE,
    PRODUCT_METRICS_TABLE,
)
