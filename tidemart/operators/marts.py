"""The daily marts and their variants over a raw event stream.

Distinct counts are two-phase: first one row per (day, key) with everything the day needs to know
about that key, then one row per day. Both phases combine before the shuffle, so neither a hot
day nor a hot key lands on one task, and no row is copied once per distinct column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.columns import amount_or_zero, as_money, is_purchase, purchase_amount
from tidemart.operators.dedup import dedup_latest
from tidemart.schema import DAILY_KPIS_TABLE, FUNNEL_STAGES


def _count_if(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def daily_kpis(silver: DataFrame) -> DataFrame:
    """Users, events, sessions, orders, revenue and buyers per day; orders and revenue count
    purchases only.

    One branch per distinct key, each a scan of just its columns (the order branch of just the
    purchases), joined on the day, where every branch is down to one row.
    """
    bought = F.coalesce(is_purchase(), F.lit(False))
    users = (
        silver.groupBy("event_date", "user_id")
        .agg(
            F.count("*").alias("events"),
            F.sum(purchase_amount()).alias("revenue"),
            F.max(bought).alias("buyer"),
        )
        .groupBy("event_date")
        .agg(
            F.count("user_id").alias("daily_active_users"),
            F.sum("events").alias("total_events"),
            as_money(F.sum("revenue")).alias("total_revenue"),
            _count_if(F.col("user_id").isNotNull() & F.col("buyer")).alias("purchase_users"),
        )
    )
    return join_day_counts(
        users, distinct_per_day(silver, "session_id"), orders_per_day(silver)
    )


def distinct_per_day(events: DataFrame, key: str) -> DataFrame:
    """``(event_date, distinct_count)`` of the non-null values of ``key``."""
    return (
        events.filter(F.col(key).isNotNull())
        .select("event_date", key)
        .distinct()
        .groupBy("event_date")
        .agg(F.count("*").alias("distinct_count"))
    )


def orders_per_day(silver: DataFrame) -> DataFrame:
    return distinct_per_day(silver.filter(is_purchase()), "order_id")


def join_day_counts(users: DataFrame, sessions: DataFrame, orders: DataFrame) -> DataFrame:
    """The KPI row of each day from its user totals and its session and order counts."""
    sessions = sessions.toDF("session_day", "total_sessions")
    orders = orders.toDF("order_day", "total_orders")
    return (
        users.join(sessions, F.col("event_date").eqNullSafe(F.col("session_day")), "left")
        .join(orders, F.col("event_date").eqNullSafe(F.col("order_day")), "left")
        .fillna(0, ["total_sessions", "total_orders"])
        .select(*DAILY_KPIS_TABLE.column_names)
    )


def stage_mask() -> Column:
    """One bit per funnel stage; 0 for any other event type."""
    mask = F.lit(0)
    for bit, stage in enumerate(FUNNEL_STAGES):
        mask = F.when(F.col("event_type") == stage, F.lit(1 << bit)).otherwise(mask)
    return mask


def funnel_from_user_days(user_days: DataFrame) -> DataFrame:
    """The funnel from one row per (event_date, user_id) with the stages that user reached."""
    reached = user_days.groupBy("event_date").agg(
        *(
            _count_if(
                F.col("user_id").isNotNull() & (F.col("stages").bitwiseAND(1 << bit) != 0)
            ).alias(f"{stage}_users")
            for bit, stage in enumerate(FUNNEL_STAGES)
        )
    )

    def rate(stage: str) -> Column:
        base = F.col(f"{stage}_users")
        share = F.round(F.col("purchase_users") / base, 4)
        return F.when(base == 0, F.lit(0.0)).otherwise(share)

    return reached.select(
        "*",
        rate("product_view").alias("product_view_to_purchase_rate"),
        rate("add_to_cart").alias("add_to_cart_to_purchase_rate"),
        rate("checkout_start").alias("checkout_to_purchase_rate"),
    )


def conversion_funnel(silver: DataFrame) -> DataFrame:
    """Distinct users per stage and day, and purchase rates; stages are independent of order."""
    return funnel_from_user_days(
        silver.groupBy("event_date", "user_id").agg(F.bit_or(stage_mask()).alias("stages"))
    )


def session_metrics(silver: DataFrame) -> DataFrame:
    """Span, counts and revenue per (day, session, user); revenue is not limited to purchases."""
    grouped = silver.groupBy("event_date", "session_id", "user_id").agg(
        F.min("event_time").alias("session_start_time"),
        F.max("event_time").alias("session_end_time"),
        F.count("*").alias("event_count"),
        _count_if(is_purchase()).alias("purchase_count"),
        as_money(F.sum(amount_or_zero())).alias("total_revenue"),
    )
    return grouped.withColumn("session_duration_seconds", whole_seconds_apart())


def whole_seconds_apart() -> Column:
    """Difference of the two ends, each cut to whole seconds first."""
    return F.unix_timestamp("session_end_time") - F.unix_timestamp("session_start_time")


def product_left_join(events: DataFrame, products: DataFrame) -> DataFrame:
    """Events with their product's attributes; null where the product is not listed.

    No broadcast hint: Spark broadcasts the dimension when its measured size is under the
    threshold and shuffles both sides otherwise.
    """
    return events.join(products, "product_id", "left")


def product_daily_metrics(silver: DataFrame, products: DataFrame) -> DataFrame:
    """Views, carts, purchases and revenue per day and product, with category and price band.

    Events are summed per (day, product) before the join, which then handles one row per product
    and day however hot a product is. Repeated dimension rows count as often as they occur, as
    they would if the join came first.
    """

    def stage_count(stage: str) -> Column:
        return _count_if(F.col("event_type") == stage)

    per_product = silver.groupBy("event_date", "product_id").agg(
        stage_count("product_view").alias("views"),
        stage_count("add_to_cart").alias("add_to_carts"),
        stage_count("purchase").alias("purchases"),
        F.sum(amount_or_zero()).alias("revenue"),
    )
    listed = products.groupBy("product_id", "category", "price_band").agg(
        F.count("*").alias("copies")
    )
    copies = F.coalesce("copies", F.lit(1))
    return product_left_join(per_product, listed).select(
        "event_date",
        "product_id",
        "category",
        "price_band",
        (F.col("views") * copies).alias("views"),
        (F.col("add_to_carts") * copies).alias("add_to_carts"),
        (F.col("purchases") * copies).alias("purchases"),
        as_money(F.col("revenue") * copies).alias("revenue"),
    )


def daily_kpis_from_raw(events: DataFrame) -> DataFrame:
    """Daily KPIs over undeduplicated events: orders and revenue of any event type, no buyers.

    Events are rolled up to one row per (day, session, user, order), and the distinct counts are three
    branches over that. The branches ask the same of the rollup, so Spark parses, deduplicates and
    shuffles the events for one of them and the others read its exchange.
    """
    rollup = (
        dedup_latest(events)
        .select(
            F.to_date("event_time").alias("event_date"),
            "session_id",
            "user_id",
            F.when(F.col("order_id") != "", F.col("order_id")).alias("order_id"),
            amount_or_zero().alias("amount"),
        )
        .groupBy("event_date", "session_id", "user_id", "order_id")
        .agg(F.count("*").alias("events"), F.sum("amount").alias("amount"))
        # Always true; a branch that left the sums out would need an exchange of its own.
        .filter((F.col("events") > 0) & F.col("amount").isNotNull())
    )
    users = (
        rollup.groupBy("event_date", "user_id")
        .agg(F.sum("events").alias("events"), F.sum("amount").alias("amount"))
        .groupBy("event_date")
        .agg(
            F.count("user_id").alias("daily_active_users"),
            F.sum("events").alias("total_events"),
            as_money(F.sum("amount")).alias("total_revenue"),
        )
    )
    counted = join_day_counts(
        users.withColumn("purchase_users", F.lit(0)),
        distinct_per_day(rollup, "session_id"),
        distinct_per_day(rollup, "order_id"),
    )
    return counted.drop("purchase_users").orderBy("event_date")


def session_metrics_from_raw(events: DataFrame) -> DataFrame:
    """Session metrics over undeduplicated events, one row per session across midnight.

    User and date come from the earliest event (lowest user id among equals). Events are first
    summed per (session, user) with fixed-width buffers, which hash; only those few rows go
    through the comparison of (time, user) structs, which sorts.
    """
    latest = dedup_latest(events)
    per_user = latest.groupBy("session_id", "user_id").agg(
        F.min("event_time").alias("first_time"),
        F.max("event_time").alias("last_time"),
        F.count("*").alias("event_count"),
        _count_if(is_purchase()).alias("purchase_count"),
        F.sum(amount_or_zero()).alias("revenue"),
    )
    return (
        per_user.groupBy("session_id")
        .agg(
            F.min(F.struct("first_time", "user_id")).alias("first"),
            F.max("last_time").alias("last_time"),
            F.sum("event_count").alias("event_count"),
            F.sum("purchase_count").alias("purchase_count"),
            as_money(F.sum("revenue")).alias("total_revenue"),
        )
        .select(
            "session_id",
            F.col("first.user_id").alias("user_id"),
            F.to_date("first.first_time").alias("event_date"),
            F.timestamp_diff("SECOND", F.col("first.first_time"), F.col("last_time")).alias(
                "session_duration_seconds"
            ),
            "event_count",
            "purchase_count",
            "total_revenue",
        )
        .orderBy("event_date", "session_id")
    )
