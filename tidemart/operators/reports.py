"""Report queries over the marts: fixed columns, newest day first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.schema import (
    CONVERSION_FUNNEL_TABLE,
    DAILY_KPIS_TABLE,
    PRODUCT_METRICS_TABLE,
)


def report_daily_kpis(daily_kpis: DataFrame) -> DataFrame:
    return daily_kpis.select(*DAILY_KPIS_TABLE.column_names).orderBy(F.desc("event_date"))


def report_conversion_funnel(conversion_funnel: DataFrame) -> DataFrame:
    columns = CONVERSION_FUNNEL_TABLE.column_names
    return conversion_funnel.select(*columns).orderBy(F.desc("event_date"))


def report_session_metrics(session_metrics: DataFrame) -> DataFrame:
    return session_metrics.select(
        "event_date",
        "session_id",
        "user_id",
        "event_count",
        "purchase_count",
        "total_revenue",
        "session_duration_seconds",
    ).orderBy(F.desc("event_date"), F.desc("session_duration_seconds"))


def report_product_daily_metrics(product_daily_metrics: DataFrame) -> DataFrame:
    return product_daily_metrics.select(*PRODUCT_METRICS_TABLE.column_names).orderBy(
        F.desc("event_date"), F.desc("revenue")
    )
