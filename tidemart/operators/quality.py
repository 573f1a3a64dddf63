"""The data quality report over raw payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.operators.validate import judged_payloads


def data_quality_report(bronze: DataFrame) -> DataFrame:
    """One row: total, valid, invalid, repeated ids, bad types and missing fields.

    The last two count errors, not rows, by the error's wording, so a missing event type is in
    both. An id that is not JSON text takes no part in the duplicate count.
    """
    errors = F.col("validation_errors")
    judged = judged_payloads(bronze).select(
        F.col("text_event_id").alias("id"),
        (F.size(errors) > 0).alias("bad"),
        F.size(F.filter(errors, lambda e: e.startswith("event_type"))).alias("bad_types"),
        F.size(F.filter(errors, lambda e: e.endswith("is required"))).alias("missing"),
    )
    return judged.agg(
        F.count("*").alias("total_events"),
        F.count(F.when(~F.col("bad"), 1)).alias("valid_events"),
        F.count(F.when(F.col("bad"), 1)).alias("invalid_events"),
        (F.count("id") - F.countDistinct("id")).alias("duplicate_event_ids"),
        F.coalesce(F.sum("bad_types"), F.lit(0)).alias("invalid_event_types"),
        F.coalesce(F.sum("missing"), F.lit(0)).alias("missing_required_fields"),
    )
