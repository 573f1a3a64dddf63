"""Quality checks: each is a one-row frame ``(check_name, passed, details)``."""

from __future__ import annotations

import logging
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOGGER = logging.getLogger(__name__)


class QualityCheckError(RuntimeError):
    """At least one check did not pass."""


def _verdict(found: DataFrame, name: str, passed: Column, details: str) -> DataFrame:
    """One row from whether ``found`` has any row at all; it is read no further than one."""
    return found.select(F.lit(1).alias("hit")).limit(1).agg(
        F.lit(name).alias("check_name"), passed.alias("passed"), F.lit(details).alias("details")
    )


def _any_row() -> Column:
    return F.count("hit") > 0


def _no_row() -> Column:
    return F.count("hit") == 0


# The names and texts of the checks, and their order, are part of the result.


def check_daily_kpis_not_empty(daily_kpis: DataFrame) -> DataFrame:
    return _verdict(
        daily_kpis,
        "daily_kpis_not_empty",
        _any_row(),
        "analytics.daily_kpis must contain at least one row",
    )


def check_no_duplicate_event_ids(silver: DataFrame) -> DataFrame:
    repeated = silver.groupBy("event_id").count().filter(F.col("count") > 1)
    return _verdict(
        repeated,
        "no_duplicate_event_ids",
        _no_row(),
        "staging.user_events_silver must not contain duplicate event_id values",
    )


def check_non_negative_revenue(daily_kpis: DataFrame) -> DataFrame:
    return _verdict(
        daily_kpis.filter(F.col("total_revenue") < 0),
        "non_negative_revenue",
        _no_row(),
        "analytics.daily_kpis.total_revenue must be non-negative",
    )


def check_product_metrics_not_empty(product_daily_metrics: DataFrame) -> DataFrame:
    return _verdict(
        product_daily_metrics,
        "product_metrics_not_empty",
        _any_row(),
        "analytics.product_daily_metrics must contain at least one row",
    )


def run_checks(
    silver: DataFrame, daily_kpis: DataFrame, product_daily_metrics: DataFrame
) -> DataFrame:
    """All four verdicts in order."""
    verdicts = [
        check_daily_kpis_not_empty(daily_kpis),
        check_no_duplicate_event_ids(silver),
        check_non_negative_revenue(daily_kpis),
        check_product_metrics_not_empty(product_daily_metrics),
    ]
    return reduce(DataFrame.unionByName, verdicts)


def sql_file_checks(spark: SparkSession, folder: str) -> DataFrame:
    """The first row of every ``.sql`` file of ``folder``, in file-name order."""
    files = sorted(path for path in Path(folder).glob("*.sql") if path.is_file())
    if not files:
        raise FileNotFoundError(f"no .sql checks in {folder}")
    verdicts = [
        spark.sql(path.read_text(encoding="utf-8").strip().rstrip(";"))
        .toDF("check_name", "passed", "details")
        .limit(1)
        for path in files
    ]
    return reduce(DataFrame.unionAll, verdicts)


def enforce(verdicts: DataFrame) -> DataFrame:
    """Log every verdict, then raise one error naming all that failed."""
    failures = []
    for row in verdicts.collect():
        LOGGER.info("check %s: passed=%s (%s)", row.check_name, row.passed, row.details)
        if not row.passed:
            failures.append(f"{row.check_name}: {row.details}")
    if failures:
        raise QualityCheckError("quality checks failed: " + "; ".join(failures))
    return verdicts
