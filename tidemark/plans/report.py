"""The quality report of a run as a one-row table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.quality import ERROR, WARNING

# The counters of a run, in report order.
METRICS = (
    "files_discovered",
    "files_processed",
    "sheets_processed",
    "records_read",
    "records_after_cleaning",
    "records_in_history",
    "rows_without_id_removed",
    "exact_duplicates_removed",
    "daily_duplicates_removed",
)


def _severity_sum(severity: str) -> Column:
    matching = F.when(F.col("severity") == severity, F.col("count"))
    return F.coalesce(F.sum(matching), F.lit(0))


def quality_report(
    issues: DataFrame, metrics: DataFrame, started: datetime, finished: datetime
) -> DataFrame:
    """Status, times, counters and issue totals per code, in one row.

    The issues themselves stay a table of their own: their number grows with the files,
    while this row has one entry per issue code.
    """
    by_code = issues.groupBy("code", "severity").agg(
        F.sum("count").alias("count"), F.count(F.lit(1)).alias("issues")
    )
    entry = F.struct("code", "severity", "count", "issues")
    totals = by_code.agg(
        _severity_sum(ERROR).alias("errors"),
        _severity_sum(WARNING).alias("warnings"),
        F.array_sort(F.collect_list(entry)).alias("issue_totals"),
    )
    counted = totals.withColumn("counters", metrics.select(F.struct(*metrics.columns)).scalar())
    counters = [F.col(f"counters.{name}") for name in metrics.columns]
    return counted.select(
        F.when(F.col("errors") == 0, "passed").otherwise("failed").alias("status"),
        F.lit(started).alias("started_at"),
        F.lit(finished).alias("finished_at"),
        F.lit(round((finished - started).total_seconds(), 3)).alias("duration_seconds"),
        F.struct(*counters, "errors", "warnings").alias("metrics"),
        "issue_totals",
    )
