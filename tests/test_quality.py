from __future__ import annotations

from datetime import UTC, date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import QualityGateError
from tidemark.operators import quality
from tidemark.plans.job import run_metrics_frame
from tidemark.plans.report import METRICS, quality_report

SCHEMA = (
    "snapshot_date DATE, snapshot_order INT, source_file STRING, source_sheet STRING, source_row_number INT, "
    "line_id STRING, record_hash STRING, sla_days_remaining INT, follow_up_notes STRING, follow_up_age_days INT"
)
DAY = date(2026, 8, 18)


def found(issues):
    return {r["code"]: (r["severity"], r["count"]) for r in issues.collect()}


def test_every_rule(spark, contract):
    rows = [
        (DAY, 1, "f", "s", 2, "a", "h", 1, "note", 0),
        (DAY, 1, "f", "s", 3, "a", "h", 1, "note", -2),
        (DAY, 1, "f", "s", 4, "a", "h", None, None, None),
        (DAY, 1, "f", "s", 5, None, "h", 1, "note", 1),
        (DAY, 1, "f", "s", 6, None, "h", 1, "note", 1),
        (None, 1, "f", "s", 7, "b", "h", 1, "note", 1),
    ]
    issues = quality.validate_history(spark.createDataFrame(rows, SCHEMA), contract)
    assert found(issues) == {
        "DUPLICATE_DAILY_PROCESS": ("error", 5),
        "NULL_PROCESS_ID": ("error", 2),
        "INVALID_SNAPSHOT_DATE": ("error", 1),
        "FUTURE_FOLLOW_UP_DATE": ("warning", 1),
        "INVALID_SLA_VALUE": ("warning", 1),
        "MISSING_FOLLOW_UP": ("info", 1),
    }
    totals = {r["severity"]: r["issue_count"] for r in quality.severity_totals(issues).collect()}
    assert totals == {"error": 8, "warning": 2, "info": 1}
    with pytest.raises(QualityGateError, match="Nothing is published"):
        quality.raise_for_errors(issues)


def test_clean_history_has_no_issue(spark, contract):
    rows = [(DAY, 1, "f", "s", 2, "a", "h", 1, "note", 0)]
    issues = quality.validate_history(spark.createDataFrame(rows, SCHEMA), contract)
    assert issues.count() == 0
    quality.raise_for_errors(issues)


def test_empty_history_blocks(spark, contract):
    issues = quality.validate_history(spark.createDataFrame([], SCHEMA), contract)
    assert found(issues) == {"EMPTY_HISTORY": ("error", 1)}
    with pytest.raises(QualityGateError, match="count 1"):
        quality.raise_for_errors(issues)


def test_missing_output_columns(spark, contract):
    frame = spark.createDataFrame([(DAY, "a", "n")], "snapshot_date DATE, line_id STRING, follow_up_notes STRING")
    issues = quality.validate_history(frame, contract)
    assert found(issues) == {"OUTPUT_CONTRACT_FAILED": ("error", 5)}


def test_report_sums_counts(spark):
    issues = quality.known_issue(spark, "INVALID_SLA_VALUE", "Example", 3)
    counters = dict.fromkeys(METRICS, 0) | {"files_discovered": 2}
    started = datetime(2026, 8, 1, tzinfo=UTC)
    report = quality_report(
        issues, run_metrics_frame(spark, counters), started, started + timedelta(seconds=2.5)
    ).first()
    assert report["status"] == "passed"
    assert report["metrics"]["warnings"] == 3
    assert report["metrics"]["files_discovered"] == 2
    assert report["duration_seconds"] == 2.5
    assert [tuple(e) for e in report["issue_totals"]] == [("INVALID_SLA_VALUE", "warning", 3, 1)]


def test_severities_are_known():
    assert set(quality.SEVERITY.values()) == {"info", "warning", "error"}
    assert set(quality.HISTORY_MESSAGES) <= set(quality.SEVERITY)


def test_rules_read_only_the_columns_they_need(spark, contract, tmp_path):
    rows = [(DAY, 1, "f", "s", 2, "a", "h", 1, "note", 0)]
    spark.createDataFrame(rows, SCHEMA).withColumn("wide", F.lit("x")).write.parquet(str(tmp_path / "h"))
    plan = quality.history_issues(spark.read.parquet(str(tmp_path / "h")), contract)
    physical = plan._jdf.queryExecution().executedPlan().toString()
    schema = physical.split("ReadSchema: ")[1].split("\n")[0]
    assert "wide" not in schema and "record_hash" not in schema
