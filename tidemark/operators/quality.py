"""Quality issues as rows: ``code, severity, message, count, source_file, source_sheet, details``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contract import ROW_NUMBER, Contract
from tidemark.errors import QualityGateError

INFO, WARNING, ERROR = "info", "warning", "error"

# Issue code -> severity.
SEVERITY = {
    "NO_INPUT_FILES": ERROR,
    "SNAPSHOT_DATE_NOT_FOUND": WARNING,
    "UNEXPECTED_SHEETS": INFO,
    "MISSING_WORKSHEET": ERROR,
    "WORKSHEET_CONTRACT_FAILED": ERROR,
    "WORKBOOK_READ_FAILED": ERROR,
    "DAILY_DUPLICATES_RESOLVED": INFO,
    "EMPTY_HISTORY": ERROR,
    "OUTPUT_CONTRACT_FAILED": ERROR,
    "NULL_PROCESS_ID": ERROR,
    "DUPLICATE_DAILY_PROCESS": ERROR,
    "INVALID_SNAPSHOT_DATE": ERROR,
    "FUTURE_FOLLOW_UP_DATE": WARNING,
    "INVALID_SLA_VALUE": WARNING,
    "MISSING_FOLLOW_UP": INFO,
}

# What the rules over a whole history say, in our words.
HISTORY_MESSAGES = {
    "EMPTY_HISTORY": "The job produced no history rows.",
    "NULL_PROCESS_ID": "History rows without a process id.",
    "DUPLICATE_DAILY_PROCESS": "Processes with several rows on one snapshot date.",
    "INVALID_SNAPSHOT_DATE": "History rows without a snapshot date.",
    "FUTURE_FOLLOW_UP_DATE": "Follow-up dates after the snapshot date.",
    "INVALID_SLA_VALUE": "Rows without a readable number of service-level days.",
    "MISSING_FOLLOW_UP": "Rows without follow-up notes.",
}

def no_details() -> Column:
    return F.create_map().cast("map<string,array<string>>")


def issue_rows(
    found: DataFrame,
    code: str,
    *,
    message: Column,
    count: Column | None = None,
    severity: str | None = None,
    source_file: Column | None = None,
    source_sheet: Column | None = None,
    details: Column | None = None,
) -> DataFrame:
    """One issue per row of ``found``."""
    missing = F.lit(None).cast("string")
    return found.select(
        F.lit(code).alias("code"),
        F.lit(severity or SEVERITY[code]).alias("severity"),
        message.alias("message"),
        (F.lit(1) if count is None else count).cast("bigint").alias("count"),
        (missing if source_file is None else source_file).alias("source_file"),
        (missing if source_sheet is None else source_sheet).alias("source_sheet"),
        (no_details() if details is None else details).alias("details"),
    )


def known_issue(spark: SparkSession, code: str, message: str, count: int = 1) -> DataFrame:
    """An issue the driver already knows, such as a missing output column."""
    return issue_rows(spark.range(1), code, message=F.lit(message), count=F.lit(count))


def union_issues(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def duplicate_daily_rows(history: DataFrame, contract: Contract) -> DataFrame:
    """Number of rows that share their snapshot date and process with another row."""
    groups = history.groupBy("snapshot_date", contract.id_column).agg(
        F.count(F.lit(1)).alias("members")
    )
    return groups.agg(
        F.coalesce(F.sum(F.when(F.col("members") > 1, F.col("members"))), F.lit(0)).alias(
            "duplicate_rows"
        )
    )


def history_counts(history: DataFrame, contract: Contract) -> DataFrame:
    """The count behind every rule over a history, as one row named by issue code.

    A first aggregation per (date, process) finds the duplicated groups and carries
    the other counts along, so the history is read once and shuffled once.
    """
    columns = set(history.columns)
    process, notes = contract.id_column, contract.follow_up_notes_column
    conditions = {
        "NULL_PROCESS_ID": F.col(process).isNull(),
        "INVALID_SNAPSHOT_DATE": F.col("snapshot_date").isNull(),
    }
    if "follow_up_age_days" in columns:
        conditions["FUTURE_FOLLOW_UP_DATE"] = F.col("follow_up_age_days") < 0
    if contract.sla_column in columns:
        conditions["INVALID_SLA_VALUE"] = F.col(contract.sla_column).isNull()
    if notes in columns:
        conditions["MISSING_FOLLOW_UP"] = F.col(notes).isNull()

    per_process = history.groupBy("snapshot_date", process).agg(
        F.count(F.lit(1)).alias("members"),
        *[F.count_if(condition).alias(code) for code, condition in conditions.items()],
    )
    members = F.col("members")
    totals = per_process.agg(
        F.coalesce(F.sum(members), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(members > 1, members)), F.lit(0)).alias("DUPLICATE_DAILY_PROCESS"),
        *[F.coalesce(F.sum(code), F.lit(0)).alias(code) for code in conditions],
    )
    return totals.withColumn("EMPTY_HISTORY", (F.col("rows") == 0).cast("bigint"))


def history_issues(history: DataFrame, contract: Contract) -> DataFrame:
    """Issues of the rules over a whole history; rules that found nothing add no row."""
    counts = history_counts(history, contract)
    rules = [code for code in counts.columns if code != "rows"]
    found = counts.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(code).alias("code"),
                        F.lit(SEVERITY[code]).alias("severity"),
                        F.lit(HISTORY_MESSAGES[code]).alias("message"),
                        F.col(code).alias("count"),
                    )
                    for code in rules
                ]
            )
        ).alias("issue")
    ).select("issue.*")
    missing = F.lit(None).cast("string")
    return found.filter("count > 0").select(
        "*",
        missing.alias("source_file"),
        missing.alias("source_sheet"),
        no_details().alias("details"),
    )


def missing_output_columns(columns: Sequence[str], contract: Contract) -> list[str]:
    """Columns a history must have and ``columns`` lacks (schema metadata only)."""
    needed = {
        "snapshot_date",
        "snapshot_order",
        "source_file",
        "source_sheet",
        ROW_NUMBER,
        contract.id_column,
        "record_hash",
    }
    return sorted(needed - {name.lower() for name in columns})


def validate_history(history: DataFrame, contract: Contract) -> DataFrame:
    """Output contract, then the rules over the rows."""
    spark = history.sparkSession
    missing = missing_output_columns(history.columns, contract)
    parts = []
    if missing:
        message = f"The history lacks columns: {', '.join(missing)}"
        parts.append(known_issue(spark, "OUTPUT_CONTRACT_FAILED", message, len(missing)))
    if {"snapshot_date", contract.id_column} <= set(history.columns):
        parts.append(history_issues(history, contract))
    return union_issues(parts)


def severity_totals(issues: DataFrame) -> DataFrame:
    """Summed issue counts per severity."""
    return issues.groupBy("severity").agg(F.sum("count").alias("issue_count"))


def gate_status(issues: DataFrame) -> DataFrame:
    """Whether a run may publish, in one row: ``errors`` (summed counts of blocking issues) and ``publishes``."""
    totals = issues.agg(F.coalesce(F.sum(F.when(F.col("severity") == ERROR, F.col("count"))), F.lit(0)).alias("errors"))
    return totals.withColumn("publishes", F.col("errors") == 0)


def raise_for_errors(issues: DataFrame, kept_in: str | None = None) -> None:
    """Stop the run when any blocking issue was found; the error says where they are kept."""
    gate = gate_status(issues).first()
    if not gate["publishes"]:
        place = f" See {kept_in}." if kept_in else ""
        raise QualityGateError(f"Nothing is published while blocking issues count {gate['errors']}.{place}")
