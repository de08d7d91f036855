"""The whole job: dated workbooks in, checked and published tables out.

Each stage ends in a written table, so a lost executor repeats one stage at most and
every counter comes from settled data:

1. ``files``      listing, dates, order
2. ``records``    one distributed scan of the workbook contents
3. ``sheets``     contract status of every worksheet
4. ``rows``       typed rows with their lineage; a narrow step, no shuffle
5. ``history``    daily state (the one shuffle that resolves rows), laid out by date

Exact copies need no step of their own in the job: the daily state keeps the last of
them anyway. They are counted by content digest, which shuffles a few bytes per row.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.contract import (
    LINEAGE_COLUMNS,
    NOTE_CELL_DATE,
    ROW_NUMBER,
    ROW_PATH,
    ROW_SHEET,
    Contract,
)
from tidemark.functions.values import file_name
from tidemark.operators import cleaning, contracts, history, quality
from tidemark.plans.report import METRICS, quality_report
from tidemark.sinks import database, tables
from tidemark.sources import discovery, workbooks
from tidemark.staging import Stage, job_session

ROW_SCOPE = (ROW_PATH, ROW_SHEET)
STATE_FILES, STATE_RECORDS, STATE_COUNTERS = "state_files", "state_records", "state_counters"


@dataclass
class JobResult:
    """Tables of one run, all read back from storage."""

    history: DataFrame
    latest_position: DataFrame
    summary: DataFrame
    issues: DataFrame
    report: DataFrame
    metrics: dict[str, int]
    run_id: str
    output_paths: dict[str, str] = field(default_factory=dict)
    root: str = ""  # folder of the history
    parts: list[tables.Part] = field(default_factory=list)


@dataclass
class Ingested:
    """Stages 1 to 4: everything known before the history is resolved."""

    files: DataFrame
    records: DataFrame
    sheets: DataFrame
    rows: DataFrame
    numbered: DataFrame | None = None


def ingest(spark: SparkSession, source: str | DataFrame, contract: Contract, stage: Stage) -> Ingested:
    """Scan, check and clean all workbooks of a folder or an inventory."""
    listed = discovery.snapshot_files(discovery.list_files(source, spark, stage), contract)
    files = stage.write(listed, "files")
    numbered = stage.write(discovery.snapshot_order(files), "numbered_files")
    records = stage.write(workbooks.scan_workbooks(files, contract), "records", partition_by=("record",))
    return ingest_records(files, numbered, records, contract, stage)


def ingest_records(
    files: DataFrame, numbered: DataFrame, records: DataFrame, contract: Contract, stage: Stage
) -> Ingested:
    """Check and clean scanned records."""
    failures = stage.write(workbooks.read_failures(records), "failures")
    readable = without(records, failures.select("path"))
    columns = header_columns(readable, numbered, contract)
    places = stage.write(workbooks.layouts(readable, columns, contract), "layouts")
    rows = workbooks.sheet_rows(readable, columns, contract, places)
    sheets = stage.write(sheet_status(readable, contract), "sheets")

    kept = filled_columns(sheets, columns)
    failing = stage.write(row_scope(sheets.filter(~F.col("passes"))), "failing")
    stamped = contracts.stamp_lineage(without(rows, failing), numbered, contract)
    ordered = stamped.select(
        *LINEAGE_COLUMNS,
        *kept,
        *[F.lit(None).cast("string").alias(name) for name in undelivered(kept, contract)],
        ROW_NUMBER,
        NOTE_CELL_DATE,
    )
    typed = stage.write(cleaning.digested_values(ordered, contract), "rows")
    return Ingested(files, records, sheets, typed, numbered)


def without(rows: DataFrame, excluded: DataFrame) -> DataFrame:
    """Rows whose keys are not in ``excluded``, a written table and usually empty.

    Without entries there is no join. Otherwise the size of the written table decides
    whether Spark broadcasts it, so the rows are not shuffled for a few exceptions.
    """
    return rows if excluded.isEmpty() else rows.join(excluded, excluded.columns, "left_anti")


def undelivered(columns: list[str], contract: Contract) -> list[str]:
    """Columns the history cannot do without, where no worksheet delivered them."""
    needed = (contract.id_column, contract.follow_up_notes_column)
    return [name for name in needed if name not in columns]


def header_columns(records: DataFrame, numbered: DataFrame, contract: Contract) -> list[str]:
    """Source columns of the worksheets in first-seen order (schema metadata).

    Only worksheets that can fulfil the contract count. Others deliver no rows, and a
    stray worksheet must not widen the table by whatever its first row holds.
    """
    required = contracts.texts(contract.required_columns)
    _, position = contracts.sheet_lineage(contract, F.col("sheet_key"))
    seen = (
        workbooks.sheet_list(records)
        .filter(F.size(F.array_except(required, "header_keys")) == 0)
        .join(numbered.select("path", "snapshot_order"), "path")
        .select(
            F.struct("snapshot_order", position.alias("sheet_order")).alias("sheet"),
            F.posexplode("header_keys").alias("at", "name"),
        )
    )
    first = seen.groupBy("name").agg(F.min(F.struct("sheet", "at")).alias("first_seen"))
    names = [row["name"] for row in first.orderBy("first_seen").select("name").collect()]
    return contract.business_columns(workbooks.source_columns(names))


def row_scope(sheets: DataFrame) -> DataFrame:
    """Keys of worksheets under the names the rows use."""
    return sheets.select(F.col("path").alias(ROW_PATH), F.col("sheet_key").alias(ROW_SHEET))


def sheet_status(records: DataFrame, contract: Contract) -> DataFrame:
    """Every expected worksheet with its filled cells per header and what it violates.

    The reader has counted the cells, so the rows are not read for this.
    """
    missing = contracts.missing_required(contract)
    if contract.allow_empty_sheets:
        missing = F.when(F.col("raw_rows") > 0, missing).otherwise(contracts.texts([]))
    violations = {
        "colliding_columns": contracts.repeated(F.col("header_keys")),
        "reserved_columns": F.array_intersect("header_keys", contracts.texts(LINEAGE_COLUMNS)),
        "missing_columns": missing,
    }
    found = sum((F.size(name) for name in violations), F.lit(0))
    return workbooks.sheet_list(records).withColumns(violations).withColumn("passes", found == 0)


def filled_columns(sheets: DataFrame, columns: list[str]) -> list[str]:
    """Columns that hold a value in some passing worksheet, in their order."""
    totals = (
        sheets.filter("passes")
        .select(F.explode("filled_cells").alias("name", "cells"))
        .groupBy("name")
        .agg(F.sum("cells").alias("cells"))
    )
    filled = {row["name"] for row in totals.filter("cells > 0").collect()}
    return [name for name in columns if name in filled]


def source_issues(ingested: Ingested, contract: Contract) -> list[DataFrame]:
    """Issues of files, workbooks and worksheets."""
    name = file_name(F.col("path"))
    books = workbooks.workbook_list(ingested.records).withColumn("source_file", name)
    sheet_severity = quality.ERROR if contract.strict_sheets else quality.WARNING

    described = F.format_string
    failing = ingested.sheets.filter(~F.col("passes")).withColumn("source_file", name)
    reason = F.concat_ws(
        "; ",
        *[
            F.when(F.size(columns) > 0, F.concat(F.lit(text), F.array_join(columns, ", ")))
            for columns, text in (
                ("colliding_columns", "Headers collide: "),
                ("reserved_columns", "Headers are reserved: "),
                ("missing_columns", "Required columns are missing: "),
            )
        ],
    )
    return [
        quality.issue_rows(
            discovery.undated_files(ingested.files),
            "SNAPSHOT_DATE_NOT_FOUND",
            message=described("No valid snapshot date in the name of '%s'.", F.col("source_file")),
            source_file=F.col("source_file"),
        ),
        quality.issue_rows(
            contracts.unexpected_sheets(books, contract),
            "UNEXPECTED_SHEETS",
            message=F.lit("The workbook has worksheets outside the contract."),
            count=F.col("sheet_count"),
            source_file=F.col("source_file"),
            details=F.create_map(F.lit("worksheets"), F.col("worksheets")),
        ),
        quality.issue_rows(
            contracts.missing_sheets(books, contract),
            "MISSING_WORKSHEET",
            message=described("Expected worksheet '%s' is missing.", F.col("source_sheet")),
            severity=sheet_severity,
            source_file=F.col("source_file"),
            source_sheet=F.col("source_sheet"),
        ),
        quality.issue_rows(
            contracts.sheet_collisions(books),
            "WORKSHEET_CONTRACT_FAILED",
            message=described(
                "Worksheet names collide: %s", F.array_join("colliding_sheets", ", ")
            ),
            source_file=F.col("source_file"),
        ),
        quality.issue_rows(
            failing,
            "WORKSHEET_CONTRACT_FAILED",
            message=reason,
            source_file=F.col("source_file"),
            source_sheet=F.col("sheet"),
        ),
        quality.issue_rows(
            workbooks.read_failures(ingested.records),
            "WORKBOOK_READ_FAILED",
            message=described("The workbook cannot be read: %s", F.col("error")),
            source_file=name,
        ),
    ]


def day_counters(ingested: Ingested, contract: Contract) -> DataFrame:
    """Cleaning counters by snapshot date; each is an aggregate over a written table."""
    scope = ("snapshot_date", "snapshot_order", "sheet_order")
    copies = cleaning.collapse_digests(ingested.rows, contract, scope)
    return cleaning.clean_metrics(copies, contract, scope=("snapshot_date",))


def run_counters(ingested: Ingested, resolved: DataFrame, contract: Contract) -> dict[str, int]:
    return total_counters(ingested, day_counters(ingested, contract), resolved)


def total_counters(ingested: Ingested, by_day: DataFrame, resolved: DataFrame) -> dict[str, int]:
    """The counters of a run."""
    cleaned = by_day.agg(*[F.sum(name).alias(name) for name in ("clean_rows", "rows_without_id", "exact_duplicates")]).first()
    sheets = ingested.sheets.agg(F.count_if("passes").alias("passing")).first()
    read = workbooks.sheet_list(ingested.records).agg(F.sum("raw_rows").alias("rows")).first()
    after_cleaning, in_history = cleaned["clean_rows"] or 0, resolved.count()
    return {
        "files_discovered": ingested.files.count(),
        "files_processed": workbooks.workbook_list(ingested.records).count(),
        "sheets_processed": sheets["passing"],
        "records_read": read["rows"] or 0,
        "records_after_cleaning": after_cleaning,
        "records_in_history": in_history,
        "rows_without_id_removed": cleaned["rows_without_id"] or 0,
        "exact_duplicates_removed": cleaned["exact_duplicates"] or 0,
        "daily_duplicates_removed": after_cleaning - in_history,
    }


def run_issues(
    spark: SparkSession,
    ingested: Ingested,
    resolved: DataFrame,
    counters: dict[str, int],
    contract: Contract,
) -> DataFrame:
    parts = source_issues(ingested, contract)
    if ingested.files.filter(F.col("snapshot_date").isNotNull()).isEmpty():
        parts.append(quality.known_issue(spark, "NO_INPUT_FILES", "No dated snapshot was found."))
    removed = counters["daily_duplicates_removed"]
    if removed:
        message = "Several rows of a process on one date; the last one was kept."
        parts.append(quality.known_issue(spark, "DAILY_DUPLICATES_RESOLVED", message, removed))
    parts.append(quality.validate_history(resolved, contract))
    return quality.union_issues(parts)


def resolve_history(rows: DataFrame, contract: Contract) -> DataFrame:
    """Clean rows, one per process and date, with derived columns."""
    daily = history.daily_state(cleaning.clean_rows(rows, contract), contract)
    return history.add_derived(daily, contract)


def run_job(
    spark: SparkSession,
    source: str | DataFrame,
    contract: Contract | None = None,
    output: str | None = None,
    database_url: str | None = None,
    csv: bool = False,
    database_properties: dict[str, str] | None = None,
    database_connections: int | None = None,
) -> JobResult:
    """Build, check and publish the tables of all workbooks below a folder, or of an inventory.

    Raises :class:`~tidemark.errors.QualityGateError` when a blocking issue was found;
    nothing is published then. The source files are only read. Without ``output`` the
    tables stay in the stage folder of the run; with it, the stage is removed after success
    and kept after a failure. Settings of the run hold in a session of its own.
    """
    contract = contract or Contract()
    session = job_session(spark)
    result, target, stage, state = build_tables(session, source, contract, output)
    if output:
        publish_tables(result, target, output, csv, contract, state)
    if database_url:
        database.write_database(
            result.history, database_url, contract, database_properties, database_connections
        )
    if output:
        stage.remove()
    return in_session(result, target, spark)


def in_session(result: JobResult, target: str, spark: SparkSession) -> JobResult:
    """The result with its tables opened in the caller's session."""
    names = {"latest_position": tables.LATEST, "summary": tables.SUMMARY, "issues": tables.ISSUES, "report": tables.REPORT_TABLE}
    opened = {
        field: tables.read_table(spark, f"{target}/{name}", getattr(result, field).schema) for field, name in names.items()
    }
    opened["history"] = tables.read_history(spark, result.root, result.parts, result.history.schema)
    return replace(result, **opened)


def build_tables(
    spark: SparkSession, source: str | DataFrame, contract: Contract, output: str | None
) -> tuple[JobResult, str, Stage, dict[str, DataFrame]]:
    """All tables of a run, written to its own folder and past the quality gate, and what a later run must know."""
    started = datetime.now(UTC)
    stage = Stage(spark)
    ingested = ingest(spark, source, contract, stage)
    target, root = (tables.run_folder(output, stage.run_id), output) if output else (stage.root, stage.root)
    tables.write_history(resolve_history(ingested.rows, contract), root, contract, stage.run_id)
    parts = [tables.Part(stage.run_id)]
    schema = history_schema(ingested, contract)
    resolved = tables.read_history(spark, root, parts, schema)
    by_day = tables.write_table(day_counters(ingested, contract), target, STATE_COUNTERS)
    counters, issues = checked(spark, ingested, resolved, by_day, target, contract)
    latest = tables.write_table(history.latest_position(resolved, contract), target, tables.LATEST)
    totals = tables.write_table(history.summary(resolved, contract), target, tables.SUMMARY)
    result = finished(spark, (resolved, latest, totals, issues), counters, started, stage, target, root, parts)
    return result, target, stage, published_state(ingested)


def history_schema(ingested: Ingested, contract: Contract) -> StructType:
    return resolve_history(ingested.rows, contract).schema


def checked(
    spark: SparkSession, ingested: Ingested, resolved: DataFrame, by_day: DataFrame, target: str, contract: Contract
) -> tuple[dict[str, int], DataFrame]:
    """Counters and issues of a run; a blocking issue ends it."""
    counters = total_counters(ingested, by_day, resolved)
    found = run_issues(spark, ingested, resolved, counters, contract)
    issues = tables.write_table(found, target, tables.ISSUES)
    quality.raise_for_errors(issues, kept_in=f"{target}/{tables.ISSUES}")
    return counters, issues


def finished(
    spark: SparkSession,
    named: tuple[DataFrame, DataFrame, DataFrame, DataFrame],
    counters: dict[str, int],
    started: datetime,
    stage: Stage,
    target: str,
    root: str,
    parts: list[tables.Part],
) -> JobResult:
    """The result of a run, with its report."""
    resolved, latest, totals, issues = named
    metrics = run_metrics_frame(spark, counters)
    report = tables.write_table(quality_report(issues, metrics, started, datetime.now(UTC)), target, tables.REPORT_TABLE)
    return JobResult(resolved, latest, totals, issues, report, counters, stage.run_id, root=root, parts=parts)


def publish_tables(
    result: JobResult, target: str, output: str, csv: bool, contract: Contract, state: dict[str, DataFrame]
) -> None:
    """Write what the next run needs, the report and the optional copies, then make the run the current one."""
    named = dict(
        zip(tables.TABLES, (result.history, result.latest_position, result.summary, result.issues), strict=True)
    )
    for name, table in state.items():
        tables.write_table(table, target, name)
    result.output_paths = {name: f"{target}/{name}" for name in named}
    result.output_paths[tables.HISTORY] = f"{output}/{tables.HISTORY}"
    result.output_paths |= tables.write_report(result.report, result.issues, target)
    if csv:
        for name, table in named.items():
            result.output_paths[f"{name}_csv"] = tables.write_csv(table, target, name)
    spark = result.history.sparkSession
    tables.publish(spark, output, result.run_id, datetime.now(UTC), named, result.parts, contract)


def published_state(ingested: Ingested) -> dict[str, DataFrame]:
    """What a later run that adds days must know of the files of this one: a row per file, worksheet and workbook."""
    return {STATE_FILES: ingested.numbered, STATE_RECORDS: ingested.records.filter(F.col("record") != "row")}


def run_metrics_frame(spark: SparkSession, counters: dict[str, int]) -> DataFrame:
    schema = ", ".join(f"{name} BIGINT" for name in METRICS)
    return spark.createDataFrame([tuple(counters[name] for name in METRICS)], schema)
