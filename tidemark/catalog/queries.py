"""Registered queries: every operator on whole tables, by name."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog import samples
from tidemark.catalog.samples import CONTRACT, DIRTY_COLUMNS, DIRTY_CONTRACT, HASHED, WORKBOOK_CONTRACT
from tidemark.functions import text, values
from tidemark.operators import analytics, cleaning, contracts, history, quality
from tidemark.plans import job, report
from tidemark.sinks import tables
from tidemark.sources import discovery, workbooks
from tidemark.staging import Stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ROW_KEY = ("snapshot_date", "source_row_number")


def registered(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.daily_state(samples.mapped(spark, sf_dir), CONTRACT)


def _derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.add_derived(_daily(spark, sf_dir), CONTRACT, HASHED)


def _collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.collapse_sheets(samples.dirty(spark, sf_dir), DIRTY_CONTRACT)


def _dirty_value(spark: SparkSession, sf_dir: str, name: str, value: Column) -> DataFrame:
    return samples.dirty(spark, sf_dir).select(*ROW_KEY, value.alias(name))


# --- cleaning ---------------------------------------------------------------------------


@registered
def canonical_label(spark, sf_dir):
    kind, key = F.col("event_type"), F.col("event_id")
    label = (
        F.when(samples.every(4), F.concat(F.lit("  Área  "), kind, F.lit("\n")))
        .when(samples.every(3), F.concat(F.lit("Follow-up "), kind, F.lit(" (situação) "), key % 9))
        .when(samples.every(5), F.concat(F.lit("--Über__"), kind, F.lit("\t#é")))
        .otherwise(F.concat(kind, F.lit(" "), key % 100))
    )
    events = samples.table(spark, sf_dir, "events")
    return events.select("event_id", text.canonical_label(label).alias("label"))


@registered
def drop_blank_rows(spark, sf_dir):
    return cleaning.drop_blank_rows(samples.dirty(spark, sf_dir), DIRTY_CONTRACT)


@registered
def trim_text(spark, sf_dir):
    return _dirty_value(spark, sf_dir, "current_stage", text.trim_text(F.col("current_stage")))


@registered
def blank_to_null(spark, sf_dir):
    return _dirty_value(spark, sf_dir, "line_id", text.blank_to_null(F.col("line_id")))


@registered
def identifier(spark, sf_dir):
    return _dirty_value(spark, sf_dir, "request_id", text.identifier(F.col("request_id")))


@registered
def numeric_coerce(spark, sf_dir):
    value = values.whole_number(F.col("sla_days_remaining"))
    return _dirty_value(spark, sf_dir, "sla_days_remaining", value)


@registered
def date_coerce(spark, sf_dir):
    return _dirty_value(spark, sf_dir, "start_date", values.calendar_date(F.col("start_date")))


@registered
def date_by_worksheet(spark, sf_dir):
    """Dates by the format that most values of their worksheet fit."""
    rows = samples.mixed_dates(spark, sf_dir)
    return cleaning.clean_values(rows, samples.VOTED_CONTRACT).select(*ROW_KEY, "start_date")


@registered
def drop_null_ids(spark, sf_dir):
    kept = cleaning.drop_null_ids(samples.dirty(spark, sf_dir), DIRTY_CONTRACT)
    return cleaning.clean_values(kept, DIRTY_CONTRACT)


@registered
def exact_dedup(spark, sf_dir):
    return cleaning.drop_exact_duplicates(samples.dirty(spark, sf_dir))


@registered
def clean_metrics(spark, sf_dir):
    return cleaning.clean_metrics(_collapsed(spark, sf_dir), DIRTY_CONTRACT)


@registered
def clean(spark, sf_dir):
    return cleaning.clean(samples.dirty(spark, sf_dir), DIRTY_CONTRACT)


@registered
def sla_bucket(spark, sf_dir):
    days = F.col("sla_days_remaining")
    return samples.mapped(spark, sf_dir).select(*ROW_KEY, values.sla_bucket(days).alias("sla_bucket"))


@registered
def sla_status(spark, sf_dir):
    days = F.col("sla_days_remaining")
    return samples.mapped(spark, sf_dir).select(*ROW_KEY, values.sla_status(days).alias("sla_status"))


# --- history ----------------------------------------------------------------------------


@registered
def daily_state(spark, sf_dir):
    return _daily(spark, sf_dir)


@registered
def follow_up_date(spark, sf_dir):
    dated = values.with_follow_up_date(
        samples.mapped(spark, sf_dir), F.col("follow_up_notes"), F.col("snapshot_date"), "follow_up_date"
    )
    return dated.select(*ROW_KEY, "follow_up_date")


@registered
def follow_up_age(spark, sf_dir):
    aged = history.add_follow_up(samples.mapped(spark, sf_dir), CONTRACT)
    return aged.select(*ROW_KEY, "follow_up_age_days")


@registered
def record_hash(spark, sf_dir):
    hashed = history.add_record_hash(samples.mapped(spark, sf_dir), CONTRACT, HASHED)
    return hashed.select(*ROW_KEY, "record_hash")


@registered
def derived(spark, sf_dir):
    return _derived(spark, sf_dir)


@registered
def latest_position(spark, sf_dir):
    return history.latest_position(_derived(spark, sf_dir), CONTRACT)


@registered
def summary(spark, sf_dir):
    return history.summary(_daily(spark, sf_dir), CONTRACT)


@registered
def union_snapshots(spark, sf_dir):
    rows = samples.mapped(spark, sf_dir)
    frames = [
        rows.filter(F.col("source_sheet") == sheet).drop(absent)
        for sheet, absent in zip(samples.SHEETS, HASHED, strict=True)
    ]
    return history.union_snapshots(frames)


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = samples.table(spark, sf_dir, "orders")
    return orders.withColumn("snapshot_date", F.col("o_orderdate").cast("date"))


@registered
def daily_state_orders(spark, sf_dir):
    return history.last_per_key(
        _orders(spark, sf_dir), ("snapshot_date", "o_custkey"), ("o_orderkey",)
    ).drop("o_orderdate")


@registered
def latest_position_orders(spark, sf_dir):
    return history.last_per_key(
        _orders(spark, sf_dir), ("o_custkey",), ("snapshot_date", "o_orderkey")
    ).drop("o_orderdate")


# --- analytics --------------------------------------------------------------------------


@registered
def q1_processes_by_date(spark, sf_dir):
    return analytics.processes_by_date(_daily(spark, sf_dir), CONTRACT)


@registered
def q2_current_position(spark, sf_dir):
    return analytics.current_position(_derived(spark, sf_dir), CONTRACT)


@registered
def q3_overdue_by_stage(spark, sf_dir):
    return analytics.overdue_by_stage(_daily(spark, sf_dir), CONTRACT)


@registered
def q4_stale_follow_ups(spark, sf_dir):
    return analytics.stale_follow_ups(_derived(spark, sf_dir), CONTRACT)


@registered
def q5_state_changes(spark, sf_dir):
    return analytics.state_changes(_derived(spark, sf_dir), CONTRACT)


# --- quality ----------------------------------------------------------------------------

_ISSUE = ("code", "severity", "message", "count")


@registered
def rule_issues(spark, sf_dir):
    return quality.history_issues(_derived(spark, sf_dir), CONTRACT).select(*_ISSUE)


@registered
def rule_duplicate_daily(spark, sf_dir):
    return quality.duplicate_daily_rows(samples.mapped(spark, sf_dir), CONTRACT)


def _unresolved_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues of the rows before the daily state is resolved, so duplicates are found."""
    rows = history.add_follow_up(samples.mapped(spark, sf_dir), CONTRACT)
    return quality.history_issues(rows, CONTRACT)


@registered
def severity_totals(spark, sf_dir):
    return quality.severity_totals(_unresolved_issues(spark, sf_dir))


@registered
def run_metrics(spark, sf_dir):
    """The counters of a run over the dirty rows; the typed rows are computed once."""
    typed = cleaning.digested_values(samples.dirty(spark, sf_dir), DIRTY_CONTRACT)
    rows = Stage(spark).write(typed, "rows")
    copies = cleaning.collapse_digests(rows, DIRTY_CONTRACT, cleaning.SHEET_SCOPE)
    per_sheet = cleaning.clean_metrics(copies, DIRTY_CONTRACT)
    cleaned = per_sheet.agg(
        F.count_distinct("source_file").alias("files_discovered"),
        F.count_distinct("source_file").alias("files_processed"),
        F.count(F.lit(1)).alias("sheets_processed"),
        F.sum("raw_rows").alias("records_read"),
        F.sum("clean_rows").alias("records_after_cleaning"),
        F.sum("rows_without_id").alias("rows_without_id_removed"),
        F.sum("exact_duplicates").alias("exact_duplicates_removed"),
    )
    daily = history.daily_state(cleaning.clean_rows(rows, DIRTY_CONTRACT), DIRTY_CONTRACT)
    kept = daily.agg(F.count(F.lit(1)).alias("records_in_history"))
    removed = F.col("records_after_cleaning") - F.col("records_in_history")
    counted = cleaned.withColumn("records_in_history", kept.scalar())
    return counted.withColumn("daily_duplicates_removed", removed).select(*report.METRICS)


@registered
def quality_report(spark, sf_dir):
    """The report of a run over the dirty rows, without its times."""
    now = datetime.now(UTC)
    issues = _unresolved_issues(spark, sf_dir)
    row = report.quality_report(issues, run_metrics(spark, sf_dir), now, now)
    entry = F.transform(
        "issue_totals", lambda e: F.concat_ws(":", e["code"], e["severity"], e["count"].cast("string"))
    )
    return row.select("status", "metrics.*", F.array_join(entry, " ").alias("issue_totals"))


def _broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows before the daily state, some without an id or a date."""
    rows = history.add_follow_up(samples.mapped(spark, sf_dir), CONTRACT)
    number = F.col("source_row_number")
    return rows.withColumns(
        {
            "line_id": F.when(number % 37 != 0, F.col("line_id")),
            "snapshot_date": F.when(number % 59 != 0, F.col("snapshot_date")),
        }
    )


@registered
def blocking_issues(spark, sf_dir):
    return quality.history_issues(_broken(spark, sf_dir), CONTRACT).select(*_ISSUE)


@registered
def gate_status(spark, sf_dir):
    """The gate over resolved rows, which pass, and over broken ones."""
    checked = {"resolved": _derived(spark, sf_dir), "broken": _broken(spark, sf_dir)}
    parts = [
        quality.gate_status(quality.history_issues(rows, CONTRACT)).select(
            F.lit(name).alias("rows"), "errors", F.when(F.col("publishes"), "yes").otherwise("no").alias("publishes")
        )
        for name, rows in checked.items()
    ]
    return parts[0].unionByName(parts[1])


def _flawed(spark: SparkSession, sf_dir: str, wanted: Column) -> job.Ingested:
    """Files, records and worksheets of the flawed workbooks whose files are wanted."""
    stage = Stage(spark)
    paths = samples.flawed_rows(spark, sf_dir).filter(wanted).select("path").distinct()
    files = stage.write(discovery.snapshot_files(paths, WORKBOOK_CONTRACT), "files")
    dated = files.filter(F.col("snapshot_date").isNotNull()).select("path")
    contents = samples.flawed_contents(spark, sf_dir).join(dated, "path", "left_semi")
    records = stage.write(workbooks.parse_workbooks(contents, WORKBOOK_CONTRACT), "records", ("record",))
    readable = job.without(records, workbooks.read_failures(records).select("path"))
    sheets = stage.write(job.sheet_status(readable, WORKBOOK_CONTRACT), "sheets")
    return job.Ingested(files, records, sheets, workbooks.sheet_rows(readable, [], WORKBOOK_CONTRACT))


@registered
def source_issues(spark, sf_dir):
    """Issues of flawed files, workbooks and worksheets."""
    found = job.source_issues(_flawed(spark, sf_dir, F.lit(True)), WORKBOOK_CONTRACT)
    return quality.union_issues(found).select("code", "severity", "count", "source_file", "source_sheet")


@registered
def empty_history_issues(spark, sf_dir):
    """Issues of a run whose files are all older than the first day, and whose history lacks its hash."""
    early = F.col("start_date") < samples.FIRST_DAY
    ingested = _flawed(spark, sf_dir, early)
    resolved = _derived(spark, sf_dir).filter(F.col("snapshot_date") < samples.FIRST_DAY).drop("record_hash")
    found = job.run_issues(spark, ingested, resolved, {"daily_duplicates_removed": 0}, WORKBOOK_CONTRACT)
    return found.select("code", "severity", "count")


def _published(spark: SparkSession, sf_dir: str) -> tuple[str, dict[str, DataFrame]]:
    """The tables after a run has written and published them, opened as readers do; and the folder of the run."""
    stage = Stage(spark)
    output, folder = stage.path("out"), tables.run_folder(stage.path("out"), stage.run_id)
    written = {"history": tables.write_history(_derived(spark, sf_dir), output, CONTRACT, stage.run_id)}
    written["latest_position"] = tables.write_table(history.latest_position(written["history"], CONTRACT), folder, "latest_position")
    written["summary"] = tables.write_table(history.summary(written["history"], CONTRACT), folder, "summary")
    issues = quality.history_issues(written["history"], CONTRACT)
    written["quality_issues"] = tables.write_table(issues, folder, "quality_issues")
    tables.publish(spark, output, stage.run_id, datetime.now(UTC), written)
    return folder, tables.open_published(spark, output)


@registered
def published_history(spark, sf_dir):
    return _published(spark, sf_dir)[1]["history"]


@registered
def published_latest_position(spark, sf_dir):
    return _published(spark, sf_dir)[1]["latest_position"]


@registered
def published_summary(spark, sf_dir):
    return _published(spark, sf_dir)[1]["summary"]


@registered
def published_issues(spark, sf_dir):
    return _published(spark, sf_dir)[1]["quality_issues"].select("code", "severity", "count")


@registered
def published_csv(spark, sf_dir):
    """The text copy of the summary, read back with its types."""
    folder, published = _published(spark, sf_dir)
    path = tables.write_csv(published["summary"], folder, "summary")
    return spark.read.option("header", True).schema(published["summary"].schema).csv(path)


@registered
def lower_case_names(spark, sf_dir):
    return text.lower_columns(samples.table(spark, sf_dir, "customer").withColumnsRenamed({"c_name": "C_NAME", "c_acctbal": "C_AcctBal"}))


@registered
def job_result(spark, sf_dir):
    """Rows of the tables of a result, and its counters."""
    stage = Stage(spark)
    written = tables.write_history(_derived(spark, sf_dir), stage.root, CONTRACT, stage.run_id)
    named = (written, history.latest_position(written, CONTRACT), history.summary(written, CONTRACT), quality.history_issues(written, CONTRACT))
    counters = run_metrics(spark, sf_dir).first().asDict()
    parts = [tables.Part(stage.run_id)]
    result = job.finished(spark, named, counters, datetime.now(UTC), stage, stage.root, stage.root, parts)
    opened = job.in_session(replace(result, **_stored(result, stage.root)), stage.root, spark)
    rows = {f"{name}_rows": getattr(opened, name).count() for name in ("history", "latest_position", "summary", "issues", "report")}
    return spark.createDataFrame([tuple({**rows, **opened.metrics}.values())], ", ".join(f"{c} BIGINT" for c in [*rows, *opened.metrics]))


def _stored(result: job.JobResult, folder: str) -> dict[str, DataFrame]:
    named = {"latest_position": tables.LATEST, "summary": tables.SUMMARY, "issues": tables.ISSUES}
    return {field: tables.write_table(getattr(result, field), folder, name) for field, name in named.items()}


def _added_days(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Published tables after the last three days, first published with other and fewer rows, were written anew."""
    stage, later = Stage(spark), Stage(spark)
    output, derived = stage.path("out"), _derived(spark, sf_dir)
    first = derived.agg(F.date_sub(F.max("snapshot_date"), 2)).first()[0]
    late = F.col("snapshot_date") >= F.lit(first)
    other = derived.withColumn("current_stage", F.when(late, "replaced").otherwise(F.col("current_stage")))
    old = tables.write_history(other.filter(~late | (F.crc32("line_id") % 2 == 0)), output, CONTRACT, stage.run_id)
    latest, totals = history.latest_position(old, CONTRACT), history.summary(old, CONTRACT)
    written = tables.write_history(derived.filter(late), output, CONTRACT, later.run_id)
    parts = tables.parts_after([tables.Part(stage.run_id)], tables.Part(later.run_id, first))
    whole = tables.read_history(spark, output, parts, derived.schema)
    folder = tables.run_folder(output, later.run_id)
    merged = history.merged_latest(latest, whole.filter(~late), written, first, CONTRACT)
    named = {
        "history": whole,
        "latest_position": tables.write_table(merged.select(*whole.columns), folder, "latest_position"),
        "summary": tables.write_table(history.merged_summary(totals, written, first, CONTRACT), folder, "summary"),
        "quality_issues": tables.write_table(quality.history_issues(whole, CONTRACT), folder, "quality_issues"),
    }
    tables.publish(spark, output, later.run_id, datetime.now(UTC), named, parts)
    return tables.open_published(spark, output)


@registered
def added_days_history(spark, sf_dir):
    return _added_days(spark, sf_dir)["history"]


@registered
def added_days_latest_position(spark, sf_dir):
    return _added_days(spark, sf_dir)["latest_position"]


@registered
def added_days_summary(spark, sf_dir):
    return _added_days(spark, sf_dir)["summary"]


@registered
def published_report(spark, sf_dir):
    """The report and its issues read back from the JSON files."""
    now, stage = datetime.now(UTC), Stage(spark)
    folder, issues = stage.root, stage.write(_unresolved_issues(spark, sf_dir), "issues")  # read more than once
    row = report.quality_report(issues, run_metrics(spark, sf_dir), now, now)
    paths = tables.write_report(row, issues, folder)
    found = spark.read.json(paths[tables.REPORT])
    kept = spark.read.json(paths[tables.REPORT_ISSUES]).agg(F.sum("count").alias("issue_count"))
    return found.select("status", "metrics.*").withColumn("issue_count", kept.scalar())


# --- sources and contract ---------------------------------------------------------------


def _site_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.snapshot_files(samples.site_paths(spark, sf_dir), CONTRACT)


@registered
def src_discover(spark, sf_dir):
    return _site_files(spark, sf_dir)


@registered
def snapshot_date_from_name(spark, sf_dir):
    name = values.file_name(samples.site_path())
    events = samples.table(spark, sf_dir, "events")
    return events.select("event_id", values.snapshot_date_from_name(name).alias("snapshot_date"))


@registered
def snapshot_order(spark, sf_dir):
    return discovery.snapshot_order(_site_files(spark, sf_dir))


@registered
def undated_files(spark, sf_dir):
    return discovery.undated_files(_site_files(spark, sf_dir)).select("path", "source_file")


def _shown(rows: DataFrame) -> DataFrame:
    """Working columns under plain names."""
    return rows.withColumnsRenamed({n: n.lstrip("_") for n in rows.columns if n.startswith("_")})


@registered
def lineage(spark, sf_dir):
    files = discovery.snapshot_order(_site_files(spark, sf_dir))
    return _shown(contracts.stamp_lineage(samples.site_rows(spark, sf_dir), files, CONTRACT))


def _books(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.sheets_of_workbooks(samples.site_sheets(spark, sf_dir))


@registered
def sheet_collisions(spark, sf_dir):
    names = F.array_join("colliding_sheets", "|").alias("colliding_sheets")
    return contracts.sheet_collisions(_books(spark, sf_dir)).select("source_file", "sheet_key", names)


@registered
def missing_sheets(spark, sf_dir):
    return contracts.missing_sheets(_books(spark, sf_dir), CONTRACT)


@registered
def unexpected_sheets(spark, sf_dir):
    names = F.array_join("worksheets", "|").alias("worksheets")
    found = contracts.unexpected_sheets(_books(spark, sf_dir), CONTRACT)
    return found.select("source_file", "sheet_count", names)


@registered
def header_collisions(spark, sf_dir):
    names = F.array_join("colliding_columns", "|").alias("colliding_columns")
    found = contracts.header_collisions(samples.site_headers(spark, sf_dir))
    return found.select("source_file", "source_sheet", names)


def _site_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty rows in one workbook per process and day, so that some columns are empty."""
    rows = samples.dirty(spark, sf_dir)
    process = F.coalesce(text.trim_text(F.col("line_id")), F.lit("none"))
    return rows.withColumn("source_file", F.concat_ws("_", process, F.col("source_file")))


@registered
def column_fill(spark, sf_dir):
    return contracts.column_fill(_site_dirty(spark, sf_dir), DIRTY_COLUMNS)


@registered
def contract_failures(spark, sf_dir):
    filled = contracts.filled_cells(_site_dirty(spark, sf_dir), DIRTY_COLUMNS)
    found = contracts.contract_failures(filled, DIRTY_CONTRACT)
    names = F.array_join("missing_columns", "|").alias("missing_columns")
    return found.select("source_file", "source_sheet", names)


_WORKBOOK_COLUMNS = [
    "line_id", "request_id", "current_stage", "sla_days_remaining", "sla_status",
    "follow_up_notes", "start_date",
]


@registered
def read_workbooks(spark, sf_dir):
    contents = samples.workbook_contents(spark, sf_dir)
    records = Stage(spark).write(workbooks.parse_workbooks(contents, WORKBOOK_CONTRACT), "records", ("record",))
    return _shown(workbooks.sheet_rows(records, _WORKBOOK_COLUMNS, WORKBOOK_CONTRACT))


@registered
def read_failures(spark, sf_dir):
    contents = samples.damaged_contents(spark, sf_dir)
    records = workbooks.parse_workbooks(contents, WORKBOOK_CONTRACT)
    return workbooks.read_failures(records).select("path")


@registered
def history_from_workbooks(spark, sf_dir):
    """Workbook files to history: scan, contract, cleaning, daily state, derived columns."""
    stage = Stage(spark)
    listed = discovery.snapshot_files(samples.workbook_paths(spark, sf_dir), WORKBOOK_CONTRACT)
    files = stage.write(listed, "files")
    numbered = stage.write(discovery.snapshot_order(files), "numbered_files")
    contents = samples.workbook_contents(spark, sf_dir)
    records = stage.write(
        workbooks.parse_workbooks(contents, WORKBOOK_CONTRACT), "records", ("record",)
    )
    ingested = job.ingest_records(files, numbered, records, WORKBOOK_CONTRACT, stage)
    return job.resolve_history(ingested.rows, WORKBOOK_CONTRACT)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned dirty rows to daily state, and the changes between snapshots."""
    cleaned = cleaning.clean(samples.dirty(spark, sf_dir), DIRTY_CONTRACT)
    daily = history.daily_state(cleaned, DIRTY_CONTRACT)
    hashed = history.add_record_hash(daily, DIRTY_CONTRACT)
    return analytics.state_changes(hashed, DIRTY_CONTRACT)
