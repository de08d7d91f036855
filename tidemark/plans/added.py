"""Added days: a run that reads the new files and writes their dates, and leaves the rest of the history as it lies.

Files are compared with those of the published run, by path and length. Everything from the first date with a new, changed or missing
file on is written anew: the number of a file, and with it its rows, depends on all files before it, never on those after it. For a new
last day, that is this day alone. Tables that cover the whole history follow from what the published run knew of the earlier
files (a row per file, workbook and worksheet) and from the new rows; the result is that of a run over everything.
"""

from __future__ import annotations

from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contract import Contract
from tidemark.errors import TidemarkError
from tidemark.operators import history
from tidemark.plans import job
from tidemark.sinks import tables
from tidemark.sources import discovery, workbooks
from tidemark.staging import Stage, job_session

_FILE = ("path", "length", "snapshot_date", "snapshot_order")


def first_change(known: DataFrame, numbered: DataFrame) -> date | None:
    """First date with a file that is new, gone, changed in length or numbered anew."""
    mine, theirs = numbered.select(*_FILE), known.select(*_FILE)
    odd = mine.exceptAll(theirs).unionByName(theirs.exceptAll(mine))
    return odd.agg(F.min("snapshot_date")).first()[0]


def add_days(
    spark: SparkSession, source: str | DataFrame, contract: Contract | None = None, output: str = "", csv: bool = False
) -> job.JobResult:
    """Publish the history with the days that were added to a folder (or an inventory) since the last run.

    The result equals that of :func:`~tidemark.plans.job.run_job`, which is called where nothing was published yet, where the contract is another one, or where
    the columns of the history change (the content hash covers all of them). Files are told apart by path and length.
    Blocking issues publish nothing. Without a changed date the new run has the same parts, and writes none.
    """
    contract = contract or Contract()
    session = job_session(spark)
    try:
        current = tables.newest(session, output)
    except TidemarkError:
        return job.run_job(spark, source, contract, output, csv=csv)
    if current.contract != repr(contract):
        return job.run_job(spark, source, contract, output, csv=csv)
    built = _build(session, source, contract, output, current)
    if built is None:
        return job.run_job(spark, source, contract, output, csv=csv)
    result, target, stage, state = built
    job.publish_tables(result, target, output, csv, contract, state)
    stage.remove()
    return job.in_session(result, target, spark)


def _ingested(
    spark: SparkSession, source: str | DataFrame, contract: Contract, stage: Stage, folder: str
) -> tuple[job.Ingested, date | None]:
    """All files, what is known or read of their worksheets, and the rows of those that must be read; and their first date."""
    listed = discovery.snapshot_files(discovery.list_files(source, spark, stage), contract)
    files = stage.write(listed, "files")
    numbered = stage.write(discovery.snapshot_order(files), "numbered_files")
    first = first_change(tables.read_table(spark, f"{folder}/{job.STATE_FILES}"), numbered)
    late = F.lit(False) if first is None else F.col("snapshot_date") >= F.lit(first)
    read = workbooks.scan_workbooks(files.filter(late), contract)
    early = numbered.filter(~late).select("path")
    known = tables.read_table(spark, f"{folder}/{job.STATE_RECORDS}", read.schema).join(early, "path", "left_semi")
    records = stage.write(read.unionByName(known.select(*read.columns)), "records", partition_by=("record",))
    return job.ingest_records(files, numbered, records, contract, stage), first


def _build(
    spark: SparkSession, source: str | DataFrame, contract: Contract, output: str, current: tables.Published
) -> tuple[job.JobResult, str, Stage, dict[str, DataFrame]] | None:
    """Tables of a run that adds days, or nothing where the columns of the history change."""
    started, stage = datetime.now(UTC), Stage(spark)
    before = tables.open_published(spark, output)
    old, target = tables.run_folder(output, current.run_id), tables.run_folder(output, stage.run_id)
    ingested, first = _ingested(spark, source, contract, stage, old)
    schema = job.history_schema(ingested, contract)
    if sorted(schema.names) != sorted(before[tables.HISTORY].columns):
        stage.remove()
        return None
    parts, fresh = current.parts, None
    if first is not None:
        added = tables.Part(stage.run_id, first)
        tables.write_history(job.resolve_history(ingested.rows, contract), output, contract, stage.run_id)
        parts, fresh = tables.parts_after(current.parts, added), tables.read_history(spark, output, [added], schema)
    resolved = tables.read_history(spark, output, parts, schema)
    counted, latest, totals = _merged(spark, ingested, before, resolved, fresh, first, old, contract)
    by_day = tables.write_table(counted, target, job.STATE_COUNTERS)
    counters, issues = job.checked(spark, ingested, resolved, by_day, target, contract)
    latest = tables.write_table(latest.select(*schema.names), target, tables.LATEST)
    totals = tables.write_table(totals, target, tables.SUMMARY)
    result = job.finished(spark, (resolved, latest, totals, issues), counters, started, stage, target, output, parts)
    return result, target, stage, job.published_state(ingested)


def _merged(
    spark: SparkSession,
    ingested: job.Ingested,
    before: dict[str, DataFrame],
    resolved: DataFrame,
    fresh: DataFrame | None,
    first: date | None,
    folder: str,
    contract: Contract,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Counters by date, latest position and summary, from those of the published run and the rows written anew."""
    counters = tables.read_table(spark, f"{folder}/{job.STATE_COUNTERS}")
    if fresh is None:
        return counters, before[tables.LATEST], before[tables.SUMMARY]
    early = F.col("snapshot_date") < F.lit(first)
    kept = counters.filter(early).unionByName(job.day_counters(ingested, contract))
    latest = history.merged_latest(before[tables.LATEST], resolved.filter(early), fresh, first, contract)
    return kept, latest, history.merged_summary(before[tables.SUMMARY], fresh, first, contract)
