"""Snapshot tables derived from the given ``events`` table.

``events`` has five event types (the worksheets), one snapshot per day, users (the
processes) and a unique ``event_id`` (the row order).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.workbook_bytes import workbook_bytes
from tidemark.contract import ROW_PATH, ROW_SHEET, Contract
from tidemark.functions.text import canonical_label
from tidemark.functions.values import sla_status
from tidemark.operators import contracts

FIRST_DAY = "2024-01-01"
SHEETS = ("error", "signup", "purchase", "view", "click")
HASHED = ("current_stage", "follow_up_notes", "line_id", "request_id", "sla_days_remaining")
DIRTY_COLUMNS = ("line_id", "request_id", "current_stage", "sla_days_remaining", "start_date")
WORKBOOK_ROWS = 20_000  # event ids per derived workbook, which bounds the size of a file
DROP_FOLDER = "/drop"

CONTRACT = Contract(
    expected_sheets=SHEETS,
    required_columns=("line_id", "request_id", "current_stage", "sla_days_remaining"),
)
DIRTY_CONTRACT = Contract(
    expected_sheets=SHEETS, required_columns=DIRTY_COLUMNS, date_columns=("start_date",)
)
WORKBOOK_CONTRACT = Contract(
    expected_sheets=SHEETS,
    required_columns=(
        "line_id", "request_id", "current_stage", "sla_days_remaining", "follow_up_notes",
    ),
    date_columns=("start_date",),
    allow_empty_sheets=True,
)


VOTED_CONTRACT = Contract(
    expected_sheets=SHEETS, required_columns=("line_id",), date_columns=("start_date",),
    date_formats=("dd/MM/yyyy", "MM/dd/yyyy", "yyyy-MM-dd"), date_format_by_worksheet=True,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def every(divisor: int) -> Column:
    return F.col("event_id") % divisor == 0


def _day() -> Column:
    return F.col("ts").cast("date")


def mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as snapshot rows, typed and with a note to find a date in."""
    day, key = _day(), F.col("event_id")
    noted = F.date_format(F.date_sub(day, (key % 6).cast("int")), "dd/MM/yyyy")
    note = (
        F.when(every(11), None)
        .when(every(7), "no date")
        .when(every(19), "31/12 - carried")
        .when(every(23), "31/02/2024 - bad")
        .when(every(29), "10/02 - planned")
        .when(every(31), F.concat(F.date_format(day, "d-M-yy"), F.lit(" short year")))
        .when(every(37), "29/02 - leap day")
        .when(every(41), "29/02/2023 - no such day")
        .when(every(43), "1/1/999 - three digits")
        .when(every(47), "01-01-2300 - out of range")
        .otherwise(F.concat(noted, F.lit(" - reviewed")))
    )
    sla = (F.floor(F.col("value") / 10) - 10).cast("int")
    return table(spark, sf_dir, "events").select(
        day.alias("snapshot_date"),
        (F.datediff(day, F.lit(FIRST_DAY)) + 1).alias("snapshot_order"),
        F.concat(F.lit("operations_snapshot_"), day.cast("string"), F.lit(".xlsx")).alias(
            "source_file"
        ),
        F.col("event_type").alias("source_sheet"),
        F.array_position(contracts.texts(SHEETS), F.col("event_type")).cast("int").alias(
            "sheet_order"
        ),
        (key + 2).alias("source_row_number"),
        F.concat(F.lit("LINE-"), F.col("user_id")).alias("line_id"),
        F.concat((key % 97).cast("string"), F.lit(".0")).alias("request_id"),
        F.when(every(13), None).otherwise(F.col("event_type")).alias("current_stage"),
        F.when(every(17), None).otherwise(sla).alias("sla_days_remaining"),
        note.alias("follow_up_notes"),
    )


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source columns as text, with duplicates, blanks, padding and unreadable values."""
    events = table(spark, sf_dir, "events")
    day, key = _day(), F.col("event_id")
    sla = (F.floor(F.col("value") / 10) - 10).cast("int").cast("string")
    source = {
        "line_id": F.when(every(37), None)
        .when(every(41), "   ")
        .when(every(83), "\u00a0\u2003")
        .otherwise(F.concat(F.lit("LINE-"), F.col("user_id"))),
        "request_id": F.concat(
            F.when(every(19), "-").when(every(23), "R-").otherwise(""),
            (key % 97).cast("string"),
            F.when(every(29), ".05").when(every(3), ".000").otherwise(".0"),
        ),
        "current_stage": F.when(every(13), None).otherwise(
            F.when(every(3), F.concat(F.lit("\t "), F.col("event_type"), F.lit(" \t")))
            .when(every(7), F.concat(F.lit("\u00a0"), F.col("event_type"), F.lit("\u3000\x85")))
            .otherwise(F.col("event_type"))
        ),
        "sla_days_remaining": F.when(every(17), "n/a")
        .when(every(31), "1,000")
        .when(every(43), "5d")
        .when(every(47), "2.5")
        .when(every(59), "+5")
        .when(every(61), "1e1")
        .when(every(67), ".5")
        .when(every(71), "7.")
        .when(every(73), "-12.00")
        .otherwise(sla),
        "start_date": F.when(every(53), "x")
        .when(every(5), F.date_format(day, "dd/MM/yyyy"))
        .otherwise(day.cast("string")),
    }
    copies = F.when(every(10), F.array(F.lit(0), F.lit(1_000_000))).otherwise(F.array(F.lit(0)))
    rows = events.select("*", F.explode(copies).alias("shift"))
    return rows.select(
        day.alias("snapshot_date"),
        F.concat(F.lit("operations_snapshot_"), day.cast("string"), F.lit(".xlsx")).alias(
            "source_file"
        ),
        F.col("event_type").alias("source_sheet"),
        F.array_position(contracts.texts(SHEETS), F.col("event_type")).cast("int").alias(
            "sheet_order"
        ),
        (key + 2 + F.col("shift")).alias("source_row_number"),
        *[F.when(~every(101), value).alias(name) for name, value in source.items()],
        (F.datediff(day, F.lit(FIRST_DAY)) + 1).alias("snapshot_order"),
    )


def mixed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates as text; most values of a worksheet have one format, and a fifth another that often fits too."""
    day, key = _day(), F.col("event_id")
    sheet = F.array_position(contracts.texts(SHEETS), F.col("event_type")).cast("int")
    style = (F.dayofyear(day) + sheet + F.when(every(5), 1).otherwise(0)) % 3
    start = F.date_sub(day, (key % 40).cast("int"))
    written = F.when(style == 0, F.date_format(start, "dd/MM/yyyy")).when(style == 1, F.date_format(start, "MM/dd/yyyy"))
    text = F.when(every(11), None).when(every(13), "soon").otherwise(F.coalesce(written, start.cast("string")))
    return table(spark, sf_dir, "events").select(
        day.alias("snapshot_date"),
        F.concat(F.lit("operations_snapshot_"), day.cast("string"), F.lit(".xlsx")).alias("source_file"),
        F.col("event_type").alias("source_sheet"),
        (key + 2).alias("source_row_number"),
        F.concat(F.lit("LINE-"), F.col("user_id")).alias("line_id"),
        F.when(every(7), F.concat(F.lit(" "), text, F.lit(" "))).otherwise(text).alias("start_date"),
    )


def site_path() -> Column:
    """Path of the file a user's events of one day came in, in nine spellings; some names and folders look hidden."""
    day, user = _day(), F.col("user_id")
    style = (user + F.dayofmonth(day)) % 9
    start = F.when(style == 0, "Operations_").when(style == 2, "snapshot_").when(style == 5, "~$operations_")
    written = (
        F.when(style == 1, F.date_format(day, "dd.MM.yyyy"))
        .when(style == 2, F.date_format(day, "dd_MM_yyyy"))
        .when(style == 3, "31-02-2024")
        .when(style == 4, "latest")
        .when(style == 7, F.concat(F.lit("1"), day.cast("string")))
        .when(style == 8, F.concat(F.lit("2024-13-05 "), F.date_format(day, "dd.MM.yyyy")))
        .otherwise(day.cast("string"))
    )
    end = F.when(style == 1, ".xlsm").when(style == 6, ".csv").otherwise(".xlsx")
    hidden = F.when(user % 7 == 3, "_").when(user % 7 == 5, ".").otherwise("")
    folder = F.concat(F.lit(f"{DROP_FOLDER}/"), hidden, F.lit("area"), user % 7, F.lit("/"))
    start = F.when(user % 10 == 4, F.concat(F.lit("_"), F.coalesce(start, F.lit("operations_")))).when(user % 10 == 8, ".operations_").otherwise(start)
    site = F.concat(F.lit("site"), user, F.lit("s_"))
    return F.concat(folder, F.coalesce(start, F.lit("operations_")), site, written, end)


def site_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file a user's events of one day came in."""
    return table(spark, sf_dir, "events").select(site_path().alias("path")).distinct()


def site_file() -> Column:
    return F.concat(F.lit("site"), F.col("user_id"), F.lit("_"), _day().cast("string"), F.lit(".xlsx"))


def site_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as rows of the files in :func:`site_paths`, by worksheet."""
    return table(spark, sf_dir, "events").select(
        site_path().alias(ROW_PATH),
        canonical_label(F.col("event_type")).alias(ROW_SHEET),
        (F.col("event_id") + 2).alias("source_row_number"),
        F.concat(F.lit("LINE-"), F.col("user_id")).alias("line_id"),
    )


def site_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workbook and worksheet name of every event; some names collide or are not expected."""
    name = (
        F.when(every(11), F.concat(F.lit("Notes "), F.col("event_id") % 3))
        .when(every(5), F.concat(F.lit(" "), F.upper("event_type"), F.lit("! ")))
        .otherwise(F.col("event_type"))
    )
    events = table(spark, sf_dir, "events")
    return events.select(site_file().alias("source_file"), name.alias("source_sheet"))


def site_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers of every worksheet of the site files; some collide."""
    sheets = (
        table(spark, sf_dir, "events")
        .groupBy(site_file().alias("source_file"), F.col("event_type").alias("source_sheet"))
        .agg(F.min("event_id").alias("event_id"))
    )
    headers = F.concat(
        F.array(F.lit("Line Id"), F.lit("Request Id"), F.lit("Situação"), F.lit("SLA Days")),
        F.when(every(3), F.array(F.lit("LINE-ID"))).otherwise(contracts.texts([])),
        F.when(every(7), F.array(F.lit("situacao "), F.lit("Status"))).otherwise(contracts.texts([])),
    )
    cells = sheets.select("source_file", "source_sheet", F.explode(headers).alias("header"))
    return cells.groupBy("source_file", "source_sheet").agg(
        F.collect_list(canonical_label(F.col("header"))).alias("header_keys")
    )


def workbook_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the derived workbook each belongs to."""
    day = _day()
    part = F.floor(F.col("event_id") / WORKBOOK_ROWS)
    name = F.concat(
        F.lit("operations_"), day.cast("string"), F.lit("_part"), part.cast("string"), F.lit(".xlsx")
    )
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit(f"{DROP_FOLDER}/"), name).alias("path"),
        day.alias("start_date"),
        "event_id",
        "event_type",
        F.concat(F.lit("LINE-"), F.col("user_id")).alias("line_id"),
        (F.col("event_id") % 97).cast("double").alias("request_id"),
        F.when(every(13), "N/A")
        .otherwise(F.concat(F.lit(" "), F.col("event_type")))
        .alias("current_stage"),
        (F.floor(F.col("value") / 10) - 10).cast("int").alias("sla_days_remaining"),
        F.when(every(31), None)
        .otherwise(F.concat(F.date_format(day, "dd/MM"), F.lit(" - reviewed")))
        .alias("note_text"),
        F.when(every(31), F.date_sub(day, 3)).alias("note_date"),
    )


_HEADER = (
    "Line Id", "Request-Id", "Current Stage", "SLA Days Remaining", "SLA Status",
    "Follow Up Notes", "Start Date", "Unnamed: 7",
)


def workbook_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workbook files (``path``, ``content``) of the events; a file holds a bounded id range."""
    rows = workbook_rows(spark, sf_dir).withColumn(
        "sla_status", sla_status(F.col("sla_days_remaining"))
    )

    def build(batch: pd.DataFrame) -> pd.DataFrame:
        ordered = batch.sort_values("event_id")
        sheets = {
            f" {name.title()} ": [_HEADER, *_sheet_values(group)]
            for name, group in ordered.groupby("event_type")
        }
        sheets["Remarks"] = [("Remark",)]
        return pd.DataFrame({"path": [batch["path"].iloc[0]], "content": [workbook_bytes(sheets)]})

    return rows.groupBy("path").applyInPandas(build, "path STRING, content BINARY")


def _sheet_values(rows: pd.DataFrame) -> Iterator[tuple]:
    """Worksheet rows, with an empty one after every row whose event id divides by fifty."""
    dated = rows["note_date"].notna()
    note = rows["note_text"].where(~dated, rows["note_date"])
    columns = [rows[c] for c in ("line_id", "request_id", "current_stage", "sla_days_remaining")]
    for event, *row in zip(rows["event_id"], *columns, rows["sla_status"], note, rows["start_date"], strict=True):
        yield (*row, "x")
        if event % 50 == 0:
            yield ()


FLAWS = ("cut short", "sheet missing", "sheet too many", "stage missing", "none", "undated")


def _flaw(day: Column) -> Column:
    return F.dayofmonth(day) % len(FLAWS)


def flawed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workbook rows with the flaw of their file; files of every sixth day have no date in their name."""
    rows = workbook_rows(spark, sf_dir).withColumn("flaw", _flaw(F.col("start_date")))
    undated = F.concat(F.lit(f"{DROP_FOLDER}/late"), F.dayofyear("start_date"), F.regexp_extract("path", "_part.*", 0))
    return rows.withColumn("path", F.when(F.col("flaw") == FLAWS.index("undated"), undated).otherwise(F.col("path")))


def flawed_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workbook files with the flaw of their day: every issue that files and worksheets can have."""
    rows = flawed_rows(spark, sf_dir).withColumn("sla_status", sla_status(F.col("sla_days_remaining")))
    stage = _HEADER.index("Current Stage")

    def build(batch: pd.DataFrame) -> pd.DataFrame:
        flaw = FLAWS[batch["flaw"].iloc[0]]
        groups = dict(list(batch.sort_values("event_id").groupby("event_type")))
        if flaw == "sheet missing":
            groups.pop("view", None)
        sheets = {name.title(): [_HEADER, *_sheet_values(group)] for name, group in groups.items()}
        if flaw == "stage missing":
            sheets = {n: [row[:stage] + row[stage + 1 :] for row in rows] for n, rows in sheets.items()}
        if flaw == "sheet too many":
            sheets |= {"Notes": [("x",)], "More notes": [("x",)]}
        content = workbook_bytes(sheets)
        if flaw == "cut short":
            content = content[: len(content) // 2]
        return pd.DataFrame({"path": [batch["path"].iloc[0]], "content": [content]})

    return rows.groupBy("path").applyInPandas(build, "path STRING, content BINARY")


def damaged_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The workbook files, those of every fifth day cut short."""
    day = F.dayofmonth(F.regexp_extract("path", r"(\d{4}-\d{2}-\d{2})", 1).cast("date"))
    half = F.substring(F.col("content"), F.lit(1), (F.length("content") / 2).cast("int"))
    whole = workbook_contents(spark, sf_dir)
    return whole.withColumn("content", F.when(day % 5 == 0, half).otherwise(F.col("content")))


def workbook_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workbook_rows(spark, sf_dir).select("path").distinct()
