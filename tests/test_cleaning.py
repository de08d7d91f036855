from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tidemark.contract import Contract
from tidemark.operators import cleaning

COLUMNS = "source_file STRING, source_sheet STRING, source_row_number INT, line_id STRING, stage STRING, sla_days_remaining STRING, start_date STRING"


def rows_of(spark, *rows):
    return spark.createDataFrame([("f", "s", *row) for row in rows], COLUMNS)


def test_clean_removes_blank_rows_missing_ids_and_copies(spark, contract):
    rows = rows_of(
        spark,
        (2, "1", " Approval ", "2", "2026-08-01"),
        (3, "1.0", "Approval", "2.0", "01/08/2026"),
        (4, None, "Intake", "4", None),
        (5, None, None, None, None),
        (6, "  ", None, None, None),
    )
    cleaned = cleaning.clean(rows, contract).collect()
    assert [tuple(row)[2:] for row in cleaned] == [(3, "1", "Approval", 2, date(2026, 8, 1))]

    collapsed = cleaning.collapse_sheets(rows, contract)
    assert cleaning.clean_rows(collapsed, contract).collect() == cleaned
    counters = cleaning.clean_metrics(collapsed, contract).first().asDict()
    assert counters == {
        "source_file": "f", "source_sheet": "s",
        "raw_rows": 5, "rows_without_id": 2, "exact_duplicates": 1, "clean_rows": 1,
    }


def test_counting_by_digest_equals_counting_by_content(spark, contract):
    rows = rows_of(
        spark,
        (2, "1", "ab", "c", None), (3, "1", "ab", "c", None), (4, "1", "a", "bc", None),
        (5, None, "x", None, None), (6, None, "x", None, None), (7, None, None, None, None),
        (8, "2", None, "1", None), (9, "2", "-", None, None), (10, "2", None, "1.0", None),
    )
    exact = cleaning.clean_metrics(cleaning.collapse_sheets(rows, contract), contract)
    marked = cleaning.digested_values(rows, contract)
    narrow = cleaning.collapse_digests(marked, contract, cleaning.SHEET_SCOPE)
    assert cleaning.clean_metrics(narrow, contract).collect() == exact.collect()
    assert exact.first()["exact_duplicates"] == 2


def test_copies_are_found_within_one_worksheet_only(spark, contract):
    first = rows_of(spark, (2, "1", "a", None, None), (9, "1", "a", None, None))
    second = first.withColumn("source_sheet", F.lit("t"))
    kept = cleaning.drop_exact_duplicates(first.unionByName(second))
    assert sorted((r["source_sheet"], r["source_row_number"]) for r in kept.collect()) == [
        ("s", 9),
        ("t", 9),
    ]


def test_result_does_not_depend_on_row_order_or_partitions(spark, contract):
    rows = spark.range(3000).select(
        F.lit("f").alias("source_file"),
        F.concat(F.lit("s"), F.col("id") % 3).alias("source_sheet"),
        F.col("id").cast("int").alias("source_row_number"),
        # one id holds a third of the rows
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 100).cast("string")).alias("line_id"),
        (F.col("id") % 7).cast("string").alias("stage"),
        F.lit("5").alias("sla_days_remaining"),
        F.lit(None).cast("string").alias("start_date"),
    )
    expected = sorted(map(tuple, cleaning.clean(rows, contract).collect()))
    shuffled = rows.repartition(7, F.rand(3)).sortWithinPartitions(F.rand(5))
    assert sorted(map(tuple, cleaning.clean(shuffled, contract).collect())) == expected


def test_other_names_and_formats(spark):
    contract = Contract(
        required_columns=("Key",), id_column="Key", number_columns=("Days",),
        date_columns=("Opened",), date_formats=("dd.MM.yyyy",),
    )
    rows = spark.createDataFrame(
        [("f", "s", 2, "7.0", "3.0", "24.12.2025")],
        "source_file STRING, source_sheet STRING, source_row_number INT, key STRING, days STRING, opened STRING",
    )
    assert tuple(cleaning.clean(rows, contract).first())[3:] == ("7", 3, date(2025, 12, 24))


def test_one_date_format_per_worksheet_by_vote(spark):
    """In each worksheet the format that most values fit; equals go to the first, and a worksheet without a date has none."""
    contract = Contract(date_columns=("DUE_DATE",), date_formats=("dd/MM/yyyy", "MM/dd/yyyy"), date_format_by_worksheet=True)
    sheets = {
        "day first": ["01/02/2026", "13/02/2026", "12/31/2026", None, " 14/02/2026 "],
        "month first": ["01/02/2026", "02/13/2026", "02/14/2026", "13/02/2026", "2026-03-04 00:00:00"],
        "either": ["01/02/2026", "03/04/2026"],
        "none": ["soon", None],
    }
    rows = [(name, i, f"k{i}", value) for name, values in sheets.items() for i, value in enumerate(values)]
    frame = spark.createDataFrame(rows, "source_sheet STRING, source_row_number INT, line_id STRING, due_date STRING").repartition(3)
    found = {name: [] for name in sheets}
    for r in cleaning.clean_values(frame, contract).orderBy("source_row_number").collect():
        found[r.source_sheet].append(None if r.due_date is None else r.due_date.isoformat())
    assert found == {
        "day first": ["2026-02-01", "2026-02-13", None, None, "2026-02-14"],
        "month first": ["2026-01-02", "2026-02-13", "2026-02-14", None, "2026-03-04"],
        "either": ["2026-02-01", "2026-04-03"],
        "none": [None, None],
    }
    assert cleaning.clean_values(frame.limit(0), contract).collect() == []
