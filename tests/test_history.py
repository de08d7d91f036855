from __future__ import annotations

from datetime import date

import parity
import pytest
from pyspark.sql import functions as F

from tidemark.catalog import samples
from tidemark.catalog.oracle import ORACLE
from tidemark.contract import Contract
from tidemark.operators import analytics, cleaning, history, quality

SF = "/root/testdata/sf0.001"
STATE = "snapshot_date DATE, snapshot_order INT, sheet_order INT, source_row_number INT, line_id STRING, current_stage STRING"
DAY = date(2026, 8, 18)


def test_daily_state_keeps_the_last_sheet(spark, contract):
    rows = spark.createDataFrame(
        [(DAY, 1, 1, 2, "LINE-1", "Intake"), (DAY, 1, 2, 3, "LINE-1", "Approval")], STATE
    )
    assert [r["current_stage"] for r in history.daily_state(rows, contract).collect()] == ["Approval"]


def test_null_ids_form_one_group_and_null_order_wins(spark, contract):
    rows = spark.createDataFrame(
        [
            (DAY, 1, 1, 2, None, "a"),
            (DAY, 1, 1, 3, None, "b"),
            (DAY, None, 1, 2, "x", "newest"),
            (DAY, 9, 9, 9, "x", "older"),
            (None, 1, 1, 1, "y", "undated"),
            (DAY, 1, 1, 1, "y", "dated"),
        ],
        STATE,
    )
    daily = {(r["line_id"], r["current_stage"]) for r in history.daily_state(rows, contract).collect()}
    assert daily == {(None, "b"), ("x", "newest"), ("y", "undated"), ("y", "dated")}
    latest = {(r["line_id"], r["current_stage"]) for r in history.latest_position(rows, contract).collect()}
    assert latest == {(None, "b"), ("x", "newest"), ("y", "undated")}


def test_derived_columns(spark, contract):
    rows = spark.createDataFrame(
        [(DAY, 1, "f", "s", 1, 2, "LINE-1", "15/08/2026 - reviewed")],
        "snapshot_date DATE, snapshot_order INT, source_file STRING, source_sheet STRING, "
        "sheet_order INT, source_row_number INT, line_id STRING, follow_up_notes STRING",
    )
    row = history.add_derived(rows, contract).first()
    assert row["follow_up_age_days"] == 3
    assert len(row["record_hash"]) == 16
    moved = rows.withColumn("source_row_number", F.lit(99)).withColumn("source_file", F.lit("g"))
    assert history.add_derived(moved, contract).first()["record_hash"] == row["record_hash"]


def test_a_date_cell_in_the_notes_is_the_follow_up_date(spark, contract):
    rows = spark.createDataFrame(
        [(DAY, "L", "2026-08-05", date(2026, 8, 5)), (DAY, "L", "2026-08-05", None)],
        "snapshot_date DATE, line_id STRING, follow_up_notes STRING, _note_cell_date DATE",
    )
    found = history.add_follow_up(rows, contract)
    assert "_note_cell_date" not in found.columns
    assert [r["follow_up_date"] for r in found.collect()] == [date(2026, 8, 5), date(2026, 5, 8)]


def test_hash_columns_can_be_left_out(spark):
    contract = Contract(hash_exclude=("SLA Days Remaining",))
    rows = spark.createDataFrame(
        [("L", 1, "n"), ("L", 2, "n")], "line_id STRING, sla_days_remaining INT, follow_up_notes STRING"
    )
    hashed = history.add_record_hash(rows, contract)
    assert hashed.select("record_hash").distinct().count() == 1


def test_empty_history(spark, contract):
    empty = samples.mapped(spark, SF).limit(0)
    assert history.daily_state(empty, contract).count() == 0
    assert history.summary(empty, contract).columns == [
        "snapshot_date", "source_file", "source_sheet", "record_count", "unique_processes",
    ]


@pytest.fixture(scope="module")
def resolved(spark):
    daily = history.daily_state(samples.mapped(spark, SF), samples.CONTRACT)
    return history.add_derived(daily, samples.CONTRACT, samples.HASHED)


def answer(question: str, name: str) -> tuple:
    """One row that DuckDB gives over the SQL of a registered query."""
    with parity.connect(SF) as connection:
        return connection.execute(question.format(ORACLE[name])).fetchone()


def test_totals_of_the_mapped_fixture(spark, resolved):
    contract = samples.CONTRACT
    assert resolved.count() == 397
    assert history.latest_position(resolved, contract).count() == 15
    per_sheet = history.summary(resolved, contract)
    assert tuple(per_sheet.agg(F.count("*"), F.sum("record_count")).first()) == (127, 397)
    per_day = analytics.processes_by_date(resolved, contract)
    assert tuple(per_day.agg(F.count("*"), F.sum("unique_processes")).first()) == (30, 397)
    overdue = {tuple(r) for r in analytics.overdue_by_stage(resolved, contract).collect()}
    assert overdue == {("click", 6), ("view", 3), ("NO STAGE", 2), ("error", 2)}
    stale = analytics.stale_follow_ups(resolved, contract)
    expected = answer("SELECT count(*), max(follow_up_age_days) FROM ({})", "q4_stale_follow_ups")
    assert tuple(stale.agg(F.count("*"), F.max("follow_up_age_days")).first()) == expected and expected[0] > 0
    assert analytics.state_changes(resolved, contract).count() == answer("SELECT count(*) FROM ({})", "q5_state_changes")[0]
    counts = quality.history_counts(resolved, contract).first()
    codes = ("FUTURE_FOLLOW_UP_DATE", "INVALID_SLA_VALUE", "MISSING_FOLLOW_UP")
    for code in codes:
        assert counts[code] == answer(f"SELECT count FROM ({{}}) WHERE code = '{code}'", "rule_issues")[0] > 0
    hashes = resolved.agg(F.min("record_hash"), F.max("record_hash")).first()
    assert tuple(hashes) == answer("SELECT min(record_hash), max(record_hash) FROM ({})", "derived")


def test_totals_of_the_dirty_fixture(spark):
    contract = samples.DIRTY_CONTRACT
    dirty = samples.dirty(spark, SF)
    assert dirty.count() == 1100
    assert cleaning.drop_blank_rows(dirty, contract).count() == 1089
    collapsed = cleaning.collapse_sheets(dirty, contract)
    totals = cleaning.clean_metrics(collapsed, contract, scope=()).first()
    sums = "SELECT sum(raw_rows), sum(rows_without_id), sum(exact_duplicates), sum(clean_rows) FROM ({})"
    assert tuple(totals) == answer(sums, "clean_metrics")
    clean = cleaning.clean(dirty, contract)
    checks = clean.agg(
        F.count_if(F.col("sla_days_remaining").isNull()), F.count_if(F.col("start_date").isNull()),
        F.sum("sla_days_remaining"), F.sum("source_row_number"),
    )
    assert tuple(checks.first()) == answer(
        "SELECT count(*) FILTER (sla_days_remaining IS NULL), count(*) FILTER (start_date IS NULL), "
        "sum(sla_days_remaining), sum(source_row_number) FROM ({})", "clean",
    )


def test_state_changes_bridge_gaps_in_dates(spark, contract):
    rows = spark.createDataFrame(
        [
            (date(2026, 8, 1), 1, 1, 2, "L", "a", "h1"),
            (date(2026, 8, 2), 2, 1, 2, "L", "b", "h1"),
            (date(2026, 8, 9), 3, 1, 2, "L", "c", "h2"),
            (date(2026, 8, 9), 3, 1, 3, "M", "d", "h9"),
        ],
        STATE + ", record_hash STRING",
    )
    found = analytics.state_changes(rows, contract).collect()
    assert [tuple(r) for r in found] == [(date(2026, 8, 9), "L", "c")]


def test_union_fills_gaps_with_null(spark):
    left = spark.createDataFrame([(1, "a")], "k INT, x STRING")
    right = spark.createDataFrame([(2, "b")], "k INT, y STRING")
    joined = history.union_snapshots([left, right])
    assert sorted(map(tuple, joined.collect())) == [(1, "a", None), (2, None, "b")]
