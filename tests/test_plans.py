"""Plans, not results: what must hold at any size."""

from __future__ import annotations

import pytest

from tidemark.catalog.queries import QUERIES
from tidemark.catalog.samples import CONTRACT
from tidemark.operators import cleaning, history

SF = "/root/testdata/sf0.001"
READERS = {"read_workbooks", "read_failures", "history_from_workbooks"}


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_pairs_rows_freely_or_runs_python_after_the_reader(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    if name not in READERS - {"history_from_workbooks"}:
        assert "Python" not in plan and "MapInArrow" not in plan


@pytest.mark.parametrize("name", ["daily_state", "latest_position", "q2_current_position", "daily_state_orders"])
def test_only_one_candidate_per_key_leaves_a_map_task(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    partial = [line for line in plan.splitlines() if "WindowGroupLimit" in line and "Partial" in line]
    assert partial


def test_state_changes_shuffle_rows_once_per_grain(spark):
    plan = plan_of(QUERIES["q5_state_changes"](spark, SF))
    # by (date, process), by process, and the sort of the result
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("Exchange rangepartitioning") == 1


def test_derived_columns_need_no_shuffle(spark, tmp_path):
    QUERIES["daily_state"](spark, SF).write.parquet(str(tmp_path / "daily"))
    daily = spark.read.parquet(str(tmp_path / "daily"))
    plan = plan_of(history.add_derived(daily, CONTRACT))
    assert "Exchange" not in plan and "Generate" not in plan


def test_a_date_filter_reaches_the_files(spark, tmp_path):
    from tidemark.sinks.tables import write_history

    daily = QUERIES["daily_state"](spark, SF)
    written = write_history(daily, str(tmp_path), CONTRACT)
    assert written.columns == daily.columns
    plan = plan_of(written.filter("snapshot_date = DATE'2024-01-05' AND line_id = 'LINE-3'").select("line_id"))
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan
    assert "EqualTo(line_id,LINE-3)" in plan
    assert "ReadSchema: struct<line_id:string>" in plan


def test_a_hot_process_reaches_its_task_as_few_rows(spark):
    """A third of the rows in one group: the shuffle carries one row per map task of it."""
    rows = spark.range(30_000, numPartitions=4).selectExpr(
        "DATE'2026-08-01' AS snapshot_date", "1 AS snapshot_order", "1 AS sheet_order",
        "id AS source_row_number", "IF(id % 3 = 0, 'hot', CAST(id AS STRING)) AS line_id",
    )
    daily = history.daily_state(rows, CONTRACT)
    assert daily.count() == 20_001
    assert daily.filter("line_id = 'hot'").first()["source_row_number"] == 29_997


def test_the_job_shuffles_its_rows_only_to_resolve_them(spark, sample_dir, monkeypatch):
    from tidemark.plans import job
    from tidemark.staging import Stage

    plans, write = {}, Stage.write

    def recorded(stage, frame, name, partition_by=()):
        plans[name] = plan_of(frame)
        return write(stage, frame, name, partition_by)

    monkeypatch.setattr(Stage, "write", recorded)
    ingested = job.ingest(spark, str(sample_dir), CONTRACT.__class__(), Stage(spark))
    for name in ("records", "rows"):
        assert "Exchange hashpartitioning" not in plans[name]
        assert "SortMergeJoin" not in plans[name]
    resolved = plan_of(job.resolve_history(ingested.rows, CONTRACT.__class__()))
    assert resolved.count("Exchange hashpartitioning") == 1
    pushed = resolved.split("PushedFilters: ")[1].split("]")[0]
    assert "_blank_row" in pushed and "IsNotNull(line_id)" in pushed
    for name in ("sheets", "rows"):
        assert "Python" not in plans[name] and "MapInArrow" not in plans[name]
    # the cells are read once: by the typed rows
    assert [name for name in plans if "cells:array" in plans[name]] == ["rows"]
    counted = plan_of(cleaning.collapse_digests(ingested.rows, CONTRACT.__class__(), ("snapshot_order",)))
    read = counted.split("ReadSchema: ")[1].split(">")[0]
    assert read == "struct<snapshot_order:int,line_id:string,_blank_row:boolean,_digest:string"
