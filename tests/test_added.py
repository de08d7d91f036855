"""Days that are added to a published history, against a run over everything."""

from __future__ import annotations

from datetime import date
from pathlib import Path

from conftest import snapshot_sheets, write_snapshots

from tidemark.catalog.workbook_bytes import workbook_bytes
from tidemark.contract import Contract
from tidemark.plans.added import add_days
from tidemark.plans.job import run_job
from tidemark.sinks.tables import Part, newest, open_published, part_conditions, parts_after, register_catalog, remove_unused


def content(tables):
    return {name: (table.columns, sorted(map(str, table.collect()))) for name, table in tables.items()}


def add(folder: Path, snapshot: int, processes: int, day: date, name: str | None = None) -> Path:
    path = folder / (name or f"operations_snapshot_{day}.xlsx")
    path.write_bytes(workbook_bytes(snapshot_sheets(snapshot, processes, day)))
    return path


def written_dates(output: Path, run_id: str) -> set[str]:
    return {p.parent.name.removeprefix("snapshot_date=") for p in (output / "history" / f"run_id={run_id}").rglob("*.parquet")}


def test_added_changed_and_late_days_equal_a_run_over_everything(spark, tmp_path, contract):
    folder, output = tmp_path / "in", tmp_path / "out"
    folder.mkdir()
    write_snapshots(folder, 3, 10)
    first = add_days(spark, str(folder), contract, str(output))  # nothing is published yet
    assert first.history.count() == 30 and len(newest(spark, str(output)).parts) == 1
    register_catalog(spark, str(output), Contract(database_schema="added"))

    def late_and_gone():
        add(folder, 1, 9, date(2026, 8, 2))
        (folder / "operations_snapshot_2026-08-04.xlsx").unlink()
        (folder / "operations_without_date.xlsx").write_bytes(b"x")

    steps = [
        (lambda: add(folder, 3, 8, date(2026, 8, 4)), {"2026-08-04"}),  # two processes are gone
        (late_and_gone, {"2026-08-02", "2026-08-03"}),
    ]
    for number, (change, dates) in enumerate(steps):
        change()
        result = add_days(spark, str(folder), contract, str(output))
        assert written_dates(output, result.run_id) == dates
        full = run_job(spark, str(folder), contract, str(tmp_path / f"full-{number}"))
        assert content(open_published(spark, str(output))) == content(open_published(spark, str(tmp_path / f"full-{number}")))
        assert result.metrics == full.metrics
        assert spark.sql("SELECT count(*) FROM added.historical_operations").first()[0] == full.history.count()
    kept = {p.name for p in (output / "history").iterdir() if p.is_dir()}
    removed = remove_unused(spark, str(output))
    assert {f"history/{name}" for name in kept} - set(removed) == {f"history/run_id={p.run_id}" for p in newest(spark, str(output)).parts}
    assert open_published(spark, str(output))["history"].count() == 29


def test_another_contract_or_other_columns_make_a_full_run(spark, tmp_path, contract):
    folder, output = tmp_path / "in", tmp_path / "out"
    folder.mkdir()
    write_snapshots(folder, 2, 10)
    add_days(spark, str(folder), contract, str(output))
    sheets = {name: [(*rows[0], "Colour"), *[(*row, "red") for row in rows[1:]]] for name, rows in snapshot_sheets(2, 10, date(2026, 8, 3)).items()}
    (folder / "operations_snapshot_2026-08-03.xlsx").write_bytes(workbook_bytes(sheets))
    result = add_days(spark, str(folder), contract, str(output))
    assert len(newest(spark, str(output)).parts) == 1 and "colour" in result.history.columns
    assert written_dates(output, result.run_id) == {"2026-08-01", "2026-08-02", "2026-08-03"}
    add(folder, 3, 10, date(2026, 8, 4))
    other = Contract(hash_exclude=("owner",))
    assert written_dates(output, add_days(spark, str(folder), other, str(output)).run_id) >= {"2026-08-01", "2026-08-04"}


def test_parts():
    one, two, three = Part("a"), Part("b", date(2026, 1, 5)), Part("c", date(2026, 1, 3))
    assert parts_after([one], two) == [one, two]
    assert parts_after([one, two], three) == [one, three]
    assert parts_after([one, two], Part("d")) == [Part("d")]
    assert part_conditions([one]) == ["TRUE"]
    assert part_conditions([one, two]) == ["(snapshot_date < DATE'2026-01-05' OR snapshot_date IS NULL)", "snapshot_date >= DATE'2026-01-05'"]
