"""The whole job on workbook files."""

from __future__ import annotations

import json
from datetime import date, timedelta
from pathlib import Path

import duckdb
import pytest
from conftest import DAYS_LEFT, HEADER, process_row, snapshot_sheets, with_part

from tidemark import QualityGateError, TidemarkError, run_job
from tidemark.catalog.workbook_bytes import workbook_bytes
from tidemark.contract import Contract
from tidemark.operators import analytics, quality
from tidemark.plans import job
from tidemark.sinks.tables import current_run, open_published, register_catalog, register_views
from tidemark.staging import Stage, shared_folder

DAY = date(2026, 8, 1)


def write(folder: Path, name: str, sheets: dict) -> None:
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(workbook_bytes(sheets))


def fixture_answers(snapshots: int = 3, processes: int = 18) -> dict[str, list[tuple]]:
    """What the analytical functions must find in the fixture, by SQL over its rows."""
    con = duckdb.connect()
    con.execute(
        "CREATE TABLE states (day DATE, sheet VARCHAR, line VARCHAR, request VARCHAR, step VARCHAR, days INT, status VARCHAR, "
        "note VARCHAR, owner VARCHAR, site VARCHAR, started DATE, due DATE)"
    )
    for snapshot in range(snapshots):
        day = DAY + timedelta(days=snapshot)
        for sheet, rows in snapshot_sheets(snapshot, processes, day).items():
            con.executemany(f"INSERT INTO states VALUES ({', '.join('?' * 12)})", [(day, sheet, *row) for row in rows[1:]])
    con.execute("CREATE VIEW latest AS SELECT * FROM states QUALIFY row_number() OVER (PARTITION BY line ORDER BY day DESC) = 1")
    called = "strptime(regexp_extract(note, '[0-9]{2}/[0-9]{2}/[0-9]{4}'), '%d/%m/%Y')::DATE"
    questions = {
        "per_day": "SELECT count(DISTINCT line) FROM states GROUP BY day ORDER BY day",
        "overdue": "SELECT step, count(*) FROM latest WHERE days < 0 GROUP BY ALL ORDER BY 2 DESC, 1",
        "stale": f"SELECT line, date_diff('day', {called}, day) AS age FROM latest WHERE age > 3",
        "changes": "SELECT count(*) FROM (SELECT (started, due, days, status, step, note) IS DISTINCT FROM lag((started, due, days, status, step, note)) "
        "OVER w AS new, lag(line) OVER w AS before FROM states WINDOW w AS (PARTITION BY line ORDER BY day)) WHERE new AND before IS NOT NULL",
        "sheets": "SELECT day, sheet, count(*) FROM states GROUP BY ALL",
        "unnoted": "SELECT count(*) FROM states WHERE note IS NULL",
        "late": "SELECT count(*) FROM states WHERE days < 0",
    }
    return {name: con.execute(sql).fetchall() for name, sql in questions.items()}


def issues_of(spark, folder, contract):
    """Issues of a run, whether or not they block it."""
    ingested = job.ingest(spark, str(folder), contract, Stage(spark))
    resolved = job.resolve_history(ingested.rows, contract)
    counters = job.run_counters(ingested, resolved, contract)
    issues = job.run_issues(spark, ingested, resolved, counters, contract).collect()
    found = [(r["code"], r["severity"], r["count"], r["source_file"], r["source_sheet"]) for r in issues]
    return counters, sorted(found, key=str)


def test_job_builds_and_publishes_all_tables(spark, sample_dir, tmp_path, contract):
    output = str(tmp_path / "out")
    before = {p.name: p.read_bytes() for p in sample_dir.iterdir()}
    result = run_job(spark, str(sample_dir), contract, output, csv=True)
    assert {p.name: p.read_bytes() for p in sample_dir.iterdir()} == before
    assert result.metrics == {
        "files_discovered": 3,
        "files_processed": 3,
        "sheets_processed": 15,
        "records_read": 54,
        "records_after_cleaning": 54,
        "records_in_history": 54,
        "rows_without_id_removed": 0,
        "exact_duplicates_removed": 0,
        "daily_duplicates_removed": 0,
    }
    published = open_published(spark, output)
    assert {name: table.count() for name, table in published.items()} == {
        "history": 54,
        "latest_position": 18,
        "summary": 15,
        "quality_issues": 1,
    }
    assert [r["code"] for r in published["quality_issues"].collect()] == ["MISSING_FOLLOW_UP"]
    history, expected = published["history"], fixture_answers()
    assert history.select("snapshot_date", "line_id").distinct().count() == 54
    assert history.columns == result.history.columns == [
        "snapshot_date", "snapshot_order", "source_file", "source_sheet", "sheet_order", "line_id",
        "request_id", "current_stage", "sla_days_remaining", "sla_status", "follow_up_notes", "owner", "site",
        "start_date", "due_date", "source_row_number", "follow_up_date", "follow_up_age_days", "record_hash",
    ]
    types = dict(result.history.dtypes)
    assert (types["start_date"], types["sla_days_remaining"]) == ("date", "bigint")
    assert "." not in history.first()["request_id"]

    per_day = analytics.processes_by_date(history, contract).collect()
    assert [(r["unique_processes"],) for r in per_day] == expected["per_day"]
    overdue = analytics.overdue_by_stage(history, contract).collect()
    assert sorted(tuple(r) for r in overdue) == sorted(expected["overdue"]) != []
    stale = analytics.stale_follow_ups(history, contract).collect()
    assert sorted((r["line_id"], r["follow_up_age_days"]) for r in stale) == sorted(expected["stale"]) != []
    assert analytics.state_changes(history, contract).count() == expected["changes"][0][0] > 0
    sheets = sorted(tuple(r)[:3] for r in result.summary.select("snapshot_date", "source_sheet", "record_count").collect())
    assert sheets == sorted(expected["sheets"])

    (report,) = [json.loads(p.read_text()) for p in Path(result.output_paths["quality_report"]).glob("*.json")]
    assert report["status"] == "passed"
    assert report["metrics"]["records_in_history"] == 54
    assert result.report.first()["status"] == "passed"
    (issue,) = spark.read.json(result.output_paths["quality_report_issues"]).collect()
    assert (issue["code"], issue["severity"], issue["count"]) == ("MISSING_FOLLOW_UP", "info", expected["unnoted"][0][0])
    csv = spark.read.option("header", True).csv(result.output_paths["latest_position_csv"])
    assert csv.count() == 18

    register_views(published, contract)
    counted = spark.sql("SELECT count(*) AS n FROM historical_operations WHERE sla_days_remaining < 0")
    assert counted.first()["n"] == expected["late"][0][0]


_NEWEST = "snapshot_date DESC, snapshot_order DESC, sheet_order DESC, source_row_number DESC"
SQL = {
    "processes_by_date": "SELECT snapshot_date, count(DISTINCT line_id) AS unique_processes FROM {t} GROUP BY 1",
    "overdue_by_stage": "SELECT nvl(current_stage, 'NO STAGE') AS current_stage, count(*) AS overdue_processes FROM {l} "
    "WHERE sla_days_remaining < 0 GROUP BY 1",
    "stale_follow_ups": "SELECT line_id, request_id, current_stage, follow_up_date, follow_up_age_days FROM {l} "
    "WHERE follow_up_age_days > 3",
    "state_changes": "SELECT snapshot_date, line_id, current_stage FROM (SELECT *, lag(record_hash) OVER "
    "(PARTITION BY line_id ORDER BY snapshot_date, snapshot_order) AS before FROM {t}) WHERE before <> record_hash",
    "current_position": "SELECT * FROM {l}",
}


def test_sql_on_the_published_tables(spark, sample_dir, tmp_path, contract):
    output = str(tmp_path / "out")
    run_job(spark, str(sample_dir), contract, output)
    register_catalog(spark, output, contract)
    history = open_published(spark, output)["history"]
    table = "analytics.historical_operations"
    latest = (
        f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY line_id ORDER BY {_NEWEST}) "
        f"AS position_rank FROM {table}) WHERE position_rank = 1)"
    )
    for name, statement in SQL.items():
        found = spark.sql(statement.format(t=table, l=latest))
        expected = getattr(analytics, name)(history, contract)
        assert sorted(map(str, found.select(*expected.columns).collect())) == sorted(map(str, expected.collect())), name
    assert spark.table("analytics.latest_position").count() == 18
    assert dict(spark.table(table).dtypes)["snapshot_date"] == "date"


def test_job_without_output_keeps_its_tables_in_the_stage(spark, sample_dir):
    result = run_job(spark, str(sample_dir))
    assert (result.history.count(), result.output_paths) == (54, {})


def test_every_source_issue(spark, tmp_path, contract):
    good = snapshot_sheets(0, 18, DAY)
    write(tmp_path, "a_2026-08-01.xlsx", good | {"Extra": [("x",)], "alpha": [("x",)]})
    missing = {k: v for k, v in snapshot_sheets(1, 18, DAY).items() if k != "Overdue"}
    write(tmp_path, "b_2026-08-02.xlsx", missing)
    no_stage = [row[:2] + row[3:] for row in good["Overdue"]]
    write(tmp_path, "c_2026-08-03.xlsx", good | {"Overdue": no_stage})
    clash = [(*HEADER, "site "), *[(*row, "x") for row in good["Overdue"][1:]]]
    write(tmp_path, "d_2026-08-04.xlsx", good | {"Overdue": clash, " OVERDUE ": good["Overdue"]})
    write(tmp_path, "e_2026-08-05.xlsx", good | {"Overdue": [HEADER]})
    reserved = [(*HEADER, "Snapshot Date"), *[(*row, "x") for row in good["Overdue"][1:]]]
    write(tmp_path, "f_2026-08-06.xlsx", good | {"Overdue": reserved})
    (tmp_path / "g_2026-08-07.xlsx").write_bytes(workbook_bytes(good)[:500])
    (tmp_path / "h_2026-08-08.xlsx").touch()
    write(tmp_path, "undated.xlsx", good)
    counters, found = issues_of(spark, tmp_path, contract)
    missing_notes = sum(row[5] is None for rows in missing.values() for row in rows)
    expected = [
        ("MISSING_FOLLOW_UP", "info", missing_notes, None, None),
        ("MISSING_WORKSHEET", "error", 1, "b_2026-08-02.xlsx", "Overdue"),
        ("SNAPSHOT_DATE_NOT_FOUND", "warning", 1, "undated.xlsx", None),
        ("UNEXPECTED_SHEETS", "info", 2, "a_2026-08-01.xlsx", None),
        ("WORKBOOK_READ_FAILED", "error", 1, "g_2026-08-07.xlsx", None),
        ("WORKBOOK_READ_FAILED", "error", 1, "h_2026-08-08.xlsx", None),
        ("WORKSHEET_CONTRACT_FAILED", "error", 1, "c_2026-08-03.xlsx", "Overdue"),
        ("WORKSHEET_CONTRACT_FAILED", "error", 1, "d_2026-08-04.xlsx", None),
        ("WORKSHEET_CONTRACT_FAILED", "error", 1, "d_2026-08-04.xlsx", "Overdue"),
        ("WORKSHEET_CONTRACT_FAILED", "error", 1, "e_2026-08-05.xlsx", "Overdue"),
        ("WORKSHEET_CONTRACT_FAILED", "error", 1, "f_2026-08-06.xlsx", "Overdue"),
    ]
    assert found == sorted(expected, key=str)
    assert (counters["files_discovered"], counters["files_processed"]) == (9, 6)


def test_worksheet_names_that_collide_block_the_run(spark, tmp_path, contract):
    good = snapshot_sheets(0, 18, DAY)
    write(tmp_path, "d_2026-08-04.xlsx", good | {" OVERDUE ": good["Overdue"]})
    with pytest.raises(QualityGateError, match="count 1\\."):
        run_job(spark, str(tmp_path), contract)


def test_lenient_sheets_and_empty_sheets(spark, tmp_path):
    sheets, rows = snapshot_sheets(0, 18, DAY), [process_row(p, 0, DAY) for p in range(1, 19)]
    sheets["Overdue"] = [HEADER]
    del sheets["26 to 35 Days"]
    write(tmp_path / "in", "a_2026-08-01.xlsx", sheets)
    contract = Contract(strict_sheets=False, allow_empty_sheets=True)
    result = run_job(spark, str(tmp_path / "in"), contract)
    codes = {r["code"]: r["severity"] for r in result.issues.collect()}
    assert codes["MISSING_WORKSHEET"] == "warning"
    assert result.history.count() == 18 - sum(row[DAYS_LEFT] < 0 or row[DAYS_LEFT] > 25 for row in rows)
    with pytest.raises(QualityGateError):
        run_job(spark, str(tmp_path / "in"), Contract(strict_sheets=False))


def test_same_day_appearances_are_resolved(spark, tmp_path, contract):
    sheets = snapshot_sheets(0, 18, DAY)
    write(tmp_path / "in", "b_2026-08-01.xlsx", sheets)
    moved = process_row(1, 0, DAY)
    sheets["0 to 7 Days"] = [*sheets["0 to 7 Days"], (*moved[:2], "Moved", *moved[3:])]
    sheets["Overdue"] = [*sheets["Overdue"], sheets["Overdue"][1], (None, "REQ-1", "no id")]
    write(tmp_path / "in", "A_2026-08-01.xlsx", sheets)
    result = run_job(spark, str(tmp_path / "in"), contract)
    assert result.metrics["exact_duplicates_removed"] == 1
    assert result.metrics["rows_without_id_removed"] == 1
    assert result.metrics["daily_duplicates_removed"] == 19
    # the file that sorts last wins, whatever the case of its name
    assert {r["source_file"] for r in result.history.collect()} == {"b_2026-08-01.xlsx"}
    resolved = [r for r in result.issues.collect() if r["code"] == "DAILY_DUPLICATES_RESOLVED"]
    assert [(r["severity"], r["count"]) for r in resolved] == [("info", 19)]


def test_optional_columns_may_differ_between_files(spark, tmp_path, contract):
    plain = {name: [row[:6] for row in rows] for name, rows in snapshot_sheets(0, 18, DAY).items()}
    write(tmp_path / "in", "a_2026-08-01.xlsx", plain)
    # names the job itself uses for files and sheets are ordinary source columns
    odd = {
        name: [(*HEADER, "Path", "Sheet", "Copies", "Passes"), *[(*row, "p", 1.5, True, "q") for row in rows[1:]]]
        for name, rows in snapshot_sheets(1, 18, date(2026, 8, 2)).items()
    }
    write(tmp_path / "in", "b_2026-08-02.xlsx", odd)
    result = run_job(spark, str(tmp_path / "in"), contract)
    rows = {(r["snapshot_date"].day, r["path"], r["sheet"], r["copies"], r["passes"]) for r in result.history.collect()}
    assert rows == {(1, None, None, None, None), (2, "p", "1.5", "True", "q")}
    assert result.history.columns[5:8] == ["line_id", "request_id", "current_stage"]


def test_a_blocked_run_leaves_the_published_tables_alone(spark, sample_dir, tmp_path, contract):
    output = str(tmp_path / "out")
    with pytest.raises(TidemarkError, match="Nothing has been published"):
        current_run(spark, output)
    run_job(spark, str(sample_dir), contract, output)
    first = current_run(spark, output)
    write(sample_dir, "bad_2026-08-09.xlsx", {"Overdue": [HEADER]})
    with pytest.raises(QualityGateError, match="Nothing is published") as blocked:
        run_job(spark, str(sample_dir), contract, output)
    issues = spark.read.parquet(str(blocked.value).split("See ")[1].rstrip("."))
    assert {r["source_file"] for r in issues.filter("severity = 'error'").collect()} == {
        "bad_2026-08-09.xlsx"
    }
    assert current_run(spark, output) == first
    (sample_dir / "bad_2026-08-09.xlsx").write_bytes(
        workbook_bytes(snapshot_sheets(3, 18, date(2026, 8, 9)))
    )
    again = run_job(spark, str(sample_dir), contract, output)
    assert current_run(spark, output) != first
    assert open_published(spark, output)["history"].count() == 72
    assert open_published(spark, output)["history"].columns == again.history.columns


def test_registered_views_follow_the_published_run(spark, sample_dir, tmp_path):
    contract = Contract(database_schema="follows")
    output = str(tmp_path / "out")
    run_job(spark, str(sample_dir), contract, output)
    register_catalog(spark, output, contract)
    counted = "SELECT count(*) AS n FROM follows.historical_operations"
    assert spark.sql(counted).first()["n"] == 54
    sheets = {name: [(*rows[0], "Ward"), *[(*row, "w") for row in rows[1:]]] for name, rows in snapshot_sheets(3, 18, DAY).items()}
    write(sample_dir, "more_2026-08-09.xlsx", sheets)
    result = run_job(spark, str(sample_dir), contract, output)
    assert spark.sql(counted).first()["n"] == 72
    assert spark.sql("SELECT * FROM follows.historical_operations").columns == result.history.columns
    assert spark.table("follows.latest_position").count() == 18
    register_catalog(spark, output, contract)
    assert len(list((tmp_path / "out" / "catalog").glob("*.json"))) == 1


def test_no_file_is_passed_over_for_its_name(spark, tmp_path, contract):
    names = ("a_2026-08-01.xlsx", "_b_2026-08-02.xlsx", "_archive/c_2026-08-03.xlsx", ".d_2026-08-04.xlsx", "2024/e_2026-08-05.xlsx")
    for i, name in enumerate(names):
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(workbook_bytes(snapshot_sheets(i, 18, DAY + timedelta(days=i))))
    result = run_job(spark, str(tmp_path / "in"), contract)
    assert (result.metrics["files_discovered"], result.metrics["files_processed"]) == (5, 5)
    assert result.history.select("snapshot_date").distinct().count() == 5
    only = run_job(spark, str(tmp_path / "in"), Contract(file_patterns=("2024/*.xlsx", "_a*/*.xlsx")))
    assert sorted(r["source_file"] for r in only.history.select("source_file").distinct().collect()) == [
        "c_2026-08-03.xlsx", "e_2026-08-05.xlsx"
    ]
    rows = [(f"file:{tmp_path}/in/{name}", 1) for name in names[:3]]
    listed = run_job(spark, spark.createDataFrame(rows, "path STRING, length BIGINT"), contract)
    assert listed.metrics["records_in_history"] == 54


def test_a_finished_run_leaves_no_stage(spark, sample_dir, tmp_path, contract):
    result = run_job(spark, str(sample_dir), contract, str(tmp_path / "out"))
    assert result.history.count() == 54
    root = Path(shared_folder(spark).removeprefix("file:")) / f"stage-{result.run_id}"
    assert not root.exists()
    kept = run_job(spark, str(sample_dir), contract)
    assert (root.parent / f"stage-{kept.run_id}").exists()


def test_no_input(spark, tmp_path, contract):
    with pytest.raises(FileNotFoundError):
        run_job(spark, str(tmp_path / "none"), contract)
    folder = tmp_path / "in"
    folder.mkdir()
    _, found = issues_of(spark, folder, contract)
    assert [(code, severity) for code, severity, *_ in found] == [
        ("EMPTY_HISTORY", quality.ERROR),
        ("NO_INPUT_FILES", quality.ERROR),
    ]
    write(folder, "undated.xlsx", snapshot_sheets(0, 18, DAY))
    with pytest.raises(QualityGateError, match="count 2"):
        run_job(spark, str(folder), contract)


def test_a_workbook_that_breaks_halfway_delivers_no_rows(spark, sample_dir, contract):
    content = workbook_bytes(snapshot_sheets(3, 18, date(2026, 8, 4)))
    broken = with_part(content, "xl/worksheets/sheet3.xml", "<worksheet><sheetData><row r='1'>")
    (sample_dir / "x_2026-08-04.xlsx").write_bytes(broken)
    ingested = job.ingest(spark, str(sample_dir), contract, Stage(spark))
    assert ingested.records.filter("record = 'row' AND path LIKE '%x_2026-08-04.xlsx'").count() > 0
    resolved = job.resolve_history(ingested.rows, contract)
    assert resolved.count() == 54
    counters = job.run_counters(ingested, resolved, contract)
    assert (counters["files_discovered"], counters["files_processed"]) == (4, 3)
    # sheets read before the failure stay counted
    assert counters["records_read"] > 54
