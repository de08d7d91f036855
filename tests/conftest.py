from __future__ import annotations

import io
import zipfile
from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

from tidemark.catalog.workbook_bytes import workbook_bytes
from tidemark.contract import DEFAULT_SHEETS, Contract

HEADER = (
    "Line Id", "Request Id", "Current Stage", "SLA Days Remaining", "SLA Status", "Follow Up Notes",
    "Owner", "Site", "Start Date", "Due Date",
)
DAYS_LEFT = 3  # place of the days in a row
STEPS = ("Draft", "Costing", "Signature", "Archive")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tidemark-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(folder / "checkpoints"))
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def contract():
    return Contract()


def process_row(process: int, snapshot: int, day: date) -> tuple:
    """One process on one day: it visits the five worksheets in turn and moves on every other day."""
    left = (-3, 2, 9, 18, 28)[(process + 2 * snapshot) % 5] + process % 3
    step = STEPS[(process + (snapshot + process % 2) // 2) % 4]
    called = day - timedelta(days=process * process % 9)
    note = None if (process, snapshot) == (4, 1) else f"called {called:%d/%m/%Y}, {step.lower()} goes on"
    return (
        f"P/{process * 37 % 101:03d}", f"{900 - process}.0", step, left, "OVERDUE" if left < 0 else "ON TIME", note,
        ("Ada", "Bo", "Cy")[process % 3], f"Hall {process // 4}", day - timedelta(days=30 - process), day + timedelta(days=left),
    )


def snapshot_sheets(snapshot: int, processes: int, day: date) -> dict[str, list[tuple]]:
    rows = [process_row(process, snapshot, day) for process in range(1, processes + 1)]
    limits = [(-99, -1), (0, 7), (8, 15), (16, 25), (26, 35)]
    return {
        name: [HEADER, *[row for row in rows if low <= row[DAYS_LEFT] <= high]]
        for name, (low, high) in zip(DEFAULT_SHEETS, limits, strict=True)
    }


def write_snapshots(folder: Path, snapshots: int = 3, processes: int = 18) -> Path:
    for snapshot in range(snapshots):
        day = date(2026, 8, 1) + timedelta(days=snapshot)
        content = workbook_bytes(snapshot_sheets(snapshot, processes, day))
        (folder / f"operations_snapshot_{day}.xlsx").write_bytes(content)
    return folder


@pytest.fixture
def sample_dir(tmp_path):
    folder = tmp_path / "snapshots"
    folder.mkdir()
    return write_snapshots(folder)


def with_part(content: bytes, name: str, body: str) -> bytes:
    """The workbook with one part replaced or added."""
    target = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(content)) as old, zipfile.ZipFile(target, "w") as new:
        for entry in old.namelist():
            if entry != name:
                new.writestr(entry, old.read(entry))
        new.writestr(name, body)
    return target.getvalue()
