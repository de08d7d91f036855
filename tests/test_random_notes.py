"""Note dates, file dates and identifiers on random text, against plain Python."""

from __future__ import annotations

import random
import re
from datetime import date, timedelta

from pyspark.sql import functions as F

from tidemark.functions import text, values

ALPHABET = "0123456789" * 2 + "//--.._ aé\t1/2"


def random_texts(count: int, seed: int) -> list[str]:
    source = random.Random(seed)
    made = ["".join(source.choices(ALPHABET, k=source.randint(0, 14))) for _ in range(count // 2)]
    for _ in range(count // 2):
        day, month = source.randint(0, 33), source.randint(0, 14)
        year = source.choice(["", "", "/24", "-2024", "/1999", "/123", "-9999", "/00"])
        sign = source.choice("/-")
        made.append(f"{source.choice(['', 'x', 'seen '])}{day:0{source.randint(1, 2)}d}{sign}{month}{year} ok")
    return made


def day_or_none(year: int, month: int, day: int) -> date | None:
    try:
        return date(year, month, day)
    except ValueError:
        return None


def expected_note_date(note: str, snapshot: date) -> date | None:
    match = re.search(values.NOTE_DATE_PATTERN.removeprefix("(?U)"), note)
    if match is None:
        return None
    day, month = int(match[1]), int(match[2])
    if match[3]:
        year = int(match[3])
        found = day_or_none(year + 2000 if year < 100 else year, month, day)
    else:
        found = day_or_none(snapshot.year, month, day)
        if found and (found - snapshot).days > values.NOTE_LOOKAHEAD_DAYS:
            found = day_or_none(snapshot.year - 1, month, day)
    limits = (values.EARLIEST_NOTE_DATE, values.LATEST_NOTE_DATE)
    return found if found and limits[0] <= found.isoformat() <= limits[1] else None


def test_note_dates(spark):
    snapshots = [date(2024, 1, 1) + timedelta(days=37 * i) for i in range(20)]
    rows = [(note, snapshots[i % 20], i) for i, note in enumerate(random_texts(6000, 1))]
    frame = spark.createDataFrame(rows, "note STRING, day DATE, i INT")
    dated = values.with_follow_up_date(frame, F.col("note"), F.col("day"), "found")
    wrong = [
        (r["note"], r["day"], r["found"])
        for r in dated.collect()
        if r["found"] != expected_note_date(r["note"], r["day"])
    ]
    assert wrong == []
    assert dated.filter("found IS NOT NULL").count() > 1000


def expected_file_date(stem: str) -> date | None:
    for pattern, order in ((values.FILE_DATE_YEAR_FIRST, (1, 2, 3)), (values.FILE_DATE_DAY_FIRST, (3, 2, 1))):
        match = re.search(pattern.removeprefix("(?U)"), stem)
        if match:
            return day_or_none(*(int(match[group]) for group in order))
    return None


def test_file_dates(spark):
    source = random.Random(2)
    stems = ["".join(source.choices("0123456789-_.x", k=source.randint(6, 16))) for _ in range(3000)]
    for _ in range(3000):
        parts = [f"{source.randint(0, 2100):04d}", str(source.randint(0, 13)), str(source.randint(0, 32))]
        if source.random() < 0.5:
            parts.reverse()
        edge = source.choice(["", "a", "1", "_", "a_"])
        stems.append(edge + source.choice("-_.").join(parts) + source.choice(["", "z", "2", "_"]))
    frame = spark.createDataFrame([(s,) for s in stems], "stem STRING")
    name = F.concat(F.col("stem"), F.lit(".xlsx"))
    found = frame.select("stem", values.snapshot_date_from_name(name).alias("found")).collect()
    wrong = [(r["stem"], r["found"]) for r in found if r["found"] != expected_file_date(r["stem"])]
    assert wrong == []
    assert sum(r["found"] is not None for r in found) > 1000


def test_identifiers(spark):
    source = random.Random(3)
    made = ["".join(source.choices("01-. a\t", k=source.randint(0, 7))) for _ in range(4000)]
    frame = spark.createDataFrame([(t,) for t in made], "t STRING")
    for row in frame.select("t", text.identifier(F.col("t")).alias("found")).collect():
        plain = row["t"].strip()
        decimal = re.fullmatch(r"(-?\d+)\.0+", plain)
        assert row["found"] == (decimal[1] if decimal else plain or None), row["t"]
