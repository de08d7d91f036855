"""Column functions on the hand cases."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.functions import text, values


def applied(spark, rows, schema, *columns):
    frame = spark.createDataFrame(rows, schema)
    return [tuple(row) for row in frame.select(*columns).collect()]


def one_column(spark, inputs, function):
    return [r[0] for r in applied(spark, [(i,) for i in inputs], "x STRING", function(F.col("x")))]


LABELS = [
    ("\tÜber  Größe \n", "UBER_GROSSE"),
    ("Due/by (days)", "DUE_BY_DAYS"),
    ("Lot No.", "LOT_NO"),
    ("__x--y__", "X_Y"),
    ("état", "ETAT"),
    ("ﬁnal ½ ㎏", "FINAL_1_2_KG"),
    ("straße", "STRASSE"),
    ("Ação nº 5", "ACAO_NO_5"),
    ("日本", ""),
    ("한글 A", "A"),
    (None, ""),
    ("", ""),
]


def test_canonical_label_as_column_and_as_name_agree(spark):
    found = one_column(spark, [label for label, _ in LABELS], text.canonical_label)
    assert found == [expected for _, expected in LABELS]
    assert [text.canonical_name(label) for label, _ in LABELS] == found


def test_trim_and_blank(spark):
    inputs = ["\t a b  ", "  \n", "", None, "x", "\x1cy　"]
    assert one_column(spark, inputs, text.trim_text) == ["a b", "", "", None, "x", "y"]
    assert one_column(spark, inputs, text.blank_to_null) == [
        "\t a b  ", None, None, None, "x", "\x1cy　",
    ]


@pytest.mark.parametrize("token", text.MISSING_TOKENS)
def test_missing_tokens_are_exact(token):
    assert token == token.strip()


def test_missing_tokens(spark):
    inputs = ["NA", "n/a", " NA ", "na", "<NA>", "none", "None"]
    assert one_column(spark, inputs, text.missing_to_null) == [
        None, None, " NA ", "na", None, "none", None,
    ]


def test_identifier(spark):
    inputs = ["8040.0", "31.000", "AB-7.0x", " 7.0 ", "-3.000", "1.50", "1.0.0", "  ", None, ".0"]
    assert one_column(spark, inputs, text.identifier) == [
        "8040", "31", "AB-7.0x", "7", "-3", "1.50", "1.0.0", None, None, ".0",
    ]
    number = applied(spark, [(60412.0,)], "x DOUBLE", text.identifier(F.col("x")))
    assert number == [("60412",)]


def test_whole_number(spark):
    cases = {
        "12": 12, "-4": -4, "+5": 5, "5.0": 5, "5.": 5, "1e1": 10, "9007199254740993": 9007199254740993,
        "2.5": None, "1,000": None, "5d": None, "0x1A": None, "1_000": None, "inf": None,
        "n/a": None, "": None, None: None, "3000000000": 3000000000, "1e400": None,
    }
    assert one_column(spark, list(cases), values.whole_number) == list(cases.values())


def test_calendar_date(spark):
    cases = {
        "2026-08-15": date(2026, 8, 15), "15/08/2026": date(2026, 8, 15),
        "2026-08-15 10:30:00": date(2026, 8, 15), "2026-08-15T10:30": date(2026, 8, 15),
        "2026-02-30": None, "30/02/2026": None, "x": None, "2026": None, "2026-8-5": None,
        "15/08/26": None, None: None, "2026-08-1T": None,
    }
    assert one_column(spark, list(cases), values.calendar_date) == list(cases.values())


def test_calendar_date_in_other_formats(spark):
    found = one_column(
        spark, ["20260815", "Aug 15, 2026"], lambda c: values.calendar_date(c, ("yyyyMMdd", "MMM d, yyyy"))
    )
    assert found == [date(2026, 8, 15), date(2026, 8, 15)]


def test_snapshot_date_from_name(spark):
    cases = {
        "operations_2026-08-18.xlsx": date(2026, 8, 18),
        "operations_18.08.2026.xlsm": date(2026, 8, 18),
        "snapshot_18_08_2026.xlsx": date(2026, 8, 18),
        "a 2026_8-5.xlsx": date(2026, 8, 5),
        "operations_31-02-2026.xlsx": None,
        "operations_latest.xlsx": None,
        "12026-08-18.xlsx": None,
        "2026-08-181.xlsx": None,
        "2026-13-01 and 05-08-2026.xlsx": None,
        "0000-01-01.xlsx": None,
        "0000_01_01.xlsx": None,
        "01.01.0000.xlsx": None,
        "1500-01-01.xlsx": date(1500, 1, 1),
        "x.2026-08-18": None,
    }
    assert one_column(spark, list(cases), values.snapshot_date_from_name) == list(cases.values())


NOTES = [
    ("15/08/2026 - reviewed", "2026-08-18", date(2026, 8, 15)),
    ("31/12 - reviewed", "2026-01-05", date(2025, 12, 31)),
    ("no date", "2026-08-18", None),
    ("15-08-26", "2026-08-18", date(2026, 8, 15)),
    ("18/09", "2026-08-18", date(2026, 9, 18)),
    ("19/09", "2026-08-18", date(2025, 9, 19)),
    ("1/2 done 15/08/2026", "2026-08-18", date(2026, 2, 1)),
    ("2026-08-05 ok", "2026-08-18", date(2026, 5, 8)),
    ("15/08/20261 x", "2026-08-18", date(2026, 8, 15)),
    ("1/1/99", "2026-08-18", date(2099, 1, 1)),
    ("1/1/099", "2026-08-18", date(2099, 1, 1)),
    ("31/02/2026", "2026-08-18", None),
    ("00/08", "2026-08-18", None),
    ("29/02 x", "2028-01-05", None),
    ("29/02 x", "2027-03-05", None),
    ("29/02 x", "2028-03-05", date(2028, 2, 29)),
    ("15/08/126", "2026-08-18", None),
    ("01/01/9999", "2026-08-18", None),
    ("é15/08/2026", "2026-08-18", None),
    ("١٥/٠٨/٢٠٢٦", "2026-08-18", date(2026, 8, 15)),
    (None, "2026-08-18", None),
    ("15/08/2026", None, None),
]


def test_follow_up_date(spark):
    rows = [(note, day, number) for number, (note, day, _) in enumerate(NOTES)]
    frame = spark.createDataFrame(rows, "note STRING, day STRING, n INT")
    dated = values.with_follow_up_date(frame, F.col("note"), F.col("day").cast("date"), "found")
    assert dated.columns == ["note", "day", "n", "found"]
    found = {row["n"]: row["found"] for row in dated.collect()}
    assert [found[n] for n in range(len(NOTES))] == [expected for _, _, expected in NOTES]


def test_buckets_and_status(spark):
    days = [-1, 0, 7, 8, 15, 16, 25, 26, 99, None]
    rows = applied(
        spark, [(d,) for d in days], "d INT", values.sla_bucket(F.col("d")), values.sla_status(F.col("d"))
    )
    assert [bucket for bucket, _ in rows] == [
        "Overdue", "0 to 7 Days", "0 to 7 Days", "8 to 15 Days", "8 to 15 Days",
        "16 to 25 Days", "16 to 25 Days", "26 to 35 Days", "26 to 35 Days", None,
    ]
    assert [status for _, status in rows] == ["OVERDUE"] + ["ON TIME"] * 8 + [None]


def test_record_hash_depends_on_content_not_on_column_order(spark):
    rows = [("a", None), ("a", "b"), ("a", "b")]
    found = applied(
        spark, rows, "x STRING, y STRING", values.record_hash(["x", "y"]), values.record_hash(["y", "x"])
    )
    assert all(len(left) == 16 and left == right for left, right in found)
    assert found[0] != found[1] == found[2]
