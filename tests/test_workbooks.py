"""Workbook reader, discovery and contract checks."""

from __future__ import annotations

import io
import zipfile
from datetime import date

import pytest
from conftest import with_part, write_snapshots
from pyspark.sql import functions as F

from tidemark.catalog.workbook_bytes import column_letters, workbook_bytes
from tidemark.contract import Contract
from tidemark.operators import contracts
from tidemark.sources import discovery, workbooks
from tidemark.staging import Stage

CONTRACT = Contract(expected_sheets=("Open",), required_columns=("KEY",), id_column="KEY")


def scanned(spark, *books, contract=CONTRACT):
    files = spark.createDataFrame(
        [(f"/d/b{i}.xlsx", bytearray(content)) for i, content in enumerate(books)],
        "path STRING, content BINARY",
    )
    return workbooks.parse_workbooks(files, contract).cache()


def cells_of(records):
    """Row numbers and filled cells by header, of one worksheet."""
    keys = workbooks.sheet_list(records).first()["header_keys"]
    rows = records.filter("record = 'row'").orderBy("row_number").collect()
    assert all(len(r["cells"]) == len(keys) for r in rows)
    named = [(r["row_number"], zip(keys, r["cells"], strict=True)) for r in rows]
    return [(n, {k: (c["kind"], c["text"]) for k, c in cells if c["kind"]}) for n, cells in named]


def test_cell_kinds_and_row_numbers(spark):
    content = workbook_bytes(
        {
            "Open": [
                ("Key", "Amount", "Flag", "Day"),
                ("a", 219175.0, True, date(2026, 8, 1)),
                (),
                ("b", 2.5, False, None),
                (),
            ]
        }
    )
    records = scanned(spark, content)
    assert cells_of(records) == [
        (2, {
            "key": ("text", "a"), "amount": ("number", "219175"),
            "flag": ("flag", "True"), "day": ("date", "2026-08-01"),
        }),
        (4, {"key": ("text", "b"), "amount": ("number", "2.5"), "flag": ("flag", "False")}),
    ]
    sheet = workbooks.sheet_list(records).first()
    assert (sheet["raw_rows"], sheet["headers"]) == (3, ["Key", "Amount", "Flag", "Day"])


def test_headers_repeat_collide_or_are_blank(spark):
    content = workbook_bytes(
        {"Open": [("Key", "Key", None, "KEY ", "Unnamed: 3", "--"), ("a", "b", "c", "d", "e", "f")]}
    )
    records = scanned(spark, content)
    sheet = workbooks.sheet_list(records).first()
    assert sheet["headers"] == ["Key", "Key.1", "KEY ", "Unnamed: 3", "--"]
    assert sheet["header_keys"] == ["key", "key_1", "key", "unnamed_3", ""]
    assert workbooks.source_columns(sheet["header_keys"]) == ["key", "key_1", "key"]
    (row,) = cells_of(records)
    assert "c" not in [text for _, text in row[1].values()]


def test_shared_strings_errors_formulas_and_1904_dates(spark):
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    content = workbook_bytes({"Open": [("Key",)]})
    content = with_part(
        content, "xl/sharedStrings.xml",
        f"<sst {main}><si><t>Key</t></si><si><r><t>ri</t></r><r><t>ch</t></r>"
        "<rPh><t>no</t></rPh></si></sst>",
    )
    content = with_part(
        content, "xl/styles.xml",
        f'<styleSheet {main}><numFmts><numFmt numFmtId="170" formatCode="[Red]0.0&quot;d&quot;"/>'
        '<numFmt numFmtId="171" formatCode="dd\\.mm\\.yyyy"/></numFmts><cellXfs><xf numFmtId="0"/>'
        '<xf numFmtId="170"/><xf numFmtId="171"/><xf numFmtId="21"/></cellXfs></styleSheet>',
    )
    sheet = (
        f'<worksheet {main}><sheetData><row><c t="s"><v>0</v></c><c t="str"><v>Sum</v></c>'
        '<c t="inlineStr"><is><t>Day</t></is></c><c t="inlineStr"><is><t>Time</t></is></c>'
        '<c t="inlineStr"><is><t>Err</t></is></c></row>'
        '<row r="3"><c r="A3" t="s"><v>1</v></c><c r="B3" s="1"><f>1+1</f><v>2</v></c>'
        '<c r="C3" s="2"><v>1.5</v></c><c r="D3" s="3"><v>0.25</v></c>'
        '<c r="E3" t="e"><v>#DIV/0!</v></c></row></sheetData></worksheet>'
    )
    content = with_part(content, "xl/worksheets/sheet1.xml", sheet)
    assert cells_of(scanned(spark, content)) == [
        (3, {
            "key": ("text", "rich"), "sum": ("number", "2"), "day": ("date", "1900-01-01 12:00:00"),
            "time": ("time", "06:00:00"),
        })
    ]
    book = zipfile.ZipFile(io.BytesIO(content)).read("xl/workbook.xml").decode()
    dated = with_part(content, "xl/workbook.xml", book.replace("<sheets>", '<workbookPr date1904="1"/><sheets>'))
    assert cells_of(scanned(spark, dated))[0][1]["day"] == ("date", "1904-01-02 12:00:00")


def test_missing_tokens_flags_and_note_dates(spark, contract):
    sheet = [
        ("Line Id", "SLA Days Remaining", "Follow Up Notes", "Item"),
        ("1", True, date(2026, 8, 5), "N/A"),
        ("2", "NA", "5/8 text", " NA "),
    ]
    records = scanned(spark, workbook_bytes({"Overdue": sheet}), contract=contract)
    columns = ["line_id", "sla_days_remaining", "follow_up_notes", "item"]
    rows = workbooks.sheet_rows(records, columns, contract).orderBy("source_row_number")
    assert workbooks.sheet_list(records).first()["filled_cells"] == {
        "line_id": 2, "sla_days_remaining": 1, "follow_up_notes": 2, "item": 1,
    }
    assert [tuple(r)[2:] for r in rows.collect()] == [
        (2, "1", "1", "2026-08-05", None, date(2026, 8, 5)),
        (3, "2", None, "5/8 text", " NA ", None),
    ]


def test_unreadable_workbooks_are_findings(spark):
    good = workbook_bytes({"Open": [("Key",), ("a",)]})
    broken = with_part(good, "xl/worksheets/sheet1.xml", "<worksheet><sheetData><row>")
    records = scanned(spark, good, good[: len(good) // 2], b"", broken)
    assert {r["path"] for r in workbooks.read_failures(records).collect()} == {
        "/d/b1.xlsx", "/d/b2.xlsx", "/d/b3.xlsx",
    }
    assert [r["path"] for r in workbooks.workbook_list(records).collect()] == ["/d/b0.xlsx"]


def test_large_sheet_spans_several_batches(spark):
    rows = [(f"k{i}", i) for i in range(10_000)]
    records = scanned(spark, workbook_bytes({"Open": [("Key", "N"), *rows]}))
    assert records.filter("record = 'row'").count() == 10_000
    assert workbooks.sheet_list(records).first()["raw_rows"] == 10_000


def test_column_letters():
    assert [column_letters(i) for i in (0, 25, 26, 701, 702)] == ["A", "Z", "AA", "ZZ", "AAA"]
    assert [workbooks._column_index(letters) for letters in ("A", "Z", "AA", "ZZ", "AAA")] == [
        0, 25, 26, 701, 702,
    ]


def test_discovery(spark, tmp_path, contract):
    write_snapshots(tmp_path, snapshots=2, processes=9)
    nested = tmp_path / "more files"
    nested.mkdir()
    for name in ("notes.xlsx", "~$operations_2026-08-01.xlsx", "x_2026-08-01.csv", "OLD 31.07.2026.xlsm"):
        (nested / name).touch()
    files = discovery.snapshot_files(discovery.list_files(str(tmp_path), spark), contract)
    assert files.count() == 4
    assert [r["source_file"] for r in discovery.undated_files(files).collect()] == ["notes.xlsx"]
    numbered = discovery.snapshot_order(files).orderBy("snapshot_order").collect()
    assert [(r["snapshot_order"], r["source_file"]) for r in numbered] == [
        (1, "OLD 31.07.2026.xlsm"),
        (2, "operations_snapshot_2026-08-01.xlsx"),
        (3, "operations_snapshot_2026-08-02.xlsx"),
    ]
    with pytest.raises(FileNotFoundError):
        discovery.list_files(str(tmp_path / "none"), spark)


HIDDEN = ("_archive/c_2026-08-03.xlsx", ".d_2026-08-04.xlsx", "_b_2026-08-02.xlsx", "2024/e_2026-08-05.xlsx",
          "2024/deep/._f/a{b,c}_2026-08-06.xlsx", "a_2026-08-01.xlsx", "~$a_2026-08-01.xlsx")


@pytest.mark.parametrize(
    "patterns",
    [("*.xlsx",), ("2024/*.xlsx",), ("2024/**/*.xlsx",), ("a{b,c}*.xlsx", "_*.xlsx"), ("[!a]_*.xlsx",), ("?_2026*",), ("[_.]*",)],
)
def test_patterns_name_files_as_a_recursive_glob_does(spark, tmp_path, patterns):
    for name in HIDDEN:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).touch()
    files = discovery.snapshot_files(discovery.list_files(str(tmp_path), spark), Contract(file_patterns=patterns))
    expected = {p for pattern in patterns for p in tmp_path.rglob(pattern) if p.is_file() and not p.name.startswith("~$")}
    assert {r["path"] for r in files.collect()} == {f"file:{p}" for p in expected}
    assert expected


def test_an_inventory_stands_for_a_folder(spark, contract):
    rows = [("s3://b/in/a_2026-08-01.xlsx", 5), ("s3://b/in/_b_2026-08-02.xlsm", 0), ("s3://b/in/c.csv", 1)]
    inventory = spark.createDataFrame(rows, "path STRING, length INT")
    files = discovery.snapshot_files(discovery.list_files(inventory, spark), contract).orderBy("path").collect()
    assert [(r["source_file"], r["length"]) for r in files] == [("_b_2026-08-02.xlsm", 0), ("a_2026-08-01.xlsx", 5)]


def test_order_within_a_date_ignores_case_then_takes_the_path(spark):
    day = date(2026, 1, 1)
    rows = [("/b/B.xlsx", "B.xlsx", day), ("/a/b.xlsx", "b.xlsx", day), ("/c/a.xlsx", "a.xlsx", day)]
    files = spark.createDataFrame(rows, "path STRING, source_file STRING, snapshot_date DATE")
    found = {r["path"]: r["snapshot_order"] for r in discovery.snapshot_order(files).collect()}
    assert found == {"/c/a.xlsx": 1, "/a/b.xlsx": 2, "/b/B.xlsx": 3}


def test_numbers_are_consecutive_over_many_partitions(spark):
    frame = spark.range(5000).select((F.hash("id") % 50).alias("k"), "id")
    numbered = discovery.number_in_order(frame, ("k", "id"), "n").collect()
    in_order = sorted(numbered, key=lambda r: (r["k"], r["id"]))
    assert [r["n"] for r in in_order] == list(range(1, 5001))


def test_sheet_checks(spark, contract):
    rows = [
        ("a.xlsx", sheet)
        for sheet in ("Overdue", " OVERDUE!", "0 to 7 Days", "8-to-15 days", "Zeta", "alpha")
    ]
    books = contracts.sheets_of_workbooks(spark.createDataFrame(rows, "source_file STRING, source_sheet STRING"))
    missing = contracts.missing_sheets(books, contract).collect()
    assert [tuple(r) for r in missing] == [("a.xlsx", "16 to 25 Days", 4), ("a.xlsx", "26 to 35 Days", 5)]
    extra = contracts.unexpected_sheets(books, contract).first()
    assert (extra["sheet_count"], extra["worksheets"]) == (2, ["alpha", "Zeta"])
    clash = contracts.sheet_collisions(books).first()
    assert (clash["sheet_key"], clash["colliding_sheets"]) == ("OVERDUE", [" OVERDUE!", "Overdue"])


def test_required_columns_without_a_value_are_missing(spark):
    contract = Contract(required_columns=("KEY", "STAGE", "NOTE"), id_column="KEY")
    rows = spark.createDataFrame(
        [("f", "s", "1", None), ("f", "s", "2", None), ("f", "t", "1", "x")],
        "source_file STRING, source_sheet STRING, key STRING, stage STRING",
    )
    found = contracts.contract_failures(contracts.filled_cells(rows, ["key", "stage"]), contract)
    assert {r["source_sheet"]: r["missing_columns"] for r in found.collect()} == {
        "s": ["note", "stage"],
        "t": ["note"],
    }


def large_book(rows: int) -> bytes:
    sheet = [("Key", "Text"), *[(f"k{i}", f"value {i * 7919 % 100_003} of a long row {i}") for i in range(rows)]]
    return workbook_bytes({"Open": sheet, "Closed": [("Key",), ("z",)], "Other": [("Key",), ("o",)]})


def test_large_workbooks_are_read_by_worksheet(spark, tmp_path):
    both = Contract(expected_sheets=("Open", "Closed"), required_columns=("KEY",), id_column="KEY")
    good, broken = large_book(50), large_book(50)
    (tmp_path / "good.xlsx").write_bytes(good)
    (tmp_path / "broken.xlsx").write_bytes(with_part(broken, "xl/worksheets/sheet2.xml", "<worksheet><sheetData><row>"))
    (tmp_path / "no.xlsx").write_bytes(b"no archive at all")
    (tmp_path / "empty.xlsx").touch()
    listed = [(str(f), f.stat().st_size, date(2026, 8, 1)) for f in tmp_path.iterdir()] + [(f"{tmp_path}/gone.xlsx", 5, date(2026, 8, 1))]
    files = spark.createDataFrame(listed, "path STRING, length BIGINT, snapshot_date DATE")

    def found(large):
        records = workbooks.scan_workbooks(files, both, large).cache()
        name = F.substring_index("path", "/", -1).alias("name")
        rows = records.filter("record <> 'workbook'").filter("path LIKE '%good.xlsx'").drop("path").collect()
        books = workbooks.workbook_list(records).select(name, "sheets").collect()
        return sorted(map(str, rows)), books, sorted(r[0] for r in workbooks.read_failures(records).select(name).collect())

    assert found(0) == found(1 << 30)
    rows, books, failures = found(0)
    assert len(rows) == 53 and [r.name for r in books] == ["good.xlsx"]
    assert failures == ["broken.xlsx", "empty.xlsx", "gone.xlsx", "no.xlsx"]


def test_a_large_worksheet_is_read_in_bounded_memory(tmp_path):
    import tracemalloc

    from tidemark.sources.listing import open_ranges
    from tidemark.sources.stores import Stores

    content = large_book(60_000)
    part = zipfile.ZipFile(io.BytesIO(content)).getinfo("xl/worksheets/sheet1.xml")
    (tmp_path / "large.xlsx").write_bytes(content)
    opened = lambda: open_ranges(Stores(), f"file:{tmp_path}/large.xlsx", 1 << 16)
    rows = 0
    tracemalloc.start()
    for batch in workbooks._blocks("large.xlsx", opened, CONTRACT.sheet_keys, "Open"):
        rows += batch.num_rows
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 60_001 and peak < part.file_size


def test_rows_of_one_layout_are_not_dealt_by_it(spark):
    """However many rows share a list of headers, the few lists come to the rows."""
    content = workbook_bytes({"Open": [("Key", "N"), *[(f"{i * 7919 % 10_007:x}" * 3, i) for i in range(6_000)]]})
    files = spark.createDataFrame([(f"/d/b{i}.xlsx", bytearray(content)) for i in range(4)], "path STRING, content BINARY")
    records = Stage(spark).write(workbooks.parse_workbooks(files, CONTRACT), "records", ("record",))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16k")  # for a table of this size what 10 MB are for a large one
    try:
        rows = workbooks.sheet_rows(records, ["key", "n"], CONTRACT)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning(layout" not in plan and "SortMergeJoin" not in plan
        assert rows.count() == 24_000 and rows.filter("n IS NULL").isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
