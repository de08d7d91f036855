"""Workbook files as a distributed scan.

Every workbook is read inside the task that holds it; nothing passes the driver. The
scan yields three kinds of records, told apart by ``record``:

* ``workbook``: sheet names, or the error that made the file (or a worksheet of it) unreadable,
* ``sheet``: headers, filled cells per header and the number of data rows of an expected worksheet,
* ``row``: the cells of one worksheet row, in the order of the headers.

``layout`` stands for the list of headers: rows carry it, and the few different lists tell where a column is.

A small workbook is read at once, by one task. Of a large one only the directory at its end is read first; each of its worksheets
is then a unit of its own, which reads the ranges of its parts and holds a block of rows at a time. A worksheet holds at most
2**20 rows by its format, which bounds the work of a task.
"""

from __future__ import annotations

import hashlib
import io
import re
import zipfile
from collections.abc import Callable, Iterator, Sequence
from datetime import datetime, timedelta
from functools import cached_property
from itertools import accumulate, islice
from typing import BinaryIO, NamedTuple
from xml.etree import ElementTree
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contract import NOTE_CELL_DATE, ROW_NUMBER, ROW_PATH, ROW_SHEET, Contract
from tidemark.functions.text import MISSING_TOKENS, canonical_name, missing_to_null
from tidemark.sources.listing import open_ranges, read_bytes, spread
from tidemark.sources.stores import Stores, stores_of
from tidemark.staging import Stage

RECORD_SCHEMA = (
    "record STRING, path STRING, sheet STRING, sheet_key STRING, row_number INT, "
    "names ARRAY<STRING>, name_keys ARRAY<STRING>, raw_rows INT, error STRING, "
    "layout STRING, filled ARRAY<INT>, cells ARRAY<STRUCT<kind: STRING, text: STRING>>"
)
_PLAIN_FIELDS = (
    pa.field("record", pa.string()),
    pa.field("path", pa.string()),
    pa.field("sheet", pa.string()),
    pa.field("sheet_key", pa.string()),
    pa.field("row_number", pa.int32()),
    pa.field("names", pa.list_(pa.string())),
    pa.field("name_keys", pa.list_(pa.string())),
    pa.field("raw_rows", pa.int32()),
    pa.field("error", pa.string()),
    pa.field("layout", pa.string()),
    pa.field("filled", pa.list_(pa.int32())),
)
_CELL = pa.struct([("kind", pa.string()), ("text", pa.string())])
_ARROW_SCHEMA = pa.schema([*_PLAIN_FIELDS, pa.field("cells", pa.list_(_CELL))])


class _Record(NamedTuple):
    """The plain fields of a record; its cells travel beside it."""

    record: str
    path: str
    sheet: str | None = None
    sheet_key: str | None = None
    row_number: int | None = None
    names: list[str] | None = None
    name_keys: list[str] | None = None
    raw_rows: int | None = None
    error: str | None = None
    layout: str | None = None
    filled: list[int] | None = None


_NO_CELL = (None, None)
_RECORDS_PER_BATCH = 4096
LARGE_BYTES = 32 << 20  # a larger workbook is read worksheet by worksheet
DIRECTORY = ""  # the unit of a large workbook that stands for its list of worksheets
_CHUNK_BYTES = 1 << 18

# Cell kinds.
TEXT, NUMBER, FLAG, DATE, TIME = "text", "number", "flag", "date", "time"
_MISSING = frozenset(MISSING_TOKENS)

# Number formats that mean a date or a time in every workbook.
_DATE_FORMAT_IDS = frozenset([*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)])
_FORMAT_LITERALS = re.compile(r'"[^"]*"|\\.|_.|\[(?!hh?\]|mm?\]|ss?\])[^\]]*\]', re.IGNORECASE)


def _local(element) -> str:
    return element.tag.rpartition("}")[2]


def _children(element, name: str) -> list:
    return [child for child in element if _local(child) == name]


def _attribute(element, name: str) -> str | None:
    return next((v for k, v in element.attrib.items() if k.rpartition("}")[2] == name), None)


def _text(element) -> str:
    """Text of a string item: its own text, or that of its formatted runs."""
    runs = [part for run in _children(element, "r") for part in _children(run, "t")]
    return "".join(part.text or "" for part in _children(element, "t") + runs)


class _Book:
    """The parts of one workbook file that its worksheets refer to."""

    def __init__(self, stream: BinaryIO):
        self.archive = zipfile.ZipFile(stream)
        root = self._part("xl/workbook.xml")
        targets = {
            relation.get("Id"): relation.get("Target")
            for relation in self._part("xl/_rels/workbook.xml.rels")
            if (relation.get("Type") or "").endswith("/worksheet")
        }
        entries = [(s.get("name"), _attribute(s, "id")) for s in root.iter() if _local(s) == "sheet"]
        self.sheets = {name: targets[ref] for name, ref in entries if ref in targets}
        settings = [e for e in root.iter() if _local(e) == "workbookPr"]
        self.from_1904 = any(e.get("date1904") in ("1", "true") for e in settings)
        self.days: dict[str, tuple[str, str]] = {}

    @cached_property
    def strings(self) -> list[str]:
        return self._shared_strings()

    @cached_property
    def date_styles(self) -> list[bool]:
        return self._date_styles()

    def _part(self, name: str):
        return ElementTree.fromstring(self.archive.read(name))

    def _shared_strings(self) -> list[str]:
        """Texts the cells refer to; each item is freed once its text is taken."""
        if "xl/sharedStrings.xml" not in self.archive.namelist():
            return []
        strings = []
        with self.archive.open("xl/sharedStrings.xml") as part:
            for _, element in ElementTree.iterparse(part):
                if _local(element) == "si":
                    strings.append(_text(element))
                    element.clear()
        return strings

    def _date_styles(self) -> list[bool]:
        """For every cell style, whether it shows a date or a time."""
        if "xl/styles.xml" not in self.archive.namelist():
            return []
        root = self._part("xl/styles.xml")
        own = {f.get("numFmtId"): f.get("formatCode") or "" for f in root.iter() if _local(f) == "numFmt"}

        def shows_date(style) -> bool:
            number = style.get("numFmtId") or "0"
            if number in own:
                return bool(re.search("[dmhys]", _FORMAT_LITERALS.sub("", own[number]), re.IGNORECASE))
            return int(number) in _DATE_FORMAT_IDS

        styles = [s for group in _children(root, "cellXfs") for s in _children(group, "xf")]
        return [shows_date(style) for style in styles]

    def _entry(self, name: str) -> str:
        target = self.sheets[name]
        return target.lstrip("/") if target.startswith("/") else f"xl/{target}"

    def open_sheet(self, name: str):
        return self.archive.open(self._entry(name))

    def packed_size(self, name: str) -> int:
        return self.archive.getinfo(self._entry(name)).compress_size

    def value(self, attributes: dict[str, str], raw: str) -> tuple[str, str | None] | None:
        """Kind and text of a cell, ``None`` for an empty one; an error has no text."""
        if not raw:
            return None
        kind = attributes.get("t", "n")
        if kind == "n":
            style = int(attributes.get("s", 0))
            dated = style < len(self.date_styles) and self.date_styles[style]
            return self._date(raw) if dated else (NUMBER, _number(raw))
        if kind == "s":
            text = self.strings[int(raw)]
            return (TEXT, text) if text else None
        if kind == "b":
            return FLAG, "True" if raw == "1" else "False"
        if kind == "d":
            return DATE, raw.replace("T", " ").removesuffix(" 00:00:00")
        return TEXT, None if kind == "e" else raw

    def _date(self, raw: str) -> tuple[str, str]:
        if not raw.isdigit():
            return self._moment(float(raw))
        if raw not in self.days:  # whole days are few and come again and again
            self.days[raw] = self._moment(int(raw))
        return self.days[raw]

    def _moment(self, serial: float) -> tuple[str, str]:
        seconds = round(serial % 1 * 86400)
        if 0 <= serial < 1:
            return TIME, str(datetime.min + timedelta(seconds=seconds))[11:19]
        start = datetime(1904, 1, 1) if self.from_1904 else datetime(1899, 12, 30)
        if not self.from_1904 and serial < 60:
            start += timedelta(days=1)  # the calendar of the format has a 29 February 1900
        return DATE, str(start + timedelta(days=int(serial), seconds=seconds)).removesuffix(" 00:00:00")


def _number(raw: str) -> str:
    """Number text, without a fraction when the number is whole."""
    if raw.lstrip("+-").isdigit():
        return str(int(raw))
    value = float(raw)
    return str(int(value)) if value.is_integer() else repr(value)


def _column_index(letters: str) -> int:
    index = 0
    for letter in letters:
        index = index * 26 + ord(letter) - 64
    return index - 1


Cells = dict[int, tuple[str, str | None]]


def _sheet_rows(book: _Book, stream) -> Iterator[tuple[int, Cells]]:
    """Row number and cells by column index, in the order of the worksheet part.

    The handlers run for every cell, so they keep their state in local variables.
    """
    rows: list[tuple[int, Cells]] = []
    columns: dict[str, int] = {}
    cells: Cells = {}
    attributes: dict[str, str] = {}
    pieces: list[str] = []
    number, index, phonetic = 0, -1, False
    cell_tag, value_tag, text_tag, row_tag, phonetic_tag = "c", "v", "t", "row", "rPh"
    cell_value = book.value
    parser = expat.ParserCreate()
    parser.buffer_text = True

    def root(name: str, _: dict[str, str]) -> None:
        nonlocal cell_tag, value_tag, text_tag, row_tag, phonetic_tag
        prefix = name[: name.find(":") + 1]
        if prefix:
            cell_tag, value_tag, text_tag = prefix + "c", prefix + "v", prefix + "t"
            row_tag, phonetic_tag = prefix + "row", prefix + "rPh"
        parser.StartElementHandler = start

    def start(name: str, given: dict[str, str]) -> None:
        nonlocal attributes, pieces, number, cells, index, phonetic
        if name == cell_tag:
            attributes, pieces = given, []
        elif name == value_tag or name == text_tag:
            if not phonetic:
                parser.CharacterDataHandler = pieces.append
        elif name == row_tag:
            number = int(given.get("r", number + 1))
            cells, index = {}, -1
        elif name == phonetic_tag:
            phonetic = True

    def end(name: str) -> None:
        nonlocal index, phonetic
        if name == value_tag or name == text_tag:
            parser.CharacterDataHandler = None
        elif name == cell_tag:
            letters = attributes.get("r", "").rstrip("0123456789")
            if letters:
                if letters not in columns:
                    columns[letters] = _column_index(letters)
                index = columns[letters]
            else:
                index += 1
            if pieces:
                value = cell_value(attributes, pieces[0] if len(pieces) == 1 else "".join(pieces))
                if value is not None:
                    cells[index] = value
        elif name == row_tag:
            rows.append((number, cells))
        elif name == phonetic_tag:
            phonetic = False

    parser.StartElementHandler = root
    parser.EndElementHandler = end
    while chunk := stream.read(_CHUNK_BYTES):
        parser.Parse(chunk, False)
        yield from rows
        rows.clear()
    parser.Parse(b"", True)
    yield from rows


def _headers(cells: Cells) -> dict[int, str]:
    """Header text by column index; a repeated header gets a number."""
    headers, used = {}, set()
    for index in sorted(cells):
        name = cells[index][1]
        if not name:
            continue
        unique, repeat = name, 0
        while unique in used:
            repeat += 1
            unique = f"{name}.{repeat}"
        used.add(unique)
        headers[index] = unique
    return headers


def _sheet_records(book: _Book, path: str, sheet: str, key: str) -> Iterator[tuple]:
    headers: dict[int, str] = {}
    name_keys: list[str] = []
    places: dict[int, int] = {}  # of colliding headers only the first holds cells
    filled: list[int] = []
    layout, last = "", 1
    with book.open_sheet(sheet) as stream:
        for number, cells in _sheet_rows(book, stream):
            if cells:
                last = number
            if number == 1:
                headers = _headers(cells)
                name_keys = [canonical_name(name).lower() for name in headers.values()]
                places = {i: n for n, i in enumerate(headers) if name_keys.index(name_keys[n]) == n}
                filled = [0] * len(headers)
                layout = hashlib.md5("\x1f".join(name_keys).encode()).hexdigest()
                continue
            row, any_cell = [_NO_CELL] * len(filled), False
            for index, value in cells.items():
                place = places.get(index)
                if place is not None and value[1] is not None:
                    row[place], any_cell = value, True
                    if value[0] != TEXT or value[1] not in _MISSING:
                        filled[place] += 1
            if any_cell:
                yield _Record("row", path, sheet, key, row_number=number, layout=layout), row
    names = list(headers.values())
    yield _Record("sheet", path, sheet, key, None, names, name_keys, last - 1, layout=layout, filled=filled), []


def _workbook_records(path: str, opened: Callable[[], BinaryIO], wanted: Sequence[str], part: str | None = None) -> Iterator[tuple]:
    """Records of a workbook, or of one part of it: a worksheet, or the directory.

    A worksheet that is read alone adds a ``workbook`` record only if it fails.
    """
    names: list[str] = []
    error = None
    try:
        with opened() as stream:
            if not stream.seek(0, io.SEEK_END):
                raise ValueError("The file is empty.")
            book = _Book(stream)
            names = list(book.sheets)
            for name in names:
                if canonical_name(name) in wanted and part in (None, name):
                    yield from _sheet_records(book, path, name, canonical_name(name))
    except Exception as failure:  # an unreadable file is a finding, not a crash
        error = f"{type(failure).__name__}: {failure}"
    if error or part in (None, DIRECTORY):
        name_keys = [canonical_name(name) for name in names]
        yield _Record("workbook", path, names=names, name_keys=name_keys, error=error), []


def _to_arrow(block: list[tuple[_Record, list[tuple[str | None, str | None]]]]) -> pa.RecordBatch:
    """Records and their cells as one batch, built column by column."""
    plain = zip(*[record for record, _ in block], strict=True)
    offsets = list(accumulate((len(cells) for _, cells in block), initial=0))
    values = [value for _, cells in block for value in cells]
    kinds, texts = pa.array([v[0] for v in values], pa.string()), pa.array([v[1] for v in values], pa.string())
    cell_list = pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([kinds, texts], ["kind", "text"])
    )
    columns = [pa.array(v, f.type) for v, f in zip(plain, _PLAIN_FIELDS, strict=True)]
    return pa.RecordBatch.from_arrays([*columns, cell_list], schema=_ARROW_SCHEMA)


def _blocks(path: str, opened: Callable[[], BinaryIO], wanted: Sequence[str], part: str | None = None) -> Iterator[pa.RecordBatch]:
    records = _workbook_records(path, opened, wanted, part)
    while block := list(islice(records, _RECORDS_PER_BATCH)):
        yield _to_arrow(block)


def parse_workbooks(files: DataFrame, contract: Contract) -> DataFrame:
    """Records of every workbook in ``files`` (``path``, ``content``)."""
    wanted = contract.sheet_keys

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for index in range(batch.num_rows):
                content = batch["content"][index].as_py()
                yield from _blocks(batch["path"][index].as_py(), lambda content=content: io.BytesIO(content), wanted)

    return files.select("path", "content").mapInArrow(read, RECORD_SCHEMA)


def unit_lister(stores: Stores, wanted: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``path, part, length`` of large workbooks: the directory, and each expected worksheet with its packed size.

    Only the directory at the end of a file is read. Where it cannot be read, the unit of the directory reports that.
    """

    def list_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                parts = [(DIRECTORY, 0)]
                try:
                    with open_ranges(stores, path) as stream:
                        book = _Book(stream)
                        parts += [(name, book.packed_size(name)) for name in book.sheets if canonical_name(name) in wanted]
                except Exception:  # reported when the unit is read
                    parts = parts[:1]
                columns = [[path] * len(parts), *map(list, zip(*parts, strict=True))]
                kinds = (pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["path", "part", "length"])

    return list_units


def scan_workbooks(files: DataFrame, contract: Contract, large: int = LARGE_BYTES) -> DataFrame:
    """Records of the dated workbooks among ``files`` (``path``, ``length``, ``snapshot_date``).

    A task opens its units one after the other, so it holds one workbook of less than ``large`` bytes, or a block of rows and the
    shared texts of a large one, at a time. A file that cannot be opened is a finding like one that cannot be read.
    """
    wanted, stores = contract.sheet_keys, stores_of(files.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if part is None:
                    yield from _blocks(path, lambda path=path: io.BytesIO(read_bytes(stores, path)), wanted)
                else:
                    yield from _blocks(path, lambda path=path: open_ranges(stores, path), wanted, part)

    dated = files.filter(F.col("snapshot_date").isNotNull()).select("path", "length")
    whole = dated.filter(F.col("length") < large).select("path", F.lit(None).cast("string").alias("part"), "length")
    parts = dated.filter(F.col("length") >= large).select("path").mapInArrow(unit_lister(stores, wanted), "path STRING, part STRING, length BIGINT")
    return spread(whole.unionByName(parts)).select("path", "part").mapInArrow(read, RECORD_SCHEMA)


def _books(records: DataFrame) -> DataFrame:
    """One row per workbook; a worksheet that was read alone may have added an error."""
    found = records.filter(F.col("record") == "workbook")
    return found.groupBy("path").agg(F.max_by("names", F.size("names")).alias("names"), F.max_by("name_keys", F.size("names")).alias("name_keys"), F.min("error").alias("error"))


def workbook_list(records: DataFrame) -> DataFrame:
    """Readable workbooks with their sheet names."""
    found = _books(records).filter(F.col("error").isNull())
    return found.select("path", F.col("names").alias("sheets"), F.col("name_keys").alias("sheet_keys"))


def read_failures(records: DataFrame) -> DataFrame:
    """Workbooks that could not be read, with the reason."""
    return _books(records).filter(F.col("error").isNotNull()).select("path", "error")


def sheet_list(records: DataFrame) -> DataFrame:
    """Expected worksheets with their headers and number of data rows."""
    return records.filter(F.col("record") == "sheet").select(
        "path",
        "sheet",
        "sheet_key",
        F.col("names").alias("headers"),
        F.col("name_keys").alias("header_keys"),
        "raw_rows",
        filled_by_header().alias("filled_cells"),
    )


def filled_by_header() -> Column:
    """Cells with a value by canonical header, as a map; of colliding headers the first counts."""
    keys = F.array_distinct("name_keys")
    count = F.transform(
        keys, lambda key: F.get("filled", F.array_position("name_keys", key).cast("int") - 1).cast("bigint")
    )
    return F.map_from_arrays(keys, count)


def source_columns(headers: Sequence[str]) -> list[str]:
    """Headers that name a column: not empty and not a placeholder."""
    return [name for name in headers if name and not name.startswith("unnamed")]


def cell_text(cell: Column) -> Column:
    """Text of a cell; only text cells can hold a missing token."""
    return F.when(cell["kind"] == TEXT, missing_to_null(cell["text"])).otherwise(cell["text"])


def _read_columns(columns: Sequence[str], contract: Contract) -> list[str]:
    note = contract.follow_up_notes_column
    return [*columns, *([note] if note not in columns else [])]


def layouts(records: DataFrame, columns: Sequence[str], contract: Contract) -> DataFrame:
    """For every list of headers, where each column to read stands in it (0: nowhere); one row per list."""
    wanted = F.array(*[F.lit(name) for name in _read_columns(columns, contract)]).cast("array<string>")
    known = records.filter(F.col("record") == "sheet").select("layout", "name_keys").distinct()
    return known.select(
        "layout", F.transform(wanted, lambda name: F.array_position("name_keys", name).cast("int")).alias("places")
    )


def sheet_rows(
    records: DataFrame, columns: Sequence[str], contract: Contract, places: DataFrame | None = None
) -> DataFrame:
    """Worksheet rows with one text column per source column, taken by its place in the row.

    ``places`` are the :func:`layouts` of the records, if a caller has written them; else they are written here. Only the
    size of a written table tells Spark how small it is, and nearly all rows can have one layout: dealt by it, they would
    meet in one task.

    Two kinds of cells mean more than their text: a flag in a number column counts as
    one or zero, and a date in the notes column is kept beside the text.
    """
    note, named = contract.follow_up_notes_column, _read_columns(columns, contract)
    if places is None:
        places = Stage(records.sparkSession).write(layouts(records, columns, contract), "layouts")
    rows = records.filter(F.col("record") == "row").join(places, "layout")
    cells = {name: F.get("cells", F.get("places", F.lit(i)) - 1) for i, name in enumerate(named)}
    values = []
    for name in columns:
        value = cell_text(cells[name])
        if name in contract.number_columns:
            flag = F.when(cells[name]["text"] == "True", "1").otherwise("0")
            value = F.when(cells[name]["kind"] == FLAG, flag).otherwise(value)
        values.append(value.alias(name))
    return rows.select(
        F.col("path").alias(ROW_PATH),
        F.col("sheet_key").alias(ROW_SHEET),
        F.col("row_number").alias(ROW_NUMBER),
        *values,
        F.when(cells[note]["kind"] == DATE, cells[note]["text"].try_cast("date")).alias(NOTE_CELL_DATE),
    )
