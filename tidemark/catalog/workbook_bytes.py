"""Workbook files for the registered queries and the tests."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Mapping, Sequence
from datetime import date
from xml.sax.saxutils import escape, quoteattr

_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_RELATIONS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"
_DATE_STYLE = 1  # second cell style of _STYLES, built-in date format 14
_STYLES = f'<styleSheet xmlns="{_MAIN}"><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>'


def column_letters(index: int) -> str:
    letters = ""
    index += 1
    while index:
        index, digit = divmod(index - 1, 26)
        letters = chr(65 + digit) + letters
    return letters


def _cell(reference: str, value: object) -> str:
    if value is None or value != value:
        return ""
    if isinstance(value, bool):
        return f'<c r="{reference}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, int | float):
        return f'<c r="{reference}"><v>{value}</v></c>'
    if isinstance(value, date):
        serial = (value - date(1899, 12, 30)).days
        return f'<c r="{reference}" s="{_DATE_STYLE}"><v>{serial}</v></c>'
    text = escape(str(value))
    return f'<c r="{reference}" t="inlineStr"><is><t xml:space="preserve">{text}</t></is></c>'


def _sheet(rows: Sequence[Sequence[object]]) -> str:
    lines = []
    for number, row in enumerate(rows, start=1):
        cells = "".join(_cell(f"{column_letters(i)}{number}", value) for i, value in enumerate(row))
        lines.append(f'<row r="{number}">{cells}</row>')
    return f'<worksheet xmlns="{_MAIN}"><sheetData>{"".join(lines)}</sheetData></worksheet>'


def workbook_bytes(sheets: Mapping[str, Sequence[Sequence[object]]]) -> bytes:
    """A workbook file of the given sheets; the first row of a sheet is its header."""
    entries, relations = [], []
    for number, name in enumerate(sheets, start=1):
        entries.append(f'<sheet name={quoteattr(name)} sheetId="{number}" r:id="rId{number}"/>')
        relations.append(
            f'<Relationship Id="rId{number}" Type="{_RELATIONS}/worksheet" '
            f'Target="worksheets/sheet{number}.xml"/>'
        )
    parts = {
        "xl/workbook.xml": f'<workbook xmlns="{_MAIN}" xmlns:r="{_RELATIONS}">'
        f"<sheets>{''.join(entries)}</sheets></workbook>",
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{_PACKAGE}">'
        f"{''.join(relations)}</Relationships>",
        "xl/styles.xml": _STYLES,
    }
    for number, rows in enumerate(sheets.values(), start=1):
        parts[f"xl/worksheets/sheet{number}.xml"] = _sheet(rows)
    target = io.BytesIO()
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, body in parts.items():
            archive.writestr(name, '<?xml version="1.0" encoding="UTF-8"?>' + body)
    return target.getvalue()
