"""Workbooks, written row by row with no library: memory does not grow with the rows."""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterable, Iterator
from xml.sax.saxutils import escape, quoteattr

from pyspark.sql import DataFrame

# Fixed values of the format.
MOST_ROWS, MOST_NAME, MOST_CHARS = 1_048_576, 31, 32_767
_NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
_PKG = "http://schemas.openxmlformats.org/package/2006"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_TYPE = "application/vnd.openxmlformats-officedocument.spreadsheetml"


def sheet_name(name: str, taken: set[str]) -> str:
    """A legal name, not taken before in any case; a number is added where it is."""
    base = re.sub(r"[\[\]:*?/\\]", " ", name).strip().strip("'")[:MOST_NAME] or "Sheet"
    found, n = base, 1
    while found.lower() in taken:
        n += 1
        found = f"{base[: MOST_NAME - len(str(n)) - 1]}_{n}"
    taken.add(found.lower())
    return found


def _cell(value: object) -> str:
    if value is None or value == "":
        return "<c/>"
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return f"<c><v>{value}</v></c>"
    text = re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", lambda m: "\n" if m.group() == "\x0b" else "", str(value))[:MOST_CHARS]
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>'


def write(path: str, sheets: Iterable[tuple[str, list[str], Iterable]]) -> list[str]:
    """Sheets of (name, header, rows) as one workbook; a sheet that is full goes on in another one. Returns the names."""
    names: list[str] = []
    taken: set[str] = set()
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, header, rows in sheets:
            left: Iterator = iter(rows)
            row = next(left, None)
            while True:
                names.append(sheet_name(name, taken))
                with z.open(f"xl/worksheets/sheet{len(names)}.xml", "w", force_zip64=True) as f:
                    put = lambda cells: f.write(f"<row>{''.join(map(_cell, cells))}</row>".encode())  # noqa: B023, E731
                    f.write(f'<?xml version="1.0" encoding="UTF-8"?><worksheet {_NS}><sheetData>'.encode())
                    put(header)
                    n = 1
                    while row is not None and n < MOST_ROWS:
                        put(row)
                        row, n = next(left, None), n + 1
                    f.write(b"</sheetData></worksheet>")
                if row is None:
                    break
        numbers = range(1, len(names) + 1)
        z.writestr("xl/workbook.xml", f"<workbook {_NS}><sheets>" + "".join(f'<sheet name={quoteattr(s)} sheetId="{k}" r:id="r{k}"/>' for k, s in zip(numbers, names, strict=True)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{_PKG}/relationships">' + "".join(f'<Relationship Id="r{k}" Type="{_REL}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in numbers) + "</Relationships>")
        z.writestr("_rels/.rels", f'<Relationships xmlns="{_PKG}/relationships"><Relationship Id="r1" Type="{_REL}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="{_TYPE}.worksheet+xml"/>' for k in numbers)
        z.writestr("[Content_Types].xml", f'<Types xmlns="{_PKG}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{_TYPE}.sheet.main+xml"/>{kinds}</Types>')
    return names


def write_report(path: str, reports: dict[str, DataFrame]) -> list[str]:
    """One sheet for each DataFrame, in its order. Rows come to the driver one partition at a time; lists are joined by lines."""
    flat = lambda v: "\n".join(map(str, v)) if isinstance(v, list) else v
    return write(path, ((name, df.columns, ([flat(v) for v in row] for row in df.toLocalIterator())) for name, df in reports.items()))


def write_layouts(path: str, sheets: dict[str, tuple[list[str], DataFrame]]) -> list[str]:
    """One sheet for each header and layout of plans.reports, in the order of its places. Rows come to the driver one partition at a time."""
    return write(path, ((name, header, (row.cells for row in df.orderBy("place").select("cells").toLocalIterator())) for name, (header, df) in sheets.items()))
