"""Zipped office documents as rows: one for each paragraph, of body blocks, table cells and page headers.

Parsing ends at the edge: links, objects and numbering are resolved within a file, and all analytics are DataFrame plans on the rows.
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame

SCHEMA = (
    "path string, part string, block_no int, kind string, row_no int, cell_no int, para_no int, text string, style string, any_bold boolean, all_bold boolean, "
    "num_id string, abstract_id string, level int, number_start int, number_format string, shaded boolean, header_row boolean, links array<string>, "
    "objects array<struct<program:string,target:string,external:boolean,shape:string>>, error string"
)
_OBJECT = pa.struct([("program", pa.string()), ("target", pa.string()), ("external", pa.bool_()), ("shape", pa.string())])
_ARROW = pa.schema([
    ("path", pa.string()), ("part", pa.string()), ("block_no", pa.int32()), ("kind", pa.string()), ("row_no", pa.int32()), ("cell_no", pa.int32()), ("para_no", pa.int32()),
    ("text", pa.string()), ("style", pa.string()), ("any_bold", pa.bool_()), ("all_bold", pa.bool_()), ("num_id", pa.string()), ("abstract_id", pa.string()), ("level", pa.int32()),
    ("number_start", pa.int32()), ("number_format", pa.string()), ("shaded", pa.bool_()), ("header_row", pa.bool_()), ("links", pa.list_(pa.string())),
    ("objects", pa.list_(_OBJECT)), ("error", pa.string()),
])


def local(name: str) -> str:
    return name.rsplit("}", 1)[-1]


def _attr(node: ElementTree.Element | None, name: str, default: str = "") -> str:
    if node is None:
        return default
    return next((v for k, v in node.attrib.items() if local(k) == name), default)


def _child(node: ElementTree.Element | None, *names: str) -> ElementTree.Element | None:
    for name in names:
        node = next((c for c in node if local(c.tag) == name), None) if node is not None else None
    return node


def _all(node: ElementTree.Element, name: str) -> Iterator[ElementTree.Element]:
    return (n for n in node.iter() if local(n.tag) == name)


def _rows(node: ElementTree.Element, name: str) -> Iterator[ElementTree.Element]:
    """Children of this name, also inside content controls and the like, but not those of a nested table."""
    for c in node:
        if local(c.tag) == name:
            yield c
        elif local(c.tag) in ("sdt", "sdtContent", "customXml", "ins", "smartTag"):
            yield from _rows(c, name)


class _Part:
    """One XML part with its relations and the numbering of its file."""

    def __init__(self, archive: zipfile.ZipFile, name: str, numbering: dict) -> None:
        self.root, self.numbering = ElementTree.fromstring(archive.read(name)), numbering
        rels = f"{posixpath.dirname(name)}/_rels/{posixpath.basename(name)}.rels"
        self.rels: dict[str, tuple[str, bool]] = {}
        if rels in archive.namelist():
            self.rels = {_attr(r, "Id"): (_attr(r, "Target"), _attr(r, "TargetMode") == "External") for r in ElementTree.fromstring(archive.read(rels))}

    def paragraph(self, p: ElementTree.Element) -> dict:
        runs = [(r, "".join(t.text or "" for t in _all(r, "t"))) for r in _all(p, "r")]
        bold = [(b := _child(r, "rPr", "b")) is not None and _attr(b, "val", "1") not in ("0", "false") for r, t in runs if t.strip()]
        number = _child(p, "pPr", "numPr")
        num_id, level = _attr(_child(number, "numId"), "val") or None, int(_attr(_child(number, "ilvl"), "val", "0") or 0)
        abstract, start, form = self.numbering.get((num_id, level), (None, None, None))
        return {
            "text": "".join(t for _, t in runs), "style": _attr(_child(p, "pPr", "pStyle"), "val"), "any_bold": any(bold), "all_bold": bool(bold) and all(bold),
            "num_id": num_id, "abstract_id": abstract, "level": level if num_id else None, "number_start": start, "number_format": form,
            "links": self.links(p, runs), "objects": [o for n in _all(p, "OLEObject") if (o := self.object(n))],
        }

    def links(self, p: ElementTree.Element, runs: list) -> list[str]:
        """Targets of link elements with their anchors, then texts of neighbouring runs in the link style; each once."""
        found = []
        for link in _all(p, "hyperlink"):
            target, anchor = self.rels.get(_attr(link, "id"), ("", False))[0], _attr(link, "anchor")
            if target and not anchor.startswith("_Toc"):
                found.append(f"{target}#{anchor}" if anchor else target)
        styled = ""
        for run, text in [*runs, (None, "")]:
            if run is not None and _attr(_child(run, "rPr", "rStyle"), "val") == "Hyperlink":
                styled += text
            else:
                found.append(styled.strip())
                styled = ""
        return list(dict.fromkeys(u for u in found if u.startswith("http")))

    def object(self, node: ElementTree.Element) -> dict | None:
        if (rel := self.rels.get(_attr(node, "id"))) is None:
            return None
        return {"program": _attr(node, "ProgID"), "target": rel[0], "external": rel[1], "shape": _attr(node, "ShapeID")}

    def rows(self) -> Iterator[dict]:
        body = _child(self.root, "body")
        body = self.root if body is None else body
        for block, node in enumerate(c for c in body if local(c.tag) in ("p", "tbl")):
            if local(node.tag) == "p":
                yield {"block_no": block, "kind": "p", "para_no": 0, **self.paragraph(node)}
            else:
                yield from ({"block_no": block, "kind": "tbl", **r} for r in self.table(node))

    def table(self, table: ElementTree.Element) -> Iterator[dict]:
        above: dict[int, ElementTree.Element] = {}
        for row_no, row in enumerate(_rows(table, "tr")):
            head, column = _child(row, "trPr", "tblHeader") is not None, 0
            for cell_no, cell in enumerate(_rows(row, "tc")):
                merge = _child(cell, "tcPr", "vMerge")
                # A cell that continues a vertical merge shows what the cell above it began.
                shown = above.get(column, cell) if merge is not None and _attr(merge, "val", "continue") == "continue" else cell
                above[column] = shown
                column += int(_attr(_child(cell, "tcPr", "gridSpan"), "val", "1") or 1)
                shade = _attr(_child(shown, "tcPr", "shd"), "fill", "auto")
                for para_no, p in enumerate(_rows(shown, "p")):
                    yield {"row_no": row_no, "cell_no": cell_no, "para_no": para_no, "shaded": shade.lower() not in ("auto", "ffffff", ""), "header_row": head, **self.paragraph(p)}


def _numbering(archive: zipfile.ZipFile) -> dict:
    """(numId, level): (abstract id, start, format); an override of a start wins."""
    if "word/numbering.xml" not in archive.namelist():
        return {}
    root = ElementTree.fromstring(archive.read("word/numbering.xml"))
    whole = lambda v, default: int(v) if v.isdigit() else default
    levels = {_attr(a, "abstractNumId"): {whole(_attr(v, "ilvl"), 0): (whole(_attr(_child(v, "start"), "val"), 1), _attr(_child(v, "numFmt"), "val")) for v in _rows(a, "lvl")} for a in _rows(root, "abstractNum")}
    out = {}
    for num in _rows(root, "num"):
        abstract = _attr(_child(num, "abstractNumId"), "val")
        starts = {whole(_attr(o, "ilvl"), 0): _attr(_child(o, "startOverride"), "val") for o in _rows(num, "lvlOverride")}
        for level, (start, form) in levels.get(abstract, {}).items():
            out[_attr(num, "numId"), level] = (abstract, whole(starts.get(level, ""), start), form)
    return out


def parse(path: str, content: bytes | None) -> Iterator[dict]:
    """Rows of one file; a file that cannot be opened or has no paragraph gives one row without a block."""
    try:
        with zipfile.ZipFile(io.BytesIO(content or b"")) as archive:
            numbering = _numbering(archive)
            names = ["word/document.xml", *sorted(n for n in archive.namelist() if re.fullmatch(r"word/header\d+\.xml", n))]
            found = [{"path": path, "part": n, **r} for n in names for r in _Part(archive, n, numbering).rows()]
        yield from found or [{"path": path}]
    except Exception as e:  # noqa: BLE001  what a broken file raises has no bound; the row tells
        yield {"path": path, "error": f"{type(e).__name__}: {e}"[:200]}


def paragraphs(files: DataFrame) -> DataFrame:
    """Rows of SCHEMA for files (path, content). Order: part, block_no, row_no, cell_no, para_no. kind: p or tbl. One task holds one file at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                yield pa.RecordBatch.from_pylist(list(parse(path.as_py(), content.as_py())), schema=_ARROW)

    return files.select("path", "content").mapInArrow(run, SCHEMA)
