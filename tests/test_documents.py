"""Office files made here, through sources, plans, sinks and the stream."""

import io
import struct
import zipfile

import pytest

from plumbago.functions import payload
from plumbago.plans import documents as D
from plumbago.sinks import payloads, xlsx
from plumbago.sources import compound, docx, files

W = 'xmlns:w="w" xmlns:r="r" xmlns:o="o"'


def para(text, style="", bold=False, extra=""):
    return f'<w:p><w:pPr><w:pStyle w:val="{style}"/>{extra}</w:pPr><w:r><w:rPr>{"<w:b/>" if bold else ""}</w:rPr><w:t>{text}</w:t></w:r></w:p>'


def cell(*paras, fill="auto"):
    return f'<w:tc><w:tcPr><w:shd w:fill="{fill}"/></w:tcPr>{"".join(p if p.startswith("<") else para(p) for p in paras)}</w:tc>'


def table(*rows):
    return "<w:tbl>" + "".join(f"<w:tr>{''.join(c if c.startswith('<w:tc') else cell(c) for c in r)}</w:tr>" for r in rows) + "</w:tbl>"


def link(rid):
    return f'<w:p><w:hyperlink r:id="{rid}"><w:r><w:t>here</w:t></w:r></w:hyperlink></w:p>'


def document(*blocks, rels=(), **parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {W}><w:body>{''.join(blocks)}</w:body></w:document>")
        z.writestr("word/_rels/document.xml.rels", "<R>" + "".join(f'<Relationship Id="{i}" Target="{t}"/>' for i, t in rels) + "</R>")
        for name, body in parts.items():
            z.writestr(f"word/{name}.xml", body)
    return out.getvalue()


def parsed(spark, **contents):
    rows = [(name, content) for name, content in contents.items()]
    return docx.paragraphs(spark.createDataFrame(rows, "path string, content binary"))


def test_header_fields(spark):
    header = lambda *rows: f"<w:hdr {W}>{table(*rows)}</w:hdr>"
    content = document(header10=header([cell("Organisation: Acme"), cell("SOP No:", "FIN-01")], ["Confidential", ""]), header2=header(["Other: x"]))
    got = D.header_fields(parsed(spark, a=content)).orderBy("row_no", "cell_no").collect()
    assert [(r.label, r.value) for r in got] == [("Organisation", "Acme"), ("SOP No:", "FIN-01"), ("", "Confidential")]


def test_sections(spark):
    heads = [para(f"Part {k}", "Heading1") for k in range(1, 18)]
    found = document(*heads[:16], table(["A", "B"], ["1", "2"]), heads[16], table(["C", "D"]))
    rows = D.section_tables(parsed(spark, found=found, few=document(*heads[:15]), broken=b"no zip"))
    got = {(r.path, r.section, tuple(r.cells or ())) for r in rows.collect()}
    assert got == {("found", "16\tPart 16", ("A", "B")), ("found", "16\tPart 16", ("1", "2")), ("few", "Section 16 Not Found", ()), *((r.path, r.section, ()) for r in rows.collect() if r.section.startswith("ERROR"))}
    assert {r.path for r in rows.collect()} == {"found", "few", "broken"}
    assert [tuple(r) for r in D.tables_by_header(rows).collect()] == [("A | B", 1, 1)]


def test_links(spark):
    number = '<w:numPr><w:ilvl w:val="0"/><w:numId w:val="3"/></w:numPr>'
    numbering = f'<w:numbering {W}><w:abstractNum w:abstractNumId="7"><w:lvl w:ilvl="0"><w:start w:val="1"/><w:numFmt w:val="decimal"/></w:lvl></w:abstractNum><w:num w:numId="3"><w:abstractNumId w:val="7"/></w:num></w:numbering>'
    rels = [("r1", "https://example.org/a"), ("r2", "mailto:x")]
    shaded = document(para("Objective", "Heading1", extra=number), table([cell("Name", fill="D9D9D9"), cell("Link", fill="D9D9D9")], ["Guide", cell(link("r1"))]), link("r1"), rels=rels, numbering=numbering)
    plain = document(table(["Name", "Link"], ["Guide", cell(link("r1"))]), rels=rels)
    got = {(r.path, r.section, r.table_flag, r.row_label, r.row_label_col, r.url_col, r.url) for r in D.link_inventory(parsed(spark, shaded=shaded, plain=plain, mail=document(link("r2"), rels=rels), broken=b"")).collect()}
    url = "https://example.org/a"
    assert got == {
        ("shaded", "1 Objective", "Within Table", "Guide", "Name", "Link", url), ("shaded", "1 Objective", "Outside Table", "", "", "", url),
        ("plain", "", "Within Table", "Guide", "", "B", url), ("mail", None, None, None, None, None, "No Hyperlink found"),
    }


def test_performance(spark):
    content = document(para("Process Performance", "Heading2"), table(["Process", "SLA", "Targets"], ["Pay", "5d", cell("KPI A: 95", "within month")], ["Pay", "5d", "KPI B: 90"]))
    got = D.performance_rows(parsed(spark, a=content)).orderBy("slot").collect()
    assert [(r.cells, r.slot_header, r.slot_value) for r in got] == [(["Pay", "5d"], "Targets 1", "KPI A: 95\nwithin month"), (["Pay", "5d"], "Targets 2", "KPI B: 90")]


def test_risks(spark):
    head = para("Process Risk", "Heading1")
    good = document(head, table(["Log", "Log"], ["Reference", "Risk"], ["R1", "x"], ["", "y"], ["Reference Note: z", "w"]))
    rows = D.risk_tables(parsed(spark, good=good, bad=document(head, table(["", "Risk", "Control"])), none=document(head), other=document(para("x")), broken=b"?"))
    got = {(r.path, r.outcome, r.reason if r.outcome == "skipped" else None, tuple(r.cells or ())) for r in rows.collect()}
    assert got == {("good", "block", None, ("R1", "x")), ("bad", "skipped", "Table Structure Not Correct", ()), ("none", "skipped", "Table Not Found", ()), ("other", "skipped", "Process Risk Section Not Found", ()), ("broken", "failed", None, ())}
    assert {tuple(r) for r in D.risk_summary(rows).collect()} == {("block", 1), ("skipped", 3), ("failed", 1), ("Total", 5)}


def test_objects(spark):
    ole = lambda rid, program: f'<w:p><w:r><w:object><o:OLEObject ProgID="{program}" ShapeID="s" r:id="{rid}"/></w:object></w:r></w:p>'
    rels = [("x", "embeddings/a.xlsx"), ("p", "embeddings/b.bin"), ("h", "https://example.org/c%20d.docx"), ("n", "e.bin")]
    content = document(para("Data", "Heading1"), table([cell("H0", fill="CCCCCC"), "H1"], ["Row", cell(ole("x", "Excel.Sheet.12"))]), ole("p", "Acrobat.Document"), ole("h", ""), ole("n", ""), ole("lost", ""), rels=rels)
    got = [(r.type, r.linked, r.row_label, r.object_col) for r in D.object_inventory(parsed(spark, a=content)).orderBy("block_no").collect()]
    assert got == [("Excel", False, "Row", "H1"), ("PDF", False, "", ""), ("Word", True, "", "")]


def test_words_and_steps(spark):
    heads = table(["No", "Step"], ["1", "Post the vendor invoice"], ["2", "Two words"])
    rows = parsed(spark, a=document(para("Process Steps", "Heading1"), para("parking Park park_1"), heads), b=document(para("Process Steps", "Heading1"), para("Other", "Heading1"), heads), c=b"")
    hits, without = D.word_search(rows, ["park"])
    assert [tuple(r) for r in hits.collect()] == [("a", "Park")]
    assert sorted(r.path for r in without.collect()) == ["b", "c"]
    assert [(r.path, r.step) for r in D.steps(rows).collect()] == [("a", "Post the vendor invoice")]


def test_vertical_merge():
    merge = lambda v, text: f'<w:tc><w:tcPr><w:vMerge{v}/></w:tcPr>{para(text)}</w:tc>'
    content = document(table([merge(' w:val="restart"', "top"), "x"], [merge("", ""), "y"]))
    assert [r["text"] for r in docx.parse("a", content)] == ["top", "x", "top", "y"]


def compound_file(streams, cyclic=False):
    """A compound file of 512-byte sectors: FAT, directory, mini FAT, mini stream, then large streams."""
    small = {k: v for k, v in streams.items() if len(v) < 4096}
    large = {k: v for k, v in streams.items() if len(v) >= 4096}
    mini, mini_fat, entries = b"", [], []
    for name, body in small.items():
        n, first = -(-len(body) // 64), len(mini_fat)
        mini_fat += [*range(first + 1, first + n), 0xFFFFFFFE]
        mini += body.ljust(n * 64, b"\0")
        entries.append((name, first, len(body)))
    pad = lambda b: b.ljust(-(-len(b) // 512) * 512, b"\0")
    directory_sectors = -(-(len(streams) + 1) // 4)
    chains = [("dir", directory_sectors), ("minifat", 1), ("mini", max(1, len(pad(mini)) // 512)), *((k, len(pad(v)) // 512) for k, v in large.items())]
    fat, starts = [0xFFFFFFFD], {}
    for name, n in chains:
        starts[name] = len(fat)
        fat += [*range(len(fat) + 1, len(fat) + n), 0xFFFFFFFE]
    if cyclic:
        fat[starts[next(iter(large))] + 1] = starts[next(iter(large))]
    entries += [(k, starts[k], len(v)) for k, v in large.items()]
    entry = lambda name, kind, right, child, start, size: (name.encode("utf-16-le") + b"\0\0").ljust(64, b"\0") + struct.pack("<HBBIII", 2 * len(name) + 2, kind, 1, 0xFFFFFFFF, right, child) + bytes(36) + struct.pack("<III", start, size, 0)
    directory = entry("Root Entry", 5, 0xFFFFFFFF, 1, starts["mini"], len(mini)) + b"".join(entry(n, 2, k + 2 if k + 1 < len(entries) else 0xFFFFFFFF, 0xFFFFFFFF, s, z) for k, (n, s, z) in enumerate(entries))
    header = compound.MAGIC + bytes(16) + struct.pack("<HHHHH", 62, 3, 0xFFFE, 9, 6) + bytes(10) + struct.pack("<IIIIIIIII", 1, starts["dir"], 0, 4096, starts["minifat"], 1, 0xFFFFFFFE, 0, 0) + b"\xff" * 432
    numbers = lambda x: struct.pack(f"<{len(x)}I", *x).ljust(512, b"\xff")
    return header + numbers(fat) + pad(directory).ljust(directory_sectors * 512, b"\0") + numbers(mini_fat) + pad(mini or b"\0") + b"".join(map(pad, large.values()))


def test_compound(spark):
    streams = {"WordDocument": "Heading\rhttp://example.org\rend".encode("cp1252"), "Package": bytes(range(256)) * 20}
    found = compound.streams(spark.createDataFrame([("a", compound_file(streams)), ("b", b"no")], "path string, content binary"))
    rows = found.collect()
    assert {r["name"]: bytes(r.content) for r in rows if r.path == "a"} == streams
    assert [r.error is not None for r in rows if r.path == "b"] == [True]
    cut = compound.segments(compound.document_text(found)).orderBy("segment_no").collect()
    assert [(r.pos, r.segment) for r in cut] == [(0, "Heading"), (8, "http://example.org"), (27, "end")]
    assert dict((n, c) for _, _, n, c in compound.Compound(compound_file(streams, cyclic=True)).streams())["WordDocument"] == streams["WordDocument"]


def test_payloads(spark, tmp_path):
    raw = b"\0\0\0\0\2\0a.pdf\0c:\\a.pdf\0\0\0\0\0t\0" + struct.pack("<I", 3) + b"abc"
    assert payload.native(raw) == ("a.pdf", "c:\\a.pdf", b"abc")
    assert payload.payload({"\x01Ole10Native": raw}) == (b"abc", "a.pdf", ".pdf")
    assert payload.pdf_body(b"x%PDF-1 %%EOF y %%EOF z") == b"%PDF-1 %%EOF y %%EOF"
    assert payload.markers(b"a\x14\x01\x15b\x14\x01\x15") == [1, 5]
    assert [payload.verified(*a) for a in ((b"", ".pdf"), (b"%PDF-", ".pdf"), (b"zz", ".xlsx"))] == [(False, "missing or empty"), (True, "OK (5b)"), (False, "invalid xlsx")]
    rows = spark.createDataFrame([("f", "x.bin", 1, b"1"), ("f", "X.bin", 2, b"2")], "folder string, name string, payload_no int, content binary")
    payloads.write(payloads.named(rows), str(tmp_path))
    assert {p.name: p.read_bytes() for p in (tmp_path / "f").iterdir()} == {"x.bin": b"1", "X_2.bin": b"2"}


def test_workbook(spark, tmp_path):
    path = str(tmp_path / "r.xlsx")
    assert xlsx.write_report(path, {"A/B": spark.createDataFrame([("x\x01<", 1)], "s string, n int"), "a:b": spark.range(2)}) == ["A B", "a b_2"]
    with zipfile.ZipFile(path) as z:
        assert b"x&lt;" in z.read("xl/worksheets/sheet1.xml") and z.testzip() is None
    assert payload.verified((tmp_path / "r.xlsx").read_bytes(), ".xlsx")[0]


def test_scan_and_stream(spark, tmp_path):
    from plumbago.streaming import files as live

    (tmp_path / "in/sub").mkdir(parents=True)
    for name in ("a.docx", "sub/b.DOCX", "~$c.docx", "a.doc", "d.txt"):
        (tmp_path / "in" / name).write_bytes(document(para("text")))
    listing = files.scan(spark, str(tmp_path / "in")).drop("content")
    assert sorted(r.file_name for r in listing.collect()) == ["a.doc", "a.docx", "b.DOCX"]
    assert sorted(r.path.rsplit("/", 1)[-1] for r in files.prefer_docx(listing).collect()) == ["a.docx", "b.DOCX"]
    out = str(tmp_path / "out")
    for _ in range(2):  # the second run finds nothing new
        live.append(live.paragraph_stream(spark, str(tmp_path / "in")), out, str(tmp_path / "log")).awaitTermination(60)
    assert [r.text for r in spark.read.parquet(out).collect()] == ["text", "text"]


@pytest.mark.parametrize("text", ["http://a", "æøå"])
def test_decoding(text):
    assert compound.decoded(text.encode("cp1252" if text.startswith("http") else "utf-16-le")) == text


def test_step_matches(spark):
    made = lambda *steps: document(para("Process Steps", "Heading1"), table(["No", "Step"], *(["1", s] for s in steps)))
    found = D.steps(parsed(spark, a=made("Post the vendor invoice", "Water all green plants"), b=made("Post the supplier bill"), c=made("Post the vendor invoice")))
    groups = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2)], "path string, group int")
    got = sorted((r.path, r.step, r["rank"], r.pct >= 99) for r in D.step_matches(found, groups).collect())
    assert got == [("a", "Post the vendor invoice", 1, True), ("b", "Post the supplier bill", 1, True)]
