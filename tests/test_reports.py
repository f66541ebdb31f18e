"""Report layouts, steps from office files and their groups, links before the first heading, and binary documents' edge cases."""

import zipfile

from pyspark.sql import functions as F

from plumbago.plans import binary_links, binary_objects, binary_risks, documents as D, reports as R
from plumbago.sinks import xlsx
from tests.test_documents import cell, document, link, para, parsed, table


def cells(layout):
    return [tuple(r.cells) for r in layout.orderBy("place").collect()]


def test_steps_of_all_kinds(spark):
    over = table(["Id", "Process Description"], ["1", "post the vendor invoice"], ["2", "two words"], ["3", "post the vendor invoice"])
    detail = table(["Id", "Work Instruction"], ["1", "post the vendor invoice"], ["2", "check it all twice"], ["3", "check it all twice"])
    rows = parsed(
        spark,
        both=document(para("Activities Overview", "Heading1"), para(""), over, para("DETAILED PROCESS STEPS"), detail),
        over=document(para("Process Overview", bold=True), over, para("Process Steps", "Heading1"), para("Else", "Heading2"), detail),
        detail=document(para("Procedure", "Title"), detail),
        lines=document(para("Process Steps", "Heading1"), para("1. Do it at once"), para("no number at all"), para("1.2 Too short"), para("Other", "Heading1"), para("2. Not to be taken")),
        none=document(para("nothing")),
    )
    got = [tuple(r) for r in D.all_steps(rows).orderBy("path", "step_no").collect()]
    post, check = "post the vendor invoice", "check it all twice"
    assert got == [
        ("both", 1, post, "Activities Overview + Detailed Steps"), ("both", 2, post, "Activities Overview + Detailed Steps"), ("both", 3, check, "Activities Overview + Detailed Steps"),
        ("detail", 1, post, "Detailed Process Steps"), ("detail", 2, check, "Detailed Process Steps"), ("lines", 1, "Do it at once", "Paragraph steps (fallback)"),
        ("over", 1, post, "SOP Activities Overview"), ("over", 2, post, "SOP Activities Overview"),
    ]


def test_group_rows(spark):
    rows = spark.createDataFrame([("Reference Documents", "c", ["none"]), ("Vendor Posting", "b", []), ("Vendor Posting", "a", ["x", "y"])], "group_name string, path string, lines array<string>")
    codes = spark.createDataFrame([("a", ["FB10", "FB20"])], "path string, codes array<string>")
    assert cells(R.groups(rows, codes)) == [("Vendor Posting", "a", "x\ny", "FB10, FB20"), (None, "b", R.NOTHING, R.NOTHING), ("Reference Documents", "c", "none", R.NOTHING)]


def test_links_before_the_first_heading_and_headers_of_the_table_before(spark):
    head = table([cell("Name", fill="D9D9D9"), cell("Target", fill="D9D9D9")])
    data = lambda rid: table(["x", cell(link(rid))])
    rels = [(f"r{k}", f"https://u/{k}") for k in range(4)]
    content = document(
        para("plain words"), para(""), data("r0"), para("Program Details", bold=True), head, para(""), data("r1"), link("r2"), para("Real", "Heading1"), para("Bold one", bold=True), data("r3"), rels=rels
    )
    got = {r.url: (r.section, r.row_label, r.row_label_col, r.url_col) for r in D.link_inventory(parsed(spark, a=content)).collect()}
    assert got["https://u/0"] == ("plain words", "x", "", "B") and got["https://u/1"] == ("Program Details", "x", "Name", "Target")
    assert got["https://u/2"][0] == "Program Details" and got["https://u/3"] == ("Real", "x", "", "B")


def test_section_and_header_sheets(spark):
    rows = spark.createDataFrame(
        [("f/a", "16\tS", 1, 0, ["A", "B"]), ("f/a", "16\tS", 1, 1, ["1", "2"]), ("f/b", "16\tT", 4, 0, ["C"]), ("f/c", "16\tT", 2, 0, ["A", "B"]), ("f/c", "16\tT", 2, 3, ["3", "4"]), ("f/d", "Section 16 Not Found", None, None, None)],
        "path string, section string, block_no int, row_no int, cells array<string>",
    )
    assert cells(R.section_tables(rows))[-1] == ("f", "d", "Section 16 Not Found", "(No tables found in Section 16)") and cells(R.section_tables(rows))[1] == ("f", "a", "16\tS", "1", "2")
    sheets = R.header_sheets(rows)
    assert cells(sheets.where("header_key = 'A | B'")) == [("Folder Name", "Word Doc Name", "A", "B"), ("f", "a", "1", "2"), ("f", "c", "3", "4")]
    assert cells(sheets.where("header_key = 'C'")) == [("Folder Name", "Word Doc Name", "C")]


def test_performance_layout(spark):
    rows = spark.createDataFrame(
        [("f/a", ["K"], ["x"], 0, "T 1", "p", 1), ("f/a", ["K"], ["x"], 1, "T 2", "q", 1), ("f/a", ["K"], ["y"], None, "T 1", None, 2), ("f/b", ["K", "L"], ["z"], 0, "T", "r", 1), ("f/b", ["K", "L"], ["u", "v"], 0, "T", "s", 3)],
        "path string, headers array<string>, cells array<string>, slot int, slot_header string, slot_value string, row_no int",
    )
    files = spark.createDataFrame([("f/a",), ("f/b",), ("f/c",)], "path string")
    assert cells(R.performance(rows, files)) == [
        ("f", "a", "K", "K", "T 1", "T 2"), ("f", "a", "K", "x", "p", "q"), ("f", "a", "K", "y", "", ""),
        ("f", "b", "K", "K", "L", "T"), ("f", "b", "K", "z", "", "r"), ("f", "b", "K", "u", "v", "s"), ("f", "c", "Table Not Found", "", "", ""),
    ]


def test_risk_layout_and_workbook(spark, tmp_path):
    rows = spark.createDataFrame(
        [("f/a", "block", None, 1, ["Ref", "Risk"], ["R1", "late"]), ("f/a", "block", None, 2, ["Ref", "Risk"], ["REF", "Risk"]), ("f/b", "block", None, 1, ["Ref"], ["R2"]), ("f/c", "skipped", "why", None, None, None), ("f/d", "failed", "bad", None, None, None)],
        "path string, outcome string, reason string, row_no int, headers array<string>, cells array<string>",
    )
    sheets = R.risks(rows)
    assert cells(sheets["Process Risk"]) == [("f", "a", "Ref", "Ref", "Risk"), ("f", "a", "Ref", "R1", "late"), ("f", "a", "Ref", "REF", "Risk"), ("f", "b", "Ref", "Ref", ""), ("f", "b", "Ref", "R2", "N/A")]
    assert [r.is_header for r in sheets["Process Risk"].orderBy("place").collect()] == [True, False, True, True, False]
    assert cells(sheets["Skipped"]) == [("f", "c", "why")] and cells(sheets["Failed"]) == [("f", "d")]
    assert cells(sheets["Summary"]) == [("block", "2"), ("failed", "1"), ("skipped", "1"), ("Total", "4")]
    assert [r.header for r in R.header_names(rows).orderBy("first").collect()] == ["Ref", "Risk"]
    path = str(tmp_path / "r.xlsx")
    assert xlsx.write_layouts(path, {name: (["Folder Name"], df) for name, df in sheets.items()}) == list(sheets)
    assert b"late" in zipfile.ZipFile(path).read("xl/worksheets/sheet1.xml")


def test_objects_words_and_groups(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([("f/a.docx", 1, "https://x", "C:\\in\\Output\\a\\b.xlsx", "t"), ("f/a.docx", 2, None, "C:\\in\\Output\\a\\b.xlsx", "t"), ("f/a.docx", 3, "", None, "t"), ("f/a.docx", 4, None, None, None)], "path string, k int, h string, s string, t string")
    found = rows.withColumns({c: F.lit(c) for c in ("section", "row_label", "row_label_col", "type", "object_col")})
    assert [c[6] for c in cells(R.objects(found, ["k"], R.shown_target(F.col("h"), F.col("s"), F.col("t"))))] == ["https://x", "Output/a/b.xlsx", "t", ""]
    hits, missed = spark.createDataFrame([("b", "x"), ("a", "y"), ("a", "x")], "path string, word string"), spark.createDataFrame([("c",)], "path string")
    assert cells(R.words(hits, missed)) == [("a", "x"), (None, "y"), ("b", "x"), ("Documents with no matches",), ("c", "—")]
    assert cells(R.words(hits, missed.limit(0)))[-1] == ("b", "x")
    assert R.word_banner(hits, missed, ["x", "y"]).first().banner == "Search words: x, y   |   2 document(s) with matches   |   1 document(s) with no matches"


def test_binary_documents_without_content(spark):
    empty = spark.createDataFrame([("a", None), ("b", ""), ("c", "\r\r"), ("d", "\x07"), ("e", "PROCESS RISKS AND MITIGATION"), ("f", "\x14\x01\x15")], "path string, text string")
    assert binary_links.links(empty).count() == 0 and binary_risks.risk_rows(empty).count() == 0
    assert [tuple(r) for r in binary_objects.contexts(empty).collect()] == [("f", 1, "DOCUMENT", "", "", "")]
    assert binary_links.links(empty.limit(0)).count() == 0


def test_object_contexts_are_told_from_one_row(spark):
    """No text is joined, broadcast or dealt out, though there be headings before and after, repeated ones and several marks."""
    text = "DETAILS AND MORE 9\r3GOALS OF ALL\rNo one\r\x14\x01\x15\rDETAILS AND MORE\rA\x07B\x07\x07\r1 step\r\x14\x01\x15 and \x14\x01\x15\r3GOALS OF ALL 7\rLATE ONES"
    rows = spark.createDataFrame([("a", text), ("b", "CONCLUSIONS\r\x14\x01\x15"), ("c", None), ("d", "no mark\rat all"), (None, "\x14\x01\x15")], "path string, text string").repartition(3)
    found = binary_objects.contexts(rows)
    got = sorted((str(r.path), r.marker_no, r.section, r.row_label) for r in found.collect())
    assert got == [("None", 1, "DOCUMENT", ""), ("a", 1, "DOCUMENT", "1 step"), ("a", 2, "DETAILS AND MORE", "1 step"), ("a", 3, "DETAILS AND MORE", "1 step"), ("b", 1, "CONCLUSIONS", "")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" not in plan


def test_links_are_told_from_one_row(spark):
    text = "GOALS AND MORE\rName\x07Link\x07\x07\r\r\rA\x07https://a.example/page\x07\x07\r \rno row\rB\x07open\rhttps://b.example/page and\rNOTHING ELSE HERE\r\rC\x07https://c.example/page"
    found = binary_links.links(spark.createDataFrame([("a", text), ("b", None), ("c", "https://d.example/page")], "path string, text string").repartition(2))
    got = sorted((r.path, r["at"], r.section, r.table_flag, r.row_label, r.url_col, r.url, r.cell_no) for r in found.collect())
    goals = "GOALS AND MORE"
    assert got == [
        ("a", 4, goals, "Within Table", "A", "Link", "https://a.example/page", 1), ("a", 7, goals, "Within Table", "B", "", "https://b.example/page", 1),
        ("a", 11, "NOTHING ELSE HERE", "Within Table", "C", "", "https://c.example/page", 1), ("c", 0, "", "Outside Table", "", "", "https://d.example/page", None),
    ]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert not any(step in plan for step in ("Window", "Aggregate", "Sort", "Join", "Union"))


def test_report_of_links_deals_out_no_names(spark):
    """Names of file and folder are told from the path after the rows are numbered, so they are not shuffled beside it."""
    rows = spark.createDataFrame([("in/a.doc", 2, "u2"), ("in/a.doc", 1, "u1"), ("in/b.doc", 1, "u3")], "path string, at int, url string").repartition(2)
    found = R.links(rows.select("*", *(F.lit(c).alias(c) for c in ("section", "table_flag", "row_label", "row_label_col", "url_col"))), ["at"])
    assert [tuple(r.cells[k] for k in (0, 1, 7, 8, 9)) for r in found.orderBy("place").collect()] == [("in", "a.doc", "u1", "a.doc", "in"), (None, None, "u2", "a.doc", "in"), ("in", "b.doc", "u3", "b.doc", "in")]
    below = found._jdf.queryExecution().optimizedPlan().toString().split("Window", 1)[1]
    assert "split(" not in below
