"""Objects of binary documents: which payloads count, and the section, row and columns around each object's mark in the text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plumbago.functions import text as T
from plumbago.operators import ordered

CELL, PARAGRAPH, MARK, OBJECT = "\x07", "\r", "\x14\x01\x15", "\x01"
#: The section of an object with no heading or no mark.
WHOLE = "DOCUMENT"
_HELD = "\ue001"


def shown(text: Column, controls: str = r"[\x00-\x06\x08\x0a-\x0c\x0e-\x1f]") -> Column:
    """Text with what fields display, without their codes and other control characters; an object's mark is one character."""
    plain = F.regexp_replace(F.regexp_replace(F.replace(text, F.lit(MARK), F.lit(_HELD)), r"\x13[^\x14\x15]*\x14", ""), controls, "")
    return F.replace(plain, F.lit(_HELD), F.lit(OBJECT))


def _before(text: str, mark: str, n: Column) -> Column:
    """The characters of column text before the n-th mark."""
    return F.length(F.call_function("substring_index", F.col(text), F.lit(mark), n.cast("int")))


def headings(texts: DataFrame) -> DataFrame:
    """texts with column headings, (pos, section) by pos: each section's last heading, at its paragraph's end, in (path, text).

    Leading digits are a heading's number, digits at its end a page. What follows the last paragraph's end is no heading.
    """
    cut = texts.withColumn("_s", F.split("text", PARAGRAPH))
    ended = F.filter(F.transform("_s", lambda s, i: F.struct(i.alias("i"), s.alias("s"))), lambda x: (x["i"] < F.size("_s") - 1) & (F.length(x["s"]) >= 4))
    name = lambda s: T.strip(F.replace(shown(s, r"[\x00-\x1f]"), F.lit(OBJECT), F.lit("")))
    found = F.filter(F.transform(ended, lambda x: F.struct(x["i"].alias("i"), name(x["s"]).alias("name"))), lambda x: T.is_section_heading(x["name"]))
    number = lambda name: F.regexp_extract(name, r"^(\d+)", 1)
    clean = lambda name: T.strip(F.regexp_replace(T.strip(F.regexp_replace(name, r"^\d+", "")), r"\d+$", ""))
    section = lambda name: F.when(number(name) != "", F.concat(number(name), F.lit(". "), clean(name))).otherwise(clean(name))
    labelled = F.transform(found, lambda x: F.struct(section(x["name"]).alias("section"), _before("text", PARAGRAPH, x["i"] + 1).alias("pos")))
    by_section = cut.withColumn("_h", F.array_sort(labelled))
    last = F.filter("_h", lambda h, i: F.coalesce(F.get("_h", i + 1)["section"] != h["section"], F.lit(True)))
    return by_section.withColumn("headings", F.array_sort(F.transform(last, lambda h: F.struct(h["pos"].alias("pos"), h["section"].alias("section"))))).drop("_s", "_h")


def markers(texts: DataFrame) -> DataFrame:
    """texts with (marker_no, pos), a row for each object's mark: its number from 1 and the place of the object's character in the text."""
    marks = F.size(F.split("text", MARK)) - 1
    numbered = texts.where(marks > 0).select("*", F.explode(F.sequence(F.lit(1), marks)).alias("marker_no"))
    return numbered.withColumn("pos", _before("text", MARK, F.col("marker_no")) + 1)


def _at(cells: str, *tests) -> Column:  # noqa: ANN002
    """The first index of a cell with text that passes all tests (cell, index); null without one."""
    return F.get(F.filter(F.transform(F.col(cells), lambda v, i: F.when(_all(v, i, tests), i)), lambda i: i.isNotNull()), F.lit(0))


def _all(v: Column, i: Column, tests) -> Column:  # noqa: ANN001
    kept = v != ""
    for test in tests:
        kept = kept & test(v, i)
    return kept


def contexts(texts: DataFrame, back: int = 2000, on: int = 200, most: int = 100) -> DataFrame:
    """(path, marker_no, section, row_label, row_label_col, object_col) of each object's mark in (path, text).

    The paragraph of the mark, in a window of `back` characters before and `on` after it, is a flat row of cells. Its first
    cells up to an empty one are the headers if the object stands after them; the label is then the first other cell with
    text of the object's row, else of the paragraph (activity codes are no labels). Without a header there, the nearest
    paragraph before with two cells or more names the columns. Without a label, the nearest paragraph before that begins
    with a digit, else the nearest of prose, is it. Labels are cut at `most` characters. All this is told from the row of
    the text: nothing is joined, broadcast or dealt out.
    """
    begin = F.greatest(F.col("pos") - back, F.lit(0))
    cut = F.col("text").substr((begin + 1).cast("int"), (F.col("pos") + on - begin).cast("int"))
    held = markers(headings(texts.where(F.contains("text", F.lit(MARK))).select("path", "text")))
    near = F.try_element_at(F.filter("headings", lambda h: h["pos"] < F.col("pos")), F.lit(-1))["section"]
    w = held.select("path", "marker_no", F.coalesce(near, F.lit(WHOLE)).alias("section"), F.split(shown(cut), PARAGRAPH).alias("paras"))
    flags = F.transform("paras", lambda p: F.contains(p, F.lit(OBJECT)))
    w = w.withColumn("place", F.size("paras") - F.array_position(F.reverse(flags), True).cast("int"))
    w = w.withColumn("before", F.reverse(F.slice("paras", F.lit(1), F.col("place")))).withColumn("cells", F.transform(F.split(F.get("paras", F.col("place")), CELL), T.strip))
    holds = lambda cells: F.array_position(F.transform(cells, lambda c: F.contains(c, F.lit(OBJECT))), True).cast("int") - 1
    empty = F.array_position("cells", "").cast("int")
    w = w.withColumn("own", holds("cells")).withColumn("n_cols", F.greatest(F.when(empty == 0, F.size("cells")).otherwise(empty - 1), F.lit(1)))
    w = w.withColumn("head", F.slice("cells", F.lit(1), F.col("n_cols"))).withColumn("data", F.slice("cells", F.col("n_cols") + 2, F.size("cells"))).withColumn("data_at", holds("data"))
    width = F.col("n_cols") + 1
    plain = lambda cells: F.transform(cells, lambda c: T.strip(F.replace(c, F.lit(OBJECT), F.lit(""))))
    many = F.col("data_at") >= 0
    row = F.slice("data", F.when(many, F.floor(F.col("data_at") / width) * width + 1).otherwise(1).cast("int"), F.col("n_cols"))
    w = w.withColumn("col", F.when(many, F.col("data_at") % width)).withColumn("values", F.when(many, plain(row)).otherwise(plain("cells")))
    inside = _at("values", lambda v, i: i != F.col("col"))
    alone = _at("values", lambda v, i: i != F.col("own"), lambda v, i: ~v.rlike(r"^\d+\.\w"))
    w = w.withColumn("label_at", F.when(many, inside).otherwise(alone))
    w = w.withColumn("object_col", F.coalesce(F.get("head", F.col("col")), F.lit(""))).withColumn("label_col", F.when(many, F.get("head", F.col("label_at"))))
    filled = lambda p: F.size(F.filter(F.split(p, CELL), lambda c: T.strip(c) != ""))
    header = F.get(F.filter("before", lambda p: F.contains(p, F.lit(CELL)) & ~F.contains(p, F.lit(OBJECT)) & (filled(p) >= 2)), F.lit(0))
    w = w.withColumn("above", F.when(F.col("object_col") == "", F.transform(F.split(header, CELL), T.strip)))
    w = w.withColumn("label_col", F.coalesce(F.get("above", _at("above", lambda v, i: i != F.col("own"))), "label_col")).withColumn("object_col", F.coalesce(F.get("above", F.col("own")), "object_col"))
    letters = lambda t: F.regexp_replace(t, r"[^\p{L}]", "")
    bare = F.transform("before", lambda p: T.strip(F.regexp_replace(p, r"[\x00-\x08\x0b-\x1f]", "")))
    w = w.withColumn("prose", F.filter(bare, lambda t: (F.length(letters(t)) >= 4) & letters(t).rlike(r"[^\p{Lu}]")))
    label = F.coalesce(F.get("values", F.col("label_at")), F.get(F.filter("prose", lambda t: t.rlike(r"^\d")), F.lit(0)), F.get("prose", F.lit(0)))
    blank = lambda c, name: F.coalesce(c, F.lit("")).alias(name)
    return w.select("path", "marker_no", "section", blank(F.substring(label, 1, most), "row_label"), blank(F.col("label_col"), "row_label_col"), "object_col")


def is_document(content: Column, extension: Column, program: Column, least: int = 64) -> Column:
    """Whether a payload is one to report: no bitmap of an icon, no picture program's, and not too small to be a file."""
    bitmap = (F.substring(content, 1, 2) == F.lit(b"BM")) & (extension != ".bmp")
    return (F.length(content) >= least) & ~bitmap & ~F.contains(F.coalesce(program, F.lit("")), F.lit("PBrush"))


def inventory(payloads: DataFrame, texts: DataFrame, skip: tuple[str, ...] = ("BIN",)) -> DataFrame:
    """(path, object_no, object_file, type, section, row_label, row_label_col, object_col), a row for each payload to report.

    payloads: (path, entry_no, program, label, extension, content). The n-th of those reported, by entry_no, stands at the
    text's n-th mark; without one its section is the whole document. A payload without a name gets its document's.
    """
    stem = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "")
    extension = F.coalesce("extension", F.lit(""))
    name = F.coalesce(F.nullif(T.strip(F.regexp_replace("label", r"\p{C}", "")), F.lit("")), F.concat(stem, F.lit("_embedded"), F.coalesce(F.nullif(extension, F.lit("")), F.lit(".bin"))))
    kind = T.object_type(F.coalesce("program", F.lit("")), extension)
    kept = payloads.where(is_document(F.col("content"), extension, F.col("program"))).select("path", "entry_no", name.alias("object_file"), kind.alias("type")).where(~F.col("type").isin(*skip))
    numbered = ordered.autonumber(kept, ["path"], ["entry_no"]).withColumnRenamed("number", "marker_no").drop("entry_no")
    found = numbered.join(contexts(texts), ["path", "marker_no"], "left").fillna(WHOLE, ["section"]).fillna("", ["row_label", "row_label_col", "object_col"])
    return found.withColumnRenamed("marker_no", "object_no")
