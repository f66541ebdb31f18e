"""Layouts of the reports: each is a DataFrame of (place, cells), a sheet's rows below its header, which sinks.xlsx.write_layouts sorts and writes.

place orders the rows of a sheet; cells are their texts from the first column on. A file's folder and name are told from its path.
Widths of blocks are padded to the widest of all files, which is one aggregate; nothing else looks beyond one file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbago import config
from plumbago.functions import text as T
from plumbago.plans import documents, grouping

NO_MATCH, NOTHING, MISSING = "Documents with no matches", "—", "N/A"
LINK_HEADER = ["Folder Name", "Word Document", "Word Section", "Table", "Row Label", "Row Label Column", "URL Column", "URL", "Filter by File", "Filter by Folder"]
OBJECT_HEADER = ["Folder Name", "Word Document", "Word Section", "Row Label", "Row Label Column", "Object Type", "URL", "URL Column"]
WORD_HEADER, GROUP_HEADER = ["Document Name", "Word Found"], ["Group Name", "Document Name", "Similar Process Steps", "SAP Transaction Codes"]


def file_name() -> Column:
    return F.element_at(F.split("path", "/"), -1)


def folder_name() -> Column:
    return F.coalesce(F.get(F.reverse(F.split("path", "/")), F.lit(1)), F.lit(""))


def _pad(cells: Column, width: Column, fill: str = "") -> Column:
    return F.concat(cells, F.array_repeat(F.lit(fill), F.greatest(width - F.size(cells), F.lit(0)).cast("int")))


def _texts(*columns) -> Column:  # noqa: ANN002
    return F.array(*((F.col(c) if isinstance(c, str) else c).cast("string") for c in columns))


def _with_most(df: DataFrame, sizes: DataFrame, size: Column, least: int = 0) -> DataFrame:
    """df with column most: the greatest size of all rows, a single value."""
    return df.crossJoin(F.broadcast(sizes.agg(F.coalesce(F.max(size), F.lit(least)).alias("most"))))  # one row


def header_fields(pairs: DataFrame, files: DataFrame, order: list[str]) -> DataFrame:
    """Two rows for each of files (path), by name: its labels and its values, as many columns as the most pairs of a file."""
    key = F.struct(*order, "label", "value")
    packed = files.select("path").distinct().join(pairs.groupBy("path").agg(F.array_sort(F.collect_list(key)).alias("_p")), "path", "left").withColumn("_p", F.coalesce("_p", F.array().cast(f"array<{_kind(pairs, key)}>")))
    wide = _with_most(packed, packed, F.size("_p"))
    row = lambda part: _pad(F.transform("_p", lambda p: F.coalesce(p[part], F.lit(""))), F.col("most"))
    two = F.array(F.concat(_texts(folder_name(), file_name()), row("label")), F.concat(_texts(F.lit(None), F.lit(None)), row("value")))
    return wide.select("path", F.posexplode(two).alias("line", "cells")).select(F.struct(file_name().alias("name"), "path", "line").alias("place"), "cells")


def _kind(df: DataFrame, column: Column) -> str:
    return df.select(column.alias("c")).schema["c"].dataType.simpleString()


def section_tables(section: DataFrame, missing: str = "(No tables found in Section 16)") -> DataFrame:
    """The rows of plans.documents.section_tables behind folder, file and section; a row that says so for a file without tables."""
    cells = F.concat(_texts(folder_name(), file_name(), "section"), F.coalesce("cells", F.array(F.lit(missing))))
    return section.select(F.struct("path", "block_no", "row_no").alias("place"), cells.alias("cells"))


def header_sheets(section: DataFrame) -> DataFrame:
    """(header_key, place, cells): the rows of all tables with one first row, which heads their sheet (place.line 0); sheets by first appearance."""
    tables = section.where("block_no is not null").withColumn("first", F.min_by("cells", "row_no").over(Window.partitionBy("path", "block_no")))
    tables = tables.withColumn("header_key", F.array_join("first", " | ")).withColumn("head_no", F.min("row_no").over(Window.partitionBy("path", "block_no")))
    rows = tables.where("row_no > head_no").select("header_key", F.lit(1).alias("line"), "path", "block_no", "row_no", F.concat(_texts(folder_name(), file_name()), "cells").alias("cells"))
    heads = tables.groupBy("header_key").agg(F.min_by("first", F.struct("path", "block_no")).alias("first"), F.min(F.struct("path", "block_no")).alias("_f"))
    heads = heads.select("header_key", F.lit(0).alias("line"), F.col("_f.path").alias("path"), F.col("_f.block_no").alias("block_no"), F.lit(None).cast("int").alias("row_no"), F.concat(_texts(F.lit("Folder Name"), F.lit("Word Doc Name")), "first").alias("cells"))
    return heads.unionByName(rows).select("header_key", F.struct("line", "path", "block_no", "row_no").alias("place"), "cells")


def once(df: DataFrame, keys: list[str], order: list, columns: list[str]) -> DataFrame:
    """df with columns blank but on the first row of each key, and is_first, is_last and nth (from 0)."""
    whole = Window.partitionBy(*keys).orderBy(*order)
    numbered = df.withColumn("nth", F.row_number().over(whole) - 1).withColumn("is_last", F.lead(F.lit(1)).over(whole).isNull()).withColumn("is_first", F.col("nth") == 0)
    return numbered.withColumns({c: F.when(F.col("is_first"), F.col(c)) for c in columns})


def links(found: DataFrame, order: list[str]) -> DataFrame:
    """LINK_HEADER rows of a link inventory: folder and file on each file's first row, and on all rows in the columns to filter by."""
    numbered = once(found, ["path"], [*order, "url"], [])
    named = numbered.withColumn("by_file", file_name()).withColumn("by_folder", folder_name())
    shown = named.withColumns({c: F.when(F.col("is_first"), F.col(f"by_{c}")) for c in ("folder", "file")})
    return shown.select(F.struct("path", "nth").alias("place"), _texts("folder", "file", "section", "table_flag", "row_label", "row_label_col", "url_col", "url", "by_file", "by_folder").alias("cells"))


def performance(found: DataFrame, files: DataFrame) -> DataFrame:
    """For each file of plans.documents.performance_rows: its headers, then its rows; MISSING beyond its own columns. One blank row for a file without."""
    slots = F.array_sort(F.collect_list(F.when(F.col("slot").isNotNull(), F.struct("slot", "slot_value"))))
    rows = found.groupBy("path", "headers", "cells", "row_no").agg(slots.alias("_s")).withColumn("most_slots", F.max(F.size("_s")).over(Window.partitionBy("path")))
    names = found.where("slot_header is not null").groupBy("path").agg(F.transform(F.array_sort(F.collect_set(F.struct(F.coalesce("slot", F.lit(0)).alias("k"), "slot_header"))), lambda x: x["slot_header"]).alias("slot_names"))
    rows = rows.join(names, "path").withColumn("columns", F.concat("headers", F.when(F.col("most_slots") > 0, F.slice("slot_names", F.lit(1), F.greatest("most_slots", F.lit(1)))).otherwise(F.array().cast("array<string>"))))
    data = F.concat(F.slice(F.concat("cells", F.array_repeat(F.lit(""), F.size("headers"))), F.lit(1), F.size("headers")), F.transform("_s", lambda x: x["slot_value"]))
    base = rows.select("path", "row_no", "columns", _pad(data, F.size("columns")).alias("own"))
    heads = base.groupBy("path").agg(F.first("columns").alias("columns")).select("path", F.lit(-1).alias("row_no"), "columns", F.col("columns").alias("own"))
    blank = files.select("path").distinct().join(heads.select("path"), "path", "left_anti").select("path", F.lit(-1).alias("row_no"))
    wide = _with_most(heads.unionByName(base).unionByName(blank, allowMissingColumns=True), heads, F.size("columns"), 1)
    own = F.when(F.col("own").isNull(), F.array_repeat(F.lit(""), F.col("most"))).otherwise(_pad(F.col("own"), F.col("most"), MISSING))
    category = F.coalesce(F.get("columns", F.lit(0)), F.lit(config.NO_TABLE))
    return wide.select(F.struct("path", "row_no").alias("place"), F.concat(_texts(folder_name(), file_name(), category), own).alias("cells"))


def risks(outcomes: DataFrame) -> dict[str, DataFrame]:
    """The sheets of plans.documents.risk_tables: its blocks (headers, then rows; is_header marks these and rows that repeat them), skipped and failed files, and the totals."""
    blocks = outcomes.where("outcome = 'block'")
    repeated = F.lower(F.get("cells", F.lit(0))) == F.lower(F.get("headers", F.lit(0)))
    rows = blocks.select("path", "row_no", "headers", "cells", repeated.alias("is_header"))
    heads = blocks.groupBy("path").agg(F.min_by("headers", "row_no").alias("headers")).select("path", F.lit(-1).alias("row_no"), "headers", F.col("headers").alias("cells"), F.lit(True).alias("is_header"))
    wide = _with_most(heads.unionByName(rows), blocks, F.size("headers"))
    n = F.size("headers")
    own = F.slice(F.concat("cells", F.array_repeat(F.lit(""), n)), F.lit(1), n)
    cells = F.concat(_texts(folder_name(), file_name(), F.get("headers", F.lit(0))), F.when(F.col("is_header"), _pad(own, F.col("most"))).otherwise(_pad(own, F.col("most"), MISSING)))
    listed = lambda kind, *more: outcomes.where(F.col("outcome") == kind).select(F.struct("path").alias("place"), _texts(folder_name(), file_name(), *more).alias("cells"))
    counts = outcomes.groupBy("outcome").agg(F.countDistinct("path").alias("n"))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).select(F.lit("Total").alias("outcome"), "n")
    place = F.struct((F.col("outcome") == "Total").alias("last"), "outcome").alias("place")
    return {
        "Process Risk": wide.select(F.struct("path", "row_no").alias("place"), cells.alias("cells"), "is_header"), "Skipped": listed("skipped", "reason"), "Failed": listed("failed"),
        "Summary": counts.unionByName(total).select(place, _texts("outcome", "n").alias("cells")),
    }


def header_names(outcomes: DataFrame) -> DataFrame:
    """(header, first): every header of the blocks once, at its first appearance: a struct of path and position."""
    return outcomes.where("outcome = 'block'").select("path", F.posexplode("headers").alias("pos", "header")).groupBy("header").agg(F.min(F.struct("path", "pos")).alias("first"))


def shown_target(hyperlink: Column, saved: Column, target: Column) -> Column:
    """What stands for an object: its hyperlink, else the short path of its saved file, else its target."""
    short = F.regexp_replace(F.replace(saved, F.lit("\\"), F.lit("/")), r"^.*?(Output/)", "$1")
    given = lambda c: F.nullif(F.coalesce(c, F.lit("")), F.lit(""))
    return F.coalesce(given(hyperlink), given(short), given(target), F.lit(""))


def objects(found: DataFrame, order: list[str], url: Column) -> DataFrame:
    """OBJECT_HEADER rows of an object inventory."""
    return found.select(F.struct("path", *order).alias("place"), _texts(folder_name(), file_name(), "section", "row_label", "row_label_col", "type", url, "object_col").alias("cells"))


def words(hits: DataFrame, missed: DataFrame) -> DataFrame:
    """WORD_HEADER rows: each document's words by name, its name on the first; then those without a match."""
    shown = once(hits.select("path", "word").distinct().withColumn("name", F.col("path")), ["path"], ["word"], ["name"])
    part = lambda n: F.lit(n).alias("part")
    found = shown.select(F.struct(part(0), "path", "nth").alias("place"), _texts("name", "word").alias("cells"))
    first = missed.agg(F.count(F.lit(1)).alias("n")).where("n > 0").select(F.struct(part(1), F.lit("").alias("path"), F.lit(0).alias("nth")).alias("place"), _texts(F.lit(NO_MATCH)).alias("cells"))
    rest = missed.select(F.struct(part(2), "path", F.lit(0).alias("nth")).alias("place"), _texts("path", F.lit(NOTHING)).alias("cells"))
    return found.unionByName(first).unionByName(rest)


def word_banner(hits: DataFrame, missed: DataFrame, searched: list[str]) -> DataFrame:
    """One row: the words, and the documents with and without them."""
    n = hits.agg(F.countDistinct("path").alias("n")).crossJoin(missed.agg(F.count(F.lit(1)).alias("m")))  # one row each
    return n.select(F.format_string("Search words: %s   |   %d document(s) with matches   |   %d document(s) with no matches", F.lit(", ".join(searched)), "n", "m").alias("banner"))


def groups(rows: DataFrame, codes: DataFrame) -> DataFrame:
    """GROUP_HEADER rows of plans.grouping.grouped rows: groups by name, the reference documents last; the name on a group's first row. codes: (path, codes)."""
    both = rows.join(codes.select("path", "codes"), "path", "left").withColumn("key", F.when(F.col("group_name") == grouping.REFERENCE, "~").otherwise(F.col("group_name"))).withColumn("shown", F.col("group_name"))
    filled = lambda c, separator: F.when(F.size(c) > 0, F.array_join(c, separator)).otherwise(NOTHING)
    return once(both, ["group_name"], ["path"], ["shown"]).select(F.struct("key", "nth").alias("place"), _texts("shown", "path", filled("lines", "\n"), filled("codes", ", ")).alias("cells"))


def document_codes(paragraphs: DataFrame) -> DataFrame:
    """(path, codes): each document's transaction codes in order."""
    each = paragraphs.where("text is not null").select("path", F.explode(T.codes(F.col("text"))).alias("code"))
    return each.groupBy("path").agg(F.array_sort(F.collect_set("code")).alias("codes"))


def grouping_report(paragraphs: DataFrame, asked: int = 0, stops: list[str] | None = None) -> DataFrame:
    """From paragraphs to GROUP_HEADER rows: steps, groups of documents with like ones, their matched steps, and codes. asked: the number of groups, 0 for a third.

    The steps serve several joins, so they are kept once computed; a lost executor's share of them is computed anew.
    """
    rows = grouping.grouped(documents.all_steps(paragraphs).persist(), paragraphs.select("path").distinct(), stops, asked)
    return groups(rows, document_codes(paragraphs))


def counters(found: DataFrame) -> DataFrame:
    """One row of a link inventory's counts: links, in and outside tables, and files without."""
    return found.agg(
        F.count_if(F.col("table_flag").isNotNull()).alias("n_links"), F.count_if(F.col("table_flag") == "Within Table").alias("n_inside"),
        F.count_if(F.col("table_flag") == "Outside Table").alias("n_outside"), F.count_if(F.col("url") == config.NO_LINK).alias("n_without"),
    )
