"""Links of binary documents: the text between marks becomes paragraphs and rows of cells, and each link gets its section, row and column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plumbago.functions import text as T

CELL, PARAGRAPH = "\x07", "\r"


def shown(text: Column) -> Column:
    """Text without its field codes and without characters that do not print."""
    return T.strip(F.regexp_replace(F.regexp_replace(text, "(?s)\x13.*?\x15", ""), r"[\p{C}\p{Z}&&[^ ]]", ""))


def _holds_cell(paragraph: Column) -> Column:
    return F.contains(paragraph, F.lit(CELL))


def units(texts: DataFrame) -> DataFrame:
    """texts with column units, an array of (at, is_row, text) of each row's text: paragraphs, and table rows put together from their paragraphs.

    A paragraph with a cell mark is part of a row, which ends where such a paragraph ends in the mark; else the next
    paragraph is the row's rest. An empty paragraph between rows is none. at: the place of the first paragraph, from 0.
    A letter for each unit tells which empty ones follow a row. All is told within the row of the text, in one pass.
    """
    cut = texts.where("text is not null").withColumn("_p", F.split("text", PARAGRAPH))
    goes_on = lambda p: _holds_cell(p) & ~F.endswith(p, F.lit(CELL))
    begun = cut.withColumn("_n", F.filter(F.sequence(F.lit(0), F.size("_p") - 1), lambda i: (i == 0) | ~goes_on(F.get("_p", i - 1))))
    parts = F.transform("_n", lambda i, k: F.struct(i.alias("at"), F.slice("_p", i + 1, F.coalesce(F.get("_n", k + 1), F.size("_p")) - i).alias("parts")))
    text = lambda parts: F.array_join(F.transform(parts, lambda q, k: F.when((k == 0) | _holds_cell(q), q).otherwise(F.concat(F.lit(" "), q))), "")
    made = begun.withColumn("_u", F.transform(parts, lambda u: F.struct(u["at"].alias("at"), _holds_cell(F.get(u["parts"], F.lit(0))).alias("is_row"), text(u["parts"]).alias("text"))))
    letters = F.array_join(F.transform("_u", lambda u: F.when(u["is_row"], "R").when(T.strip(u["text"]) == "", "B").otherwise("P")), "")
    marked = made.withColumn("_l", F.split(F.regexp_replace(letters, r"(?:(?<=R)|(?!^)\G)B", "D"), ""))
    return marked.withColumn("units", F.filter("_u", lambda u, k: F.get("_l", k) != "D")).drop("_p", "_n", "_u", "_l")


def links(texts: DataFrame) -> DataFrame:
    """(path, section, table_flag, row_label, row_label_col, url_col, url, at, cell_no), a row for each distinct link of a paragraph or cell.

    A table's first row names its columns if it has text and no link; a longer row then holds several records of as many
    cells as there are names. A record's label is its first cell with text. A row of texts is a document: its units become
    tables, runs of rows, and paragraphs with links, and these become rows where they are; nothing is dealt out or sorted.
    """
    http = lambda t: F.contains(t, F.lit("http"))
    found = units(texts.where(http(F.col("text"))).select("path", "text"))
    heads = F.filter(F.transform("units", lambda u, k: F.struct(k.alias("k"), F.when(~u["is_row"], shown(u["text"])).alias("name"))), lambda h: F.coalesce(T.is_caps_heading(h["name"]), F.lit(False)))
    is_row = lambda k: F.coalesce(F.get("units", k)["is_row"], F.lit(False))
    every = F.sequence(F.lit(0), F.size("units") - 1)
    begin = F.filter(every, lambda k: is_row(k) & ~is_row(k - 1))
    end = F.filter(every, lambda k: is_row(k) & ~is_row(k + 1))
    alone = F.filter(every, lambda k: ~is_row(k) & http(F.get("units", k)["text"]))
    runs = F.concat(F.arrays_zip(begin.alias("lo"), end.alias("hi")), F.transform(alone, lambda k: F.struct(k.alias("lo"), k.alias("hi"))))
    parts = found.withColumn("heads", heads).select("path", "heads", "units", F.explode(runs).alias("run"))
    section = F.coalesce(F.try_element_at(F.filter("heads", lambda h: h["k"] <= F.col("run.lo")), F.lit(-1))["name"], F.lit(""))
    own = F.slice("units", F.col("run.lo") + 1, F.col("run.hi") - F.col("run.lo") + 1)
    parts = parts.select("path", section.alias("section"), F.get("units", F.col("run.lo"))["is_row"].alias("is_row"), own.alias("own"))

    filled = lambda cells: F.filter(cells, lambda c: c != "")
    pieces = lambda u: F.when(u["is_row"], filled(F.split(u["text"], CELL + CELL))).otherwise(F.array(u["text"]))
    tables = parts.withColumn("pieces", F.flatten(F.transform("own", lambda u: F.transform(pieces(u), lambda p: F.struct(u["at"].alias("at"), p.alias("piece"))))))
    top = F.get("pieces", F.lit(0))["piece"]
    tables = tables.withColumn("top", F.when(F.col("is_row") & (F.size(T.urls(top)) == 0), F.transform(F.split(top, CELL), shown)))
    tables = tables.withColumn("names", F.when(F.size(filled("top")) > 0, F.col("top")))
    data = F.slice("pieces", F.when(F.col("names").isNull(), 1).otherwise(2), F.size("pieces"))
    rows = tables.select("path", "section", "is_row", "names", F.explode(F.filter(data, lambda p: http(p["piece"]))).alias("p")).select("*", "p.at", "p.piece")
    rows = rows.withColumn("cells", F.when(F.col("is_row"), F.split("piece", CELL)).otherwise(F.array("piece"))).withColumn("labels", F.transform("cells", shown))
    n_names = F.size(filled("names"))
    stride = F.when(n_names >= 2, n_names).otherwise(F.size("cells"))
    cells = rows.withColumn("stride", stride).select("*", F.posexplode("cells").alias("cell_no", "cell")).where(http(F.col("cell")))
    record = F.slice("labels", (F.floor(F.col("cell_no") / F.col("stride")) * F.col("stride") + 1).cast("int"), F.col("stride"))
    first = lambda c: F.get(c, F.lit(0))
    inside = lambda c: F.coalesce(F.when(F.col("is_row"), c), F.lit(""))
    return cells.select(
        "path", "section", F.when(F.col("is_row"), "Within Table").otherwise("Outside Table").alias("table_flag"), inside(F.coalesce(first(filled(record)), first(filled("labels")))).alias("row_label"),
        inside(first(F.col("names"))).alias("row_label_col"), inside(F.get("names", F.col("cell_no"))).alias("url_col"), F.explode(T.urls(F.col("cell"))).alias("url"), "at", F.when(F.col("is_row"), F.col("cell_no")).alias("cell_no"),
    )
