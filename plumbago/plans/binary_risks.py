"""Risk tables of binary documents: the section after its last title, cut into rows of cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from plumbago import config
from plumbago.functions import text as T
from plumbago.sources import compound

CELL = "\x07"
#: What stands at the ends of a cell besides its text.
ENDS = r"^[\r\n\x00\x01\x13\x15 ]+|[\r\n\x00\x01\x13\x15 ]+$"


def section(texts: DataFrame, title: str = config.RISK_TITLE, stops: str = config.RISK_STOPS, most: int = 3000) -> DataFrame:
    """(path, section): the text after the last title, up to a paragraph that begins with a stop, or `most` characters. '' without a title."""
    after = texts.where("text is not null").select("path", F.regexp_extract("text", rf"(?is)^.*(?:{title})(.*)$", 1).alias("after"))
    stop = F.regexp_instr("after", F.lit(rf"(?i)\r(?:{stops})"))
    return after.select("path", F.when(stop > 0, F.col("after").substr(F.lit(1), stop - 1)).otherwise(F.substring("after", 1, most)).alias("section"))


def risk_rows(texts: DataFrame) -> DataFrame:
    """(path, row_no, headers, cells) of (path, text): the risk table's rows, filled or cut to as many cells as there are headers.

    The table begins at the section's first cell mark. A first row that says one thing in several cells is its title;
    the next row holds the headers. Rows without a reference, and reference notes, are none. row_no counts the rows with
    text from 1, title and headers too. A document without such a table has no rows.
    """
    found = section(texts).withColumn("_at", F.locate(CELL, F.col("section"))).where("_at > 0")
    table = compound.table_cells(F.col("section").substr(F.col("_at"), F.length("section")))
    rows = found.select("path", F.posexplode(table).alias("pos", "raw"))
    rows = rows.withColumn("cells", F.filter(F.transform("raw", lambda c: F.regexp_replace(c, ENDS, "")), lambda c: T.strip(c) != "")).where(F.size("cells") > 0)
    rows = rows.withColumn("row_no", F.row_number().over(Window.partitionBy("path").orderBy("pos")))
    one = (F.size(F.array_distinct(F.transform("cells", T.strip))) == 1) & (F.size("cells") >= 2)
    whole = Window.partitionBy("path")
    rows = rows.withColumn("head_no", 1 + F.max(((F.col("row_no") == 1) & one).cast("int")).over(whole))
    rows = rows.withColumn("headers", F.max(F.when(F.col("row_no") == F.col("head_no"), F.col("cells"))).over(whole))
    width = F.size("headers")
    data = rows.where("row_no > head_no").withColumn("cells", F.slice(F.concat("cells", F.array_repeat(F.lit(""), width)), F.lit(1), width))
    reference = F.lower(T.strip(F.get("cells", F.lit(0))))
    return data.where((reference != "") & ~reference.startswith("reference note")).select("path", "row_no", "headers", "cells")
