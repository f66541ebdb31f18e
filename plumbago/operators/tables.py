"""Operators on table rows and cells: splitting, grouping by header, fan-out, votes and outcome totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbago.functions import text as T


def lines_of(docs: DataFrame, key: str = "doc_id", text: str = "text", separator: str = "\n") -> DataFrame:
    """(key, line_no, line): line_no from 0. A null text has no lines."""
    return docs.where(F.col(text).isNotNull()).select(key, F.posexplode(F.split(text, separator)).alias("line_no", "line"))


def cells_of(rows: DataFrame, line: str, separator: str) -> DataFrame:
    """A row for each cell of a line, stripped: cell_no from 0."""
    return rows.select("*", F.posexplode(F.split(line, separator)).alias("cell_no", "_c")).withColumn("cell", T.strip(F.col("_c"))).drop("_c")


def by_header(rows: DataFrame, keys: list[str], row: str, cells: str) -> DataFrame:
    """Tables (keys) with their first row joined as header_key, and the number of rows after it."""
    first = F.min_by(cells, row)
    return rows.groupBy(*keys).agg(F.array_join(first, " | ").alias("header_key"), (F.count(F.lit(1)) - 1).alias("n_rows"))


def vote_out(pairs: DataFrame, keys: list[str], value: str = "value", placeholder: Column | None = None) -> DataFrame:
    """Drops the pairs of a key of whose filled values half or more are placeholders; blanks the placeholders of the others."""
    test = T.is_placeholder(F.col(value)) if placeholder is None else placeholder
    filled = T.strip(F.col(value)) != ""
    whole = Window.partitionBy(*keys)
    n, bad = F.sum(filled.cast("int")).over(whole), F.sum((filled & test).cast("int")).over(whole)
    return pairs.withColumn("_drop", (n > 0) & (bad * 2 >= n)).withColumn(value, F.when(test, "").otherwise(F.col(value))).where(~F.col("_drop")).drop("_drop")


def fan_out(rows: DataFrame, keys: list[str], header: str, slots: str) -> DataFrame:
    """A column for each slot of the last cell: header H becomes H 1..N where a table's most slots are above one. Long form."""
    most = F.max(F.size(slots)).over(Window.partitionBy(*keys))
    wide = rows.withColumn("_n", most).select("*", F.posexplode_outer(slots).alias("slot", "slot_value"))
    return wide.withColumn("slot_header", F.when(F.col("_n") > 1, F.concat(F.col(header), F.lit(" "), (F.coalesce("slot", F.lit(0)) + 1).cast("string"))).otherwise(F.col(header))).drop("_n")


def outcome_totals(df: DataFrame, outcome: str, key: str) -> DataFrame:
    """Distinct keys of each outcome, and a row Total with the sum of these."""
    counts = df.groupBy(outcome).agg(F.countDistinct(key).alias("n")).where("n > 0")
    return counts.unionByName(counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).select(F.lit("Total").alias(outcome), "n"))


def column_widths(cells: DataFrame, column: str, text: str, factor: float = 1.2, least: float = 10.0, most: float = 60.0) -> DataFrame:
    """For each column: its filled cells, the characters of its widest cell, and the width estimated from these, between least and most."""
    widest = F.max(F.length(text))
    return cells.groupBy(column).agg(F.count_if(F.col(text) != "").alias("filled"), widest.alias("widest"), F.round(F.least(F.greatest(widest * F.lit(factor), F.lit(least)), F.lit(most)), 6).alias("width"))
