"""Header fields of binary documents: cells between marks, kept where they look like a label and a value, in groups of near ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbago import config
from plumbago.functions import text as T

#: The mark that ends a cell, and control characters that a cell's text may hold besides its paragraphs' ends.
CELL = "\x07"
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f]"


def is_pair(text: Column, label: Column, value: Column) -> Column:
    """Whether a cell is a label and its value: short, with a colon, and free of what field codes and style runs leave behind."""
    plain = (F.length(label).between(1, 60)) & ~label.rlike(config.BAD_LABEL) & ~F.substring(value, 1, 50).rlike(config.BAD_VALUE)
    return F.coalesce(F.contains(text, F.lit(":")) & (F.length(text) <= 200) & plain, F.lit(False))


def pairs_of(text: Column) -> Column:
    """(at, label, value) of the cells of a text that are pairs; cells are counted from 0 and have no control characters."""
    cells = F.transform(F.split(text, CELL), lambda c, at: F.struct(at.alias("at"), T.strip(F.regexp_replace(c, CONTROL, "")).alias("text")))
    paragraphs = lambda t: F.filter(F.transform(F.split(t, r"[\r\n]+"), T.strip), lambda p: p != "")
    cut = F.transform(F.filter(cells, lambda c: F.contains(c["text"], F.lit(":"))), lambda c: F.struct(c["at"].alias("at"), c["text"].alias("text"), paragraphs(c["text"]).alias("p")))
    pairs = F.transform(cut, lambda c: F.struct(c["at"].alias("at"), c["text"].alias("text"), T.label_value(c["p"]).alias("p")))
    return F.transform(F.filter(pairs, lambda c: is_pair(c["text"], c["p"]["label"], c["p"]["value"])), lambda c: F.struct(c["at"].alias("at"), c["p"]["label"].alias("label"), c["p"]["value"].alias("value")))


def header_fields(texts: DataFrame, gap: int = 3) -> DataFrame:
    """(path, at, label, value) of the cells of (path, text) that most look like a page header.

    Cells that are pairs and follow each other within `gap` cells are a group; of the groups with two pairs or more, the one
    with most telling and short labels holds the header, the first of equals; without one, all pairs. A label counts once for
    each path, whatever its case. A null text has no cells. A path's pairs are one array, so that one row for each text is
    dealt out and sorted, once.
    """
    whole = Window.partitionBy("path").orderBy("path")
    found = texts.where("text is not null").select("path", pairs_of(F.col("text")).alias("_p")).where(F.size("_p") > 0)
    every = F.collect_list("_p").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    pairs = found.withColumns({"_every": every, "_n": F.row_number().over(whole)}).where("_n = 1").select("path", F.array_sort(F.flatten("_every")).alias("_p"))
    at = lambda k: F.get("_p", k)["at"]
    begun = pairs.withColumn("_b", F.filter(F.sequence(F.lit(0), F.size("_p") - 1), lambda k: (k == 0) | (at(k) - at(k - 1) > gap)))
    groups = F.transform("_b", lambda k, g: F.slice("_p", k + 1, F.coalesce(F.get("_b", g + 1), F.size("_p")) - k))
    one = lambda label: 2 * label.rlike(config.LABEL_SCORE).cast("int") + (F.length(label) < 40).cast("int")
    score = lambda group: F.aggregate(group, F.lit(0), lambda n, p: n + one(p["label"]))
    scored = F.transform(groups, lambda group, g: F.struct(score(group).alias("score"), (-g).alias("g"), group.alias("pairs")))
    best = F.array_max(F.filter(scored, lambda x: F.size(x["pairs"]) >= 2))["pairs"]
    key = lambda label: F.lower(T.strip(F.regexp_replace(label, r":+$", "")))
    keyed = F.transform(F.coalesce(best, F.col("_p")), lambda p: F.struct(key(p["label"]).alias("key"), p["at"].alias("at"), p["label"].alias("label"), p["value"].alias("value")))
    ranked = begun.select("path", F.array_sort(keyed).alias("_k"))
    first = F.filter("_k", lambda p, k: F.coalesce(F.get("_k", k - 1)["key"] != p["key"], F.lit(True)))
    return ranked.select("path", F.inline(first)).select("path", "at", "label", "value")
