"""The analytics on office documents, as plans on the rows of sources.docx.paragraphs.

All windows are within one file. Every result names its file by path; order columns tell the place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbago import config
from plumbago.functions import text as T
from plumbago.operators import ordered, similarity, tables

BODY = "word/document.xml"
_CELL = ["path", "part", "block_no", "row_no", "cell_no"]


def _styled(parts: tuple[str, ...] = config.HEADING_STYLES) -> Column:
    return F.coalesce(T.any_of(F.col("style"), parts), F.lit(False)) & (T.strip(F.col("text")) != "")


def _upto(keys: tuple[str, ...] = ("path",), last: int = 0):  # noqa: ANN202
    return Window.partitionBy(*keys).orderBy("block_no").rowsBetween(Window.unboundedPreceding, last)


def blocks(paragraphs: DataFrame) -> DataFrame:
    """One row for each block of the body: a paragraph, or the first paragraph of a table, without its text and style."""
    first = (F.col("kind") == "p") | (F.col("row_no") == 0) & (F.col("cell_no") == 0) & (F.col("para_no") == 0)
    own = lambda c: F.when(F.col("kind") == "p", F.col(c)).alias(c)
    return paragraphs.where((F.col("part") == BODY) & first).select("path", "block_no", "kind", own("text"), own("style"), "any_bold", "all_bold", own("num_id"), "level", "number_start", "number_format")


def cells(paragraphs: DataFrame) -> DataFrame:
    """One row for each table cell: its paragraphs, their text in lines, and what any of them holds."""
    inside = paragraphs.where("kind = 'tbl'")
    flat = lambda c: F.flatten(F.transform(F.col("_p"), lambda x: x[c])).alias(c)
    packed = inside.groupBy(*_CELL).agg(
        F.array_sort(F.collect_list(F.struct("para_no", "text", "links", "objects"))).alias("_p"), F.max("shaded").alias("shaded"), F.max("any_bold").alias("any_bold"), F.max("header_row").alias("header_row"),
    )
    texts = F.transform(F.col("_p"), lambda x: T.squeeze(x["text"]))
    return packed.select(*_CELL, texts.alias("paragraphs"), T.strip(F.array_join(texts, "\n")).alias("text"), "shaded", "any_bold", "header_row", flat("links"), flat("objects"))


def rows(table_cells: DataFrame) -> DataFrame:
    """One row for each table row of the body: cells (texts) and last_paragraphs (of its last cell)."""
    packed = table_cells.where(F.col("part") == BODY).groupBy("path", "block_no", "row_no").agg(F.array_sort(F.collect_list(F.struct("cell_no", "text", "paragraphs"))).alias("_c"))
    return packed.select("path", "block_no", "row_no", F.transform("_c", lambda c: c["text"]).alias("cells"), F.element_at("_c", -1)["paragraphs"].alias("last_paragraphs"))


def _opened(paragraphs: DataFrame) -> DataFrame:
    return paragraphs.groupBy("path").agg(F.max("error").alias("error"))


def header_fields(paragraphs: DataFrame) -> DataFrame:
    """(path, block_no, row_no, cell_no, label, value) of the first page header, in name order, that has a table with text; placeholders are voted out."""
    found = cells(paragraphs.where(F.col("part") != BODY))
    chosen = found.where("text <> ''").groupBy("path").agg(F.min("part").alias("part"))
    filled = F.filter("paragraphs", lambda p: p != "")
    pairs = found.join(chosen, ["path", "part"]).withColumn("pair", T.label_value(filled)).where("pair is not null").select("path", "block_no", "row_no", "cell_no", "pair.label", "pair.value")
    return tables.vote_out(pairs, ["path"])


def section_tables(paragraphs: DataFrame, n: int = 16, style: str = "Heading1") -> DataFrame:
    """(path, section, block_no, row_no, cells) of the tables between the n-th heading and the next; a row that says so for a file without them."""
    top = F.coalesce(F.col("style") == style, F.lit(False))
    counted = blocks(paragraphs).withColumn("no", F.sum(top.cast("int")).over(_upto())).withColumn("heading", F.last(F.when(top, T.strip(F.col("text"))), True).over(_upto()))
    section = F.concat(F.lit(f"{n}\t"), F.col("heading")).alias("section")
    inside = counted.where(F.col("no") == n)
    hits = inside.where("kind = 'tbl'").select("path", "block_no", section).join(rows(cells(paragraphs)), ["path", "block_no"])
    named = inside.groupBy("path").agg(F.max(section).alias("section"))
    missing = _opened(paragraphs).join(named, "path", "left").join(hits.select("path").distinct(), "path", "left_anti")
    said = F.when(F.col("error").isNotNull(), F.concat(F.lit("ERROR: "), "error")).otherwise(F.coalesce("section", F.lit(config.NO_SECTION.format(n))))
    return hits.select("path", "section", "block_no", "row_no", "cells").unionByName(missing.select("path", said.alias("section")), allowMissingColumns=True)


def tables_by_header(section: DataFrame) -> DataFrame:
    """(header_key, n_tables, n_rows) over section_tables: tables with the same first row belong together."""
    each = tables.by_header(section.where("block_no is not null"), ["path", "block_no"], "row_no", "cells")
    return each.groupBy("header_key").agg(F.count(F.lit(1)).alias("n_tables"), F.sum("n_rows").alias("n_rows"))


def sections(paragraphs: DataFrame, labels: bool = False) -> DataFrame:
    """blocks with section: the nearest heading, with its automatic number where its text has none of its own.

    labels: before the first heading, a table's section is the last paragraph with text before it, and a short bold
    paragraph right before a table is the section from there on.
    """
    b = blocks(paragraphs).withColumn("heading", _styled())
    numbered = F.col("heading") & F.col("num_id").isNotNull() & F.col("number_format").isin(*config.NUMBER_FORMATS)
    order = Window.partitionBy("path", "num_id", "level").orderBy("block_no").rowsBetween(Window.unboundedPreceding, 0)
    number = F.sum(numbered.cast("int")).over(order) - 1 + F.col("number_start")
    name = T.strip(F.col("text"))
    label = F.when(numbered & ~name.rlike(r"^\d"), F.concat_ws(" ", number.cast("string"), name)).otherwise(name)
    b = b.withColumn("label", label)
    if labels:
        filled = F.coalesce(name != "", F.lit(False))
        b = b.withColumn("_early", F.max(F.col("heading").cast("int")).over(_upto()) == 0).withColumn("_last", F.last(F.when(filled, name), True).over(_upto()))
        following = Window.partitionBy("path").orderBy("block_no").rowsBetween(1, Window.unboundedFollowing)
        before_table = F.first(F.when(filled | (F.col("kind") == "tbl"), F.col("kind")), True).over(following) == "tbl"
        short = filled & F.col("any_bold") & F.length(name).between(4, 79) & ~name.startswith("http")
        own = F.when(F.col("_early") & (F.col("kind") == "tbl"), F.col("_last")).when(F.col("_early") & short & before_table, name)
        b = b.withColumn("_own", own)
        b = b.withColumn("label", F.when(F.col("heading"), F.col("label")).otherwise(F.col("_own"))).withColumn("heading", F.col("heading") | F.col("_own").isNotNull())
    return ordered.carry_section(b, ["path"], ["block_no"], F.col("heading"), F.col("label"))


def _header_cells(table_cells: DataFrame, whole: bool) -> DataFrame:
    """The first row's cells of the tables whose first row is a header: marked, or whole: all shaded or all text bold, else: any of these."""
    first = table_cells.where((F.col("row_no") == 0) & (F.col("part") == BODY))
    fold = F.min if whole else F.max
    bold = fold(F.when(F.col("text") != "", F.col("any_bold")))
    heads = first.groupBy("path", "block_no").agg((F.max("header_row") | F.coalesce(fold("shaded"), F.lit(False)) | F.coalesce(bold, F.lit(False))).alias("is_header")).where("is_header").select("path", "block_no")
    return first.join(heads, ["path", "block_no"]).select("path", "block_no", "cell_no", F.col("text").alias("column_name"))


def _borrowed_headers(paragraphs: DataFrame, heads: DataFrame) -> DataFrame:
    """heads, and for a table without its own those of the table before it, if no paragraph with text stands between."""
    filled = (F.col("kind") == "tbl") | (T.strip(F.col("text")) != "")
    before = F.last(F.when(filled, F.struct("kind", "block_no")), True).over(_upto(last=-1))
    pairs = blocks(paragraphs).withColumn("_b", before).where("kind = 'tbl' and _b.kind = 'tbl'").select("path", "block_no", F.col("_b.block_no").alias("head_no"))
    without = pairs.join(heads.select("path", "block_no").distinct(), ["path", "block_no"], "left_anti")
    lent = heads.withColumnRenamed("block_no", "head_no").join(without, ["path", "head_no"])
    return heads.unionByName(lent.select("path", "block_no", "cell_no", "column_name"))


def link_inventory(paragraphs: DataFrame) -> DataFrame:
    """One row for each link: path, section, table_flag, row_label, row_label_col, url_col, url and its place; one that says so for an open file without links."""
    where = sections(paragraphs, labels=True).select("path", "block_no", "section")
    found = cells(paragraphs).where(F.col("part") == BODY)
    linked = found.where(F.size("links") > 0).withColumn("table_flag", F.lit("Within Table"))
    heads = _borrowed_headers(paragraphs, _header_cells(found, True))
    labels = found.where("cell_no = 0").select("path", "block_no", "row_no", F.col("text").alias("row_label"))
    inside = (
        linked.join(labels, ["path", "block_no", "row_no"], "left").join(heads, ["path", "block_no", "cell_no"], "left")
        .join(heads.where("cell_no = 0").select("path", "block_no", F.col("column_name").alias("row_label_col")), ["path", "block_no"], "left")
        .withColumn("url_col", F.coalesce("column_name", T.column_letters(F.col("cell_no"))))
    )
    outside = paragraphs.where((F.col("part") == BODY) & (F.col("kind") == "p") & (F.size("links") > 0)).withColumn("table_flag", F.lit("Outside Table"))
    blank = lambda c: F.coalesce(c, F.lit("")).alias(c)
    columns = ["path", "block_no", "row_no", "cell_no", "table_flag", "links"]
    both = inside.select(*columns, "row_label", "row_label_col", "url_col").unionByName(outside.select(*columns), allowMissingColumns=True)
    hits = both.join(where, ["path", "block_no"]).select("path", "section", "table_flag", blank("row_label"), blank("row_label_col"), blank("url_col"), F.explode("links").alias("url"), "block_no", "row_no", "cell_no")
    none = _opened(paragraphs).where("error is null").join(hits.select("path").distinct(), "path", "left_anti")
    return hits.unionByName(none.select("path", F.lit(config.NO_LINK).alias("url")), allowMissingColumns=True)


def _keyword_tables(paragraphs: DataFrame, keywords: tuple[str, ...], stops: Column) -> DataFrame:
    """(path, block_no) of the tables whose nearest stop before them holds a keyword."""
    nearest = F.last(F.when(F.col("kind") == "p", F.when(stops, T.any_of(F.col("text"), keywords))), True).over(_upto())
    return blocks(paragraphs).withColumn("hit", nearest).where("kind = 'tbl' and hit").select("path", "block_no")


def performance_rows(paragraphs: DataFrame, keywords: tuple[str, ...] = config.PERFORMANCE_KEYWORDS) -> DataFrame:
    """(path, headers, cells, slot, slot_header, slot_value, row_no): the first performance table, rows with equal cells but the last made one, its targets fanned out."""
    found = rows(cells(paragraphs)).join(_keyword_tables(paragraphs, keywords, _styled()), ["path", "block_no"])
    first = ordered.first_of(found.where((F.col("row_no") == 0) & (F.size("cells") > 1)), ["path"], ["block_no"])
    heads = first.select("path", "block_no", F.slice("cells", 1, F.size("cells") - 1).alias("headers"), F.element_at("cells", -1).alias("last_header"))
    data = found.where("row_no > 0").join(heads, ["path", "block_no"]).withColumn("base", F.slice("cells", 1, F.greatest(F.size("cells") - 1, F.lit(0))))
    pieces = data.select("path", "headers", "last_header", "base", "row_no", F.posexplode_outer(F.filter("last_paragraphs", lambda p: p != "")).alias("k", "paragraph"))
    place = F.min(F.struct("row_no", "k")).alias("place")
    distinct = pieces.groupBy("path", "headers", "last_header", "base", "paragraph").agg(place)
    lists = distinct.groupBy("path", "headers", "last_header", F.col("base").alias("cells")).agg(F.min("place.row_no").alias("row_no"), F.array_sort(F.collect_list(F.when(F.col("paragraph").isNotNull(), F.struct("place", "paragraph")))).alias("_p"))
    labelled = lambda p: p.rlike(config.LABELLED) & ~F.contains(F.regexp_extract(p, config.LABELLED, 1), F.lit("."))
    fold = lambda done, p: F.when(labelled(p) | (F.size(done) == 0), F.concat(done, F.array(p))).otherwise(F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.concat(F.element_at(done, -1), F.lit("\n"), p))))
    slots = F.aggregate(F.transform("_p", lambda x: x["paragraph"]), F.array().cast("array<string>"), fold)
    return tables.fan_out(lists.withColumn("slots", slots).drop("_p"), ["path"], "last_header", "slots").drop("slots", "last_header")


def risk_tables(paragraphs: DataFrame, keywords: tuple[str, ...] = config.RISK_KEYWORDS) -> DataFrame:
    """(path, outcome, reason, block_no, row_no, headers, cells). outcome: block (a row of a risk table), skipped or failed (one row for the file)."""
    keyed = F.coalesce(T.any_of(F.col("text"), keywords), F.lit(False))
    found = rows(cells(paragraphs)).join(_keyword_tables(paragraphs, keywords, _styled() | keyed), ["path", "block_no"])
    filled = F.array_distinct(F.filter("cells", lambda c: c != ""))
    title = (F.size("cells") == 1) | (F.size(filled) <= 1)
    order = Window.partitionBy("path", "block_no").orderBy("row_no").rowsBetween(Window.unboundedPreceding, 0)
    begun = found.withColumn("begun", F.max((~title).cast("int")).over(order)).where("begun = 1")
    heads = begun.groupBy("path", "block_no").agg(F.min_by("cells", "row_no").alias("names"), F.min("row_no").alias("head_no"))
    first = ordered.first_of(heads, ["path"], ["block_no"])
    bad = first.where((F.size("names") <= 1) | (F.get("names", F.lit(0)) == ""))
    named = F.transform("names", lambda h, i: F.when(h == "", F.concat(F.lit("Col"), (i + 1).cast("string"))).otherwise(h))
    data = begun.join(first.join(bad, "path", "left_anti"), ["path", "block_no"]).where(F.col("row_no") > F.col("head_no"))
    key = F.get("cells", F.lit(0))
    kept = data.where((F.size("cells") > 1) & (key != "") & ~F.lower(key).startswith("reference note"))
    hits = kept.select("path", F.lit("block").alias("outcome"), "block_no", "row_no", named.alias("headers"), "cells")
    has_section = blocks(paragraphs).where("kind = 'p'").groupBy("path").agg(F.max(keyed).alias("has_section"))
    rest = _opened(paragraphs).join(hits.select("path").distinct(), "path", "left_anti").join(bad.select("path", F.lit(True).alias("bad")), "path", "left").join(has_section, "path", "left")
    reason = F.when(F.col("error").isNotNull(), F.col("error")).when(F.col("bad"), config.BAD_TABLE).when(F.col("has_section"), config.NO_TABLE).otherwise(config.NO_RISK)
    outcome = F.when(F.col("error").isNotNull(), "failed").otherwise("skipped")
    return hits.unionByName(rest.select("path", outcome.alias("outcome"), reason.alias("reason")), allowMissingColumns=True)


def risk_summary(outcomes: DataFrame) -> DataFrame:
    return tables.outcome_totals(outcomes, "outcome", "path")


def object_inventory(paragraphs: DataFrame, skip: tuple[str, ...] = ("BIN",)) -> DataFrame:
    """One row for each embedded or linked object: path, section, type, target, linked, row_label, row_label_col, object_col and its place."""
    where = sections(paragraphs).select("path", "block_no", "section")
    found = cells(paragraphs).where(F.col("part") == BODY)
    heads = _header_cells(found, False)
    holding = found.where((F.col("row_no") == 0) & (F.size("objects") > 0)).select("path", "block_no").distinct()
    heads = heads.join(holding, ["path", "block_no"], "left_anti")
    labels = found.where((F.col("cell_no") == 0) & (F.size("objects") == 0)).select("path", "block_no", "row_no", F.substring("text", 1, 100).alias("row_label"))
    inside = (
        found.where(F.size("objects") > 0).join(labels, ["path", "block_no", "row_no"], "left").join(heads.withColumnRenamed("column_name", "object_col"), ["path", "block_no", "cell_no"], "left")
        .join(heads.where("cell_no = 0").select("path", "block_no", F.col("column_name").alias("row_label_col")), ["path", "block_no"], "left")
    )
    columns = ["path", "block_no", "row_no", "cell_no", "objects"]
    outside = paragraphs.where((F.col("part") == BODY) & (F.col("kind") == "p") & (F.size("objects") > 0)).select(*columns)
    every = inside.select(*columns, "row_label", "row_label_col", "object_col").unionByName(outside, allowMissingColumns=True).withColumn("o", F.explode("objects"))
    target = F.coalesce(T.decode_path(F.col("o.target")), F.col("o.target"))
    kind = T.object_type(F.col("o.program"), T.extension(target))
    blank = lambda c: F.coalesce(c, F.lit("")).alias(c)
    linked = F.col("o.external") | target.rlike("^https?://")
    return every.join(where, ["path", "block_no"]).select("path", "section", kind.alias("type"), target.alias("target"), linked.alias("linked"), blank("row_label"), blank("row_label_col"), blank("object_col"), "block_no", "row_no", "cell_no").where(~F.col("type").isin(*skip))


def word_search(paragraphs: DataFrame, words: list[str]) -> tuple[DataFrame, DataFrame]:
    """(path, word) of all full-word hits in their own case, and (path) of the files without one, unreadable ones too."""
    hits = paragraphs.select("path", F.explode(T.word_hits(F.coalesce("text", F.lit("")), words)).alias("word")).distinct()
    return hits, paragraphs.select("path").distinct().join(hits, "path", "left_anti")


def steps(paragraphs: DataFrame, headings: tuple[str, ...] = config.OVERVIEW_HEADINGS + config.DETAIL_HEADINGS, least: int = 3, most: int = 80) -> DataFrame:
    """(path, block_no, row_no, step): the step column of the table after a step heading, unless another heading stands between; of `least` to `most` words."""
    b = blocks(paragraphs).withColumn("heading", _styled())
    name = F.lower(T.strip(F.col("text")))
    named = F.col("heading") & reduce(lambda x, y: x | y, (F.contains(name, F.lit(h.lower())) | F.contains(F.lit(h.lower()), name) for h in headings))
    after = ordered.next_with_barrier(b, ["path"], ["block_no"], named, F.col("kind") == "tbl", F.col("heading"), "block_no", "table_no").where("table_no is not null")
    found = rows(cells(paragraphs)).join(after.select("path", F.col("table_no").alias("block_no")).distinct(), ["path", "block_no"])
    wanted = F.array_position(F.transform("cells", lambda c: T.any_of(c, config.STEP_COLUMNS)), True)
    heads = found.where("row_no = 0").select("path", "block_no", F.when(wanted > 0, wanted.cast("int") - 1).otherwise(1).alias("column_no"))
    step = T.clean_step(F.get("cells", F.col("column_no")))
    picked = found.where("row_no > 0").join(heads, ["path", "block_no"]).select("path", "block_no", "row_no", step.alias("step"))
    return picked.where(F.size(F.split("step", r"\s+")).between(least, most))


def _step_heading() -> Column:
    """A heading by style, by bold text alone, or a short line in capitals."""
    name, style = T.strip(F.col("text")), F.lower(F.coalesce("style", F.lit("")))
    capitals = (F.size(F.split(name, r"\s+")) <= 8) & (name == F.upper(name)) & (F.length(name) > 3)
    return F.coalesce((F.col("kind") == "p") & (style.startswith("heading") | style.startswith("title") | F.coalesce(F.col("all_bold"), F.lit(False)) | capitals), F.lit(False))


def _names(headings: tuple[str, ...]) -> Column:
    """Whether a text holds one of the headings or stands in one; an empty text does."""
    name = F.lower(T.strip(F.col("text")))
    return reduce(lambda x, y: x | y, (F.contains(name, F.lit(h.lower())) | F.contains(F.lit(h.lower()), name) for h in headings))


def _step_table(paragraphs: DataFrame, headings: tuple[str, ...], columns: tuple[str, ...], most: int) -> tuple[DataFrame, DataFrame]:
    """(path, step_no, step) of the first table after a heading, unless another heading with text stands between; (path) of those with rows."""
    b = blocks(paragraphs).withColumn("heading", _step_heading())
    barrier = F.col("heading") & (T.strip(F.col("text")) != "")
    after = ordered.next_with_barrier(b, ["path"], ["block_no"], F.col("heading") & _names(headings), F.col("kind") == "tbl", barrier, "block_no", "table_no").where("table_no is not null")
    first = ordered.first_of(after, ["path"], ["block_no"]).select("path", F.col("table_no").alias("block_no"))
    found = rows(cells(paragraphs)).join(first, ["path", "block_no"]).withColumn("cells", F.filter("cells", lambda c: c != "")).where(F.size("cells") > 0)
    found = ordered.autonumber(found, ["path"], ["row_no"], 0).withColumnRenamed("number", "step_no")
    wanted = F.array_position(F.transform("cells", lambda c: T.any_of(c, columns)), True).cast("int")
    data = found.where("step_no > 0").join(found.where("step_no = 0").select("path", F.when(wanted > 0, wanted - 1).otherwise(1).alias("column_no")), "path")
    step = data.select("path", "step_no", T.clean_step(F.get("cells", F.col("column_no"))).alias("step"))
    return step.where(F.size(F.split("step", r"\s+")).between(3, most)), data.select("path").distinct()


def all_steps(paragraphs: DataFrame) -> DataFrame:
    """(path, step_no, step, source): the steps of the overview's table, then those of the details' that are new, each once; else numbered paragraphs.

    source tells where a document's steps come from. Steps are numbered from 1 in their order.
    """
    overview, _ = _step_table(paragraphs, config.OVERVIEW_HEADINGS, config.OVERVIEW_COLUMNS, 50)
    detail, detailed = _step_table(paragraphs, config.DETAIL_HEADINGS, config.DETAIL_COLUMNS, 80)
    new = ordered.distinct_in_order(detail, ["path"], "step", "step_no").join(overview.select("path", "step").distinct(), ["path", "step"], "left_anti")
    tables_steps = overview.withColumn("part", F.lit(0)).unionByName(new.withColumn("part", F.lit(1)))
    heading, name = _step_heading(), T.strip(F.col("text"))
    lines = blocks(paragraphs).where("kind = 'p'").withColumn("_on", F.last(F.when(heading, _names(config.OVERVIEW_HEADINGS + config.DETAIL_HEADINGS)), True).over(_upto()))
    step = T.clean_step(F.regexp_replace(name, r"^[\d.]+\s+", ""))
    numbered = lines.where(F.col("_on") & ~heading & name.rlike(r"^[\d.]+\s+\w")).select("path", F.col("block_no").cast("int").alias("step_no"), step.alias("step"), F.lit(2).alias("part"))
    rest = numbered.where(F.size(F.split("step", r"\s+")).between(3, 60)).join(tables_steps.select("path").distinct(), "path", "left_anti")
    whole = Window.partitionBy("path")
    both = tables_steps.unionByName(rest).join(detailed.withColumn("_d", F.lit(True)), "path", "left").withColumn("_first", F.min("part").over(whole))
    source = F.when(F.col("_first") == 2, config.SOURCES[3]).when(F.col("_first") == 1, config.SOURCES[1]).when(F.col("_d"), config.SOURCES[2]).otherwise(config.SOURCES[0])
    return ordered.autonumber(both.withColumn("source", source), ["path"], ["part", "step_no"]).select("path", F.col("number").alias("step_no"), "step", "source")


def step_matches(found: DataFrame, groups: DataFrame, threshold: float = config.TFIDF_THRESHOLD, top: int = config.TOP_STEPS) -> DataFrame:
    """(path, step, sim, pct, rank): each file's steps that best match a step of another file of its group (path, group)."""
    keyed = found.join(groups, "path").withColumn("step_id", F.xxhash64("path", "block_no", "row_no"))
    terms = keyed.select("step_id", F.explode(F.regexp_extract_all(T.expand_synonyms(F.col("step")), F.lit(r"\b(\w\w+)\b"), 1)).alias("term"))
    weights = similarity.tfidf(terms, "step_id", "term", sublinear=False, most=None).join(keyed.select("step_id", "path", "group"), "step_id")
    a = weights.select("group", "term", F.col("path").alias("path"), "step_id", F.col("weight").alias("_a"))
    b = weights.select("group", "term", F.col("path").alias("other"), F.col("step_id").alias("other_id"), F.col("weight").alias("_b"))
    pairs = a.join(b, ["group", "term"]).where("path <> other").groupBy("path", "step_id", "other_id").agg(F.sum(F.col("_a") * F.col("_b")).alias("sim"))
    best = pairs.groupBy("path", "step_id").agg(F.max("sim").alias("sim"))
    return similarity.best_matches(best, "path", "step_id", threshold, top).join(keyed.select("step_id", "step"), "step_id").drop("step_id")
