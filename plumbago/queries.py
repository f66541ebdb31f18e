"""The registered queries over the test tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from plumbago import config, document_queries
from plumbago.functions import text as T
from plumbago.operators import ordered, similarity, tables
from plumbago.plans import binary, grouping
from plumbago.sources import files

WORDS = ["thereof", "the", "and"]
PROGRAMS = ("", "Excel.Sheet.12", "AcroExch.Document", "Word.Document.8", "Visio.Drawing", "PowerPoint.Show", "Package", "Paint")
CODE_TEXTS = (
    "use T-code: ZT# now", "Run ZT# SAP", "Run SAP tcode ZT#", "a transaction ZT# or so", "OPEN TRANSACTION zt-#", "report s_alr_87# and S_ALR_87#", "go to the transaction zt#",
    "Go to T_CODE_ZT# in SAP, then transaction NOTE", "T-codes (ZB#) and transaction ZA#", "no code at all",
)


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_hits(spark, sf_dir):
    hits = _t(spark, sf_dir, "documents").select("doc_id", F.explode(F.array_distinct(T.word_hits(F.col("text"), WORDS))).alias("word"))
    return hits.distinct()


def word_not_found(spark, sf_dir):
    hit = F.size(T.word_hits(F.coalesce("text", F.lit("")), ["the", "and"])) > 0
    return _t(spark, sf_dir, "documents").groupBy("doc_id").agg(F.max(hit).alias("hit")).where("NOT hit").select("doc_id")


def word_summary(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents").select(F.size(T.word_hits(F.coalesce("text", F.lit("")), ["the", "and"])).alias("n"))
    return docs.agg(F.count(F.lit(1)).alias("scanned"), F.count_if(F.col("n") > 0).alias("found"), F.count_if(F.col("n") == 0).alias("not_found"))


def distinct_blocks(spark, sf_dir):
    lines = tables.lines_of(_t(spark, sf_dir, "documents")).withColumn("line", T.strip(F.col("line"))).where("line <> ''")
    return ordered.distinct_in_order(lines, ["doc_id"], "line", "line_no")


def section_carry(spark, sf_dir):
    lines = tables.lines_of(_t(spark, sf_dir, "documents"))
    return ordered.carry_section(lines, ["doc_id"], ["line_no"], F.col("line").rlike("^[A-Z]{4,}"), F.substring("line", 1, 60)).where("section <> ''").select("doc_id", "line_no", "section")


def nth_section(spark, sf_dir):
    """The lines from a document's third long one on, before its fourth, under the third one's text."""
    lines = tables.lines_of(_t(spark, sf_dir, "documents"))
    found = ordered.nth_section(lines, ["doc_id"], ["line_no"], F.length("line") > 100, 3)
    head = F.first("line").over(Window.partitionBy("doc_id").orderBy("line_no"))
    return found.select("doc_id", "line_no", F.concat(F.lit("3\t"), F.substring(head, 1, 60)).alias("section"))


def asof_heading(spark, sf_dir):
    events = _t(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    views, signups = events.where("event_type = 'view'").select("user_id", "ts", "event_id"), events.where("event_type = 'signup'").groupBy("user_id", "ts").agg(F.max("event_id").alias("signup_id"))
    return ordered.asof_before(views, signups, ["user_id"], "ts", "signup_id").where("signup_id is not null").select("event_id", "signup_id")


def next_with_barrier(spark, sf_dir):
    events = _t(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    kind = F.col("event_type")
    return ordered.next_with_barrier(events, ["user_id"], ["ts", "event_id"], kind == "view", kind == "purchase", kind == "error", "event_id", "purchase_id").where("purchase_id is not null").select("event_id", "purchase_id")


def positional_zip(spark, sf_dir):
    events = _t(spark, sf_dir, "events")
    one = lambda kind, name: events.where(F.col("event_type") == kind).select("user_id", F.col("ts").alias(f"{name}_ts"), F.col("event_id").alias(name))
    return ordered.positional_zip(one("click", "click_id"), one("purchase", "purchase_id"), ["user_id"], ["click_id_ts", "click_id"], ["purchase_id_ts", "purchase_id"]).select("user_id", "pos", "click_id", "purchase_id")


def gap_groups(spark, sf_dir):
    return ordered.gap_groups(_t(spark, sf_dir, "events").select("user_id", "event_id"), ["user_id"], "event_id", 3).where("group_size >= 2").select("user_id", "event_id", "gap_group", "group_size")


def gap_best_group(spark, sf_dir):
    grouped = ordered.gap_groups(_t(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), ["user_id"], "event_id", 3)
    return ordered.best_group(grouped, ["user_id"], F.when(F.col("event_type") == "purchase", 2).otherwise(0) + F.lit(1)).select("user_id", "event_id")


def autonumber(spark, sf_dir):
    return ordered.autonumber(_t(spark, sf_dir, "conversations"), ["conv_id", "role"], ["turn"]).select("conv_id", "turn", "role", F.col("number").cast("long").alias("number"))


def _pipe_rows(spark, sf_dir):
    lines = tables.lines_of(_t(spark, sf_dir, "documents")).withColumn("pipe", F.contains("line", F.lit("|")))
    islands = lines.withColumn("table_idx", F.sum((~F.col("pipe")).cast("int")).over(Window.partitionBy("doc_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)))
    return islands.where("pipe")


def pipe_cells(spark, sf_dir):
    return tables.cells_of(_pipe_rows(spark, sf_dir).select("doc_id", "line_no", "line"), "line", r"\|").select("doc_id", "line_no", "cell_no", "cell")


def tables_by_header(spark, sf_dir):
    rows = _pipe_rows(spark, sf_dir).withColumn("cells", F.transform(F.split("line", r"\|"), T.strip))
    return tables.by_header(rows, ["doc_id", "table_idx"], "line_no", "cells").groupBy("header_key").agg(F.count(F.lit(1)).alias("n_tables"), F.sum("n_rows").cast("long").alias("n_rows"))


def label_value(spark, sf_dir):
    turns = _t(spark, sf_dir, "conversations").where("text is not null").withColumn("pair", T.label_value(F.split(F.concat("role", F.lit(": "), "text"), "\n")))
    return turns.select("conv_id", "turn", "pair.label", "pair.value")


def placeholder_vote(spark, sf_dir):
    """A customer's orders as header values: hints, blanks and other placeholders, and real ones."""
    k = F.pmod("o_orderkey", F.lit(11))
    value = F.when(k == 0, "TBD").when(k == 1, " (Insert the name) ").when(k == 2, " ").when(k == 3, "Enter name here").when(k == 4, "SOP  Reference No and name").when(k == 5, "(of the second kind)")
    pairs = _t(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", value.otherwise(F.col("o_orderpriority")).alias("value"))
    return tables.vote_out(pairs, ["o_custkey"])


def outcome_summary(spark, sf_dir):
    joined = _t(spark, sf_dir, "documents").select("doc_id").join(_t(spark, sf_dir, "labels"), "doc_id", "left")
    outcome = F.when(F.col("quality").isNull(), "skipped").when(F.col("quality") == 0, "failed").otherwise("block")
    return tables.outcome_totals(joined.withColumn("outcome", outcome), "outcome", "doc_id")


def prefer_ext(spark, sf_dir):
    """Customers as files: folders by nation, stems in several cases, some of them locks or other files."""
    k = F.col("c_custkey")
    stem = F.concat(F.when(k % 7 == 0, "~$").otherwise(""), F.when(k % 2 == 0, F.col("c_mktsegment")).otherwise(F.initcap("c_mktsegment")), F.pmod(F.floor(k / 10), F.lit(9)).cast("string"))
    extension = F.element_at(F.array(*map(F.lit, (".doc", ".docx", ".DOC", ".txt"))), (k % 4 + 1).cast("int"))
    listing = files.described(_t(spark, sf_dir, "customer").select(F.concat(F.lit("in/"), F.col("c_nationkey"), F.lit("/"), stem, extension).alias("path")))
    return files.prefer_docx(listing.where(files.is_office()))


def _links(spark, sf_dir):
    pages = _t(spark, sf_dir, "pages").withColumn("host", F.regexp_extract("url", r"^(https?://[^/]+)", 1))
    found = pages.select("page_id", "host", F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1))).alias("href"))
    return found.withColumn("link", F.when(F.col("href").startswith("/"), F.concat("host", "href")).otherwise(F.col("href"))).where(F.col("link").startswith("http"))


def page_links(spark, sf_dir):
    """The links of pages as fields, and those in their text."""
    whole = F.replace("html", F.lit('href="/'), F.concat(F.lit('href="'), F.regexp_extract("url", r"^(https?://[^/]+)", 1), F.lit("/")))
    fields = F.regexp_replace(whole, 'href="([^"]*)"', '\x13 HYPERLINK "$1"\x14link\x15')
    return _t(spark, sf_dir, "pages").select("page_id", F.explode(T.urls(fields)).alias("link"))


def no_link_fill(spark, sf_dir):
    counts = _links(spark, sf_dir).groupBy("page_id").agg(F.min("link").alias("first_link"))
    return _t(spark, sf_dir, "pages").select("page_id").join(counts, "page_id", "left").select("page_id", F.coalesce("first_link", F.lit("No Hyperlink found")).alias("link"))


def url_ext_type(spark, sf_dir):
    program = F.element_at(F.array(*map(F.lit, PROGRAMS)), (F.pmod("page_id", F.lit(len(PROGRAMS))) + 1).cast("int"))
    return _t(spark, sf_dir, "pages").select("page_id", T.extension(F.col("url")).alias("ext"), program.alias("program")).withColumn("kind", T.object_type(F.col("program"), F.col("ext")))


def codes(spark, sf_dir):
    """Each way in which a text names a transaction, and words there that are none."""
    k = F.col("p_partkey").cast("string")
    text = F.element_at(F.array(*(F.replace(F.lit(t), F.lit("#"), k) for t in CODE_TEXTS)), (F.pmod("p_partkey", F.lit(len(CODE_TEXTS))) + 1).cast("int"))
    return _t(spark, sf_dir, "part").select("p_partkey", F.array_join(T.codes(text), ",").alias("codes"))


def numbered_steps(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders").where(F.col("o_orderpriority").rlike(r"^\d"))
    return orders.select("o_orderkey", T.clean_step(F.regexp_replace("o_orderpriority", r"^[\d.]+[-\s]+", "")).alias("step"))


def word_freq_name(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents")
    return similarity.name_groups(docs.where("text is not null"), "source", "text", "doc_id")


def _terms(spark, sf_dir):
    docs = _t(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    return docs.select("doc_id", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"([a-z]{2,})"), 1)).alias("term"))


def tfidf_topk(spark, sf_dir):
    vectors = similarity.tfidf(_terms(spark, sf_dir))
    pairs = similarity.cosine_pairs(vectors, vectors.withColumnRenamed("doc_id", "other_id"), "doc_id", "other_id").where("doc_id <> other_id").withColumn("sim", F.round("sim", 6))
    return similarity.best_matches(pairs, "doc_id", "other_id", 0.12).select("doc_id", "other_id", "rank", "sim")


def cosine_topk(spark, sf_dir):
    v = _t(spark, sf_dir, "embeddings").where("vec_id is not null and embedding is not null")
    a, b = v.where("vec_id % 100 = 0").select("vec_id", "label", "embedding"), v.select(F.col("vec_id").alias("other_id"), "label", F.col("embedding").alias("other"))
    pairs = a.join(b, "label").where("vec_id <> other_id").withColumn("sim", F.round(similarity.cosine(F.col("embedding"), F.col("other")), 6))
    return similarity.best_matches(pairs, "vec_id", "other_id", 0.0).select("vec_id", "other_id", "rank")


def cluster_docs(spark, sf_dir):
    """Average linkage within each label. Its groups must be small; it runs on the few hundred test items' hashed words."""
    hashed = _terms(spark, sf_dir).withColumn("slot", F.pmod(F.xxhash64("term"), F.lit(64)).cast("int")).groupBy("doc_id", "slot").count().groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("slot", "count"))).alias("m"))
    vectors = hashed.select("doc_id", F.transform(F.sequence(F.lit(0), F.lit(63)), lambda k: F.coalesce(F.element_at("m", k), F.lit(0)).cast("double")).alias("v"), F.lit(0).alias("g"))
    return similarity.cluster(vectors, "g", "doc_id", "v").select("doc_id", "cluster")


def _part_steps(spark, sf_dir):
    """Parts as steps: a document for each brand and size, whose steps are the parts' names and types."""
    return _t(spark, sf_dir, "part").select(F.concat_ws(" ", "p_brand", "p_size").alias("path"), F.col("p_partkey").alias("step_no"), F.lower(F.concat_ws(" ", F.lit("verify"), "p_name", "p_type")).alias("step"))


def step_matches(spark, sf_dir):
    steps = _part_steps(spark, sf_dir)
    groups = steps.select("path").distinct().withColumn("group", F.regexp_extract("path", r"(\S+)$", 1))
    return grouping.step_matches(steps.select("path", "step_no", "step"), groups, ["verify", "and", "the"])


def group_names(spark, sf_dir):
    """Names of nine groups of parts, with a verb for some of them, and none with words for others."""
    steps = _part_steps(spark, sf_dir).withColumn("size", F.pmod("step_no", F.lit(9)))
    text = F.when(F.col("size") == 0, "1 2 3").when(F.col("size") < 3, F.concat(F.lit("Invoice posting; payment approval, "), "step")).when(F.col("size") < 5, F.concat(F.lit("ledger "), "step")).otherwise(F.col("step"))
    return similarity.name_groups(steps.withColumn("text", text), "size", "text", "step_no").select(F.col("size").cast("int").alias("size"), "group_name")


def group_documents(spark, sf_dir):
    """The grouping from steps to the report's rows, over the test items: sentences are steps, and items with few words reference documents."""
    items = _t(spark, sf_dir, "benchmark")
    steps = items.select(F.col("item_id").alias("path"), F.posexplode(F.split("text", r"[.\n]+\s*")).alias("step_no", "step")).where("step <> ''")
    return grouping.grouped(steps, items.select(F.col("item_id").alias("path"))).select("group_name", "path", F.array_join("lines", "\n").alias("lines"))


def report_sizes(spark, sf_dir):
    """What a report's layout needs of a table of cells: the most cells of a row, and for each column its cells, its widest one and its width."""
    cells = tables.cells_of(_pipe_rows(spark, sf_dir), "line", r"\|")
    return tables.column_widths(cells, "cell_no", "cell")


def binary_header(spark, sf_dir):
    """Header fields as binary documents hold them: an order's lines as cells between marks, some short of a colon, too long or with remains of field codes."""
    rows = _t(spark, sf_dir, "orders").join(_t(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    k = F.col("o_orderkey")
    cells = (
        F.concat(F.lit("SOP No: "), k), F.lit("no pair"), F.concat(F.lit("Organ\x01isation\r: "), F.col("c_mktsegment")), F.when(k % 2 == 0, "sop no: again").otherwise("Bad@label: x"), F.lit(""), F.lit("..."), F.lit(""),
        F.concat(F.lit("Status: "), F.col("o_orderstatus")), F.when(k % 3 == 0, F.concat(F.lit("Price: "), F.repeat(F.lit("9"), 200))).otherwise("HYPERLINK: y"), F.lit("-"), F.lit("-"), F.lit("-"), F.lit("Late: one"), F.when(k % 5 == 0, "Title: two").otherwise("OJQJ: z"),
    )
    rows = rows.select("o_orderkey", "o_orderstatus", "c_mktsegment").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "o_orderkey")  # before the texts are made, which are larger
    return binary.header_fields(rows.select(k.alias("path"), F.concat_ws(binary.CELL, *cells).alias("text")))


def fan_out(spark, sf_dir):
    orders = _t(spark, sf_dir, "lineitem").where("l_linestatus = 'F'").groupBy("l_orderkey").agg(F.sort_array(F.collect_set("l_returnflag")).alias("slots")).withColumn("header", F.lit("Flag"))
    return tables.fan_out(orders, ["l_orderkey"], "header", "slots").select("l_orderkey", "slot_header", "slot_value")


def synonyms(spark, sf_dir):
    return _t(spark, sf_dir, "part").select("p_partkey", T.expand_synonyms(F.concat_ws(" ", F.lit("  ".join(config.SYNONYMS).upper()), "p_name")).alias("words"))


QUERIES = {f.__name__: f for f in (
    word_hits, word_not_found, word_summary, distinct_blocks, section_carry, nth_section, asof_heading, next_with_barrier, positional_zip, gap_groups, gap_best_group, autonumber,
    pipe_cells, tables_by_header, label_value, placeholder_vote, outcome_summary, prefer_ext, page_links, no_link_fill, url_ext_type, codes, numbered_steps, word_freq_name,
    tfidf_topk, cosine_topk, cluster_docs, fan_out, synonyms, step_matches, group_names, group_documents, report_sizes, binary_header,
)} | document_queries.QUERIES

_LINES = "lines AS (SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS line_no, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL))"
_PIPES = _LINES + ", pipes AS (SELECT * FROM (SELECT *, sum(CASE WHEN contains(line, '|') THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS table_idx FROM lines) WHERE contains(line, '|'))"
_HREFS = "hrefs AS (SELECT DISTINCT page_id, CASE WHEN starts_with(href, '/') THEN regexp_extract(url, '^(https?://[^/]+)', 1) || href ELSE href END AS link FROM (SELECT page_id, url, unnest(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) AS href FROM pages)), links AS (SELECT * FROM hrefs WHERE starts_with(link, 'http'))"
_GAPS = """new AS (SELECT user_id, event_id, event_type, CASE WHEN event_id - lag(event_id) OVER w > 3 THEN 1 ELSE 0 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY event_id) AS gap_group FROM new), s AS (SELECT *, count(*) OVER (PARTITION BY user_id, gap_group) AS group_size FROM g)"""
_EXT = "lower(regexp_extract(regexp_extract(url, '^([^?#]*)', 1), '(\\.[A-Za-z0-9]+)$', 1))"

ORACLE_SQL = {
    "word_hits": r"SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '(?i)\b(thereof|the|and)\b', 1)) AS word FROM (SELECT doc_id, regexp_replace(text, '[^\x00-\x7F]', ' ', 'g') AS text FROM documents)",
    "word_not_found": r"SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE regexp_matches(text, '(?i)\b(the|and)\b'))",
    "word_summary": r"SELECT count(*) AS scanned, count(*) FILTER (h) AS found, count(*) FILTER (NOT h) AS not_found FROM (SELECT regexp_matches(coalesce(text, ''), '(?i)\b(the|and)\b') AS h FROM documents)",
    "distinct_blocks": f"WITH {_LINES} SELECT doc_id, trim(line) AS line, min(line_no) AS line_no FROM lines WHERE trim(line) <> '' GROUP BY doc_id, trim(line)",
    "section_carry": f"WITH {_LINES}, s AS (SELECT doc_id, line_no, last_value(CASE WHEN regexp_matches(line, '^[A-Z]{{4,}}') THEN substr(line, 1, 60) END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section FROM lines) SELECT * FROM s WHERE section <> ''",
    "nth_section": f"""WITH {_LINES}, n AS (SELECT *, sum(CASE WHEN length(line) > 100 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS n FROM lines)
SELECT doc_id, line_no, '3' || chr(9) || substr(first_value(line) OVER (PARTITION BY doc_id ORDER BY line_no), 1, 60) AS section FROM n WHERE n = 3""",
    "asof_heading": "SELECT v.event_id, s.signup_id FROM (SELECT * FROM events WHERE event_type = 'view') v ASOF JOIN (SELECT user_id, ts, max(event_id) AS signup_id FROM events WHERE event_type = 'signup' GROUP BY ALL) s ON v.user_id = s.user_id AND v.ts > s.ts",
    "next_with_barrier": """WITH n AS (SELECT *, first_value(CASE WHEN event_type IN ('purchase', 'error') THEN struct_pack(kind := event_type, id := event_id) END IGNORE NULLS)
OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nx FROM events)
SELECT event_id, nx.id AS purchase_id FROM n WHERE event_type = 'view' AND nx.kind = 'purchase'""",
    "positional_zip": """WITH r AS (SELECT *, CAST(row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS INTEGER) AS pos FROM events)
SELECT c.user_id, c.pos, c.event_id AS click_id, p.event_id AS purchase_id FROM r c JOIN r p ON c.user_id = p.user_id AND c.pos = p.pos AND c.event_type = 'click' AND p.event_type = 'purchase'""",
    "gap_groups": f"WITH {_GAPS} SELECT user_id, event_id, CAST(gap_group AS BIGINT) AS gap_group, group_size FROM s WHERE group_size >= 2",
    "gap_best_group": f"""WITH {_GAPS}, t AS (SELECT user_id, gap_group, sum(CASE WHEN event_type = 'purchase' THEN 3 ELSE 1 END) AS score, count(*) AS n FROM g GROUP BY ALL),
b AS (SELECT user_id, gap_group FROM t WHERE n >= 2 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY score DESC, gap_group) = 1)
SELECT g.user_id, g.event_id FROM g LEFT JOIN b USING (user_id) WHERE b.gap_group IS NULL OR b.gap_group = g.gap_group""",
    "autonumber": "SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS number FROM conversations",
    "pipe_cells": f"WITH {_PIPES}, c AS (SELECT doc_id, line_no, string_split(line, '|') AS l FROM pipes) SELECT doc_id, line_no, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS cell_no, trim(unnest(l)) AS cell FROM c",
    "tables_by_header": f"WITH {_PIPES}, h AS (SELECT doc_id, table_idx, array_to_string(list_transform(string_split(arg_min(line, line_no), '|'), lambda x: trim(x)), ' | ') AS header_key, count(*) - 1 AS n FROM pipes GROUP BY ALL) SELECT header_key, count(*) AS n_tables, CAST(sum(n) AS BIGINT) AS n_rows FROM h GROUP BY 1",
    "label_value": r"""WITH p AS (SELECT conv_id, turn, string_split(role || ': ' || text, chr(10)) AS p FROM conversations WHERE text IS NOT NULL),
q AS (SELECT *, p[1] AS lp FROM p)
SELECT conv_id, turn, CASE WHEN len(p) = 1 THEN trim(string_split(lp, ':')[1]) ELSE lp END AS label,
CASE WHEN len(p) = 1 THEN trim(substr(lp, strpos(lp, ':') + 1)) ELSE trim(array_to_string(list_filter(p, lambda x: x <> lp), ' ')) END AS value FROM q""",
    "placeholder_vote": """WITH p AS (SELECT o_custkey, o_orderkey, o_orderkey % 11 AS r, o_orderpriority FROM orders),
v AS (SELECT *, count(*) FILTER (r <> 2) OVER w AS n, count(*) FILTER (r IN (0, 1, 3, 4)) OVER w AS bad FROM p WINDOW w AS (PARTITION BY o_custkey))
SELECT o_custkey, o_orderkey, CASE WHEN r < 5 THEN '' WHEN r = 5 THEN '(of the second kind)' ELSE o_orderpriority END AS value FROM v WHERE NOT (n > 0 AND bad * 2 >= n)""",
    "outcome_summary": """WITH o AS (SELECT CASE WHEN quality IS NULL THEN 'skipped' WHEN quality = 0 THEN 'failed' ELSE 'block' END AS outcome, count(DISTINCT doc_id) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1)
SELECT outcome, n FROM o UNION ALL SELECT 'Total', CAST(coalesce(sum(n), 0) AS BIGINT) FROM o""",
    "prefer_ext": """WITH f AS (SELECT c_nationkey AS n, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) END || (c_custkey // 10 % 9) AS stem,
['.doc', '.docx', '.DOC'][c_custkey % 4 + 1] AS ext FROM customer WHERE c_custkey % 7 <> 0 AND c_custkey % 4 <> 3)
SELECT arg_max('in/' || n || '/' || stem || ext, {'a': ext = '.docx', 'b': 'in/' || n || '/' || stem || ext}) AS path FROM f GROUP BY n, lower(stem)""",
    "page_links": r"""WITH p AS (SELECT page_id, replace(html, 'href="/', 'href="' || regexp_extract(url, '^(https?://[^/]+)', 1) || '/') AS html FROM pages), f AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="(https?://[^"\s]+)', 1)) AS link FROM p
UNION ALL SELECT page_id, unnest(regexp_extract_all(html, '(?:^|[^"\w])(https?://[^\s"]{8,})', 1)) FROM p)
SELECT DISTINCT page_id, link FROM f WHERE NOT regexp_matches(link, '^(https?://schemas\.|http://www\.w3\.|http://purl\.|http://dublincore\.org/schemas)')""",
    "no_link_fill": f"WITH {_HREFS} SELECT page_id, coalesce(min(link), 'No Hyperlink found') AS link FROM pages LEFT JOIN links USING (page_id) GROUP BY page_id",
    "url_ext_type": f"""WITH e AS (SELECT page_id, {_EXT} AS ext, {list(PROGRAMS)}[page_id % {len(PROGRAMS)} + 1] AS program FROM pages)
SELECT page_id, ext, program, CASE WHEN program LIKE 'Excel%' OR ext IN ('.xlsx', '.xls', '.xlsm') THEN 'Excel' WHEN program LIKE 'Acro%' OR ext = '.pdf' THEN 'PDF' WHEN program LIKE 'Word%' OR ext IN ('.docx', '.doc') THEN 'Word'
WHEN program = 'Package' OR ext = '.msg' THEN 'MSG' WHEN program LIKE 'Visio%' OR ext IN ('.vsd', '.vsdx') THEN 'VSD' WHEN program LIKE 'Power%' OR ext IN ('.pptx', '.ppt') THEN 'PPTX' WHEN ext = '' THEN 'Object' ELSE upper(substr(ext, 2)) END AS kind FROM e""",
    "codes": """SELECT p_partkey, replace(['ZT#', 'ZT#', 'ZT#', 'ZT#', 'ZT_#', 'S_ALR_87#', 'ZT#', 'ZT#', 'ZA#,ZB#', ''][p_partkey % 10 + 1], '#', CAST(p_partkey AS VARCHAR)) AS codes FROM part""",
    "numbered_steps": r"SELECT o_orderkey, trim(regexp_replace(o_orderpriority, '^[\d.]+[-\s]+', '')) AS step FROM orders WHERE regexp_matches(o_orderpriority, '^\d')",
    "tfidf_topk": r"""WITH t AS (SELECT item_id AS doc_id, unnest(regexp_extract_all(lower(text), '([a-z]{2,})', 1)) AS term FROM benchmark), c AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
n AS (SELECT count(DISTINCT doc_id) AS n FROM t), d AS (SELECT term, count(*) AS df, sum(tf) AS total FROM c GROUP BY 1 ORDER BY total DESC, term LIMIT 5000),
w AS (SELECT doc_id, term, (1 + ln(tf)) * (ln((1 + n) / (1 + df)) + 1) AS w FROM c JOIN d USING (term), n), u AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS w FROM w),
p AS (SELECT a.doc_id, b.doc_id AS other_id, round(sum(a.w * b.w), 6) AS sim FROM u a JOIN u b ON a.term = b.term AND a.doc_id <> b.doc_id GROUP BY 1, 2)
SELECT doc_id, other_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY sim DESC, other_id) AS INTEGER) AS rank, sim FROM p WHERE sim >= 0.12 QUALIFY rank <= 5""",
    "cosine_topk": """WITH p AS (SELECT a.vec_id, b.vec_id AS other_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS sim FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id)
SELECT vec_id, other_id, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, other_id) AS INTEGER) AS rank FROM p WHERE sim >= 0 QUALIFY rank <= 5""",
    "fan_out": """WITH s AS (SELECT l_orderkey, list_sort(list(DISTINCT l_returnflag)) AS s FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1), u AS (SELECT l_orderkey, len(s) AS n, generate_subscripts(s, 1) AS k, unnest(s) AS slot_value FROM s)
SELECT l_orderkey, CASE WHEN n > 1 THEN 'Flag ' || k ELSE 'Flag' END AS slot_header, slot_value FROM u""",
    "step_matches": r"""WITH s AS (SELECT p_brand || ' ' || p_size AS path, p_partkey AS step_no, lower('verify ' || p_name || ' ' || p_type) AS step FROM part),
o AS (SELECT *, regexp_extract(path, '(\S+)$', 1) AS g, list_filter(regexp_extract_all(regexp_replace(step, '^verify', 'validate'), '\b(\w\w+)\b', 1), lambda w: w NOT IN ('verify', 'and', 'the')) AS w FROM s),
t AS (SELECT g, path, step_no, unnest(w || list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1])) AS term FROM o),
c AS (SELECT g, path, step_no, term, count(*) AS tf FROM t GROUP BY ALL), n AS (SELECT g, count(*) AS n FROM o GROUP BY 1),
i AS (SELECT g, term, ln((1 + any_value(n)) / (1 + count(*))) + 1 AS idf FROM c JOIN n USING (g) GROUP BY 1, 2),
u AS (SELECT g, path, step_no, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY path, step_no)) AS w FROM c JOIN i USING (g, term)),
p AS (SELECT a.path, a.step_no, sum(a.w * b.w) AS sim FROM u a JOIN u b ON a.g = b.g AND a.term = b.term AND a.path <> b.path GROUP BY a.path, a.step_no, b.path, b.step_no),
x AS (SELECT o.path, o.step_no, o.step, round(max(sim), 9) AS sim FROM o LEFT JOIN p USING (path, step_no) GROUP BY ALL),
y AS (SELECT *, coalesce(sim >= 0.12, false) AS hit, max(coalesce(sim >= 0.12, false)) OVER (PARTITION BY path) AS found FROM x),
z AS (SELECT path, step, CAST(row_number() OVER (PARTITION BY path ORDER BY CASE WHEN found THEN sim END DESC NULLS LAST, step_no) AS INTEGER) AS rank, CASE WHEN found THEN CAST(floor(sim * 100) AS INTEGER) ELSE 0 END AS pct FROM y WHERE hit OR NOT found)
SELECT path, rank, step, pct FROM z WHERE rank <= 5""",
    "group_names": f"""WITH s AS (SELECT p_partkey, CAST(p_partkey % 9 AS INTEGER) AS size, lower('verify ' || p_name || ' ' || p_type) AS step FROM part),
t AS (SELECT size, p_partkey, lower(CASE WHEN size = 0 THEN '1 2 3' WHEN size < 3 THEN 'Invoice posting; payment approval, ' || step WHEN size < 5 THEN 'ledger ' || step ELSE step END) AS text FROM s),
l AS (SELECT size, p_partkey, regexp_extract_all(text, '\\b([a-z]{{4,}})\\b', 1) AS l FROM t),
w AS (SELECT size, p_partkey, generate_subscripts(l, 1) AS pos, unnest(l) AS word FROM l),
c AS (SELECT size, word, count(*) AS n, min(p_partkey * 1000 + pos) AS f, word IN {config.VERBS} AS verb, word IN {config.NOUNS} AS noun FROM w WHERE word NOT IN {config.SKIP} GROUP BY size, word),
r AS (SELECT *, row_number() OVER (PARTITION BY size ORDER BY n DESC, f) AS k, row_number() OVER (PARTITION BY size, verb ORDER BY n DESC, f) AS kv, row_number() OVER (PARTITION BY size, noun ORDER BY n DESC, f) AS kn,
upper(substr(word, 1, 1)) || substr(word, 2) AS title FROM c),
x AS (SELECT size, max(title) FILTER (verb AND kv = 1) AS v, max(title) FILTER (noun AND kn = 1) AS n, max(title) FILTER (k = 1) AS a, max(title) FILTER (k = 2) AS b FROM r GROUP BY 1)
SELECT t.size, coalesce(CASE WHEN v IS NOT NULL AND n IS NOT NULL THEN n || ' ' || v WHEN v IS NOT NULL THEN v || ' Process' WHEN n IS NOT NULL THEN n || ' Processing' ELSE concat_ws(' ', a, b) END, '') AS group_name
FROM (SELECT DISTINCT size FROM t) t JOIN x USING (size) UNION ALL SELECT DISTINCT size, 'Group ' || (size + 1) FROM t WHERE size NOT IN (SELECT size FROM x)""",
    "report_sizes": f"WITH {_PIPES}, c AS (SELECT string_split(line, '|') AS l FROM pipes), d AS (SELECT CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS cell_no, trim(unnest(l)) AS cell FROM c) SELECT cell_no, count(*) FILTER (cell <> '') AS filled, CAST(max(length(cell)) AS INTEGER) AS widest, round(least(greatest(max(length(cell)) * 1.2::DOUBLE, 10.0), 60.0)::DOUBLE, 6) AS width FROM d GROUP BY 1",
    "binary_header": r"""WITH o AS (SELECT o_orderkey AS k, o_orderstatus AS status, c_mktsegment AS segment FROM orders JOIN customer ON o_custkey = c_custkey),
c AS (SELECT k AS path, 0 AS pos, 'SOP No' AS label, CAST(k AS VARCHAR) AS value FROM o UNION ALL SELECT k, 2, ': ' || segment, 'Organisation' FROM o
UNION ALL SELECT k, 3, 'sop no', 'again' FROM o WHERE k % 2 = 0 UNION ALL SELECT k, 7, 'Status', status FROM o UNION ALL SELECT k, 12, 'Late', 'one' FROM o UNION ALL SELECT k, 13, 'Title', 'two' FROM o WHERE k % 5 = 0),
n AS (SELECT *, CASE WHEN pos - lag(pos) OVER w > 3 THEN 1 ELSE 0 END AS fresh FROM c WINDOW w AS (PARTITION BY path ORDER BY pos)),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY path ORDER BY pos) AS g FROM n),
s AS (SELECT path, g, count(*) AS n, sum(CASE WHEN regexp_matches(label, '(?i)organ|process map|sop no|sop number|sla|title') THEN 2 ELSE 0 END + 1) AS score FROM g GROUP BY ALL),
b AS (SELECT path, g FROM s WHERE n >= 2 QUALIFY row_number() OVER (PARTITION BY path ORDER BY score DESC, g) = 1),
x AS (SELECT g.* FROM g LEFT JOIN b USING (path) WHERE b.g IS NULL OR g.g = b.g)
SELECT path, CAST(pos AS INTEGER) AS "at", label, value FROM x QUALIFY row_number() OVER (PARTITION BY path, lower(label) ORDER BY pos) = 1""",
    "synonyms": f"SELECT p_partkey, '{' '.join(config.SYNONYMS.values())} ' || trim(lower(p_name)) AS words FROM part",
} | document_queries.ORACLE_SQL
