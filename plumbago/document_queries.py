"""Queries of the plans on binary documents. An order is a document: its texts hold the marks that such files hold, and the SQL says what must be found."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plumbago.functions import text as T
from plumbago.plans import binary_links, binary_objects, binary_risks, reports


def _orders(spark, sf_dir: str) -> DataFrame:
    """(k, status), dealt out over all partitions: the plans work within rows, and a small file's rows would stay in few tasks."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"))
    return orders.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "k")


def _texts(orders: DataFrame, *parts) -> DataFrame:  # noqa: ANN002
    """(path, text): the parts, texts or columns, in a row."""
    return orders.select(F.col("k").alias("path"), F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts)).alias("text"))


def binary_links_of(spark, sf_dir):
    """Links in fields and in plain text, in tables with and without names, in rows of several records, and in a row that a paragraph's end divides."""
    o = _orders(spark, sf_dir)
    k = F.col("k").cast("string")
    texts = _texts(
        o, "1. OVERVIEW AND SCOPE\r", 'see \x13HYPERLINK "https://a.example/', k, '"\x14here\x15 now\r',
        "Name\x07Link\x07\x07First\x07https://b.example/page/", k, "\x07Second\x07https://c.example/page/", k, "\x07\x07\r", "\r",
        "Open row\x07text https://d.example/page/", F.col("status"), "\r", "goes on https://e.example/page/", k, "\r", "NA\r",
        F.when(F.col("k") % 2 == 0, "DETAILS (MORE)\r").otherwise("Details\r"), "A\x07https://f.example/page/", k, "\x07\x07\r", "http://schemas.example.com/names\r", "end",
    )
    return binary_links.links(texts).select("path", "section", "table_flag", "row_label", "row_label_col", "url_col", "url", "at")


def binary_risks_of(spark, sf_dir):
    """The last of two sections of the same title, with and without a row that is a title; a note, a short, a long row, and what stands after a stop."""
    o = _orders(spark, sf_dir)
    odd = F.col("k") % 2 == 1
    texts = _texts(
        o, "PROCESS RISK AND MITIGATION\rearly\x07Ref\x07Risk\x07\x07E1\x07early\x07\x07\rProcess Risks and Mitigation\rlead\x07", F.when(odd, "Risks\x07Risks\x07\x07").otherwise(""),
        "Ref\x07Risk\x07Mitigation\x07\x07", "R", F.col("k").cast("string"), "\x07\x01late ", F.col("status"), "\x07\x07 \r\x07\x07", "Reference Note 1\x07x\x07\x07", "R2\x07a\x07b\x07c\x07\x07",
        F.when(F.col("k") % 3 == 0, "\rAppendix\x07no\x07\x07").otherwise(""),
    )
    return binary_risks.risk_rows(texts).select("path", "row_no", F.array_join("headers", "|").alias("headers"), F.array_join("cells", "|").alias("cells"))


def binary_object_contexts(spark, sf_dir):
    """Objects in a table under headers, after prose, and in a row under an earlier header row; headings that a contents page names before."""
    o = _orders(spark, sf_dir)
    k, filler = F.col("k").cast("string"), "\r" + "of no use " * 30 + "\r"
    texts = _texts(
        o, "DETAILS AND MORE 9\r2SCOPE OF WORK 3\rSHORT\rOVERVIEW 1\r2SCOPE OF WORK 7\r", "Name\x07File\x07\x07Row ", k, "\x07\x14\x01\x15\x07\x07", filler, "NO_SECTION HERE\rDETAILS AND MORE\r",
        "1. Attach the file ", F.col("status"), "\rnote\r\x14\x01\x15", filler, F.when(F.col("k") % 2 == 0, "CONCLUSIONS\r").otherwise("GOALS\r"),
        "Head A\x07Head B\x07\x07\r12.A.7/x\x07Label ", k, "\x07\x14\x01\x15\x07\x07\r", "\x13 EMBED Word \x14last\x15 words\r",
    )
    return binary_objects.contexts(texts)


def binary_object_inventory(spark, sf_dir):
    """Customers' payloads, some of them icons, pictures or too small, matched in order with the marks of two texts of three."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("k"), F.concat(F.lit("in/doc"), F.floor(F.col("c_custkey") / 8).cast("string"), F.lit(".doc")).alias("path"))
    r = F.col("k") % 8
    program = F.when(r == 1, "PBrush").when(r == 2, "Excel.Sheet.12").otherwise("")
    extension = F.when(r == 3, ".pdf").when(r == 4, ".bin").when(r == 5, ".bmp").otherwise("")
    content = F.when(r == 0, "small").when(r.isin(5, 6), F.concat(F.lit("BM"), F.repeat(F.lit("x"), 80))).otherwise(F.repeat(F.lit("y"), 80)).cast("binary")
    label = F.when(r == 3, F.concat(F.lit("file"), F.col("k"), F.lit("\x01.pdf"))).when(r == 5, " ")
    payloads = c.select("path", F.col("k").alias("entry_no"), program.alias("program"), label.alias("label"), extension.alias("extension"), content.alias("content"))
    n = F.regexp_extract("path", r"(\d+)", 1).cast("int")
    texts = c.select("path").distinct().where(n % 3 != 0).select("path", F.lit("DETAILS AND MORE\rA step here\r\x14\x01\x15\r").alias("text"))
    return binary_objects.inventory(payloads, texts)


def word_report(spark, sf_dir):
    """The report of a word search over all documents, as (part, path, nth, cells)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("string").alias("path"), T.word_hits(F.coalesce("text", F.lit("")), ["thereof", "company"]).alias("words"))
    hits = docs.select("path", F.explode(F.array_distinct(F.transform("words", F.lower))).alias("word"))
    found = reports.words(hits, docs.where(F.size("words") == 0).select("path").distinct())
    return found.select("place.part", "place.path", "place.nth", F.array_join("cells", "|", "").alias("cells"))


def header_report(spark, sf_dir):
    """The report of header fields: a customer is a file, its urgent orders are its pairs, in two rows as wide as the most of them."""
    files = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey"), F.concat(F.lit("in/n"), "c_nationkey", F.lit("/c"), "c_custkey", F.lit(".doc")).alias("path"))
    urgent = spark.read.parquet(f"{sf_dir}/orders.parquet").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("at"), F.col("o_orderkey").cast("string").alias("label"), F.col("o_orderstatus").alias("value"))
    rows = reports.header_fields(files.join(urgent, "c_custkey").drop("c_custkey"), files, ["at"])
    return rows.select("place.path", "place.line", F.size("cells").alias("n_cells"), F.array_join("cells", "|", "-").alias("cells"))


def link_report(spark, sf_dir):
    """The report of the links of binary_links_of: names on each file's first row alone."""
    rows = binary_links_of(spark, sf_dir).withColumn("path", F.concat(F.lit("in/"), F.col("path").cast("string"), F.lit(".doc")))
    return reports.links(rows, ["at"]).select("place.path", "place.nth", F.array_join("cells", "|", "-").alias("cells"))


QUERIES = {f.__name__: f for f in (binary_links_of, binary_risks_of, binary_object_contexts, binary_object_inventory, word_report, header_report, link_report)}

_O = "o AS (SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS s, o_orderstatus AS status FROM orders)"

_LINKS = f"""WITH {_O}, r AS (
SELECT k, '1. OVERVIEW AND SCOPE' AS section, 'Outside Table' AS table_flag, '' AS row_label, '' AS row_label_col, '' AS url_col, 'https://a.example/' || s AS url, 1 AS "at" FROM o
UNION ALL SELECT k, '1. OVERVIEW AND SCOPE', 'Within Table', 'First', 'Name', 'Link', 'https://b.example/page/' || s, 2 FROM o
UNION ALL SELECT k, '1. OVERVIEW AND SCOPE', 'Within Table', 'Second', 'Name', '', 'https://c.example/page/' || s, 2 FROM o
UNION ALL SELECT k, '1. OVERVIEW AND SCOPE', 'Within Table', 'Open row', 'Name', 'Link', 'https://d.example/page/' || status, 4 FROM o
UNION ALL SELECT k, '1. OVERVIEW AND SCOPE', 'Within Table', 'Open row', 'Name', 'Link', 'https://e.example/page/' || s, 4 FROM o
UNION ALL SELECT k, CASE WHEN k % 2 = 0 THEN 'DETAILS (MORE)' ELSE '1. OVERVIEW AND SCOPE' END, 'Within Table', 'A', '', '', 'https://f.example/page/' || s, 8 FROM o)
SELECT k AS path, section, table_flag, row_label, row_label_col, url_col, url, CAST("at" AS INTEGER) AS "at" FROM r"""

ORACLE_SQL = {
    "binary_links_of": _LINKS,
    "binary_risks_of": f"""WITH {_O}, r AS (SELECT k, CAST(2 + k % 2 AS INTEGER) AS row_no, 'R' || s || '|late ' || status || '|' AS cells FROM o
UNION ALL SELECT k, CAST(4 + k % 2 AS INTEGER), 'R2|a|b' FROM o)
SELECT k AS path, row_no, 'Ref|Risk|Mitigation' AS headers, cells FROM r""",
    "binary_object_contexts": f"""WITH {_O}
SELECT k AS path, 1 AS marker_no, '2. SCOPE OF WORK' AS section, 'Row ' || s AS row_label, 'Name' AS row_label_col, 'File' AS object_col FROM o
UNION ALL SELECT k, 2, 'DETAILS AND MORE', '1. Attach the file ' || status, '', '' FROM o
UNION ALL SELECT k, 3, CASE WHEN k % 2 = 0 THEN 'CONCLUSIONS' ELSE 'DETAILS AND MORE' END, 'Label ' || s, 'Head A', '' FROM o""",
    "binary_object_inventory": """WITH c AS (SELECT c_custkey AS k, c_custkey // 8 AS d, c_custkey % 8 AS r FROM customer),
f AS (SELECT k, d, CASE WHEN r = 3 THEN 'file' || k || '.pdf' WHEN r = 5 THEN 'doc' || d || '_embedded.bmp' ELSE 'doc' || d || '_embedded.bin' END AS object_file,
CASE r WHEN 2 THEN 'Excel' WHEN 3 THEN 'PDF' WHEN 5 THEN 'BMP' ELSE 'Object' END AS type FROM c WHERE r IN (2, 3, 5, 7)),
n AS (SELECT *, CAST(row_number() OVER (PARTITION BY d ORDER BY k) AS INTEGER) AS object_no FROM f)
SELECT 'in/doc' || d || '.doc' AS path, object_no, object_file, type, CASE WHEN object_no = 1 AND d % 3 <> 0 THEN 'DETAILS AND MORE' ELSE 'DOCUMENT' END AS section,
CASE WHEN object_no = 1 AND d % 3 <> 0 THEN 'A step here' ELSE '' END AS row_label, '' AS row_label_col, '' AS object_col FROM n""",
    "word_report": r"""WITH d AS (SELECT CAST(doc_id AS VARCHAR) AS path, list_distinct(list_transform(regexp_extract_all(regexp_replace(coalesce(text, ''), '[^\x00-\x7F]', ' ', 'g'), '(?i)\b(thereof|company)\b', 1), lambda w: lower(w))) AS w FROM documents),
h AS (SELECT DISTINCT path, unnest(w) AS word FROM d), n AS (SELECT *, CAST(row_number() OVER (PARTITION BY path ORDER BY word) - 1 AS INTEGER) AS nth FROM h)
SELECT 0 AS part, path, nth, CASE WHEN nth = 0 THEN path ELSE '' END || '|' || word AS cells FROM n
UNION ALL SELECT 1, '', 0, 'Documents with no matches' WHERE EXISTS (SELECT 1 FROM d WHERE len(w) = 0)
UNION ALL SELECT DISTINCT 2, path, 0, path || '|—' FROM d WHERE len(w) = 0""",
    "header_report": """WITH p AS (SELECT o_custkey AS k, list(CAST(o_orderkey AS VARCHAR) ORDER BY o_orderkey) AS l, list(o_orderstatus ORDER BY o_orderkey) AS v FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1),
m AS (SELECT max(len(l)) AS most FROM p), f AS (SELECT 'n' || c_nationkey AS folder, 'c' || c_custkey || '.doc' AS name, coalesce(l, []) AS l, coalesce(v, []) AS v, most FROM customer LEFT JOIN p ON c_custkey = k, m)
SELECT 'in/' || folder || '/' || name AS path, 0 AS line, CAST(most + 2 AS INTEGER) AS n_cells, array_to_string([folder, name] || l, '|') || repeat('|', most - len(l)) AS cells FROM f
UNION ALL SELECT 'in/' || folder || '/' || name, 1, CAST(most + 2 AS INTEGER), array_to_string(['-', '-'] || v, '|') || repeat('|', most - len(v)) FROM f""",
    "link_report": f"""WITH l AS ({_LINKS}), n AS (SELECT *, CAST(row_number() OVER (PARTITION BY path ORDER BY "at", url) - 1 AS INTEGER) AS nth FROM l)
SELECT 'in/' || path || '.doc' AS path, nth, CASE WHEN nth = 0 THEN 'in|' || path || '.doc' ELSE '-|-' END || '|' || section || '|' || table_flag || '|' || row_label || '|' || row_label_col || '|' || url_col || '|' || url || '|' || path || '.doc|in' AS cells FROM n""",
}
