"""Folders of office files as rows: the listing, its columns and the choice among files of one stem."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: What Spark's binaryFile source gives; a stream needs it spelled out.
SCHEMA = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
GLOB = "*.[dD][oO][cC]*"


def described(files: DataFrame) -> DataFrame:
    """files (path, ...) with folder, file_name, stem, ext; a missing extension is ''."""
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(
        "*", F.regexp_replace("path", "/[^/]*$", "").alias("folder"), name.alias("file_name"),
        F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"), F.lower(F.regexp_extract(name, r"(\.[^.]*)$", 1)).alias("ext"),
    )


def is_office(extensions: tuple[str, ...] = (".docx", ".doc"), lock_prefix: str = "~$") -> Column:
    """Whether a described row is a document; lock files, which begin with lock_prefix, are none."""
    return F.col("ext").isin(*extensions) & ~F.col("file_name").startswith(lock_prefix)


def scan(spark: SparkSession, folder: str, extensions: tuple[str, ...] = (".docx", ".doc"), lock_prefix: str = "~$") -> DataFrame:
    """All documents below a folder, with content. A plan that does not use the content does not read it."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", GLOB).load(folder)
    return described(found).where(is_office(extensions, lock_prefix))


def prefer_docx(files: DataFrame) -> DataFrame:
    """One path for each folder and stem of any case: a .docx before a .doc, the last of several .docx. Give it a listing, without content."""
    rank = F.struct((F.col("ext") == ".docx").alias("docx"), F.col("path"))
    return files.groupBy("folder", F.lower("stem").alias("stem_key")).agg(F.max(rank).alias("_r")).select(F.col("_r.path").alias("path"))
