"""A growing folder of documents as a stream: the operators on single files are stateless, so each file is treated once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plumbago.sources import docx, files


def stream(spark: SparkSession, folder: str, files_each: int = 1000) -> DataFrame:
    """Described files of a folder tree, new ones in each trigger."""
    found = spark.readStream.format("binaryFile").schema(files.SCHEMA).option("recursiveFileLookup", True).option("pathGlobFilter", files.GLOB).option("maxFilesPerTrigger", files_each).load(folder)
    return files.described(found).where(files.is_office())


def paragraph_stream(spark: SparkSession, folder: str, files_each: int = 1000) -> DataFrame:
    return docx.paragraphs(stream(spark, folder, files_each).where("ext = '.docx'"))


def append(found: DataFrame, path: str, checkpoint: str):  # noqa: ANN201
    """Append to a Parquet table, exactly once, until what is there has been read."""
    return found.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
