"""What the operators share: the shared folder, written tables and slices of Arrow batches."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid
import warnings
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, StructField, StructType

#: Bytes of text that one vectorised step in a Python worker handles at once.
SLICE_BYTES = 1 << 20
#: Bytes of an Arrow batch between the JVM and a worker; both sides hold a batch or more of each running task.
BATCH_BYTES = 4 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: spark.checkpoint.dir, or one of our own where that is unset."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("plumbago.shared.dir", "")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            warnings.warn("spark.checkpoint.dir is unset: tables go to a folder of the driver, which executors on other machines do not see", stacklevel=2)
        base = tempfile.mkdtemp(prefix="plumbago-")
        spark.sparkContext.setCheckpointDir(base)
        spark.conf.set("plumbago.shared.dir", base)
    return f"{base.rstrip('/')}/plumbago-{spark.sparkContext.applicationId}"


def written(df: DataFrame, name: str, partitions_by: str | None = None, **options: str) -> DataFrame:
    """df as a Parquet table in the shared folder: it cuts lineage, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    writer = df.write.options(**options)
    (writer.partitionBy(partitions_by) if partitions_by else writer).parquet(path)
    spark.sparkContext._jvm.System.gc()  # lets Spark delete the shuffle files of what is now a table
    return spark.read.schema(df.schema).parquet(path)


def clean_up(spark: SparkSession) -> None:
    """Delete the tables that this application has written to the shared folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def unused(df: DataFrame, name: str) -> str:
    """A name that no column of df has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(name: str) -> Column:
    """The column of this very name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def extended(df: DataFrame, more: str) -> StructType:
    """df's schema and the columns of a DDL string."""
    return StructType([*df.schema.fields, *DataType.fromDDL(more).fields])


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another and the n + 1 offsets of the texts; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]] if buffers[2] is not None and buffers[2].size else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each has at most `most` bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0).cast(pa.int64()))
        ends = np.cumsum(sizes)
        first = 0
        while first < len(sizes):
            last = max(first + 1, int(np.searchsorted(ends, ends[first] - sizes[first] + most, "right")))
            yield batch.slice(first, last - first)
            first = last


Batches = Iterator[pa.RecordBatch]


def tidy(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """run, after whose last batch the worker gives freed memory back: workers stay for later tasks, and what they keep adds up with the JVM's."""

    @functools.wraps(run)
    def tidied(batches: Batches) -> Batches:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)

    return tidied


def in_batches(df: DataFrame, run: Callable[[Batches], Batches], schema: str | StructType) -> DataFrame:
    """df.mapInArrow of tidy(run), in batches of at most BATCH_BYTES or one row; sets the session's limit to that.

    Columns whose names have dots or backticks, which mapInArrow cannot take, go through under other names.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    odd = {c: unused(df, f"column_{k}") for k, c in enumerate(df.columns) if "." in c or "`" in c}
    if not odd:
        return df.mapInArrow(tidy(run), schema)
    schema = DataType.fromDDL(schema) if isinstance(schema, str) else schema
    plain = StructType([StructField(odd.get(f.name, f.name), f.dataType, f.nullable) for f in schema.fields])
    return df.toDF(*(odd.get(c, c) for c in df.columns)).mapInArrow(tidy(run), plain).toDF(*schema.names)
