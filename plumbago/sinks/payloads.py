"""Payloads as files, in a folder that all executors see."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F


#: Characters that file names must not have.
UNSAFE = r"[\x00-\x1f<>:\"/\\|?*]"


def safe(name: Column) -> Column:
    """name as a file name: unsafe characters become _, dots and blanks at the ends go; `_` for nothing."""
    plain = F.regexp_replace(F.regexp_replace(F.coalesce(name, F.lit("")), UNSAFE, "_"), r"^[. ]+|[. ]+$", "")
    return F.when(plain == "", F.lit("_")).otherwise(plain)


def named(payloads: DataFrame) -> DataFrame:
    """payloads (folder, name, payload_no, ...) with folder and file_name safe and no two alike in a folder, whatever their case.

    The first of equal names, by payload_no, keeps its own; the others get _n before the extension, with n the first number from 2 on
    that no name and no earlier number of the folder has. A folder's names are numbered in one task; their contents stay where they are.
    """
    keyed = payloads.withColumn("folder", safe(F.col("folder"))).withColumn("_safe", safe(F.col("name")))

    def number(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["payload_no", "_safe"], kind="stable")
        first = ~pdf["_safe"].str.lower().duplicated()
        taken, out = set(pdf["_safe"].str.lower()), []
        for name, own in zip(pdf["_safe"], first, strict=True):
            stem, ext = os.path.splitext(name)
            n, found = 2, name
            while not own and (found := f"{stem}_{n}{ext}").lower() in taken:
                n += 1
            taken.add(found.lower())
            out.append(found)
        return pd.DataFrame({"folder": pdf["folder"], "payload_no": pdf["payload_no"], "_safe": pdf["_safe"], "file_name": out})

    kinds = dict(keyed.dtypes)
    names = keyed.select("folder", "payload_no", "_safe").groupBy("folder").applyInPandas(number, f"folder string, payload_no {kinds['payload_no']}, _safe string, file_name string")
    return keyed.join(names, ["folder", "payload_no", "_safe"]).drop("_safe")


def write(payloads: DataFrame, root: str) -> None:
    """Writes content to root/folder/file_name, as named() gives them. A file appears whole or not at all, so a task may run twice."""

    def put(rows: Iterator) -> None:
        for row in rows:
            folder = os.path.join(root, row["folder"])
            os.makedirs(folder, exist_ok=True)
            part = os.path.join(folder, f".{uuid.uuid4().hex}")
            with open(part, "wb") as f:
                f.write(row["content"] or b"")
            os.replace(part, os.path.join(folder, row["file_name"]))

    payloads.select("folder", "file_name", "content").foreachPartition(put)
