"""The Spark session and what its workers need."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)


def prepare(spark: SparkSession) -> SparkSession:
    """Let the Python workers import this package where they see the same folder; clusters get it by --py-files."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    return spark


def local_session(cpus: int = 8, memory: str = "8g", **conf: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("plumbago").config("spark.driver.memory", memory)
    defaults = {"spark.sql.shuffle.partitions": str(cpus), "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    return prepare(builder.config(map=defaults | conf).getOrCreate())
