"""Parquet tables laid out as ``<dir>/<name>.parquet``.

Nothing is remembered between reads: files are listed and the schema is
inferred every time, so a table that was overwritten is read as it is now.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def parquet(spark: SparkSession, path: str) -> DataFrame:
    """Lazy parquet scan; column pruning and filter pushdown reach the reader."""
    return spark.read.parquet(path)


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """The table ``name`` stored as ``<data_dir>/<name>.parquet``."""
    return parquet(spark, os.path.join(data_dir, f"{name}.parquet"))
