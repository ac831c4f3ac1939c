"""Line sources: text files, string columns and string literals.

Every source returns a DataFrame with one string column ``value`` holding
one line per row, the shape of Spark's text source.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from lexicount.functions.text import as_column, text_lines
from lexicount.plans import repartitioned


def lines_from_text(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row per line of the text file(s) or directory at ``path``.

    Lines end at ``\\n``, ``\\r\\n`` or ``\\r``; a final terminator adds no
    row; an empty file has no rows. Files are split into byte ranges by
    ``spark.sql.files.maxPartitionBytes``, so a large file is read by many
    tasks.
    """
    paths = [path] if isinstance(path, str) else list(path or ())
    if not paths or not all(isinstance(p, str) and p for p in paths):
        raise ValueError(f"a text file path is required, got {path!r}")
    return spark.read.text(paths)


def lines_from_column(
    df: DataFrame,
    col: str | Column = "text",
    keep: Iterable[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """One row per line of a string column, same rule as ``lines_from_text``.

    ``keep`` lists columns carried next to every line (for example a
    document id). NULL and ``''`` give no rows. Map-only, unless
    ``partitions`` asks for a round-robin exchange of the input first.
    """
    keep = list(keep)
    src = repartitioned(df, partitions).select(*keep, as_column(col).alias("__text"))
    return src.select(*keep, F.explode(text_lines("__text")).alias("value"))


def lines_from_literal(spark: SparkSession, text: str | None) -> DataFrame:
    """A one-row ``value`` DataFrame holding ``text`` as given.

    The string is *not* split into lines: a job parameter is one line.
    A missing parameter is an error, not an empty result.
    """
    if text is None:
        raise ValueError("input string is required")
    if not isinstance(text, str):
        raise ValueError(f"input string must be a str, got {type(text).__name__}")
    return spark.createDataFrame([(text,)], "value string")


def values(
    spark: SparkSession, rows: Iterable, dtype: DataType | str, name: str = "x"
) -> DataFrame:
    """Literal values as a one-column DataFrame (B04), for small inputs only."""
    if isinstance(dtype, str):
        dtype = StructType.fromDDL(f"`{name}` {dtype}").fields[0].dataType
    schema = StructType([StructField(name, dtype, True)])
    return spark.createDataFrame([(v,) for v in rows], schema)
