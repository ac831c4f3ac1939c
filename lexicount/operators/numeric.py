"""Column statistics: scaled columns, exact sums, hit ratios, prefix filters.

Integers are widened to bigint *before* arithmetic: under ANSI mode an int
overflow raises instead of wrapping, and sums must be exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexicount._checks import factor, string
from lexicount.functions.text import as_column


def _factor(k: int | float) -> Column:
    k = factor(k)
    return F.lit(k).cast("bigint") if isinstance(k, int) else F.lit(float(k))


def _scaled(col: str | Column, k: int | float) -> Column:
    k = factor(k)
    c = as_column(col)
    return c.cast("bigint" if isinstance(k, int) else "double") * _factor(k)


def scale(df: DataFrame, col: str | Column, k: int | float, out: str = "scaled") -> DataFrame:
    """Add ``out = k * col`` (B13): bigint for an integer ``k``, double otherwise."""
    return df.withColumn(out, _scaled(col, k))


def total(df: DataFrame, col: str | Column, k: int | float = 1, out: str = "total") -> DataFrame:
    """One row: exact ``sum(k * col)`` (B14); NULL over no rows, as in SQL."""
    k = factor(k)
    expr = as_column(col).cast("bigint") if isinstance(k, int) and k == 1 else _scaled(col, k)
    return df.agg(F.sum(expr).alias(out))


def sum_of_squares(df: DataFrame, col: str | Column, out: str = "sum_sq") -> DataFrame:
    """One row: exact ``sum(col * col)`` in bigint."""
    x = as_column(col).cast("bigint")
    return df.agg(F.sum(x * x).alias(out))


def hit_ratio(df: DataFrame, predicate: Column, k: float = 1.0) -> DataFrame:
    """One row ``(hit, total, ratio)`` with ``ratio = k * hit / total``.

    ``hit`` counts rows where ``predicate`` is true (NULL is not a hit),
    ``total`` counts all rows, ``ratio`` is NULL when there are no rows. Both
    counts are exact integers; the ratio is computed once from them, so it
    does not depend on the order rows are added in.
    """
    counted = df.agg(
        F.count_if(predicate).cast("bigint").alias("hit"),
        F.count(F.lit(1)).alias("total"),
    )
    return counted.select(
        "hit", "total", F.try_divide(F.lit(float(factor(k))) * F.col("hit"), F.col("total")).alias("ratio")
    )


def prefix_filter(df: DataFrame, col: str | Column, prefix: str) -> DataFrame:
    """Rows whose ``col`` starts with the literal, case-sensitive ``prefix``.

    ``startswith`` reaches the parquet reader as a pushed ``StringStartsWith``.
    """
    prefix = string(prefix, "prefix")
    return df.filter(as_column(col).startswith(prefix))
