"""Partitioning on request.

No operator looks at sizes: a plan is the same for any amount of data, and the
scan's own splits feed the work. Where a caller knows better (one file of one
row group, say) ``partitions`` asks for a round-robin exchange, and it is
applied whenever it is given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def repartitioned(df: DataFrame, partitions: int | None) -> DataFrame:
    """``df`` in ``partitions`` partitions; None leaves it as it is."""
    if partitions is None:
        return df
    if isinstance(partitions, bool) or not isinstance(partitions, int) or partitions < 1:
        raise ValueError(f"partitions must be a positive int, got {partitions!r}")
    return df.repartition(partitions)


__all__ = ["repartitioned"]
