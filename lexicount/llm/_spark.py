"""Small Spark helpers shared by the operators."""

from __future__ import annotations

import contextlib
import ctypes
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexicount.sinks import fresh_path

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

Batches = Iterator[pa.RecordBatch]


def ship(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the
    driver has it; on a cluster it goes along with ``--py-files``."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *paths])


#: Rows that an operator's function gets at once: what it copies or makes of a
#: batch follows these, not the batch that Spark sends.
ROWS_AT_ONCE = 1024


def _parts(batches: Batches) -> Batches:
    for b in batches:
        for lo in range(0, b.num_rows, ROWS_AT_ONCE):
            yield b.slice(lo, ROWS_AT_ONCE)


def give_back() -> None:
    """Hand freed memory back to the system: a worker waits for its next task
    with little of it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def map_arrow(df: DataFrame, fn: Callable[[Batches], Batches], schema: str) -> DataFrame:
    """``mapInArrow`` in parts of batches, with the package importable on the
    workers. An empty batch is passed over."""
    ship(df.sparkSession)

    def run(batches: Batches) -> Batches:
        try:
            yield from fn(_parts(batches))
        finally:
            give_back()

    return df.mapInArrow(run, schema)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: it is
    computed once, and a lost executor costs no recomputation of it."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def pick(df: DataFrame, **columns: str | Column) -> DataFrame:
    """Only the named columns, under the operator's own names, so that extra
    columns of any name can't clash."""
    return df.select(*[(F.col(f"`{c}`") if isinstance(c, str) else c).alias(k) for k, c in columns.items()])


def packed_row(df: DataFrame, without: str) -> Column:
    """All columns but ``without`` in one struct ``row``: whatever they are
    called, they can't clash with an operator's own columns."""
    rest = [F.col(f"`{c}`") for c in df.columns if c != without]
    return F.struct(*rest, F.lit(True).alias("__a_row_has_a_field")).alias("row")


def unpacked(df: DataFrame, like: DataFrame, replaced: dict[str, Column]) -> DataFrame:
    """The columns of ``like`` out of ``row``, but those in ``replaced``."""
    return df.select(*[
        replaced[c].cast(like.schema[c].dataType).alias(c) if c in replaced else F.col(f"row.`{c}`").alias(c)
        for c in like.columns
    ])


def row_type(df: DataFrame, without: str) -> str:
    """The type of ``packed_row`` as text."""
    fields = [f"`{c}`:{df.schema[c].dataType.simpleString()}" for c in df.columns if c != without]
    return f"struct<{','.join([*fields, '__a_row_has_a_field:boolean'])}>"


def text_key(text: Column) -> Column:
    """A 128-bit key of a whole text; null and empty texts are the same."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))
