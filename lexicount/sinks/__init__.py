"""Sinks: ``word: n`` text lines, bounded driver maps and the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexicount._checks import natural


def pair_lines(counts: DataFrame) -> DataFrame:
    """``value = '<word>: <count>'`` per row of a word-count table."""
    return counts.select(
        F.concat_ws(": ", F.col("word"), F.col("count").cast("string")).alias("value")
    )


def write_pairs_as_text(counts: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write ``pair_lines(counts)`` as text files under ``path``, one line per word.

    Each task writes its own file; nothing passes through the driver.
    """
    pair_lines(counts).write.mode(mode).text(path)


def to_dict(counts: DataFrame, max_rows: int, key: str = "word", value: str = "count") -> dict:
    """A small result as a ``{key: value}`` dict on the driver (the reference's
    result map), refusing anything larger than ``max_rows``.

    Only ``max_rows + 1`` rows are ever fetched, so an unexpectedly large
    result fails fast instead of filling driver memory. For large results keep
    the DataFrame, or rank first: ``to_dict(rank_by_count(counts, n), n)``.
    """
    max_rows = natural(max_rows, "max_rows")
    rows = counts.select(key, value).limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"result has more than {max_rows} rows; keep it as a DataFrame")
    out = {r[0]: r[1] for r in rows}
    if len(out) != len(rows):
        raise ValueError(f"column {key!r} has repeated values; aggregate before to_dict")
    return out


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: the session's ``spark.checkpoint.dir``.

    Only when the setting is absent and the master is local (one machine,
    tests) is a private folder created and set as the checkpoint dir. On a
    cluster a missing setting is an error: a machine-local folder would not
    survive the loss of that machine.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder all executors share"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="lexicount-ckpt-"))
    return sc.getCheckpointDir()


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under ``shared_dir`` for a written intermediate table.

    All paths of an application lie in one folder, ``lexicount-<application id>``.
    Results are read from it lazily, so it must live as long as the application;
    after that nothing refers to it and it can be deleted as a whole.
    """
    own = f"lexicount-{spark.sparkContext.applicationId}"
    return f"{shared_dir(spark).rstrip('/')}/{own}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet under ``shared_dir`` and read back: computed
    once, and a lost executor costs no recomputation. It stays as long as
    ``fresh_path`` says."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


__all__ = ["fresh_path", "pair_lines", "shared_dir", "to_dict", "write_pairs_as_text", "written"]
