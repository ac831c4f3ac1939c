"""Streaming form of the text source.

The reference has no streaming operator. Every operator in this package is a
lazy DataFrame-to-DataFrame function built from native expressions, so it
accepts a streaming DataFrame unchanged; ``text_stream`` is the text source
(B01) in its streaming form, e.g.::

    counts = word_count(text_stream(spark, "/landing/texts"))
    counts.writeStream.outputMode("update").format(...).start()

The word-count aggregate keeps one state row per distinct word in the
checkpointed state store; its size grows with the vocabulary, not with the
number of lines read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame ``value: string``, one row per line of new files in ``path``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.load(path)


__all__ = ["text_stream"]
