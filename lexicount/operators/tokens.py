"""Tokenising operators: lines (or whole texts) to one row per word."""

from __future__ import annotations

import functools
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexicount._checks import string
from lexicount.functions.text import as_column, java_split, line_words, text_lines, text_words
from lexicount.plans import repartitioned


def non_empty(df: DataFrame, col: str = "word") -> DataFrame:
    """Drop rows whose ``col`` is the empty string (B06). NULL rows go too,
    as a SQL filter drops them."""
    return df.filter(F.col(col) != "")


def words(
    df: DataFrame,
    col: str | Column = "value",
    keep_empty: bool = False,
    multiline: bool = False,
    keep: Iterable[str] = (),
    partitions: int | None = None,
    only: Iterable[str] | None = None,
) -> DataFrame:
    """One ``word`` row per space-separated piece of ``col``.

    ``col`` holds one line per row, unless ``multiline`` is set: then it holds
    whole texts and is first cut into lines with the text-reader rule.
    ``keep_empty=False`` (the default) drops empty words; ``True`` keeps them
    under the Java split rule (see ``java_split``). ``keep`` names columns
    carried next to every word. ``only`` gives just these words, and texts that
    contain none of them are left out by the scan. Map-only, unless
    ``partitions`` asks for a round-robin exchange of the input first.
    """
    keep = list(keep)
    if only is not None:
        only = sorted({string(w, "word") for w in only})
        holds = (as_column(col).contains(w) for w in only)
        df = df.filter(functools.reduce(Column.__or__, holds, F.lit(False)))
    src = repartitioned(df, partitions).select(*keep, as_column(col).alias("__text"))
    if multiline and keep_empty:
        src = src.select(*keep, F.explode(text_lines("__text")).alias("__text"))
    if keep_empty:
        pieces = java_split("__text")
    else:
        pieces = text_words("__text") if multiline else line_words("__text")
    each = src.select(*keep, F.explode(pieces).alias("word"))
    return each if only is None else each.filter(F.col("word").isin(only))
