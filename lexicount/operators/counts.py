"""Counting operators: word count, count by value, lookups and ranking.

Every aggregate here is a hash aggregate split into a partial (map-side)
and a final phase, so a hot key costs one row per task in the shuffle, not
one row per occurrence. Nothing is collected to the driver but the histograms
of ``top_by_count``, which have a fixed size.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexicount._checks import identifier, natural, string
from lexicount.functions.text import as_column, can_be_word, line_count, word_occurrences
from lexicount.operators.tokens import words
from lexicount.sinks import fresh_path, written


def _count() -> Column:
    return F.count(F.lit(1)).alias("count")


def word_count(
    df: DataFrame,
    col: str | Column = "value",
    keep_empty: bool = False,
    multiline: bool = False,
    only: Iterable[str] | None = None,
) -> DataFrame:
    """``(word string, count bigint)`` for every distinct word of ``col``.

    ``keep_empty=False`` is the DataFrame word count (empty words dropped);
    ``keep_empty=True`` is the RDD/literal word count, which counts the empty
    words the Java split rule produces. ``multiline`` says ``col`` holds whole
    texts rather than single lines. ``only`` counts just these words.
    """
    each = words(df, col, keep_empty=keep_empty, multiline=multiline, only=only)
    return each.groupBy("word").agg(_count())


def count_by_value(df: DataFrame, col: str | Column) -> DataFrame:
    """``(<col>, count bigint)`` per distinct value; NULL is a group of its own."""
    return df.groupBy(as_column(col)).agg(_count())


def word_lookup(
    df: DataFrame, word: str, col: str | Column = "value", multiline: bool = False
) -> DataFrame:
    """One row ``(word, count)``: occurrences of ``word``, 0 when absent.

    Only texts that contain ``word`` as a substring are read past the scan
    filter (pushed to parquet as ``StringContains``); in those, matching
    words are counted in place and summed by a global aggregate, so no row
    per word is ever made. A word that cannot occur (empty, or holding a
    separator) gives 0 without reading any text.
    """
    word = string(word, "word")
    c = as_column(col)
    hits = word_occurrences("__text", word, multiline=multiline)
    if not can_be_word(word, multiline):
        src = df.filter(F.lit(False)).select(c.alias("__text"))
    else:
        src = df.filter(c.contains(word)).select(c.alias("__text"))
    total = F.coalesce(F.sum(hits), F.lit(0)).cast("bigint").alias("count")
    return src.agg(total).select(F.lit(word).alias("word"), "count")


def word_lookup_sql(spark: SparkSession, counts: DataFrame, word: str) -> DataFrame:
    """Same answer as ``word_lookup`` through SQL over the counts.

    The word is bound as a named parameter, never pasted into the SQL text,
    so quotes, backslashes or SQL fragments in it are plain data. ``counts``
    is passed to the statement itself: no view of any name is made or
    replaced. Catalyst pushes ``word = :w`` below the aggregate, but not below
    the tokeniser: counts made for this lookup alone should be of ``only`` that
    word (``word_count(..., only=[word])``), so that the scan leaves out the texts
    without it; ``word_lookup`` counts in place.
    """
    word = string(word, "word")
    return spark.sql(
        "SELECT CAST(:w AS STRING) AS word, coalesce(max(`count`), 0L) AS `count` "
        "FROM {counts} WHERE word = :w",
        args={"w": word},
        counts=counts,
    )


def rank_by_count(counts: DataFrame, n: int | None = None) -> DataFrame:
    """Order by ``count`` descending, then ``word`` ascending; top ``n`` if given.

    Without ``n`` the rows are range-partitioned and every partition is
    sorted, so the ranking may be of any length. With ``n`` the plan is a
    single ``TakeOrderedAndProject``: every task keeps its own top ``n`` and
    one task merges them, so ``n`` must stay small (thousands); use
    ``top_by_count`` for more.
    """
    ranked = counts.orderBy(F.col("count").desc(), F.col("word").asc())
    if n is None:
        return ranked
    return ranked.limit(natural(n, "n"))


def _best_first() -> list[Column]:
    return [F.col("count").desc(), F.col("word").asc()]


def exact_ranks(counts: DataFrame) -> DataFrame:
    """``(rank, word, count)``: every word's place in the order of
    ``rank_by_count``, from 1, without ties (O1).

    The rows are range-partitioned and sorted, and written with their range
    and their place in it; a rank is the number of rows in earlier ranges plus
    the place. Only the sizes of the ranges, one row each, meet in one task, and
    only they are broadcast.
    """
    order = _best_first()
    # The upper bits of the increasing id are the partition, the lower 33 the place.
    at = F.monotonically_increasing_id()
    sorted_rows = counts.select("word", "count").repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(
        sorted_rows.select("word", "count", F.spark_partition_id().alias("part"), at.bitwiseAND((1 << 33) - 1).alias("place")),
        "ranked",
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    offsets = sizes.select(F.col("part").alias("o_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    ranked = placed.join(F.broadcast(offsets), F.col("part") == F.col("o_part"))
    return ranked.select((F.col("offset") + F.col("place") + 1).alias("rank"), "word", "count")


#: Bits of a count that one histogram tells apart: at most 2**16 rows of it.
_DIGIT = 16


def _threshold(counts: DataFrame, n: int) -> tuple[int, int] | None:
    """``(cut, above)``: the ``n``-th largest count and how many are larger;
    None if there are fewer than ``n``. Digit by digit, from the highest."""
    largest = counts.agg(F.max("count")).first()[0]
    if largest is None:
        return None
    cut, above = 0, 0
    for shift in reversed(range(0, max(1, largest.bit_length()), _DIGIT)):
        of = counts.filter(F.shiftright("count", shift + _DIGIT) == cut) if shift + _DIGIT < 64 else counts
        digit = F.shiftright("count", shift).bitwiseAND((1 << _DIGIT) - 1)
        histogram = of.groupBy(digit.alias("digit")).agg(_count()).collect()
        for row in sorted(histogram, key=lambda r: -r["digit"]):
            if above + row["count"] >= n:
                cut = (cut << _DIGIT) | row["digit"]
                break
            above += row["count"]
        else:
            return None
    return cut, above


def top_by_count(counts: DataFrame, n: int, stored: bool = False) -> DataFrame:
    """``(rank, word, count)`` of the ``n`` first words in the order of
    ``rank_by_count``, for an ``n`` of any size (O2).

    Histograms of the counts' digits (at most 2**16 rows each) give the count
    of the last word taken. All words above it are in; those that have just
    that count are ranked by word, and as many as are missing are taken. No
    task merges ``n`` rows. ``counts`` is read several times, so it is written
    first, unless it is a ``stored`` table already.
    """
    n = natural(n, "n")
    if not stored:
        counts = written(counts.select("word", "count"), "counts")
    if n == 0:
        return exact_ranks(counts.limit(0))
    found = _threshold(counts, n)
    if found is None:
        return exact_ranks(counts)
    cut, above = found
    ties = exact_ranks(counts.filter(F.col("count") == cut)).filter(F.col("rank") <= n - above)
    ties = ties.withColumn("rank", F.col("rank") + above)
    return exact_ranks(counts.filter(F.col("count") > cut)).unionByName(ties)


COUNT_TABLE = "lexicount_counts_"


def store_counts(spark: SparkSession, counts: DataFrame, name: str, buckets: int = 64) -> str:
    """Write ``counts`` as a table bucketed and sorted by word, for repeated
    lookups; returns the table's name. A table stored before under the name is
    replaced. The files are in the shared folder, one for every bucket; choose
    ``buckets`` so that one holds about 128 MB.
    """
    stored = COUNT_TABLE + identifier(name, "count table name")
    if natural(buckets, "buckets") < 1:
        raise ValueError("buckets must be positive")
    # Dealt as the buckets are, so that each is written by one task.
    dealt = counts.select("word", "count").repartition(buckets, "word")
    writer = dealt.write.bucketBy(buckets, "word").sortBy("word").option("path", fresh_path(spark, stored))
    writer.mode("overwrite").saveAsTable(stored)
    return stored


def stored_lookup(spark: SparkSession, name: str, word: str) -> DataFrame:
    """``word_lookup`` over a table of ``store_counts``: ``(word, count)``, 0
    when absent. The scan reads the one bucket that the word is in, with the
    word pushed down to it; no text is read again.
    """
    word = string(word, "word")
    rows = spark.table(COUNT_TABLE + identifier(name, "count table name")).filter(F.col("word") == word)
    return rows.agg(F.coalesce(F.max("count"), F.lit(0)).alias("count")).select(F.lit(word).alias("word"), "count")


def line_counts(df: DataFrame, key: str = "doc_id", col: str | Column = "text") -> DataFrame:
    """``(<key>, n_lines bigint)``: lines per key under the text-reader rule.

    Equal to counting the rows of ``lines_from_column(df, col, keep=[key])``
    per key, but the lines are counted in place instead of exploded, so only
    one small row per input row is shuffled. Keys whose texts have no line
    (NULL or empty) do not appear, as with the exploded form.
    """
    c = as_column(col)
    texts = df.filter(c.isNotNull() & (c != "")).select(key, line_count(c).cast("bigint").alias("__lines"))
    return texts.groupBy(key).agg(F.sum("__lines").alias("n_lines"))
