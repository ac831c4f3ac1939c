"""Line deduplication by range-partitioned hashes (operator 13), DataFrame
functions only.

A text is its ``\\n``-split lines; a line's key is the line without the white
space ``[\\x20\\x09-\\x0D]`` at both ends, A-Z in lower case. A key of at least
``least_chars`` code points that two or more documents hold stays in the one of
the smallest id, with all its lines there, and goes from all others.

Only 128-bit hashes of the keys move, with the document and the position. They
are range-partitioned and sorted by (hash, document, position), so a key that a
third of all lines hold is cut into as many ranges as its rows need. Each range
is then read as a stream in which the first document of a hash is the one that
keeps it. A hash that began in an earlier range is the last one there: the
last hash of every range with its first document, a row per range, is what the
ranges tell each other.

What comes back is no text: of every document the bitmap of the lines that
stay, run-length compressed into ``keep``, an array of ``(start, length)`` runs
of kept lines. ``applied`` cuts the texts by it.

A document is an id: rows that repeat an id are one document and keep each
other's keys. Null ids are one document behind all others. A null or empty text
is one empty line. Texts and ids of repeated rows stay apart by a key of the
text, so every row gets its own bitmap. An empty table gives no rows.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexicount.llm._spark import pick, text_key, written

LEAST_CHARS = 10
BLANK = " \t\n\x0b\x0c\r"
#: Stands for the null id, behind all others.
NO_ID = 2**63 - 1
_ORDER = ("h1", "h2", "doc", "tkey", "pos")


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    bare = F.btrim(line, F.lit(BLANK))
    # Lower-casing would change other letters too; ASCII lines have none.
    ascii_only = F.octet_length(bare) == F.length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, string.ascii_uppercase, string.ascii_lowercase))


def _body(text: str) -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def _documents(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``(doc, tkey, text)``; the null id is the largest number."""
    own = pick(docs, doc_id=doc_id, text=text)
    return own.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), text_key(F.col("text")).alias("tkey"),
        _body("text").alias("text"), F.col("doc_id").cast("long").alias("doc_id"),
    )


def hashed_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS) -> DataFrame:
    """``(doc, tkey, pos, h1, h2)`` of every line whose key is long enough."""
    each = _documents(docs, doc_id, text).select("doc", "tkey", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    keys = each.select("doc", "tkey", "pos", line_key(F.col("line")).alias("key")).filter(F.length("key") >= least_chars)
    return keys.select("doc", "tkey", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"))


def dropped_lines(lines: DataFrame) -> DataFrame:
    """``(doc, tkey, pos)`` of the lines that go, each once."""
    # Sampling the ranges and dealing the rows both read what is written here.
    lines = written(lines, "line-hashes")
    ranges = written(
        lines.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER).withColumn("part", F.spark_partition_id()),
        "line-ranges",
    )
    # Of a range's largest hash the smallest document: ~x turns the order of x.
    last = F.max(F.struct("h1", "h2", F.bitwise_not("doc").alias("doc"))).alias("last")
    carry = ranges.groupBy("part").agg(last).groupBy("last.h1", "last.h2").agg(F.min(F.bitwise_not("last.doc")).alias("carried"))
    carry = carry.select(F.col("h1").alias("c1"), F.col("h2").alias("c2"), "carried")
    stream = Window.partitionBy("part", "h1", "h2").orderBy("doc", "tkey", "pos").rowsBetween(Window.unboundedPreceding, 0)
    first = ranges.withColumn("here", F.first("doc").over(stream))
    # A row per range at most: spark.sql.shuffle.partitions of them.
    first = first.join(F.broadcast(carry), (F.col("h1") == F.col("c1")) & (F.col("h2") == F.col("c2")), "left")
    keeper = F.least("here", F.coalesce("carried", "here"))
    return first.filter(F.col("doc") != keeper).select("doc", "tkey", "pos").distinct()


def keep_bitmaps(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS) -> DataFrame:
    """``(doc, tkey, n_lines, n_dropped, keep)``, one row per distinct id and
    text; ``doc`` is the id, 2**63 - 1 for null."""
    gone = dropped_lines(hashed_lines(docs, doc_id, text, least_chars))
    holes = gone.groupBy(F.col("doc").alias("g_doc"), F.col("tkey").alias("g_key")).agg(F.array_sort(F.collect_list("pos")).alias("holes"))
    breaks = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    sizes = _documents(docs, doc_id, text).groupBy("doc", "tkey").agg(F.max(breaks + 1).alias("n_lines"))
    both = sizes.join(holes, (F.col("doc") == F.col("g_doc")) & (F.col("tkey") == F.col("g_key")), "left")
    none = F.array().cast("array<int>")
    holes_or = F.coalesce("holes", none)
    # Runs of kept lines lie between the holes before and behind them.
    before, behind = F.concat(F.array(F.lit(-1)), holes_or), F.concat(holes_or, F.array(F.col("n_lines")))
    runs = F.zip_with(before, behind, lambda a, b: F.struct((a + 1).alias("start"), (b - a - 1).alias("length")))
    return both.select(
        "doc", "tkey", F.col("n_lines").cast("long").alias("n_lines"), F.size(holes_or).cast("long").alias("n_dropped"),
        F.filter(runs, lambda r: r["length"] > 0).alias("keep"),
    )


def kept_text(text: Column, keep: Column) -> Column:
    """The lines of ``text`` in the runs, joined."""
    lines = F.split(text, "\n", -1)
    return F.array_join(F.flatten(F.transform(keep, lambda r: F.slice(lines, r["start"] + 1, r["length"]))), "\n")


def applied(docs: DataFrame, bitmaps: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_lines, n_dropped, keep, text)`` per row of ``docs``, the
    text without the lines that go."""
    own = _documents(docs, doc_id, text)
    maps = bitmaps.select(F.col("doc").alias("b_doc"), F.col("tkey").alias("b_key"), "n_lines", "n_dropped", "keep")
    met = own.join(maps, (F.col("doc") == F.col("b_doc")) & (F.col("tkey") == F.col("b_key")))
    left = F.when(F.col("n_dropped") == 0, F.col("text")).otherwise(kept_text(F.col("text"), F.col("keep")))
    return met.select("doc_id", "n_lines", "n_dropped", "keep", left.alias("text"))
