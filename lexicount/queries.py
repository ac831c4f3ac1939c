"""Registered queries over the test tables and their DuckDB oracle SQL.

Each query is a callable ``(spark, data_dir) -> DataFrame`` that reads the
whole of its tables; ``ORACLE_SQL`` holds, per query, a self-contained SQL
statement DuckDB runs over the same parquet files (views named after the
tables). Column names and types agree between the two.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexicount.operators import (
    count_by_value,
    exact_ranks,
    get,
    get_or_create,
    hit_ratio,
    line_counts,
    names,
    prefix_filter,
    rank_by_count,
    release,
    scale,
    store_counts,
    stored_lookup,
    sum_of_squares,
    top_by_count,
    total,
    word_count,
    word_lookup,
    word_lookup_sql,
)
from lexicount.sinks import fresh_path, pair_lines, write_pairs_as_text, written
from lexicount.sources import lines_from_column, lines_from_text, table

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values from the reference's jobs: the name prefix "ho" and the
# ratio factor 4.0 (hits inside the disc times 4 over all darts).
PREFIX = "ho"
HIT_FACTOR = 4.0

# Our parameters: the top-n size, the looked-up words and the disc. The dart
# predicate is re-aimed at table rows: the first two vector components are
# the point and the disc has radius^2 0.02 around the origin.
TOP_N = 50
LOOKUP_WORD = "the"
LOOKUP_MISSING_WORD = "zzzz"
LOOKUP_SQL_WORD = "of"
LOOKUP_WORDS = ("the", "of", "and", "zzzz", "it's")
HIT_RADIUS_SQ = 0.02
# The reference's own disc has its centre at (1, 1).
SHIFTED_RADIUS_SQ = 2.0


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents")


def q_word_count(spark: SparkSession, d: str) -> DataFrame:
    return word_count(_docs(spark, d), "text", multiline=True)


def q_line_word_count(spark: SparkSession, d: str) -> DataFrame:
    # The reference's shape: lines first, then words per line.
    return word_count(lines_from_column(_docs(spark, d), "text"), "value")


def q_word_count_raw(spark: SparkSession, d: str) -> DataFrame:
    return word_count(_docs(spark, d), "text", keep_empty=True, multiline=True)


def q_string_word_count(spark: SparkSession, d: str) -> DataFrame:
    # The job-parameter form: each text is one string, split on spaces only
    # (line breaks stay inside words), empty words counted.
    return word_count(_docs(spark, d), "text", keep_empty=True)


def _edge_line(doc_id):
    # Six bad lines chosen by document, covering every Java split edge.
    k = doc_id % 6
    return (
        F.when(k == 0, F.lit(""))
        .when(k == 1, F.lit("   "))
        .when(k == 2, F.lit("a b "))
        .when(k == 3, F.lit("  a  b  "))
        .when(k == 4, F.lit("a\tb"))
        .otherwise(F.lit("a  b"))
    )


def q_word_count_raw_edge(spark: SparkSession, d: str) -> DataFrame:
    # The bad line first, then the whole text, as one string.
    edge = F.concat(_edge_line(F.col("doc_id")), F.col("text"))
    return word_count(_docs(spark, d), edge, keep_empty=True)


def _broken_text(doc_id, text):
    # Every text with other line ends, by document: \r\n, a lone \r, mixed with
    # a tab, a final break, trailing spaces; some rows empty, some NULL.
    k = doc_id % 9
    return (
        F.when(k == 0, F.replace(text, F.lit("\n"), F.lit("\r\n")))
        .when(k == 1, F.replace(text, F.lit("\n"), F.lit("\r")))
        .when(k == 2, F.concat(F.replace(text, F.lit(". "), F.lit(".\t")), F.lit("\r\n")))
        .when(k == 3, F.concat(text, F.lit("\n")))
        .when(k == 4, F.concat(F.replace(text, F.lit("\n"), F.lit("  \n")), F.lit("   ")))
        .when(k == 5, F.concat(text, F.lit("\n\r\n\n")))
        .when(k == 6, F.concat(F.lit("\r"), F.replace(text, F.lit(". "), F.lit(".\n\r")), F.lit("\r")))
        .when(k == 7, F.when(doc_id % 2 == 0, F.lit("")).otherwise(text))
        .otherwise(F.when(doc_id % 2 == 0, text))
    )


def _broken(spark: SparkSession, d: str) -> DataFrame:
    docs = _docs(spark, d)
    return docs.select("doc_id", _broken_text(F.col("doc_id"), F.col("text")).alias("text"))


def q_word_count_breaks(spark: SparkSession, d: str) -> DataFrame:
    return word_count(_broken(spark, d), "text", multiline=True)


def q_word_count_raw_breaks(spark: SparkSession, d: str) -> DataFrame:
    return word_count(_broken(spark, d), "text", keep_empty=True, multiline=True)


def q_line_counts_breaks(spark: SparkSession, d: str) -> DataFrame:
    return line_counts(_broken(spark, d), "doc_id", "text")


def q_word_lookup_breaks(spark: SparkSession, d: str) -> DataFrame:
    return word_lookup(_broken(spark, d), LOOKUP_WORD, "text", multiline=True)


def _spaced_text(text):
    # Real text with spacing defects: a leading space, double spaces after
    # sentences, an empty and a blank line at every break, trailing spaces.
    body = F.replace(F.replace(text, F.lit(". "), F.lit(".  ")), F.lit("\n"), F.lit("\n\n \n"))
    return F.concat(F.lit(" "), body, F.lit("  "))


def q_word_count_raw_spaced(spark: SparkSession, d: str) -> DataFrame:
    return word_count(_docs(spark, d), _spaced_text(F.col("text")), keep_empty=True, multiline=True)


def q_text_file_word_count(spark: SparkSession, d: str) -> DataFrame:
    # The texts written as a text file in the shared folder, anew for every
    # call, and read back as lines.
    path = fresh_path(spark, "documents-text")
    _docs(spark, d).select("text").write.text(path)
    return word_count(lines_from_text(spark, path))


def q_conversation_word_count(spark: SparkSession, d: str) -> DataFrame:
    return word_count(table(spark, d, "conversations"), "text", multiline=True)


def q_page_word_count(spark: SparkSession, d: str) -> DataFrame:
    return word_count(table(spark, d, "pages"), "html", multiline=True)


def q_line_counts(spark: SparkSession, d: str) -> DataFrame:
    return line_counts(_docs(spark, d), "doc_id", "text")


def q_word_lookup(spark: SparkSession, d: str) -> DataFrame:
    return word_lookup(_docs(spark, d), LOOKUP_WORD, "text", multiline=True)


def q_word_lookup_missing(spark: SparkSession, d: str) -> DataFrame:
    return word_lookup(_docs(spark, d), LOOKUP_MISSING_WORD, "text", multiline=True)


def q_word_lookup_sql(spark: SparkSession, d: str) -> DataFrame:
    counts = word_count(_docs(spark, d), "text", multiline=True, only=[LOOKUP_SQL_WORD])
    return word_lookup_sql(spark, counts, LOOKUP_SQL_WORD)


def q_top_words(spark: SparkSession, d: str) -> DataFrame:
    return rank_by_count(q_word_count(spark, d), TOP_N)


def q_pair_lines(spark: SparkSession, d: str) -> DataFrame:
    return pair_lines(q_word_count(spark, d))


def q_ranked_words(spark: SparkSession, d: str) -> DataFrame:
    return exact_ranks(q_word_count(spark, d))


def q_top_half_words(spark: SparkSession, d: str) -> DataFrame:
    # The larger half of the vocabulary; most of it are words that occur once.
    counts = written(q_word_count(spark, d), "counts")
    return top_by_count(counts, counts.count() // 2, stored=True)


def q_word_lookup_stored(spark: SparkSession, d: str) -> DataFrame:
    # Counted once, looked up again and again.
    name = f"words_{_folder_hash(d)}"
    store_counts(spark, q_word_count(spark, d), name)
    found = [stored_lookup(spark, name, w) for w in LOOKUP_WORDS]
    return functools.reduce(DataFrame.unionByName, found)


def q_pair_lines_file(spark: SparkSession, d: str) -> DataFrame:
    # Written as text in the shared folder, then read back.
    path = fresh_path(spark, "pairs-text")
    write_pairs_as_text(q_word_count(spark, d), path)
    return lines_from_text(spark, path)


def q_count_by_value(spark: SparkSession, d: str) -> DataFrame:
    return count_by_value(table(spark, d, "events"), "event_type")


def _lineitem(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem")


def q_doubled(spark: SparkSession, d: str) -> DataFrame:
    li = _lineitem(spark, d).select("l_orderkey", "l_linenumber")
    return scale(li, "l_linenumber", 2, out="doubled")


def q_total(spark: SparkSession, d: str) -> DataFrame:
    return total(_lineitem(spark, d), "l_linenumber")


def q_total_doubled(spark: SparkSession, d: str) -> DataFrame:
    return total(_lineitem(spark, d), "l_linenumber", k=2)


def q_sum_of_squares(spark: SparkSession, d: str) -> DataFrame:
    return sum_of_squares(_lineitem(spark, d), "l_linenumber")


def _in_disc(centre: float, radius_sq: float):
    emb = F.col("embedding")
    x, y = (F.try_element_at(emb, F.lit(i)).cast("double") - F.lit(centre) for i in (1, 2))
    return x * x + y * y <= F.lit(radius_sq)


def q_hit_ratio(spark: SparkSession, d: str) -> DataFrame:
    return hit_ratio(table(spark, d, "embeddings"), _in_disc(0.0, HIT_RADIUS_SQ), k=HIT_FACTOR)


def q_hit_ratio_shifted(spark: SparkSession, d: str) -> DataFrame:
    return hit_ratio(table(spark, d, "embeddings"), _in_disc(1.0, SHIFTED_RADIUS_SQ), k=HIT_FACTOR)


def q_prefix_filter(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part").select("p_partkey", "p_name")
    return prefix_filter(part, "p_name", PREFIX)


def _folder_hash(d: str) -> str:
    return hashlib.sha1(d.rstrip("/").encode()).hexdigest()[:12]


def _dataset_name(d: str) -> str:
    # The name identifies the data (table and folder), so a second call over
    # the same folder reuses the cached dataset and another folder gets its own.
    return f"lineitem_linenumber_{_folder_hash(d)}"


def _keys_name(d: str) -> str:
    return f"order_keys_{_folder_hash(d)}"


def q_named_dataset_total(spark: SparkSession, d: str) -> DataFrame:
    numbers = get_or_create(
        spark, _dataset_name(d), lambda: _lineitem(spark, d).select("l_linenumber")
    )
    return total(numbers, "l_linenumber")


def q_named_datasets(spark: SparkSession, d: str) -> DataFrame:
    # A dataset by its name, one that is not there, and the list of names.
    name, missing = _keys_name(d), f"nothing_{_folder_hash(d)}"
    orders = table(spark, d, "orders")
    first = get_or_create(spark, name, lambda: orders.select("o_orderkey"))
    found, none = get(spark, name), get(spark, missing)
    listed = names(spark)
    same = found.sameSemantics(first)

    def row(label: str, listed: bool, same: bool | None):
        kinds = zip((label, listed, same), ("string", "boolean", "boolean"), ("dataset", "listed", "same_data"), strict=True)
        return [F.lit(v).cast(kind).alias(c) for v, kind, c in kinds]

    there = total(found, "o_orderkey").select(*row("order keys", name in listed, same), "total")
    absent = total(orders.limit(0) if none is None else none, "o_orderkey")
    return there.unionByName(absent.select(*row("missing", missing in listed, None), "total"))


def release_named_datasets(spark: SparkSession, d: str) -> None:
    """Free what the queries over named datasets have cached for the folder."""
    for name in (_dataset_name(d), _keys_name(d)):
        release(spark, name)


QUERIES: dict[str, Query] = {
    "word_count": q_word_count,
    "line_word_count": q_line_word_count,
    "word_count_raw": q_word_count_raw,
    "word_count_raw_edge": q_word_count_raw_edge,
    "word_count_breaks": q_word_count_breaks,
    "word_count_raw_breaks": q_word_count_raw_breaks,
    "line_counts_breaks": q_line_counts_breaks,
    "word_lookup_breaks": q_word_lookup_breaks,
    "conversation_word_count": q_conversation_word_count,
    "page_word_count": q_page_word_count,
    "string_word_count": q_string_word_count,
    "word_count_raw_spaced": q_word_count_raw_spaced,
    "text_file_word_count": q_text_file_word_count,
    "line_counts": q_line_counts,
    "word_lookup": q_word_lookup,
    "word_lookup_missing": q_word_lookup_missing,
    "word_lookup_sql": q_word_lookup_sql,
    "top_words": q_top_words,
    "ranked_words": q_ranked_words,
    "top_half_words": q_top_half_words,
    "word_lookup_stored": q_word_lookup_stored,
    "pair_lines": q_pair_lines,
    "pair_lines_file": q_pair_lines_file,
    "count_by_value": q_count_by_value,
    "doubled": q_doubled,
    "total": q_total,
    "total_doubled": q_total_doubled,
    "sum_of_squares": q_sum_of_squares,
    "hit_ratio": q_hit_ratio,
    "hit_ratio_shifted": q_hit_ratio_shifted,
    "prefix_filter": q_prefix_filter,
    "named_dataset_total": q_named_dataset_total,
    "named_datasets": q_named_datasets,
}


# ---------------------------------------------------------------- oracle SQL
# DuckDB: string literals keep backslashes, so the regex below sees \r and \n.
_BREAK = r"'\r\n|\n|\r'"


def _java_words(v: str) -> str:
    return (
        f"unnest(CASE WHEN {v}='' THEN [''] WHEN rtrim({v},' ')='' THEN []::VARCHAR[] "
        f"ELSE string_split(rtrim({v},' '),' ') END)"
    )


def _line_array(t: str) -> str:
    # Text-reader rule: no lines for '', no extra line after a final break.
    parts = f"regexp_split_to_array({t},{_BREAK})"
    return (
        f"CASE WHEN {t}='' THEN []::VARCHAR[] "
        f"WHEN ends_with({t},chr(10)) OR ends_with({t},chr(13)) "
        f"THEN list_slice({parts},1,len({parts})-1) ELSE {parts} END"
    )


def _lines(src: str = "documents", text: str = "text") -> str:
    return f"SELECT unnest({_line_array(text)}) AS value FROM {src}"


def _words(src: str = "documents", text: str = "text") -> str:
    return f"SELECT unnest(string_split(value,' ')) AS word FROM ({_lines(src, text)})"


def _word_count(src: str = "documents", text: str = "text") -> str:
    return f"SELECT word, count(*) AS count FROM ({_words(src, text)}) WHERE word<>'' GROUP BY word"


_WORD_COUNT = _word_count()

_EDGE = (
    "SELECT CASE doc_id % 6 WHEN 0 THEN '' WHEN 1 THEN '   ' WHEN 2 THEN 'a b ' "
    "WHEN 3 THEN '  a  b  ' WHEN 4 THEN concat('a',chr(9),'b') ELSE 'a  b' END || text AS value "
    "FROM documents"
)

_SPACED = (
    "SELECT concat(' ', replace(replace(text,'. ','.  '),chr(10),chr(10)||chr(10)||' '||chr(10)), '  ') "
    "AS text FROM documents"
)


_BROKEN = (
    "(SELECT doc_id, CASE doc_id % 9 "
    "WHEN 0 THEN replace(text, chr(10), chr(13)||chr(10)) "
    "WHEN 1 THEN replace(text, chr(10), chr(13)) "
    "WHEN 2 THEN replace(text, '. ', '.'||chr(9)) || chr(13)||chr(10) "
    "WHEN 3 THEN text || chr(10) "
    "WHEN 4 THEN replace(text, chr(10), '  '||chr(10)) || '   ' "
    "WHEN 5 THEN text || chr(10)||chr(13)||chr(10)||chr(10) "
    "WHEN 6 THEN chr(13) || replace(text, '. ', '.'||chr(10)||chr(13)) || chr(13) "
    "WHEN 7 THEN CASE WHEN doc_id % 2 = 0 THEN '' ELSE text END "
    "ELSE CASE WHEN doc_id % 2 = 0 THEN text END END AS text FROM documents)"
)


def _lookup(word: str, src: str = "documents") -> str:
    quoted = "'" + word.replace("'", "''") + "'"
    return f"SELECT {quoted} AS word, count(*) AS count FROM ({_words(src)}) WHERE word={quoted}"


def _line_counts(src: str = "documents") -> str:
    return (
        f"SELECT doc_id, count(*) AS n_lines FROM (SELECT doc_id, "
        f"unnest({_line_array('text')}) AS value FROM {src}) GROUP BY doc_id"
    )


def _hit_ratio(centre: float, radius_sq: float) -> str:
    x, y = (f"(CAST(embedding[{i}] AS DOUBLE)-{centre!r})" for i in (1, 2))
    return (
        f"SELECT hit, total, CASE WHEN total=0 THEN NULL ELSE CAST({HIT_FACTOR!r} AS DOUBLE)*hit/total END "
        "AS ratio FROM (SELECT CAST(count_if(h) AS BIGINT) AS hit, count(*) AS total FROM (SELECT "
        f"{x}*{x}+{y}*{y}<={radius_sq!r} AS h FROM embeddings))"
    )


_PAIR_LINES = (
    f"SELECT concat(word, ': ', count(*)) AS value FROM ({_words()}) WHERE word<>'' GROUP BY word"
)


_RANK = "row_number() OVER (ORDER BY count DESC, word) AS rank"

ORACLE_SQL: dict[str, str] = {
    "word_count": _WORD_COUNT,
    "line_word_count": _WORD_COUNT,
    "word_count_raw": (
        f"SELECT word, count(*) AS count FROM (SELECT {_java_words('value')} AS word "
        f"FROM ({_lines()})) GROUP BY word"
    ),
    "word_count_raw_edge": (
        f"SELECT word, count(*) AS count FROM (SELECT {_java_words('value')} AS word "
        f"FROM ({_EDGE})) GROUP BY word"
    ),
    "word_count_breaks": _word_count(_BROKEN),
    "word_count_raw_breaks": (
        f"SELECT word, count(*) AS count FROM (SELECT {_java_words('value')} AS word "
        f"FROM ({_lines(_BROKEN)})) GROUP BY word"
    ),
    "line_counts_breaks": _line_counts(_BROKEN),
    "word_lookup_breaks": _lookup(LOOKUP_WORD, _BROKEN),
    "conversation_word_count": _word_count("conversations"),
    "page_word_count": _word_count("pages", "html"),
    "string_word_count": (
        f"SELECT word, count(*) AS count FROM (SELECT {_java_words('text')} AS word "
        f"FROM documents) GROUP BY word"
    ),
    "word_count_raw_spaced": (
        f"SELECT word, count(*) AS count FROM (SELECT {_java_words('value')} AS word "
        f"FROM ({_lines('(' + _SPACED + ')')})) GROUP BY word"
    ),
    "text_file_word_count": _WORD_COUNT,
    "line_counts": _line_counts(),
    "word_lookup": _lookup(LOOKUP_WORD),
    "word_lookup_missing": _lookup(LOOKUP_MISSING_WORD),
    "word_lookup_sql": _lookup(LOOKUP_SQL_WORD),
    "top_words": f"{_WORD_COUNT} ORDER BY count DESC, word LIMIT {TOP_N}",
    "ranked_words": f"SELECT {_RANK}, word, count FROM ({_WORD_COUNT})",
    "top_half_words": (
        f"WITH c AS ({_WORD_COUNT}) SELECT {_RANK}, word, count FROM c "
        "QUALIFY rank <= (SELECT count(*) // 2 FROM c)"
    ),
    "word_lookup_stored": " UNION ALL ".join(_lookup(w) for w in LOOKUP_WORDS),
    "pair_lines": _PAIR_LINES,
    "pair_lines_file": _PAIR_LINES,
    "count_by_value": "SELECT event_type, count(*) AS count FROM events GROUP BY event_type",
    "doubled": "SELECT l_orderkey, l_linenumber, CAST(l_linenumber AS BIGINT)*2 AS doubled FROM lineitem",
    "total": "SELECT CAST(sum(l_linenumber) AS BIGINT) AS total FROM lineitem",
    "total_doubled": "SELECT CAST(sum(CAST(l_linenumber AS BIGINT)*2) AS BIGINT) AS total FROM lineitem",
    "sum_of_squares": (
        "SELECT CAST(sum(CAST(l_linenumber AS BIGINT)*l_linenumber) AS BIGINT) AS sum_sq FROM lineitem"
    ),
    "hit_ratio": _hit_ratio(0.0, HIT_RADIUS_SQ),
    "hit_ratio_shifted": _hit_ratio(1.0, SHIFTED_RADIUS_SQ),
    "prefix_filter": f"SELECT p_partkey, p_name FROM part WHERE starts_with(p_name,'{PREFIX}')",
    "named_dataset_total": "SELECT CAST(sum(l_linenumber) AS BIGINT) AS total FROM lineitem",
    "named_datasets": (
        "SELECT 'order keys' AS dataset, true AS listed, true AS same_data, CAST(sum(o_orderkey) AS BIGINT) AS total FROM orders "
        "UNION ALL SELECT 'missing', false, NULL, NULL"
    ),
}

if set(ORACLE_SQL) != set(QUERIES):
    raise RuntimeError(f"queries without oracle SQL or the reverse: {set(ORACLE_SQL) ^ set(QUERIES)}")
