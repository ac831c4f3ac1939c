"""lexicount: word counting and simple column statistics as lazy Spark plans.

Every public function takes and returns DataFrames (or Columns) built only
from native Spark expressions, and no Python UDF runs. Nothing is collected
to the driver except by ``to_dict``, which refuses results over a row bound, and
the histograms of ``top_by_count``, which have a fixed size.
"""

from lexicount.functions import java_split, line_count, line_words, text_lines, text_words
from lexicount.operators import (
    count_by_value,
    exact_ranks,
    get,
    get_or_create,
    hit_ratio,
    is_cached,
    is_current,
    line_counts,
    names,
    non_empty,
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
    words,
)
from lexicount.sinks import fresh_path, pair_lines, shared_dir, to_dict, write_pairs_as_text
from lexicount.sources import (
    lines_from_column,
    lines_from_literal,
    lines_from_text,
    table,
    values,
)

__all__ = [
    "count_by_value",
    "exact_ranks",
    "fresh_path",
    "get",
    "get_or_create",
    "hit_ratio",
    "is_cached",
    "is_current",
    "java_split",
    "line_count",
    "line_words",
    "line_counts",
    "lines_from_column",
    "lines_from_literal",
    "lines_from_text",
    "names",
    "non_empty",
    "pair_lines",
    "prefix_filter",
    "rank_by_count",
    "release",
    "scale",
    "shared_dir",
    "store_counts",
    "stored_lookup",
    "sum_of_squares",
    "table",
    "text_lines",
    "text_words",
    "to_dict",
    "top_by_count",
    "total",
    "values",
    "word_count",
    "word_lookup",
    "word_lookup_sql",
    "words",
    "write_pairs_as_text",
]
