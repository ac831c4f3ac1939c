"""DataFrame-to-DataFrame operators. All are lazy but ``exact_ranks``,
``top_by_count`` and ``store_counts``, which write a table first."""

from lexicount.operators.counts import (
    count_by_value,
    exact_ranks,
    line_counts,
    rank_by_count,
    store_counts,
    stored_lookup,
    top_by_count,
    word_count,
    word_lookup,
    word_lookup_sql,
)
from lexicount.operators.named import get, get_or_create, is_cached, is_current, names, release
from lexicount.operators.numeric import hit_ratio, prefix_filter, scale, sum_of_squares, total
from lexicount.operators.tokens import non_empty, words

__all__ = [
    "count_by_value",
    "exact_ranks",
    "get",
    "get_or_create",
    "hit_ratio",
    "is_cached",
    "is_current",
    "line_counts",
    "names",
    "non_empty",
    "prefix_filter",
    "rank_by_count",
    "release",
    "scale",
    "store_counts",
    "stored_lookup",
    "sum_of_squares",
    "top_by_count",
    "total",
    "word_count",
    "word_lookup",
    "word_lookup_sql",
    "words",
]
