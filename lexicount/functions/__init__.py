"""Column-level building blocks (native Spark expressions only)."""

from lexicount.functions.text import (
    LINE_BREAK,
    WORD_SEPARATOR,
    as_column,
    can_be_word,
    java_split,
    line_count,
    line_words,
    text_lines,
    text_words,
    unix_breaks,
    word_occurrences,
)

__all__ = [
    "LINE_BREAK",
    "WORD_SEPARATOR",
    "as_column",
    "can_be_word",
    "java_split",
    "line_count",
    "text_lines",
    "line_words",
    "text_words",
    "unix_breaks",
    "word_occurrences",
]
