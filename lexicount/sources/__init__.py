"""Sources: text files, string columns, literals and parquet tables."""

from lexicount.sources.tables import parquet, table
from lexicount.sources.text import (
    lines_from_column,
    lines_from_literal,
    lines_from_text,
    values,
)

__all__ = [
    "lines_from_column",
    "lines_from_literal",
    "lines_from_text",
    "parquet",
    "table",
    "values",
]
