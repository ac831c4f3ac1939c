"""Column expressions for the two text rules every operator relies on.

All of them are native Spark expressions: they stay inside whole-stage
codegen, need no Python worker and compose with any DataFrame, batch or
streaming.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's rules):
#   words are separated by exactly one ASCII space, nothing else
#   (tab, other whitespace and punctuation stay inside the word);
#   lines end at "\r\n", "\n" or "\r", like Spark's text reader.
WORD_SEPARATOR = " "
LINE_BREAK = r"\r\n|\n|\r"


def _by_name(fn):
    """Build the expression once per column name (and options).

    A Column is an unresolved expression, not tied to a session or plan, so
    one built for a name is valid for every DataFrame. Building it costs one
    JVM round trip per function call, which adds up on the driver when plans
    are built repeatedly; Column arguments are built fresh each time.
    """
    cached = functools.lru_cache(maxsize=256)(fn)

    @functools.wraps(fn)
    def wrapper(c, *args, **kwargs):
        if isinstance(c, str):
            return cached(c, *args, **kwargs)
        return fn(c, *args, **kwargs)

    return wrapper


def _empty() -> Column:
    return F.array().cast("array<string>")


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


@_by_name
def java_split(c: str | Column) -> Column:
    """Split one line on a single space with java.util.regex.Pattern.split rules.

    Leading and inner empty strings are kept, trailing ones are dropped,
    ``''`` gives ``['']``, a line of spaces only gives ``[]`` and NULL gives
    NULL (so ``explode`` yields no row). Spark's own ``split`` keeps trailing
    empties, hence the ``rtrim`` (which trims ASCII spaces only).
    """
    c = as_column(c)
    trimmed = F.rtrim(c)
    return (
        F.when(c == "", F.array(F.lit("")))
        # No trailing space, no trailing empties: Spark's split already agrees
        # (and the line is not copied by rtrim).
        .when(~c.endswith(WORD_SEPARATOR), F.split(c, WORD_SEPARATOR))
        .when(trimmed == "", _empty())
        .otherwise(F.split(trimmed, WORD_SEPARATOR))
    )


def _ends_with_break(c: Column) -> Column:
    return c.endswith("\n") | c.endswith("\r")


@_by_name
def unix_breaks(c: str | Column) -> Column:
    r"""``c`` with every line break (``\r\n``, ``\r``) written as one ``\n``.

    Texts without ``\r`` (the common case) pass through after one scan.
    """
    c = as_column(c)
    normalised = F.replace(F.replace(c, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    return F.when(c.contains("\r"), normalised).otherwise(c)


def _occurrences(c: Column, s: str) -> Column:
    # Removed bytes over the pattern's byte length: a count without splitting.
    removed = F.octet_length(c) - F.octet_length(F.replace(c, F.lit(s), F.lit("")))
    return removed if len(s) == 1 else (removed / len(s.encode())).cast("int")


@_by_name
def text_lines(c: str | Column) -> Column:
    r"""The lines of a text value, exactly as ``spark.read.text`` would read it.

    A final terminator adds no extra line, an empty text has no lines and
    NULL gives NULL. Breaks are normalised to ``\n`` and split on that one
    character (the JVM's single-character split path, no regex); when the
    text ends with a break, the last, empty piece is dropped.
    """
    c = as_column(c)
    parts = F.split(unix_breaks(c), "\n")
    return (
        F.when(c == "", _empty())
        .when(_ends_with_break(c), F.slice(parts, 1, F.size(parts) - 1))
        .otherwise(parts)
    )


@_by_name
def line_count(c: str | Column) -> Column:
    r"""Number of lines of a text value (``size(text_lines(c))``) without
    materialising the lines: ``\n`` bytes are counted, plus ``\r`` not
    followed by ``\n`` when the text has any ``\r``."""
    c = as_column(c)
    cr_only = F.when(
        c.contains("\r"), _occurrences(c, "\r") - _occurrences(c, "\r\n")
    ).otherwise(F.lit(0))
    breaks = _occurrences(c, "\n") + cr_only
    return F.when(c == "", F.lit(0)).otherwise(breaks + 1 - _ends_with_break(c).cast("int"))


@_by_name
def text_words(c: str | Column) -> Column:
    """The non-empty words of a whole multi-line text, in order.

    Turning both line-break characters into spaces and splitting on a space
    yields exactly the non-empty words of "cut into lines, then every line
    on a space". One single-character split per text instead of a line split
    plus one split per line; empties are removed before ``explode`` so they
    never become rows.
    """
    c = as_column(c)
    spaced = F.replace(F.replace(c, F.lit("\r"), F.lit(" ")), F.lit("\n"), F.lit(" "))
    return F.array_remove(F.split(spaced, WORD_SEPARATOR), "")


@_by_name
def line_words(c: str | Column) -> Column:
    """The non-empty words of one line: pieces between spaces, empties dropped."""
    c = as_column(c)
    return F.array_remove(F.split(c, WORD_SEPARATOR), "")


def _regex_quote(s: str) -> str:
    """``s`` as a literal Java regex (the ``Pattern.quote`` rule)."""
    return "\\Q" + s.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def _separators(multiline: bool) -> str:
    return " \r\n" if multiline else " "


def can_be_word(word: str, multiline: bool = False) -> bool:
    """Whether tokenising can ever produce the non-empty word ``word``."""
    return word != "" and not any(ch in word for ch in _separators(multiline))


@_by_name
def word_occurrences(c: str | Column, word: str, multiline: bool = False) -> Column:
    """How many words of ``c`` equal ``word`` (empty words never match).

    Counted with one regex scan for ``word`` bounded by separators (or the
    text's ends); the scan looks for the word itself and checks its edges only
    where it occurs. Spark gathers the matches (not the other words) in an
    array and takes its size. Separators are the space,
    plus both line-break characters when ``multiline``. A word that is
    empty or contains a separator can never be produced: 0.
    """
    if not can_be_word(word, multiline):
        return F.lit(0)
    cls = _separators(multiline).replace("\r", "\\r").replace("\n", "\\n")
    q = _regex_quote(word)
    # The literal comes first, so the regex engine only checks the edges
    # where the word actually occurs: after it, "not preceded by a
    # non-separator followed by the word" and "not followed by a non-separator".
    pattern = f"{q}(?<![^{cls}]{q})(?![^{cls}])"
    return F.regexp_count(as_column(c), F.lit(pattern))
