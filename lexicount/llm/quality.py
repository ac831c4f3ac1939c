"""Quality rules by cross-document line frequency (operator 1).

Every line with a word is normalised (lower case, words joined by one
space) and hashed; for each host the number of documents that hold the line
is counted, exact copies of a text counting as one document. A line held by
more than ``max(min_docs, max_share * documents of the host)`` documents is
frequent and is removed, except from its first carrier (the smallest
document id of the host) and its exact copies, so that no content vanishes
everywhere. A document
that keeps less than ``min_left`` of its words is depleted and rejected,
besides those that fail the base rules.

Shape: one pass over the texts gives a small row per document and one row
per (host, line, document); line counts are pre-aggregated before the
shuffle, and frequent lines meet their documents in a join whose sides Spark
may split when one line is held by a third of all documents.

Null or empty texts have no words and fail the base rules; a null host is a
host of its own; repeated rows each get their (equal) result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexicount.llm import _words as w
from lexicount.llm._spark import Batches, map_arrow, packed_row, pick, row_type, text_key, unpacked, written

#: A line is frequent above this many documents of a host ...
MIN_DOCS = 20
#: ... and above this share of them.
MAX_SHARE = 0.002
#: A document must keep this share of its words.
MIN_LEFT = 0.2
#: Base rules: least words, and most of them (in percent) in repeated windows.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True

_SCHEMA = (
    "doc_id long, host string, tkey binary, n_words long, word_chars long, n_symbols long, "
    "n_dup_lines long, n_repeat_words long, lines array<struct<line:long,words:int>>"
)


def line_hashes(t: w.Flat) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text, hash, words)`` of every line with a word; ``t`` is lower case."""
    start, end, first = w.word_spans(t)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, w.U64), np.zeros(0, np.int64)
    ls, _, _ = w.line_spans(t)
    line = np.searchsorted(ls, start, side="right") - 1
    # A line start can equal the next text's (empty lines): the word's own text decides.
    new = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]]))
    edges = np.append(new, len(start))
    place = (np.arange(len(start)) - np.repeat(new, np.diff(edges))).astype(w.U64)
    with np.errstate(over="ignore"):
        each = w.keyed(w.hash_spans(t.buf, start, end) ^ w.mix(place), 1)
        h = w.mix(np.add.reduceat(each, new))
    return w.owners(first)[new], h, np.diff(edges)


def _distinct(text: np.ndarray, line: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each line once per text, with the words of all its copies there."""
    order = np.lexsort((line, text))
    text, line, words = text[order], line[order], words[order]
    if not len(text):
        return text, line, words
    new = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (line[1:] != line[:-1])]))
    return text[new], line[new], np.add.reduceat(words, new)


def _measure(batches: Batches) -> Batches:
    for b in batches:
        text = b.column("text")
        for (i, j, t), (_, _, low) in zip(w.runs(text), _lower_runs(text), strict=True):
            start, end, first = w.word_spans(t)
            points = w.code_points(t)
            own = w.owners(first).astype(w.U64)
            words = w.hash_spans(t.buf, start, end)
            h, pos = w.ngram_hashes(words, first, 3)
            with np.errstate(over="ignore"):
                twice = pos[w.repeated(w.mix(h + w.keyed(own[pos], 2)))] if len(pos) else pos
            covered = np.zeros(len(words), dtype=np.int64)
            for k in range(3):
                covered[twice + k] = 1
            ls, le, lt = w.line_spans(t)
            full = np.searchsorted(start, le) > np.searchsorted(start, ls)
            ls, le, lt = ls[full], le[full], lt[full]
            with np.errstate(over="ignore"):
                dup = w.later_copies(w.mix(w.hash_spans(t.buf, ls, le) + w.keyed(lt.astype(w.U64), 3)))
            symbols = np.zeros(len(t.buf) - 7, dtype=np.int64)
            np.cumsum(_SYMBOLS[t.buf[:-8]], out=symbols[1:])
            text_no, line, n = _distinct(*line_hashes(low))
            begin = np.searchsorted(text_no, np.arange(t.n + 1))
            lines = pa.ListArray.from_arrays(
                pa.array(begin, pa.int32()),
                pa.StructArray.from_arrays([pa.array(line.view(np.int64)), pa.array(n, pa.int32())], ["line", "words"]),
            )
            out = [
                *[b.column(c).slice(i, j - i) for c in ("doc_id", "host", "tkey")],
                pa.array(np.diff(first)),
                pa.array(w.segment_sums(points[end] - points[start], first)),
                pa.array(symbols[t.off[1:]] - symbols[t.off[:-1]]),
                pa.array(np.bincount(lt[dup], minlength=t.n)),
                pa.array(w.segment_sums(covered, first)),
                lines,
            ]
            names = ["doc_id", "host", "tkey", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines"]
            yield pa.RecordBatch.from_arrays(out, names)


def _lower_runs(text: pa.Array):
    """The runs of ``w.runs(text)`` again, in lower case (bytes may differ in
    number, so the runs are cut by the original)."""
    low = pc.utf8_lower(pc.fill_null(text.cast(pa.large_string()), ""))
    for i, j, _ in w.runs(text):
        for _, _, t in w.runs(low.slice(i, j - i), run_bytes=1 << 62):
            yield i, j, t


def measured(docs: DataFrame, doc_id: str = "doc_id", host: str = "source", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: base figures and the hashed lines."""
    src = pick(docs, doc_id=doc_id, host=host, text=text)
    src = src.select(F.col("doc_id").cast("long"), F.col("host").cast("string"), "text", text_key(F.col("text")).alias("tkey"))
    return map_arrow(src, _measure, _SCHEMA)


def verdicts(
    docs: DataFrame,
    doc_id: str = "doc_id",
    host: str = "source",
    text: str = "text",
    min_docs: int = MIN_DOCS,
    max_share: float = MAX_SHARE,
    min_left: float = MIN_LEFT,
) -> tuple[DataFrame, DataFrame]:
    """``(verdict, removed)``: a row per document with its base figures,
    ``n_removed_words``, ``base_failed`` and ``kept``; and for every (host,
    text) that loses lines their hashes, ``(r_host, r_tkey, removed,
    removed_words)``."""
    base = written(measured(docs, doc_id, host, text), "line-frequency")
    # One row per (host, text): copies of a text are one document.
    texts = base.groupBy("host", "tkey").agg(F.min("doc_id").alias("doc_id"), F.first("lines").alias("lines"))
    sizes = base.select("host", "tkey").distinct().groupBy(F.col("host").alias("s_host")).agg(F.count(F.lit(1)).alias("n_texts"))
    held = (
        texts.select("host", "doc_id", F.explode("lines.line").alias("line"))
        .groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("carrier"))
        .filter(F.col("n_docs") > F.lit(min_docs))
    )
    limit = F.greatest(F.lit(float(min_docs)), F.lit(float(max_share)) * F.col("n_texts"))
    frequent = written(
        held.join(sizes, F.col("host").eqNullSafe(F.col("s_host"))).filter(F.col("n_docs") > limit)
        .select(F.col("host").alias("f_host"), F.col("line").alias("f_line"), "carrier"),
        "frequent-lines",
    )
    each = base.select("doc_id", "host", "tkey", F.explode("lines").alias("l")).select("doc_id", "host", "tkey", "l.line", "l.words")
    # Spark broadcasts the frequent lines while they are under its threshold,
    # and else sorts and splits both sides.
    removed = written(
        each.join(frequent, F.col("host").eqNullSafe(F.col("f_host")) & (F.col("line") == F.col("f_line")))
        .groupBy("host", "tkey", "line")
        .agg(F.max("words").alias("words"), F.min("doc_id").alias("first_id"), F.min("carrier").alias("carrier"))
        .filter(~F.col("first_id").eqNullSafe(F.col("carrier")))
        .groupBy(F.col("host").alias("r_host"), F.col("tkey").alias("r_tkey"))
        .agg(F.collect_list("line").alias("removed"), F.sum("words").cast("long").alias("removed_words")),
        "removed-lines",
    )
    joined = base.drop("lines").join(
        removed.drop("removed"), (F.col("tkey") == F.col("r_tkey")) & F.col("host").eqNullSafe(F.col("r_host")), "left"
    ).withColumn("n_removed_words", F.coalesce("removed_words", F.lit(0).cast("long")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    left = (F.col("n_words") - F.col("n_removed_words")).cast("double")
    verdict = joined.withColumn("base_failed", failed).select(
        "doc_id", "host", "tkey", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "n_removed_words", "base_failed",
        (~F.col("base_failed") & (left >= F.lit(float(min_left)) * F.col("n_words"))).alias("kept"),
    )
    return verdict, removed


def _strip(batches: Batches) -> Batches:
    """Texts without their removed lines; the others unchanged."""
    for b in batches:
        text, removed = b.column("text"), b.column("removed")
        out = text.to_pylist()
        low = pc.utf8_lower(pc.fill_null(text, ""))
        for k in np.flatnonzero(np.asarray(removed.is_valid())):
            gone = set(removed[int(k)].as_py())
            lines = out[k].split("\n")
            for _, _, t in w.runs(low.slice(int(k), 1), run_bytes=1 << 62):
                # Lower case keeps "\n": the lines of both forms correspond.
                ls, le, _ = w.line_spans(t)
                ws, _, _ = w.word_spans(t)
                full = np.flatnonzero(np.searchsorted(ws, le) > np.searchsorted(ws, ls))
                _, h, _ = line_hashes(t)
                drop = {int(n) for n, x in zip(full, h.view(np.int64), strict=True) if int(x) in gone}
            out[k] = "\n".join(x for n, x in enumerate(lines) if n not in drop)
        yield pa.RecordBatch.from_arrays(
            [b.column("row"), pa.array(out, pa.string()), removed.is_valid()], ["row", "text", "changed"]
        )


def clean(docs: DataFrame, doc_id: str = "doc_id", host: str = "source", text: str = "text", **limits) -> DataFrame:
    """``docs`` without rejected documents, texts without removed lines, same
    columns; an ``n_chars`` column follows the text."""
    verdict, removed = verdicts(docs, doc_id, host, text, **limits)
    out = verdict.filter(~F.col("kept")).select("host", "tkey").distinct().withColumn("out", F.lit(True))
    change = out.join(
        removed, (F.col("tkey") == F.col("r_tkey")) & F.col("host").eqNullSafe(F.col("r_host")), "full"
    ).select(
        F.coalesce("host", "r_host").alias("c_host"), F.coalesce("tkey", "r_tkey").alias("c_tkey"), "out", "removed"
    )
    body = F.col(f"`{text}`")
    rows = docs.select(
        packed_row(docs, text), body.alias("text"), F.col(f"`{host}`").cast("string").alias("host"), text_key(body).alias("tkey")
    )
    joined = rows.join(
        change, (F.col("tkey") == F.col("c_tkey")) & F.col("host").eqNullSafe(F.col("c_host")), "left"
    ).filter(F.col("out").isNull())
    done = map_arrow(
        joined.select("row", "text", "removed"), _strip, f"row {row_type(docs, text)}, text string, changed boolean"
    )
    new = {text: F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("changed"), F.length("text")).otherwise(F.col("row.n_chars"))
    return unpacked(done, docs, new)
