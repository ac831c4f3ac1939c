"""Best-fit packing of documents by length patterns (operator 3).

Pieces of at most ``size`` tokens are packed into sequences of ``size``. Only
the histogram of lengths is planned: patterns of one to three lengths that
fill a sequence are enumerated, their repeat counts are fitted to the
histogram by non-negative least squares (projected accelerated gradient),
rounded down within the supply and raised greedily where all lengths are
still there; what is left is packed by best fit, decreasing, in whole groups
of equal sequences. The plan's size is bounded by ``size``, whatever the
number of documents.

Every piece is then given a place by its rank among pieces of its length.
Ranks are dealt without gathering a length in one task: pieces are hashed to
``buckets``, counted by (bucket, length), the counts summed up over buckets,
and a piece's rank is its bucket's start plus its rank within the bucket.
"""

from __future__ import annotations

import base64
import functools
import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexicount.llm._spark import Batches, map_arrow, pick, written

SIZE = 2048
VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
BUCKETS = 1024
ITERATIONS = 150


# ------------------------------------------------------------------- lengths
def patterns(lengths: np.ndarray, size: int) -> np.ndarray:
    """``(p, 3)`` lengths a >= b >= c (0: none) whose sum is ``size``, or which
    no further length present would fit to, for sums short of it."""
    have = np.zeros(size + 1, dtype=bool)
    have[lengths] = True
    least = int(lengths.min())
    a = lengths.astype(np.int32)
    rows = [np.stack([a, 0 * a, 0 * a], 1)[(a == size) | (a + least > size)]]
    x, y = np.meshgrid(a, a, indexing="ij")
    two = np.stack([x[x >= y], y[x >= y]], 1)
    total = two.sum(1)
    fits = total <= size
    two, total = two[fits], total[fits]
    done = (total == size) | (total + least > size)
    rows.append(np.column_stack([two[done], np.zeros(done.sum(), two.dtype)]))
    third = size - total
    ok = (third >= 1) & (third <= two[:, 1])
    ok &= have[np.clip(third, 0, size)]
    rows.append(np.column_stack([two[ok], third[ok]]))
    return np.concatenate(rows).astype(np.int64)


def fit(pats: np.ndarray, supply: np.ndarray, iterations: int = ITERATIONS) -> np.ndarray:
    """Repeat counts >= 0 of the patterns that minimise the squared distance
    to the histogram ``supply`` (index: length)."""
    k = len(pats)
    used = (pats > 0).astype(float)

    def lay(x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(supply))
        for c in range(pats.shape[1]):
            out += np.bincount(pats[:, c], weights=x * used[:, c], minlength=len(supply))
        return out

    def back(r: np.ndarray) -> np.ndarray:
        return sum(r[pats[:, c]] * used[:, c] for c in range(pats.shape[1]))

    v = np.ones(k)
    for _ in range(8):  # the largest eigenvalue, for the step
        v = back(lay(v))
        top = np.linalg.norm(v)
        v /= max(top, 1e-300)
    step = 1.0 / max(top * 1.05, 1e-9)
    x = y = np.zeros(k)
    t = 1.0
    for _ in range(iterations):
        z = np.maximum(0.0, y - step * back(lay(y) - supply))
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = z + (t - 1) / t2 * (z - x)
        x, t = z, t2
    return x


def plan(histogram: np.ndarray, size: int = SIZE) -> list[tuple[tuple[int, ...], int]]:
    """``(lengths of a sequence, repeats)`` that use up ``histogram`` exactly
    (``histogram[n]`` pieces of ``n`` tokens, 1 <= n <= size)."""
    left = histogram.astype(np.int64).copy()
    out: list[tuple[tuple[int, ...], int]] = []
    present = np.flatnonzero(left)
    if len(present):
        pats = patterns(present, size)
        x = fit(pats, left.astype(float))
        order = np.argsort(-x, kind="stable")
        # Rounded down first, then raised by one, both within the supply.
        for raised in (0, 1):
            for k in order:
                want = int(x[k]) if not raised else int(x[k] - int(x[k]) > 0.05)
                if not want:
                    if not raised and x[k] < 1:
                        break
                    continue
                p = pats[k][pats[k] > 0]
                need = np.bincount(p, minlength=len(left))
                some = np.flatnonzero(need)
                n = min(want, int((left[some] // need[some]).min()))
                if n > 0:
                    left[some] -= n * need[some]
                    out.append((tuple(int(v) for v in p), n))
    return out + best_fit(left, size)


def best_fit(left: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on a histogram: the longest piece opens a sequence,
    the longest that fits follows, again and again; equal sequences at once."""
    left = left.copy()
    out = []
    while True:
        have = np.flatnonzero(left)
        if not len(have):
            return out
        seq, room, need = [], size, {}
        while room:
            top = int(np.searchsorted(have, room, side="right")) - 1
            while top >= 0 and left[have[top]] <= need.get(int(have[top]), 0):
                top -= 1
            if top < 0:
                break
            v = int(have[top])
            seq.append(v)
            need[v] = need.get(v, 0) + 1
            room -= v
        n = min(int(left[v]) // c for v, c in need.items())
        for v, c in need.items():
            left[v] -= n * c
        out.append((tuple(seq), n))


def places(planned: list[tuple[tuple[int, ...], int]], size: int) -> tuple[np.ndarray, ...]:
    """The plan by length: ``(start, rank, sequence, offset)``, where intervals
    ``start[n]:start[n+1]`` are those of length ``n``, each beginning at a rank."""
    length, count, first, offset = [], [], [], []
    seq = 0
    for lengths, n in planned:
        at = 0
        for v in lengths:
            length.append(v)
            count.append(n)
            first.append(seq)
            offset.append(at)
            at += v
        seq += n
    length, count, first, offset = (np.asarray(v, dtype=np.int64) for v in (length, count, first, offset))
    order = np.argsort(length, kind="stable")
    length, count, first, offset = length[order], count[order], first[order], offset[order]
    start = np.searchsorted(length, np.arange(size + 2))
    upto = np.concatenate([[0], np.cumsum(count)])
    rank = upto[:-1] - upto[start[length]] if len(length) else upto[:-1]
    return start, rank, first, offset


def _place(spots: tuple[np.ndarray, ...]):
    start, rank, first, offset = spots

    def run(batches: Batches) -> Batches:
        for b in batches:
            n = b.column("length").to_numpy()
            r = b.column("rank").to_numpy()
            out = np.empty(len(n), dtype=np.int64)
            for v in np.unique(n):
                mine = n == v
                lo, hi = start[v], start[v + 1]
                out[mine] = lo + np.searchsorted(rank[lo:hi], r[mine], side="right") - 1
            cols = [c for i, c in enumerate(b.columns) if b.schema.names[i] not in ("rank", "bucket")]
            names = [c for c in b.schema.names if c not in ("rank", "bucket")]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(first[out] + r - rank[out]), pa.array(offset[out])], [*names, "sequence_id", "offset"]
            )

    return run


def pack(pieces: DataFrame, size: int = SIZE, buckets: int = BUCKETS) -> DataFrame:
    """``pieces`` (with a ``length`` of 1 to ``size``) and their ``sequence_id``
    and ``offset``. Equal rows stand for as many pieces."""
    if {"bucket", "rank", "sequence_id", "offset"} & set(pieces.columns):
        raise ValueError("pieces may not have columns bucket, rank, sequence_id or offset")
    pieces = written(
        pieces.withColumn("bucket", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in pieces.columns]), F.lit(buckets)).cast("int")),
        "pieces",
    )
    counts = pieces.groupBy("bucket", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = written(counts, "piece-counts")
    # At most ``size`` rows reach the driver: the histogram of lengths.
    hist = np.zeros(size + 1, dtype=np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():
        if not 1 <= row["length"] <= size:
            raise ValueError(f"a piece of {row['length']} tokens; they must have 1 to {size}")
        hist[row["length"]] = row["n"]
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("bucket").alias("s_bucket"), F.col("length").alias("s_length"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin")
    )
    keys = [c for c in pieces.columns if c not in ("bucket", "length")]
    within = Window.partitionBy("bucket", "length").orderBy(*[F.col(f"`{c}`") for c in keys])
    ranked = (
        pieces.withColumn("nth", F.row_number().over(within))
        .join(starts, (F.col("bucket") == F.col("s_bucket")) & (F.col("length") == F.col("s_length")))
        .withColumn("rank", F.col("begin") + F.col("nth") - 1)
        .select(*[F.col(f"`{c}`") for c in pieces.columns], F.col("rank").cast("long"))
    )
    fields = ", ".join(f"`{c}` {pieces.schema[c].dataType.simpleString()}" for c in pieces.columns if c != "bucket")
    return map_arrow(ranked, _place(places(plan(hist, size), size)), f"{fields}, sequence_id long, offset long")


# -------------------------------------------------------------------- tokens
#: Two white-space characters in a row: only there does the look-ahead of the
#: vocabulary's pattern matter.
_RUNS = "[\\s\\x{0B}\\x{1C}-\\x{1F}\\x{85}\\p{Z}]{2}"


@functools.lru_cache(maxsize=4)
def encoder(vocabulary: str):
    """``texts -> arrays of ids``, as ``tokenizers`` gives them without special
    tokens added. The same merges run in ``tiktoken`` (several times faster),
    whose ids are the same; only texts with the special token's string go
    through ``tokenizers`` itself."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    path = public_tokenizers.path(vocabulary)
    whole = Tokenizer.from_file(path)
    special = [t.content for t in whole.get_added_tokens_decoder().values()]
    with open(os.path.splitext(path)[0] + ".tiktoken", "rb") as f:
        ranks = {base64.b64decode(a): int(n) for a, n in map(bytes.split, f)}
    pattern = public_tokenizers.PATTERN
    make = lambda name, pat: tiktoken.Encoding(name, pat_str=pat, mergeable_ranks=ranks, special_tokens={})
    full = make("full", pattern)
    plain = make("plain", pattern.replace("|\\s+(?!\\S)", ""))

    def encode(texts: pa.Array) -> list[np.ndarray]:
        spaced = pc.match_substring_regex(texts, _RUNS).to_pylist()
        out = []
        for text, wide in zip(texts.to_pylist(), spaced, strict=True):
            if any(s in text for s in special):
                out.append(np.asarray(whole.encode(text, add_special_tokens=False).ids, dtype="<u4"))
            else:
                out.append((full if wide else plain).encode_to_numpy(text, disallowed_special=()))
        return out

    return encode


def cut(ids: np.ndarray, size: int) -> list[tuple[int, np.ndarray]]:
    """``(start, ids)`` of the pieces: whole if short enough, else pieces of
    ``size``, the first one shorter where need be."""
    if len(ids) <= size:
        return [(0, ids)]
    at = len(ids) % size
    cuts = [0, *range(at or size, len(ids), size)]
    return [(a, ids[a:b]) for a, b in zip(cuts, [*cuts[1:], len(ids)], strict=True)]


def _pieces(vocabulary: str, size: int, end_id: int, with_ids: bool):
    def run(batches: Batches) -> Batches:
        encode = encoder(vocabulary)
        for b in batches:
            for lo in range(0, b.num_rows, 64):
                part = b.slice(lo, 64)
                texts = pc.fill_null(part.column("text"), "")
                doc, no, start, length, crc, body = [], [], [], [], [], []
                for k, ids in enumerate(encode(texts)):
                    ids = np.append(ids, end_id).astype("<u4")
                    for i, (at, piece) in enumerate(cut(ids, size)):
                        doc.append(k)
                        no.append(i)
                        start.append(at)
                        length.append(len(piece))
                        crc.append(zlib.crc32(piece.tobytes()))
                        if with_ids:
                            body.append(piece.astype(np.int32))
                cols = [part.column("doc_id").take(pa.array(doc, pa.int64())), pa.array(no, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array(body, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    return run


def pieces(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE,
    vocabulary: str = VOCABULARY, end_id: int = END_ID, with_ids: bool = False,
) -> DataFrame:
    """One row per piece of every document: ``(doc_id, piece, start,
    length, ids_crc32[, ids])``. A null text is empty: the end id alone."""
    src = pick(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("long"), "text")
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return map_arrow(src, _pieces(vocabulary, size, end_id, with_ids), schema)


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, n_tokens, ids)`` of packed pieces that carry ``ids``: at
    most ``size`` tokens are gathered for a sequence."""
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"),
    )


def packed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, **options) -> DataFrame:
    """Every document's pieces and their places."""
    return pack(pieces(docs, doc_id, text, size, **options), size)
