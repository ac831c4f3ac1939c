"""Near-duplicate classes by BagMinHash (operator 2).

A text is the multiset of its five-word shingles (lower case; a shorter text
is one shingle of all its words). Shingle ``d`` with weight ``w`` (its count)
owns a Poisson process on ``[0, w) x time``: weights are discretised at the
integers and their range is split hierarchically into the dyadic blocks
``[0,1) [1,2) [2,4) [4,8) ...``. A block of width ``v`` yields points at rate
``v`` whose times, levels and registers come from keyed hashes of (shingle,
block, number); in the block that holds ``w`` only points of a level below
``w`` count (thinning, which splits the process further). Register ``k``
holds the earliest point that fell on it, so two signatures agree there with
probability sum(min)/sum(max), the weighted Jaccard similarity. Points are
made for a time window that is doubled until every register is filled, so a
long text makes few points per shingle.

Signatures are cut into bands; texts that share a band are candidates unless
their sizes, or their sketches (four bits of every register), put them below
the similarity, the latter by ``MARGIN`` standard errors; every candidate is
verified by the exact multiset overlap of its shingles. Classes are the
connected components of the verified links.

No pair of texts is ever a row. A band bucket is dealt into blocks of at most
about ``BLOCK`` texts and ``BLOCK_SHINGLES`` shingles; a block, or two, is
compared in one task, first by sketch, which gives the texts that may have a
partner in another class, then those by their bags of shingles, as products of
(text, shingle) matrices. Of the links that hold a task returns as many as join
its classes. The blocks of the first ``FIRST_BANDS`` bands are joined before
those of the others, and those before pairs of blocks, so that texts that share
a class by then are not compared: a bucket with thousands of near copies costs
little, and no verified link is given up. What is left grows with the square of
the texts of one bucket that are near the similarity but in no common class:
their number of comparisons does, not their rows or the memory they take.

Texts without words are equal to each other only if their bytes are; null
counts as empty. Exact copies are one text before anything is compared.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexicount.llm import _blocks
from lexicount.llm import _words as w
from lexicount.llm._spark import Batches, map_arrow, packed_row, pick, text_key, unpacked, written

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 25, 5
#: Bands whose buckets are looked at first.
FIRST_BANDS = 3
#: Texts and shingles of a block, about.
BLOCK, BLOCK_SHINGLES = 4096, 1 << 22
#: Standard errors by which a sketch may fall short of the similarity.
MARGIN = 4.0
_U = w.U64


def shingles(t: w.Flat, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """``(hash, text)`` of every shingle of lower-case texts, repeats included."""
    start, end, first = w.word_spans(t)
    words = w.hash_spans(t.buf, start, end)
    h, pos = w.ngram_hashes(words, first, n, key=5)
    owner = w.owners(first)[pos] if len(pos) else pos
    size = np.diff(first)
    few = np.flatnonzero((size > 0) & (size < n))
    if len(few):
        acc = w.keyed(size[few].astype(_U), 6)
        for k in range(n - 1):
            has = size[few] > k
            acc[has] = w.mix(acc[has] ^ w.keyed(words[first[few[has]] + k], 7 + k))
        h, owner = np.concatenate([h, acc]), np.concatenate([owner, few])
    return h, owner


def bags(h: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(hash, text, weight)``, sorted by text and hash."""
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    if not len(h):
        return h, owner, np.zeros(0, np.int64)
    new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])]))
    return h[new], owner[new], np.diff(np.append(new, len(h)))


def _unit(x: np.ndarray) -> np.ndarray:
    """Uniform in (0, 1)."""
    return ((x >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53


def signatures(h: np.ndarray, owner: np.ndarray, weight: np.ndarray, n: int, m: int) -> np.ndarray:
    """``(n, m)`` registers, uint64: a hash of the earliest point on each; 0 rows
    for texts without shingles."""
    sig = np.zeros((n, m), dtype=np.uint64)
    total = np.bincount(owner, weights=weight, minlength=n)
    # Blocks of every shingle: (shingles, number, lowest level, width).
    parts = []
    lo, width, b = 0, 1, 0
    live = np.arange(len(h))
    while len(live):
        parts.append((live, b, lo, width))
        lo, b = lo + width, b + 1
        width = lo
        live = live[weight[live] > lo]
    item = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
    block = np.concatenate([np.full(len(p[0]), p[1]) for p in parts]) if parts else item
    low = np.concatenate([np.full(len(p[0]), p[2]) for p in parts]) if parts else item
    wide = np.concatenate([np.full(len(p[0]), p[3]) for p in parts]) if parts else item
    if not len(item):
        return sig
    text, most = owner[item], weight[item]
    state = w.keyed(h[item] ^ w.mix(block.astype(_U)), 11)
    clock = -np.log(_unit(w.keyed(state, 12))) / wide
    step = np.zeros(len(item), dtype=np.uint64)
    best = np.full(n * m, np.inf)
    value = np.zeros(n * m, dtype=np.uint64)
    # Most signatures are full after this many points; the others go on.
    window = np.where(total > 0, (np.log(m) + 2.0) * m / np.maximum(total, 1), 0.0)
    open_text = total > 0
    active = np.arange(len(item))
    while len(active):
        # All points inside the window of the texts that are still open.
        active = active[open_text[text[active]]]
        now = active[clock[active] <= window[text[active]]]
        while len(now):
            point = w.keyed(state[now] ^ w.mix(step[now] + _U(1)), 13)
            level = low[now] + np.floor(_unit(w.keyed(point, 14)) * wide[now]).astype(np.int64)
            reg = text[now] * m + (w.keyed(point, 15) % _U(m)).astype(np.int64)
            ok = level < most[now]
            r, c, p = reg[ok], clock[now[ok]], point[ok]
            better = c < best[r]
            r, c, p = r[better], c[better], p[better]
            if len(r):
                order = np.lexsort((c, r))
                r, c, p = r[order], c[order], p[order]
                head = np.concatenate([[True], r[1:] != r[:-1]])
                best[r[head]], value[r[head]] = c[head], p[head]
            step[now] += _U(1)
            gap = -np.log(_unit(w.keyed(state[now] ^ w.mix(step[now] + _U(1)), 16))) / wide[now]
            clock[now] += gap
            now = now[clock[now] <= window[text[now]]]
        full = np.isfinite(best.reshape(n, m)).all(axis=1)
        open_text &= ~full
        if not open_text.any():
            break
        window[open_text] *= 2.0
    sig[:] = value.reshape(n, m)
    return sig


def sketches(sig: np.ndarray) -> np.ndarray:
    """``(n, words)`` int64: four bits of every register, sixteen to a word."""
    n, m = sig.shape
    bits = np.zeros((n, -(-m // 16) * 16), dtype=np.uint8)
    bits[:, :m] = (w.keyed(sig, 18) & _U(15)).astype(np.uint8)
    return np.ascontiguousarray(bits[:, ::2] | (bits[:, 1::2] << 4)).view("<i8")


def most_unequal(similarity: float, m: int, bits: int = 4) -> int:
    """Registers of ``m`` that may differ in the sketches of similar texts."""
    p = similarity + (1 - similarity) / 2**bits
    return int(m * (1 - p) + MARGIN * math.sqrt(m * p * (1 - p)))


def _bags(batches: Batches) -> Batches:
    """Every text's shingles, the ``k``-th repeat of one an element of its own."""
    for b in batches:
        low = pc.utf8_lower(pc.fill_null(b.column("text").cast(pa.large_string()), ""))
        for i, j, t in w.runs(low, run_bytes=1 << 20):
            h, owner, weight = bags(*shingles(t))
            again = w.spread(np.zeros(len(h), np.int64), weight).astype(_U)
            token = w.mix(np.repeat(h, weight) ^ w.keyed(again, 20))
            total = np.bincount(owner, weights=weight, minlength=t.n).astype(np.int64)
            off = np.concatenate([[0], np.cumsum(total)])
            raw = token.astype("<u8").tobytes()
            yield pa.RecordBatch.from_arrays(
                [b.column("id").slice(i, j - i), pa.array([raw[8 * off[k] : 8 * off[k + 1]] for k in range(t.n)], pa.binary())],
                ["b_id", "bag"],
            )


def _sign(bands: int, rows: int):
    def run(batches: Batches) -> Batches:
        for b in batches:
            low = pc.utf8_lower(pc.fill_null(b.column("text").cast(pa.large_string()), ""))
            for i, j, t in w.runs(low, run_bytes=1 << 20):
                h, owner, weight = bags(*shingles(t))
                sig = signatures(h, owner, weight, t.n, bands * rows)
                key = np.empty((t.n, bands), dtype=np.uint64)
                for k in range(bands):
                    acc = np.full(t.n, k, dtype=np.uint64)
                    for r in range(rows):
                        acc = w.mix(w.keyed(acc, 17) ^ sig[:, k * rows + r])
                    key[:, k] = acc
                size = np.bincount(owner, weights=weight, minlength=t.n).astype(np.int64)
                has = size > 0
                off = np.concatenate([[0], np.cumsum(np.where(has, bands, 0))])
                lists = pa.ListArray.from_arrays(
                    pa.array(off, pa.int32()), pa.array(key[has].reshape(-1).view(np.int64))
                )
                brief = sketches(sig)
                wide = pa.ListArray.from_arrays(
                    pa.array(np.arange(t.n + 1) * brief.shape[1], pa.int32()), pa.array(brief.reshape(-1))
                )
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(i, j - i), b.column("tkey").slice(i, j - i), pa.array(size), lists, wide],
                    ["doc_id", "tkey", "n_shingles", "bands", "sketch"],
                )

    return run


def _components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(id, class)``: the least id of each node's connected component.
    ``nodes`` are the ids that have edges. Star-shaped links need few rounds."""
    edges = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    edges = written(edges, "dup-edges")
    label = written(nodes.select("id", F.col("id").alias("class")), "dup-labels")
    while True:
        # Least label around, then the label of that label (pointer jumping).
        near = (
            edges.join(label, F.col("a") == F.col("id")).groupBy("b").agg(F.min("class").alias("near"))
        )
        step = label.join(near, F.col("id") == F.col("b"), "left").select(
            "id", F.col("class").alias("old"), F.least("class", F.coalesce("near", "class")).alias("new")
        )
        step = written(step, "dup-labels")
        jump = step.select(F.col("id").alias("j_id"), F.col("new").alias("jump"))
        label = step.join(jump, F.col("new") == F.col("j_id"), "left").select(
            "id", F.least("new", F.coalesce("jump", "new")).alias("class"), "old"
        )
        label = written(label, "dup-labels")
        if label.filter(F.col("class") != F.col("old")).isEmpty():
            return label.select("id", "class")
        label = label.select("id", "class")


def _joined(label: DataFrame | None, links: DataFrame) -> DataFrame | None:
    """``(id, class)`` after more links: components of the classes they join,
    so that earlier links are not walked again. None: no links so far."""
    if links.isEmpty():
        return label
    if label is not None:
        a, b = (label.select(F.col("id").alias(f"i{c}"), F.col("class").alias(f"c{c}")) for c in "ab")
        links = links.join(a, F.col("a") == F.col("ia"), "left").join(b, F.col("b") == F.col("ib"), "left").select(
            F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")
        ).filter("a <> b")
    links = written(links.distinct(), "dup-edges")
    if links.isEmpty():
        return label
    nodes = links.select(F.col("a").alias("id")).unionByName(links.select(F.col("b").alias("id"))).distinct()
    found = _components(nodes, links)
    if label is None:
        return found
    to = found.select(F.col("id").alias("from"), F.col("class").alias("to"))
    moved = label.join(to, F.col("class") == F.col("from"), "left").select("id", F.coalesce("to", "class").alias("class"))
    fresh = found.join(label.select(F.col("id").alias("known")), F.col("id") == F.col("known"), "left_anti")
    return written(moved.unionByName(fresh), "dup-labels")


def classes(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
    block: int = BLOCK,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """One row per row of ``docs``: ``(doc_id, tkey, rep_id, class_id,
    class_tkey)``. ``rep_id`` is the least id with the same text, ``class_id``
    the least id of its class and ``class_tkey`` the text that goes with it;
    null ids are never least unless all of them are null (then the class id is
    null)."""
    ids = pick(docs, doc_id=doc_id, text=text).select(
        F.col("doc_id").cast("long"), "text", text_key(F.col("text")).alias("tkey")
    )
    signed = written(map_arrow(ids, _sign(bands, rows), "doc_id long, tkey binary, n_shingles long, bands array<long>, sketch array<long>"), "bag-signatures")
    label: DataFrame | None = None
    reps = signed.groupBy("tkey").agg(
        F.min("doc_id").alias("rep_id"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"),
        F.first("sketch").alias("sketch"),
    )
    # A text stands for its copies under a number of its own, fixed by writing it.
    reps = written(reps.withColumn("id", F.monotonically_increasing_id()), "distinct-texts")
    parts = [f"s{k}" for k in range(-(-bands * rows // 16))]
    band = reps.filter(F.size("bands") > 0).select("id", "n_shingles", F.posexplode("bands").alias("band", "v"))
    band = band.select("id", "n_shingles", "band", F.xxhash64("band", "v").alias("bucket"))
    blocks = F.greatest(F.ceil(F.col("n") / F.lit(block)), F.ceil(F.col("size") / F.lit(block_shingles)))
    shared = band.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("size")).filter("n > 1").select(
        F.col("bucket").alias("s_bucket"), F.least(blocks, F.col("n")).cast("int").alias("blocks")
    )
    brief = reps.select(F.col("id").alias("b_id"), *[F.element_at("sketch", k + 1).alias(p) for k, p in enumerate(parts)])
    band = written(
        band.join(shared, F.col("bucket") == F.col("s_bucket")).join(brief, F.col("id") == F.col("b_id")).select(
            "bucket", "band", "blocks", F.pmod(F.xxhash64("id", "bucket"), "blocks").cast("int").alias("block"), "id", "n_shingles", *parts
        ),
        "shared-buckets",
    )

    # The texts of all candidates, once: by the row of the least id.
    ends = band.select(F.col("id").alias("e_id")).distinct().join(
        reps.select("id", F.col("tkey").alias("e_key"), "rep_id"), F.col("e_id") == F.col("id")
    ).select("id", "e_key", "rep_id")
    body = written(
        ids.join(ends, (F.col("tkey") == F.col("e_key")) & F.col("doc_id").eqNullSafe(F.col("rep_id")))
        .select("id", "text").dropDuplicates(["id"]),
        "candidate-texts",
    )
    key = ["bucket", "i", "j"]
    members = ", ".join(f"{c} long" for c in ("bucket", "i", "j", "side", "id", "class", "n_shingles"))

    def met(rows: DataFrame) -> DataFrame:
        return rows.repartition(*key).sortWithinPartitions(*key, "side")

    def found(now: DataFrame) -> DataFrame:
        """Links that join classes within the groups of ``now``."""
        near = _blocks.candidates(parts, similarity, most_unequal(similarity, bands * rows))
        near = written(map_arrow(met(now), near, members), "near-texts")
        texts = body.join(near.select(F.col("id").alias("n_id")).distinct(), F.col("id") == F.col("n_id"), "left_semi")
        bag = map_arrow(texts, _bags, "b_id long, bag binary")
        full = near.join(bag, F.col("id") == F.col("b_id")).select(*key, "side", "id", "class", "bag")
        return written(map_arrow(met(full), _blocks.links(similarity), "a long, b long"), "dup-links")

    # The blocks of a few bands, then of all, then the pairs of blocks.
    several = F.sequence(F.lit(0), F.col("blocks") - 1)
    for part, pairs in ((band.filter(F.col("band") < FIRST_BANDS), False), (band, False), (band.filter("blocks > 1"), True)):
        if label is None:
            now = part.withColumn("class", F.col("id"))
        else:
            named = label.select(F.col("id").alias("l_id"), "class")
            now = part.join(named, F.col("id") == F.col("l_id"), "left").withColumn("class", F.coalesce("class", "id")).drop("l_id")
        group = ["bucket"] if pairs else ["bucket", "block"]
        is_open = now.groupBy(*group).agg(F.min("class").alias("c0"), F.max("class").alias("c1")).filter("c0 <> c1").select(
            *[F.col(c).alias(f"o_{c}") for c in group]
        )
        now = now.join(is_open, [F.col(c) == F.col(f"o_{c}") for c in group], "left_semi")
        if pairs:
            now = now.withColumn("other", F.explode(several)).filter("other <> block")
            i, j, side = F.least("block", "other"), F.greatest("block", "other"), (F.col("block") > F.col("other")).cast("long")
        else:
            i, j, side = F.col("block"), F.col("block"), F.lit(0)
        where = [x.cast("long").alias(c) for x, c in zip((i, j, side), ("i", "j", "side"), strict=True)]
        label = _joined(label, found(now.select("bucket", *where, "id", "class", "n_shingles", *parts)))
    if label is None:
        label = reps.select("id", F.col("id").alias("class")).limit(0)

    member = reps.join(label.withColumnRenamed("id", "l_id"), F.col("id") == F.col("l_id"), "left").select(
        "tkey", "rep_id", F.coalesce("class", "id").alias("class")
    )
    none = F.lit(2**63 - 1)
    first = member.groupBy("class").agg(F.min(F.struct(F.coalesce("rep_id", none).alias("i"), "tkey")).alias("f")).select(
        F.col("class").alias("f_class"), F.nullif(F.col("f.i"), none).alias("class_id"), F.col("f.tkey").alias("class_tkey")
    )
    texts = member.join(first, F.col("class") == F.col("f_class")).select(
        F.col("tkey").alias("t_key"), "rep_id", "class_id", "class_tkey"
    )
    return signed.select("doc_id", "tkey").join(texts, F.col("tkey") == F.col("t_key")).select(
        "doc_id", "tkey", "rep_id", "class_id", "class_tkey"
    )


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each class: that of the least id (of repeated
    rows one, whichever comes first)."""
    found = classes(docs, doc_id, text, **options)

    def key(i: Column, t: Column) -> Column:
        return F.md5(F.concat(t, F.coalesce(i.cast("string"), F.lit("-")).cast("binary")))

    lone = found.filter((F.col("tkey") == F.col("class_tkey")) & F.col("doc_id").eqNullSafe(F.col("class_id"))).select(
        key(F.col("doc_id"), F.col("tkey")).alias("lone")
    ).distinct()
    body = F.col(f"`{text}`")
    rows = docs.select(
        packed_row(docs, text), body.alias("text"), key(F.col(f"`{doc_id}`").cast("long"), text_key(body)).alias("key")
    )
    # The join and the choice among repeated rows go by one key: one exchange.
    kept = rows.join(lone, F.col("key") == F.col("lone"), "left_semi").dropDuplicates(["key"])
    return unpacked(kept, docs, {text: F.col("text")})
