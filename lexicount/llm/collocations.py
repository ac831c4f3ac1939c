"""Phrase collocations from Misra-Gries summaries (operator 12).

Texts, A-Z in lower case, are split into pieces at ``[.,;:!?\\x0A-\\x0D]`` and
those into words at blanks and tabs. Phrases of one to ``MOST_WORDS`` words are
counted per language (null: ``und``) in two passes.

The first finds every phrase that may be frequent. Phrases go to hash
partitions by a keyed hash. A task sums its texts up to ``HELD`` phrases and
hands on one summary for each partition, with the number of occurrences that
went into it. A partition adds up those numbers, its mass, and merges the
summaries under the Misra-Gries rule: of more than ``k`` counters the
``k + 1``-st largest count is taken off all, and what is left with nothing
goes. With ``k`` above mass / threshold less than the threshold is ever taken
off a phrase, so that each phrase of ``least`` occurrences survives. Phrases
are told apart by 40 bits within a partition: a collision can only add.
The number of partitions follows the bytes of the texts, so that a partition
keeps about ``COUNTERS`` counters; what a hot phrase adds to a partition's mass
raises its capacity, not the phrases in it.

The second pass counts exactly. The survivors are sent around as a filter of
hash bits, a slice for every partition and never more than ``FILTER_BYTES`` in
all (a fuller filter lets more through and stays exact); the phrases that pass
are counted by their texts, and only real counts are compared with ``least``.

A candidate (two or more words) is cut in two at every place; with counts
``l`` and ``r`` of the parts and ``a`` of its own its score is
``floor(2000000 * a / (l + r))``, the lowest cut counts. Candidates within a
longer one that has 80 % of their count go. Decimals keep all that exact.

Null and empty texts have no words; repeated rows count again; a table without
frequent phrases gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexicount.llm import _words as w
from lexicount.llm._spark import Batches, map_arrow, pick, written

LEAST, MOST_WORDS, COVERED, SCALE, TOP = 30, 4, 80, 2_000_000, 2000
UNKNOWN = "und"
#: Counters that a hash partition of ordinary mass keeps.
COUNTERS = 1 << 14
#: Bytes of text for each occurrence of a phrase, to choose the partitions by.
BYTES_EACH = 2
#: Phrases that a task holds before it hands on its summaries.
HELD = 1_000_000
#: Occurrences that are summed at once in a task.
PENDING = 500_000
#: Filter bits for each counter, and the most bytes of the whole filter.
BITS_EACH, FILTER_BYTES = 8, 1 << 26
#: Ranks are first taken in so many groups of each language.
RANK_GROUPS = 256
_RUN = 1 << 20
_U = w.U64
_KEY_BITS = 40

_BREAK = np.zeros(256, dtype=bool)
_BREAK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_SEPARATOR = _BREAK.copy()
_SEPARATOR[[0x20, 0x09]] = True


class Phrases:
    """The phrases of some texts: words, and where windows of them may start."""

    def __init__(self, t: w.Flat, lang: list[str]):
        low = t.buf.copy()
        capital = (low >= 0x41) & (low <= 0x5A)
        low[capital] += 0x20
        self.buf = low
        self.start, self.end, self.first = w.word_spans(t, _SEPARATOR)
        self.words = w.hash_spans(low, self.start, self.end)
        self.owner = w.owners(self.first)
        size = int(t.off[-1])
        breaks = np.cumsum(_BREAK[low[:size]])
        # Words of one piece have the same text and as many breaks before them.
        self.piece = breaks[self.start] if len(self.start) else self.start
        seeds = np.asarray([w.seed_of(x) for x in lang], dtype=_U)
        self.lang = seeds[self.owner] if len(self.owner) else np.zeros(0, _U)

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """``(hash with the language, first word)`` of all phrases of ``n`` words."""
        h, at = w.ngram_hashes(self.words, self.first, n, 1201)
        inside = self.piece[at] == self.piece[at + n - 1]
        at = at[inside]
        return w.mix(h[inside] ^ w.keyed(self.lang[at], n)), at

    def second(self, at: np.ndarray, n: int) -> np.ndarray:
        """Another hash of the phrases of ``n`` words at these words."""
        acc = w.keyed(self.words[at], 1203)
        for k in range(1, n):
            acc = w.mix(w.keyed(acc, 1204 + k) ^ self.words[at + k])
        return acc


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with their counts added up."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    if not len(keys):
        return keys, counts
    head = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[head], np.add.reduceat(counts, head)


class Summary:
    """A Misra-Gries summary of ``capacity`` counters."""

    def __init__(self, capacity: int):
        self.capacity, self.error = capacity, 0
        self.keys, self.counts = np.zeros(0, _U), np.zeros(0, np.int64)
        self.new: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.new.append((keys, counts))
        self.waiting += len(keys)
        if self.waiting > 4 * self.capacity:
            self.merge()

    def merge(self) -> None:
        if self.new:
            keys, counts = (np.concatenate(x) for x in zip((self.keys, self.counts), *self.new, strict=True))
            keys, counts = summed(keys, counts)
            self.new, self.waiting = [], 0
            if len(keys) > self.capacity:
                off = int(np.partition(counts, len(counts) - self.capacity - 1)[len(counts) - self.capacity - 1])
                self.error += off
                stay = counts > off
                keys, counts = keys[stay], counts[stay] - off
            self.keys, self.counts = keys, counts

    def survivors(self, least: int) -> np.ndarray:
        """Keys whose true count may be ``least``."""
        self.merge()
        return self.keys[self.counts + self.error >= least]


def counted_once(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with how often they occur; sorts in place."""
    keys.sort()
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    head = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[head], np.diff(np.append(head, len(keys)))


def _parted(h: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """``(partition, key within it)``; partitions are ranges of hashes."""
    return (((h >> _U(32)) * _U(parts)) >> _U(32)).astype(np.int64), h & _U((1 << _KEY_BITS) - 1)


def _packed(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray(keys.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, : _KEY_BITS // 8].tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    five = np.frombuffer(data, dtype=np.uint8).reshape(-1, _KEY_BITS // 8)
    out = np.zeros((len(five), 8), dtype=np.uint8)
    out[:, : _KEY_BITS // 8] = five
    return out.view("<u8").reshape(-1).astype(_U)


_SUMMARY = "part long, kind int, mass long, once binary, more binary, counts binary"


def _summaries(keys: np.ndarray, counts: np.ndarray, parts: int) -> pa.RecordBatch:
    """A header and a summary for each hash partition, of sorted keys."""
    part, key = _parted(keys, parts)
    edge = np.searchsorted(part, np.arange(parts + 1))
    rows = []
    for p in np.flatnonzero(np.diff(edge)).tolist():
        k, c = key[edge[p] : edge[p + 1]], counts[edge[p] : edge[p + 1]]
        one = c == 1
        rows.append((p, 0, int(c.sum()), None, None, None))
        rows.append((p, 1, None, _packed(k[one]), _packed(k[~one]), c[~one].astype("<i8").tobytes()))
    cols = list(zip(*rows, strict=True)) or [[]] * 6
    types = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], ["part", "kind", "mass", "once", "more", "counts"]
    )


def _runs(b: pa.RecordBatch):
    lang = b.column("lang").to_pylist()
    for i, j, t in w.runs(b.column("text"), _RUN):
        yield lang[i:j], Phrases(t, lang[i:j])


def _summarise(parts: int, most_words: int, held: int):
    def run(batches: Batches) -> Batches:
        none = (np.zeros(0, _U), np.zeros(0, np.int64))
        have, pending, n = none, [], 0

        def added() -> tuple[np.ndarray, np.ndarray]:
            if not pending:
                return have
            keys, counts = counted_once(np.concatenate(pending))
            pending.clear()
            return summed(np.concatenate([have[0], keys]), np.concatenate([have[1], counts]))

        for b in batches:
            for _, p in _runs(b):
                for k in range(1, most_words + 1):
                    pending.append(p.windows(k)[0])
                    n += len(pending[-1])
                    if n >= PENDING:
                        have, n = added(), 0
                if len(have[0]) >= held:
                    yield _summaries(*have, parts)
                    have = none
        have = added()
        if len(have[0]):
            yield _summaries(*have, parts)

    return run


def _slice_bits(key: np.ndarray, bits: int) -> np.ndarray:
    return (w.keyed(key, 1202) % _U(bits)).astype(np.int64)


def _merge(least: int, bits: int):
    """Rows come by partition, the headers first: a slice of the filter each."""

    def run(batches: Batches) -> Batches:
        part, mass, summary = None, 0, None

        def over() -> pa.RecordBatch:
            keep = np.zeros(bits, dtype=bool)
            if summary is not None:
                keep[_slice_bits(summary.survivors(least), bits)] = True
                if summary.error >= least:
                    raise AssertionError("a frequent phrase may be lost")
            return pa.RecordBatch.from_arrays([pa.array([part]), pa.array([np.packbits(keep).tobytes()])], ["part", "slice"])

        for b in batches:
            cols = [b.column(c) for c in ("part", "kind", "mass", "once", "more", "counts")]
            for k in range(b.num_rows):
                p, kind, m, once, more, counts = (c[k].as_py() for c in cols)
                if p != part:
                    if part is not None:
                        yield over()
                    part, mass, summary = p, 0, None
                if kind == 0:
                    mass += m
                    continue
                if summary is None:
                    summary = Summary(mass // least + 1)
                a, z = _unpacked(once), _unpacked(more)
                summary.add(np.concatenate([a, z]), np.concatenate([np.ones(len(a), np.int64), np.frombuffer(counts, "<i8")]))
        if part is not None:
            yield over()

    return run


def _texts(p: Phrases, at: np.ndarray, n: int) -> pa.Array:
    """The phrases of ``n`` words at these words, joined by single spaces."""
    word = (at[:, None] + np.arange(n)).reshape(-1)
    size = p.end[word] - p.start[word]
    body = np.full(int(size.sum()) + len(word), 0x20, dtype=np.uint8)
    to = np.cumsum(size + 1) - size - 1
    body[w.spread(to, size)] = p.buf[w.spread(p.start[word], size)]
    # A word is followed by a space; behind the last one it is left out.
    last = np.zeros(len(word), dtype=bool)
    last[n - 1 :: n] = True
    keep = np.ones(len(body), dtype=bool)
    keep[(to + size)[last]] = False
    length = (size + ~last).reshape(-1, n).sum(1)
    off = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(off), pa.py_buffer(body[keep]))


def _counted(send, parts: int, bits: int, most_words: int):
    """Phrases that pass the filter, and under an empty one the words."""

    def run(batches: Batches) -> Batches:
        mask = np.frombuffer(send.value, dtype=np.uint8)
        wide = bits // 8
        for b in batches:
            for lang, p in _runs(b):
                names = pa.array(lang, pa.string())
                code = names.dictionary_encode()
                each = np.asarray(code.indices)
                words = np.bincount(each[p.owner], minlength=len(code.dictionary)) if len(p.owner) else np.zeros(len(code.dictionary))
                total = pa.array([""] * len(code.dictionary), pa.string())
                yield pa.RecordBatch.from_arrays([code.dictionary, total, pa.array(words.astype(np.int64))], ["lang", "phrase", "n"])
                for k in range(1, most_words + 1):
                    h, at = p.windows(k)
                    part, key = _parted(h, parts)
                    bit = _slice_bits(key, bits)
                    on = (mask[part * wide + bit // 8] >> (7 - bit % 8).astype(np.uint8)) & 1 == 1
                    if not on.any():
                        continue
                    h, at = h[on], at[on]
                    # Equal under two hashes of 64 bits.
                    second = p.second(at, k)
                    order = np.lexsort((second, h))
                    h, at, second = h[order], at[order], second[order]
                    head = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (second[1:] != second[:-1])]))
                    count = np.diff(np.append(head, len(h)))
                    one = at[head]
                    yield pa.RecordBatch.from_arrays(
                        [names.take(pa.array(p.owner[one])), _texts(p, one, k).cast(pa.string()), pa.array(count)], ["lang", "phrase", "n"]
                    )

    return run


def frequent_phrases(
    docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, most_words: int = MOST_WORDS,
    counters: int = COUNTERS, held: int = HELD, filter_bytes: int = FILTER_BYTES,
) -> DataFrame:
    """``(lang, phrase, n)`` of every phrase of ``least`` occurrences; under the
    empty phrase the number of all words of the language."""
    body = F.col("text").cast("string")
    src = pick(docs, lang=lang, text=text).select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), body.alias("text"))
    size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 + size // BYTES_EACH // (least * counters)
    bits = max(8, min(BITS_EACH * counters, 8 * filter_bytes // parts) // 8 * 8)
    local = map_arrow(src, _summarise(parts, most_words, held), _SUMMARY)
    dealt = local.repartition("part").sortWithinPartitions("part", "kind")
    slices = map_arrow(dealt, _merge(least, bits), "part long, slice binary").toArrow()
    # At most filter_bytes, or a byte for every partition.
    mask = np.zeros((parts, bits // 8), dtype=np.uint8)
    for p, x in zip(slices["part"].to_pylist(), slices["slice"].to_pylist(), strict=True):
        mask[p] = np.frombuffer(x, dtype=np.uint8)
    send = docs.sparkSession.sparkContext.broadcast(mask.tobytes())
    del slices, mask
    found = map_arrow(src, _counted(send, parts, bits, most_words), "lang string, phrase string, n long")
    total = found.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    return total.filter((F.col("n") >= least) | (F.col("phrase") == ""))


def _exact(column: str | Column) -> Column:
    return F.col(column).cast("decimal(19,0)") if isinstance(column, str) else column.cast("decimal(19,0)")


def _sub(words: Column, start: Column, size: Column) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def scored(phrases: DataFrame) -> DataFrame:
    """``(lang, phrase, a, l, r, score)`` of the candidates among all frequent
    phrases, by their lowest cut, without those that a longer one covers."""
    words = F.split("phrase", " ", -1)
    several = phrases.withColumn("words", words).withColumn("size", F.size("words")).filter("size > 1")
    cuts = several.select("lang", "phrase", F.col("n").alias("a"), "words", "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k", _sub(F.col("words"), F.lit(1), F.col("k")).alias("head"),
        _sub(F.col("words"), F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"),
    )
    one = phrases.select(F.col("lang").alias("lang1"), F.col("phrase").alias("phrase1"), F.col("n").alias("l"))
    two = phrases.select(F.col("lang").alias("lang2"), F.col("phrase").alias("phrase2"), F.col("n").alias("r"))
    both = cuts.join(one, (F.col("lang") == F.col("lang1")) & (F.col("head") == F.col("phrase1"))).join(
        two, (F.col("lang") == F.col("lang2")) & (F.col("rest") == F.col("phrase2"))
    )
    score = F.expr(f"CAST(a AS DECIMAL(19,0)) * CAST({SCALE} AS DECIMAL(7,0)) DIV (CAST(l AS DECIMAL(19,0)) + CAST(r AS DECIMAL(19,0)))")
    lowest = both.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    spans = F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("size") - 1),
        lambda n: F.transform(F.sequence(F.lit(1), F.col("size") - n + 1), lambda i: _sub(F.col("words"), i, n)),
    ))
    within = several.filter("size > 2").select(F.col("lang").alias("w_lang"), "n", F.explode(spans).alias("w_phrase"))
    cover = within.groupBy("w_lang", "w_phrase").agg(F.max("n").alias("cover"))
    left = lowest.join(cover, (F.col("lang") == F.col("w_lang")) & (F.col("phrase") == F.col("w_phrase")), "left")
    covered = _exact("cover") * 100 >= _exact("a") * COVERED
    return left.filter(~F.coalesce(covered, F.lit(False))).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", top: int = TOP, **options) -> DataFrame:
    """The ``top`` phrases of every language by score, count and text: ``(lang,
    rank, phrase, a, l, r, n, score)``."""
    phrases = written(frequent_phrases(docs, lang, text, **options), "phrases")
    best = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    # First within a group by the phrase's hash, then among what the groups keep.
    group = F.pmod(F.xxhash64("phrase"), F.lit(RANK_GROUPS))
    part = scored(phrases).withColumn("group", group)
    part = part.withColumn("place", F.row_number().over(Window.partitionBy("lang", "group").orderBy(*best))).filter(F.col("place") <= top)
    ranked = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).filter(F.col("rank") <= top)
    words = phrases.filter("phrase = ''").select(F.col("lang").alias("n_lang"), F.col("n"))
    return ranked.join(words, F.col("lang") == F.col("n_lang")).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
