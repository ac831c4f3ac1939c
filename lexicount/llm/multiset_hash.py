"""Document fingerprints by a homomorphic multiset hash (operator 4).

A text is the multiset of its paragraphs: its ``\\n``-split lines, cut after
sentence ends (a stop, of any script in ``_STOPS``, and closing quotes or
brackets, before white space; the full-width stops need none), words joined by
single spaces, so that blank paragraphs are nothing. Every paragraph is hashed
to a wide vector, and the fingerprint is the sum of the vectors modulo powers
of two:

* ``EXACT`` lanes of 32 uniform bits, added modulo 2**32, tell multisets apart;
  half of them come from one 64-bit hash of the paragraph's words and half from
  another under a key of its own (``WORD_KEYS``), so that 128 bits would have to
  agree for two paragraphs to be taken for each other;
* ``NEAR`` lanes are of the parts of paragraphs: one of more than ``PART_WORDS``
  words is cut where the words' hashes say so, a word of more than
  ``WORD_BYTES`` bytes likewise counts as several. Lanes of +1 or -1, added
  modulo 2**32, keep distances: the squared difference of two such sums is, per
  lane and on average, the number of parts (squared counts) in which the texts
  differ.

Addition is commutative, so the order of paragraphs is immaterial, and
``combine`` inserts or deletes paragraphs without the rest of the text.

Likeness of two fingerprints is ``1 - |A-B|^2 / (|A|^2 + |B|^2)`` over the
near lanes, cut to 0..1, and 1 if they are equal (also for two empty texts).

Null texts are empty and have the zero fingerprint.
"""

from __future__ import annotations

import base64
import bisect
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexicount.llm import _words as w
from lexicount.llm._spark import Batches, map_arrow, pick, ship, text_key, written

EXACT, NEAR = 16, 96
#: Keys under which the words are hashed, each for its share of the exact lanes.
WORD_KEYS = (0, 406)
_EXACT_KEYS = w.keyed(np.arange(EXACT // 2, dtype=w.U64), 401).reshape(len(WORD_KEYS), -1)
_NEAR_KEYS = w.keyed(np.arange((NEAR + 63) // 64, dtype=w.U64), 402)
#: Longer paragraphs (in words) are cut for the near lanes: after one word in
#: ``CUT`` by its hash, and where a part would have more words than that.
PART_WORDS = 32
#: Longer words (in bytes) count as several, cut at one byte in ``CUT``.
WORD_BYTES = 64
CUT = 8
_WIDE = "。！？｡"
_STOPS = ".!?…؟۔।॥։።།။។" + _WIDE
_CLOSERS = "\"')]}”’“»›」』）】》〉"
_IS_STOP, _IS_CLOSER = np.zeros(0x10001, dtype=bool), np.zeros(0x10001, dtype=bool)
_IS_STOP[[ord(c) for c in _STOPS]] = True
_IS_CLOSER[[ord(c) for c in _CLOSERS]] = True


def _last(buf: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(code point, bytes)`` of the characters before ``end``; any above
    16 bits is 0x10000."""
    b1, b2, b3 = (buf[np.maximum(end - k, 0)].astype(np.int64) for k in (1, 2, 3))
    size = np.select([b1 < 0x80, b2 >= 0xC0, b3 >= 0xE0], [1, 2, 3], 4)
    two, three = ((b2 & 0x1F) << 6) | (b1 & 0x3F), ((b3 & 0x0F) << 12) | ((b2 & 0x3F) << 6) | (b1 & 0x3F)
    return np.select([size == 1, size == 2, size == 3], [b1, two, three], 0x10000), size


def _ends_sentence(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether spans end with a stop, or with one and closers behind it."""
    end = end.copy()
    out = np.zeros(len(end), dtype=bool)
    left = np.arange(len(end))
    while len(left):
        cp, size = _last(buf, end[left])
        out[left[_IS_STOP[cp]]] = True
        on = _IS_CLOSER[cp] & (end[left] - size > start[left])
        end[left] -= size
        left = left[on]
    return out


def _wide_ends(t: w.Flat) -> np.ndarray:
    """Places behind full-width stops and the stops and closers that follow."""
    size = int(t.off[-1])
    at = np.flatnonzero((t.buf[:size] == 0xE3) | (t.buf[:size] == 0xEF)) + 3
    at = at[at <= size]
    cp, _ = _last(t.buf, at)
    at = at[np.isin(cp, [ord(c) for c in _WIDE])]
    # A place is moved behind what closes the sentence, character by character.
    done, left = [], at
    while len(left):
        lead = t.buf[left]
        nxt = left + np.select([lead < 0x80, lead < 0xE0, lead < 0xF0], [1, 2, 3], 4)
        inside = nxt <= size
        cp, _ = _last(t.buf, np.minimum(nxt, size))
        on = inside & (_IS_STOP[cp] | _IS_CLOSER[cp])
        done.append(left[~on])
        left = nxt[on]
    return np.unique(np.concatenate(done)) if done else at


def _cut(start: np.ndarray, end: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans, cut at those places that are inside of one."""
    if not len(at) or not len(start):
        return start, end
    k = np.searchsorted(start, at, side="left") - 1
    at = at[(k >= 0) & (at < end[np.maximum(k, 0)])]
    return np.sort(np.concatenate([start, at])), np.sort(np.concatenate([end, at]))


def _stepped(first: np.ndarray, count: np.ndarray, step: int) -> np.ndarray:
    """``first + step``, ``first + 2 * step`` ... below ``first + count``."""
    n = np.maximum(count - 1, 0) // step
    return np.repeat(first, n) + step * (w.spread(np.zeros(len(n), np.int64), n) + 1)


def _hashed(words: np.ndarray, head: np.ndarray) -> np.ndarray:
    """The hash of every run of words that starts at a head."""
    place = np.arange(len(words)) - np.repeat(head, np.diff(np.append(head, len(words))))
    with np.errstate(over="ignore"):
        each = w.keyed(words ^ w.mix(place.astype(w.U64)), 403)
        return w.mix(np.add.reduceat(each, head))


def _pieces(t: w.Flat, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words, the long ones cut: at a byte if the eight before it say so,
    and where a piece would still be too long."""
    long = np.flatnonzero(end - start > WORD_BYTES)
    if not len(long):
        return start, end
    at = w.spread(start[long] + 8, end[long] - start[long] - 8)
    view = np.ndarray((len(t.buf) - 7,), dtype="<u8", buffer=t.buf, strides=(1,))
    start, end = _cut(start, end, at[w.keyed(view[at - 8], 404) % w.U64(CUT) == 0])
    return _cut(start, end, _stepped(start, end - start, WORD_BYTES))


def paragraphs(t: w.Flat) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """``(hashes, text)`` of every paragraph, a column for each of the keys,
    and ``(hash, text)`` of every part of one, repeats included."""
    start, end, _ = w.word_spans(t)
    if not len(start):
        none = np.zeros(0, np.int64)
        return (np.zeros((0, len(WORD_KEYS)), w.U64), none), (np.zeros(0, w.U64), none)
    start, end = _cut(start, end, _wide_ends(t))
    owner = np.searchsorted(t.off, start, side="right") - 1
    # A paragraph starts at a text's first word, after a line break, after a stop.
    breaks = np.cumsum(t.buf[: int(t.off[-1])] == 10)
    gap = breaks[start[1:]] != breaks[end[:-1] - 1]
    stop = _ends_sentence(t.buf, start[:-1], end[:-1])
    head = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | gap | stop]))
    under = w.hashes_of_spans(t.buf, start, end, WORD_KEYS)
    words = under[0]
    whole = np.stack([_hashed(x, head) for x in under], axis=1), owner[head]
    ps, pe = _pieces(t, start, end)
    if len(ps) > len(start):
        head, owner = np.searchsorted(ps, start[head]), np.searchsorted(t.off, ps, side="right") - 1
        words = w.hash_spans(t.buf, ps, pe)
    count = np.diff(np.append(head, len(words)))
    if (count <= PART_WORDS).all():
        return whole, (whole[0][:, 0] if words is under[0] else _hashed(words, head), owner[head])
    ends = (w.keyed(words, 405) % w.U64(CUT) == 0) & np.repeat(count > PART_WORDS, count)
    part = np.union1d(head, np.flatnonzero(ends[:-1]) + 1)
    part = np.union1d(part, _stepped(part, np.diff(np.append(part, len(words))), PART_WORDS))
    return whole, (_hashed(words, part), owner[part])


def wide(h: np.ndarray) -> np.ndarray:
    """``(n, EXACT)`` uint32 lanes of paragraphs, each group of lanes from the
    hash under its own key."""
    return w.mix(h[:, :, None] ^ _EXACT_KEYS[None]).reshape(len(h), EXACT // 2).view(np.uint32)


def signs(h: np.ndarray) -> np.ndarray:
    """``(n, NEAR)`` int8 lanes of part hashes."""
    bits = w.mix(h[:, None] ^ _NEAR_KEYS[None, :])
    return np.unpackbits(bits.view(np.uint8), axis=1)[:, :NEAR].astype(np.int8) * 2 - 1


def _added(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Rows added up per text, modulo 2**32; ``owner`` ascends."""
    out = np.zeros((n, values.shape[1]), dtype=np.uint32)
    if len(owner):
        head = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        out[owner[head]] = np.add.reduceat(values, head, axis=0, dtype=np.int64).astype(np.uint32)
    return out


def sums(whole: tuple[np.ndarray, np.ndarray], parts: tuple[np.ndarray, np.ndarray], n: int) -> np.ndarray:
    """``(n, bytes)`` fingerprints of ``n`` texts from what ``paragraphs`` gives."""
    exact, near = _added(wide(whole[0]), whole[1], n), _added(signs(parts[0]), parts[1], n)
    return np.concatenate([exact.astype("<u4").view(np.uint8), near.astype("<u4").view(np.uint8)], axis=1)


def fingerprints(texts: pa.Array) -> np.ndarray:
    """``(n, bytes)`` fingerprints of an Arrow string column."""
    out = [sums(*paragraphs(t), t.n) for _, _, t in w.runs(texts, 1 << 20)]
    return np.concatenate(out) if out else np.zeros((0, 4 * (EXACT + NEAR)), np.uint8)


def _lanes(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    fp = np.ascontiguousarray(fp)
    return fp[:, : 4 * EXACT].copy().view("<u4"), fp[:, 4 * EXACT :].copy().view("<u4")


def combine(a: np.ndarray, b: np.ndarray, sign: int = 1) -> np.ndarray:
    """Fingerprints of the united (``sign=1``) or reduced (``-1``) multisets."""
    (ea, na), (eb, nb) = _lanes(a), _lanes(b)
    with np.errstate(over="ignore"):
        e, n = (ea + eb, na + nb) if sign > 0 else (ea - eb, na - nb)
    return np.concatenate([e.astype("<u4").view(np.uint8), n.astype("<u4").view(np.uint8)], axis=1)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, 0 to 1."""
    x, y = (_lanes(v)[1].view("<i4").astype(float) for v in (a, b))
    apart, size = ((x - y) ** 2).sum(1), (x**2).sum(1) + (y**2).sum(1)
    near = np.clip(1 - apart / np.maximum(size, 1), 0.0, 1.0)
    return np.where((a == b).all(axis=1), 1.0, near)


def strings(fp: np.ndarray) -> list[str]:
    return [base64.b64encode(row.tobytes()).decode() for row in fp]


def _fingerprint(batches: Batches) -> Batches:
    for b in batches:
        cols = [c for n, c in zip(b.schema.names, b.columns, strict=True) if n != "text"]
        names = [n for n in b.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*cols, pa.array(strings(fingerprints(b.column("text"))))], [*names, "fingerprint"])


def fingerprinted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, fingerprint)`` per row of ``docs``."""
    return map_arrow(pick(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("long"), "text"), _fingerprint, "doc_id long, fingerprint string")


# -------------------------------------------------- each text and the next one
#: Ranges of documents for each shuffle partition.
RANGES = 4

_EDITED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def edit(text: str, after: str) -> str:
    """The last third of ``text`` replaced by as much of the start of ``after``."""
    k = len(text) // 3
    return text[: len(text) - k] + after[:k]


def _edited(batches: Batches) -> Batches:
    """Rows come range by range in descending order, followed by the head of
    the range after; a row that is its range's own meets the row behind it."""
    held = None
    for b in batches:
        for lo in range(0, b.num_rows, 256):
            todo = []
            for row in b.slice(lo, 256).to_pylist():
                row["text"] = row["text"] or ""
                if held is not None and held["own"] and held["range"] == row["range"]:
                    todo.append((held, row["text"]))
                held = row
            texts = [a["text"] for a, _ in todo]
            after = [n for _, n in todo]
            edits = [edit(x, n) for x, n in zip(texts, after, strict=True)]
            mine, edited, follow = (fingerprints(pa.array(v, pa.string())) for v in (texts, edits, after))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([a["doc_id"] for a, _ in todo], pa.int64()),
                    pa.array([len(x) for x in texts], pa.int64()),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edits], pa.string()),
                    pa.array(strings(mine), pa.string()),
                    pa.array(strings(edited), pa.string()),
                    pa.array(likeness(mine, edited)),
                    pa.array(likeness(mine, follow)),
                ],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )


def _order(doc_id: int | None, tkey: bytes) -> tuple[bool, int, bytes]:
    return (doc_id is not None, doc_id or 0, bytes(tkey))


def edited_likeness(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ranges: int | None = None) -> DataFrame:
    """Per document its fingerprint, that of its edited text (``edit`` with the
    next document, in descending id, the first following the last), and how
    like the two, and it and the next document, are.

    The keys, id and hash of the text, are cut into ranges by Spark, ``RANGES``
    for every shuffle partition unless ``ranges`` is given; many documents
    under one id, or without one, fill as many ranges as they need. The heads
    of the ranges, one row each, then say in which range a text belongs; the
    head's text also goes to the range before it, so each text is shuffled once
    and no range waits for another. Among equal ids the greater key of the text
    comes first; null ids come last. Rows equal in id and text stay together.
    """
    spark = docs.sparkSession
    base = pick(docs, doc_id=doc_id, text=text).select(
        F.col("doc_id").cast("long"), "text", text_key(F.col("text")).alias("tkey")
    )
    n = ranges or RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = written(base.select("doc_id", "tkey"), "edit-keys")
    dealt = keys.repartitionByRange(n, F.desc_nulls_last("doc_id"), F.desc("tkey"))
    first = F.max(F.struct("doc_id", "tkey")).alias("head")
    # As many rows as there are ranges.
    heads = [_order(*r.head) for r in dealt.groupBy(F.spark_partition_id().alias("part")).agg(first).collect()]
    heads = sorted(set(heads))  # range k begins, from above, with heads[k]
    ship(spark)

    @F.udf("array<struct<range:int,own:boolean>>", useArrow=True)
    def places(doc_id: int | None, tkey: bytes) -> list[tuple[int, bool]]:
        key = _order(doc_id, tkey)
        k = bisect.bisect_left(heads, key)
        own = [(k, True)]
        return [*own, ((k + 1) % len(heads), False)] if heads[k] == key else own

    rows = base.select(F.explode(places("doc_id", "tkey")).alias("r"), "doc_id", "tkey", "text").select(
        "r.range", "r.own", "doc_id", "tkey", "text"
    )
    sorted_rows = rows.repartition("range").sortWithinPartitions(
        "range", F.desc("own"), F.desc_nulls_last("doc_id"), F.desc("tkey")
    )
    return map_arrow(sorted_rows.drop("tkey"), _edited, _EDITED)
