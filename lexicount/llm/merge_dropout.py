"""Seeded merge-dropout for a SentencePiece BPE vocabulary (operator 5).

The text gets the model's dummy prefix and is cut into units, each a run of
spaces and what follows up to the next space: no piece of the vocabulary has
a space behind another character, so no merge crosses units. Within a unit
the agenda is processed as usual: of all adjacent pairs whose union is a
piece, the one of the highest score (of equals the leftmost) is merged, until
none is left. Here every candidate, the pair of spans ``(start, middle, end)``
in its unit, is skipped if a hash under the seed, the text, the unit's place in
it and the spans falls below ``dropout``. So every occurrence of a word draws
anew, and again under another seed; equal texts are cut alike. ``dropout=0``
gives the library's own ids.

The agenda without dropout is run once for every distinct unit and remembered,
merge by merge. As long as none of those merges is skipped, the agenda under
dropout takes the same ones: what else is skipped was never the best. So an
occurrence draws for the remembered merges first; only where one is skipped its
agenda is run, from that merge on.

Characters without a piece become their UTF-8 bytes' pieces; so does U+2581,
which the library itself can't tell from a space. Hence decoding gives every
text back exactly.

Null texts are empty; an empty text has no ids.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexicount.llm import _words as w
from lexicount.llm._spark import Batches, map_arrow, pick

VOCABULARY = "piece_bpe_32k.model"
DROPOUT = 0.1
SEED = 20
#: Longer units (in characters) take the agenda one by one, with a heap.
LONG_UNIT = 64
#: Units whose agenda without dropout a worker keeps for later texts.
MEMO_UNITS = 200_000
_NONE = np.int64(2**62)
_SPACES = np.zeros(256, dtype=bool)
_SPACES[0x20] = True


class Pieces:
    """The vocabulary as arrays."""

    def __init__(self, vocabulary: str):
        import public_tokenizers
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(vocabulary))
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        plain = [not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)) for i in range(n)]
        ids = {p: i for i, p in enumerate(names) if plain[i]}
        if any("▁" in p.lstrip("▁") for p in ids):
            raise ValueError(f"{vocabulary}: a piece has a space behind another character")
        self.char = np.full(0x110000, -1, dtype=np.int32)
        for p, i in ids.items():
            if len(p) == 1:
                self.char[0x20 if p == "▁" else ord(p)] = i
        self.char[0x2581] = -1
        # Every way to put a piece together from two.
        order = sorted(ids.values(), key=lambda i: (-sp.get_score(i), i))
        rank, place, last = {}, -1, None
        for i in order:  # equal scores share a rank: the leftmost goes first
            if sp.get_score(i) != last:
                place, last = place + 1, sp.get_score(i)
            rank[i] = place
        keys, to, ranks = [], [], []
        for p, i in ids.items():
            for k in range(1, len(p)):
                a, b = ids.get(p[:k]), ids.get(p[k:])
                if a is not None and b is not None:
                    keys.append((a << 20) | b)
                    to.append(i)
                    ranks.append(rank[i])
        self._table(*(np.asarray(x, dtype=np.int64) for x in (keys, to, ranks)))
        self.byte = np.asarray([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], dtype=np.int32)
        bodies = [b""] * n
        for p, i in ids.items():
            bodies[i] = p.replace("▁", " ").encode()
        for b, i in enumerate(self.byte):
            bodies[i] = bytes([b])
        self.size = np.asarray([len(b) for b in bodies], dtype=np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.body = np.frombuffer(b"".join(bodies), dtype=np.uint8)
        self.memo = Plain()
        self.by_pair: dict[int, tuple[int, int]] | None = None

    def _table(self, keys: np.ndarray, to: np.ndarray, ranks: np.ndarray) -> None:
        """An open hash table of pairs: far fewer reads than a binary search."""
        size = 1 << int(4 * len(keys) - 1).bit_length()
        self.shift = w.U64(64 - size.bit_length() + 1)
        self.keys = np.full(size + 64, -1, dtype=np.int64)
        self.to, self.ranks = np.zeros(size + 64, np.int32), np.zeros(size + 64, np.int32)
        slot = self._slot(keys)
        left = np.arange(len(keys))
        self.reach = 0
        while len(left):
            free = left[self.keys[slot[left]] == -1]
            self.keys[slot[free]] = keys[free]
            won = self.keys[slot[left]] == keys[left]
            got = left[won]
            self.to[slot[got]], self.ranks[slot[got]] = to[got], ranks[got]
            left = left[~won]
            slot[left] += 1
            self.reach += 1

    def _slot(self, key: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((key.astype(w.U64) * w.U64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def pair(self, a: int, b: int) -> tuple[int, int] | None:
        """``(rank, merged id)`` of two symbols, without arrays."""
        if a < 0 or b < 0:
            return None
        if self.by_pair is None:
            used = np.flatnonzero(self.keys >= 0)
            body = zip(self.ranks[used].tolist(), self.to[used].tolist(), strict=True)
            self.by_pair = dict(zip(self.keys[used].tolist(), body, strict=True))
        return self.by_pair.get((a << 20) | b)

    def pairs(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(rank, merged id)`` of adjacent symbols; rank ``_NONE``: no piece."""
        key = np.where((a >= 0) & (b >= 0), (a << 20) | b, -2)
        slot = self._slot(key)
        found = self.keys[slot]
        for _ in range(self.reach - 1):
            on = np.flatnonzero((found != key) & (found != -1))
            if not len(on):
                break
            slot[on] += 1
            found[on] = self.keys[slot[on]]
        return np.where(found == key, self.ranks[slot], _NONE), self.to[slot].astype(np.int64)


class Plain:
    """Units with their agenda without dropout: the merges in their order and
    the ids at the end. Units are told apart by two hashes; a unit that is too
    long to remember (``LONG_UNIT``) has ``count`` -1 and no merges."""

    FIELDS = ("start", "middle", "end", "to", "span")

    def __init__(self):
        zero = np.zeros(0, np.int64)
        self.key, self.check = np.zeros(0, w.U64), np.zeros(0, w.U64)
        self.first = self.count = self.id_first = self.id_count = zero
        self.start = self.middle = self.end = np.zeros(0, np.int16)
        self.to, self.span, self.ids = np.zeros(0, np.int32), np.zeros(0, w.U64), np.zeros(0, np.int32)

    def find(self, key: np.ndarray, check: np.ndarray) -> np.ndarray:
        """Places of units, -1 for those not here; the keys are sorted."""
        if not len(self.key):
            return np.full(len(key), -1)
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where((self.key[at] == key) & (self.check[at] == check), at, -1)

    def take(self, rows: np.ndarray) -> Plain:
        """Some units, with what belongs to them."""
        out = Plain()
        out.key, out.check, out.count, out.id_count = (x[rows] for x in (self.key, self.check, self.count, self.id_count))
        some = np.maximum(out.count, 0)
        at = w.spread(self.first[rows], some)
        for name in self.FIELDS:
            setattr(out, name, getattr(self, name)[at])
        out.ids = self.ids[w.spread(self.id_first[rows], out.id_count)]
        out.first, out.id_first = np.cumsum(some) - some, np.cumsum(out.id_count) - out.id_count
        return out

    def plus(self, other: Plain) -> Plain:
        """Both, the units in the order given: their places stay."""
        out = Plain()
        out.first = np.concatenate([self.first, other.first + len(self.start)])
        out.id_first = np.concatenate([self.id_first, other.id_first + len(self.ids)])
        for name in ("key", "check", "count", "id_count", "ids", *self.FIELDS):
            setattr(out, name, np.concatenate([getattr(self, name), getattr(other, name)]))
        return out

    def sorted(self) -> Plain:
        order = np.argsort(self.key, kind="stable")
        for name in ("key", "check", "first", "count", "id_first", "id_count"):
            setattr(self, name, getattr(self, name)[order])
        return self


@functools.lru_cache(maxsize=2)
def vocabulary_of(name: str) -> Pieces:
    return Pieces(name)


def spans(start: np.ndarray, middle: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of every candidate's place in its unit."""
    return w.mix((start.astype(w.U64) << w.U64(42)) | (middle.astype(w.U64) << w.U64(21)) | end.astype(w.U64))


def least_draw(dropout: float) -> int:
    """Candidates whose 53-bit draw is below this are skipped."""
    return math.ceil(dropout * 2.0**53)


def skipped(unit: np.ndarray, span: np.ndarray, dropout: float) -> np.ndarray:
    """Whether the candidates of units (their keyed hash) are skipped."""
    if dropout <= 0:
        return np.zeros(len(span), dtype=bool)
    return w.keyed(unit ^ span, 501) >> w.U64(11) < w.U64(least_draw(dropout))


_ALL = 2**64 - 1


def _mix(x: int) -> int:
    """``_words.mix`` of one number."""
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _ALL
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & _ALL
    return x ^ (x >> 31)


_KEY = (0x9E3779B97F4A7C15 * 502) & _ALL


def agenda(v: Pieces, sym: list[int], unit: int, dropout: float) -> list[int]:
    """One unit by a heap: ids of its symbols, -1 for a character without one."""
    n = len(sym)
    sym, left, right, end = list(sym), list(range(-1, n - 1)), list(range(1, n + 1)), list(range(1, n + 1))
    alive = [True] * n
    below = least_draw(dropout)

    def offered(i: int, j: int) -> tuple[int, int, int, int, int] | None:
        got = v.pair(sym[i], sym[j])
        if got is None:
            return None
        if below:
            span = _mix(((i << 42) | (j << 21) | end[j]) & _ALL)
            if _mix(((unit ^ span) + _KEY) & _ALL) >> 11 < below:
                return None
        return (got[0], i, j, end[j], got[1])

    heap = [x for x in (offered(i, i + 1) for i in range(n - 1)) if x]
    heapq.heapify(heap)
    while heap:
        _, i, j, e, t = heapq.heappop(heap)
        if not (alive[i] and alive[j]) or right[i] != j or end[j] != e:
            continue
        sym[i], end[i], alive[j] = t, e, False
        right[i] = right[j]
        if right[j] < n:
            left[right[j]] = i
        for a in (left[i], i):
            if a >= 0 and right[a] < n and (x := offered(a, right[a])):
                heapq.heappush(heap, x)
    return [s for s, a in zip(sym, alive, strict=True) if a]


def merge_units(
    v: Pieces, sym: np.ndarray, owner: np.ndarray, start: np.ndarray, end: np.ndarray, unit: np.ndarray, dropout: float,
    history: list | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The agenda of all units at once, one merge of each per round: from
    symbols with their unit and their places in it to ``(symbols, places,
    units)``. ``history`` gets every round's merges."""
    done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    n = len(sym)
    # Symbols are linked; number n ends every unit on both sides.
    sym = np.append(sym.astype(np.int64), -1)
    owner, start, end = (np.append(x, -1).astype(np.int64) for x in (owner, start, end))
    new = owner[:n] != np.concatenate([[-2], owner[: n - 1]]) if n else np.zeros(0, bool)
    head = np.flatnonzero(new)
    nxt, prv = np.append(np.arange(1, n + 1), n), np.append(np.arange(-1, n - 1), n)
    nxt[np.append(head[1:] - 1, n - 1) if n else head], prv[head] = n, n
    key, to, alive = np.full(n + 1, _NONE), np.zeros(n + 1, np.int64), np.ones(n + 1, dtype=bool)
    alive[n] = False

    def weigh(i: np.ndarray) -> None:
        """Rank, place and result of the pairs that begin at ``i``."""
        j = nxt[i]
        r, to[i] = v.pairs(sym[i], sym[j])
        live = np.flatnonzero(r < _NONE)
        if dropout > 0 and len(live):
            a, b = i[live], j[live]
            gone = skipped(unit[owner[a]], spans(start[a], start[b], end[b]), dropout)
            r[live[gone]] = _NONE
        key[i] = np.where(r < _NONE, (r << 32) | i, _NONE)

    weigh(np.arange(n))
    units = len(head)
    while len(head):
        # Behind a unit that is done no key is left: segments may run over it.
        best = np.minimum.reduceat(key[:-1], head)
        on = best < _NONE
        head, i = head[on], best[on] & 0xFFFFFFFF
        if 2 * len(head) < units:  # what is done is set aside
            here = np.zeros(int(owner.max(initial=-1)) + 2, dtype=bool)
            here[owner[head]] = True
            keep = here[owner] & alive
            out = alive & ~keep
            done.append((sym[out], start[out], owner[out]))
            units, n = len(head), int(keep.sum())
            moved = np.full(len(keep), n)
            moved[keep] = np.arange(n)
            keep[-1] = True
            sym, owner, start, end, to, alive, key = (x[keep] for x in (sym, owner, start, end, to, alive, key))
            nxt, prv = moved[nxt[keep]], moved[prv[keep]]
            head, i = moved[head], moved[i]
            key = np.where(key < _NONE, (key >> 32 << 32) | np.arange(n + 1), _NONE)
        if not len(i):
            break
        j = nxt[i]
        if history is not None:
            history.append((owner[i], start[i], start[j], end[j], to[i]))
        sym[i], end[i], nxt[i] = to[i], end[j], nxt[j]
        prv[nxt[j]] = i
        prv[n] = n
        key[j], alive[j] = _NONE, False
        before = prv[i]
        weigh(np.concatenate([i, before[before < n]]))
    done.append((sym[alive], start[alive], owner[alive]))
    sym, start, owner = (np.concatenate(x) for x in zip(*done, strict=True))
    order = np.lexsort((start, owner))
    return sym[order], start[order], owner[order]


def _code_points(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(code point, first byte)`` of valid UTF-8."""
    at = np.flatnonzero((buf & 0xC0) != 0x80)
    b = np.concatenate([buf, np.zeros(3, np.uint8)]).astype(np.int32)
    lead = b[at]
    cp = lead.copy()
    for n, low, mask in ((2, 0xC0, 0x1F), (3, 0xE0, 0x0F), (4, 0xF0, 0x07)):
        m = np.flatnonzero(lead >= low)
        val = lead[m] & mask
        for k in range(1, n):
            val = (val << 6) | (b[at[m] + k] & 0x3F)
        cp[m] = val
    return cp, at


def encode(texts: pa.Array, seed: int = SEED, dropout: float = DROPOUT, vocabulary: str = VOCABULARY) -> list[np.ndarray]:
    """Ids of every text."""
    v = vocabulary_of(vocabulary)
    out: list[np.ndarray] = []
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    texts = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string())))
    for _, _, t in w.runs(texts, 1 << 20):
        size = int(t.off[-1])
        space = _SPACES[t.buf[:size]]
        opens = np.zeros(size, dtype=bool)
        opens[1:] = space[1:] & ~space[:-1]
        opens[t.off[:-1][np.diff(t.off) > 0]] = True
        us = np.flatnonzero(opens)
        ue = np.append(us[1:], size) if len(us) else us
        first = np.searchsorted(us, t.off)
        if not len(us):
            out += [np.zeros(0, np.int32)] * t.n
            continue
        own = w.owners(first)
        unit = None
        if dropout > 0:
            place = (np.arange(len(us)) - first[own]).astype(w.U64)
            body = w.hash_spans(t.buf, t.off[:-1], t.off[1:], 512)
            with np.errstate(over="ignore"):
                unit = w.keyed(w.mix(body[own] + place), seed)
        flat, count = _encoded(v, t.buf, us, ue, unit, dropout)
        ends = np.concatenate([[0], np.cumsum(count)])[first]
        out += [flat[ends[k] : ends[k + 1]] for k in range(t.n)]
    return out


class Units:
    """Byte spans as symbols: those of unit ``k`` are ``first[k]:first[k + 1]``."""

    def __init__(self, v: Pieces, buf: np.ndarray, us: np.ndarray, ue: np.ndarray):
        self.v = v
        self.text = buf[w.spread(us, ue - us)]
        edge = np.concatenate([[0], np.cumsum(ue - us)])
        cp, self.at = _code_points(self.text) if len(self.text) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        self.first = np.searchsorted(self.at, edge)
        self.sym = v.char[cp].astype(np.int64)
        self.size = np.diff(self.first)

    def ids(self, sym: np.ndarray, start: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, how many of each unit)``; characters without a piece become bytes."""
        where = self.first[owner] + start
        end = np.append(self.at, len(self.text))
        size = np.where(sym < 0, end[np.minimum(where + 1, len(self.at))] - end[where], 1)
        flat = np.repeat(sym, size)
        lost = np.flatnonzero(flat < 0)
        if len(lost):
            step = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
            flat[lost] = self.v.byte[self.text[np.repeat(end[where], size)[lost] + step[lost]]]
        return flat.astype(np.int32), np.bincount(owner, weights=size, minlength=len(self.size)).astype(np.int64)


def plain_units(v: Pieces, buf: np.ndarray, us: np.ndarray, ue: np.ndarray, key: np.ndarray, check: np.ndarray) -> Plain:
    """The agenda without dropout of distinct units."""
    units = Units(v, buf, us, ue)
    out = Plain()
    out.key, out.check = key, check
    short = units.size <= LONG_UNIT
    pos = w.spread(units.first[:-1][short], units.size[short])
    owner = np.repeat(np.flatnonzero(short), units.size[short])
    start = pos - units.first[owner]
    history: list = []
    sym, start, owner = merge_units(v, units.sym[pos], owner, start, start + 1, key, 0.0, history)
    out.ids, out.id_count = units.ids(sym, start, owner)
    out.id_first = np.cumsum(out.id_count) - out.id_count
    if history:  # a unit has one merge in a round
        own, a, m, e, to = (np.concatenate(x) for x in zip(*history, strict=True))
        order = np.argsort(own, kind="stable")
        own, a, m, e, to = (x[order] for x in (own, a, m, e, to))
        out.start, out.middle, out.end, out.to, out.span = a.astype(np.int16), m.astype(np.int16), e.astype(np.int16), to.astype(np.int32), spans(a, m, e)
        count = np.bincount(own, minlength=len(us))
    else:
        count = np.zeros(len(us), np.int64)
    out.first = np.cumsum(count) - count
    out.count = np.where(short, count, -1)
    return out


def _distinct(key: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(first occurrence, distinct unit of each, occurrences)`` by both hashes."""
    _, one, back, times = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    if (check != check[one][back]).any():
        both = np.stack([key, check], axis=1)
        _, one, back, times = np.unique(both, axis=0, return_index=True, return_inverse=True, return_counts=True)
    return one, back.reshape(-1), times


def _encoded(v: Pieces, buf: np.ndarray, us: np.ndarray, ue: np.ndarray, unit: np.ndarray | None, dropout: float) -> tuple[np.ndarray, np.ndarray]:
    """``(ids, how many of each unit)`` of units under their keyed hashes."""
    key, check = w.hashes_of_spans(buf, us, ue, (511, 513))
    one, back, times = _distinct(key, check)
    at = v.memo.find(key[one], check[one])
    new = np.flatnonzero(at < 0)
    fresh = plain_units(v, buf, us[one[new]], ue[one[new]], key[one[new]], check[one[new]])
    at[new] = len(v.memo.key) + np.arange(len(new))
    known = v.memo.plus(fresh)
    again = np.flatnonzero((times[new] > 1) & (fresh.count >= 0))
    if len(again) and len(v.memo.key) + len(again) <= MEMO_UNITS:
        v.memo = v.memo.plus(fresh.take(again)).sorted()
    at = at[back]
    begin, count = known.id_first[at], known.id_count[at]
    long = known.count[at] < 0
    pools, size = [known.ids], len(known.ids)
    if long.any():
        rows = np.flatnonzero(long)
        flat, n = _by_heap(v, buf, us[rows], ue[rows], None if unit is None else unit[rows], dropout)
        begin[rows], count[rows] = size + np.cumsum(n) - n, n
        pools.append(flat)
        size += len(flat)
    if unit is not None:
        rows, flat, n = _varied(v, known, buf, us, ue, at, unit, dropout)
        begin[rows], count[rows] = size + np.cumsum(n) - n, n
        pools.append(flat)
    return np.concatenate(pools)[w.spread(begin, count)], count


def _varied(
    v: Pieces, known: Plain, buf: np.ndarray, us: np.ndarray, ue: np.ndarray, at: np.ndarray, unit: np.ndarray, dropout: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(units, ids, how many of each)`` of those for which a remembered merge
    is skipped, going on from that merge."""
    rows = np.flatnonzero(known.count[at] > 0)
    n = known.count[at[rows]]
    merge = w.spread(known.first[at[rows]], n)
    out = skipped(np.repeat(unit[rows], n), known.span[merge], dropout)
    head = np.cumsum(n) - n
    hit = np.flatnonzero(out)
    which = np.searchsorted(head, hit, side="right") - 1
    lead = np.concatenate([[True], which[1:] != which[:-1]]) if len(which) else np.zeros(0, bool)
    taken = hit[lead] - head[which[lead]]  # merges before the first that is skipped
    rows, first = rows[which[lead]], known.first[at[rows[which[lead]]]]
    units = Units(v, buf, us[rows], ue[rows])
    owner = np.repeat(np.arange(len(rows)), units.size)
    start = np.arange(len(owner)) - units.first[owner]
    end, sym, alive = start + 1, units.sym.copy(), np.ones(len(owner), dtype=bool)
    merge = w.spread(first, taken)
    base = np.repeat(units.first[:-1], taken)
    here = base + known.start[merge]
    # Of merges at one place the last one stays.
    sym[here], end[here] = known.to[merge], known.end[merge]
    alive[base + known.middle[merge]] = False
    sym, start, owner = merge_units(v, sym[alive], owner[alive], start[alive], end[alive], unit[rows], dropout)
    return rows, *units.ids(sym, start, owner)


def _by_heap(v: Pieces, buf: np.ndarray, us: np.ndarray, ue: np.ndarray, unit: np.ndarray | None, dropout: float) -> tuple[np.ndarray, np.ndarray]:
    """``(ids, how many of each)`` of long units, one by one."""
    units = Units(v, buf, us, ue)
    sym, start, owner = [], [], []
    for k in range(len(us)):
        got = np.asarray(agenda(v, units.sym[units.first[k] : units.first[k + 1]].tolist(), 0 if unit is None else int(unit[k]), dropout), dtype=np.int64)
        # A character without a piece stays alone: its place follows from the sizes.
        chars = np.where(got < 0, 1, _chars(v)[np.maximum(got, 0)])
        sym.append(got)
        start.append(np.cumsum(chars) - chars)
        owner.append(np.full(len(got), k))
    return units.ids(*(np.concatenate(x) for x in (sym, start, owner)))


def _chars(v: Pieces) -> np.ndarray:
    """Code points of every piece."""
    if not hasattr(v, "chars"):
        lead = np.concatenate([[0], np.cumsum((v.body & 0xC0) != 0x80)])
        v.chars = lead[v.at + v.size] - lead[v.at]
    return v.chars


def decode(ids: np.ndarray, vocabulary: str = VOCABULARY) -> str:
    """The text of some ids, without the dummy prefix."""
    v = vocabulary_of(vocabulary)
    ids = np.asarray(ids, dtype=np.int64)
    return v.body[w.spread(v.at[ids], v.size[ids])].tobytes().decode()[1:]


def _round_trip(seed: int, dropout: float, vocabulary: str, with_ids: bool):
    def run(batches: Batches) -> Batches:
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                part = b.slice(lo, 1024)
                text = pc.fill_null(part.column("text"), "")
                n, crc, sha, same, body = [], [], [], [], []
                for ids, x in zip(encode(text, seed, dropout, vocabulary), text.to_pylist(), strict=True):
                    back = decode(ids, vocabulary)
                    n.append(len(ids))
                    crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
                    sha.append(hashlib.sha256(back.encode()).hexdigest())
                    same.append(back == x)
                    if with_ids:
                        body.append(ids)
                cols = [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(sha, pa.string()), pa.array(same, pa.bool_())]
                names = ["doc_id", "n_tokens", "ids_crc32", "decoded_sha256", "lossless"]
                if with_ids:
                    cols.append(pa.array(body, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    return run


def segmented(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = SEED, dropout: float = DROPOUT,
    vocabulary: str = VOCABULARY, with_ids: bool = False,
) -> DataFrame:
    """Per row its segmentation under the seed: ``(doc_id, n_tokens, ids_crc32,
    decoded_sha256, lossless[, ids])``, after decoding it again."""
    src = pick(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("long"), "text")
    schema = "doc_id long, n_tokens long, ids_crc32 long, decoded_sha256 string, lossless boolean" + ", ids array<int>" * with_ids
    return map_arrow(src, _round_trip(seed, dropout, vocabulary, with_ids), schema)
