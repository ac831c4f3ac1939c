"""Vectorised words, lines and hashes over Arrow string columns.

A word is a maximal run of bytes outside the six ASCII white-space bytes
``[\\x20\\x09-\\x0D]`` (UTF-8 continuation bytes never collide with them, so
this equals the same rule on code points).
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_GOLD = U64(0x9E3779B97F4A7C15)
_M1, _M2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)

#: Texts are worked on in runs of about this many bytes, so that memory does
#: not follow the batch size; a longer text is one run by itself.
RUN_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection that spreads every input bit."""
    x = (x ^ (x >> U64(30))) * _M1
    x = (x ^ (x >> U64(27))) * _M2
    return x ^ (x >> U64(31))


def keyed(x: np.ndarray, key: int) -> np.ndarray:
    """``x`` hashed under ``key``."""
    with np.errstate(over="ignore"):
        return mix(np.asarray(x, dtype=U64) + _GOLD * U64((key + 1) & 0xFFFFFFFFFFFFFFFF))


def seed_of(text: str) -> int:
    """A 63-bit seed from a string."""
    h = 1469598103934665603
    for b in text.encode():
        h = ((h ^ b) * 1099511628211) & 0x7FFFFFFFFFFFFFFF
    return h


@dataclass
class Flat:
    """Some texts as one padded byte array; text ``i`` is ``buf[off[i]:off[i+1]]``."""

    buf: np.ndarray
    off: np.ndarray

    @property
    def n(self) -> int:
        return len(self.off) - 1


def runs(texts: pa.Array | pa.ChunkedArray, run_bytes: int = RUN_BYTES) -> Iterator[tuple[int, int, Flat]]:
    """``(first, end, Flat)`` for consecutive runs of texts; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if len(texts) == 0:
        return
    _, offs, data = texts.buffers()
    off = np.frombuffer(offs, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(off, off[i] + run_bytes, side="right")) - 1)
        size = int(off[j] - off[i])
        buf = np.zeros(size + 8, dtype=np.uint8)
        buf[:size] = raw[off[i] : off[j]]
        yield i, j, Flat(buf, off[i : j + 1] - off[i])
        i = j


def word_spans(t: Flat, separators: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, first)``: words of all texts; those of text ``i`` are
    ``first[i]:first[i+1]``. ``separators`` marks the bytes between words."""
    size = int(t.off[-1])
    space = separators[t.buf[:size]]
    edge = np.zeros(size + 1, dtype=bool)
    edge[t.off] = True
    before = np.empty(size, dtype=bool)
    after = np.empty(size, dtype=bool)
    if size:
        before[0], after[-1] = True, True
        before[1:], after[:-1] = space[:-1], space[1:]
    start = np.flatnonzero(~space & (before | edge[:-1]))
    end = np.flatnonzero(~space & (after | edge[1:])) + 1
    return start, end, np.searchsorted(start, t.off)


def line_spans(t: Flat) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, text)`` of every ``\\n``-split line; an empty text has one."""
    size = int(t.off[-1])
    nl = np.flatnonzero(t.buf[:size] == 10)
    owner = np.searchsorted(t.off, nl, side="right") - 1
    start = np.concatenate([t.off[:-1], nl + 1])
    end = np.concatenate([nl, t.off[1:]])
    text_s = np.concatenate([np.arange(t.n), owner])
    text_e = np.concatenate([owner, np.arange(t.n)])
    a, b = np.lexsort((start, text_s)), np.lexsort((end, text_e))
    return start[a], end[b], text_s[a]


def hash_spans(buf: np.ndarray, start: np.ndarray, end: np.ndarray, key: int = 0) -> np.ndarray:
    """64-bit hashes of the byte spans, eight bytes at a time."""
    return hashes_of_spans(buf, start, end, (key,))[0]


#: Of so few spans that are left the rest is hashed without arrays.
_LAST_SPANS = 6


def hashes_of_spans(buf: np.ndarray, start: np.ndarray, end: np.ndarray, keys: tuple[int, ...]) -> list[np.ndarray]:
    """``hash_spans`` under several keys."""
    view = np.ndarray((len(buf) - 7,), dtype="<u8", buffer=buf, strides=(1,))
    size = end - start
    out = [keyed(size.astype(U64), key) for key in keys]
    todo, at, left = np.flatnonzero(size > 0), start, size
    if len(todo) < len(size):
        at, left = start[todo], size[todo]
    with np.errstate(over="ignore"):
        while len(todo) > _LAST_SPANS:
            lane = view[at]
            short = left < 8
            if short.any():
                keep = np.minimum(left, 8).astype(U64) * U64(8)
                mask = np.where(keep == U64(64), ~U64(0), (U64(1) << (keep & U64(63))) - U64(1))
                lane = lane & mask
            for h in out:
                h[todo] = mix((h[todo] ^ lane) + _GOLD)
            more = left > 8
            todo, at, left = todo[more], at[more] + 8, left[more] - 8
    for k, a, n in zip(todo.tolist(), at.tolist(), left.tolist(), strict=True):
        lanes = buf[a : a + n].tobytes()
        for h in out:
            h[k] = _rest(int(h[k]), lanes)
    return out


def _rest(h: int, data: bytes) -> int:
    """The steps of ``hash_spans`` over some bytes, as plain numbers."""
    every, gold, m1, m2 = 0xFFFFFFFFFFFFFFFF, int(_GOLD), int(_M1), int(_M2)
    for (lane,) in struct.iter_unpack("<Q", data + bytes(-len(data) % 8)):
        h = ((h ^ lane) + gold) & every
        h = ((h ^ (h >> 30)) * m1) & every
        h = ((h ^ (h >> 27)) * m2) & every
        h ^= h >> 31
    return h


def code_points(t: Flat) -> np.ndarray:
    """Running count of code points: those of ``buf[a:b]`` are ``c[b] - c[a]``."""
    size = int(t.off[-1])
    out = np.zeros(size + 1, dtype=np.int64)
    np.cumsum((t.buf[:size] & 0xC0) != 0x80, out=out[1:])
    return out


def segment_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values[first[i]:first[i+1]]``; empty segments give 0."""
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def owners(first: np.ndarray) -> np.ndarray:
    """The segment each element belongs to."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def ngram_hashes(words: np.ndarray, first: np.ndarray, n: int, key: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """``(hash, position)`` of every window of ``n`` words within one text."""
    if len(words) < n:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    m = len(words) - n + 1
    with np.errstate(over="ignore"):
        h = keyed(words[:m], key)
        for k in range(1, n):
            h = mix((h ^ words[k : m + k]) + _GOLD)
    inside = np.ones(m, dtype=bool)
    for k in range(1, n):  # a window may not run over the start of a later text
        at = first[1:-1] - k
        inside[at[(at >= 0) & (at < m)]] = False
    pos = np.flatnonzero(inside)
    return h[pos], pos


def repeated(keys: np.ndarray) -> np.ndarray:
    """True where a key occurs more than once."""
    out = np.zeros(len(keys), dtype=bool)
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    same = k[1:] == k[:-1]
    out[order[1:]] |= same
    out[order[:-1]] |= same
    return out


def later_copies(keys: np.ndarray) -> np.ndarray:
    """True where a key occurred at an earlier position."""
    out = np.zeros(len(keys), dtype=bool)
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    out[order[1:]] = k[1:] == k[:-1]
    return out


def spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The indices ``first[0], ..., first[0] + size[0] - 1, first[1], ...``."""
    total = int(size.sum())
    before = np.cumsum(size) - size
    return np.arange(total) + np.repeat(first - before, size)
