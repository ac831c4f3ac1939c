"""Links between the members of a bucket, block against block.

A bucket is dealt into blocks of bounded size; two blocks, or one and itself,
meet in one task. What comes back is never a pair for its own sake: first the
members that some member of another class may be similar to (by sketch), then
of the links that hold only as many as join the classes of the two blocks.
Batches come sorted by (bucket, i, j, side).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from lexicount.llm import _words as w
from lexicount.llm._spark import Batches

#: Groups of at most this many members are compared pair by pair, all at once.
FEW = 24
#: Members compared with a block at once, and cells of a product.
AT_ONCE, CELLS = 128, 1 << 20
#: Columns of a dense product at once.
COLUMNS = 1024
#: A shared element is multiplied densely where it has more pairs than this
#: share of all.
DENSE = 1 / 200
_NIBBLE = w.U64(0x1111111111111111)


def whole_groups(batches: Batches, keys: tuple[str, ...]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of complete groups, with the first row of each and the end."""
    held: list[pa.RecordBatch] = []
    last = None

    def given() -> tuple[pa.Table, np.ndarray]:
        t = pa.Table.from_batches(held)
        cols = [t[k].to_numpy() for k in keys]
        new = np.zeros(max(0, t.num_rows - 1), dtype=bool)
        for c in cols:
            new |= c[1:] != c[:-1]
        return t, np.concatenate([[0], np.flatnonzero(new) + 1, [t.num_rows]])

    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(k).to_numpy() for k in keys]
        end = tuple(c[-1] for c in cols)
        same = np.ones(b.num_rows, dtype=bool)
        for c, x in zip(cols, end, strict=True):
            same &= c == x
        tail = int(np.argmax(same))  # the last group's first row in this batch
        if last is not None and tail == 0 and end == last:
            held.append(b)
            continue
        held.append(b.slice(0, tail))
        if sum(x.num_rows for x in held):
            yield given()
        held, last = [b.slice(tail)], end
    if sum(x.num_rows for x in held):
        yield given()


def few_pairs(edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows ``x < y`` of every pair within each group."""
    end = np.repeat(edge[1:], np.diff(edge))
    row = np.arange(edge[0], edge[-1])
    after = end - row - 1
    return np.repeat(row, after), w.spread(row + 1, after)


def unequal(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many four-bit registers differ; the last axis is the words."""
    d = a ^ b
    d |= d >> w.U64(1)
    d |= d >> w.U64(2)
    return np.bitwise_count(d & _NIBBLE).sum(-1, dtype=np.int64)


class Members:
    """Rows of a table as arrays."""

    def __init__(self, t: pa.Table, parts: list[str], least: float, most: int):
        self.cls, self.n, self.side = (t[c].to_numpy() for c in ("class", "n_shingles", "side"))
        self.sketch = np.stack([t[p].to_numpy() for p in parts], axis=1).view(w.U64)
        self.least, self.most = least, most

    def comparable(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether rows ``x`` and ``y`` (any shapes that fit) may be similar."""
        a, b = self.n[x], self.n[y]
        out = (self.cls[x] != self.cls[y]) & (np.minimum(a, b) >= self.least * np.maximum(a, b))
        x, y = np.broadcast_arrays(x, y)
        out[out] = unequal(self.sketch[x[out]], self.sketch[y[out]]) <= self.most
        return out


def candidates(parts: list[str], least: float, most: int):
    """Of every group the members that may be similar to one of another class
    and, in a group of two blocks, of the other block."""

    def run(batches: Batches) -> Batches:
        for t, edge in whole_groups(batches, ("bucket", "i", "j")):
            m = Members(t, parts, least, most)
            hit = np.zeros(t.num_rows, dtype=bool)
            crossed = t["i"].to_numpy() != t["j"].to_numpy()
            size = np.diff(edge)
            small = size <= FEW
            for lo, hi in _stretches(small):  # neighbouring small groups
                x, y = few_pairs(edge[lo : hi + 1])
                ok = ~crossed[x] | (m.side[x] != m.side[y])
                x, y = x[ok], y[ok]
                near = m.comparable(x, y)
                hit[x[near]], hit[y[near]] = True, True
            for k in np.flatnonzero(~small).tolist():
                rows = np.arange(edge[k], edge[k + 1])
                one, two = (rows, rows) if not crossed[rows[0]] else (rows[m.side[rows] == 0], rows[m.side[rows] == 1])
                for lo in range(0, len(one), AT_ONCE):
                    x = one[lo : lo + AT_ONCE]
                    # Whoever has been hit need not be compared with others that have.
                    for a, b in ((x[~hit[x]], two), (x[hit[x]], two[~hit[two]])):
                        if len(a) and len(b):
                            near = m.comparable(a[:, None], b[None, :])
                            hit[a[near.any(1)]], hit[b[near.any(0)]] = True, True
            yield from t.select(["bucket", "i", "j", "side", "id", "class", "n_shingles"]).filter(pa.array(hit)).to_batches()

    return run


def _stretches(on: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of true values, cut where they get long."""
    at = np.flatnonzero(np.diff(np.concatenate([[0], on.astype(np.int8), [0]])))
    for lo, hi in zip(at[::2].tolist(), at[1::2].tolist(), strict=True):
        for a in range(lo, hi, 4096):
            yield a, min(hi, a + 4096)


class Union:
    """Classes as they are joined."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def top(self, x: int) -> int:
        root = x
        while self.up.get(root, root) != root:
            root = self.up[root]
        while self.up.get(x, x) != root:
            self.up[x], x = root, self.up[x]
        return root

    def join(self, a: int, b: int) -> bool:
        a, b = self.top(a), self.top(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def joining_links(
    token: np.ndarray, off: np.ndarray, cls: np.ndarray, one: np.ndarray, two: np.ndarray, least: float
) -> list[tuple[int, int]]:
    """Links between rows of ``one`` and ``two`` (the same array: within it)
    whose multisets overlap by ``least``, as many as join their classes. Row
    ``k`` holds the elements ``token[off[k]:off[k + 1]]``, each of them once."""
    total = np.diff(off)
    same = one is two
    sides = (one,) if same else (one, two)
    names, place = np.unique(np.concatenate([token[w.spread(off[s], total[s])] for s in sides]), return_inverse=True)
    # Elements by row of either side, as (row, element) in order of rows.
    cut = int(total[one].sum())
    at = [np.repeat(np.arange(len(s)), total[s]) for s in sides]
    el = [place[:cut], place if same else place[cut:]]
    if same:
        at, el = [at[0], at[0]], [place, place]
    count = [np.bincount(e, minlength=len(names)) for e in el]
    pairs = count[0] * count[1]
    shared = (count[0] > 1) if same else pairs > 0
    dense = shared & (pairs > DENSE * len(one) * len(two))
    rare = shared & ~dense
    column = np.cumsum(dense) - 1
    # Of rare elements the rows of the second side, element by element.
    keep = rare[el[1]]
    order = np.argsort(el[1][keep], kind="stable")
    of_rare = at[1][keep][order]
    first = np.concatenate([[0], np.cumsum(np.where(rare, count[1], 0))])
    solid = dense[el[1]]
    row1, col1 = at[1][solid], column[el[1][solid]]
    n_dense = int(dense.sum())

    union, out = Union(), []
    label = cls.copy()
    step = max(1, CELLS // max(1, len(two)))
    exact = np.float32 if not len(total) or total.max() < 1 << 24 else np.float64
    edge0 = np.concatenate([[0], np.cumsum(total[one])])
    # A few rows first: their links may join most of the classes.
    cuts, size = [0], 8
    while cuts[-1] < len(one):
        cuts.append(min(len(one), cuts[-1] + min(step, size)))
        size *= 2
    # Rows of one class together: what has their class needs no comparison.
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        x = np.arange(lo, hi)
        mine = label[one[x]]
        y = np.flatnonzero(label[two] != mine[0]) if (mine == mine[0]).all() else np.arange(len(two))
        if not len(y):
            continue
        to = np.full(len(two), -1)
        to[y] = np.arange(len(y))
        e, r = el[0][edge0[lo] : edge0[lo + len(x)]], at[0][edge0[lo] : edge0[lo + len(x)]] - lo
        both = np.zeros((len(x), len(y)), dtype=exact)
        on = dense[e]
        re, ce = r[on], column[e[on]]
        for c in range(0, n_dense, COLUMNS):
            wide = min(COLUMNS, n_dense - c)
            a, b = np.zeros((len(x), wide), exact), np.zeros((len(y), wide), exact)
            now = (ce >= c) & (ce < c + wide)
            a[re[now], ce[now] - c] = 1
            now = (col1 >= c) & (col1 < c + wide)
            rows = to[row1[now]]
            b[rows[rows >= 0], col1[now][rows >= 0] - c] = 1
            both += a @ b.T
        on = rare[e]
        er, rr = e[on], r[on]
        size = count[1][er]
        for a, b in _slices(size, 4 * CELLS):
            right = to[of_rare[w.spread(first[er[a:b]], size[a:b])]]
            left = np.repeat(rr[a:b], size[a:b])
            ok = right >= 0
            both += np.bincount(left[ok] * len(y) + right[ok], minlength=both.size).reshape(both.shape).astype(exact)
        either = (total[one[x]][:, None] + total[two[y]][None, :]).astype(np.float64) - both
        linked = (both >= least * either) & (both / np.maximum(either, 1) >= least) & (mine[:, None] != label[two[y]][None, :])
        a, b = np.nonzero(linked)
        if not len(a):
            continue
        ca, cb = label[one[x[a]]], label[two[y[b]]]
        order = np.lexsort((cb, ca))
        head = np.concatenate([[True], (ca[order][1:] != ca[order][:-1]) | (cb[order][1:] != cb[order][:-1])])
        for k in order[head].tolist():
            if union.join(int(ca[k]), int(cb[k])):
                out.append((int(one[x[a[k]]]), int(two[y[b[k]]])))
        known, back = np.unique(label, return_inverse=True)
        label = np.asarray([union.top(int(c)) for c in known])[back]
    return out


def _slices(size: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of elements whose sizes add up to about ``most``."""
    total = np.cumsum(size)
    a = 0
    while a < len(size):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + most, side="right")))
        yield a, b
        a = b


def links(least: float):
    """Per group the links that join its classes: ``(a, b)``."""

    def run(batches: Batches) -> Batches:
        for t, edge in whole_groups(batches, ("bucket", "i", "j")):
            ids, cls, side, i, j = (t[c].to_numpy() for c in ("id", "class", "side", "i", "j"))
            bags = t["bag"].combine_chunks() if t["bag"].num_chunks != 1 else t["bag"].chunk(0)
            found = []
            for a, b in zip(edge, edge[1:], strict=False):
                if b - a < 2:
                    continue
                each = [np.frombuffer(x.as_py(), dtype="<u8") for x in bags.slice(a, b - a)]
                off = np.concatenate([[0], np.cumsum([len(x) for x in each])])
                rows = np.argsort(cls[a:b], kind="stable")
                crossed = i[a] != j[a]
                one = rows if not crossed else rows[side[a:b][rows] == 0]
                two = one if not crossed else rows[side[a:b][rows] == 1]
                if len(one) and len(two):
                    got = joining_links(np.concatenate(each), off, cls[a:b], one, two, least)
                    found += [(ids[a + x], ids[a + y]) for x, y in got]
            if found:
                cols = np.asarray(found, dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(cols.min(1)), pa.array(cols.max(1))], ["a", "b"])

    return run
