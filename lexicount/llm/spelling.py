"""Spelling variants by k-d trees over letter counts (operator 11).

Words are maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z in lower case. Two
words are near if one code point inserted, deleted or replaced makes one of the
other. Such an edit moves a word's vector of letter counts by an L1 distance of
one (insertion) or at most two (replacement), so near words of lengths
``(L, L)`` and ``(L, L + 1)`` are found by range searches of radius two and one
in k-d trees of the vectors, one tree for every length.

The search is spread over the cluster in two levels. A forest of k-d trees is
built on a bounded sample of the words (``SAMPLE`` to ``MOST_SAMPLE``); it only says how the space
is cut into cells, every word is put into the cell that holds its vector. A word
is sent as a point to its own cell and as a query to all cells whose boxes lie
within the radius. A cell of more than ``2 * CELL`` words is dealt into blocks by
a hash of the word, and its queries go to all of its blocks, so a task holds the
points of one block and streams the queries past them. In a block the points
get a k-d tree with tight boxes; what the boxes let through is held against the
distance of the vectors, and then letter by letter.

Every pair is found once, by the shorter or, of equal lengths, the smaller
word. A word's form is its near word of the largest count (of equals the
smallest) if that has ``RATIO`` times its own count; the root follows forms to
the last. Counts grow along a chain, so it ends after a few steps and is walked
by pointer jumping.

``slip`` makes spelling errors on purpose: where it divides the crc32 of
``<doc_id>:<run>``, the run's code point at ``crc32 % length`` is deleted. A
null id is an empty one there; null and empty texts have no words; rows that
repeat count again. Tables without words give no rows.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexicount.llm import _words as w
from lexicount.llm._spark import Batches, map_arrow, pick, written

LEAST_CHARS, LEAST_COUNT, RATIO = 6, 5, 5
SLIP = 199
#: Texts are counted in runs of about this many bytes.
COUNT_BYTES = 4 << 20
#: Longer runs of letters (in bytes) go through zlib one by one.
LONG_RUN = 128
#: Expected words of the sample that shapes the cells, and words in a cell.
SAMPLE, CELL = 50_000, 2048
#: Least sample words in a cell, so that the forest is bounded by the sample;
#: where the words need more cells the sample grows, up to this many words.
LEAST_SAMPLE, MOST_SAMPLE = 8, 500_000
#: Longer words share one tree.
LONG_WORD = 128
#: Points in a leaf of a block's tree; queries searched at once.
LEAF, AT_ONCE = 16, 2048
#: Steps doubled by each round of pointer jumping: 2**ROUNDS counts that each
#: grow ``RATIO`` times would pass 64 bits.
ROUNDS = 5
#: Letter counts: 26 for a-z, the other letters by their number modulo 6.
DIMS = 32
_DIM = np.zeros(256, dtype=np.int64)
_DIM[0x61:0x7B] = np.arange(26)
_DIM[0xC0:] = 26 + np.arange(64) % 6

_PAIRS = "x string, nx long, y string, ny long"


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, np.uint32(0xEDB88320) ^ (t >> np.uint32(1)), t >> np.uint32(1))
    return t


_CRC = _crc_table()


def crc_spans(buf: np.ndarray, start: np.ndarray, size: np.ndarray, state: np.ndarray) -> np.ndarray:
    """crc32 of byte spans, each going on from the crc32 of what precedes it."""
    out = state.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    order = np.argsort(-size, kind="stable")
    at, left, run = start[order], size[order], out[order]
    whole = int(np.searchsorted(-left, -LONG_RUN, side="left"))  # those come first
    for k in range(whole):
        run[k] = zlib.crc32(buf[at[k] : at[k] + left[k]].tobytes(), int(run[k] ^ np.uint32(0xFFFFFFFF))) ^ 0xFFFFFFFF
    at, left, rest = at[whole:], left[whole:], run[whole:]
    for k in range(int(left[0]) if len(left) else 0):
        n = int(np.searchsorted(-left, -k, side="left"))
        head = rest[:n]
        rest[:n] = _CRC[(head ^ buf[at[:n] + k]) & np.uint32(0xFF)] ^ (head >> np.uint32(8))
    out[order] = run
    return out ^ np.uint32(0xFFFFFFFF)


def letter_runs(t: w.Flat) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(lower-case bytes, start, size, code points)`` of the runs. The letters
    U+00C0 to U+00FF are the two bytes C3 80 to C3 BF."""
    size = int(t.off[-1])
    low = t.buf.copy()
    capital = (low >= 0x41) & (low <= 0x5A)
    low[capital] += 0x20
    lead = low[:size] == 0xC3
    letter = (low[:size] >= 0x61) & (low[:size] <= 0x7A) | lead
    letter[1:] |= lead[:-1]
    edge = np.zeros(size + 1, dtype=bool)
    edge[t.off] = True
    before, after = np.zeros(size, dtype=bool), np.zeros(size, dtype=bool)
    before[1:], after[:-1] = letter[:-1], letter[1:]
    start = np.flatnonzero(letter & (~before | edge[:-1]))
    end = np.flatnonzero(letter & (~after | edge[1:])) + 1
    leads = np.zeros(size + 1, dtype=np.int64)
    np.cumsum(lead, out=leads[1:])
    return low, start, end - start, end - start - (leads[end] - leads[start])


def _slipped(run: bytes, crc: int, chars: int) -> str:
    text = run.decode()
    k = crc % chars
    return text[:k] + text[k + 1 :]


def _strings(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.Array:
    body = buf[w.spread(start, size)]
    off = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(off), pa.py_buffer(body))


def _count(least_chars: int, slip: int | None):
    def run(batches: Batches) -> Batches:
        for b in batches:
            names = [b"" if x is None else str(x).encode() for x in b.column("doc_id").to_pylist()]
            for i, j, t in w.runs(b.column("text"), COUNT_BYTES):
                low, start, size, chars = letter_runs(t)
                long = chars >= least_chars
                start, size, chars = start[long], size[long], chars[long]
                words, extra = _strings(low, start, size), []
                if slip and len(start):
                    owner = np.searchsorted(t.off, start, side="right") - 1
                    state = np.asarray([zlib.crc32(x + b":") for x in names[i:j]], dtype=np.uint32)
                    crc = crc_spans(low, start, size, state[owner])
                    hit = crc % np.uint32(slip) == 0
                    for k in np.flatnonzero(hit & (chars > least_chars)):
                        extra.append(_slipped(low[start[k] : start[k] + size[k]].tobytes(), int(crc[k]), int(chars[k])))
                    words = words.filter(pa.array(~hit))
                if extra:
                    words = pa.concat_arrays([words, pa.array(extra, pa.large_string())])
                found = words.value_counts()
                if len(found):
                    yield pa.RecordBatch.from_arrays([found.field("values").cast(pa.string()), found.field("counts")], ["word", "n"])

    return run


def word_counts(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS,
    least_count: int = LEAST_COUNT, slip: int | None = None,
) -> DataFrame:
    """``(word, n)`` of the words of enough code points and occurrences."""
    src = pick(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    each = map_arrow(src, _count(least_chars, slip), "word string, n long")
    return each.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


# ------------------------------------------------------------------ k-d trees
@dataclass
class Letters:
    """Words as Latin-1 bytes: word ``k`` is ``flat[off[k]:off[k + 1]]``."""

    flat: np.ndarray
    off: np.ndarray

    @property
    def size(self) -> np.ndarray:
        return np.diff(self.off)

    def vectors(self) -> np.ndarray:
        """``(n, DIMS)`` letter counts."""
        n = len(self.off) - 1
        owner = np.repeat(np.arange(n), self.size)
        return np.bincount(owner * DIMS + _DIM[self.flat], minlength=n * DIMS).reshape(n, DIMS).astype(np.int32)

    def take(self, rows: np.ndarray, size: int) -> np.ndarray:
        """The letters of words that all have ``size`` of them."""
        return self.flat[self.off[rows][:, None] + np.arange(size)]


def letters(words: pa.Array) -> Letters:
    words = words.cast(pa.large_string())
    _, offs, data = words.buffers()
    off = np.frombuffer(offs, dtype=np.int64)[words.offset : words.offset + len(words) + 1]
    raw = np.frombuffer(data, dtype=np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    lead = raw == 0xC3
    after = np.zeros(len(raw), dtype=bool)
    after[1:] = lead[:-1]
    skipped = np.concatenate([[0], np.cumsum(lead)])
    off = off - off[0]
    return Letters((raw + np.where(after, 0x40, 0).astype(np.uint8))[~lead], off - skipped[off])


class Tree:
    """A k-d tree; nodes are arrays, node 0 is the root. Boxes are tight around
    the points, or (``open_space``) the whole space as the cuts divide it."""

    def __init__(self, points: np.ndarray, leaf: int, open_space: bool = False):
        far = np.iinfo(np.int32).max // 4
        self.order = np.arange(len(points))
        lo, hi, kids, part = [], [], [], []
        whole = (np.full(DIMS, -far, np.int32), np.full(DIMS, far, np.int32))
        todo = [(0, len(points), *whole, -1)]
        while todo:
            a, b, low, high, parent = todo.pop()
            rows = self.order[a:b]
            own = points[rows]
            if not open_space and len(own):
                low, high = own.min(0), own.max(0)
            here = len(lo)
            lo.append(low)
            hi.append(high)
            kids.append([-1, -1])
            part.append((a, b))
            if parent >= 0:
                kids[parent][0 if kids[parent][0] < 0 else 1] = here
            if b - a <= leaf:
                continue
            spread = own.var(0)
            dim = int(spread.argmax())
            if spread[dim] == 0:
                continue
            value = own[:, dim]
            cut = int(np.median(value))
            if (value <= cut).all():  # the median is the largest value
                cut = int(value[value < cut].max())
            left = value <= cut
            self.order[a:b] = np.concatenate([rows[left], rows[~left]])
            mid = a + int(left.sum())
            below, above = high.copy(), low.copy()
            below[dim], above[dim] = cut, cut + 1
            todo.append((a, mid, low, below, here))
            todo.append((mid, b, above, high, here))
        self.lo, self.hi = np.stack(lo), np.stack(hi)
        self.kids, self.part = np.asarray(kids), np.asarray(part)
        self.leaves = np.flatnonzero(self.kids[:, 0] < 0)

    def reach(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """``(query, leaf node)``: leaves whose boxes are within the radius."""
        q, node = np.arange(len(queries)), np.zeros(len(queries), dtype=np.int64)
        out_q, out_n = [], []
        while len(q):
            x = queries[q]
            apart = np.maximum(self.lo[node] - x, 0) + np.maximum(x - self.hi[node], 0)
            near = apart.sum(1) <= radius
            q, node = q[near], node[near]
            end = self.kids[node, 0] < 0
            out_q.append(q[end])
            out_n.append(node[end])
            q, node = np.repeat(q[~end], 2), self.kids[node[~end]].reshape(-1)
        return np.concatenate(out_q) if out_q else q, np.concatenate(out_n) if out_n else node


def family(size: np.ndarray) -> np.ndarray:
    """Which tree words of a length are in."""
    return np.minimum(size, LONG_WORD + 1)


class Forest:
    """The cells: a tree of open boxes for every length, built on a sample."""

    def __init__(self, sample: pa.Array, leaf: int):
        own = letters(sample)
        points, of = own.vectors(), family(own.size)
        self.trees: dict[int, Tree] = {int(k): Tree(points[of == k], leaf, open_space=True) for k in np.unique(of)}
        self.first, at = {}, LONG_WORD + 2  # numbers below: lengths the sample lacks
        for k, tree in self.trees.items():
            tree.order = np.zeros(0, np.int64)  # only the boxes are of use
            self.first[k] = at
            at += len(tree.lo)

    def cells(self, points: np.ndarray, of: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """``(point, cell)`` of cells of the tree ``of`` within the radius; with
        radius 0 each point's own."""
        if of not in self.trees:
            return np.arange(len(points)), np.full(len(points), of)
        q, node = self.trees[of].reach(points, radius)
        return q, node + self.first[of]


def _own_cells(send):
    def run(batches: Batches) -> Batches:
        forest = send.value
        for b in batches:
            own = letters(b.column("word"))
            points, of = own.vectors(), family(own.size)
            cell = np.zeros(len(points), np.int64)
            for k in np.unique(of):
                rows = np.flatnonzero(of == k)
                q, c = forest.cells(points[rows], int(k), 0)
                cell[rows[q]] = c
            if len(cell):
                yield pa.RecordBatch.from_arrays([pa.array(cell)], ["cell"])

    return run


def _deal(send, send_blocks):
    """Points to their cells, queries to all cells in reach."""

    def run(batches: Batches) -> Batches:
        forest, blocks = send.value, send_blocks.value
        for b in batches:
            for lo in range(0, b.num_rows, AT_ONCE):
                part = b.slice(lo, AT_ONCE)
                own = letters(part.column("word"))
                points, of = own.vectors(), family(own.size)
                code = w.keyed(np.asarray([zlib.crc32(x.encode()) for x in part.column("word").to_pylist()], dtype=w.U64), 1101)
                rows, cells, kinds = [], [], []
                for k in np.unique(of).tolist():
                    mine = np.flatnonzero(of == k)
                    reach = [(k, 0, 0), (k, 2, 1)] + ([(k + 1, 1, 1)] if k <= LONG_WORD else [])
                    for tree, radius, kind in reach:
                        q, c = forest.cells(points[mine], tree, radius)
                        rows.append(mine[q])
                        cells.append(c)
                        kinds.append(np.full(len(q), kind))
                if not rows:
                    continue
                row, cell, kind = np.concatenate(rows), np.concatenate(cells), np.concatenate(kinds)
                many = np.asarray([blocks.get(c, 0) for c in cell.tolist()], dtype=np.int64)
                # A point goes to one block, a query to all; empty cells have none.
                times = np.where(kind == 0, 1, many)
                block = w.spread(np.zeros(len(times), np.int64), times)
                row, cell, kind, many = (np.repeat(x, times) for x in (row, cell, kind, many))
                point = kind == 0
                block[point] = (code[row[point]] % many[point].astype(w.U64)).astype(np.int64)
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell), pa.array(block), pa.array(kind), part.column("word").take(at), part.column("n").take(at)],
                    ["cell", "block", "kind", "word", "n"],
                )

    return run


def one_edit(a: Letters, x: np.ndarray, b: Letters, y: np.ndarray) -> np.ndarray:
    """Whether words ``x`` of ``a`` and ``y`` of ``b`` differ by one code point
    replaced or, where ``y`` is longer by one, inserted."""
    sx, sy = a.size[x], b.size[y]
    out = np.zeros(len(x), dtype=bool)
    for size in np.unique(sx[(sy == sx) | (sy == sx + 1)]).tolist():
        same = np.flatnonzero((sx == size) & (sy == size))
        if len(same):
            out[same] = (a.take(x[same], size) != b.take(y[same], size)).sum(1) == 1
        more = np.flatnonzero((sx == size) & (sy == size + 1))
        if len(more):
            p, q = a.take(x[more], size), b.take(y[more], size + 1)
            ahead = np.logical_and.accumulate(p == q[:, :-1], axis=1).sum(1)
            behind = np.logical_and.accumulate((p == q[:, 1:])[:, ::-1], axis=1).sum(1)
            out[more] = ahead + behind >= size
    return out


class Block:
    """The points of one block, and a tree around them."""

    def __init__(self, words: pa.Array, n: pa.Array):
        self.words, self.n = words, n
        self.letters = letters(words)
        self.points = self.letters.vectors()
        self.tree = Tree(self.points, LEAF)

    def pairs(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(query, point)`` of near words, each pair by one of its two."""
        own = letters(words)
        points = own.vectors()
        found_x, found_y = [], []
        for lo in range(0, len(points), AT_ONCE):
            q, node = self.tree.reach(points[lo : lo + AT_ONCE], 2)
            part = self.tree.part[node]
            count = part[:, 1] - part[:, 0]
            total = np.cumsum(count)
            cut = np.searchsorted(total, np.arange(1 << 18, int(count.sum()), 1 << 18)).tolist()
            for a, b in zip([0, *cut], [*cut, len(q)], strict=True):
                x = np.repeat(q[a:b], count[a:b]) + lo
                y = self.tree.order[w.spread(part[a:b, 0], count[a:b])]
                step = self.letters.size[y] - own.size[x]
                apart = np.abs(points[x] - self.points[y]).sum(1)
                near = ((step == 0) & (apart <= 2)) | ((step == 1) & (apart == 1))
                x, y = x[near], y[near]
                good = one_edit(own, x, self.letters, y)
                found_x.append(x[good])
                found_y.append(y[good])
        none = np.zeros(0, np.int64)
        x, y = (np.concatenate(v) if v else none for v in (found_x, found_y))
        # Of equal lengths only the smaller word asks.
        left, right = words.take(pa.array(x)), self.words.take(pa.array(y))
        once = np.asarray(pc.less(left, right)) | (own.size[x] < self.letters.size[y])
        return x[once], y[once]


def _search(batches: Batches) -> Batches:
    """Rows come by (cell, block), the points before the queries."""
    at, waiting, block = None, [], None
    for b in batches:
        if not b.num_rows:
            continue
        cell, part, kind = (b.column(c).to_numpy() for c in ("cell", "block", "kind"))
        new = (cell[1:] != cell[:-1]) | (part[1:] != part[:-1]) | (kind[1:] != kind[:-1])
        edge = [0, *(np.flatnonzero(new) + 1).tolist(), b.num_rows]
        for lo, hi in zip(edge, edge[1:], strict=False):
            here = (int(cell[lo]), int(part[lo]))
            if here != at:
                at, waiting, block = here, [], None
            words, n = (b.column(c).slice(lo, hi - lo) for c in ("word", "n"))
            if kind[lo] == 0:
                waiting.append((words, n))
                continue
            if block is None:
                if not waiting:  # nothing is dealt to this block
                    continue
                block = Block(pa.concat_arrays([x for x, _ in waiting]), pa.concat_arrays([x for _, x in waiting]))
                waiting = []
            x, y = (pa.array(v) for v in block.pairs(words))
            if len(x):
                yield pa.RecordBatch.from_arrays([words.take(x), n.take(x), block.words.take(y), block.n.take(y)], ["x", "nx", "y", "ny"])


def near_pairs(words: DataFrame, sample: int = SAMPLE, cell: int = CELL) -> DataFrame:
    """``(x, nx, y, ny)``, every pair of near words of ``(word, n)`` once.
    ``words`` is read several times: give a written table."""
    sc = words.sparkSession.sparkContext
    total = words.count()
    sample = max(sample, min(MOST_SAMPLE, LEAST_SAMPLE * total // cell))
    share = min(1.0, sample / max(1, total))
    draw = F.pmod(F.xxhash64("word", F.lit(1111)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    # The sample shapes the cells and nothing else; whichever rows the limit leaves out.
    drawn = words.filter(draw).select("word").limit(2 * sample).toArrow()["word"].combine_chunks()
    forest = Forest(drawn, max(LEAST_SAMPLE, int(cell * share)))
    send = sc.broadcast(forest)
    # A row per cell: at most 2 * sample / LEAST_SAMPLE leaves and LONG_WORD lengths.
    sizes = map_arrow(words, _own_cells(send), "cell long").groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()
    blocks = sc.broadcast({r["cell"]: -(-r["n"] // (2 * cell)) for r in sizes})
    rows = map_arrow(words, _deal(send, blocks), "cell long, block long, kind long, word string, n long")
    dealt = rows.repartition("cell", "block").sortWithinPartitions("cell", "block", "kind")
    return map_arrow(dealt, _search, _PAIRS)


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of ``(word, form)`` links that never come back."""
    now = written(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "spelling-roots")
    for _ in range(ROUNDS):
        onward = now.select(F.col("word").alias("at"), F.col("root").alias("onward"))
        now = written(
            now.join(onward, F.col("root") == F.col("at"), "left").select(
                "word", F.coalesce("onward", "root").alias("root"), F.col("onward").isNotNull().alias("moved")
            ),
            "spelling-roots",
        )
        if now.filter("moved").isEmpty():
            break
    return now.select("word", "root")


def variants(words: DataFrame, ratio: int = RATIO, **options) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` per row of ``(word, n)``."""
    words = written(words, "spelling-words")
    pairs = near_pairs(words, **options)
    sides = F.explode(F.array(
        F.struct(F.col("x").alias("word"), F.col("nx").alias("n"), F.col("y").alias("other"), F.col("ny").alias("m")),
        F.struct(F.col("y").alias("word"), F.col("ny").alias("n"), F.col("x").alias("other"), F.col("nx").alias("m")),
    )).alias("s")
    best = F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best")
    near = pairs.select(sides).select("s.*").groupBy("word").agg(
        F.first("n").alias("n"), F.count(F.lit(1)).alias("n_near"), best
    )
    form = F.when(-F.col("best.m") >= F.lit(ratio) * F.col("n"), F.col("best"))
    near = written(near.select(F.col("word").alias("w"), "n_near", form["other"].alias("form"), (-form["m"]).alias("form_n")), "spelling-near")
    last = roots(near.filter("form IS NOT NULL").select(F.col("w").alias("word"), "form"))
    last = last.select(F.col("word").alias("r"), "root")
    return words.join(near, F.col("word") == F.col("w"), "left").join(last, F.col("word") == F.col("r"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"
    )
