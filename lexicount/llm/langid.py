"""Language identification by averaged hashed subword embeddings (operator 7).

Every 2- to 4-byte window of a lower-case text (digits left out, white space
one kind) is hashed to one of ``BUCKETS`` embeddings; a text is the average of
its embeddings, and a linear softmax over the average names the language. The
model is trained by stochastic gradient descent in numpy (steps scaled as in
AdaGrad) on a bounded sample
of labelled texts (``PER_LABEL`` expected texts of each label, whole), every
one as its bag of buckets made on the executors. There the sample is cut, too:
of each label the texts of the smallest draws, as long as their bags fit into the
label's share of ``ENTRIES``, so that neither the number of labels nor the
lengths of the texts decide what reaches the driver.

Part of the sample is held back to calibrate: a temperature is fitted to it,
and a text is rejected if its calibrated probability is below ``threshold``,
the value that would reject ``REJECT_SHARE`` of the held-back texts that were
named rightly (at most ``MOST_REJECT``). Null texts, texts without a letter
and labels without examples: ``und`` with score 0, rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexicount.llm import _words as w
from lexicount.llm._spark import Batches, map_arrow, packed_row, pick, row_type, unpacked

BUCKETS = 1 << 15
WINDOWS = (2, 3, 4)
#: Dimensions of an embedding: at least, for each label above that, at most.
DIM, DIM_EACH, MOST_DIM = 16, 0.25, 64
PER_LABEL = 400
#: Labels are taken from at most this many values, the most frequent ones,
#: unless the caller says otherwise: a model has a column for each.
MAX_LABELS = 1024
#: Bag entries (a bucket and its share, 8 bytes) of the whole sample.
ENTRIES = 24_000_000
EPOCHS, RATE = 8, 0.05
REJECT_SHARE = 0.001
MOST_REJECT = 0.5
UNKNOWN = "und"

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[[0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0x20
_CLASS[0x30:0x3A] = 0x30


def _lower(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))


def window_buckets(t: w.Flat, n: int) -> np.ndarray:
    """The bucket of the ``n``-byte window at every byte; a window over a
    text's end takes the bytes of a blank end instead."""
    size = int(t.off[-1])
    buf = np.full(size + 8, 0x20, dtype=np.uint8)
    buf[:size] = _CLASS[t.buf[:size]]
    view = np.ndarray((size,), dtype="<u8", buffer=buf, strides=(1,))
    lane = view & w.U64((1 << (8 * n)) - 1)
    for k in range(1, n):  # windows that would reach into the next text
        at = t.off[1:] - k
        at = at[(at >= 0) & (at >= t.off[:-1])]
        lane[at] = lane[at] & w.U64((1 << (8 * k)) - 1)
    with np.errstate(over="ignore"):
        return (((lane ^ w.U64(n << 56)) * w.U64(0x9E3779B97F4A7C15)) >> w.U64(64 - BUCKETS.bit_length() + 1)).astype(np.int32)


def bags(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """``(bucket, share)`` of every text; shares add up to 1."""
    out = []
    for _, _, t in w.runs(_lower(texts)):
        each = [window_buckets(t, n) for n in WINDOWS]
        for k in range(t.n):
            mine = np.concatenate([e[t.off[k] : t.off[k + 1]] for e in each])
            b, c = np.unique(mine, return_counts=True)
            out.append((b, c / max(1, len(mine))))
    return out


@dataclass
class Model:
    labels: list[str]
    table: np.ndarray  # (BUCKETS, n): each bucket's share of what ``head`` takes
    bias: np.ndarray
    temperature: float
    threshold: float
    head: np.ndarray | None = None  # from the averages to the logits; None: they are the logits

    def logits(self, texts: pa.Array) -> np.ndarray:
        out = []
        for _, _, t in w.runs(_lower(texts), 2 << 20):
            first = t.off
            size = np.diff(first)
            full = np.flatnonzero(size)
            z = np.zeros((t.n, self.table.shape[1]))
            for n in WINDOWS:
                at = window_buckets(t, n)
                for k in range(self.table.shape[1]):
                    if len(full):
                        z[full, k] += np.add.reduceat(self.table[:, k][at], first[full], dtype=np.float64)
            z /= np.maximum(1, size * len(WINDOWS))[:, None]
            out.append((z if self.head is None else z @ self.head) + self.bias)
        return np.concatenate(out) if out else np.zeros((0, len(self.labels)))

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """``(label, score, rejected)``."""
        if not self.labels:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
        p = softmax(self.logits(texts) / self.temperature)
        best = p.argmax(1) if len(p) else np.zeros(0, int)
        score = p.max(1) if len(p) else np.zeros(0)
        letter = np.asarray(pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False))
        names = [self.labels[k] if ok else UNKNOWN for k, ok in zip(best, letter, strict=True)]
        score = np.where(letter, score, 0.0)
        return names, score, ~letter | (score < self.threshold)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True)) if len(z) else z
    return e / e.sum(axis=1, keepdims=True) if len(z) else z


def dimensions(labels: int) -> int:
    return max(DIM, min(MOST_DIM, int(DIM_EACH * labels)))


def train(examples: list[tuple[str, np.ndarray, np.ndarray]], seed: int = 7) -> Model:
    """The model from ``(label, buckets, shares)``; a fifth calibrates."""
    labels = sorted({e[0] for e in examples})
    if not labels:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 0.0)
    no = {x: k for k, x in enumerate(labels)}
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(examples))
    held = set(order[: len(examples) // 5].tolist()) if len(examples) >= 50 else set()
    fit = [k for k in range(len(examples)) if k not in held]
    dim = dimensions(len(labels))
    emb = rng.normal(0, 0.1, (BUCKETS, dim))
    out = np.zeros((dim, len(labels)))
    bias = np.zeros(len(labels))
    steps, total = 0, EPOCHS * len(fit)
    # Steps are scaled by the gradients met so far (one sum per embedding), so
    # that rare and frequent buckets learn alike and no step can blow up.
    seen_emb, seen_out, seen_bias = np.full(BUCKETS, 1e-12), np.full(out.shape, 1e-12), np.full(len(labels), 1e-12)
    for _ in range(EPOCHS):
        for k in rng.permutation(fit):
            label, b, c = examples[k]
            c = c.astype(np.float64)
            rate = RATE * (1 - steps / total)
            steps += 1
            mean = c @ emb[b]
            p = softmax((mean @ out + bias)[None])[0]
            p[no[label]] -= 1
            g = out @ p
            outer = np.outer(mean, p)
            seen_out += outer**2
            seen_bias += p**2
            seen_emb[b] += c**2 * (g @ g)
            out -= rate * outer / np.sqrt(seen_out)
            bias -= rate * p / np.sqrt(seen_bias)
            emb[b] -= (rate * c / np.sqrt(seen_emb[b]))[:, None] * g[None]
    # With few labels a bucket's part in the logits is smaller than its embedding.
    table, head = (emb @ out, None) if len(labels) <= dim else (emb, out)

    def score(keys) -> tuple[np.ndarray, np.ndarray]:
        z = np.stack([examples[k][2].astype(np.float64) @ table[examples[k][1]] for k in keys])
        z = (z if head is None else z @ head) + bias
        return z, np.asarray([no[examples[k][0]] for k in keys])

    z, y = score(sorted(held) if held else fit)
    heat = np.exp(np.linspace(-2, 3, 101))
    loss = [-np.log(np.maximum(softmax(z / t)[np.arange(len(y)), y], 1e-12)).mean() for t in heat]
    temperature = float(heat[int(np.argmin(loss))])
    p = softmax(z / temperature)
    right = p.max(1)[p.argmax(1) == y]
    threshold = min(MOST_REJECT, float(np.quantile(right, REJECT_SHARE))) if len(right) else 0.0
    return Model(labels, table.astype(np.float32), bias, temperature, threshold, head)


def _bags(batches: Batches) -> Batches:
    for b in batches:
        found = bags(b.column("text"))
        yield pa.RecordBatch.from_arrays(
            [
                b.column("lang"), b.column("draw"), b.column("key"), pa.array([len(x) for x, _ in found], pa.int64()),
                pa.array([x for x, _ in found], pa.list_(pa.int32())), pa.array([c.astype(np.float32) for _, c in found], pa.list_(pa.float32())),
            ],
            ["lang", "draw", "key", "size", "bucket", "share"],
        )


def sampled(
    docs: DataFrame, lang: str = "lang", text: str = "text", where: Column | None = None, per_label: int = PER_LABEL,
    max_labels: int = MAX_LABELS, entries: int = ENTRIES,
) -> DataFrame | None:
    """``(lang, draw, key, size, bucket, share)``, the bags to learn from; None
    if there is no label.

    A text is drawn by its hash, so that a label has about ``per_label`` distinct
    ones; of those the smallest draws stay, at most twice as many and at most
    ``entries / labels`` entries, cut on the executors."""
    rows = docs.filter(where) if where is not None else docs
    rows = pick(rows, lang=lang, text=text).filter("lang IS NOT NULL AND text IS NOT NULL")
    texts = F.approx_count_distinct(F.xxhash64("text")).alias("texts")
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), texts).orderBy(F.desc("n"), "lang").limit(max_labels).collect()
    if not counts:
        return None
    # At most max_labels rows.
    shares = docs.sparkSession.createDataFrame(
        [(r["lang"], min(1.0, per_label / max(1, r["texts"]))) for r in counts], "s_lang string, drawn_share double"
    )
    draw = F.pmod(F.xxhash64("text", F.lit(1707)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = rows.withColumn("draw", draw).join(F.broadcast(shares), F.col("lang") == F.col("s_lang")).filter(F.col("draw") < F.col("drawn_share"))
    drawn = drawn.dropDuplicates(["lang", "text"]).select("lang", "text", "draw", F.xxhash64("text").alias("key"))
    bag = map_arrow(drawn, _bags, "lang string, draw double, key long, size long, bucket array<int>, share array<float>")
    # A label's group has about per_label rows, whatever the table.
    least = Window.partitionBy("lang").orderBy("draw", "key")
    so_far = F.sum("size").over(least.rowsBetween(Window.unboundedPreceding, 0))
    kept = bag.withColumn("place", F.row_number().over(least)).withColumn("so_far", so_far)
    return kept.filter((F.col("place") <= 2 * per_label) & (F.col("so_far") <= max(BUCKETS, entries // len(counts)))).drop("place", "so_far")


def learned(docs: DataFrame, lang: str = "lang", text: str = "text", where: Column | None = None, **bounds) -> Model:
    """A model from the labelled rows that pass ``where``; the sample is drawn
    by a hash of the text, the label left out. Copies of a text under one label
    are one example, and count as one. ``bounds`` are those of ``sampled``."""
    sample = sampled(docs, lang, text, where, **bounds)
    if sample is None:
        return train([])
    got = sample.toArrow()
    order = np.lexsort((got["key"].to_numpy(), got["draw"].to_numpy()))
    # The bags stay in Arrow's memory; whatever order they came in.
    label, bucket, share = got["lang"].to_pylist(), got["bucket"].to_numpy(), got["share"].to_numpy()
    examples = sorted(((label[k], bucket[k], share[k]) for k in order), key=lambda e: e[0])
    model = train([e for e in examples if len(e[1])])
    del got, label, bucket, share, examples
    pa.default_memory_pool().release_unused()
    return model


def _predict(model):
    def run(batches: Batches) -> Batches:
        m = model.value
        for b in batches:
            names, score, rejected = m.predict(b.column("text"))
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("text"), pa.array(names, pa.string()), pa.array(score), pa.array(rejected)],
                ["row", "text", "lang_pred", "score", "rejected"],
            )

    return run


def _judged(docs: DataFrame, model: Model, text: str) -> DataFrame:
    """``row``, ``text``, ``lang_pred``, ``score`` and ``rejected``. The size
    of the model that is sent is fixed by ``BUCKETS`` and ``MAX_LABELS``."""
    send = docs.sparkSession.sparkContext.broadcast(model)
    src = docs.select(packed_row(docs, text), F.col(f"`{text}`").alias("text"))
    schema = f"row {row_type(docs, text)}, text string, lang_pred string, score double, rejected boolean"
    return map_arrow(src, _predict(send), schema)


def predicted(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score, rejected)`` per row of ``docs``."""
    rows = pick(docs, doc_id=doc_id, text=text)
    return _judged(rows, model, "text").select(F.col("row.doc_id").alias("doc_id"), "lang_pred", "score", "rejected")


def accepted(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not rejected, all columns as they are."""
    return unpacked(_judged(docs, model, text).filter("NOT rejected"), docs, {text: F.col("text")})
