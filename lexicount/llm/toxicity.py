"""Toxic passages as maximum-scoring segments (operator 9).

Every word (letters, digits and non-ASCII, lower case, hashed to ``BUCKETS``)
gets the log-odds of toxic against clean labelled texts under a Dirichlet
prior proportional to the corpus, pulled towards zero by its standard error
and lowered by a constant ``DRIFT``, so that clean text scores below zero on
average. One linear scan per text finds all maximal segments (Ruzzo and
Tompa); the score of the best one follows an extreme-value law in clean text,
``P(max >= s) ~ 1 - exp(-K n exp(-lambda s))``, with lambda from the scores of
clean words and K fitted to clean texts. Segments beyond ``E_VALUE`` expected
by chance are the toxic passages. Their normalised scores (lambda s - ln K n),
the best one and the sum, go through a logistic regression fitted on the
labelled sample. K and the regression see each text of the sample under scores
learned from the other folds, as they will see texts that were not learned
from.

Words are counted over at most ``PER_CLASS`` expected texts of each class.
Null and empty texts have no segment.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexicount.llm import _words as w
from lexicount.llm._spark import Batches, map_arrow, pick, written

BUCKETS = 1 << 18
PER_CLASS = 10_000
#: The prior weighs as much as this share of all words counted.
PRIOR = 0.05
LEAST_PRIOR = 0.05
SHRINK = 1.645
DRIFT = 0.5
FOLDS = 8
E_VALUE = 0.05
THRESHOLD = 0.7

_OUTSIDE = np.ones(256, dtype=bool)
_OUTSIDE[[*b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", *range(0x80, 0x100)]] = False


def word_buckets(texts: pa.Array, run_bytes: int = 2 << 20):
    """``(first text, buckets, first)`` for runs of texts."""
    low = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    for i, _, t in w.runs(low, run_bytes):
        start, end, first = w.word_spans(t, _OUTSIDE)
        h = w.hash_spans(t.buf, start, end, 901)
        yield i, (h >> w.U64(64 - BUCKETS.bit_length() + 1)).astype(np.int32), first


def best_scores(s: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The best segment's score in every text, 0 if none is positive."""
    n = len(first) - 1
    out = np.zeros(n)
    if not len(s):
        return out
    own = w.owners(first)
    total = np.cumsum(s.astype(np.float64))
    far = 2.0 * (np.abs(total).max() + np.abs(s).max() + 1)  # lowers each text below the ones before
    total = total - own * far
    low = np.minimum.accumulate(np.concatenate([[0.0], total[:-1]]))
    head = first[:-1][np.diff(first) > 0]
    low[head] = total[head] - s[head]
    low = np.minimum.accumulate(low)
    full = np.flatnonzero(np.diff(first) > 0)
    out[full] = np.maximum(0.0, np.maximum.reduceat(total - low, head))
    return out


def segments(s: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments ``(start, end, score)`` of one text, by
    Ruzzo and Tompa's scan over runs of words of one sign."""
    if not len(s):
        return []
    up = s > 0
    cut = np.flatnonzero(np.concatenate([[True], up[1:] != up[:-1]]))
    ends = np.append(cut[1:], len(s))
    sums = np.add.reduceat(s.astype(np.float64), cut)
    total = 0.0
    stack: list[list[float]] = []  # [start, end, sum before, sum after]
    for a, b, x in zip(cut.tolist(), ends.tolist(), sums.tolist(), strict=True):
        if x <= 0:
            total += x
            continue
        now = [a, b, total, total + x]
        total += x
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= now[2]:
                j -= 1
            if j < 0 or stack[j][3] >= now[3]:
                stack.append(now)
                break
            now = [stack[j][0], now[1], stack[j][2], now[3]]
            del stack[j:]
    return [(int(a), int(b), hi - lo) for a, b, lo, hi in stack]


@dataclass
class Model:
    score: np.ndarray  # by bucket
    lam: float
    k: float
    weight: np.ndarray  # logistic: constant, best, sum of passages

    def normal(self, s, n):
        """lambda s - ln(K n): at 0, one such segment is expected by chance."""
        return self.lam * s - np.log(np.maximum(self.k * np.maximum(n, 1), 1e-300))

    def passages(self, s: np.ndarray) -> list[tuple[int, int, float]]:
        """The significant ones among the segments of one text, normalised."""
        n = len(s)
        found = [(a, b, float(self.normal(x, n))) for a, b, x in segments(s)]
        return [f for f in found if f[2] >= -np.log(E_VALUE)]

    def measure(self, texts: pa.Array) -> tuple[np.ndarray, list[list[tuple[int, int, float]]]]:
        """``(features, passages)`` of every text."""
        rows, found = [], []
        for _, at, first in word_buckets(texts):
            s = self.score[at]
            size = np.diff(first)
            best = best_scores(s, first)
            top = np.where(best > 0, self.normal(best, size), -20.0)
            total = np.zeros(len(size))
            hits: list[list[tuple[int, int, float]]] = [[] for _ in size]
            for i in np.flatnonzero(top >= -np.log(E_VALUE)):
                hits[i] = self.passages(s[first[i] : first[i + 1]])
                total[i] = sum(x for _, _, x in hits[i])
            rows.append(np.column_stack([np.ones(len(size)), np.clip(top, -20, 40), np.log1p(np.maximum(total, 0))]))
            found += hits
        return (np.concatenate(rows) if rows else np.zeros((0, 3))), found

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weight, -30, 30)))


def log_odds(toxic: np.ndarray, clean: np.ndarray) -> np.ndarray:
    """Scores of the buckets from their counts."""
    both = toxic + clean
    prior = np.maximum(PRIOR * both, LEAST_PRIOR)
    a, b = toxic + prior, clean + prior
    odds = np.log(a / np.maximum(a.sum() - a, 1e-9)) - np.log(b / np.maximum(b.sum() - b, 1e-9))
    error = np.sqrt(1 / a + 1 / b)
    return (np.sign(odds) * np.maximum(0.0, np.abs(odds) - SHRINK * error) - DRIFT).astype(np.float32)


def decay(score: np.ndarray, share: np.ndarray) -> float:
    """lambda > 0 with E[exp(lambda s)] = 1 over clean words."""
    if not (share > 0).any() or (score[share > 0] <= 0).all():
        return 1.0
    s, p = score[share > 0].astype(float), share[share > 0]
    lo, hi = 1e-3, 20.0
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if (p * np.exp(np.minimum(mid * s, 500))).sum() < 1 else (lo, mid)
    return (lo + hi) / 2


def _counts(batches: Batches) -> Batches:
    for b in batches:
        group = np.asarray(b.column("fold")) * 2 + np.asarray(b.column("toxic"))
        parts = [
            np.repeat(group[i : i + len(first) - 1], np.diff(first)).astype(np.int64) * BUCKETS + at
            for i, at, first in word_buckets(b.column("text"))
        ]
        if not parts:
            continue
        at, n = np.unique(np.concatenate(parts), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n.astype(np.int64))], ["at", "n"])


def _best(models):
    def run(batches: Batches) -> Batches:
        for b in batches:
            fold = np.asarray(b.column("fold"))
            size, core = [], []
            for i, at, first in word_buckets(b.column("text")):
                own = fold[i : i + len(first) - 1]
                n = np.diff(first)
                best = np.zeros(len(n))
                for f, m in enumerate(models.value):
                    best = np.where(own == f, m.lam * best_scores(m.score[at], first), best)
                size.append(n)
                core.append(best - np.log(np.maximum(n, 1)))
            if size:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(core))], ["core"])

    return run


def _features(models):
    def run(batches: Batches) -> Batches:
        for b in batches:
            fold = np.asarray(b.column("fold"))
            out = np.zeros((b.num_rows, 3))
            for f, m in enumerate(models.value):
                own = np.flatnonzero(fold == f)
                if len(own):
                    out[own], _ = m.measure(b.column("text").take(pa.array(own)))
            yield pa.RecordBatch.from_arrays([pa.array(out[:, 1]), pa.array(out[:, 2]), b.column("toxic")], ["top", "total", "toxic"])

    return run


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weighted logistic regression by Newton steps."""
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        g = x.T @ (weight * (p - y)) + ridge * beta
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
        step = np.linalg.solve(h, g)
        beta = beta - step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def learned(
    docs: DataFrame, labels: DataFrame, where: Column | None = None, doc_id: str = "doc_id", text: str = "text",
    label: str = "toxic", per_class: int = PER_CLASS,
) -> Model:
    """A model from labelled texts whose id passes ``where`` (on ``doc_id``)."""
    spark = docs.sparkSession
    marks = pick(labels, doc_id=doc_id, toxic=label).select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
    marks = marks.filter("doc_id IS NOT NULL AND toxic IN (0, 1)")
    marks = (marks.filter(where) if where is not None else marks).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    size = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    zero = Model(np.zeros(BUCKETS, np.float32), 1.0, 1.0, np.asarray([-30.0, 0.0, 0.0]))
    if not size.get(1) or not size.get(0):
        return zero
    share = F.when(F.col("toxic") == 1, min(1.0, per_class / size[1])).otherwise(min(1.0, per_class / size[0]))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(909)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # At most about two rows of 12 bytes per text of the sample: a proven bound.
    chosen = F.broadcast(marks.filter(draw < share).limit(4 * per_class).withColumnRenamed("doc_id", "m_id"))
    src = pick(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("long"), "text")
    fold = F.pmod(F.xxhash64("text", F.lit(910)), F.lit(FOLDS)).cast("int").alias("fold")
    # An id is one example, however many rows repeat it: that of the least hash.
    met = src.join(chosen, F.col("doc_id") == F.col("m_id"))
    one = met.groupBy("m_id").agg(F.min_by(F.struct("text", "toxic"), F.xxhash64("text")).alias("r")).select("r.*")
    sample = written(one.select("text", "toxic", fold), "toxic-sample")
    # At most 2 * FOLDS * BUCKETS rows, whatever the corpus.
    table = map_arrow(sample, _counts, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(2 * FOLDS * BUCKETS)
    counts[table["at"].to_numpy()] = table["n"].to_numpy()
    counts = counts.reshape(FOLDS, 2, BUCKETS)
    del table
    pa.default_memory_pool().release_unused()

    def scores(c: np.ndarray) -> Model:
        score = log_odds(c[1], c[0])
        return Model(score, decay(score, c[0] / max(1.0, c[0].sum())), 1.0, zero.weight)

    whole = counts.sum(axis=0)
    model, folds = scores(whole), [scores(whole - c) for c in counts]
    send = spark.sparkContext.broadcast
    core = map_arrow(sample.filter("toxic = 0"), _best(send(folds)), "core double").toArrow()["core"].to_numpy()
    if len(core):  # the likeliest K, heavy scores of mislabelled texts left out
        core = core[core <= np.quantile(core, 0.95)]
        model.k = float(1 / max(1e-12, np.mean(np.exp(-np.clip(core, -30, 30)))))
    for m in folds:
        m.k = model.k
    got = map_arrow(sample, _features(send(folds)), "top double, total double, toxic int").toArrow()
    x = np.column_stack([np.ones(got.num_rows), got["top"].to_numpy(), got["total"].to_numpy()])
    y = got["toxic"].to_numpy().astype(float)
    # Each class counts as in all labelled rows, however it was sampled.
    weight = np.where(y == 1, size[1] / max(1, (y == 1).sum()), size[0] / max(1, (y == 0).sum()))
    model.weight = logistic(x, y, weight * len(y) / weight.sum()) if len(y) else zero.weight
    return model


def _score(model, threshold: float):
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Batches) -> Batches:
        m = model.value
        for b in batches:
            x, found = m.measure(b.column("text"))
            p = m.probability(x)
            spans = pa.array([[{"start": a, "end": e, "score": s} for a, e, s in f] for f in found], kind)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(p), pa.array((p >= threshold).astype(np.int32)), spans], ["doc_id", "score", "predicted", "passages"])

    return run


def scored(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, score, predicted, passages)`` per row; passages are spans of
    words with their normalised scores."""
    src = pick(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("long"), "text")
    send = docs.sparkSession.sparkContext.broadcast(model)
    return map_arrow(src, _score(send, threshold), "doc_id long, score double, predicted int, passages array<struct<start:int,end:int,score:double>>")
