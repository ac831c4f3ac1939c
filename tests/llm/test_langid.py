"""Operator 7: training, held-out accuracy, calibration, rejection."""

import numpy as np
import pyarrow as pa
import pytest
from lexicount.llm import langid as g
from lexicount.llm import queries


LARGE = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def model(spark):
    return g.learned(spark.read.parquet(f"{LARGE}/documents.parquet"), where=~queries.held_out(4, 2))


def test_held_out_accuracy_and_calibration(spark, model):
    assert np.isfinite(model.table).all()
    docs = spark.read.parquet(f"{LARGE}/documents.parquet").filter(queries.held_out(4, 2)).select("text", "lang").toArrow()
    names, score, rejected = model.predict(docs["text"].combine_chunks())
    right = np.array([a == b for a, b in zip(names, docs["lang"].to_pylist())])
    assert right.mean() > 0.97 and abs(score.mean() - right.mean()) < 0.03
    assert rejected.mean() < 0.02
    assert set(names) <= {"en", "de", "fr", "es"}


def test_logits_are_averages_of_window_embeddings(model):
    text = "The éa  on\nof 12"
    body = " ".join(text.lower().replace("\n", " ").split(" ")).encode()
    body = bytes(0x30 if 0x30 <= c < 0x3A else c for c in body)
    total = np.zeros(len(model.labels))
    for n in g.WINDOWS:
        for k in range(len(body)):
            lane = int.from_bytes(body[k : k + n], "little")
            h = ((lane ^ (n << 56)) * 0x9E3779B97F4A7C15) % 2**64
            total += model.table[h >> (64 - 15)]
    got = model.logits(pa.array([text, "other text"]))[0]
    assert np.allclose(got, total / (len(body) * len(g.WINDOWS)) + model.bias, atol=1e-5)


def test_company_does_not_matter(model):
    texts = ["Der Hund und die Katze", "", None, "the thing", "x"]
    whole = model.predict(pa.array(texts))
    for k, t in enumerate(texts):
        one = model.predict(pa.array([t], pa.string()))
        assert one[0][0] == whole[0][k] and one[1][0] == pytest.approx(whole[1][k], abs=1e-6)


def test_unknown_and_rejected(model):
    names, score, rejected = model.predict(pa.array([None, "", " 123 ###", "日本語の文字です" * 20]))
    assert names[:3] == ["und"] * 3 and score[:3].tolist() == [0, 0, 0] and rejected[:3].all()
    assert names[3] in model.labels and 0 <= score[3] <= 1


def test_awkward_rows(spark, awkward, empty):
    m = g.learned(awkward)
    rows = g.predicted(awkward, m).collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
    letters = {r.doc_id for r in awkward.collect() if r.text and any(c.isalpha() for c in r.text)}
    assert all((r.lang_pred == "und") == (r.doc_id not in letters) for r in rows if r.doc_id is not None)
    kept = g.accepted(awkward, m)
    assert kept.columns == awkward.columns
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in awkward.collect() if str(r) in set(map(str, kept.collect())))
    none = g.learned(empty)
    assert none.labels == [] and g.predicted(awkward, none).filter("lang_pred <> 'und'").count() == 0
    assert g.predicted(empty, m).count() == 0


def test_training_does_not_depend_on_the_order(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").limit(200)
    a, b = g.learned(docs, per_label=30), g.learned(docs.repartition(5), per_label=30)
    assert np.array_equal(a.table, b.table) and a.threshold == b.threshold


def test_copies_are_one_example(spark, monkeypatch):
    name = lambda k: "".join("abcdefghij"[int(c)] for c in str(k))
    rows = [("a", "copied text")] * 3000 + [("a", f"text number {name(k)}") for k in range(300)]
    rows += [("b", "other")] * 300 + [("b", f"autre texte {name(k)}") for k in range(100)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    monkeypatch.setattr(g, "train", lambda examples: examples)
    one, two = g.learned(docs.repartition(3), per_label=150), g.learned(docs.repartition(7), per_label=150)
    key = [(x, b.tolist(), c.tolist()) for x, b, c in one]
    assert key == [(x, b.tolist(), c.tolist()) for x, b, c in two]
    labels = [x for x, _, _ in one]
    assert 90 < labels.count("a") < 220 and 90 <= labels.count("b") <= 101
    assert len({str(k) for k in key}) == len(key)


def test_long_training_on_noisy_labels_stays_finite():
    rng = np.random.default_rng(0)
    examples = []
    for k in range(600):
        lang = k % 3
        b = np.unique(np.concatenate([rng.integers(lang * 100, lang * 100 + 120, 60), rng.integers(0, g.BUCKETS, 60)]))
        noisy = f"l{rng.integers(3)}" if k % 10 == 0 else f"l{lang}"
        examples.append((noisy, b, np.full(len(b), 1 / len(b))))
    m = g.train(examples * 3)
    assert np.isfinite(m.table).all() and np.isfinite(m.bias).all() and 0 < m.threshold <= g.MOST_REJECT
    right = [m.labels[int((c @ m.table[b] + m.bias).argmax())] == f"l{k % 3}" for k, (_, b, c) in enumerate(examples)]
    assert np.mean(right) > 0.95


def many_labels(spark, labels=300, each=30):
    """Made-up languages: every one has syllables of its own."""
    import random

    rng = random.Random(1)
    rows = []
    for k in range(labels):
        own = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(3)) for _ in range(12)]
        rows += [(f"l{k:03d}", " ".join("".join(rng.choices(own, k=rng.randint(1, 3))) for _ in range(rng.randint(20, 200)))) for _ in range(each)]
    return spark.createDataFrame(rows, "lang string, text string").repartition(6)


def test_three_hundred_labels(spark):
    """All are learned; what reaches the driver is bounded whatever they are."""
    docs = many_labels(spark)
    bound = 600_000
    sample = g.sampled(docs, entries=bound).toArrow()
    sizes = sample["size"].to_numpy()
    assert sizes.sum() <= max(bound, 300 * g.BUCKETS) and len(set(sample["lang"].to_pylist())) == 300
    assert (sizes == [len(x) for x in sample["bucket"].to_pylist()]).all()
    m = g.learned(docs)
    assert len(m.labels) == 300 and m.head is not None and m.table.shape == (g.BUCKETS, 64)
    rows = docs.toArrow()
    names, _, _ = m.predict(rows["text"].combine_chunks())
    assert np.mean([a == b for a, b in zip(names, rows["lang"].to_pylist())]) > 0.9
    assert len(g.learned(docs, per_label=20, max_labels=7).labels) == 7


def test_the_smallest_draws_stay(spark):
    """A label's bags are cut to its share of the entries, in the order of draws."""
    docs = many_labels(spark, 4, 200)
    every = {k: [] for k in range(4)}
    for r in g.sampled(docs, per_label=10**6).collect():
        every[int(r.lang[1:])].append((r.draw, r.key, r["size"]))
    bound = 4 * g.BUCKETS
    for r in g.sampled(docs, per_label=10**6, entries=bound).groupBy("lang").agg({"size": "sum", "draw": "max"}).collect():
        total, last = 0, None
        for draw, _, size in sorted(every[int(r.lang[1:])]):
            if total + size > bound // 4:
                break
            total, last = total + size, draw
        assert (r["sum(size)"], r["max(draw)"]) == (total, last) and total > g.BUCKETS // 2


def test_averages_go_through_the_head(model):
    """With many labels a model keeps embeddings: the same logits."""
    rng = np.random.default_rng(5)
    head = rng.normal(size=(len(model.labels), len(model.labels)))
    table = model.table @ np.linalg.inv(head)
    other = g.Model(model.labels, table.astype(np.float64), model.bias, 1.0, 0.0, head)
    texts = pa.array(["Der Hund und die Katze", "", "the thing of it"])
    assert np.allclose(other.logits(texts), model.logits(texts), atol=1e-4)


def plain_training(examples, buckets, seed=7):
    """The same descent, number by number: embeddings, output weights, bias,
    each step scaled by the root of the squared gradients met so far."""
    import math

    labels = sorted({e[0] for e in examples})
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(examples)).tolist()
    held = order[: len(order) // 5] if len(order) >= 50 else []
    fit = [k for k in range(len(examples)) if k not in held]
    emb = rng.normal(0, 0.1, (buckets, g.DIM)).tolist()
    out = [[0.0] * len(labels) for _ in range(g.DIM)]
    bias = [0.0] * len(labels)
    s_emb, s_out, s_bias = [1e-12] * buckets, [[1e-12] * len(labels) for _ in range(g.DIM)], [1e-12] * len(labels)

    def logits(b, c):
        mean = [sum(x * emb[i][d] for i, x in zip(b, c)) for d in range(g.DIM)]
        return mean, [sum(mean[d] * out[d][y] for d in range(g.DIM)) + bias[y] for y in range(len(labels))]

    def shares(z):
        e = [math.exp(x - max(z)) for x in z]
        return [x / sum(e) for x in e]

    step, steps = 0, g.EPOCHS * len(fit)
    for _ in range(g.EPOCHS):
        for k in rng.permutation(fit).tolist():
            label, b, c = examples[k][0], examples[k][1].tolist(), examples[k][2].tolist()
            rate = g.RATE * (1 - step / steps)
            step += 1
            mean, z = logits(b, c)
            p = [x - (labels[y] == label) for y, x in enumerate(shares(z))]
            back = [sum(out[d][y] * p[y] for y in range(len(labels))) for d in range(g.DIM)]
            for d in range(g.DIM):
                for y in range(len(labels)):
                    s_out[d][y] += (mean[d] * p[y]) ** 2
                    out[d][y] -= rate * mean[d] * p[y] / math.sqrt(s_out[d][y])
            for y in range(len(labels)):
                s_bias[y] += p[y] ** 2
                bias[y] -= rate * p[y] / math.sqrt(s_bias[y])
            for i, x in zip(b, c):
                s_emb[i] += x * x * sum(v * v for v in back)
                for d in range(g.DIM):
                    emb[i][d] -= rate * x * back[d] / math.sqrt(s_emb[i])
    return labels, held or fit, logits, shares, emb, out, bias


def test_training_number_by_number(monkeypatch):
    buckets = 64
    monkeypatch.setattr(g, "BUCKETS", buckets)
    rng = np.random.default_rng(11)
    examples = []
    for k in range(90):
        y = k % 3
        b = np.unique(np.concatenate([rng.integers(y * 20, y * 20 + 24, 8), rng.integers(0, buckets, 4)]))
        c = rng.integers(1, 5, len(b)).astype(np.float64)
        examples.append((f"l{(y + (k % 11 == 0)) % 3}", b, c / c.sum()))
    m = g.train(examples)
    labels, held, logits, shares, emb, out, bias = plain_training(examples, buckets)
    assert m.labels == labels
    assert np.allclose(m.table, np.asarray(emb) @ np.asarray(out), atol=1e-5) and np.allclose(m.bias, bias, atol=1e-8)
    # The temperature is that of the least loss on what was held back, the
    # threshold what rejects its share of those named rightly.
    z = [logits(examples[k][1].tolist(), examples[k][2].tolist())[1] for k in sorted(held)]
    y = [labels.index(examples[k][0]) for k in sorted(held)]
    loss = lambda t: -sum(np.log(shares([v / t for v in row])[i]) for row, i in zip(z, y)) / len(y)
    heats = np.exp(np.linspace(-2, 3, 101))
    assert m.temperature == pytest.approx(min(heats, key=loss))
    right = [max(p) for p, i in ((shares([v / m.temperature for v in row]), i) for row, i in zip(z, y)) if max(p) == p[i]]
    assert m.threshold == pytest.approx(min(g.MOST_REJECT, np.quantile(right, g.REJECT_SHARE)), abs=1e-6)
