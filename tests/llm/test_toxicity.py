"""Operator 9: segments, calibration, held-out results."""

import brute
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from lexicount.llm import queries
from lexicount.llm import toxicity as t

SCORES = st.lists(st.sampled_from([-2.0, -1.0, -0.5, 0.5, 1.0, 1.5, 3.0]), max_size=14)


@settings(max_examples=200, deadline=None)
@given(SCORES)
def test_all_maximal_segments(s):
    x = np.asarray(s, dtype=np.float32)
    got, want = t.segments(x), brute.segments(s)
    assert got == want
    for a, b, v in got:
        assert v == pytest.approx(x[a:b].sum()) and v > 0
    assert all(a[1] <= b[0] for a, b in zip(got, got[1:]))


@settings(max_examples=100, deadline=None)
@given(st.lists(SCORES, max_size=6))
def test_best_scores(texts):
    s = np.asarray([v for x in texts for v in x], dtype=np.float32)
    first = np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(int)
    want = [max([sum(x[a:b]) for a in range(len(x)) for b in range(a + 1, len(x) + 1)] + [0]) for x in texts]
    assert t.best_scores(s, first) == pytest.approx(want)


def test_extreme_value_law():
    """Best scores of random clean texts exceed a level as often as the law says."""
    rng = np.random.default_rng(0)
    score, share = np.array([-1.0, 2.0]), np.array([0.85, 0.15])
    lam = t.decay(score, share)
    assert (share * np.exp(lam * score)).sum() == pytest.approx(1, abs=1e-6)
    n, texts = 300, 4000
    s = rng.choice(score, n * texts, p=share).astype(np.float32)
    best = t.best_scores(s, np.arange(0, n * texts + 1, n))
    k = 1 / np.mean(np.exp(-(lam * best - np.log(n))))
    for level in np.quantile(best, [0.5, 0.9, 0.99]):
        law = 1 - np.exp(-k * n * np.exp(-lam * (level + 0.5)))
        assert (best > level).mean() == pytest.approx(law, abs=0.05)


def test_log_odds_shrink_what_is_rare():
    toxic, clean = np.zeros(t.BUCKETS), np.full(t.BUCKETS, 1.0)
    clean[:100], toxic[:100] = 1000, 200
    toxic[5] = 4000
    toxic[7000] = 1
    s = t.log_odds(toxic, clean)
    assert s[5] > 1 and s[7000] < 0 and s[6] < s[5] / 2


@pytest.fixture(scope="module")
def large(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    return docs, labels, t.learned(docs, labels, where=~queries.held_out(3, 1))


def test_held_out_results(large):
    docs, labels, model = large
    got = t.scored(docs, model).join(labels.filter(queries.held_out(3, 1)), "doc_id").select("score", "predicted", "toxic").toPandas()
    rank = got.score.rank()
    pos = got.toxic == 1
    auc = (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())
    assert auc > 0.95
    assert got[pos].predicted.mean() > 0.7 and got[~pos].predicted.mean() < 0.02
    assert ((got.score >= t.THRESHOLD) == (got.predicted == 1)).all() and got.score.between(0, 1).all()


def test_passages_are_where_the_words_are(large):
    _, _, model = large
    clean = "the and of thing stand " * 60
    x, found = model.measure(pa.array([clean, clean + " idiot scum trash clown worthless pathetic " + clean, "", None]))
    assert found[0] == [] and len(found[1]) >= 1 and found[2] == found[3] == []
    a, b, _ = max(found[1], key=lambda f: f[2])
    assert a >= 295 and b <= 311
    p = model.probability(x)
    assert p[1] > 0.7 > p[0] and ((0 <= p) & (p <= 1)).all()


def test_awkward_rows(spark, awkward, empty):
    labels = spark.createDataFrame(
        [(k, 1 if k % 2 else 0, "x") for k in range(20)] + [(None, 1, "x"), (3, None, "x"), (4, 7, None), (5, 0, "y")], "doc_id long, toxic int, text string"
    )
    for m in (t.learned(awkward, labels), t.learned(awkward, labels.limit(0)), t.learned(empty, labels)):
        rows = t.scored(awkward, m).collect()
        assert len(rows) == awkward.count()
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= t.THRESHOLD) for r in rows)
        assert t.scored(empty, m).count() == 0


def test_an_id_is_one_example(spark, monkeypatch):
    """However many rows repeat a labelled id, the sample has one of them."""
    rows = [(1, f"some bad words here {k}") for k in range(400)] + [(k, f"clean words number {k}") for k in range(2, 40)] + [(2, None), (None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(k, int(k % 9 == 1)) for k in range(40)], "doc_id long, toxic int")
    kept, real = [], t.written
    monkeypatch.setattr(t, "written", lambda df, label: kept.append(real(df, label)) or kept[-1])
    a, b = t.learned(docs, labels), t.learned(docs.repartition(7), labels)
    assert sorted(r.toxic for r in kept[0].collect()) == sorted(int(k % 9 == 1) for k in range(1, 40))
    assert sorted(map(str, kept[0].collect())) == sorted(map(str, kept[1].collect()))
    assert np.allclose(a.score, b.score)
