"""Operator 2: signatures, candidates, classes."""

import random

import brute
import numpy as np
import pytest
from lexicount.llm import bagminhash as b


def class_sets(rows):
    out = {}
    for i, c in rows:
        out.setdefault(c, set()).add(i)
    return sorted(map(sorted, out.values()))


def check(spark, docs, **options):
    rows = docs.select("doc_id", "text").collect()
    got = b.classes(docs, **options)
    found = got.collect()
    assert len(found) == len(rows)
    want = brute.classes([r.text for r in rows])
    by_key = {}
    import hashlib

    for r in found:
        by_key[r.tkey] = (r.class_tkey, r.class_id, r.rep_id)
    least, rep = {}, {}
    for r, c in zip(rows, want):
        for d, k in ((least, c), (rep, r.text or "")):
            d.setdefault(k, None)
            if r.doc_id is not None and (d[k] is None or r.doc_id < d[k]):
                d[k] = r.doc_id
    for r, c in zip(rows, want):
        _, cid, rid = by_key[hashlib.md5((r.text or "").encode()).digest()]
        assert (cid, rid) == (least[c], rep[r.text or ""])
    assert len({v[0] for v in by_key.values()}) == len(set(want))


def test_weighted_jaccard_is_unbiased():
    """Agreement of registers against sum(min)/sum(max) of random multisets."""
    rng = np.random.default_rng(1)
    for weights in (2, 7, 40):
        sim, est = [], []
        for trial in range(12):
            keys = rng.integers(1, 2**62, 30).astype(np.uint64)
            x, y = rng.integers(0, weights, (2, 30))
            h, o, c = [], [], []
            for k, v in enumerate((x, y)):
                on = v > 0
                order = np.argsort(keys[on])
                h.append(keys[on][order])
                c.append(v[on][order])
                o.append(np.full(on.sum(), k))
            s = b.signatures(np.concatenate(h), np.concatenate(o), np.concatenate(c), 2, 512)
            est.append((s[0] == s[1]).mean())
            sim.append(np.minimum(x, y).sum() / np.maximum(x, y).sum())
        assert abs(np.mean(est) - np.mean(sim)) < 0.03, weights
        assert np.abs(np.array(est) - sim).max() < 0.12


def test_signature_does_not_depend_on_company():
    import pyarrow as pa
    from lexicount.llm import _words as w

    texts = ["a b c d e f g a b c d e f g", "x y", "", "p q r s t u v w"]

    def sig(some):
        _, _, t = next(w.runs(pa.array(some)))
        return b.signatures(*b.bags(*b.shingles(t)), t.n, 64)

    whole = sig(texts)
    for k, x in enumerate(texts):
        assert (sig([x])[0] == whole[k]).all()
    assert not whole[2].any()


def test_awkward_rows(spark, awkward):
    check(spark, awkward)


def test_whole_table(spark, data):
    check(spark, spark.read.parquet(f"{data}/documents.parquet"))


def near_group(n=150, seed=2, edits=8):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(5))
    base = [word() for _ in range(150)]
    rows = []
    for k in range(n):
        x = list(base)
        for _ in range(rng.randint(0, edits)):
            x[rng.randrange(len(x))] = word()
        rows.append((k, " ".join(x)))
    chain = [word() for _ in range(120)]
    for k in range(12):  # each similar to the one before, the ends not to each other
        rows.append((1000 + k, " ".join(chain)))
        chain = chain[3:] + [word() for _ in range(3)]
    return rows


def test_large_group_and_chain(spark):
    check(spark, spark.createDataFrame(near_group(), "doc_id long, text string"))


@pytest.mark.parametrize("options", [{"block": 7}, {"block": 1}, {"block_shingles": 700}])
def test_buckets_in_many_blocks(spark, options):
    check(spark, spark.createDataFrame(near_group(edits=30), "doc_id long, text string"), **options)


def related(n, common=230, own=35, seed=4):
    """Texts under the similarity to all others, though they share their bands."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    base = [word() for _ in range(common)]
    return [(k, " ".join(base + [word() for _ in range(own)])) for k in range(n)]


def test_related_texts_make_no_rows(spark):
    """Thousands of texts just under the similarity, with a few true copies."""
    rows = related(3000)
    rows += [(5000 + k, rows[40 * k][1] + " end") for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = {}
    for r in b.classes(docs, block=700).collect():
        got.setdefault(r.class_id, set()).add(r.doc_id)
    assert sorted(map(sorted, (v for v in got.values() if len(v) > 1))) == [[40 * k, 5000 + k] for k in range(20)]


def test_links_against_plain_overlaps():
    """Every class that the matrices find, and no other."""
    rng = np.random.default_rng(3)
    from lexicount.llm import _blocks

    for trial in range(60):
        n, base = int(rng.integers(2, 40)), rng.integers(0, 2**60, 30).astype(np.uint64)
        each = [np.unique(np.concatenate([base[rng.random(30) < 0.9], rng.integers(0, 50, rng.integers(0, 6)).astype(np.uint64)])) for _ in range(n)]
        off = np.concatenate([[0], np.cumsum([len(x) for x in each])])
        cls = rng.integers(0, max(2, n // 2), n)
        order = np.argsort(cls, kind="stable")
        cut = n // 2
        for one, two in ((order, order), (order[order < cut], order[order >= cut])):
            if not len(one) or not len(two):
                continue
            got, want = _blocks.Union(), _blocks.Union()
            old = (_blocks.CELLS, _blocks.COLUMNS, _blocks.DENSE)
            _blocks.CELLS, _blocks.COLUMNS, _blocks.DENSE = [(1 << 20, 1024, 1 / 200), (17, 3, 0.3), (40, 5, 2.0)][trial % 3]
            try:
                found = _blocks.joining_links(np.concatenate(each), off, cls, one, two, 0.7)
            finally:
                _blocks.CELLS, _blocks.COLUMNS, _blocks.DENSE = old
            for x, y in found:
                both = len(np.intersect1d(each[x], each[y]))
                assert both / (len(each[x]) + len(each[y]) - both) >= 0.7 and cls[x] != cls[y]
                got.join(int(cls[x]), int(cls[y]))
            for x in one:
                for y in two:
                    both = len(np.intersect1d(each[x], each[y]))
                    if x != y and both / max(1, len(each[x]) + len(each[y]) - both) >= 0.7:
                        want.join(int(cls[x]), int(cls[y]))
            assert [got.top(int(c)) for c in cls] == [want.top(int(c)) for c in cls]


def test_candidates_against_plain_sketches():
    import pyarrow as pa
    from lexicount.llm import _blocks

    rng = np.random.default_rng(8)
    rows = []
    for bucket in range(30):
        size = int(rng.integers(1, 60))
        crossed = bool(rng.random() < 0.5)
        for _ in range(size):
            side = int(crossed and rng.random() < 0.5)
            rows.append((bucket, 0, int(crossed), side, len(rows), int(rng.integers(0, 4)), int(rng.integers(8, 12)), int(rng.integers(0, 2**20))))
    rows.sort(key=lambda r: (r[:4], r[4]))
    names = ["bucket", "i", "j", "side", "id", "class", "n_shingles", "s0"]
    table = pa.table({c: pa.array([r[k] for r in rows], pa.int64()) for k, c in enumerate(names)})
    out = set()
    for batch in _blocks.candidates(["s0"], 0.8, 3)(iter(table.to_batches(max_chunksize=37))):
        out |= set(batch.column("id").to_pylist())
    want = set()
    for x in rows:
        for y in rows:
            nibbles = sum(((x[7] >> (4 * k)) & 15) != ((y[7] >> (4 * k)) & 15) for k in range(16))
            if x[:3] == y[:3] and x[5] != y[5] and (x[2] == 0 or x[3] != y[3]) and min(x[6], y[6]) >= 0.8 * max(x[6], y[6]) and nibbles <= 3:
                want.add(x[4])
    assert out == want and 0 < len(want) < len(rows)


def test_repeats_count_as_often_as_they_stand(spark):
    one = " ".join(f"w{k}" for k in range(40))
    rows = [(1, one), (2, one + " " + one), (3, one + " z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in b.classes(docs).collect()} == {1: 1, 2: 2, 3: 1}


def test_one_document_of_each_class(spark, awkward, empty):
    got = b.deduplicated(awkward)
    assert got.columns == awkward.columns
    texts = [r.text for r in awkward.collect()]
    assert got.count() == len(set(brute.classes(texts)))
    rows = {str(r) for r in awkward.collect()}
    assert all(str(r) in rows for r in got.collect())
    assert b.deduplicated(empty).count() == 0 and b.classes(empty).count() == 0


@pytest.mark.parametrize("similarity", [0.8, 0.9])
def test_sketches_keep_similar_texts(similarity):
    """Of pairs at the similarity hardly one falls to the sketch."""
    m = b.BANDS * b.ROWS
    p = similarity + (1 - similarity) / 16
    rng = np.random.default_rng(0)
    assert (rng.binomial(m, 1 - p, 200_000) > b.most_unequal(similarity, m)).mean() < 5e-4
    sig = rng.integers(0, 2**62, (50, m)).astype(np.uint64)
    words = b.sketches(sig)
    bits = [[(int(x) >> (4 * k)) & 15 for x in row.view(np.uint64) for k in range(16)] for row in words]
    assert len(bits[0]) >= m and bits[0] != bits[1]
