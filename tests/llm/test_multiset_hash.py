"""Operator 4: equality, order, insertion and deletion, likeness, next documents."""

import hashlib
import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from lexicount.llm import multiset_hash as m

PARTS = [f"paragraph {k} has its own words." for k in range(12)]


def fp(*texts):
    return m.fingerprints(pa.array(texts, pa.string()))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=10), st.randoms())
def test_order_is_immaterial_and_counts_matter(parts, rng):
    other = list(parts)
    rng.shuffle(other)
    a, b = fp("\n".join(parts), "\n\n ".join(other))
    assert (a == b).all()
    if parts:
        (c,) = fp("\n".join([*parts, parts[0]]))
        assert (a != c).any()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=8), st.lists(st.sampled_from(PARTS), max_size=8))
def test_insertion_and_deletion(a, b):
    whole = fp("\n".join(a + b))
    assert (m.combine(fp("\n".join(a)), fp("\n".join(b))) == whole).all()
    assert (m.combine(whole, fp("\n".join(b)), -1) == fp("\n".join(a))).all()


def test_paragraphs_are_lines_and_sentences():
    same = fp("One two. Three four!\nFive", "Five\nThree  four!\tOne two.", "Three four! One two.\r\n\r\nFive")
    assert (same == same[0]).all()
    assert (fp("One two.Three") != fp("One two. Three")).any()
    assert not fp("", " \n ", None).any()


def test_likeness_follows_the_shared_share():
    rng = np.random.default_rng(4)
    errors = []
    for _ in range(60):
        n, both = 60, int(rng.integers(0, 61))
        own = [f"{rng.integers(1 << 60)} x." for _ in range(2 * n)]
        a, b = own[:n], own[:both] + own[n : 2 * n - both]
        errors.append(m.likeness(fp("\n".join(a)), fp("\n".join(b)))[0] - both / n)
    assert abs(np.mean(errors)) < 0.05 and np.abs(errors).max() < 0.45
    assert m.likeness(fp("a"), fp("a"))[0] == 1 and m.likeness(fp(""), fp(None))[0] == 1
    assert 0 <= m.likeness(fp("a"), fp(""))[0] <= 1


def test_a_line_that_stands_very_often():
    line, n = "one line again\n", 40_000
    a, b = fp(line * n), fp(line * (2 * n // 3))
    assert abs(m.likeness(a, b)[0] - (1 - (n / 3) ** 2 / (n**2 + (2 * n / 3) ** 2))) < 0.001
    assert (m.combine(a, b, -1) == fp(line * (n - 2 * n // 3))).all()


def test_sentences_end_in_any_script():
    for one, two in (('He said "go."', "Then left."), ("(Yes!)", "No."), ("क ख।", "ग घ।"), ("«Oui?»", "Non.")):
        assert (fp(f"{one} {two}") == fp(f"{two} {one}")).all()
    assert (fp("一二。三四！」五六。") == fp("五六。三四！」一二。")).all()
    assert (fp("a. b c") != fp("a. c b")).any() and (fp("「一二」三四") != fp("三四「一二」")).any()


def test_long_texts_without_stops_are_found_again():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    sign = lambda: chr(rng.randrange(0x4E00, 0x9000))
    kinds = (
        lambda: " ".join(word() for _ in range(900)),
        lambda: "".join(sign() for _ in range(2000)),
        lambda: "".join(word() for _ in range(600)),
    )
    for kind in kinds:
        text, after = kind(), " ".join(word() for _ in range(2000))
        a, b, c = fp(text, m.edit(text, after), "new start here " + text)
        assert m.likeness(a[None], b[None])[0] > 0.4 and m.likeness(a[None], c[None])[0] > 0.8
    for text in ("x" * 20_000, "again and " * 2000):
        ((_, _, t),) = m.w.runs(pa.array([text]))
        whole, parts = m.paragraphs(t)
        assert len(whole[0]) == 1 and len(parts[0]) > 5
    # Parts leave equality alone: words in another order are another text.
    text = [word() for _ in range(200)]
    assert (fp(" ".join(text)) != fp(" ".join(text[100:] + text[:100]))).any()
    assert (fp("x" * 100) != fp("x" * 64 + " " + "x" * 36)).any()


def test_paragraphs_are_told_apart_by_128_bits(monkeypatch):
    """Words whose hash under one of the keys is forced to be the same."""
    real = m.w.hashes_of_spans
    for same in range(len(m.WORD_KEYS)):
        def forced(buf, start, end, keys, same=same):
            out = real(buf, start, end, keys)
            out[same] = np.full(len(start), 12345, dtype=m.w.U64)
            return out

        monkeypatch.setattr(m.w, "hashes_of_spans", forced)
        a, b = fp("one paragraph here."), fp("two paragraphs there.")
        lanes = [x[0, : 4 * m.EXACT].reshape(len(m.WORD_KEYS), -1) for x in (a, fp("one, paragraph here."), b)]
        # The lanes under that key agree, those under the other do not.
        assert (lanes[0][same] == lanes[1][same]).all() and (lanes[0][1 - same] != lanes[1][1 - same]).any()
        assert (a != fp("one, paragraph here.")).any()
    monkeypatch.setattr(m.w, "hashes_of_spans", real)
    assert (fp("one paragraph here.")[0, : 4 * m.EXACT] != 0).all()


def test_one_id_over_many_ranges(spark):
    """A third of the rows under one id, a third without: cut by their texts."""
    rows = [(7 if k % 3 == 0 else None if k % 3 == 1 else k, f"text {k} here.") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(m.edited_likeness(docs, ranges=30)) == expected(rows)


def expected(rows):
    """By descending id, greater text key first, null ids last."""
    key = lambda r: (r[0] is not None, r[0] or 0, hashlib.md5((r[1] or "").encode()).digest())
    rows = sorted(rows, key=key, reverse=True)
    out = []
    for k, (i, t) in enumerate(rows):
        t, n = t or "", rows[(k + 1) % len(rows)][1] or ""
        q = len(t) // 3
        e = t[: len(t) - q] + n[:q]
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), m.strings(fp(t))[0], m.strings(fp(e))[0], round(float(m.likeness(fp(t), fp(n))[0]), 9)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_next, 9)) for r in df.collect()), key=str)


def test_awkward_rows(awkward, empty):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    for ranges in (None, 1, 5, 200):
        assert got(m.edited_likeness(awkward, ranges=ranges)) == expected(rows)
    assert m.edited_likeness(empty).count() == 0
    assert m.edited_likeness(awkward.filter("doc_id = 4")).first().near_next == 1
    assert sorted((r.fingerprint for r in m.fingerprinted(awkward).collect())) == sorted(m.strings(fp(*[t for _, t in rows])))


def test_whole_table(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    df = m.edited_likeness(docs, ranges=10)
    assert got(df) == expected(rows)
    r = df.selectExpr("avg(near_edited)", "avg(near_next)").first()
    assert r[0] > 0.5 > 0.1 > r[1]


def test_large_ids(spark):
    rng = random.Random(1)
    rows = [(rng.choice([-1, 1]) * rng.randrange(2**62) if k else -(2**63), f"text {k}") for k in range(60)] + [(2**63 - 1, "last"), (2**53, "a"), (2**53 + 1, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(m.edited_likeness(docs, ranges=12)) == expected(rows)
