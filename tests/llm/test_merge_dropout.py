"""Operator 5: merges under dropout, decoding."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from lexicount.llm import _words as w
from lexicount.llm import merge_dropout as d

TEXT = st.text(alphabet="the andtoing é日😀▁ \n\t<s>", max_size=60)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(d.VOCABULARY))


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXT, max_size=6), st.integers(0, 5), st.sampled_from([0.0, 0.1, 0.5, 1.0]))
def test_decoding_gives_the_text_back(texts, seed, dropout):
    got = d.encode(pa.array(texts, pa.string()), seed, dropout)
    assert [d.decode(x) for x in got] == texts


def test_without_dropout_as_the_library(spark, data, library):
    texts = [r.text for r in spark.read.parquet(f"{data}/documents.parquet").limit(150).collect()]
    texts += ["", " ", "  a", "a  b ", "x" * 300 + " " + "ab" * 200, " " * 90 + "z", "日本語 文字", "<s> </s> <unk>", "a\x00b"]
    got = d.encode(pa.array(texts), dropout=0.0)
    assert [x.tolist() for x in got] == library.encode(texts)


def test_same_as_the_plainest_agenda():
    v = d.vocabulary_of(d.VOCABULARY)
    rng = np.random.default_rng(0)
    for dropout in (0.0, 0.2, 0.7):
        for _ in range(40):
            text = " " + "".join(rng.choice(list("theandiongsr"), rng.integers(1, 14)))
            sym = [int(v.char[ord(c)]) for c in text]
            key = np.asarray([rng.integers(1 << 62)], dtype=w.U64)

            def pairs(a, b):
                r, t = v.pairs(np.asarray([a]), np.asarray([b]))
                return (int(r[0]), int(t[0])) if r[0] < d._NONE else None

            def skip(s, m, e):
                return bool(d.skipped(key, d.spans(*(np.asarray([x]) for x in (s, m, e))), dropout)[0])

            want = brute.merge(sym, pairs, skip)
            assert d.agenda(v, sym, int(key[0]), dropout) == want
            n = len(sym)
            got, _, _ = d.merge_units(v, np.asarray(sym), np.zeros(n, int), np.arange(n), np.arange(1, n + 1), key, dropout)
            assert got.tolist() == want


def by_agenda(text, seed, dropout):
    """Unit by unit with the heap, nothing remembered."""
    v = d.vocabulary_of(d.VOCABULARY)
    (_, _, t), = w.runs(pa.array([" " + text] if text else [""]), 1 << 20)
    body = w.hash_spans(t.buf, t.off[:-1], t.off[1:], 512)
    out = []
    for place, unit in enumerate(re.findall(" +[^ ]*", " " + text) if text else []):
        with np.errstate(over="ignore"):
            key = w.keyed(w.mix(body + w.U64(place)), seed)
        sym = [int(v.char[ord(c)]) for c in unit]
        at = 0
        for i in d.agenda(v, sym, int(key[0]), dropout):
            raw = unit[at].encode() if i < 0 else None
            out += [i] if raw is None else [int(v.byte[b]) for b in raw]
            at += 1 if i < 0 else int(d._chars(v)[i])
    return out


@pytest.mark.parametrize("dropout", [0.0, 0.05, 0.3, 1.0])
def test_remembered_merges_change_nothing(dropout):
    rng = random.Random(4)
    some = ["standing", "the", "nation", "é", "▁x", "日本", "antidisestablishment" * 4, "", "a", "😀s"]
    texts = [" ".join(rng.choice(some) for _ in range(rng.randint(0, 30))) for _ in range(60)]
    want = [by_agenda(x, 3, dropout) for x in texts]
    for _ in range(2):  # from an empty memory, then from a full one
        assert [x.tolist() for x in d.encode(pa.array(texts), 3, dropout)] == want
    old, d.MEMO_UNITS = d.MEMO_UNITS, 3
    d.vocabulary_of.cache_clear()
    try:
        assert [x.tolist() for half in (texts[:30], texts[30:]) for x in d.encode(pa.array(half), 3, dropout)] == want
    finally:
        d.MEMO_UNITS = old
        d.vocabulary_of.cache_clear()


def test_units_with_equal_hashes_stay_apart():
    key, check = np.asarray([5, 5, 7, 5], dtype=w.U64), np.asarray([1, 2, 1, 1], dtype=w.U64)
    one, back, times = d._distinct(key, check)
    assert len(one) == 3 and back[0] == back[3] != back[1] and sorted(times.tolist()) == [1, 1, 2]
    memo = d.Plain()
    memo.key, memo.check = key[2:3], check[2:3]
    assert memo.find(key, check).tolist() == [-1, -1, 0, -1]


def test_long_units_take_their_time_by_length():
    import time

    rng = random.Random(2)
    spent = []
    for n in (20_000, 80_000):
        text = pa.array(["".join(rng.choice("theandiongsr") for _ in range(n))])
        began = time.process_time()
        d.encode(text, 1, 0.1)
        spent.append(time.process_time() - began)
    assert spent[1] < 12 * spent[0] + 1


def test_seeds_vary_and_repeat():
    text = pa.array(["the nation of the ending stand thing " * 40])
    one, again, other = (d.encode(text, s, 0.2)[0].tolist() for s in (1, 1, 2))
    assert one == again != other
    plain = d.encode(text, dropout=0.0)[0].tolist()
    assert len(plain) < len(one)
    variants = {tuple(d.encode(pa.array(["x " * k + "standing"]), 1, 0.5)[0][-8:].tolist()) for k in range(30)}
    assert len(variants) > 1
    # All merges skipped: one id for every character of the vocabulary.
    assert len(d.encode(pa.array(["abc de"]), 1, 1.0)[0]) == 7


def test_share_of_skipped_candidates():
    n = 200_000
    unit = w.keyed(np.arange(n, dtype=w.U64), 3)
    hit = d.skipped(unit, d.spans(np.zeros(n, int), np.ones(n, int), np.full(n, 2)), 0.1)
    assert abs(hit.mean() - 0.1) < 0.005


def test_every_occurrence_of_a_word_draws_anew():
    v = d.vocabulary_of(d.VOCABULARY)
    rng = np.random.default_rng(5)
    n, drawn = 8000, 2000

    def pairs(a, b):
        r, t = v.pairs(np.asarray([a]), np.asarray([b]))
        return (int(r[0]), int(t[0])) if r[0] < d._NONE else None

    for word, dropout in (("a", 0.1), ("standing", 0.1), ("standing", 0.5)):
        texts = pa.array([" ".join([word] * 400)] * 2 + [f"{k} " + " ".join([word] * 399) for k in range(n // 400)])
        one, same, *rest = d.encode(texts, 1, dropout)
        assert one.tolist() == same.tolist()
        got = Counter()
        for ids in rest:
            # A unit starts with the piece that starts with a space.
            opens = np.flatnonzero(v.body[v.at[ids]] == 0x20).tolist()
            for lo, hi in zip(opens[1:], [*opens[2:], len(ids)], strict=True):
                got[tuple(ids[lo:hi].tolist())] += 1
        # As often as when every candidate is left out by a coin of its own.
        want = Counter()
        sym = [int(v.char[ord(c)]) for c in " " + word]
        for _ in range(drawn):
            coins = defaultdict(lambda: rng.random() < dropout)
            want[tuple(brute.merge(sym, pairs, lambda *span, coins=coins: coins[span]))] += 1
        plain = tuple(d.encode(pa.array([word]), dropout=0.0)[0].tolist())
        total = sum(got.values())
        assert abs(got[plain] / total - want[plain] / drawn) < 0.05
        assert len(got) >= 0.9 * len(want)
        common = [x for x, k in want.items() if k > drawn / 100]
        assert all(abs(got[x] / total - want[x] / drawn) < 0.05 for x in common)
        assert word == "a" or len(got) > 8


def test_awkward_rows(awkward, empty):
    rows = d.segmented(awkward, with_ids=True).collect()
    texts = [r.text or "" for r in awkward.collect()]
    assert all(r.lossless for r in rows)
    assert sorted(r.decoded_sha256 for r in rows) == sorted(hashlib.sha256(t.encode()).hexdigest() for t in texts)
    assert all(len(r.ids) == r.n_tokens for r in rows)
    assert sorted(d.decode(r.ids) if r.ids else "" for r in rows) == sorted(texts)
    assert d.segmented(empty).count() == 0


def test_whole_table(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    got = d.segmented(docs)
    assert got.count() == docs.count() and got.filter("NOT lossless").count() == 0
    right = {r.doc_id: r.h for r in docs.selectExpr("doc_id", "sha2(text, 256) AS h").collect()}
    assert {r.doc_id: r.decoded_sha256 for r in got.collect()} == right
