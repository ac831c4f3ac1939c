"""Words, lines and hashes on Arrow batches against Python."""

import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexicount.llm import _words as w

TEXT = st.text(alphabet="ab é日😀 \t\n\r\x0b.", max_size=40)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def runs(texts, size=64):
    return list(w.runs(pa.array(texts, pa.string()), size))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=8))
def test_words_and_lines(texts):
    words, lines = [], []
    for i, j, t in runs(texts):
        assert t.n == j - i
        start, end, first = w.word_spans(t)
        for k in range(t.n):
            words.append([t.buf[a:b].tobytes().decode() for a, b in zip(start[first[k] : first[k + 1]], end[first[k] : first[k + 1]])])
        ls, le, lt = w.line_spans(t)
        for k in range(t.n):
            lines.append([t.buf[a:b].tobytes().decode() for a, b in zip(ls[lt == k], le[lt == k])])
    assert words == [WORD.findall(x or "") for x in texts]
    assert lines == [(x or "").split("\n") for x in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab😀", max_size=30), min_size=1, max_size=12))
def test_hashes_tell_words_apart(words):
    _, _, t = runs([" ".join(words)], 1 << 20)[0]
    start, end, _ = w.word_spans(t)
    got = w.hash_spans(t.buf, start, end)
    plain = WORD.findall(" ".join(words))
    assert len(set(got.tolist())) == len(set(plain))
    again = {}
    for x, h in zip(plain, got.tolist()):
        assert again.setdefault(x, h) == h


def test_windows_stay_inside_texts():
    _, _, t = runs(["a b c d", "", "e f", "g h i"], 1 << 20)[0]
    start, end, first = w.word_spans(t)
    _, pos = w.ngram_hashes(w.hash_spans(t.buf, start, end), first, 3)
    assert pos.tolist() == [0, 1, 6]


def test_repeats_and_copies():
    keys = np.array([5, 7, 5, 5, 9, 7], dtype=np.uint64)
    assert w.repeated(keys).tolist() == [True, True, True, True, False, True]
    assert w.later_copies(keys).tolist() == [False, False, True, True, False, True]


@pytest.mark.parametrize("texts", [[], [None], ["", ""], ["x" * 1000, "y"]])
def test_runs_cover_everything(texts):
    got = runs(texts, 10)
    assert [k for i, j, _ in got for k in range(i, j)] == list(range(len(texts)))


def test_few_long_spans_are_hashed_alike():
    """The last spans go without arrays: the same hashes, whatever the company."""
    rng = np.random.default_rng(2)
    buf = np.concatenate([rng.integers(0, 256, 4000, dtype=np.uint8), np.zeros(8, np.uint8)])
    end = rng.integers(0, 4001, 40)
    start = rng.integers(0, end + 1)
    whole = w.hash_spans(buf, start, end, 9)
    assert [w.hash_spans(buf, start[k : k + 1], end[k : k + 1], 9)[0] for k in range(40)] == whole.tolist()
    assert [x.tolist() for x in w.hashes_of_spans(buf, start, end, (9, 4))] == [whole.tolist(), w.hash_spans(buf, start, end, 4).tolist()]
