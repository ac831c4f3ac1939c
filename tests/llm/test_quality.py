"""Operator 1: base figures, line frequencies, depletion."""

import random

import brute
from lexicount.llm import quality


def figures(df):
    return {
        (r.doc_id, r.host, r.tkey): tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_words", "base_failed", "kept"))
        for r in df.collect()
    }


def check(spark, docs, **limits):
    import hashlib

    rows = [(r.doc_id, r.source, r.text) for r in docs.select("doc_id", "source", "text").collect()]
    want = brute.quality(rows, limits["min_docs"], limits["max_share"], limits["min_left"])
    verdict, _ = quality.verdicts(docs, **limits)
    got = figures(verdict)
    assert verdict.count() == len(rows)
    for i, host, text in rows:
        key = (i, host, hashlib.md5((text or "").encode()).digest())
        assert got[key] == want[host, text or ""][:-1], (i, host)
    return rows, want


LIMITS = {"min_docs": 2, "max_share": 0.0, "min_left": 0.5}


def test_awkward_rows(spark, awkward):
    check(spark, awkward, **LIMITS)


def test_whole_table(spark, data):
    check(spark, spark.read.parquet(f"{data}/documents.parquet"), **LIMITS)


def lined(spark):
    """Hosts whose documents share lines, copies and near copies among them."""
    rng = random.Random(3)
    w = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))
    common = [w(12) for _ in range(4)]
    rows = []
    for k in range(60):
        own = [w(15) for _ in range(5)]
        some = [common[j] for j in range(4) if k % (j + 1) == 0]
        body = [*own[:2], *some, *own[2:], *([some[0].upper() + "  "] if some and k % 7 == 0 else [])]
        rows.append((k, "\n".join(body if k % 5 else [*common, w(3)]), "x" if k % 3 else "y", len("\n".join(body)), k * 2))
    rows += [(100 + k, rows[10][1], "x", 0, 0) for k in range(8)]  # copies: one document
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int, removed long")


def test_shared_lines(spark):
    docs = lined(spark)
    rows, want = check(spark, docs, **{**LIMITS, "min_docs": 5})
    assert any(v[5] and v[-2] for v in want.values()) and any(v[5] and not v[-2] for v in want.values())
    got = quality.clean(docs, **{**LIMITS, "min_docs": 5})
    assert got.schema == docs.schema
    left = sorted((r.doc_id, r.text, r.n_chars) for r in got.collect())
    source = {r.doc_id: r for r in docs.collect()}
    expect = []
    for i, host, text in rows:
        w = want[host, text]
        if w[-2]:
            expect.append((i, w[-1], len(w[-1]) if w[-1] != text else source[i].n_chars))
    assert left == sorted(expect)


def test_clean_keeps_columns_and_clean_rows(spark, awkward, empty):
    got = quality.clean(awkward)
    assert got.columns == awkward.columns
    kept = sorted(map(str, got.collect()))
    every = sorted(map(str, awkward.collect()))
    assert kept and set(kept) <= set(every)
    assert quality.clean(empty).count() == 0 and quality.verdicts(empty)[0].count() == 0


def test_copies_count_as_one_document(spark):
    text = "\n".join(f"a{k} b{k} c{k} d{k} e{k} f{k}" for k in range(20))
    docs = spark.createDataFrame([(k, text, "h") for k in range(100)], "doc_id long, text string, source string")
    assert quality.verdicts(docs)[0].filter("kept").count() == 100
