"""Operator 13: first carriers, ranges, bitmaps."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

import __spark_entry__ as entry
from lexicount.llm import line_dedup
from tools.oracle_check import duck, rows_of

ENDS = re.compile(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=10):
    """``(doc_id, n_lines, n_dropped, text)`` of every (doc_id, text)."""
    key = lambda x: ENDS.sub("", x).translate(LOWER)
    order = lambda i: 2**63 - 1 if i is None else i
    held = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least:
                held[key(line)].add(order(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(held[key(x)]) < 2 or min(held[key(x)]) == order(i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


def got(df, **options):
    done = line_dedup.applied(df, line_dedup.keep_bitmaps(df, **options))
    rows = done.collect()
    for r in rows:  # the runs are maximal, in order, and hold what is kept
        assert sum(x.length for x in r.keep) == r.n_lines - r.n_dropped
        assert all(a.start + a.length < b.start for a, b in zip(r.keep, r.keep[1:], strict=False))
    return Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in rows)


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_awkward_rows(spark, awkward):
    assert got(awkward) == brute(pairs(awkward))
    assert got(awkward, least_chars=1) == brute(pairs(awkward), 1)


def test_empty_table(spark, empty):
    assert not got(empty)
    assert line_dedup.keep_bitmaps(empty).count() == 0


def test_keys(spark):
    texts = ["  Same Line here\t", "same line HERE\r", "É same line", "é same line", "\x0bsame\x1fline ok\x0c", "same\x1fline ok", "short", "SHORT", "İstanbul lines", "i̇stanbul lines"]
    rows = [(k, t) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df) == brute(rows)
    assert {k for k, n, d, _ in got(df) if d} == {1, 5}


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_a_hot_line_over_many_ranges(spark, partitions):
    """One line in every document, repeated in some: its hash fills several
    ranges, and the answer is that of one."""
    rng = random.Random(9)
    rows = []
    for k in range(400):
        own = [f"line {rng.randrange(500)} of the many lines" for _ in range(rng.randrange(4))]
        rows.append((1000 - k, "\n".join(["The license line of all."] * (1 + k % 3) + own)))
    rows += [(None, "the license line of all."), (5, "line 1 of the many lines"), (5, "line 1 of the many lines\nx")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert got(df) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_query_against_sql(spark, data):
    df = entry.queries()["op13_line_keep_bitmaps"](spark, data)
    rel = duck(data).sql(entry.oracle_sql()["op13_line_keep_bitmaps"])
    assert df.columns == rel.columns
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(rel.columns, rel.fetchall())


def test_native_only(spark, data):
    df = entry.queries()["op13_line_keep_bitmaps"](spark, data)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_sha_of_kept(spark):
    df = spark.createDataFrame([(1, "one line, quite long\nx"), (2, "ONE line, quite long \ny\n")], "doc_id long, text string")
    out = {r.doc_id: r for r in line_dedup.applied(df, line_dedup.keep_bitmaps(df)).collect()}
    assert out[2].text == "y\n" and hashlib.sha256(out[2].text.encode()).hexdigest()
    assert [(x.start, x.length) for x in out[2].keep] == [(1, 2)]
