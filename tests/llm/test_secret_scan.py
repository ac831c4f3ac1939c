"""Operator 6: base spans, ownership, redaction."""

import random
import re

import brute
from hypothesis import given, settings
from hypothesis import strategies as st
from lexicount.llm import secret_scan as s
from pyspark.sql import functions as F

BITS = [
    "password", "PassWd", "secret", "token", "api_key", "APIKEY", "=", ":", ": ", ' = "', "'", '"', " ", "\n", "short",
    "abcdefghijkl", "abcDEF123456", "AKIA", "ABCDEFGHIJKLMN1", "0123456789abcdef", "deadbeef", "é", "日", "😀", "-", ".",
    "login://u:pa55word!x@host", "ghp_0123456789abcdefABCD", "Xy7" * 8,
]


def docs_of(spark, texts):
    return spark.createDataFrame([(k, t, f"o{k % 5}", len(t or "")) for k, t in enumerate(texts)], "doc_id long, text string, source string, n_chars long")


def base_of(df):
    kinds = len(s.BASE)
    return {r.doc_id: [tuple(x) for x in r.b] for r in df.select("doc_id", F.transform(F.filter("spans", lambda x: x["no"] < kinds), lambda x: F.struct(x["start"], x["no"], x["end"], x["kind"])).alias("b")).collect()}


def test_base_spans_of_mixed_texts(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 30))) for _ in range(400)]
    texts += [None, "", "secret: token: abcdefghijklmnop", "password=token=abcdefghijkl", "AKIAAKIA" * 4, "a" * 100_000, "api-key=0123456789ab"]
    got = base_of(s.scanned(docs_of(spark, texts)))
    for k, t in enumerate(texts):
        assert got[k] == brute.base_spans(t), t


def test_awkward_rows(spark, awkward, empty):
    found = s.scanned(awkward)
    want = sorted((str(r.doc_id), brute.base_spans(r.text)) for r in awkward.collect())
    kinds = len(s.BASE)
    got = sorted((str(r.doc_id), [(x.start, x.no, x.end, x.kind) for x in r.spans if x.no < kinds]) for r in found.collect())
    assert got == want
    assert s.scanned(empty).count() == 0
    clean = s.redacted(awkward)
    assert clean.columns == awkward.columns and clean.count() == awkward.count()
    assert s.redacted(empty).count() == 0


def test_whole_table(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    assert base_of(s.scanned(docs)) == {k: brute.base_spans(t) for k, t in texts.items()}


def corpus(spark):
    copied = "token = 'EXAMPLE00example11key'"
    rows = [(k, f"see the guide: {copied} and go on", f"owner{k}") for k in range(6)]
    rows += [(10 + k, f"config {k} api_key: 'Zk39dkfLw02mQpX8' end", "acme") for k in range(40)]  # one owner, many files
    rows += [(90, "login https://bob:s3cr3t-Pass9@host/x and Qw8Er7Ty6Ui5Op4As3Df2 here", "bob")]
    rows += [(91 + k, "random Aa1Bb2Cc3Dd4Ee5Ff6Gg7 shared by all", f"owner{k}") for k in range(5)]
    rows += [(99, "password = 'aaaaaaaaaaaa'", "zed"), (None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_ownership_tells_examples_from_live_ones(spark):
    got = {r.doc_id: r.spans for r in s.scanned(corpus(spark)).collect()}
    for k in range(6):  # base spans of a widely copied value stay, but aren't live
        assert [(x.kind, x.live, x.n_owners) for x in got[k]] == [("assign", False, 6)]
    for k in range(10, 50):
        assert [(x.kind, x.live, x.n_owners, x.n_repos) for x in got[k]] == [("assign", True, 1, 40)]
    assert [(x.kind, x.live) for x in got[90]] == [("login", True), ("random", True)]
    assert all(not got[k] for k in range(91, 96)) and got[None] == []
    assert [(x.kind, x.live) for x in got[99]] == [("assign", False)]  # one character over and over


def test_redaction_removes_live_spans_only(spark):
    docs = corpus(spark).withColumn("n_chars", F.length("text")).withColumn("cut", F.lit(1)).withColumn("new", F.lit("x"))
    got = {r.doc_id: r for r in s.redacted(docs).collect()}
    assert got[0].text == "see the guide: token = 'EXAMPLE00example11key' and go on"
    assert got[12].text == "config 2 [secret]' end" and got[12].n_chars == len(got[12].text)
    assert "s3cr3t" not in got[90].text and "Qw8Er7" not in got[90].text and got[90].text.endswith(" here")
    assert s.redacted(docs).schema.names == docs.columns


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sampled_from(BITS), max_size=25))
def test_shorter_patterns_find_what_the_base_says(parts):
    """{n,} in the pattern equals the run first, then its length."""
    text = "".join(parts)
    for plain, least, used in (("AKIA[A-Z0-9]+", 18, s.BASE[1][1]), ("[0-9a-f]+", 16, s.BASE[2][1])):
        assert [m.span() for m in re.finditer(plain, text) if len(m[0]) >= least] == [m.span() for m in re.finditer(used, text)]


def test_no_python_in_the_plan(spark, data):
    df = s.scanned(spark.read.parquet(f"{data}/documents.parquet"))
    plan = df._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def kept_of(spans):
    """Of all judged spans those that stay, by the rule itself."""
    stays = lambda x: x[1] < len(s.BASE) or x[3]
    return sorted(
        x for x in spans if x[1] < len(s.BASE) or (x[3] and not any(y[0] < x[2] and x[0] < y[2] and y[1] < x[1] and stays(y) for y in spans))
    )


def test_spans_that_give_way(spark):
    """The sweeps against every pair of spans, on random spans of all kinds."""
    rng = random.Random(6)
    rows = []
    for text in range(150):
        for no in range(len(s.KINDS)):
            at = 0
            for _ in range(rng.randint(0, 5)):  # of one kind none overlap
                at += rng.randint(0, 12)
                end = at + rng.randint(1, 15)
                rows.append((text, at, no, end, rng.random() < 0.7))
                at = end
    df = spark.createDataFrame(rows, "row long, start int, no int, end int, live boolean")
    got = df.withColumn("gone", s._covered()).filter("NOT gone").collect()
    for text in range(150):
        want = kept_of([(a, n, e, v) for t, a, n, e, v in rows if t == text])
        assert sorted((r.start, r.no, r.end, r.live) for r in got if r.row == text) == want


def masked(text, spans, mark="[secret]"):
    out, at = "", 0
    for a, b in sorted(spans):
        if a >= at:
            out += text[at:a] + mark
        at = max(at, b)
    return out + text[at:]


def test_every_live_span_is_masked(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 300))) for _ in range(150)] + [None, "", "x" * 3000]
    docs = docs_of(spark, texts)
    clean = {r.doc_id: (r.text, r.n_chars) for r in s.redacted(docs).collect()}
    n = 0
    for r in s.scanned(docs).collect():
        t = texts[r.doc_id]
        live = [(x.start, x.end) for x in r.spans if x.live]
        n += len(live)
        assert clean[r.doc_id] == ((masked(t, live), len(masked(t, live))) if live else (t, len(t or "")))
    assert n > 100


def test_a_text_full_of_secrets(spark):
    """A leaked dump of 100,000 values, scanned and masked by sweeps."""
    import time

    spent = []
    for n in (25_000, 100_000):
        value = lambda k: f"Aa1Bb2Cc3Dd4Ee5Ff6G{k:06d}"
        text = "é\n".join(f"key {value(k)}" for k in range(n))
        docs = docs_of(spark, [text, "nothing"])
        began = time.time()
        rows = {r.doc_id: r.text for r in s.redacted(docs).collect()}
        spent.append(time.time() - began)
        assert rows == {0: "é\n".join(["key [secret]"] * n), 1: "nothing"}
    assert spent[1] < 8 * spent[0] + 5, spent
