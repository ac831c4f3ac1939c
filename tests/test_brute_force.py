"""Word count and lookup against a plain-Python brute force on random texts."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lexicount import line_counts, word_count, word_lookup

from test_text_rules import py_java_split, py_reader_lines


def brute_counts(texts, keep_empty, multiline):
    c = Counter()
    for t in texts:
        if t is None:
            continue
        lines = py_reader_lines(t) if multiline else [t]
        for line in lines:
            ws = py_java_split(line)
            c.update(w for w in ws if keep_empty or w)
    return dict(c)


texts = st.lists(st.one_of(st.none(), st.text(alphabet="ab \r\n\t.\\E(", max_size=20)), min_size=1, max_size=30)
LOOKUP_WORDS = ["a", "b", "ab", "a.", "", "a b", "\t", "a\nb", "\\E", "a\\Eb", "\\Q", "(", "a*", ".", "E"]


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts, st.booleans(), st.booleans())
def test_word_count_brute_force(spark, batch, keep_empty, multiline):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(batch)], "doc_id int, text string")
    got = {r.word: r["count"] for r in word_count(df, "text", keep_empty=keep_empty, multiline=multiline).collect()}
    assert got == brute_counts(batch, keep_empty, multiline)


@settings(max_examples=30, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts, st.sampled_from(LOOKUP_WORDS), st.booleans())
def test_lookup_brute_force(spark, batch, word, multiline):
    df = spark.createDataFrame([(t,) for t in batch], "text string")
    row = word_lookup(df, word, "text", multiline=multiline).collect()
    want = brute_counts(batch, False, multiline).get(word, 0) if word else 0
    assert [(r.word, r["count"]) for r in row] == [(word, want)]


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts)
def test_line_counts_brute_force(spark, batch):
    # Duplicate keys on purpose: ids 0..2 repeat.
    rows = [(i % 3, t) for i, t in enumerate(batch)]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    got = {r.doc_id: r.n_lines for r in line_counts(df).collect()}
    want = Counter()
    for k, t in rows:
        n = len(py_reader_lines(t)) if t else 0
        if n:
            want[k] += n
    assert got == dict(want)


def test_partitions_do_not_change_results(spark):
    from locations import SF_SMALL
    from lexicount import table, words

    docs = table(spark, SF_SMALL, "documents")
    one, many = (
        sorted(words(docs, "text", keep_empty=True, multiline=True, partitions=n).groupBy("word").count().collect())
        for n in (None, 7)
    )
    assert one == many and len(one) > 1000


def test_non_empty_drops_empty_and_null_words(spark):
    from lexicount import non_empty

    df = spark.createDataFrame([("a",), ("",), (None,), (" ",)], "word string")
    assert [r.word for r in non_empty(df).collect()] == ["a", " "]


def test_lookup_agrees_with_word_count_on_real_text(spark):
    from locations import SF_SMALL
    from lexicount import rank_by_count, table

    docs = table(spark, SF_SMALL, "documents")
    counts = word_count(docs, "text", multiline=True)
    top = [(r.word, r["count"]) for r in rank_by_count(counts, 30).collect()]
    rare = [(r.word, r["count"]) for r in counts.filter("count = 1").orderBy("word").limit(5).collect()]
    for w, n in top + rare:
        got = word_lookup(docs, w, "text", multiline=True).collect()[0]["count"]
        assert got == n, w


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts, st.text(alphabet="ab.\\E(*\t\n", min_size=1, max_size=3), st.booleans())
def test_lookup_random_words(spark, batch, word, multiline):
    df = spark.createDataFrame([(t,) for t in batch], "text string")
    got = word_lookup(df, word, "text", multiline=multiline).collect()[0]["count"]
    assert got == brute_counts(batch, False, multiline).get(word, 0)


def test_lookup_multibyte_words(spark):
    text = "😀a 😀 a😀 😀\nété été, été\r\nÉté été"
    df = spark.createDataFrame([(text,)], "text string")
    for word, multiline in [("😀", True), ("été", True), ("été", False), ("Été", True), ("a😀", True), ("😀\nété", False)]:
        want = brute_counts([text], False, multiline).get(word, 0)
        got = word_lookup(df, word, "text", multiline=multiline).collect()[0]["count"]
        assert got == want, (word, multiline)
