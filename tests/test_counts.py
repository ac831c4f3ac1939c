"""Word count variants, count by value, lookups and ranking."""

import pytest
from pyspark.sql import functions as F

from lexicount import (
    count_by_value,
    exact_ranks,
    lines_from_column,
    lines_from_literal,
    lines_from_text,
    rank_by_count,
    store_counts,
    stored_lookup,
    top_by_count,
    word_count,
    word_lookup,
    word_lookup_sql,
    words,
)


def as_dict(df):
    return {r.word: r["count"] for r in df.collect()}


def test_fixture_lines_and_words(spark, wordcount_file):
    lines = lines_from_text(spark, wordcount_file)
    assert lines.schema.simpleString() == "struct<value:string>"
    assert lines.count() == 6
    assert words(lines).count() == 9


def test_fixture_word_count(spark, wordcount_file):
    counts = word_count(lines_from_text(spark, wordcount_file))
    assert counts.schema.simpleString() == "struct<word:string,count:bigint>"
    assert as_dict(counts) == {"A": 3, "B": 2, "C": 2, "D": 2}


def test_fixture_word_count_keep_empty_is_same(spark, wordcount_file):
    counts = word_count(lines_from_text(spark, wordcount_file), keep_empty=True)
    assert as_dict(counts) == {"A": 3, "B": 2, "C": 2, "D": 2}


@pytest.mark.parametrize("word,want", [("A", 3), ("Z", 0), ("", 0)])
def test_fixture_lookup(spark, wordcount_file, word, want):
    lines = lines_from_text(spark, wordcount_file)
    got = word_lookup(lines, word).collect()
    assert [(r.word, r["count"]) for r in got] == [(word, want)]
    got_sql = word_lookup_sql(spark, word_count(lines), word).collect()
    assert [(r.word, r["count"]) for r in got_sql] == [(word, want)]


HOSTILE = ["A", "Z", "", 'a"b', "a'b", "a\\b", 'x" OR "1"="1', "x' OR '1'='1", "a b", "A\n"]


def test_lookup_dataframe_equals_sql_on_hostile_words(spark):
    text = "A a\"b a'b a\\b x\" OR \"1\"=\"1 a\"b\nA"
    lines = lines_from_column(spark.createDataFrame([(text,)], "text string"), "text")
    counts = word_count(lines)
    for w in HOSTILE:
        a = word_lookup(lines, w).collect()[0]
        b = word_lookup_sql(spark, counts, w).collect()[0]
        assert (a.word, a["count"]) == (b.word, b["count"]) == (w, text_count(text, w))


def text_count(text, w):
    return sum(1 for line in text.split("\n") for x in line.split(" ") if x and x == w)


def test_lookup_sql_schema(spark, wordcount_file):
    df = word_lookup_sql(spark, word_count(lines_from_text(spark, wordcount_file)), "A")
    assert df.schema.simpleString() == "struct<word:string,count:bigint>"


def test_lookup_rejects_bad_input(spark, wordcount_file):
    lines = lines_from_text(spark, wordcount_file)
    with pytest.raises(ValueError):
        word_lookup(lines, None)
    with pytest.raises(ValueError):
        word_lookup_sql(spark, word_count(lines), 1)


def test_literal_word_count_keeps_empties(spark):
    # The reference job's literal input, with one double space.
    lines = lines_from_literal(spark, "adsfasdf asdkf  safksf a sdfa")
    got = as_dict(word_count(lines, keep_empty=True))
    assert got == {"adsfasdf": 1, "asdkf": 1, "": 1, "safksf": 1, "a": 1, "sdfa": 1}
    assert as_dict(word_count(lines)) == {k: v for k, v in got.items() if k}


def test_literal_is_one_line(spark):
    lines = lines_from_literal(spark, "A B\nA")
    assert [r.value for r in lines.collect()] == ["A B\nA"]
    assert as_dict(word_count(lines, keep_empty=True)) == {"A": 1, "B\nA": 1}


def test_literal_required(spark):
    with pytest.raises(ValueError):
        lines_from_literal(spark, None)


@pytest.mark.parametrize("path", [None, "", [], [None]])
def test_text_path_required(spark, path):
    with pytest.raises(ValueError):
        lines_from_text(spark, path)


def test_multiline_matches_lines_first(spark):
    texts = [("x  y\n\nz \r\n w",), ("",), (None,), ("a\rb c\n",)]
    df = spark.createDataFrame(texts, "text string")
    for keep_empty in (False, True):
        fused = as_dict(word_count(df, "text", keep_empty=keep_empty, multiline=True))
        staged = as_dict(word_count(lines_from_column(df, "text"), keep_empty=keep_empty))
        assert fused == staged
    assert as_dict(word_count(df, "text", keep_empty=True, multiline=True)) == {
        "x": 1, "": 3, "y": 1, "z": 1, "w": 1, "a": 1, "b": 1, "c": 1,
    }


def test_count_by_value(spark):
    # Three different names, each once; NULL is a group of its own.
    df = spark.createDataFrame([("alpha",), ("beta",), ("gamma",)], "value string")
    assert sorted((r.value, r["count"]) for r in count_by_value(df, "value").collect()) == [
        ("alpha", 1), ("beta", 1), ("gamma", 1),
    ]
    df2 = spark.createDataFrame([("a",), (None,), (None,)], "value string")
    got = {r.value: r["count"] for r in count_by_value(df2, "value").collect()}
    assert got == {"a": 1, None: 2}


def test_rank_by_count_tie_break(spark):
    counts = spark.createDataFrame(
        [("b", 2), ("a", 2), ("c", 5), ("d", 1)], "word string, count bigint"
    )
    assert [r.word for r in rank_by_count(counts).collect()] == ["c", "a", "b", "d"]
    assert [r.word for r in rank_by_count(counts, 2).collect()] == ["c", "a"]
    with pytest.raises(ValueError):
        rank_by_count(counts, -1)


def test_hot_key_counts_exact(spark):
    # One word holds a third of all rows; partial aggregation keeps it exact.
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("w"), F.col("id").cast("string"))).alias("value")
    ).repartition(8)
    got = word_count(df).filter(F.col("word") == "hot").collect()
    assert got[0]["count"] == n // 3
    assert word_count(df).count() == 1 + n - n // 3


def test_count_by_value_of_literal_strings(spark):
    from lexicount import values

    got = count_by_value(values(spark, ["a", "b", "a", None], "string"), "x").collect()
    assert sorted((r.x or "", r["count"]) for r in got) == [("", 1), ("a", 2), ("b", 1)]


def ranked(rows):
    return [(k, w, n) for k, (w, n) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0].encode())), 1)]


def made_up(spark, n=500, top=2**40):
    import random

    rng = random.Random(n)
    rows = [(f"w{k}{rng.choice(['', 'é', '日'])}", rng.choice([1, 1, 1, 2, 3, 70_000, 70_001, top, 2**63 - 1])) for k in range(n)]
    return rows, spark.createDataFrame(rows, "word string, count bigint").repartition(6)


def test_exact_ranks(spark):
    rows, df = made_up(spark)
    got = sorted(tuple(r) for r in exact_ranks(df).collect())
    assert got == ranked(rows)
    assert exact_ranks(df.limit(0)).count() == 0
    assert exact_ranks(df).dtypes == [("rank", "bigint"), ("word", "string"), ("count", "bigint")]


@pytest.mark.parametrize("n", [0, 1, 2, 49, 250, 499, 500, 501, 10**12])
def test_top_of_any_size(spark, n):
    """Within a tie the smaller words are taken; all rows if there are fewer."""
    rows, df = made_up(spark)
    assert sorted(tuple(r) for r in top_by_count(df, n, stored=n % 2 == 1).collect()) == ranked(rows)[:n]


def test_top_of_equal_counts(spark):
    df = spark.createDataFrame([(c, 1) for c in "qwertyuiop"], "word string, count bigint")
    assert sorted(r.word for r in top_by_count(df, 4).collect()) == sorted("qwertyuiop")[:4]
    assert top_by_count(df.limit(0), 4).count() == 0
    with pytest.raises(ValueError):
        top_by_count(df, -1)


HOSTILE = ["the", "it's", 'a"b', "x\\y", "1=1 OR", "%", "é", ""]


def test_stored_counts(spark):
    rows, df = made_up(spark, 60)
    for buckets in (1, 7, 64):
        assert store_counts(spark, df, "made_up", buckets) == "lexicount_counts_made_up"
        for word in [*HOSTILE, rows[0][0], rows[-1][0]]:
            assert [tuple(r) for r in stored_lookup(spark, "made_up", word).collect()] == [(word, dict(rows).get(word, 0))]
    with pytest.raises(ValueError):
        store_counts(spark, df, "no name")
    with pytest.raises(ValueError):
        store_counts(spark, df, "made_up", 0)


def test_stored_counts_are_replaced(spark):
    first = spark.createDataFrame([("a", 1), ("it's", 5)], "word string, count bigint")
    store_counts(spark, first, "again", 4)
    before = stored_lookup(spark, "again", "a")
    assert before.first()["count"] == 1 and stored_lookup(spark, "again", "it's").first()["count"] == 5
    store_counts(spark, first.selectExpr("word", "count + 1 AS count"), "again", 2)
    assert stored_lookup(spark, "again", "a").first()["count"] == 2 and before.first()["count"] == 1


@pytest.mark.parametrize("keep_empty", [False, True])
@pytest.mark.parametrize("multiline", [False, True])
def test_only_some_words(spark, keep_empty, multiline):
    """The words asked for, with the counts they have among all."""
    texts = ["the cat  the\nother the", "therefore it's", None, "", "the", "a%b _ a.b", " x ", "cat\r\nthe"]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    whole = as_dict(word_count(df, keep_empty=keep_empty, multiline=multiline))
    for only in (["the"], ["the", "cat", "the"], ["a%b", "_"], ["it's"], ["zzz"], [""], []):
        got = as_dict(word_count(df, keep_empty=keep_empty, multiline=multiline, only=only))
        assert got == {w: n for w, n in whole.items() if w in only}, only
    with pytest.raises(ValueError):
        word_count(df, only=[3])
