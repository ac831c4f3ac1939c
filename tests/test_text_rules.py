"""Java split rule and text-reader line rule."""

import os
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexicount import java_split, line_count, line_words, lines_from_column, lines_from_text, text_lines, text_words


def py_java_split(s):
    """java.util.regex.Pattern.compile(" ").split(s), written out in Python."""
    if s is None:
        return []
    if s == "":
        return [""]
    parts = s.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def py_reader_lines(s):
    """Lines as Hadoop's line reader (spark.read.text) returns them."""
    if not s:
        return []
    parts = re.split(r"\r\n|\n|\r", s)
    if s.endswith(("\n", "\r")):
        parts.pop()
    return parts


EDGE_LINES = [
    ("", [""]),
    ("   ", []),
    ("a b ", ["a", "b"]),
    ("  a  b  ", ["", "", "a", "", "b"]),
    ("a\tb", ["a\tb"]),
    ("a  b", ["a", "", "b"]),
    (None, None),
]


def test_java_split_edges(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(EDGE_LINES)], "i int, v string")
    got = {r.i: r.w for r in df.select("i", java_split("v").alias("w")).collect()}
    for i, (s, want) in enumerate(EDGE_LINES):
        assert got[i] == want, (s, got[i])


def test_java_split_matches_python_model_on_edges():
    for s, want in EDGE_LINES:
        assert py_java_split(s) == (want or [])


EDGE_FILES = [
    ("A\n\n", ["A", ""]),
    ("A", ["A"]),
    ("", []),
    ("A\r\nB\rC", ["A", "B", "C"]),
    ("\n", [""]),
    ("A\n\r", ["A", ""]),
    ("\r\n\r\n", ["", ""]),
]


def _read_files(spark, scratch, contents):
    paths = []
    for i, c in enumerate(contents):
        p = os.path.join(scratch, f"f{i:04d}.txt")
        with open(p, "wb") as f:
            f.write(c.encode("utf-8"))
        paths.append(p)
    got = {p: [] for p in paths}
    df = lines_from_text(spark, scratch).select(F.input_file_name().alias("f"), "value")
    for r in df.collect():
        got[r.f.replace("file://", "")].append(r.value)
    return [got[p] for p in paths]


def test_text_reader_edge_files(spark, scratch):
    got = _read_files(spark, scratch, [c for c, _ in EDGE_FILES])
    assert got == [want for _, want in EDGE_FILES]


def test_text_lines_matches_reader_on_edge_files(spark):
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(EDGE_FILES)], "i int, t string")
    got = {r.i: r.lines for r in df.select("i", text_lines("t").alias("lines")).collect()}
    counts = {r.i: r.n for r in df.select("i", line_count("t").alias("n")).collect()}
    for i, (_, want) in enumerate(EDGE_FILES):
        assert got[i] == want
        assert counts[i] == len(want)


def test_lines_from_column_drops_null_and_empty(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "x\ny")], "id int, text string")
    rows = sorted((r.id, r.value) for r in lines_from_column(df, "text", keep=["id"]).collect())
    assert rows == [(3, "x"), (3, "y")]


texts = st.text(alphabet="ab \t\r\n", max_size=14)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(texts, min_size=1, max_size=40))
def test_rules_match_python_models(spark, batch):
    df = spark.createDataFrame(list(enumerate(batch)), "i int, t string")
    out = df.select(
        "i",
        java_split("t").alias("js"),
        text_lines("t").alias("lines"),
        line_count("t").alias("n"),
        text_words("t").alias("tok"),
        line_words("t").alias("lw"),
    ).collect()
    for r in out:
        s = batch[r.i]
        assert r.js == py_java_split(s)
        assert r.lines == py_reader_lines(s)
        assert r.n == len(py_reader_lines(s))
        # Non-empty tokens of the whole text = non-empty words of all lines.
        by_lines = [w for line in py_reader_lines(s) for w in line.split(" ") if w]
        assert r.tok == by_lines
        assert r.lw == [w for w in s.split(" ") if w]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(texts, min_size=1, max_size=12))
def test_text_lines_matches_text_reader(spark, batch):
    import tempfile

    scratch = tempfile.mkdtemp(prefix="lexicount-test-")
    from_files = _read_files(spark, scratch, batch)
    df = spark.createDataFrame(list(enumerate(batch)), "i int, t string")
    got = {r.i: r.lines for r in df.select("i", text_lines("t").alias("lines")).collect()}
    assert [got[i] for i in range(len(batch))] == from_files


def test_unix_breaks_and_can_be_word(spark):
    from lexicount.functions import can_be_word, unix_breaks

    rows = [("a\r\nb\rc\nd",), ("plain",), ("",), (None,), ("\r\r\n",)]
    df = spark.createDataFrame(rows, "t string")
    got = [r.u for r in df.select(unix_breaks("t").alias("u")).collect()]
    assert got == ["a\nb\nc\nd", "plain", "", None, "\n\n"]
    assert can_be_word("a.b") and can_be_word("a\nb") and not can_be_word("a\nb", multiline=True)
    assert not can_be_word("") and not can_be_word("a b") and not can_be_word("x\r", multiline=True)
