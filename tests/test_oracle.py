"""Every registered query against its DuckDB oracle SQL at sf0.01."""

import pytest

from locations import SF_ORACLE

import __spark_entry__ as entry_mod
from lexicount.queries import ORACLE_SQL, QUERIES
from tools.oracle_check import duck, rows_of

NAMES = sorted(QUERIES)
SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


def test_every_query_has_oracle():
    assert set(ORACLE_SQL) == set(NAMES)
    assert set(NAMES) <= set(entry_mod.queries()) and set(NAMES) <= set(entry_mod.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry_mod.queries()[name](spark, SF_ORACLE)
    rel = con.sql(entry_mod.oracle_sql()[name])
    assert df.columns == rel.columns
    spark_types = [SPARK_TO_DUCK.get(f.dataType.simpleString()) for f in df.schema.fields]
    assert spark_types == [str(t) for t in rel.types]
    s_rows = [tuple(r) for r in df.collect()]
    d_rows = rel.fetchall()
    assert len(s_rows) == len(d_rows)
    assert rows_of(df.columns, s_rows) == rows_of(rel.columns, d_rows)


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.schema.simpleString() == "struct<word:string,count:bigint>"
    assert df.count() > 0


def test_oracle_line_rule_matches_spark_on_edges(spark):
    import duckdb

    from lexicount import text_lines
    from lexicount.queries import _line_array
    from test_text_rules import EDGE_FILES

    con = duckdb.connect()
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(EDGE_FILES)], "i int, t string")
    got = {r.i: r.lines for r in df.select("i", text_lines("t").alias("lines")).collect()}
    for i, (c, want) in enumerate(EDGE_FILES):
        duck = con.execute(f"SELECT {_line_array('t')} FROM (SELECT ? AS t)", [c]).fetchone()[0]
        assert got[i] == duck == want


@pytest.mark.parametrize("name", ["text_file_word_count", "named_dataset_total", "word_lookup_sql", "word_lookup"])
def test_stateful_queries_repeatable(spark, name):
    """Queries that keep session state (a text copy, a cache, a view) give the
    same answer when run again, as a driver may do."""
    first = sorted(tuple(r) for r in entry_mod.queries()[name](spark, SF_ORACLE).collect())
    again = sorted(tuple(r) for r in entry_mod.queries()[name](spark, SF_ORACLE).collect())
    assert first == again and first
