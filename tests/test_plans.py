"""Plan checks: the plans Catalyst picks for the registered queries."""

import pytest

from locations import SF_ORACLE
from lexicount import rank_by_count, store_counts, stored_lookup, table, word_count
from lexicount.plans import repartitioned
from lexicount.queries import QUERIES
from plan_helpers import node_names, physical_plan, pushed_filters, read_schemas

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


@pytest.fixture(scope="module")
def plans(spark):
    return {n: physical_plan(q(spark, SF_ORACLE)) for n, q in QUERIES.items()}


def test_no_python_and_no_single_partition(plans):
    for name, plan in plans.items():
        for node in PYTHON_NODES:
            assert node not in plan, (name, node)
        assert "Coalesce 1" not in plan and "SinglePartition, REPARTITION" not in plan, name


def test_word_count_partial_then_final(spark):
    df = QUERIES["word_count"](spark, SF_ORACLE)
    names = node_names(df)
    plan = physical_plan(df)
    assert "partial_count(1)" in plan
    assert names.count("HashAggregate") == 2
    assert "Exchange hashpartitioning(word" in plan
    assert read_schemas(df) == ["struct<text:string>"]


def test_lookup_counts_in_place_and_prunes(spark):
    df = QUERIES["word_lookup"](spark, SF_ORACLE)
    names = node_names(df)
    assert "Generate" not in names and "Sort" not in names  # no row per word, no sort
    assert names.count("HashAggregate") == 2  # partial + final global sum
    assert any("StringContains(text,the)" in f for f in pushed_filters(df))
    assert read_schemas(df) == ["struct<text:string>"]


def test_impossible_lookup_reads_nothing(spark):
    from lexicount import word_lookup

    df = word_lookup(table(spark, SF_ORACLE, "documents"), "a b", "text", multiline=True)
    assert "FileScan" not in physical_plan(df)
    assert [(r.word, r["count"]) for r in df.collect()] == [("a b", 0)]


def test_lookup_sql_filter_pushed_below_view_aggregate(spark):
    plan = physical_plan(QUERIES["word_lookup_sql"](spark, SF_ORACLE))
    inner_agg = plan.index("HashAggregate(keys=[word")
    assert plan.index("Filter (word") > inner_agg


def test_top_words_take_ordered(spark):
    names = node_names(QUERIES["top_words"](spark, SF_ORACLE))
    assert "TakeOrderedAndProject" in names
    assert "Sort" not in names


def test_prefix_pushed_to_parquet(spark):
    df = QUERIES["prefix_filter"](spark, SF_ORACLE)
    assert any("StringStartsWith(p_name,ho)" in f for f in pushed_filters(df))
    assert read_schemas(df) == ["struct<p_partkey:bigint,p_name:string>"]


def test_sql_lookup_pushes_the_word_to_the_scan(spark):
    df = QUERIES["word_lookup_sql"](spark, SF_ORACLE)
    assert any("StringContains(text,of)" in f for f in pushed_filters(df))
    assert "(word#" in physical_plan(df) and physical_plan(df).count("Generate") == 1


def test_numeric_queries_prune_columns(spark):
    for name in ("total", "total_doubled", "sum_of_squares"):
        assert read_schemas(QUERIES[name](spark, SF_ORACLE)) == ["struct<l_linenumber:int>"], name
    assert read_schemas(QUERIES["count_by_value"](spark, SF_ORACLE)) == ["struct<event_type:string>"]


TOKENISING = [
    "word_count", "line_word_count", "word_count_raw", "string_word_count", "word_lookup", "line_counts",
    "word_count_breaks", "conversation_word_count", "page_word_count",
]


def _shape(df):
    """The plan without paths, ids and partition counts."""
    import re

    plan = re.sub(r"Location: [^\n]*?\], ", "", physical_plan(df))
    return re.sub(r"#\d+L?|plan_id=\d+|sf0\.\d+", "", plan)


@pytest.mark.parametrize("name", TOKENISING)
def test_plan_does_not_follow_the_size(spark, name):
    from locations import SF_SMALL

    small, large = (_shape(QUERIES[name](spark, d)) for d in (SF_SMALL, "/root/testdata/sf0.1"))
    assert small == large


def test_no_round_robin_unless_asked(spark, plans):
    for name, plan in plans.items():
        assert "RoundRobinPartitioning" not in plan, name
    docs = table(spark, SF_ORACLE, "documents")
    asked = word_count(words_of(docs), "word")
    assert "RoundRobinPartitioning(3)" in physical_plan(asked)
    with pytest.raises(ValueError):
        repartitioned(docs, 0)


def words_of(docs):
    from lexicount import words

    return words(docs, "text", multiline=True, partitions=3)


def test_full_ranking_is_range_partitioned(spark):
    ranking = rank_by_count(QUERIES["word_count"](spark, SF_ORACLE))
    names = node_names(ranking)
    assert "TakeOrderedAndProject" not in names and "Sort" in names
    assert "rangepartitioning(count" in physical_plan(ranking)
    rows = ranking.collect()
    assert rows == sorted(rows, key=lambda r: (-r["count"], r.word))


def test_ranks_without_a_window_over_the_words(spark):
    """Only the sizes of the ranges meet in one task and are broadcast."""
    for name in ("ranked_words", "top_half_words"):
        df = QUERIES[name](spark, SF_ORACLE)
        plan = physical_plan(df)
        assert "TakeOrderedAndProject" not in plan
        windows = [x for x in plan.splitlines() if " Window " in x]
        assert windows and all("part#" in x and "word#" not in x for x in windows)
        rows = sorted(df.collect(), key=lambda r: r.rank)
        assert [r.rank for r in rows] == list(range(1, len(rows) + 1))
        assert rows == sorted(rows, key=lambda r: (-r["count"], r.word))


def test_stored_lookup_reads_one_bucket(spark):
    """The files of all other buckets are spoilt: the lookup doesn't open them."""
    import re

    stored = store_counts(spark, QUERIES["word_count"](spark, SF_ORACLE), "plan_words", buckets=16)
    df = stored_lookup(spark, "plan_words", "the")
    assert any("EqualTo(word,the)" in f for f in pushed_filters(df))
    files = {int(re.search(r"_(\d{5})[._]", f)[1]): f.removeprefix("file://") for f in spark.table(stored).inputFiles()}
    assert len(files) == 16
    own = spark.sql("SELECT pmod(hash('the'), 16) AS bucket").first().bucket
    for bucket, file in files.items():
        if bucket != own:
            with open(file, "wb") as f:
                f.write(b"not a table")
    assert [tuple(r) for r in df.collect()] == [tuple(r) for r in QUERIES["word_lookup"](spark, SF_ORACLE).collect()]
    with pytest.raises(Exception, match="(?i)parquet|length|magic|footer|read"):
        spark.table(stored).groupBy().sum("count").collect()


def test_break_queries_read_the_text(spark):
    for name in ("word_count_breaks", "word_count_raw_breaks", "line_counts_breaks", "word_lookup_breaks", "word_count_raw_edge"):
        assert all("text:string" in s for s in read_schemas(QUERIES[name](spark, SF_ORACLE))), name


def test_line_counts_shuffles_numbers_only(spark):
    df = QUERIES["line_counts"](spark, SF_ORACLE)
    exchange = next(x for x in physical_plan(df).splitlines() if "Exchange" in x)
    assert "doc_id" in exchange and physical_plan(df).count("Exchange") == 1


def test_many_files_same_counts(spark, scratch):
    """Many files give many scan tasks, one exchange and the same answer."""
    import os

    from lexicount.sources import parquet

    path = os.path.join(scratch, "docs.parquet")
    table(spark, SF_ORACLE, "documents").repartition(8).write.parquet(path)
    many = parquet(spark, path)
    small = word_count(table(spark, SF_ORACLE, "documents"), "text", multiline=True)
    big = word_count(many, "text", multiline=True)
    assert physical_plan(big).count("Exchange") == 1
    assert many.rdd.getNumPartitions() >= 4
    assert sorted(big.collect()) == sorted(small.collect())
