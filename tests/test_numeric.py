"""Scaled columns, sums, hit ratio, prefix filter."""

import math

import pytest
from pyspark.sql import functions as F

from lexicount import hit_ratio, prefix_filter, scale, sum_of_squares, total, values


def test_double(spark):
    # 1, 2, 3 doubled.
    df = scale(values(spark, [1, 2, 3], "int"), "x", 2, out="y")
    assert [r.y for r in df.orderBy("x").collect()] == [2, 4, 6]
    assert df.schema["y"].dataType.simpleString() == "bigint"


def test_sum_of_doubled(spark):
    # The cached-numbers job, 2*(2+4+9+16+25+36+55+66) = 426.
    df = values(spark, [2, 4, 9, 16, 25, 36, 55, 66], "int")
    assert total(df, "x", k=2).collect()[0].total == 426


def test_sum_of_squares(spark):
    assert sum_of_squares(spark.range(1, 6), "id").collect()[0].sum_sq == 55


def test_sum(spark):
    assert total(values(spark, [1, 2, 3], "int"), "x").collect()[0].total == 6


def test_sum_empty_is_null(spark):
    assert total(values(spark, [], "int"), "x").collect()[0].total is None


def test_overflow_widened(spark):
    df = values(spark, [2**31 - 1], "int")
    assert scale(df, "x", 2, out="y").collect()[0].y == 4294967294
    assert total(df, "x", k=2).collect()[0].total == 4294967294
    assert sum_of_squares(df, "x").collect()[0].sum_sq == (2**31 - 1) ** 2


def test_bad_factor(spark):
    df = values(spark, [1], "int")
    for k in (True, "2", None):
        with pytest.raises(ValueError):
            total(df, "x", k=k)
        with pytest.raises(ValueError):
            scale(df, "x", k)
        with pytest.raises(ValueError):
            hit_ratio(df, F.col("x") > 0, k=k)


def test_float_factor(spark):
    df = scale(values(spark, [1, 3], "int"), "x", 0.5, out="y")
    assert [r.y for r in df.orderBy("x").collect()] == [0.5, 1.5]


def test_prefix(spark):
    # Dog, cat, horse with prefix "ho".
    df = values(spark, ["dog", "cat", "horse"], "string", name="name")
    assert [r.name for r in prefix_filter(df, "name", "ho").collect()] == ["horse"]
    assert prefix_filter(df, "name", "Ho").count() == 0
    with pytest.raises(ValueError):
        prefix_filter(df, "name", None)


def test_hit_ratio_fixed_points(spark):
    # Points are ours: (1,1) and (2,1) hit (boundary counts), (0,0) and (2,2) miss.
    pts = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (0.0, 0.0), (2.0, 2.0)], "x double, y double")
    inside = F.pow(F.col("x") - 1, 2) + F.pow(F.col("y") - 1, 2) <= 1
    r = hit_ratio(pts, inside, k=4.0).collect()[0]
    assert (r.hit, r.total, r.ratio) == (2, 4, 2.0)


def test_hit_ratio_empty_is_null(spark):
    pts = spark.createDataFrame([], "x double, y double")
    r = hit_ratio(pts, F.col("x") > 0, k=4.0).collect()[0]
    assert (r.hit, r.total, r.ratio) == (0, 0, None)


def test_hit_ratio_null_predicate_not_hit(spark):
    pts = spark.createDataFrame([(None,), (1.0,)], "x double")
    r = hit_ratio(pts, F.col("x") > 0).collect()[0]
    assert (r.hit, r.total) == (1, 2) and math.isclose(r.ratio, 0.5)
