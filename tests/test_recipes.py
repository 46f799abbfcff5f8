"""Recipes on small inputs with ties, nulls and hot keys."""

import pytest
from pyspark.sql import Row, Window
from pyspark.sql import functions as F

from conftest import plan_text, rows
from tessera.operators import clean, joins, recipes


def test_total_per_key(spark):
    df = spark.createDataFrame([(k, v) for k in ("n", "m") for v in (3, -3, 10, None)] + [(None, 4), ("z", None)], "k string, v long")
    out = recipes.total_per_key(df, "k", "v", scale=None)
    assert rows(out) == [("m", 10), ("n", 10), ("z", None), (None, 4)]
    assert dict(out.dtypes)["total"] == "bigint"


def test_max_per_day(spark):
    df = spark.createDataFrame([("2021-05-06", 4.5), ("2021-05-06", 4.5), ("2021-05-07", None), ("2021-05-07", -2.0)], "day string, v double")
    assert rows(recipes.max_per_key(df, "day", "v")) == [("2021-05-06", 4.5), ("2021-05-07", -2.0)]


def test_fill_constant(spark):
    df = spark.createDataFrame([(10, None, None), (11, "", "x")], "id long, a string, b string")
    assert rows(clean.fill_constant(df, "?", ["a"])) == [(10, "?", None), (11, "", "x")]


def test_partition_total(spark):
    df = spark.createDataFrame([(1, 5), (1, 7), (2, None), (None, 3), (None, 3)], "k long, v long")
    got = rows(recipes.partition_total(df.where("k is not null"), "k", "v", scale=None), "k", "v", "total")
    assert got == [(1, 5, 12), (1, 7, 12), (2, None, None)]


def _window_total(df):
    w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    return df.select("k", "t", "v", F.sum(F.col("v").cast("decimal(28,2)")).over(w).cast("double").alias("running_total"))


@pytest.mark.parametrize("above,bound", [(10 ** 9, None), (200, None), (200, 0), (0, None)])
def test_running_total_equals_one_window(spark, above, bound):
    """A hot key, a null key, null values and one value of the leading order column."""
    data = [(1 if i % 4 else (None if i % 8 else 2), i, None if i % 11 == 0 else float(i % 97) + 0.25) for i in range(3000)]
    data += [(9, i, None) for i in range(4000, 4300)]
    df = spark.createDataFrame(data, "k long, t long, v double")
    out = recipes.running_total(df, "k", ["t"], "v", scale=2, split_above=above, max_broadcast_rows=bound)
    assert rows(out) == rows(_window_total(df))
    flat = df.withColumn("day", F.lit(1))
    out = recipes.running_total(flat, "k", ["day", "t"], "v", scale=2, split_above=above, max_broadcast_rows=bound)
    assert rows(out.drop("day")) == rows(_window_total(df))


def test_avg_per_key(spark):
    df = spark.createDataFrame([("u", 1), ("u", 2), ("w", None), (None, 8)], "k string, v long")
    assert rows(recipes.avg_per_key(df, "k", "v")) == [("u", 1.5), ("w", None), (None, 8.0)]


def test_extract_year(spark):
    df = spark.createDataFrame([Row(id=1, day="1999-12-31"), Row(id=2, day="2000-01-01"), Row(id=3, day=None)])
    assert rows(recipes.extract_year(df, "day"), "id", "year") == [(1, 1999), (2, 2000), (3, None)]


def test_inner_join(spark):
    left = spark.createDataFrame([(1, "bolt"), (2, "nut"), (None, "none")], "k long, item string")
    right = spark.createDataFrame([(1, 4), (1, 4), (3, 9), (None, 1)], "k long, n long")
    assert rows(left.join(right, on="k", how="inner")) == [(1, "bolt", 4), (1, "bolt", 4)]


def test_explode_tags(spark):
    df = spark.createDataFrame([(5, "red,blue"), (6, ""), (7, None), (8, "red,red")], "id long, tags string")
    assert rows(recipes.explode_tags(df, "tags")) == [(5, "blue"), (5, "red"), (6, ""), (8, "red"), (8, "red")]
    # A separator that is a regex metacharacter is taken literally.
    dotted = spark.createDataFrame([(1, "a.b.c")], "id long, tags string")
    assert rows(recipes.explode_tags(dotted, "tags", sep=".")) == [(1, "a"), (1, "b"), (1, "c")]


def test_top_n_per_group(spark):
    df = spark.createDataFrame([("p", "c", 5), ("p", "a", 5), ("p", "b", 5), ("q", "d", 1), (None, "e", 2)], "g string, name string, s long")
    out = recipes.top_n_per_group(df, "g", [F.desc("s"), F.asc("name")], 2)
    assert rows(out) == [("p", "a", 5), ("p", "b", 5), ("q", "d", 1), (None, "e", 2)]
    assert "WindowGroupLimit" in plan_text(out)


def test_null_safe_join(spark):
    left = spark.createDataFrame([(4, "x"), (None, "y"), (6, "z"), (4, "w")], "key long, a string")
    right = spark.createDataFrame([(4, 40), (None, 0), (9, 90)], "key long, b long")
    out = joins.null_safe_join(left, right, "key", "key", "full")
    assert out.columns == ["key", "a", "key_right", "b"]
    assert rows(out) == [(4, "w", 4, 40), (4, "x", 4, 40), (6, "z", None, None), (None, "y", None, 0), (None, None, 9, 90)]
    with pytest.raises(ValueError):
        joins.null_safe_join(left, right.union(right), "key", "key", "full")


def test_null_safe_join_paths_agree(spark):
    left = spark.createDataFrame([(i % 5 if i % 3 else None, i) for i in range(200)], "k long, v long")
    right = spark.createDataFrame([(k, k * 10) for k in (0, 1, 2, 7)] + [(None, -1)], "rk long, w long")
    small = joins.null_safe_join(left, right, "k", "rk", "full")
    big = joins.null_safe_join(left, right, "k", "rk", "full", max_rows=0)
    assert rows(small, "k", "v", "rk", "w") == rows(big, "k", "v", "rk", "w")
    assert (None, None, 7, 70) in rows(small, "k", "v", "rk", "w")


def test_broadcast_needs_row_and_byte_bounds(spark):
    small = spark.createDataFrame([(i, "x" * 10) for i in range(100)], "k long, s string")
    _, ok = joins.checked_broadcast(small, max_rows=1000)
    assert ok
    rows_, size = joins.size_of(small)
    assert rows_ == 100 and size >= 100 * 10
    spark.conf.set("tessera.broadcast.maxBytes", str(size - 1))
    try:
        _, ok = joins.checked_broadcast(small, max_rows=1000)
        assert not ok
    finally:
        spark.conf.unset("tessera.broadcast.maxBytes")


def test_size_up_to_stops_early_and_matches(spark):
    df = spark.createDataFrame([(i, "ab" * (i % 3)) for i in range(500)], "k long, s string")
    assert joins.size_up_to(df, 1000) == joins.size_of(df)
    n, _ = joins.size_up_to(spark.range(0, 10_000_000, numPartitions=64), 100)
    assert n == 101


def test_extract_year_bad_text_is_null(spark):
    df = spark.createDataFrame([("2019-02-28",), ("2019-02-30",), ("none",)], "d string")
    assert [r.year for r in recipes.extract_year(df, "d").collect()] == [2019, None, None]
