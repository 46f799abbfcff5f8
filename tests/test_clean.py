"""Imputation and group statistics, checked against brute force in Python."""

import random
import statistics
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import plan_text, rows
from tessera.operators import clean, profile
from tessera.operators.stats import group_median, group_quantile


def _lower_median(values):
    s = sorted(values)
    return s[(len(s) - 1) // 2]


def test_map_impute(spark):
    df = spark.createDataFrame(
        [("oak", None), ("pine", None), ("elm", None), (None, None), ("oak", "table 7")], "wood string, item string")
    names = {"oak": "oak board", "pine": "pine board", "ash": "ash board"}
    want = [("elm", "unnamed"), ("oak", "oak board"), ("oak", "table 7"), ("pine", "pine board"), (None, "unnamed")]
    assert rows(clean.impute_by_map(df, "item", "wood", names, default="unnamed")) == want
    table = spark.createDataFrame(list(names.items()), "wood string, name string")
    assert rows(clean.impute_by_map(df, "item", "wood", table, default="unnamed")) == want
    assert rows(clean.impute_by_map(df, "item", "wood", {}, default=None))[0] == ("elm", None)
    with pytest.raises(ValueError):
        clean.impute_by_map(df, "item", "wood", table.union(table))


def test_all_statistics_come_from_one_scan(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 4, None), ("a", None, -1.0), ("b", None, 2.0), ("b", 7, 9.0), (None, None, 3.0)],
                               "g string, u int, p double")
    fills = [clean.Fill("u", "mean"), clean.Fill("p", "median", sentinel=-1.0)]
    out = rows(clean.impute_columns(df, "g", fills))
    step = clean.impute_by_group(clean.impute_by_group(df, "g", "u", "mean"), "g", "p", "median", sentinel=-1.0)
    assert out == rows(step)
    assert out == [("a", 1.0, 5.0), ("a", 2.5, 5.0), ("a", 4.0, 5.0), ("b", 7.0, 2.0), ("b", 7.0, 9.0), (None, None, 3.0)]


def test_approximate_median_fill(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 9.0), ("a", None)], "g string, p double")
    assert rows(clean.impute_by_group(df, "g", "p", "median", method="approx"))[1:3] == [("a", 2.0), ("a", 2.0)]


def test_last_window_of_a_quantile_is_within_its_bound(spark):
    from pyspark.sql import Window

    df = spark.range(20_000).select(F.lit("hot").alias("g"), (F.col("id") * 7919 % 20_011).cast("double").alias("v"))
    out = group_quantile(df, "g", "v", 0.37, split_above=20, buckets=16)
    values = sorted(r.v for r in df.select("v").collect())
    assert out.first().quantile == values[-(-37 * 20_000 // 100) - 1]
    assert Window is not None


def test_mean_fill_null_group_and_empty_group(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 2), ("a", None), ("b", None), (None, 5), (None, None)], "g string, u int")
    out = clean.impute_by_group(df, "g", "u", "mean")
    assert out.columns == ["g", "u"]
    assert rows(out) == [("a", 1.0), ("a", 1.5), ("a", 2.0), ("b", None), (None, 5.0), (None, None)]


def test_sentinel_median_fill(spark):
    df = spark.createDataFrame(
        [("a", 10.0), ("a", 30.0), ("a", 20.0), ("a", -1.0), ("a", None), ("a", 40.0)], "g string, p double")
    out = clean.impute_by_group(df, "g", "p", "median", sentinel=-1.0)
    # median of 10, 20, 30, 40 (lower) = 20; both -1 and null replaced
    assert sorted(r.p for r in out.collect()) == [10.0, 20.0, 20.0, 20.0, 30.0, 40.0]


@pytest.mark.parametrize("q", [0.0, 0.1, 0.5, 0.9, 1.0])
def test_exact_quantile_matches_brute_force(spark, q):
    rnd = random.Random(7)
    data = [(g, float(rnd.randint(0, 40))) for g in ("x", "y", "z") for _ in range(rnd.randint(1, 300))]
    data += [("hot", float(rnd.randint(0, 5))) for _ in range(2000)]
    df = spark.createDataFrame(data, "g string, v double")
    got = dict(rows(group_quantile(df, "g", "v", q)))
    split = dict(rows(group_quantile(df, "g", "v", q, split_above=0, buckets=8)))
    assert got == split
    for g in {d[0] for d in data}:
        vals = sorted(v for k, v in data if k == g)
        import math
        k = max(1, math.ceil(q * len(vals)))
        assert got[g] == vals[k - 1], (g, q)


@pytest.mark.parametrize("buckets", [2, 5, 64])
def test_exact_quantile_many_buckets_hot_group_null_key(spark, buckets):
    rnd = random.Random(buckets)
    data = [("hot", float(rnd.randint(0, 5000))) for _ in range(6000)]
    data += [(None, float(rnd.randint(0, 50))) for _ in range(99)] + [("one", 3.0)]
    df = spark.createDataFrame(data, "g string, v double")
    for q in (0.25, 0.5, 0.99):
        got = dict(rows(group_quantile(df, "g", "v", q, buckets=buckets, split_above=0)))
        for g in ("hot", None, "one"):
            vals = sorted(v for k, v in data if k == g)
            import math
            assert got[g] == vals[max(1, math.ceil(q * len(vals))) - 1], (g, q, buckets)


def test_exact_median_equals_lower_median(spark):
    rnd = random.Random(3)
    data = [(g, rnd.random()) for g in range(20) for _ in range(rnd.randint(1, 50))]
    df = spark.createDataFrame(data, "g long, v double")
    got = dict(rows(group_median(df, "g", "v")))
    for g in range(20):
        assert got[g] == _lower_median([v for k, v in data if k == g])


def test_approx_median_close(spark):
    data = [(1, float(i)) for i in range(1001)]
    df = spark.createDataFrame(data, "g long, v double")
    got = rows(group_median(df, "g", "v", method="approx"))[0][1]
    assert abs(got - statistics.median(v for _, v in data)) <= 1.0


def test_group_stat_is_broadcast_not_shuffled(spark):
    df = spark.range(0, 5000).select((F.col("id") % 7).alias("g"), (F.col("id") % 13).cast("int").alias("u"))
    out = clean.impute_by_group(df, "g", "u", "mean")
    plan = plan_text(out)
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan


def test_group_stat_above_bound_uses_shuffle_join(spark):
    # Above the bound no hint is added; with the planner's own size-based
    # broadcast switched off the join must be a shuffle join.
    df = spark.range(0, 500).select(
        (F.col("id") % 50).alias("g"),
        F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.col("id") % 13).cast("int").alias("u"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = clean.impute_by_group(df, "g", "u", "mean", max_broadcast_rows=10)
        assert "BroadcastHashJoin" not in plan_text(out)
        # g and id share parity: odd groups keep their values, even groups have none and stay null.
        assert out.where(F.col("u").isNull()).count() == 250
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_mode_by_group_ties_to_smallest(spark):
    df = spark.createDataFrame(
        [("c", "Desk"), ("c", "Lamp"), ("c", "Lamp"), ("c", "Desk"), ("c", None), ("c", None), ("c", None),
         ("d", "Sofa")], "cat string, name string")
    assert rows(profile.mode_by_group(df, "cat", "name")) == [("c", "Desk"), ("d", "Sofa")]


def test_group_fill_on_two_keys(spark):
    df = spark.createDataFrame([("a", 1, 10.0), ("a", 1, None), ("a", 2, 30.0), ("a", 2, None), ("b", 1, None)],
                               "g string, h int, v double")
    out = rows(clean.impute_by_group(df, ["g", "h"], "v", "median"))
    assert out == [("a", 1, 10.0), ("a", 1, 10.0), ("a", 2, 30.0), ("a", 2, 30.0), ("b", 1, None)]


def test_medians_keep_their_columns_type(spark):
    big = 9007199254740993
    df = spark.createDataFrame([("a", big, Decimal("1.10"), 1.0), ("a", None, None, None), ("a", big + 2, Decimal("2.30"), 3.0),
                                ("a", big + 4, Decimal("9.90"), None)], "g string, n long, d decimal(10,2), x double")
    fills = [clean.Fill("n", "median", scale=None), clean.Fill("d", "median", scale=None), clean.Fill("x", "mean", scale=None)]
    out = clean.impute_columns(df, "g", fills)
    assert out.schema["n"].dataType.simpleString() == "bigint" and out.schema["d"].dataType.simpleString() == "decimal(10,2)"
    assert rows(out, "n", "d", "x")[1] == (big + 2, Decimal("2.30"), 2.0)


def test_small_and_large_groups_in_one_call(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "small").otherwise("large").alias("g"), ((F.col("id") * 7919) % 3001).alias("v"))
    df = df.withColumn("v", F.when(F.col("g") == "small", F.col("v") % 11).otherwise(F.col("v")))
    want = rows(df.groupBy("g").agg(F.expr("percentile_disc(0.5) within group (order by v)").alias("m")))
    for above in (1, 50, 1_000_000):
        assert rows(group_quantile(df, "g", "v", out="m", split_above=above)) == want
