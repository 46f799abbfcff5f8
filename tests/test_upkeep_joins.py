"""Bitmap foreign keys, many-to-many joins, merged statistics, whole shifts, comparison by position."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_text, rows
from tessera.operators import attendance, bitmaps, manytomany, quality, sketches
from tessera.session import scratch_path


# --- bitmaps ------------------------------------------------------------------

@pytest.mark.parametrize("kind", ["int", "long"])
def test_bitmap_report_equals_the_report_by_values(spark, kind):
    rng = random.Random(3)
    some = [0, 1, -1, 7, 8, 32767, 32768, 32769, -32768, -32769, 10**6, 2**31 - 1, -2**31] + ([2**62, -2**62, 2**63 - 1] if kind == "long" else [])
    keys = [rng.choice([*some, None]) for _ in range(400)] + some
    fact = spark.createDataFrame([(k, 1) for k in keys], f"fk {kind}, block int").repartition(3)
    dim = spark.createDataFrame([(k,) for k in some[::2]] + [(None,), (55,)], f"key {kind}")
    fk = [quality.ForeignKey("fk", dim, "key"), quality.ForeignKey("block", dim, "key"), quality.ForeignKey("fk", fact, "fk")]
    got = bitmaps.fk_report_bitmap(fact, fk)
    assert rows(got.drop("n_orphan_keys")) == rows(quality.fk_report(fact, fk))
    lost = set(keys) - set(some[::2]) - {None}
    assert [r.n_orphan_keys for r in got.collect()] == [len(lost), 1, 0]
    assert rows(bitmaps.fk_report_bitmap(fact, fk[:1], max_broadcast_rows=0)) == rows(got.limit(1))


def test_only_bitmaps_are_shuffled(spark):
    fact, dim = spark.range(200_000).withColumnRenamed("id", "fk"), spark.range(100_000)
    out = bitmaps.missing_bitmaps(fact, "fk", dim, "id")
    assert sum(r.n_lost for r in out.collect()) == 100_000 and out.count() <= 8
    assert "partial_bitmap_construct_agg" in plan_text(out)
    with pytest.raises(TypeError):
        bitmaps.key_bitmaps(fact.select(F.col("fk").cast("string")), "fk")
    assert bitmaps.fk_report_bitmap(fact.limit(0), [quality.ForeignKey("fk", dim, "id")]).first()[1:] == (0, 0, 0, 0)


# --- many to many -------------------------------------------------------------

@pytest.mark.parametrize("how,null_safe", [("inner", False), ("left", False), ("inner", True), ("left", True)])
def test_many_to_many_equals_a_plain_join(spark, how, null_safe):
    rng = random.Random(1)
    key = lambda: rng.choice([1, 1, 1, 2, 3, None])
    left = spark.createDataFrame([(key(), rng.choice("ab"), i % 40) for i in range(120)] + [(9, "a", 1)], "k int, g string, v int")
    right = spark.createDataFrame([(key(), rng.choice("ab"), i) for i in range(90)] + [(8, "a", 2)], "k int, g string, v int")
    renamed = right.withColumnsRenamed({"k": "rk", "g": "rg", "v": "v_right"})
    cond = (F.col("k").eqNullSafe(F.col("rk")) & F.col("g").eqNullSafe(F.col("rg"))) if null_safe else (F.col("k") == F.col("rk")) & (F.col("g") == F.col("rg"))
    want = rows(left.join(renamed, cond, how).select("k", "g", "v", "v_right"))
    for task_rows, bound in ((1, None), (40, None), (40, 0), (10**9, None)):
        got = manytomany.many_to_many_join(left, right, ["k", "g"], how, null_safe, task_rows=task_rows, max_broadcast_rows=bound)
        assert got.columns == ["k", "g", "v", "v_right"] and rows(got) == want
    inner = left.join(renamed, cond).count()
    assert manytomany.join_size(left, right, ["k", "g"], null_safe).first().n_rows == inner


def test_a_join_that_is_too_large_is_refused_before_it_runs(spark):
    df = spark.range(1000).select(F.lit(1).alias("k"), "id")
    with pytest.raises(ValueError, match="1000000 rows"):
        manytomany.many_to_many_join(df, df, "k", max_rows=999_999)
    assert manytomany.many_to_many_join(df, df, "k", max_rows=10**6, task_rows=10_000).count() == 10**6
    assert manytomany.join_size(df.limit(0), df, "k").first().n_rows == 0


def test_a_heavy_key_is_dealt(spark):
    df = spark.range(300).select(F.lit(1).alias("k"), "id")
    small = df.where("id < 10").withColumnRenamed("id", "other")
    out = manytomany.many_to_many_join(df, small, "k", task_rows=300)
    assert out.count() == 3000 and rows(out) == rows(df.join(small, "k"))


def test_copies_of_a_heavy_key_do_not_grow_with_its_output(spark, monkeypatch):
    seen, given = [], manytomany.checked_broadcast
    monkeypatch.setattr(manytomany, "checked_broadcast", lambda df, *a: seen.append(df.agg(F.max("__p")).first()[0]) or given(df, *a))
    left = spark.range(2000).select(F.lit(1).alias("k"), F.col("id").alias("a"))
    right = spark.range(50).select(F.lit(1).alias("k"), F.col("id").alias("b"))
    out = manytomany.many_to_many_join(left, right, "k", task_rows=1).agg(F.count("*"), F.sum("a"), F.sum("b")).first()
    assert tuple(out) == (100_000, 50 * 1999 * 1000, 2000 * 49 * 25)
    assert seen == [manytomany.PIECES_A_TASK * int(spark.conf.get("spark.sql.shuffle.partitions"))]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_pairs_of_a_heavy_key_are_even_over_tasks(spark, monkeypatch, how):
    left = spark.range(4000).select(F.when(F.col("id") % 100 != 0, 1).otherwise(F.col("id") + 10).alias("k"), F.col("id").alias("a"))
    right = spark.range(70).select(F.when(F.col("id") < 50, 1).otherwise(110).cast("int").alias("k"), F.col("id").alias("b"))
    want = rows(left.join(right, "k", how))
    monkeypatch.setattr(manytomany, "PAIRS_A_TASK", 10_000)
    monkeypatch.setattr(manytomany, "LIST_ROWS", 7)
    out = manytomany.many_to_many_join(left, right, "k", how, task_rows=1_000)
    assert rows(out) == want
    # 198,020 pairs; dealt by key and piece, some tasks got several pieces of the key and some none.
    n = [r.n for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert len(n) == 19 and max(n) < 1.5 * sum(n) / len(n)
    assert "SortMergeJoin" not in plan_text(out)



# --- sketches -----------------------------------------------------------------

def test_batches_merge_and_replace(spark):
    df = spark.range(30_000).select((F.col("id") % 3).alias("g"), F.when(F.col("id") % 50 != 0, (F.col("id") * 7919 % 30_011) / 4).alias("x"),
                                    (F.col("id") % 7).alias("day"))
    store = sketches.Store(spark, scratch_path(spark, "summaries"), "g", "x", scale=2)
    for day in range(7):
        store.add(f"d{day}", df.where(F.col("day") == day))
    store.add("d3", df.where(F.col("day") == 3))
    got = {r.g: r for r in sketches.with_quantile(store.read(), 0.25, "q").collect()}
    for g, r in got.items():
        values = sorted(v.x for v in df.where((F.col("g") == g) & F.col("x").isNotNull()).collect())
        assert (r.n, r.least, r.most, float(r.total)) == (len(values), values[0], values[-1], sum(values))
        rank = sum(v <= r.q for v in values) / len(values)
        assert abs(rank - 0.25) < 0.01
    assert {r.g: r.n for r in store.read(["d1", "d2"]).collect()} == {
        r.g: r.n for r in df.where("day in (1, 2) and x is not null").groupBy("g").agg(F.count("*").alias("n")).collect()}
    store.drop("d1")
    assert sum(r.n for r in store.read().collect()) == df.where("day <> 1 and x is not null").count()
    with pytest.raises(ValueError):
        store.add("a/b", df)


# --- shifts -------------------------------------------------------------------

def machine(punches):
    """Shifts of one employee by stepping through the punches."""
    out, since = [], None
    for time, kind in punches:
        if kind == "IN" and since is None:
            since = time
        elif kind == "OUT" and since is not None:
            out.append((since, time))
            since = None
    return out, since


@pytest.mark.parametrize("split", ["1000000", "0", "20"])
def test_shifts_equal_a_state_machine(spark, split):
    rng = random.Random(8)
    data, start = [], dt.datetime(2024, 1, 1)
    for emp in range(4):
        t = start
        for i in range(150 if emp else 600):
            t += dt.timedelta(minutes=rng.randrange(1, 900))
            data.append((emp, t, rng.choice(["IN", "IN", "OUT", "OUT", "BREAK", None]), len(data)))
    data += [(9, None, "IN", 9999), (9, start, "IN", 10000)]
    df = spark.createDataFrame(data, "emp_id int, punch_time timestamp_ntz, punch_type string, n int").repartition(4)
    spark.conf.set("tessera.window.splitAbove", split)
    try:
        got = attendance.shifts(df, tiebreak=["n"]).collect()
    finally:
        spark.conf.unset("tessera.window.splitAbove")
    for emp in (0, 1, 2, 3, 9):
        done, since = machine([(t, k) for e, t, k, _ in data if e == emp and t is not None and k in ("IN", "OUT")])
        mine = sorted(((r.first_in, r.last_out) for r in got if r.emp_id == emp), key=lambda s: s[0])
        assert [s for s in mine if s[1]] == done and [s[0] for s in mine if not s[1]] == ([since] if since else [])


def test_a_night_shift_is_whole(spark):
    at = lambda d, h: dt.datetime(2024, 1, d, h)
    df = spark.createDataFrame([(1, at(1, 22), "IN"), (1, at(2, 6), "OUT"), (1, at(2, 7), "OUT"), (1, at(2, 21), "IN"), (1, at(2, 23), "IN"),
                                (1, at(3, 5), "OUT"), (1, at(3, 20), "IN")], "emp_id int, punch_time timestamp_ntz, punch_type string")
    got = [tuple(r) for r in attendance.hours_by_shift(df).collect()]
    assert got == [(1, dt.date(2024, 1, 1), 1, at(1, 22), at(2, 6), 8.0), (1, dt.date(2024, 1, 2), 1, at(2, 21), at(3, 5), 8.0)]
    assert attendance.hours_by_shift(df.limit(0)).count() == 0


# --- positions ----------------------------------------------------------------

def test_equal_data_pair_up_whatever_the_partitioning(spark):
    df = spark.range(3000).select("id", (F.col("id") % 7).alias("a"), F.when(F.col("id") % 5 != 0, F.col("id") / 2).alias("b"))
    assert quality.reconcile_positions(df.repartition(2), df.repartition(9, "a"), ["id"]).count() == 0
    other = df.withColumn("b", F.when(F.col("id") == 4, -1.0).otherwise(F.col("b"))).withColumn("a", F.when(F.col("id").isin(4, 10), None).otherwise(F.col("a")))
    got = quality.reconcile_positions(df, other.where("id < 2998"), ["id"])
    assert rows(got) == [(4, "both", "a,b"), (10, "both", "a"), (2998, "left", None), (2999, "left", None)]
    assert rows(quality.reconcile_positions(df.limit(0), df.where("id < 1"), ["id"])) == [(0, "right", None)]
