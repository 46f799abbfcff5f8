"""Referential integrity, reconciliation and schema checks."""

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from conftest import SF_SMALL, plan_text, rows
from tessera.operators import quality
from tessera.plans import derived as D


def test_reconcile_same_data_is_empty(spark):
    left, _ = D.lineitem_versions(spark, SF_SMALL)
    assert quality.reconcile(left, left).count() == 0
    s = quality.reconcile_summary(left, left).collect()[0]
    assert s.n_left == s.n_right == left.count() and s.n_distinct_mismatch == 0


def test_reconcile_multiset_and_nulls(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "z")], "k long, v string")
    b = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z"), (None, "q")], "k long, v string")
    out = rows(quality.reconcile(a, b), "k", "v", "n_left", "n_right")
    assert out == [(1, "x", 2, 1), (2, "y", 0, 1), (2, None, 1, 0), (None, "q", 0, 1)]
    s = quality.reconcile_summary(a, b).collect()[0]
    assert (s.n_left, s.n_right, s.n_distinct_mismatch, s.n_only_left, s.n_only_right) == (4, 4, 4, 2, 2)


def test_reconcile_keyed_value_vs_null(spark):
    a = spark.createDataFrame([(1, "x", 1.0), (2, "y", None), (3, "z", 3.0), (4, "w", 4.0)], "k long, s string, d double")
    b = spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0), (3, "Z", 3.0), (5, "v", 5.0)], "k long, s string, d double")
    out = rows(quality.reconcile_keyed(a, b, "k"), "k", "n_left", "n_right", "diff_columns")
    assert out == [(2, 1, 1, "d"), (3, 1, 1, "s"), (4, 1, 0, "s,d"), (5, 0, 1, "s,d")]


def test_reconcile_keyed_hot_duplicate_key_no_cross_product(spark):
    hot = spark.range(0, 20000).select(F.lit(7).cast("long").alias("k"), (F.col("id") % 3).alias("v"))
    out = quality.reconcile_keyed(hot, hot.where(F.col("v") != 2), "k")
    r = out.collect()
    assert len(r) == 1 and r[0].n_left == 20000 and r[0].n_right < 20000


def test_orphans_null_fk_is_orphan(spark):
    fact = spark.createDataFrame([(1, 10), (2, None), (3, 99)], "id long, fk long")
    dim = spark.createDataFrame([(10,), (11,)], "pk long")
    assert rows(quality.orphans(fact, "fk", dim, "pk"), "id") == [(2,), (3,)]


def test_fk_report_counts(spark):
    fact = spark.createDataFrame([(10,), (10,), (None,), (99,), (11,)], "fk long")
    dim = spark.createDataFrame([(10,), (11,), (11,)], "pk long")
    rep = quality.fk_report(fact, [quality.ForeignKey("fk", dim, "pk")]).collect()[0]
    assert (rep.fk_column, rep.n_rows, rep.n_null, rep.n_orphan) == ("fk", 5, 1, 1)


def test_fk_orphans_count_sf0_01(spark):
    from tessera.plans import catalog
    n = catalog.fk_orphans(spark, "/root/testdata/sf0.01").count()
    assert n == 332   # every 7th customer has no nation, every other 11th one that does not exist


def test_reconcile_keyed_sees_middle_values_and_pairing(spark):
    def both(a, b):
        left, right = (spark.createDataFrame(x, "k long, v long, w long") for x in (a, b))
        return rows(quality.reconcile_keyed(left, right, "k"), "k", "n_left", "n_right", "diff_columns")

    assert both([(1, 1, 0), (1, 2, 0), (1, 5, 0)], [(1, 1, 0), (1, 3, 0), (1, 5, 0)]) == [(1, 3, 3, "v")]
    assert both([(1, 1, 10), (1, 2, 20)], [(1, 1, 20), (1, 2, 10)]) == [(1, 2, 2, "*")]
    assert both([(1, 1, None), (None, 2, 2)], [(1, 1, None), (None, 2, 3)]) == [(None, 1, 1, "w")]
    assert both([(1, 1, 1), (1, 1, 1)], [(1, 1, 1)]) == [(1, 2, 1, "v,w")]
    assert both([(1, 1, 1)], [(1, 1, 1)]) == []


def test_reconcile_keyed_has_no_sort(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b")], "k long, s string")
    plan = plan_text(quality.reconcile_keyed(left, left, "k"))
    assert "SortAggregate" not in plan and "CartesianProduct" not in plan


def test_fk_checks_compare_in_the_keys_own_types(spark):
    fact = spark.createDataFrame([(1, "10", 5), (2, "11", 4294967297), (None, "x", 7)], "a int, b string, c long")
    a = spark.createDataFrame([(1.0,), (2.0,)], "k double")
    b = spark.createDataFrame([(10,), (11,)], "k long")
    c = spark.createDataFrame([(5,), (7,)], "k int")
    keys = [quality.ForeignKey("a", a, "k"), quality.ForeignKey("b", b, "k"), quality.ForeignKey("c", c, "k")]
    want = [("a", 3, 1, 0), ("b", 3, 0, 1), ("c", 3, 0, 1)]
    for bound in (None, 1, 0):   # all dimensions small; none of them
        assert rows(quality.fk_report(fact, keys, bound), "fk_column", "n_rows", "n_null", "n_orphan") == want
    assert quality.orphans(fact, "a", a, "k").count() == 1 and quality.orphans(fact, "b", b, "k").count() == 1
    wide = spark.createDataFrame([(4294967297,), (1,), (2,)], "k long")
    assert quality.fk_report(fact, [quality.ForeignKey("a", wide, "k")]).first().n_orphan == 0


def test_fk_report_does_not_shuffle_the_fact_for_small_dimensions(spark):
    fact = spark.range(1000).select((F.col("id") % 7).alias("k"))
    plan = plan_text(quality.fk_report(fact, [quality.ForeignKey("k", spark.range(5), "id")]))
    assert "SortMergeJoin" not in plan and "Generate explode" not in plan


def test_expect_schema(spark):
    df = spark.createDataFrame([(1, "a")], "id long, name string")
    ok = StructType([StructField("id", LongType()), StructField("name", StringType())])
    assert quality.expect_schema(df, ok) == []
    bad = StructType([StructField("id", StringType()), StructField("other", StringType())])
    problems = quality.expect_schema(df, bad)
    assert "id: bigint != string" in problems and "missing column other" in problems
    assert "unexpected column name" in problems


def test_a_date_meets_its_first_moment(spark):
    days = spark.sql("select date'2024-01-01' as d, timestamp'2024-01-01 00:00:00' as t, timestamp_ntz'2024-01-01 00:00:00' as n")
    late = spark.sql("select timestamp_ntz'2024-01-01 00:00:01' as n")
    for a in "dtn":
        for b in "dtn":
            assert quality.orphans(days, a, days, b).count() == 0
            assert quality.fk_report(days, [quality.ForeignKey(a, days, b)]).first().n_orphan == 0
    assert quality.orphans(late, "n", days, "d").count() == 1
