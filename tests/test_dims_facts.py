"""Dimensions, surrogate keys and fact resolution."""

import hashlib
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, plan_text, rows
from tessera.functions.keys import sha_key
from tessera.operators import dims, facts
from tessera.plans import catalog
from tessera.plans import derived as D


def test_sha_key_matches_hashlib(spark):
    df = spark.createDataFrame([("A", "B", "C")], "a string, b string, c string")
    out = dims.build_dimension(df, ["a", "b", "c"], "k", default=None)
    assert out.collect()[0]["k"] == hashlib.sha256(b"A||B||C").hexdigest()


def test_default_member_added_once(spark):
    df = spark.createDataFrame([("x", "y"), ("N/A", "N/A"), ("x", "y")], "a string, b string")
    out = dims.build_dimension(df, ["a", "b"], "k")
    assert rows(out, "a", "b") == [("N/A", "N/A"), ("x", "y")]
    clean = spark.createDataFrame([("x", "y")], "a string, b string")
    assert rows(dims.build_dimension(clean, ["a", "b"], "k"), "a", "b") == [("N/A", "N/A"), ("x", "y")]


def test_concat_ws_collision_and_null_token(spark):
    df = spark.createDataFrame([("A", None, "B"), ("A", "B", None)], "a string, b string, c string")
    plain = dims.build_dimension(df, ["a", "b", "c"], "k", default=None, check_unique=False)
    assert len({r.k for r in plain.collect()}) == 1
    with pytest.raises(ValueError):
        dims.build_dimension(df, ["a", "b", "c"], "k", default=None)
    safe = dims.build_dimension(df, ["a", "b", "c"], "k", default=None, null_token="␀")
    assert len({r.k for r in safe.collect()}) == 2


def test_murmur3_key_golden(spark):
    df = spark.createDataFrame([(" furniture ",)], "ProductCategory string")
    out = dims.add_hash_key(df, ["ProductCategory"], "DIM_ProductCategoryID")
    r = out.collect()[0]
    assert r.ProductCategory == "FURNITURE"
    assert r.DIM_ProductCategoryID == -871983438
    assert dict(out.dtypes)["DIM_ProductCategoryID"] == "bigint"


def test_mapping_key_on_raw_codes(spark):
    df = spark.createDataFrame([("a", "x", "p", "L1"), ("A ", "x", "p", "L2")], "c1 string, c2 string, c3 string, lab string")
    raw = dims.build_mapping(df, ["c1", "c2", "c3"], "lab", "id")
    assert raw.columns == ["id", "c1", "c2", "c3", "lab"]
    assert len({r.id for r in raw.collect()}) == 2          # two spellings, two keys
    assert {r.c1 for r in raw.collect()} == {"A"}
    first = dims.build_mapping(df, ["c1", "c2", "c3"], "lab", "id", normalize_first=True)
    assert len({r.id for r in first.collect()}) == 1


def test_resolve_star_keeps_rows_and_computed_keys_equal_joined_keys(spark):
    fact, specs, named = catalog._star(spark, SF_SMALL)
    computed = facts.resolve_star(fact, specs, keep=catalog.FACT_MEASURES)
    joined = facts.resolve_star(fact, [replace(s, sha=False) for s in specs], keep=catalog.FACT_MEASURES)
    assert computed.count() == fact.count()
    assert rows(computed) == rows(joined)
    assert rows(facts.resolve_star(fact, specs, keep=catalog.FACT_MEASURES, keys_from=named)) == rows(joined)
    assert computed.where(F.col("DIM_ProductId").isNull()).count() == 0


def test_dimension_keys_unique(spark):
    named = D.sales_named(spark, SF_SMALL)
    for cols, key in ((catalog.PRODUCT, "P"), (catalog.STORE, "S"), (catalog.EMPLOYEE, "E")):
        dim = dims.build_dimension(named, cols, key)
        assert dim.count() == dim.select(key).distinct().count()


def test_unknown_member_routing(spark):
    fact = spark.createDataFrame([("a", 1), ("zz", 2), (None, 3)], "code string, v int")
    none = dims.build_dimension(spark.createDataFrame([("a",)], "code string"), ["code"], "k", default=None)
    with pytest.raises(ValueError):
        facts.resolve_keys(fact, facts.DimSpec(none, ["code"], "k"), unknown_member="N/A")
    other = dims.build_dimension(spark.createDataFrame([("a", "b")], "x string, y string"), ["x", "y"], "k", sep="~")
    two = spark.createDataFrame([("a", "q")], "x string, y string")
    for sha in (False, True):   # the surrogate is the dimension's own
        got = facts.resolve_star(two, [facts.DimSpec(other, ["x", "y"], "k", sha=sha, sep="~")], unknown_member="N/A").first().k
        assert got == other.where("x = 'N/A'").first().k
    numbered = dims.add_hash_key(spark.createDataFrame([("A",), ("N/A",)], "code string"), ["code"], "k")
    got = facts.resolve_keys(fact.withColumn("code", F.upper("code")), facts.DimSpec(numbered, ["code"], "k"), unknown_member="N/A")
    assert {r.v: r.k for r in got.collect()}[2] == numbered.where("code = 'N/A'").first().k
    dim = dims.build_dimension(spark.createDataFrame([("a",)], "code string"), ["code"], "k")
    plain = facts.resolve_keys(fact, facts.DimSpec(dim, ["code"], "k"))
    assert sum(r.k is None for r in plain.collect()) == 2
    routed = facts.resolve_keys(fact, facts.DimSpec(dim, ["code"], "k"), unknown_member="N/A")
    na = hashlib.sha256(b"N/A").hexdigest()
    assert sorted(r.k == na for r in routed.collect()) == [False, True, True]


def test_net_revenue_nulls(spark):
    df = spark.createDataFrame([(2.0, 10.0, 0.1), (None, 10.0, 0.1), (2.0, 10.0, None)], "u double, p double, d double")
    out = facts.net_revenue(df, "u", "p", "d", out="r")
    assert [r.r for r in out.collect()] == [2.0 * 10.0 * (1 - 0.1), None, None]
    pct = facts.net_revenue(spark.createDataFrame([(1.0, 100.0, 5.0)], "u double, p double, d double"),
                            "u", "p", "d", out="r", discount_unit="percent")
    assert pct.collect()[0].r == 95.0


def test_mapping_resolution_keeps_rows_and_leaves_unlisted_codes_unlabelled(spark):
    tx = D.transactions(spark, SF_SMALL)
    out = catalog.fact_resolve_mapping(spark, SF_SMALL)
    assert out.count() == tx.count()
    unlisted = tx.where(F.col("TransactionID") % 29 == 0).count()
    assert unlisted > 0
    for key in ("DIM_CustomLabelID", "DIM_ProductCategoryID"):
        assert out.where(F.col(key).isNull()).count() == unlisted
    assert out.where(F.col("DIM_StoreRegionID").isNull()).count() == 0


def test_strangers_of_a_sha_dimension_get_no_key(spark):
    fact = spark.createDataFrame([("a", "x", 1), ("b", "y", 2), ("a", None, 3), ("a", "x", 4)], "p string, q string, v int")
    dim = dims.build_dimension(spark.createDataFrame([("a", "x")], "p string, q string"), ["p", "q"], "k")
    for bound in (None, 0):
        sha = facts.resolve_star(fact, [facts.DimSpec(dim, ["p", "q"], "k", sha=True)], max_broadcast_rows=bound)
        plain = facts.resolve_star(fact, [facts.DimSpec(dim, ["p", "q"], "k")], max_broadcast_rows=bound)
        assert rows(sha, "v", "k") == rows(plain, "v", "k")
        assert [r[1] is None for r in rows(sha, "v", "k")] == [False, True, True, False]


def test_sha_star_does_not_shuffle_the_fact(spark):
    spark.conf.set("tessera.broadcast.maxRows", "10")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        named = D.sales_named_stage(spark, SF_SMALL)
        specs = list(catalog._dims(named).values())
        plan = plan_text(facts.resolve_star(named, specs, keep=catalog.FACT_MEASURES))
    finally:
        spark.conf.unset("tessera.broadcast.maxRows")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Join" not in plan and "Exchange" not in plan


def test_hash_collisions_are_refused(spark):
    codes = spark.range(300_000).select(F.col("id").cast("string").alias("code"))
    with pytest.raises(ValueError):
        dims.add_hash_key(codes, ["code"], "k", conform=False)
    assert dims.add_hash_key(codes.limit(100), ["code"], "k", algo="xxhash64", conform=False).count() == 100


def test_no_missing_values_left_after_cleaning(spark):
    clean = D.sales_clean(spark, SF_SMALL)
    for c in ("ProductName", "UnitsSold", "UnitPrice", "Discount"):
        assert clean.where(F.col(c).isNull()).count() == 0, c
    assert clean.where(F.col("UnitPrice") == -1).count() == 0
    assert clean.count() == D.sales(spark, SF_SMALL).count()


def test_check_unique_rejects_fan_out(spark):
    fact = spark.createDataFrame([("a", 1)], "code string, v int")
    dup = spark.createDataFrame([("a", "k1"), ("a", "k2")], "code string, k string")
    with pytest.raises(ValueError):
        facts.resolve_keys(fact, facts.DimSpec(dup, ["code"], "k"), check_unique=True)
    ok = spark.createDataFrame([("a", "k1")], "code string, k string")
    assert facts.resolve_keys(fact, facts.DimSpec(ok, ["code"], "k"), check_unique=True).count() == 1


def test_separator_in_a_natural_key_makes_no_member(spark):
    dim = dims.build_dimension(spark.createDataFrame([("a||b", "c"), ("x", "y")], "p string, q string"), ["p", "q"], "k")
    fact = spark.createDataFrame([("a||b", "c", 1), ("a", "b||c", 2), ("x", "y", 3), (None, "y", 4)], "p string, q string, v int")
    got = facts.resolve_star(fact, [facts.DimSpec(dim, ["p", "q"], "k", sha=True)], keep=["v"])
    want = facts.resolve_star(fact, [facts.DimSpec(dim, ["p", "q"], "k")], keep=["v"])
    assert rows(got, "v", "k") == rows(want, "v", "k") and [r.v for r in got.where("k is null").collect()] in ([2, 4], [4, 2])


def test_two_members_of_one_surrogate_are_refused(spark):
    both = spark.createDataFrame([("a||b", "c"), ("a", "b||c")], "p string, q string")
    dim = dims.build_dimension(both, ["p", "q"], "k", check_unique=False)
    with pytest.raises(ValueError, match="share a key"):
        facts.resolve_star(both, [facts.DimSpec(dim, ["p", "q"], "k", sha=True)])


def test_natural_keys_of_other_types_meet_as_in_a_join(spark):
    dim = spark.createDataFrame([(1, 0.0), (2, 2.5)], "n long, x double")
    dim = dim.withColumn("k", sha_key(["n", "x"]))
    fact = spark.createDataFrame([(1, 0.0), (2, 2.5), (3, 2.5)], "n int, x double")
    got = facts.resolve_star(fact, [facts.DimSpec(dim, ["n", "x"], "k", sha=True)])
    assert sorted((r.n, r.k is None) for r in got.collect()) == [(1, False), (2, False), (3, True)]


def test_sales_shuffle_their_lines_twice_at_most(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_text(D.sales(spark, SF_SMALL), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Lines by order and by part, orders and customers by customer, parts, orders by order.
    assert plan.count("Exchange hashpartitioning") <= 6
    assert "s_suppkey" not in "".join(x for x in plan.splitlines() if "Exchange hashpartitioning" in x)


def test_unknown_member_star_joins_its_sales_once(spark, monkeypatch):
    from tessera.plans import catalog

    calls, sales = [], D.sales
    monkeypatch.setattr(D, "sales", lambda *a: calls.append(a) or sales(*a))
    out = catalog.unknown_member_star(spark, SF_SMALL)
    assert len(calls) == 1 and out.agg(F.sum("n_sales")).first()[0] == sales(spark, SF_SMALL).count()
