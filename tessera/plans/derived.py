"""Inputs derived from the test tables (``FIXTURES.md`` §3).

The test tables have no nulls, no sentinels and no orphans, so the cleaning
and QA operators get inputs derived from them by fixed rules: a value is
nulled or replaced when a key is divisible by a small prime. Every derivation
reads the whole table; nothing here is a sample. The same rules are written
in SQL in ``tessera.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.keys import normalize
from tessera.operators import clean
from tessera.operators.joins import checked_broadcast
from tessera.session import scratch_path
from tessera.sources.io import read_stage, read_table, spread, write_stage

# Literal name map used to impute missing product names (three
# of the six part types, so the default is also hit), the price sentinel, and
# a priority code that no dimension lists.
NAME_MAP = {
    "ECONOMY": "economy pack",
    "PROMO": "promo bundle",
    "STANDARD": "standard kit",
}
UNITS_SENTINEL = -1.0
UNLISTED_CODE = "9-UNLISTED"
# Stages hold hex keys, which zstd halves and snappy leaves as they are.
STAGE_CODEC = "zstd"
# Suppliers that may be broadcast if their measured bytes are within bounds, too.
MOST_SUPPLIERS = 1_000_000


def _null(dtype: str):
    return F.lit(None).cast(dtype)


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw sales rows: one per line item, with nulls and a ``-1`` price sentinel."""
    li = spread(read_table(spark, sf_dir, "lineitem",
                           ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_shipdate"]))
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_brand", "p_type", "p_retailprice"])
    supp = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_name", "s_nationkey"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderpriority"])
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_mktsegment"])

    # Orders meet their customers first, so the lines are shuffled once for both.
    # Parts and suppliers, which one side of a join holds whole, come after:
    # below the planner's bound they cost no shuffle. Supplier, nation and
    # region are joined first and broadcast where they are measured small.
    placed, _ = checked_broadcast(supp.join(nation, supp.s_nationkey == nation.n_nationkey)
                                  .join(region, nation.n_regionkey == region.r_regionkey)
                                  .select("s_suppkey", "s_name", "n_name", "r_name"), MOST_SUPPLIERS)
    taken = orders.join(cust, orders.o_custkey == cust.c_custkey).select("o_orderkey", "o_orderpriority", "c_name", "c_mktsegment")
    rows = (li.join(taken, li.l_orderkey == taken.o_orderkey)
              .join(part, li.l_partkey == part.p_partkey)
              .join(placed, li.l_suppkey == placed.s_suppkey))
    ok = F.col("l_orderkey")
    return rows.select(
        F.col("p_type").alias("ProductCategory"),
        F.when(F.col("l_partkey") % 11 == 0, _null("string")).otherwise(F.col("p_name")).alias("ProductName"),
        F.col("p_brand").alias("Brand"),
        F.col("r_name").alias("StoreRegion"),
        F.col("s_name").alias("StoreName"),
        F.col("n_name").alias("StoreType"),
        F.col("c_name").alias("SalesRep"),
        F.col("c_mktsegment").alias("Department"),
        F.col("o_orderpriority").alias("EmployeeRole"),
        F.when(ok % 13 == 0, _null("int")).otherwise(F.col("l_quantity").cast("int")).alias("UnitsSold"),
        F.when(ok % 17 == 0, F.lit(UNITS_SENTINEL))
         .when(ok % 19 == 0, _null("double"))
         .otherwise(F.col("p_retailprice")).alias("UnitPrice"),
        F.when(ok % 23 == 0, _null("double")).otherwise(F.col("l_discount")).alias("Discount"),
        F.col("l_shipdate").cast("date").alias("SaleDate"),
    )


def name_sales(df: DataFrame) -> DataFrame:
    """Missing product names of sales filled from the literal map."""
    return clean.impute_by_map(df, "ProductName", "ProductCategory", NAME_MAP)


def sales_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage 1: missing product names filled from the literal map."""
    return name_sales(sales(spark, sf_dir))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a stage table in the shared checkpoint folder and
    read it back. Later steps that use it several times (a statistic, then a
    join back; several dimensions) scan the compact stage instead of
    re-running the joins that produced it, and its lineage ends here."""
    return read_stage(df.sparkSession, write_stage(df, scratch_path(df.sparkSession, name), compression=STAGE_CODEC))


def sales_named_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(sales_named(spark, sf_dir), "sales-stage1")


UNITS = clean.Fill("UnitsSold", "mean")
PRICE = clean.Fill("UnitPrice", "median", sentinel=UNITS_SENTINEL)
DISCOUNT = clean.Fill("Discount", "median")


def clean_sales(df: DataFrame) -> DataFrame:
    """Stages 2-4 on a named sales frame: units by category mean; price by
    category median without the -1 sentinel; discount by category median."""
    return clean.impute_columns(df, "ProductCategory", [UNITS, PRICE, DISCOUNT])


def sales_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_sales(sales_named_stage(spark, sf_dir))


def _orders_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice"])
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    return (orders.join(cust, orders.o_custkey == cust.c_custkey)
                  .join(nation, cust.c_nationkey == nation.n_nationkey)
                  .join(region, nation.n_regionkey == region.r_regionkey))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions whose codes arrive with stray spaces and lower case; every
    29th order has a category that no dimension lists."""
    return _orders_geo(spark, sf_dir).select(
        F.col("o_orderkey").alias("TransactionID"),
        F.concat(F.lit("  "), F.lower(F.when(F.col("o_orderkey") % 29 == 0, F.lit(UNLISTED_CODE))
                                      .otherwise(F.col("o_orderpriority"))), F.lit(" ")).alias("ProductCategory"),
        F.concat(F.lit(" "), F.col("r_name")).alias("StoreRegion"),
        F.lower("c_mktsegment").alias("CustomerType"),
        F.col("o_totalprice").alias("Amount"),
    )


def conformed_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir)
    return tx.withColumns({c: normalize(c) for c in ("ProductCategory", "StoreRegion", "CustomerType")})


def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bridge rows: every observed (priority, region, segment) combination,
    labelled ``priority/region/segment``."""
    combos = (_orders_geo(spark, sf_dir)
              .select(F.col("o_orderpriority").alias("ProductCategory"),
                      F.col("r_name").alias("StoreRegion"),
                      F.col("c_mktsegment").alias("CustomerType"))
              .distinct())
    return combos.withColumn("MappingLabel",
                             F.concat_ws("/", "ProductCategory", "StoreRegion", "CustomerType"))


def code_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Raw code lists for the three single-code dimensions."""
    return {
        "ProductCategory": read_table(spark, sf_dir, "orders", ["o_orderpriority"])
        .select(F.col("o_orderpriority").alias("ProductCategory")).distinct(),
        "StoreRegion": read_table(spark, sf_dir, "region", ["r_name"])
        .select(F.col("r_name").alias("StoreRegion")),
        "CustomerType": read_table(spark, sf_dir, "customer", ["c_mktsegment"])
        .select(F.col("c_mktsegment").alias("CustomerType")).distinct(),
    }


def punches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Punch log from events: even event ids punch IN, odd ones OUT."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id"])
    return ev.select(
        "event_id",
        F.col("user_id").alias("emp_id"),
        F.col("ts").alias("punch_time"),
        F.to_date("ts").alias("work_date"),
        F.when(F.col("event_id") % 2 == 0, F.lit("IN")).otherwise(F.lit("OUT")).alias("punch_type"),
    )


def punch_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The punch log as it arrives from a clock: times as text."""
    return punches(spark, sf_dir).select(
        "event_id", "emp_id",
        F.date_format("punch_time", "yyyy-MM-dd HH:mm:ss").alias("punch_time"),
        "punch_type")


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "customer", ["c_custkey", "c_name"]).select(
        F.col("c_custkey").alias("emp_id"), F.col("c_name").alias("emp_name"))


def customers_missing_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])
    return c.select("c_custkey", F.when(F.col("c_custkey") % 4 == 0, _null("string"))
                    .otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))


def customer_nation_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a nullable nation reference; every 11th refers to a nation that does not exist."""
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey"])
    return c.select("c_custkey", "c_name",
                    F.when(F.col("c_custkey") % 7 == 0, _null("int"))
                    .when(F.col("c_custkey") % 11 == 0, F.col("c_nationkey") + 100)
                    .otherwise(F.col("c_nationkey")).alias("c_nationkey"))


def supplier_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations by supplier: a nation list with repeats for customers to refer to."""
    return read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])


def nation_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations keyed by a nullable key: the last nation's key is unknown."""
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    return n.select(F.when(F.col("n_nationkey") == 24, _null("int"))
                    .otherwise(F.col("n_nationkey")).alias("nation_key"), "n_name")


def lineitem_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Line-item measures and a copy with quantity + 1 on every thousandth order."""
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate"])
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_shipdate"]
    left = li.select(*cols)
    right = li.select(
        F.when(F.col("l_orderkey") % 1000 == 0, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
        .alias("l_quantity"), *cols[1:])
    return left, right


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def orders_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders and a copy whose price is lost on every 100th key and off by one on every 101st."""
    o = read_table(spark, sf_dir, "orders", ORDER_COLUMNS)
    k = F.col("o_orderkey")
    price = (F.when(k % 100 == 0, _null("double"))
              .when(k % 101 == 0, F.col("o_totalprice") + 1)
              .otherwise(F.col("o_totalprice")))
    right = o.select(*[price.alias(c) if c == "o_totalprice" else F.col(c) for c in ORDER_COLUMNS])
    return o, right


def lineitem_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-item references; some point at parts and suppliers that do not exist."""
    li = read_table(spark, sf_dir, "lineitem", ["l_partkey", "l_suppkey", "l_orderkey"])
    ok = F.col("l_orderkey")
    return li.select(F.when(ok % 31 == 0, -F.col("l_partkey")).otherwise(F.col("l_partkey")).alias("l_partkey"),
                     F.when(ok % 37 == 0, -F.col("l_suppkey")).otherwise(F.col("l_suppkey")).alias("l_suppkey"),
                     "l_orderkey")


def fk_dims(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Dimensions for the line-item FK report, whole."""
    return {
        "part": read_table(spark, sf_dir, "part", ["p_partkey"]),
        "supplier": read_table(spark, sf_dir, "supplier", ["s_suppkey"]),
        "orders": read_table(spark, sf_dir, "orders", ["o_orderkey"]),
    }
