"""The query catalogue: one entry per operator of the inventory.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
test tables (or frames Spark derives from them). The matching DuckDB SQL is in
``tessera.plans.oracle``; column names agree so results compare directly.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tessera.operators import attendance, clean, dims, facts, joins, profile, quality, recipes
from tessera.operators.stats import group_median
from tessera.plans import derived as D
from tessera.plans import upkeep
from tessera.session import scratch_path
from tessera.sources import io

Query = Callable[[SparkSession, str], DataFrame]

PRODUCT = ["ProductCategory", "ProductName", "Brand"]
STORE = ["StoreRegion", "StoreName", "StoreType"]
EMPLOYEE = ["SalesRep", "Department", "EmployeeRole"]
FACT_MEASURES = ["UnitsSold", "UnitPrice", "Discount", "SaleDate"]
CODES = ["ProductCategory", "StoreRegion", "CustomerType"]
# Money columns in the test tables carry two decimals; sums over them are exact.
MONEY_SCALE = 2


# --- recipes -----------------------------------------------------------------

def total_per_key(spark, sf):
    o = io.read_table(spark, sf, "orders", ["o_custkey", "o_totalprice"])
    return recipes.total_per_key(o, "o_custkey", "o_totalprice", out="total_amount", scale=MONEY_SCALE)


def max_per_day(spark, sf):
    o = io.read_table(spark, sf, "orders", ["o_orderdate", "o_totalprice"])
    return recipes.max_per_key(o, F.to_date("o_orderdate").alias("order_day"), "o_totalprice",
                               out="max_amount")


def avg_per_group(spark, sf):
    p = io.read_table(spark, sf, "part", ["p_name", "p_retailprice"])
    return recipes.avg_per_key(p, "p_name", "p_retailprice", out="avg_price", scale=MONEY_SCALE)


def fill_constant(spark, sf):
    return clean.fill_constant(D.customers_missing_segment(spark, sf), "Unknown", ["c_mktsegment"])


def partition_total(spark, sf):
    o = io.read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_totalprice"])
    return recipes.partition_total(o, "o_custkey", "o_totalprice", out="customer_total", scale=MONEY_SCALE)


def running_total(spark, sf):
    o = io.read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"])
    return recipes.running_total(o, "o_custkey", ["o_orderdate", "o_orderkey"], "o_totalprice",
                                 out="running_amount", scale=MONEY_SCALE)


def extract_year(spark, sf):
    o = io.read_table(spark, sf, "orders", ["o_orderkey", "o_orderdate"])
    text = o.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"))
    return recipes.extract_year(text, "order_date", out="order_year")


def inner_join(spark, sf):
    p = io.read_table(spark, sf, "part", ["p_partkey", "p_name"])
    li = io.read_table(spark, sf, "lineitem", ["l_partkey", "l_orderkey", "l_linenumber", "l_extendedprice"])
    return p.join(li.withColumnRenamed("l_partkey", "p_partkey"), on="p_partkey", how="inner")


def explode_tags(spark, sf):
    p = io.read_table(spark, sf, "part", ["p_partkey", "p_name"])
    return recipes.explode_tags(p, "p_name", sep=" ", out="tag").select("p_partkey", "tag")


def top_n_per_group(spark, sf):
    o = io.read_table(spark, sf, "orders", ["o_orderkey", "o_orderpriority", "o_totalprice"])
    return recipes.top_n_per_group(o, "o_orderpriority",
                                   [F.desc("o_totalprice"), F.asc("o_orderkey")], 2)


def null_safe_outer_join(spark, sf):
    cust = D.customer_nation_refs(spark, sf)
    return joins.null_safe_join(cust, D.nation_lookup(spark, sf), "c_nationkey", "nation_key", "full")


# --- profiling and imputation ------------------------------------------------

def value_frequency(spark, sf):
    return profile.value_frequency(D.sales(spark, sf), ["ProductCategory", "ProductName"],
                                   out="n_rows", non_null=["ProductName"])


def mode_per_group(spark, sf):
    return profile.mode_by_group(D.sales(spark, sf), "ProductCategory", "ProductName",
                                 out="MostCommonProductName")


def map_impute(spark, sf):
    return D.sales_named(spark, sf)


def mean_fill(spark, sf):
    return clean.impute_by_group(D.sales_named_stage(spark, sf), "ProductCategory", "UnitsSold", "mean")


def median_per_group(spark, sf):
    return group_median(D.sales(spark, sf), "ProductCategory", "Discount", out="median_discount")


def median_excluding_sentinel(spark, sf):
    return group_median(D.sales(spark, sf), "ProductCategory", "UnitPrice", out="median_price",
                        where=f"UnitPrice <> {D.UNITS_SENTINEL}")


def median_approx(spark, sf):
    """``percentile_approx`` per part type; exact here, as groups are smaller than its accuracy."""
    return group_median(io.read_table(spark, sf, "part", ["p_type", "p_retailprice"]), "p_type", "p_retailprice",
                        out="median_price", method="approx")


def sentinel_fill_median(spark, sf):
    return clean.impute_columns(D.sales_named_stage(spark, sf), "ProductCategory", [D.UNITS, D.PRICE])


def median_fill(spark, sf):
    return D.sales_clean(spark, sf)


# --- dimensions and facts ----------------------------------------------------

STAR = {"DIM_ProductId": PRODUCT, "DIM_StoreId": STORE, "DIM_EmployeeId": EMPLOYEE}


def _dims(named, keys=tuple(STAR), default=dims.DEFAULT_MEMBER):
    """Dimensions of the staged sales, written side by side, with their specs by key."""
    def build(key):
        dim = D.stage(dims.build_dimension(named, STAR[key], key, default=default, check_unique=False), key)
        return key, facts.DimSpec(dim, STAR[key], key, sha=True)

    with ThreadPoolExecutor(len(keys)) as pool:
        return dict(pool.map(build, keys))


def _dim(spark, sf, key):
    """A dimension of its own: its columns are made distinct in the pass that makes them, nothing else is staged."""
    return dims.build_dimension(D.sales_named(spark, sf), STAR[key], key)


def dim_product(spark, sf):
    return _dim(spark, sf, "DIM_ProductId")


def dim_store(spark, sf):
    return _dim(spark, sf, "DIM_StoreId")


def dim_employee(spark, sf):
    return _dim(spark, sf, "DIM_EmployeeId")


def dim_with_default(spark, sf):
    """A dimension whose source already holds its default member: it stays one row."""
    store = D.sales_named(spark, sf).select(*STORE)
    return dims.build_dimension(store.unionByName(dims.default_member(store, STORE)), STORE, "DIM_StoreId")


def _star(spark, sf):
    """Cleaned sales, the three dimensions, and the stage that both come from."""
    named = D.sales_named_stage(spark, sf)
    return D.clean_sales(named), list(_dims(named).values()), named


def _resolved_star(spark, sf):
    # Cleaning changes no natural key, so membership is checked on the stage.
    fact, specs, named = _star(spark, sf)
    return facts.resolve_star(fact, specs, keep=FACT_MEASURES, keys_from=named), fact, specs


def fact_resolve_star(spark, sf):
    return _resolved_star(spark, sf)[0]


def net_revenue(spark, sf):
    return facts.net_revenue(fact_resolve_star(spark, sf))


def revenue_by_brand(spark, sf):
    """Flagship star query: clean, build three dimensions, resolve their keys, derive revenue,
    and total the resolved sales per brand through the product dimension."""
    star, _, specs = _resolved_star(spark, sf)
    resolved = facts.net_revenue(star.where(F.col("DIM_StoreId").isNotNull() & F.col("DIM_EmployeeId").isNotNull()), scale=MONEY_SCALE)
    per_product = resolved.groupBy("DIM_ProductId").agg(F.sum("NetRevenue").alias("r"), F.count(F.lit(1)).alias("n"))
    product = specs[0].dim.select("DIM_ProductId", "Brand")
    return (per_product.join(product, on="DIM_ProductId", how="inner").groupBy("Brand")
            .agg(F.sum("r").cast("double").alias("revenue"), F.sum("n").alias("n_sales")))


def star_fk_report(spark, sf):
    """The resolved star fact checked against its own dimensions (expected: no orphans)."""
    resolved, _, specs = _resolved_star(spark, sf)
    return quality.fk_report(resolved, [quality.ForeignKey(s.surrogate_key, s.dim, s.surrogate_key)
                                        for s in specs])


def star_reconcile(spark, sf):
    """Cleaned sales against the resolved fact on their common measures (expected: equal)."""
    resolved, fact, _ = _resolved_star(spark, sf)
    return quality.reconcile_summary(fact.select(*FACT_MEASURES), resolved)


def star_ambiguous_keys(spark, sf):
    """Natural keys that hold the key separator: a fact whose parts only join to a member's text is no such member."""
    p = io.read_table(spark, sf, "part", ["p_partkey", "p_brand", "p_type", "p_name"])
    dim = dims.build_dimension(p.select(F.concat_ws("||", "p_brand", "p_type").alias("line"), F.col("p_name").alias("label")),
                               ["line", "label"], "DIM_LineId")
    fact = p.select("p_partkey", *[F.when(F.col("p_partkey") % 2 == 0, a).otherwise(b).alias(c) for c, a, b in (
        ("line", F.concat_ws("||", "p_brand", "p_type"), F.col("p_brand")), ("label", F.col("p_name"), F.concat_ws("||", "p_type", "p_name")))])
    return facts.resolve_star(fact, [facts.DimSpec(dim, ["line", "label"], "DIM_LineId", sha=True)], keep=["p_partkey"])


def fk_report_dates(spark, sf):
    """Order dates, as dates and as moments, against a calendar of the other type that lacks a weekday."""
    o = io.read_table(spark, sf, "orders", ["o_orderdate"])
    fact = o.select(F.to_date("o_orderdate").alias("day"), F.to_date("o_orderdate").cast("timestamp_ntz").alias("moment"))
    calendar = fact.select("day").distinct().where(F.weekday("day") != 6)
    return quality.fk_report(fact, [quality.ForeignKey("day", calendar.select(F.col("day").cast("timestamp_ntz").alias("at")), "at"),
                                    quality.ForeignKey("moment", calendar, "day")])


def median_fill_long(spark, sf):
    """Missing long values, beyond what a double holds, by their group's exact median."""
    o = io.read_table(spark, sf, "orders", ["o_orderkey", "o_orderpriority"])
    big = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderkey") * 2 + (1 << 60) + 1).alias("serial")
    return clean.impute_by_group(o.select("o_orderkey", "o_orderpriority", big), "o_orderpriority", "serial", "median", scale=None)


def unknown_member_star(spark, sf):
    """Sales resolved against a product dimension without the products that were not named: they go to N/A."""
    # Only the product columns are asked for, and staged once for the facts and the dimension.
    raw = D.stage(D.sales(spark, sf).select(*PRODUCT), "sales-products")
    named = D.name_sales(raw)
    known = raw.where(F.col("ProductName").isNotNull())
    dim = dims.build_dimension(known, PRODUCT, "DIM_ProductId")
    spec = facts.DimSpec(dim, PRODUCT, "DIM_ProductId", sha=True)
    out = facts.resolve_star(named, [spec], keep=PRODUCT, unknown_member=dims.DEFAULT_MEMBER)
    return out.groupBy("DIM_ProductId").agg(F.count(F.lit(1)).alias("n_sales"))


def star_flow_persisted(spark, sf):
    """The star as tables: dimensions and fact written, the fact rewritten with its
    revenue, all read back and the fact compared with the cleaned sales."""
    fact, specs, named = _star(spark, sf)
    fact = D.stage(fact, "sales-clean")
    first = D.stage(facts.resolve_star(fact, specs, keep=FACT_MEASURES, keys_from=named), "fact-sales")
    path = io.write_stage(facts.net_revenue(first), scratch_path(spark, "fact-sales-revenue"), evolve=True, compression=D.STAGE_CODEC)
    final = io.read_stage(spark, path)
    dims_there = [quality.ForeignKey(s.surrogate_key, s.dim, s.surrogate_key) for s in specs]
    orphans = quality.fk_report(final, dims_there).agg(F.sum("n_orphan").alias("n_orphan"), F.sum("n_null").alias("n_null"))
    summary = quality.reconcile_summary(fact.select(*FACT_MEASURES), final)
    return summary.withColumn("one", F.lit(1)).join(orphans.withColumn("one", F.lit(1)), "one").drop("one")


def fk_orphans(spark, sf):
    cust = D.customer_nation_refs(spark, sf).select("c_custkey", "c_nationkey")
    return quality.orphans(cust, "c_nationkey", D.supplier_nations(spark, sf), "s_nationkey")


def fk_report(spark, sf):
    li = D.lineitem_refs(spark, sf)
    d = D.fk_dims(spark, sf)
    return quality.fk_report(li, [
        quality.ForeignKey("l_partkey", d["part"], "p_partkey"),
        quality.ForeignKey("l_suppkey", d["supplier"], "s_suppkey"),
        quality.ForeignKey("l_orderkey", d["orders"], "o_orderkey"),
    ])


def reconcile(spark, sf):
    left, right = D.lineitem_versions(spark, sf)
    return quality.reconcile(left, right)


def reconcile_summary(spark, sf):
    left, right = D.lineitem_versions(spark, sf)
    return quality.reconcile_summary(left, right)


def reconcile_keyed_dupes(spark, sf):
    """Order versions by customer: a key with many rows on both sides."""
    left, right = D.orders_versions(spark, sf)
    return quality.reconcile_keyed(left, right, "o_custkey")


def fk_report_mixed_types(spark, sf):
    """Integer and text references against dimension keys of other types."""
    li = D.lineitem_refs(spark, sf)
    d = D.fk_dims(spark, sf)
    fact = li.select(F.col("l_partkey").cast("int").alias("l_partkey"), F.col("l_suppkey").cast("string").alias("l_suppkey"))
    wide = d["part"].select(F.col("p_partkey").cast("double").alias("p_partkey"))
    return quality.fk_report(fact, [quality.ForeignKey("l_partkey", wide, "p_partkey"),
                                    quality.ForeignKey("l_suppkey", d["supplier"], "s_suppkey")])


def null_safe_same_name(spark, sf):
    """The null-safe join of two frames that share the key's name."""
    cust = D.customer_nation_refs(spark, sf).withColumnRenamed("c_nationkey", "id")
    return joins.null_safe_join(cust, D.nation_lookup(spark, sf).withColumnRenamed("nation_key", "id"), "id", "id", "full")


def reconcile_keyed(spark, sf):
    left, right = D.orders_versions(spark, sf)
    return quality.reconcile_keyed(left, right, "o_orderkey")


# --- mapping model -----------------------------------------------------------

def normalize_text(spark, sf):
    return D.conformed_transactions(spark, sf).select("TransactionID", *CODES)


def _code_dim(spark, sf, code, algo):
    src = D.code_sources(spark, sf)[code]
    return dims.add_hash_key(src, [code], f"DIM_{code}ID", algo=algo)


def hashed_dim(spark, sf):
    return _code_dim(spark, sf, "ProductCategory", "murmur3_32")


def _mapping_dim(spark, sf, algo):
    return dims.build_mapping(D.mapping(spark, sf), CODES, "MappingLabel", "DIM_CustomLabelID", algo=algo)


def custom_mapping(spark, sf):
    return _mapping_dim(spark, sf, "murmur3_32")


def resolve_single_key(spark, sf):
    tx = D.conformed_transactions(spark, sf)
    spec = facts.DimSpec(_code_dim(spark, sf, "ProductCategory", "murmur3_32"),
                         ["ProductCategory"], "DIM_ProductCategoryID")
    return facts.resolve_keys(tx, spec).select("TransactionID", "ProductCategory", "DIM_ProductCategoryID")


def fact_resolve_mapping(spark, sf, algo: str = "murmur3_32"):
    tx = D.conformed_transactions(spark, sf)
    specs = [facts.DimSpec(_code_dim(spark, sf, c, algo), [c], f"DIM_{c}ID") for c in CODES]
    specs.append(facts.DimSpec(_mapping_dim(spark, sf, algo), CODES, "DIM_CustomLabelID"))
    return facts.resolve_star(tx, specs, keep=["TransactionID", "Amount"])


def unknown_member_mapping(spark, sf):
    """Transactions of an unlisted category go to the N/A member of an integer-keyed dimension."""
    codes = D.code_sources(spark, sf)["ProductCategory"]
    source = codes.unionByName(dims.default_member(codes, ["ProductCategory"]))
    dim = dims.add_hash_key(source, ["ProductCategory"], "DIM_ProductCategoryID")
    spec = facts.DimSpec(dim, ["ProductCategory"], "DIM_ProductCategoryID")
    return facts.resolve_keys(D.conformed_transactions(spark, sf), spec, unknown_member=dims.DEFAULT_MEMBER).select(
        "TransactionID", "ProductCategory", "DIM_ProductCategoryID")


def mapping_tables(spark, sf):
    """Mapping dimensions and fact saved as tables, read back and joined by key."""
    run = scratch_path(spark, "mapping")
    tag = run.rsplit("-", 1)[-1][:12]
    tables = {f"tessera_label_{tag}": _mapping_dim(spark, sf, "murmur3_32"), f"tessera_fact_{tag}": fact_resolve_mapping(spark, sf)}
    paths = [io.write_table(df, name, path=f"{run}/{name}") and f"{run}/{name}" for name, df in tables.items()]
    label, fact = (spark.table(name) for name in tables)
    out = D.stage(fact.join(label.select("DIM_CustomLabelID", "MappingLabel"), "DIM_CustomLabelID", "left")
                  .select("TransactionID", "Amount", "DIM_CustomLabelID", "MappingLabel"), "mapping-out")
    for name, path in zip(tables, paths):
        io.drop_table(spark, name, path)
    return out


# --- attendance --------------------------------------------------------------

def parse_punches(spark, sf):
    return attendance.parse_punches(D.punch_text(spark, sf))


def punch_sequence(spark, sf):
    p = D.punches(spark, sf).select("event_id", "emp_id", "work_date", "punch_time")
    return attendance.punch_sequence(p, tiebreak=["event_id"])


def attendance_lag(spark, sf):
    return attendance.hours_by_lag(D.punches(spark, sf), D.employees(spark, sf), tiebreak=["event_id"])


def attendance_pairs(spark, sf):
    return attendance.hours_by_pairs(D.punches(spark, sf), D.employees(spark, sf), tiebreak=["event_id"])


# --- sources and sinks -------------------------------------------------------

PART_SCHEMA = ("p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, "
               "p_size INT, p_retailprice DOUBLE")


def csv_roundtrip(spark, sf):
    path = io.write_csv(io.read_table(spark, sf, "part"), scratch_path(spark, "part-csv"))
    return io.read_csv(spark, path, schema=PART_SCHEMA)


def stage_roundtrip(spark, sf):
    path = io.write_stage(io.read_table(spark, sf, "part"), scratch_path(spark, "part-stage"))
    return io.read_stage(spark, path)


def stage_schema_evolution(spark, sf):
    nation = io.read_table(spark, sf, "nation")
    path = scratch_path(spark, "nation-stage")
    io.write_stage(nation.select("n_nationkey", "n_name"), path)
    io.write_stage(nation.withColumn("n_code", F.upper(F.substring("n_name", 1, 3))), path, evolve=True)
    return io.read_stage(spark, path)


def table_roundtrip(spark, sf):
    name = "tessera_nation_" + scratch_path(spark, "t").rsplit("-", 1)[-1][:12]
    path = scratch_path(spark, "nation-table")
    io.write_table(io.read_table(spark, sf, "nation"), name, path=path)
    spark.table(name).count()  # through the catalog
    spark.sql(f"DROP TABLE {name}")  # external: the files stay for the returned frame
    return io.read_stage(spark, path)


def csv_reordered_header(spark, sf):
    """A file whose columns come in another order than the schema's, and one more."""
    part = io.read_table(spark, sf, "part")
    path = io.write_csv(part.select(*reversed(part.columns), F.lit("x").alias("extra")), scratch_path(spark, "part-csv2"))
    return io.read_csv(spark, path, schema=PART_SCHEMA)


def csv_inferred(spark, sf):
    path = io.write_csv(io.read_table(spark, sf, "part"), scratch_path(spark, "part-csv3"))
    return io.read_csv(spark, path, infer=True)


def temp_view_sql(spark, sf):
    """Punches and employees as views, counted with SQL."""
    tag = scratch_path(spark, "v").rsplit("-", 1)[-1][:12]
    p, e = f"punches_{tag}", f"employees_{tag}"
    io.register_views({p: D.punches(spark, sf), e: D.employees(spark, sf)})
    out = spark.sql(f"SELECT e.emp_name, count(*) AS n_punches FROM {p} p JOIN {e} e ON p.emp_id = e.emp_id GROUP BY e.emp_name")
    for name in (p, e):
        spark.catalog.dropTempView(name)
    return out


def schema_check(spark, sf):
    """Differences of the nation table from a schema that is off by a type, a name and a column."""
    nation = io.read_table(spark, sf, "nation")
    expected = StructType([StructField("n_nationkey", StringType()), StructField("n_label", StringType()),
                           *[f for f in nation.schema.fields if f.name == "n_regionkey"]])
    found = quality.expect_schema(nation, expected)
    return nation.select(F.explode(F.array(*[F.lit(x) for x in found])).alias("problem")).groupBy("problem").agg(
        F.count(F.lit(1)).alias("n_rows"))


QUERIES: dict[str, Query] = {
    "total_per_key": total_per_key,
    "max_per_day": max_per_day,
    "avg_per_group": avg_per_group,
    "value_frequency": value_frequency,
    "fill_constant": fill_constant,
    "partition_total": partition_total,
    "running_total": running_total,
    "extract_year": extract_year,
    "inner_join": inner_join,
    "explode_tags": explode_tags,
    "top_n_per_group": top_n_per_group,
    "null_safe_outer_join": null_safe_outer_join,
    "mode_per_group": mode_per_group,
    "map_impute": map_impute,
    "mean_fill": mean_fill,
    "median_per_group": median_per_group,
    "median_excluding_sentinel": median_excluding_sentinel,
    "median_approx": median_approx,
    "sentinel_fill_median": sentinel_fill_median,
    "median_fill": median_fill,
    "dim_product": dim_product,
    "dim_store": dim_store,
    "dim_employee": dim_employee,
    "dim_with_default": dim_with_default,
    "fact_resolve_star": fact_resolve_star,
    "net_revenue": net_revenue,
    "revenue_by_brand": revenue_by_brand,
    "star_fk_report": star_fk_report,
    "star_reconcile": star_reconcile,
    "fk_orphans": fk_orphans,
    "fk_report": fk_report,
    "reconcile": reconcile,
    "reconcile_summary": reconcile_summary,
    "reconcile_keyed": reconcile_keyed,
    "reconcile_keyed_dupes": reconcile_keyed_dupes,
    "fk_report_mixed_types": fk_report_mixed_types,
    "null_safe_same_name": null_safe_same_name,
    "star_ambiguous_keys": star_ambiguous_keys,
    "fk_report_dates": fk_report_dates,
    "median_fill_long": median_fill_long,
    "unknown_member_star": unknown_member_star,
    "unknown_member_mapping": unknown_member_mapping,
    "star_flow_persisted": star_flow_persisted,
    "mapping_tables": mapping_tables,
    "csv_reordered_header": csv_reordered_header,
    "csv_inferred": csv_inferred,
    "temp_view_sql": temp_view_sql,
    "schema_check": schema_check,
    "normalize_text": normalize_text,
    "hashed_dim": hashed_dim,
    "custom_mapping": custom_mapping,
    "resolve_single_key": resolve_single_key,
    "fact_resolve_mapping": fact_resolve_mapping,
    "parse_punches": parse_punches,
    "punch_sequence": punch_sequence,
    "attendance_lag": attendance_lag,
    "attendance_pairs": attendance_pairs,
    "csv_roundtrip": csv_roundtrip,
    "stage_roundtrip": stage_roundtrip,
    "stage_schema_evolution": stage_schema_evolution,
    "table_roundtrip": table_roundtrip,
} | upkeep.QUERIES

