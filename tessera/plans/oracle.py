"""DuckDB SQL equivalents of the query catalogue.

The derived inputs are CTEs written from the same rules as
``tessera.plans.derived``; each query's SQL pulls in the CTEs it needs (and
theirs). Where the Spark side uses a skew-safe or one-shuffle form, the SQL
keeps the textbook form (window sums, full outer joins, self joins), so the
two check each other.
"""

from __future__ import annotations

import re

from tessera.plans.derived import NAME_MAP, UNLISTED_CODE

_NAME_CASE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in NAME_MAP.items())

# name -> (dependencies, body)
CTES: dict[str, tuple[list[str], str]] = {
    "sales": ([], """
        SELECT p.p_type AS ProductCategory,
               CASE WHEN l.l_partkey % 11 = 0 THEN NULL ELSE p.p_name END AS ProductName,
               p.p_brand AS Brand,
               r.r_name AS StoreRegion, s.s_name AS StoreName, n.n_name AS StoreType,
               c.c_name AS SalesRep, c.c_mktsegment AS Department, o.o_orderpriority AS EmployeeRole,
               CASE WHEN l.l_orderkey % 13 = 0 THEN NULL ELSE CAST(l.l_quantity AS INTEGER) END AS UnitsSold,
               CASE WHEN l.l_orderkey % 17 = 0 THEN CAST(-1 AS DOUBLE)
                    WHEN l.l_orderkey % 19 = 0 THEN NULL ELSE p.p_retailprice END AS UnitPrice,
               CASE WHEN l.l_orderkey % 23 = 0 THEN NULL ELSE l.l_discount END AS Discount,
               CAST(l.l_shipdate AS DATE) AS SaleDate
        FROM lineitem l
        JOIN part p ON l.l_partkey = p.p_partkey
        JOIN supplier s ON l.l_suppkey = s.s_suppkey
        JOIN nation n ON s.s_nationkey = n.n_nationkey
        JOIN region r ON n.n_regionkey = r.r_regionkey
        JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN customer c ON o.o_custkey = c.c_custkey"""),
    "sales_named": (["sales"], f"""
        SELECT * REPLACE (CASE WHEN ProductName IS NULL
                               THEN COALESCE(CASE ProductCategory {_NAME_CASE} END, 'Unknown_Product')
                               ELSE ProductName END AS ProductName)
        FROM sales"""),
    "units_avg": (["sales_named"], """
        SELECT ProductCategory, AVG(UnitsSold) AS stat FROM sales_named GROUP BY ProductCategory"""),
    "units_filled": (["sales_named", "units_avg"], """
        SELECT s.* REPLACE (ROUND(COALESCE(CAST(s.UnitsSold AS DOUBLE), u.stat), 2) AS UnitsSold)
        FROM sales_named s LEFT JOIN units_avg u ON s.ProductCategory = u.ProductCategory"""),
    "price_med": (["units_filled"], """
        SELECT ProductCategory, quantile_disc(UnitPrice, 0.5) AS stat
        FROM units_filled WHERE UnitPrice <> -1 GROUP BY ProductCategory"""),
    "price_filled": (["units_filled", "price_med"], """
        SELECT s.* REPLACE (ROUND(CASE WHEN s.UnitPrice IS NULL OR s.UnitPrice = -1 THEN m.stat
                                       ELSE s.UnitPrice END, 2) AS UnitPrice)
        FROM units_filled s LEFT JOIN price_med m ON s.ProductCategory = m.ProductCategory"""),
    "disc_med": (["price_filled"], """
        SELECT ProductCategory, quantile_disc(Discount, 0.5) AS stat FROM price_filled GROUP BY ProductCategory"""),
    "sales_clean": (["price_filled", "disc_med"], """
        SELECT s.* REPLACE (ROUND(COALESCE(s.Discount, m.stat), 2) AS Discount)
        FROM price_filled s LEFT JOIN disc_med m ON s.ProductCategory = m.ProductCategory"""),
    "dim_product": (["sales_named"], """
        SELECT ProductCategory, ProductName, Brand,
               sha256(concat_ws('||', ProductCategory, ProductName, Brand)) AS DIM_ProductId
        FROM (SELECT ProductCategory, ProductName, Brand FROM sales_named UNION SELECT 'N/A', 'N/A', 'N/A')"""),
    "dim_known": (["sales"], """
        SELECT ProductCategory, ProductName, Brand,
               sha256(concat_ws('||', ProductCategory, ProductName, Brand)) AS DIM_ProductId
        FROM (SELECT ProductCategory, ProductName, Brand FROM sales WHERE ProductName IS NOT NULL
              UNION SELECT 'N/A', 'N/A', 'N/A')"""),
    "dim_store": (["sales_named"], """
        SELECT StoreRegion, StoreName, StoreType,
               sha256(concat_ws('||', StoreRegion, StoreName, StoreType)) AS DIM_StoreId
        FROM (SELECT StoreRegion, StoreName, StoreType FROM sales_named UNION SELECT 'N/A', 'N/A', 'N/A')"""),
    "dim_employee": (["sales_named"], """
        SELECT SalesRep, Department, EmployeeRole,
               sha256(concat_ws('||', SalesRep, Department, EmployeeRole)) AS DIM_EmployeeId
        FROM (SELECT SalesRep, Department, EmployeeRole FROM sales_named UNION SELECT 'N/A', 'N/A', 'N/A')"""),
    "fact_star": (["sales_clean", "dim_product", "dim_store", "dim_employee"], """
        SELECT p.DIM_ProductId, st.DIM_StoreId, e.DIM_EmployeeId,
               f.UnitsSold, f.UnitPrice, f.Discount, f.SaleDate
        FROM sales_clean f
        LEFT JOIN dim_product p ON f.ProductCategory = p.ProductCategory
             AND f.ProductName = p.ProductName AND f.Brand = p.Brand
        LEFT JOIN dim_store st ON f.StoreRegion = st.StoreRegion
             AND f.StoreName = st.StoreName AND f.StoreType = st.StoreType
        LEFT JOIN dim_employee e ON f.SalesRep = e.SalesRep
             AND f.Department = e.Department AND f.EmployeeRole = e.EmployeeRole"""),
    "cust_refs": ([], """
        SELECT c_custkey, c_name, CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN c_nationkey + 100
                                       ELSE c_nationkey END AS c_nationkey
        FROM customer"""),
    "supp_nations": ([], "SELECT s_suppkey, s_nationkey FROM supplier"),
    "li_refs": ([], """
        SELECT CASE WHEN l_orderkey % 31 = 0 THEN -l_partkey ELSE l_partkey END AS l_partkey,
               CASE WHEN l_orderkey % 37 = 0 THEN -l_suppkey ELSE l_suppkey END AS l_suppkey, l_orderkey FROM lineitem"""),
    "nation_lookup": ([], """
        SELECT CASE WHEN n_nationkey = 24 THEN NULL ELSE n_nationkey END AS nation_key, n_name FROM nation"""),
    "li_left": ([], """
        SELECT l_quantity, l_extendedprice, l_discount, l_shipdate FROM lineitem"""),
    "li_right": ([], """
        SELECT CASE WHEN l_orderkey % 1000 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity,
               l_extendedprice, l_discount, l_shipdate FROM lineitem"""),
    "li_counts": (["li_left", "li_right"], """
        SELECT COALESCE(a.l_quantity, b.l_quantity) AS l_quantity,
               COALESCE(a.l_extendedprice, b.l_extendedprice) AS l_extendedprice,
               COALESCE(a.l_discount, b.l_discount) AS l_discount,
               COALESCE(a.l_shipdate, b.l_shipdate) AS l_shipdate,
               COALESCE(a.n, 0) AS n_left, COALESCE(b.n, 0) AS n_right
        FROM (SELECT l_quantity, l_extendedprice, l_discount, l_shipdate, COUNT(*) AS n
              FROM li_left GROUP BY ALL) a
        FULL OUTER JOIN (SELECT l_quantity, l_extendedprice, l_discount, l_shipdate, COUNT(*) AS n
              FROM li_right GROUP BY ALL) b
          ON a.l_quantity IS NOT DISTINCT FROM b.l_quantity
         AND a.l_extendedprice IS NOT DISTINCT FROM b.l_extendedprice
         AND a.l_discount IS NOT DISTINCT FROM b.l_discount
         AND a.l_shipdate IS NOT DISTINCT FROM b.l_shipdate"""),
    "orders_right": ([], """
        SELECT o_orderkey, o_custkey, o_orderstatus,
               CASE WHEN o_orderkey % 100 = 0 THEN NULL
                    WHEN o_orderkey % 101 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
               o_orderdate, o_orderpriority FROM orders"""),
    "tx": ([], f"""
        SELECT o.o_orderkey AS TransactionID,
               concat('  ', lower(CASE WHEN o.o_orderkey % 29 = 0 THEN '{UNLISTED_CODE}' ELSE o.o_orderpriority END), ' ')
                 AS ProductCategory,
               concat(' ', r.r_name) AS StoreRegion,
               lower(c.c_mktsegment) AS CustomerType,
               o.o_totalprice AS Amount
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey"""),
    "tx_norm": (["tx"], """
        SELECT TransactionID, upper(trim(ProductCategory)) AS ProductCategory,
               upper(trim(StoreRegion)) AS StoreRegion, upper(trim(CustomerType)) AS CustomerType, Amount
        FROM tx"""),
    "dim_pc": ([], "hashed_code_dim('ProductCategory', 'SELECT DISTINCT o_orderpriority AS raw FROM orders')"),
    "dim_pc_default": ([], "hashed_code_dim('ProductCategory', "
                           "'SELECT DISTINCT o_orderpriority AS raw FROM orders UNION SELECT ''N/A'' AS raw')"),
    "dim_sr": ([], "hashed_code_dim('StoreRegion', 'SELECT r_name AS raw FROM region')"),
    "dim_ct": ([], "hashed_code_dim('CustomerType', 'SELECT DISTINCT c_mktsegment AS raw FROM customer')"),
    "mapping": ([], """
        SELECT DISTINCT o.o_orderpriority AS ProductCategory, r.r_name AS StoreRegion,
               c.c_mktsegment AS CustomerType
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey"""),
    "mapping_dim": (["mapping"], "hashed_mapping_dim()"),
    "punches": ([], """
        SELECT event_id, user_id AS emp_id, ts AS punch_time, CAST(ts AS DATE) AS work_date,
               CASE WHEN event_id % 2 = 0 THEN 'IN' ELSE 'OUT' END AS punch_type
        FROM events"""),
    "punch_seq": (["punches"], """
        SELECT *, row_number() OVER (PARTITION BY emp_id, work_date ORDER BY punch_time, event_id) AS punch_seq
        FROM punches"""),
}


# Spark's ``hash(string)``: Murmur3 x86 32-bit over the UTF-8 bytes, seed 42,
# whole little-endian 4-byte words first, then each remaining byte (sign
# extended) as its own round, then the final mix with the byte length.
# The Murmur3 constants.
_M3_C1, _M3_C2, _M3_N = 0xCC9E2D51, 0x1B873593, 0xE6546B64
_M3_F1, _M3_F2 = 0x85EBCA6B, 0xC2B2AE35
_M32 = 1 << 32


def _rotl(x: str, r: int) -> str:
    return f"((({x}) << {r}) | (({x}) >> {32 - r})) & {_M32 - 1}"


def _mix(h: str, k: str) -> str:
    k1 = f"((({_rotl(f'({k}) * {_M3_C1} % {_M32}', 15)}) * {_M3_C2}) % {_M32})"
    return f"((({_rotl(f'xor({h}, {k1})', 13)}) * 5 + {_M3_N}) % {_M32})"


def _byte(hexcol: str, i: str) -> str:
    digit = "instr('0123456789ABCDEF', substr({x}, {p}, 1)) - 1"
    hi = digit.format(x=hexcol, p=f"2 * ({i}) + 1")
    lo = digit.format(x=hexcol, p=f"2 * ({i}) + 2")
    return f"CAST((({hi}) * 16 + ({lo})) AS HUGEINT)"


def murmur3_sql(hexcol: str, ncol: str, seed: int = 42) -> str:
    """SQL for Spark's ``hash(s)`` given ``hex(encode(s))`` and ``octet_length(encode(s))``."""
    word = " + ".join(f"{_byte(hexcol, f'4 * i + {j}')} * {1 << (8 * j)}" for j in range(4))
    words = f"list_transform(range(0, {ncol} // 4), lambda i: {word})"
    after_words = f"list_reduce(list_prepend(CAST({seed} AS HUGEINT), {words}), lambda h, k: {_mix('h', 'k')})"
    tail_byte = f"(CASE WHEN {_byte(hexcol, 'i')} < 128 THEN {_byte(hexcol, 'i')} ELSE {_byte(hexcol, 'i')} + {_M32 - 256} END)"
    tail = f"list_transform(range({ncol} - {ncol} % 4, {ncol}), lambda i: {tail_byte})"
    after_tail = f"list_reduce(list_prepend({after_words}, {tail}), lambda h, k: {_mix('h', 'k')})"
    steps = (f"CASE s WHEN 1 THEN xor(h, h >> 16) WHEN 2 THEN h * {_M3_F1} % {_M32} "
             f"WHEN 3 THEN xor(h, h >> 13) WHEN 4 THEN h * {_M3_F2} % {_M32} ELSE xor(h, h >> 16) END")
    final = (f"list_reduce(list_prepend(xor({after_tail}, CAST({ncol} AS HUGEINT)), "
             f"[CAST(1 AS HUGEINT), 2, 3, 4, 5]), lambda h, s: {steps})")
    return (f"CAST(CASE WHEN {final} >= {1 << 31} THEN {final} - {_M32} ELSE {final} END AS BIGINT)")


def _hours(secs_sql: str) -> str:
    """Whole seconds to hours rounded half-up to hundredths, in integer arithmetic."""
    return f"CAST(((CAST({secs_sql} AS BIGINT) + 18) // 36) AS DOUBLE) / 100"


def _epoch_s(col: str) -> str:
    return f"CAST(floor(epoch({col})) AS BIGINT)"


def _closure(names: list[str]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for d in CTES[n][0]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def _cte_body(name: str) -> str:
    body = CTES[name][1]
    if body.startswith("hashed_code_dim("):
        code, src = re.match(r"hashed_code_dim\('(\w+)', '(.*)'\)", body).groups()
        return hashed_code_dim(code, src.replace("''", "'"))
    if body == "hashed_mapping_dim()":
        return hashed_mapping_dim()
    return body


def hashed_code_dim(code: str, src: str) -> str:
    """A conformed code list with its Murmur3 key: ``code, DIM_{code}ID``."""
    return f"""
        SELECT {code}, {murmur3_sql('__x', '__n')} AS DIM_{code}ID
        FROM (SELECT {code}, hex(encode({code})) AS __x, octet_length(encode({code})) AS __n
              FROM (SELECT upper(trim(raw)) AS {code} FROM ({src})))"""


def hashed_mapping_dim() -> str:
    """The mapping bridge keyed by Murmur3 of the SHA-256 of its raw codes."""
    return f"""
        SELECT {murmur3_sql('__x', '__n')} AS DIM_CustomLabelID,
               upper(trim(ProductCategory)) AS ProductCategory, upper(trim(StoreRegion)) AS StoreRegion,
               upper(trim(CustomerType)) AS CustomerType,
               concat_ws('/', ProductCategory, StoreRegion, CustomerType) AS MappingLabel
        FROM (SELECT *, hex(encode(__d)) AS __x, octet_length(encode(__d)) AS __n
              FROM (SELECT *, sha256(concat_ws('||', ProductCategory, StoreRegion, CustomerType)) AS __d
                    FROM mapping))"""


def with_ctes(names: list[str], body: str) -> str:
    parts = [f"{n} AS ({_cte_body(n)}\n)" for n in _closure(names)]
    return ("WITH " + ",\n".join(parts) + "\n" + body) if parts else body


def _exact_sum(col: str) -> str:
    return f"CAST(SUM(CAST({col} AS DECIMAL(28,2))) AS DOUBLE)"


def _keyed_dupes() -> str:
    """Order versions by customer: each column's multisets of values compared on their own."""
    cols = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    both = f"""both_sides AS (
        SELECT o_custkey, {', '.join(cols)}, 1 AS a, 0 AS b FROM orders
        UNION ALL SELECT o_custkey, {', '.join(cols)}, 0, 1 FROM orders_right)"""
    differ = [f"""CASE WHEN o_custkey IN (SELECT o_custkey FROM both_sides GROUP BY o_custkey, {c}
                          HAVING SUM(a) <> SUM(b)) THEN '{c}' END""" for c in cols]
    return with_ctes(["orders_right"], f"""
        , {both},
        wrong AS (SELECT DISTINCT o_custkey FROM both_sides GROUP BY o_custkey, {', '.join(cols)} HAVING SUM(a) <> SUM(b))
        SELECT o_custkey, CAST(SUM(a) AS BIGINT) AS n_left, CAST(SUM(b) AS BIGINT) AS n_right,
               COALESCE(NULLIF(ANY_VALUE(concat_ws(',', {', '.join(differ)})), ''), '*') AS diff_columns
        FROM both_sides WHERE o_custkey IN (SELECT o_custkey FROM wrong) GROUP BY o_custkey""")


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["total_per_key"] = f"SELECT o_custkey, {_exact_sum('o_totalprice')} AS total_amount FROM orders GROUP BY o_custkey"
    q["max_per_day"] = ("SELECT CAST(o_orderdate AS DATE) AS order_day, MAX(o_totalprice) AS max_amount "
                        "FROM orders GROUP BY 1")
    q["avg_per_group"] = (f"SELECT p_name, {_exact_sum('p_retailprice')} / COUNT(p_retailprice) AS avg_price "
                          "FROM part GROUP BY p_name")
    q["fill_constant"] = ("SELECT c_custkey, COALESCE(CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END, "
                          "'Unknown') AS c_mktsegment FROM customer")
    q["partition_total"] = ("SELECT o_orderkey, o_custkey, o_totalprice, "
                            "CAST(SUM(CAST(o_totalprice AS DECIMAL(28,2))) OVER (PARTITION BY o_custkey) AS DOUBLE) "
                            "AS customer_total FROM orders")
    q["running_total"] = ("SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice, "
                          "CAST(SUM(CAST(o_totalprice AS DECIMAL(28,2))) OVER (PARTITION BY o_custkey "
                          "ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) "
                          "AS DOUBLE) AS running_amount FROM orders")
    q["extract_year"] = ("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_date, "
                         "CAST(year(CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE)) AS INTEGER) AS order_year "
                         "FROM orders")
    q["inner_join"] = ("SELECT p.p_partkey, p.p_name, l.l_orderkey, l.l_linenumber, l.l_extendedprice "
                       "FROM part p JOIN lineitem l ON l.l_partkey = p.p_partkey")
    q["explode_tags"] = "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS tag FROM part"
    q["top_n_per_group"] = ("SELECT o_orderkey, o_orderpriority, o_totalprice FROM (SELECT *, row_number() OVER "
                            "(PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rn "
                            "FROM orders) WHERE rn <= 2")
    q["null_safe_outer_join"] = with_ctes(["cust_refs", "nation_lookup"], """
        SELECT c.c_custkey, c.c_name, c.c_nationkey, n.nation_key, n.n_name
        FROM cust_refs c FULL OUTER JOIN nation_lookup n ON c.c_nationkey IS NOT DISTINCT FROM n.nation_key""")

    q["value_frequency"] = with_ctes(["sales"], """
        SELECT ProductCategory, ProductName, COUNT(*) AS n_rows FROM sales
        WHERE ProductName IS NOT NULL GROUP BY 1, 2""")
    q["mode_per_group"] = with_ctes(["sales"], """
        SELECT ProductCategory, ProductName AS MostCommonProductName FROM (
          SELECT ProductCategory, ProductName,
                 row_number() OVER (PARTITION BY ProductCategory ORDER BY COUNT(*) DESC, ProductName) AS rn
          FROM sales WHERE ProductName IS NOT NULL GROUP BY 1, 2) WHERE rn = 1""")
    q["map_impute"] = with_ctes(["sales_named"], "SELECT * FROM sales_named")
    q["mean_fill"] = with_ctes(["units_filled"], "SELECT * FROM units_filled")
    q["median_per_group"] = with_ctes(["sales"], """
        SELECT ProductCategory, quantile_disc(Discount, 0.5) AS median_discount FROM sales GROUP BY 1""")
    q["median_excluding_sentinel"] = with_ctes(["sales"], """
        SELECT ProductCategory, quantile_disc(UnitPrice, 0.5) AS median_price FROM sales
        WHERE UnitPrice <> -1 GROUP BY 1""")
    q["median_approx"] = "SELECT p_type, quantile_disc(p_retailprice, 0.5) AS median_price FROM part GROUP BY p_type"
    q["sentinel_fill_median"] = with_ctes(["price_filled"], "SELECT * FROM price_filled")
    q["median_fill"] = with_ctes(["sales_clean"], "SELECT * FROM sales_clean")

    q["dim_product"] = with_ctes(["dim_product"], "SELECT * FROM dim_product")
    q["dim_store"] = with_ctes(["dim_store"], "SELECT * FROM dim_store")
    q["dim_employee"] = with_ctes(["dim_employee"], "SELECT * FROM dim_employee")
    q["dim_with_default"] = with_ctes(["sales_named"], """
        SELECT StoreRegion, StoreName, StoreType,
               sha256(concat_ws('||', StoreRegion, StoreName, StoreType)) AS DIM_StoreId
        FROM (SELECT StoreRegion, StoreName, StoreType FROM sales_named
              UNION SELECT 'N/A', 'N/A', 'N/A')""")
    q["fact_resolve_star"] = with_ctes(["fact_star"], "SELECT * FROM fact_star")
    q["net_revenue"] = with_ctes(["fact_star"], """
        SELECT *, UnitsSold * UnitPrice * (1 - Discount) AS NetRevenue FROM fact_star""")
    q["revenue_by_brand"] = with_ctes(["fact_star", "dim_product"], """
        SELECT p.Brand,
               CAST(SUM(CAST(f.UnitsSold AS DECIMAL(12,2)) * CAST(f.UnitPrice AS DECIMAL(12,2))
                        * (1 - CAST(f.Discount AS DECIMAL(12,2)))) AS DOUBLE) AS revenue,
               COUNT(*) AS n_sales
        FROM fact_star f JOIN dim_product p ON f.DIM_ProductId = p.DIM_ProductId
        GROUP BY p.Brand""")
    q["fk_orphans"] = with_ctes(["cust_refs", "supp_nations"], """
        SELECT c.c_custkey, c.c_nationkey FROM cust_refs c
        WHERE NOT EXISTS (SELECT 1 FROM supp_nations s WHERE s.s_nationkey = c.c_nationkey)""")
    fk_parts = []
    for fk, dim_sql in (("l_partkey", "SELECT p_partkey AS k FROM part"), ("l_suppkey", "SELECT s_suppkey AS k FROM supplier"),
                        ("l_orderkey", "SELECT o_orderkey AS k FROM orders")):
        fk_parts.append(f"""
        SELECT '{fk}' AS fk_column, COUNT(*) AS n_rows,
               CAST(SUM(CASE WHEN l.{fk} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_null,
               CAST(SUM(CASE WHEN l.{fk} IS NOT NULL AND d.k IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_orphan
        FROM li_refs l LEFT JOIN (SELECT DISTINCT k FROM ({dim_sql})) d ON l.{fk} = d.k""")
    q["fk_report"] = with_ctes(["li_refs"], "\nUNION ALL".join(fk_parts))
    star_parts = []
    for key, dim in (("DIM_ProductId", "dim_product"), ("DIM_StoreId", "dim_store"),
                     ("DIM_EmployeeId", "dim_employee")):
        star_parts.append(f"""
        SELECT '{key}' AS fk_column, COUNT(*) AS n_rows,
               CAST(SUM(CASE WHEN f.{key} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_null,
               CAST(SUM(CASE WHEN f.{key} IS NOT NULL AND d.k IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_orphan
        FROM fact_star f LEFT JOIN (SELECT DISTINCT {key} AS k FROM {dim}) d ON f.{key} = d.k""")
    q["star_fk_report"] = with_ctes(["fact_star"], "\nUNION ALL".join(star_parts))
    measures = "UnitsSold, UnitPrice, Discount, SaleDate"
    q["star_reconcile"] = with_ctes(["fact_star", "sales_clean"], f"""
        SELECT CAST(SUM(n_left) AS BIGINT) AS n_left, CAST(SUM(n_right) AS BIGINT) AS n_right,
               COUNT(*) FILTER (WHERE n_left <> n_right) AS n_distinct_mismatch,
               CAST(SUM(GREATEST(n_left - n_right, 0)) AS BIGINT) AS n_only_left,
               CAST(SUM(GREATEST(n_right - n_left, 0)) AS BIGINT) AS n_only_right
        FROM (SELECT COALESCE(a.n, 0) AS n_left, COALESCE(b.n, 0) AS n_right
              FROM (SELECT {measures}, COUNT(*) AS n FROM sales_clean GROUP BY ALL) a
              FULL OUTER JOIN (SELECT {measures}, COUNT(*) AS n FROM fact_star GROUP BY ALL) b
                ON a.UnitsSold IS NOT DISTINCT FROM b.UnitsSold AND a.UnitPrice IS NOT DISTINCT FROM b.UnitPrice
               AND a.Discount IS NOT DISTINCT FROM b.Discount AND a.SaleDate IS NOT DISTINCT FROM b.SaleDate)""")
    q["reconcile"] = with_ctes(["li_counts"], "SELECT * FROM li_counts WHERE n_left <> n_right")
    q["reconcile_summary"] = with_ctes(["li_counts"], """
        SELECT CAST(SUM(n_left) AS BIGINT) AS n_left, CAST(SUM(n_right) AS BIGINT) AS n_right,
               COUNT(*) FILTER (WHERE n_left <> n_right) AS n_distinct_mismatch,
               CAST(SUM(GREATEST(n_left - n_right, 0)) AS BIGINT) AS n_only_left,
               CAST(SUM(GREATEST(n_right - n_left, 0)) AS BIGINT) AS n_only_right
        FROM li_counts""")
    cols = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    diff = ", ".join(f"CASE WHEN a.{c} IS DISTINCT FROM b.{c} THEN '{c}' END" for c in cols)
    q["reconcile_keyed"] = with_ctes(["orders_right"], f"""
        SELECT * FROM (
          SELECT COALESCE(a.o_orderkey, b.o_orderkey) AS o_orderkey,
                 CAST(a.o_orderkey IS NOT NULL AS BIGINT) AS n_left,
                 CAST(b.o_orderkey IS NOT NULL AS BIGINT) AS n_right,
                 concat_ws(',', {diff}) AS diff_columns
          FROM orders a FULL OUTER JOIN orders_right b ON a.o_orderkey = b.o_orderkey)
        WHERE n_left <> n_right OR diff_columns <> ''""")

    q["reconcile_keyed_dupes"] = _keyed_dupes()
    mixed = []
    for fk, kind, dim_sql in (("l_partkey", "DOUBLE", "SELECT p_partkey AS k FROM part"),
                              ("l_suppkey", "VARCHAR", "SELECT s_suppkey AS k FROM supplier")):
        mixed.append(f"""
        SELECT '{fk}' AS fk_column, COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE l.{fk} IS NULL) AS n_null,
               COUNT(*) FILTER (WHERE l.{fk} IS NOT NULL AND d.k IS NULL) AS n_orphan
        FROM li_refs l LEFT JOIN (SELECT DISTINCT CAST(k AS {kind}) AS k FROM ({dim_sql})) d ON CAST(l.{fk} AS {kind}) = d.k""")
    q["fk_report_mixed_types"] = with_ctes(["li_refs"], "\nUNION ALL".join(mixed))
    q["null_safe_same_name"] = with_ctes(["cust_refs", "nation_lookup"], """
        SELECT c.c_custkey, c.c_name, c.c_nationkey AS id, n.nation_key AS id_right, n.n_name
        FROM cust_refs c FULL OUTER JOIN nation_lookup n ON c.c_nationkey IS NOT DISTINCT FROM n.nation_key""")
    q["star_ambiguous_keys"] = """
        WITH d AS (SELECT DISTINCT p_brand || '||' || p_type AS line, p_name AS label FROM part),
        f AS (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_brand || '||' || p_type ELSE p_brand END AS line,
                     CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE p_type || '||' || p_name END AS label FROM part)
        SELECT CASE WHEN d.line IS NOT NULL THEN sha256(concat_ws('||', d.line, d.label)) END AS DIM_LineId, p_partkey
        FROM f LEFT JOIN d ON f.line = d.line AND f.label = d.label"""
    lost = "CAST(SUM(CASE WHEN dayofweek(CAST(o_orderdate AS DATE)) = 0 THEN 1 ELSE 0 END) AS BIGINT)"
    q["fk_report_dates"] = "\nUNION ALL ".join(
        f"SELECT '{c}' AS fk_column, COUNT(*) AS n_rows, CAST(0 AS BIGINT) AS n_null, {lost} AS n_orphan FROM orders" for c in ("day", "moment"))
    q["median_fill_long"] = """
        WITH o AS (SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey * 2 + 1152921504606846977 END AS serial
                   FROM orders),
        m AS (SELECT o_orderpriority, quantile_disc(serial, 0.5) AS m FROM o GROUP BY 1)
        SELECT o_orderkey, o.o_orderpriority, COALESCE(serial, m) AS serial FROM o JOIN m ON o.o_orderpriority = m.o_orderpriority"""
    q["unknown_member_star"] = with_ctes(["sales_named", "dim_known"], """
        SELECT COALESCE(d.DIM_ProductId, sha256('N/A||N/A||N/A')) AS DIM_ProductId, COUNT(*) AS n_sales
        FROM sales_named s LEFT JOIN dim_known d ON s.ProductCategory = d.ProductCategory
             AND s.ProductName = d.ProductName AND s.Brand = d.Brand
        GROUP BY 1""")
    q["unknown_member_mapping"] = with_ctes(["tx_norm", "dim_pc_default"], """
        SELECT t.TransactionID, t.ProductCategory,
               COALESCE(d.DIM_ProductCategoryID, (SELECT DIM_ProductCategoryID FROM dim_pc_default WHERE ProductCategory = 'N/A'))
                 AS DIM_ProductCategoryID
        FROM tx_norm t LEFT JOIN dim_pc_default d ON t.ProductCategory = d.ProductCategory""")
    q["star_flow_persisted"] = "SELECT *, CAST(0 AS BIGINT) AS n_orphan, CAST(0 AS BIGINT) AS n_null FROM (" + q["star_reconcile"] + ")"
    q["mapping_tables"] = with_ctes(["tx_norm", "mapping_dim"], """
        SELECT t.TransactionID, t.Amount, m.DIM_CustomLabelID, m.MappingLabel
        FROM tx_norm t LEFT JOIN mapping_dim m ON t.ProductCategory = m.ProductCategory
             AND t.StoreRegion = m.StoreRegion AND t.CustomerType = m.CustomerType""")
    q["csv_reordered_header"] = "SELECT * FROM part"
    q["csv_inferred"] = "SELECT * REPLACE (CAST(p_partkey AS INTEGER) AS p_partkey) FROM part"
    q["temp_view_sql"] = with_ctes(["punches"], """
        SELECT c.c_name AS emp_name, COUNT(*) AS n_punches FROM punches p JOIN customer c ON p.emp_id = c.c_custkey GROUP BY 1""")
    q["schema_check"] = """
        SELECT problem, (SELECT COUNT(*) FROM nation) AS n_rows
        FROM (VALUES ('n_nationkey: int != string'), ('missing column n_label'), ('unexpected column n_name')) t(problem)"""

    q["normalize_text"] = with_ctes(["tx_norm"], """
        SELECT TransactionID, ProductCategory, StoreRegion, CustomerType FROM tx_norm""")
    q["hashed_dim"] = with_ctes(["dim_pc"], "SELECT * FROM dim_pc")
    q["custom_mapping"] = with_ctes(["mapping_dim"], "SELECT * FROM mapping_dim")
    q["resolve_single_key"] = with_ctes(["tx_norm", "dim_pc"], """
        SELECT t.TransactionID, t.ProductCategory, d.DIM_ProductCategoryID
        FROM tx_norm t LEFT JOIN dim_pc d ON t.ProductCategory = d.ProductCategory""")
    q["fact_resolve_mapping"] = with_ctes(["tx_norm", "dim_pc", "dim_sr", "dim_ct", "mapping_dim"], """
        SELECT pc.DIM_ProductCategoryID, sr.DIM_StoreRegionID, ct.DIM_CustomerTypeID, m.DIM_CustomLabelID,
               t.TransactionID, t.Amount
        FROM tx_norm t
        LEFT JOIN dim_pc pc ON t.ProductCategory = pc.ProductCategory
        LEFT JOIN dim_sr sr ON t.StoreRegion = sr.StoreRegion
        LEFT JOIN dim_ct ct ON t.CustomerType = ct.CustomerType
        LEFT JOIN mapping_dim m ON t.ProductCategory = m.ProductCategory
             AND t.StoreRegion = m.StoreRegion AND t.CustomerType = m.CustomerType""")

    q["parse_punches"] = with_ctes(["punches"], """
        SELECT event_id, emp_id,
               strptime(strftime(punch_time, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS punch_time,
               punch_type,
               CAST(strptime(strftime(punch_time, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS DATE)
                 AS work_date
        FROM punches""")
    q["punch_sequence"] = with_ctes(["punch_seq"], """
        SELECT event_id, emp_id, work_date, punch_time, CAST(punch_seq AS INTEGER) AS punch_seq FROM punch_seq""")
    lag_secs = (f"SUM(CASE WHEN punch_type = 'OUT' AND prev IS NOT NULL "
                f"THEN {_epoch_s('punch_time')} - {_epoch_s('prev')} ELSE 0 END)")
    q["attendance_lag"] = with_ctes(["punches"], f"""
        SELECT l.emp_id, c.c_name AS emp_name, l.work_date,
               MIN(CASE WHEN punch_type = 'IN' THEN punch_time END) AS first_in,
               MAX(CASE WHEN punch_type = 'OUT' THEN punch_time END) AS last_out,
               {_hours(lag_secs)} AS hours_at_work
        FROM (SELECT *, lag(punch_time) OVER (PARTITION BY emp_id, work_date ORDER BY punch_time, event_id)
                        AS prev FROM punches) l
        JOIN customer c ON c.c_custkey = l.emp_id
        GROUP BY l.emp_id, c.c_name, l.work_date""")
    pair_secs = f"SUM({_epoch_s('punch_out')} - {_epoch_s('punch_in')})"
    q["attendance_pairs"] = with_ctes(["punch_seq"], f"""
        SELECT p.emp_id, c.c_name AS emp_name, p.work_date,
               MIN(punch_in) AS first_in, MAX(punch_out) AS last_out,
               {_hours(pair_secs)} AS hours_at_work
        FROM (SELECT p1.emp_id, p1.work_date, p1.punch_time AS punch_in, p2.punch_time AS punch_out
              FROM punch_seq p1 JOIN punch_seq p2
                ON p1.emp_id = p2.emp_id AND p1.work_date = p2.work_date
               AND p2.punch_seq = p1.punch_seq + 1
              WHERE p1.punch_seq % 2 = 1) p
        JOIN customer c ON c.c_custkey = p.emp_id
        GROUP BY p.emp_id, c.c_name, p.work_date""")

    q["csv_roundtrip"] = "SELECT * FROM part"
    q["stage_roundtrip"] = "SELECT * FROM part"
    q["stage_schema_evolution"] = "SELECT *, upper(substring(n_name, 1, 3)) AS n_code FROM nation"
    q["table_roundtrip"] = "SELECT * FROM nation"
    return q


# Queries without an SQL equivalent (none at present; Spark's Murmur3 ``hash``
# is reproduced by ``murmur3_sql``).
ROWS_ONLY: tuple[str, ...] = ()
