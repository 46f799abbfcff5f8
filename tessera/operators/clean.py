"""Cleaning and imputation.

* ``fill_constant``    nulls in a subset of columns become a constant
* ``impute_by_map``    nulls become a value looked up by another column, with a default
* ``impute_columns``   nulls (and optional sentinels) of several columns become
  per-group means or medians, rounded
* ``impute_by_group``  the same for one column

Group imputation never shuffles the rows: all statistics of a call come from
one aggregate over one scan (combined map-side), end up as one row per group,
and are joined back once, broadcast when their size is within bounds.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.values import is_missing
from tessera.operators.joins import checked_broadcast, written
from tessera.operators.stats import quantile_of_counts

# Fixed value: the fallback name used when a category has no mapped name.
UNKNOWN_PRODUCT = "Unknown_Product"


def fill_constant(df: DataFrame, value, subset: Sequence[str]) -> DataFrame:
    return df.fillna(value, subset=list(subset))


def impute_by_map(df: DataFrame, col: str, by: str, mapping: Mapping[str, str] | DataFrame,
                  default: str | None = UNKNOWN_PRODUCT) -> DataFrame:
    """Fill nulls in ``col`` with the value mapped to ``by``, else ``default``.

    ``mapping`` is a dictionary, or a table whose first two columns are the
    key (unique, checked) and the value. It is joined, broadcast when its size
    is within bounds, so it may be of any size.
    """
    if isinstance(mapping, DataFrame):
        lookup = mapping.toDF(*mapping.columns).select(F.col(mapping.columns[0]).alias("__k"), F.col(mapping.columns[1]).alias("__m"))
        lookup, _ = checked_broadcast(lookup.where("__k is not null"))
        if lookup.groupBy("__k").count().where("count > 1").limit(1).count():
            raise ValueError("a key of the mapping has several values")
    else:
        lookup = df.sparkSession.createDataFrame(list(mapping.items()), "__k string, __m string")
        lookup, _ = checked_broadcast(lookup, materialize=False)
    choices = [F.col(col), F.col("__m")] + ([] if default is None else [F.lit(default)])
    joined = df.join(lookup, F.col(by) == F.col("__k"), "left")
    return joined.select(*[F.coalesce(*choices).alias(c) if c == col else F.col(c) for c in df.columns])


@dataclass(frozen=True)
class Fill:
    """How one column is filled: ``stat`` is ``"mean"`` or ``"median"``.

    Rows equal to ``sentinel`` are left out of the statistic (null rows
    always are) and replaced like nulls; results are rounded to ``scale``.
    """
    col: str
    stat: str = "mean"
    sentinel: object = None
    scale: int | None = 2
    method: str = "exact"
    accuracy: int = 10000


def _quantiles(counted: DataFrame, exact: Sequence[int], types: Sequence[str]) -> list[DataFrame]:
    """Exact medians from value counts: one search for all columns of a type, in that type."""
    out = []
    for kind in dict.fromkeys(types[i] for i in exact):
        some = [i for i in exact if types[i] == kind]
        value = reduce(lambda acc, i: F.when(F.col("i") == i, F.col(f"x{i}")).otherwise(acc), some[1:], F.col(f"x{some[0]}"))
        freq = counted.where(F.col("i").isin(some)).select(F.struct("__group", "i").alias("g"), value.alias("x"), "n")
        found = quantile_of_counts(freq, "g", "x", "n", 0.5, "stat")
        out.append(found.select("g.__group", *[F.when(F.col("g.i") == i, F.col("stat")).alias(f"__stat{i}") for i in some]))
    return out


def group_statistics(df: DataFrame, by: Sequence[str], fills: Sequence[Fill]) -> DataFrame:
    """One row per group: ``__group`` (struct of ``by``) and ``__stat0``, ``__stat1``, ... in the order of ``fills``.

    One scan. Means and approximate medians are sums and sketches per group,
    combined map-side; a row gives one entry more for each exact median, and
    these collapse to one per value. Means are doubles, medians have their
    column's type.
    """
    for f in fills:
        if f.stat not in ("mean", "median") or f.method not in ("exact", "approx"):
            raise ValueError(f"unknown statistic {f.stat!r} or method {f.method!r}")
    group = F.struct(*by).alias("__group")
    value = [F.when(~is_missing(f.col, f.sentinel), F.col(f.col)) for f in fills]
    exact = [i for i, f in enumerate(fills) if f.stat == "median" and f.method == "exact"]
    others = [i for i in range(len(fills)) if i not in exact]

    def summary(i: int, x) -> list:
        if fills[i].stat == "median":
            return [F.percentile_approx(x, 0.5, fills[i].accuracy).alias(f"__stat{i}")]
        return [F.avg(x.cast("double")).alias(f"__stat{i}")]

    if not exact:
        return df.groupBy(group).agg(*[c for i in others for c in summary(i, value[i])])
    types = [df.select(v.alias("v")).schema["v"].dataType.simpleString() for v in value]
    # Entry -1 holds the columns that are summed, entry i the value of exact median i.
    fields = [(i, v if i in exact else v.cast("double") if fills[i].stat == "mean" else v) for i, v in enumerate(value)]
    entry = lambda at: F.struct(F.lit(at).alias("i"), *[
        (v if at == i or (at < 0 and i in others) else F.lit(None).cast("double" if fills[i].stat == "mean" else types[i])).alias(f"x{i}") for i, v in fields])
    entries = F.array(*[entry(i) for i in ([-1] if others else []) + exact])
    rows = df.select(group, F.explode(entries).alias("e")).where(reduce(lambda a, b: a | b, [F.col(f"e.x{i}").isNotNull() for i, _ in fields]))
    counted = written(rows.groupBy("__group", F.col("e.i").alias("i"), *[F.col(f"e.x{i}").alias(f"x{i}") for i in exact]).agg(
        F.count(F.lit(1)).alias("n"), *[c for i in others for c in summary(i, F.col(f"e.x{i}"))]))
    parts = _quantiles(counted, exact, types)
    if others:
        parts.append(counted.where("i < 0").select("__group", *[f"__stat{i}" for i in others]))
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return whole.groupBy("__group").agg(*[F.max(f"__stat{i}").alias(f"__stat{i}") for i in range(len(fills))])


def impute_columns(df: DataFrame, by: str | Sequence[str], fills: Sequence[Fill],
                   max_broadcast_rows: int | None = None) -> DataFrame:
    """Replace missing values of several columns by statistics of their group.

    All statistics are those of ``df`` as it comes. Every value of a filled
    column is rounded. A row whose group is null, or whose group has no value,
    stays null. Column order is kept.
    """
    keys = [by] if isinstance(by, str) else list(by)
    stats, _ = checked_broadcast(group_statistics(df, keys, fills), max_broadcast_rows)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    joined = df.join(stats, F.when(known, F.struct(*keys)) == F.col("__group"), "left")
    filled = {}
    for i, f in enumerate(fills):
        value = F.when(is_missing(f.col, f.sentinel), F.col(f"__stat{i}")).otherwise(F.col(f.col))
        filled[f.col] = (value if f.scale is None else F.round(value, f.scale)).alias(f.col)
    return joined.select(*[filled.get(c, F.col(c)) for c in df.columns])


def impute_by_group(df: DataFrame, by: str | Sequence[str], col: str, stat: str = "mean",
                    sentinel=None, scale: int | None = 2, method: str = "exact",
                    accuracy: int = 10000, max_broadcast_rows: int | None = None) -> DataFrame:
    """``impute_columns`` for one column."""
    return impute_columns(df, by, [Fill(col, stat, sentinel, scale, method, accuracy)], max_broadcast_rows)
