"""Everyday DataFrame recipes: group totals, per-row partition totals, running
totals, top-N per group, year extraction, splitting a tag list into rows.

Skew notes
----------
* ``partition_total`` is an aggregate joined back, not a window: the
  aggregate combines map-side and the join broadcasts the per-key totals when
  their count is checked small, so a hot key never lands in one task.
* ``running_total`` splits the rows of a key above ``split_above`` rows by
  ranges of the order key. Totals per ``(key, range)`` are a small aggregate;
  their prefix sums give each range an offset; the window runs per
  ``(key, range)``.
* ``top_n_per_group`` filters on ``row_number() <= n``; Spark plans that as a
  per-partition limit before the shuffle and a final one after, so each map
  task ships at most ``n`` rows per group.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StringType

from tessera.functions.values import exact_avg, exact_sum
from tessera.operators.joins import checked_broadcast
from tessera.operators.sequence import large_groups, ranges_of_split_groups, with_ranges


def _keys(by: str | Sequence[str]) -> list[str]:
    return [by] if isinstance(by, str) else list(by)


def total_per_key(df: DataFrame, by: str | Sequence[str], value: str, out: str = "total",
                  scale: int | None = None) -> DataFrame:
    """Sum of ``value`` per key.

    With ``scale`` the sum is exact in ``decimal(28, scale)`` (for money with
    that many decimals) and independent of row order; without it, a plain sum."""
    agg = exact_sum(value, scale) if scale is not None else F.sum(value)
    return df.groupBy(*_keys(by)).agg(agg.alias(out))


def max_per_key(df: DataFrame, by: str | Sequence[str] | Column, value: str,
                out: str = "max_value") -> DataFrame:
    keys = [by] if isinstance(by, Column) else _keys(by)
    return df.groupBy(*keys).agg(F.max(value).alias(out))


def avg_per_key(df: DataFrame, by: str | Sequence[str], value: str, out: str = "avg_value",
                scale: int | None = None) -> DataFrame:
    """Average per key; order-independent (exact sum / count) when ``scale`` is given."""
    agg = exact_avg(value, scale) if scale is not None else F.avg(value)
    return df.groupBy(*_keys(by)).agg(agg.alias(out))


def partition_total(df: DataFrame, by: str | Sequence[str], value: str, out: str = "total",
                    scale: int | None = None, max_broadcast_rows: int | None = None) -> DataFrame:
    """Every row plus the total of ``value`` over all rows sharing its key."""
    keys = _keys(by)
    totals = total_per_key(df, keys, value, out, scale)
    totals, _ = checked_broadcast(totals, max_broadcast_rows)
    joined = df.join(totals, on=keys, how="left")
    return joined.select(*df.columns, out)


def running_total(df: DataFrame, by: str | Sequence[str], order: Sequence[str], value: str,
                  out: str = "running_total", scale: int | None = None,
                  max_broadcast_rows: int | None = None, split_above: int | None = None) -> DataFrame:
    """Cumulative sum of ``value`` per key in ``order`` (which should be unique per key).

    A key of more than ``split_above`` rows is split by ranges of the order
    key (see ``sequence.with_ranges``), which never changes the result.
    """
    keys, order = _keys(by), list(order)
    v = F.col(value).cast(DecimalType(28, scale)) if scale is not None else F.col(value)
    large = large_groups(df, keys, split_above, max_broadcast_rows)
    if large is None:
        total = F.sum(v).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
        return df.select("*", (total.cast("double") if scale is not None else total).alias(out))
    staged = with_ranges(df, keys, order, large, max_broadcast_rows).withColumn("__v", v)
    per_range = staged.groupBy("__gid").agg(F.sum("__v").alias("__sum"))
    before = Window.partitionBy("__gid.grp").orderBy("__gid.range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges_of_split_groups(per_range).select(F.col("__gid").alias("__oid"), F.sum("__sum").over(before).alias("__offset"))
    offsets, _ = checked_broadcast(offsets, max_broadcast_rows)
    inner = Window.partitionBy("__gid").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    within = staged.withColumn("__run", F.sum("__v").over(inner))
    joined = within.join(offsets, F.col("__gid") == F.col("__oid"), "left")
    # A sum over no value is null, as in one window; a null on one side adds nothing.
    total = F.coalesce(F.col("__offset") + F.col("__run"), F.col("__offset"), F.col("__run"))
    return joined.select(*df.columns, (total.cast("double") if scale is not None else total).alias(out))


def top_n_per_group(df: DataFrame, by: str | Sequence[str], order: Sequence[Column], n: int,
                    rank_col: str | None = None) -> DataFrame:
    """The first ``n`` rows of each group in ``order`` (give a unique tie-break)."""
    w = Window.partitionBy(*_keys(by)).orderBy(*order)
    ranked = df.withColumn("__rank", F.row_number().over(w)).where(F.col("__rank") <= n)
    if rank_col:
        return ranked.withColumnRenamed("__rank", rank_col)
    return ranked.drop("__rank")


def extract_year(df: DataFrame, col: str, out: str = "year") -> DataFrame:
    """Year of a date, timestamp or ``yyyy-MM-dd`` text column.

    Text that is not a date gives null rather than failing the job."""
    c = F.col(col)
    as_date = F.try_to_date(c) if isinstance(df.schema[col].dataType, StringType) else F.to_date(c)
    return df.withColumn(out, F.year(as_date))


def explode_tags(df: DataFrame, col: str, sep: str = ",", out: str | None = None) -> DataFrame:
    """One row per element of a delimited text column (the separator is literal)."""
    pattern = re.sub(r"([\\.^$|?*+()\[\]{}])", r"\\\1", sep)
    return df.withColumn(out or col, F.explode(F.split(F.col(col), pattern)))
