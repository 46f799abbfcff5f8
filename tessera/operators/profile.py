"""Profiling: value frequencies and the most frequent value per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def value_frequency(df: DataFrame, cols: Sequence[str], out: str = "n_rows",
                    non_null: Sequence[str] = ()) -> DataFrame:
    """Row count per combination of ``cols`` (rows with a null in ``non_null`` left out)."""
    src = df
    for c in non_null:
        src = src.where(F.col(c).isNotNull())
    return src.groupBy(*cols).agg(F.count(F.lit(1)).alias(out))


def mode_by_group(df: DataFrame, by: str | Sequence[str], col: str,
                  out: str = "mode") -> DataFrame:
    """The most frequent non-null ``col`` per group; ties go to the smallest value.

    Two aggregates, no window: counts per ``(group, value)``, then
    ``min_by(value, (-count, value))`` per group. Both combine map-side, so a
    group holding a third of all rows is reduced before it is shuffled.
    """
    keys = [by] if isinstance(by, str) else list(by)
    freq = value_frequency(df, [*keys, col], out="__n", non_null=[col])
    rank = F.struct((-F.col("__n")).alias("neg_n"), F.col(col).alias("v"))
    return freq.groupBy(*keys).agg(F.min_by(F.col(col), rank).alias(out))
