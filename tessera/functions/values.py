"""Value expressions: missing-value tests, exact sums, whole-second spans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

ColumnLike = Column | str


def _c(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_missing(c: ColumnLike, sentinel=None) -> Column:
    """Null, or equal to a sentinel such as ``-1`` that stands for "unknown"."""
    col = _c(c)
    if sentinel is None:
        return col.isNull()
    return col.isNull() | (col == F.lit(sentinel))


def exact_sum(c: ColumnLike, scale: int = 2, precision: int = 28) -> Column:
    """Sum in ``decimal(precision, scale)``, returned as double.

    A double sum depends on the order rows arrive in, so the same query can
    give different last bits on different clusters. Summing in decimal makes
    the result independent of partitioning; the cast back happens once.
    """
    return F.sum(_c(c).cast(DecimalType(precision, scale))).cast("double")


def exact_avg(c: ColumnLike, scale: int = 2, precision: int = 28) -> Column:
    """Average as ``exact_sum / count`` (order-independent)."""
    return exact_sum(c, scale, precision) / F.count(_c(c))


def seconds_between(later: ColumnLike, earlier: ColumnLike) -> Column:
    """Whole seconds from ``earlier`` to ``later`` (each truncated to the second)."""
    return F.unix_timestamp(_c(later)) - F.unix_timestamp(_c(earlier))
