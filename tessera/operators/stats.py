"""Per-group statistics: mean and exact or approximate quantiles.

Exact quantile, split so that no task sees a whole group
--------------------------------------------------------
Spark's ``percentile`` family keeps every distinct value of a group in one
aggregation buffer, and a running count over a group needs the group in one
task. Here the work is split instead:

1. count rows per ``(group, value)``; the partial aggregate collapses repeats
   map-side, so a hot group with few distinct values costs almost nothing;
2. per group, approximate bucket edges over its *distinct* values
   (``percentile_approx``, bounded memory, combined map-side), so each bucket
   holds about ``1/buckets`` of the group's distinct values;
3. row totals per ``(group, bucket)`` -- at most ``buckets`` rows per group --
   and their running sum locate the bucket holding the target rank
   ``ceil(q * n)`` exactly, with the count of rows before it;
4. steps 2 and 3 are repeated inside the target buckets until none of them
   has more than ``split_above`` distinct values;
5. only those values get a running count; the quantile is the smallest value
   whose count reaches the target rank, i.e. SQL ``percentile_disc`` (lower
   median for q = 0.5).

Groups of no more than ``split_above`` distinct values skip steps 2 to 4. The
edges only decide how the work is split; the answer is exact whatever
they are. ``method="approx"`` returns ``percentile_approx``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.values import exact_avg

# Distinct values of one group that may meet in one window.
DEFAULT_SPLIT_ABOVE = 2_000_000


def _by(by: str | Sequence[str]) -> list[str]:
    return [by] if isinstance(by, str) else list(by)


def group_mean(df: DataFrame, by: str | Sequence[str], col: str, out: str = "mean",
               where: Column | str | None = None, scale: int | None = None) -> DataFrame:
    """Mean per group; with ``scale`` the sum is exact, whatever order rows arrive in."""
    src = df if where is None else df.where(where)
    return src.groupBy(*_by(by)).agg((F.avg(col) if scale is None else exact_avg(col, scale)).alias(out))


def _ranked(freq: DataFrame, group: str, value: str, n: str, q: float, out: str) -> DataFrame:
    """The quantile of groups whose values may meet in one window."""
    whole = Window.partitionBy(group)
    upto = whole.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wanted = F.greatest(F.ceil(F.sum(n).over(whole) * F.lit(q)), F.lit(1))
    return freq.select(group, value, (F.sum(n).over(upto) >= wanted).alias("__there")).where("__there").groupBy(group).agg(
        F.min(value).alias(out))


def quantile_of_counts(freq: DataFrame, group: str, value: str, n: str, q: float, out: str, accuracy: int = 10000,
                       buckets: int = 128, split_above: int | None = None) -> DataFrame:
    """``group`` and the ``q`` quantile per group of a table of value counts.

    ``group`` is a struct column (struct equality takes null fields as equal);
    ``freq`` should be written, as it is read several times.
    """
    from tessera.operators.joins import checkpointed

    if split_above is None:
        split_above = int(freq.sparkSession.conf.get("tessera.quantile.splitAbove", None) or DEFAULT_SPLIT_ABOVE)
    rows = freq.count()
    # No group has more values than the whole table, which is counted from its files' footers.
    if rows <= split_above:
        return _ranked(freq, group, value, n, q, out)
    large, _ = checkpointed(freq.groupBy(F.col(group).alias("__lg")).agg(F.count(F.lit(1)).alias("__n")).where(
        F.col("__n") > split_above).select("__lg"))
    small = _ranked(freq.join(large, F.col(group) == F.col("__lg"), "left_anti"), group, value, n, q, out)
    freq = freq.join(large, F.col(group) == F.col("__lg"), "left_semi")
    probs = [i / buckets for i in range(1, buckets)]
    totals = freq.groupBy(F.col(group).alias("__tg")).agg(
        F.greatest(F.ceil(F.sum(n) * F.lit(q)), F.lit(1)).cast("long").alias("__k"))
    left = freq.select(F.col(group).alias("__g"), F.col(value).alias("__v"), F.col(n).alias("__n"))
    left = left.join(totals, F.col("__g") == F.col("__tg")).select("__g", "__v", "__n", "__k", F.lit(0).cast("long").alias("__before"))
    before = None
    while True:
        edges = left.groupBy(F.col("__g").alias("__eg")).agg(F.percentile_approx("__v", probs, accuracy).alias("__edges"))
        placed = left.join(edges, F.col("__g") == F.col("__eg")).withColumn(
            "__b", F.size(F.filter("__edges", lambda e: e < F.col("__v")))).drop("__eg", "__edges")
        per_bucket = placed.groupBy("__g", "__b").agg(F.sum("__n").alias("__bn"), F.count("*").alias("__values"),
                                                      F.first("__k").alias("__k"), F.first("__before").alias("__start"))
        earlier = Window.partitionBy("__g").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
        located = per_bucket.select(
            F.col("__g").alias("__lg"), F.col("__b").alias("__lb"), "__bn", "__k", "__values",
            (F.col("__start") + F.coalesce(F.sum("__bn").over(earlier), F.lit(0).cast("long"))).alias("__from")
        ).where((F.col("__from") < F.col("__k")) & (F.col("__from") + F.col("__bn") >= F.col("__k")))
        left = placed.join(located.select("__lg", "__lb", "__from"),
                           (F.col("__g") == F.col("__lg")) & (F.col("__b") == F.col("__lb"))
                           ).select("__g", "__v", "__n", "__k", F.col("__from").alias("__before"))
        widest = located.agg(F.max("__values")).first()[0] or 0
        # Edges are doubles: values closer together than these can tell are ranked as they are.
        if widest <= max(1, split_above) or widest == before:
            break
        before = widest
        left, _ = checkpointed(left)
    running = Window.partitionBy("__g").orderBy("__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = left.withColumn("__cum", F.col("__before") + F.sum("__n").over(running))
    return small.unionByName(ranked.groupBy(F.col("__g").alias(group)).agg(
        F.min(F.when(F.col("__cum") >= F.col("__k"), F.col("__v"))).alias(out)))


def group_quantile(df: DataFrame, by: str | Sequence[str], col: str, q: float = 0.5,
                   out: str = "quantile", method: str = "exact", accuracy: int = 10000,
                   where: Column | str | None = None, buckets: int = 128,
                   split_above: int | None = None) -> DataFrame:
    """One row per group with the ``q`` quantile of ``col`` (nulls ignored).

    ``where`` is a column or an SQL predicate. ``split_above`` defaults to the
    session setting ``tessera.quantile.splitAbove`` or 2,000,000.
    """
    from tessera.operators.joins import written

    keys = _by(by)
    src = df if where is None else df.where(where)
    if method == "approx":
        return src.groupBy(*keys).agg(F.percentile_approx(col, q, accuracy).alias(out))
    if method != "exact":
        raise ValueError(f"unknown method {method!r}")
    freq = (src.where(F.col(col).isNotNull()).groupBy(F.struct(*keys).alias("__group"), F.col(col).alias("__value"))
            .agg(F.count(F.lit(1)).alias("__count")))
    freq = written(freq)
    got = quantile_of_counts(freq, "__group", "__value", "__count", q, out, accuracy, buckets, split_above)
    return got.select(*[F.col(f"__group.{k}").alias(k) for k in keys], out)


def group_median(df: DataFrame, by: str | Sequence[str], col: str, out: str = "median",
                 method: str = "exact", accuracy: int = 10000,
                 where: Column | str | None = None) -> DataFrame:
    return group_quantile(df, by, col, 0.5, out, method, accuracy, where)
