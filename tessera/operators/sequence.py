"""Ordered sequences within a group, split so a hot group spans many tasks.

``number_and_neighbours`` gives each row its position in its group (1, 2, ...)
and the previous / next value of a column in the group's order -- the
``row_number``, ``lag`` and ``lead`` of one window -- without requiring a
whole group in one task.

Rows of a group of more than ``split_above`` rows are cut into ranges of the
full order key, tie-break included, so a group whose rows all share one hour,
one date or no valid time at all splits like any other. The edges of the
ranges come from a hash sample of the group's own order keys. They only
decide how the work is split: windows run per ``(group, range)``, and one row
per range (row count, first and last value) gives the offset of each range
and its neighbours across range boundaries. The result equals the single
window exactly. Groups within the bound have one range and need no offset;
with no group beyond it, there is one plain window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.joins import checked_broadcast, checkpointed, measured_broadcast

# Rows per group above which a group's window is split into ranges.
DEFAULT_SPLIT_ABOVE = 1_000_000
# Edges sampled per split group (about); a range holds about 1/64 of the group.
EDGES = 64


def _bound(df: DataFrame, split_above: int | None) -> int:
    if split_above is not None:
        return split_above
    return int(df.sparkSession.conf.get("tessera.window.splitAbove", None) or DEFAULT_SPLIT_ABOVE)


def large_groups(df: DataFrame, keys: Sequence[str], split_above: int | None = None,
                 max_broadcast_rows: int | None = None) -> DataFrame | None:
    """``__g`` (struct of the keys) and ``__n`` of the groups of more than ``split_above`` rows, or None without any.

    A table of no more rows than that has none; its rows are counted first,
    which a file scan answers from the files' footers.
    """
    bound = _bound(df, split_above)
    if df.count() <= bound:
        return None
    grp = F.struct(*[F.col(k) for k in keys])
    counted = df.groupBy(grp.alias("__g")).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > bound)
    large, _, n = measured_broadcast(counted, max_broadcast_rows)
    return large if n else None


def with_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[str], large: DataFrame,
                max_broadcast_rows: int | None = None) -> DataFrame:
    """``df`` plus ``__grp`` (struct of the keys) and ``__gid`` (struct of group and range).

    ``large`` names the groups to cut (see ``large_groups``). The range number
    grows along ``order`` within a group. Struct equality
    takes null fields as equal, so rows with null keys stay together.
    """
    grp, position = F.struct(*[F.col(k) for k in keys]), F.struct(*[F.col(c) for c in order])
    # About EDGES rows of each large group, chosen by a hash of the order key.
    picked = (df.select(grp.alias("__grp"), position.alias("__at")).join(large, F.col("__grp") == F.col("__g"))
              .where(F.pmod(F.xxhash64("__at"), F.greatest(F.lit(1), F.expr(f"__n div {EDGES}"))) == 0))
    edges = picked.groupBy("__g").agg(F.array_sort(F.collect_set("__at")).alias("__edges"))
    # The hash is uneven on few distinct keys; keep the list short whatever it gives.
    every = F.greatest(F.lit(1), F.expr(f"size(__edges) div {EDGES}"))
    edges = edges.select("__g", F.filter("__edges", lambda e, i: i % every == 0).alias("__edges"))
    edges, _ = checked_broadcast(edges, max_broadcast_rows)
    number = F.size(F.filter(F.col("__edges"), lambda e: e <= position))
    placed = df.withColumn("__grp", grp).join(edges, F.col("__grp") == F.col("__g"), "left")
    number = F.when(F.col("__edges").isNull(), F.lit(0)).otherwise(number)
    return placed.withColumn("__gid", F.struct(F.col("__grp").alias("grp"), number.alias("range"))).drop("__g", "__edges")


def ranges_of_split_groups(per_range: DataFrame) -> DataFrame:
    """The rows of ``per_range`` (keyed by ``__gid``) whose group has several ranges, written once."""
    counted, _ = checkpointed(per_range.where("__gid.range > 0"))
    groups = counted.select(F.col("__gid.grp").alias("__many")).distinct()
    first = per_range.where("__gid.range = 0").join(groups, F.col("__gid.grp") == F.col("__many"), "left_semi")
    return counted.unionByName(first)


def number_and_neighbours(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                          seq: str = "__seq", prev: str = "__prev", nxt: str = "__next",
                          max_broadcast_rows: int | None = None,
                          split_above: int | None = None) -> DataFrame:
    """``df`` plus ``seq`` (row number), ``prev`` and ``nxt`` (lag / lead of ``value``).

    ``order`` must be unique within a group (add a tie-break column).
    """
    keys, order = list(keys), list(order)
    large = large_groups(df, keys, split_above, max_broadcast_rows)
    if large is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.select("*", F.row_number().over(w).alias(seq), F.lag(value).over(w).alias(prev), F.lead(value).over(w).alias(nxt))
    staged = with_ranges(df, keys, order, large, max_broadcast_rows)
    position = F.struct(*[F.col(c) for c in order])
    per_range = staged.groupBy("__gid").agg(
        F.count(F.lit(1)).alias("__cnt"),
        F.min_by(F.struct(F.col(value).alias("v")), position).alias("__first"),
        F.max_by(F.struct(F.col(value).alias("v")), position).alias("__last"))
    across = Window.partitionBy("__gid.grp").orderBy("__gid.range")
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges_of_split_groups(per_range).select(
        F.col("__gid").alias("__oid"), "__cnt",
        F.coalesce(F.sum("__cnt").over(earlier), F.lit(0).cast("long")).alias("__offset"),
        F.lag("__last").over(across).alias("__prev_last"),
        F.lead("__first").over(across).alias("__next_first"))
    offsets, _ = checked_broadcast(offsets, max_broadcast_rows)
    inner = Window.partitionBy("__gid").orderBy(*order)
    numbered = staged.select("*", F.row_number().over(inner).alias("__rn"), F.lag(value).over(inner).alias("__lag"),
                             F.lead(value).over(inner).alias("__lead"))
    joined = numbered.join(offsets, F.col("__gid") == F.col("__oid"), "left")
    last = F.col("__rn") == F.col("__cnt")
    return joined.select(
        *df.columns,
        (F.coalesce(F.col("__offset"), F.lit(0).cast("long")) + F.col("__rn")).cast("int").alias(seq),
        F.when(F.col("__rn") == 1, F.col("__prev_last.v")).otherwise(F.col("__lag")).alias(prev),
        F.when(last, F.col("__next_first.v")).otherwise(F.col("__lead")).alias(nxt))
