"""The first n rows of each group, for any n, without sorting a large group in one task.

``recipes.top_n_per_group`` ranks rows in a window: right for a small n, as
each map task hands on n rows a group at most. Here the row that ends a large group's
first n is searched for instead, for all large groups at once: edges from a
hash sample of a group's order keys cut it into bins, one aggregate counts
the bins, and the bin that holds the n-th row is cut again, until it has no
more than ``split_above`` rows. Only that bin is ranked; rows before it
are in, rows after it out. A round reads the group and order columns only, and
its result is a row a large group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.joins import checked_broadcast, checkpointed

# Rows of one group that may be ranked in one task.
DEFAULT_SPLIT_ABOVE = 1_000_000
EDGES = 128

Order = Sequence[str | tuple[str, str]]


def _parts(order: Order) -> list[tuple[str, bool]]:
    out = []
    for item in order:
        name, way = (item, "asc") if isinstance(item, str) else item
        if way not in ("asc", "desc"):
            raise ValueError(f"unknown direction {way!r}")
        out.append((name, way == "desc"))
    return out


class _Key:
    """Order keys as structs, compared as ``orderBy`` does: nulls first ascending, last descending."""

    def __init__(self, order: Order):
        self.parts = _parts(order)

    def of_row(self) -> Column:
        return F.struct(*[F.col(name).alias(f"o{i}") for i, (name, _) in enumerate(self.parts)])

    def before(self, a: Column, b: Column) -> Column:
        """Whether key ``a`` comes strictly before ``b``."""
        steps, equal = [], F.lit(True)
        for i, (_, down) in enumerate(self.parts):
            x, y = a[f"o{i}"], b[f"o{i}"]
            less = (x > y) if down else (x < y)
            nulls = (x.isNotNull() & y.isNull()) if down else (x.isNull() & y.isNotNull())
            steps.append(equal & (nulls | F.coalesce(less, F.lit(False))))
            equal = equal & x.eqNullSafe(y)
        return reduce(lambda p, q: p | q, steps)

    def sorted(self, keys: Column) -> Column:
        return F.array_sort(keys, lambda a, b: F.when(self.before(a, b), -1).when(self.before(b, a), 1).otherwise(0))

    def columns(self) -> list[Column]:
        return [F.desc(name) if down else F.asc(name) for name, down in self.parts]


def _inside(key: _Key, row: Column) -> Column:
    """Whether the row lies after ``__lo`` and not after ``__hi`` (null: no limit)."""
    lo, hi = F.col("__lo"), F.col("__hi")
    return (lo.isNull() | key.before(lo, row)) & (hi.isNull() | ~key.before(hi, row))


def _narrowed(rows: DataFrame, state: DataFrame, key: _Key, edges: int) -> DataFrame:
    """One round: ``state`` with the interval of each group's n-th row cut to one bin."""
    side, _ = checked_broadcast(state, materialize=False)
    inside = rows.join(side, F.col("__r") == F.col("__g")).where(_inside(key, F.col("__at")))
    picked = inside.where(F.pmod(F.xxhash64("__at"), F.greatest(F.lit(1), F.expr(f"__n div {edges}"))) == 0)
    cuts = picked.groupBy("__g").agg(F.collect_set("__at").alias("__cuts"))
    # The hash is uneven on few distinct keys; keep the list short whatever it gives.
    every = F.greatest(F.lit(1), F.expr(f"size(__cuts) div {edges}"))
    cuts = cuts.select("__g", F.filter(key.sorted(F.col("__cuts")), lambda e, i: i % every == 0).alias("__cuts"))
    state, _ = checkpointed(state.join(cuts.withColumnRenamed("__g", "__cg"), F.col("__g") == F.col("__cg"), "left").drop("__cg"))
    side, _ = checked_broadcast(state, materialize=False)
    inside = rows.join(side, F.col("__r") == F.col("__g")).where(_inside(key, F.col("__at")))
    bins = inside.select("__g", F.size(F.filter(F.coalesce("__cuts", F.array()), lambda e: key.before(e, F.col("__at")))).alias("__b"))
    counted = bins.groupBy("__g", "__b").agg(F.count(F.lit(1)).alias("__c"))
    earlier = Window.partitionBy("__g").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.withColumn("__s", F.coalesce(F.sum("__c").over(earlier), F.lit(0).cast("long"))).withColumnRenamed("__g", "__cg")
    found = state.join(counted, (F.col("__g") == F.col("__cg")) & (F.col("__s") < F.col("__k")) & (F.col("__s") + F.col("__c") >= F.col("__k")))
    return found.select(
        "__g", (F.col("__k") - F.col("__s")).alias("__k"), F.col("__c").alias("__n"),
        F.coalesce(F.expr("get(__cuts, __b - 1)"), F.col("__lo")).alias("__lo"),
        F.coalesce(F.expr("get(__cuts, __b)"), F.col("__hi")).alias("__hi"))


def first_n(df: DataFrame, by: str | Sequence[str], order: Order, n: int, split_above: int | None = None,
            edges: int = EDGES) -> DataFrame:
    """The first ``n`` rows of each group of ``by`` in ``order``: column names, or pairs of name and ``"asc"`` / ``"desc"``.

    Rows that tie in ``order`` at the end are taken in any order; name enough
    columns to avoid it. Rows with null group columns are a group. Groups of
    more than ``split_above`` rows (``tessera.window.splitAbove``, or
    1,000,000) are searched; if one key alone has more, its rows are ranked
    in one task. A group of at most n rows is kept whole, unsorted.
    """
    keys = [by] if isinstance(by, str) else list(by)
    if split_above is None:
        split_above = int(df.sparkSession.conf.get("tessera.window.splitAbove", None) or DEFAULT_SPLIT_ABOVE)
    key, group = _Key(order), F.struct(*keys)
    rows = df.select(group.alias("__r"), key.of_row().alias("__at"))
    kind = rows.schema["__at"].dataType
    big, _ = checkpointed(rows.groupBy(F.col("__r").alias("__g")).agg(F.count(F.lit(1)).alias("__n"))
                          .where((F.col("__n") > split_above) & (F.col("__n") > 0)))
    state = big.where(F.col("__n") > n).select("__g", F.lit(n).cast("long").alias("__k"), "__n", F.lit(None).cast(kind).alias("__lo"),
                                               F.lit(None).cast(kind).alias("__hi"))
    left, going = state, state.agg(F.max("__n")).first()[0]
    while going is not None and going > split_above:
        left, _ = checkpointed(_narrowed(rows, left, key, edges))
        now = left.agg(F.max("__n")).first()[0]
        if now == going:
            break
        going = now
    # ``__k`` rows of the last bin are wanted; all rows of a group that is small enough as a whole.
    known = left.select("__g", "__k", "__lo", "__hi").unionByName(
        big.where(F.col("__n") <= n).select("__g", F.lit(None).cast("long").alias("__k"), F.lit(None).cast(kind).alias("__lo"),
                                            F.lit(None).cast(kind).alias("__hi")))
    known, _ = checked_broadcast(known)
    placed = df.withColumn("__r", group).join(known, F.col("__r") == F.col("__g"), "left")
    at, lo, hi = key.of_row(), F.col("__lo"), F.col("__hi")
    sure = F.col("__g").isNotNull() & (F.col("__k").isNull() | (lo.isNotNull() & ~key.before(lo, at)))
    out = F.col("__g").isNotNull() & hi.isNotNull() & key.before(hi, at)
    rank = F.row_number().over(Window.partitionBy("__r").orderBy(*key.columns()))
    ranked = placed.where(~sure & ~out).withColumn("__rank", rank).where(F.col("__rank") <= F.coalesce("__k", F.lit(n)))
    return placed.where(sure).select(*df.columns).unionByName(ranked.select(*df.columns))
