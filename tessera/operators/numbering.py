"""Dense row numbers over a whole table, and surrogate keys that resolve collisions.

``number_rows`` numbers rows 0, 1, 2, ... in a declared order without a
global window: rows are dealt by ranges of the order, written once with their
range and place in it, and each range adds the number of rows in the ranges
before it: a prefix sum over one row a range.

``assign_keys`` gives every member of a dimension an integer key. A member
keeps the key of an earlier build; a new one takes its hash; a member
whose hash is taken, by an earlier key or by a smaller new member, gets a
number beyond the range of the hash. So keys are unique at any number of
members, stay as they are from build to build, and are plain hashes but for
the few that collide.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.keys import DEFAULT_HASH_ALGO, hash_key
from tessera.operators.joins import checked_broadcast, written

# Fixed value: the first number past those of a 32-bit hash.
FIRST_NUMBER = 1 << 31
# Share of different rows from which on a table counts as one of few repeats (measured by a sketch).
SPREAD_OUT = 0.9
# Rows that one run deals by hash, which bounds the shuffle files there are at a time, and rows that one task of it sorts.
ROWS_A_RUN = 250_000_000
ROWS_A_TASK = 1_000_000
# Members are mostly distinct texts, which zstd halves and snappy leaves as they are.
CODEC = "zstd"
# Rows of the table and of the earlier build, by their hash and by their key; what a hash says of a member's key.
NEW, PAST, THERE = 0, 1, 2
HOME, GIVEN, LATE, SEVERAL, CLASH = 0, 1, 2, 3, 4
# Fixed value: bits of ``monotonically_increasing_id`` that count rows inside a partition.
ROW_BITS = 33


def dealt(df: DataFrame, rows: int, *cols: str | Column, ranges: bool = False) -> DataFrame:
    """``df`` dealt by ``cols`` over as many tasks as the session has, or more if ``rows`` are many."""
    tasks = rows // ROWS_A_TASK
    deal = df.repartitionByRange if ranges else df.repartition
    return deal(tasks, *cols) if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else deal(*cols)


def number_rows(df: DataFrame, order: Sequence[str | Column], out: str = "row_index", start: int = 0, rows: int = 0) -> DataFrame:
    """``df`` plus ``out``: ``start``, ``start`` + 1, ... in ``order``.

    Rows that tie in ``order`` are numbered in any order; name enough columns
    to avoid it. Nulls come first unless the column says otherwise. The rows
    are written, so their numbers stay whatever is recomputed later. Rows that
    agree in all of ``order`` stay in one range. ``rows``, where it is known
    that there are many, makes more ranges of them.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    placed = dealt(df, rows, *order, ranges=True).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id())
    placed = written(placed, codec=CODEC, release=True)
    part, place = F.shiftright("__id", ROW_BITS), F.col("__id").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # One row a range: as many as the shuffle has partitions.
    bases = placed.groupBy(part.alias("__part")).agg(F.count("*").alias("n")).select(
        "__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__base"))
    return placed.join(F.broadcast(bases), part == F.col("__part")).select(
        *df.columns, (F.col("__base") + place + F.lit(start)).alias(out))


def _row_counts(df: DataFrame, cols: Sequence[str]) -> tuple[int, int]:
    """Rows of ``df`` and about how many different ``cols`` they have."""
    row = df.agg(F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64(*cols))).first()
    return row[0], row[1]


def keyed_members(df: DataFrame, cols: Sequence[str], algo: str = DEFAULT_HASH_ALGO, key: str = "key",
                  earlier: DataFrame | None = None, spread_out: int | None = None) -> DataFrame:
    """The members (distinct ``cols``) of ``df`` with their ``key``: ``cols``, ``key``, ``__rows`` and ``__moved``.

    ``__rows`` counts a member's rows in ``df``; ``__moved`` says that its key
    is not its hash. ``earlier`` is a former build with ``cols`` and ``key``;
    its members need not be in ``df`` any more, their keys stay taken all the same.

    Members and earlier keys meet once, dealt by hash. An earlier key that is
    not its member's hash is also sent to where it would be one. ``spread_out``
    is the number of rows of ``df`` if few of them repeat: they go straight to
    their hash, where otherwise repeats are counted first. More than
    ``ROWS_A_RUN`` are keyed in several runs, each over the hashes of one
    remainder, and the shuffle files of a run are deleted before the next. A
    key that is its member's hash is not written but taken again.
    """
    names = [f"__m{i}" for i in range(len(cols))]
    own = hash_key(cols, algo).cast("long")
    renamed = [F.col(c).alias(n) for c, n in zip(cols, names)]
    rows = df.select(own.alias("__h"), F.lit(NEW).alias("__kind"), *renamed, F.lit(None).cast("long").alias("__taken"))
    total, first = spread_out or 0, FIRST_NUMBER
    if earlier is not None:
        taken = F.col(key).cast("long")
        n, most = earlier.agg(F.count(F.lit(1)), F.max(F.coalesce(taken, own))).first()
        total, first = total + n, max(first, (most or 0) + 1)
        kinds = F.when(taken != own, F.array(F.lit(PAST), F.lit(THERE))).otherwise(F.array(F.lit(PAST)))
        past = earlier.select(own.alias("__own"), F.explode(kinds).alias("__kind"), *renamed, taken.alias("__taken"))
        rows = rows.unionByName(past.select(F.when(F.col("__kind") == THERE, F.col("__taken")).otherwise(F.col("__own")).alias("__h"), "__kind", *names, "__taken"))
    runs = -(-total // ROWS_A_RUN) if spread_out else 1

    def keyed(rows: DataFrame) -> DataFrame:
        """The members of all rows of some hashes, with what is known of their keys from these alone."""
        if spread_out:
            rows = dealt(rows, total // runs, "__h")
        rows = rows.withColumn("__there", F.col("__kind") == THERE)
        known, most, least = F.max("__kind") != NEW, F.max("__taken"), F.min("__taken")
        sits = F.coalesce(F.max(F.col("__taken") == F.col("__h")), F.lit(False))
        if earlier is None:
            known, most, least, sits = F.lit(False), F.lit(None).cast("long"), F.lit(None).cast("long"), F.lit(False)
        rows = rows.groupBy("__h", "__there", *names).agg(F.count_if(F.col("__kind") == NEW).alias("__rows"), known.alias("__known"),
                                                          most.alias("__most"), least.alias("__least"), sits.alias("__sits"))
        if not spread_out:
            rows = rows.repartition("__h")
        # Earlier members of a hash come before its new ones, these in their order.
        upto = Window.partitionBy("__h").orderBy(F.desc("__known"), "__there", *names).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        rows = rows.withColumns({"__claims": F.count_if("__sits").over(upto), "__place": F.count_if(~F.col("__known")).over(upto)})
        # A hash goes to its smallest new member, unless it is taken.
        state = (F.when(F.col("__claims") > 1, CLASH).when(F.col("__least") != F.col("__most"), SEVERAL).when(F.col("__most") != F.col("__h"), GIVEN)
                 .when(F.col("__known") | (F.col("__place") == 1) & (F.col("__claims") == 0), HOME).otherwise(LATE))
        rows = rows.withColumn("__state", state).where(~F.col("__there") & (F.col("__rows") > 0) | (F.col("__state") == CLASH))
        return rows.select(*[F.col(n).alias(c) for n, c in zip(names, cols)], "__rows", "__state", F.when(F.col("__state") == GIVEN, F.col("__most")).alias("__given"))

    rows = written(*[keyed(rows if runs == 1 else rows.where(F.pmod("__h", F.lit(runs)) == r)) for r in range(runs)], codec=CODEC, release=True)
    if earlier is not None and rows.where(F.col("__state") == CLASH).limit(1).count():
        raise ValueError(f"{key} of the earlier build is not unique")

    def with_key(rows: DataFrame, found: Column) -> DataFrame:
        return rows.select(*cols, found.alias(key), "__rows", (F.col("__state") != HOME).alias("__moved"))

    late = rows.where(F.col("__state") == LATE)
    numbered = number_rows(late.select(*cols, "__rows", "__state"), cols, key, first, late.count() if spread_out else 0)
    out = with_key(rows.where(F.col("__state") <= GIVEN), F.coalesce("__given", own)).unionByName(with_key(numbered, F.col(key)))
    several = rows.where(F.col("__state") == SEVERAL)
    if earlier is not None and several.limit(1).count():
        # A member with several earlier keys has all of them but its hash.
        past = earlier.where(taken != own).select(*renamed, taken.alias("__taken")).distinct()
        out = out.unionByName(with_key(several.join(past, same(cols, names)), F.col("__taken")))
    return out


def same(left: Sequence[str], right: Sequence[str]) -> Column:
    """Null-safe equality of column lists."""
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right)])


def assign_keys(df: DataFrame, cols: Sequence[str], key: str, algo: str = DEFAULT_HASH_ALGO,
                earlier: DataFrame | None = None) -> DataFrame:
    """``df`` plus an integer ``key`` that no two members (values of ``cols``) share.

    Repeated rows are kept and share their member's key. Null parts are values
    like any other. A new member of a hash goes by the order of ``cols``, so
    one build over the same members always gives the same keys; a later build
    gives members of ``earlier`` the keys they have there. The hash must be an
    integer one.

    Where ``df`` has no other columns, its rows are the members, each as often
    as it was counted. Otherwise members that are not at their hash are looked
    up, broadcast when their size is within bounds.
    """
    cols = list(cols)
    if algo == "sha256":
        raise ValueError("a hexadecimal key cannot be numbered on; use an integer hash")
    if list(df.columns) == cols:
        n, different = _row_counts(df, cols)
        members = keyed_members(df, cols, algo, key, earlier, spread_out=n if different >= SPREAD_OUT * n else None)
        return members.select(*cols, key, F.explode(F.sequence(F.lit(1).cast("long"), "__rows")).alias("__i")).drop("__i")
    names = [f"__k{i}" for i in range(len(cols))]
    moved = keyed_members(df.select(*cols), cols, algo, key, earlier).where("__moved").select(
        *[F.col(c).alias(n) for c, n in zip(cols, names)], F.col(key).alias("__moved_to"))
    moved, _ = checked_broadcast(moved, materialize=False)
    joined = df.join(moved, same(cols, names), "left")
    return joined.select(*df.columns, F.coalesce(F.col("__moved_to"), hash_key(cols, algo).cast("long")).alias(key))
