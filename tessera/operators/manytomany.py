"""Joins in which a key may repeat on both sides.

The number of rows a key gives is the product of its counts, known before the
join from one aggregate a side. ``join_size`` reports it; ``many_to_many_join``
refuses a join above a given size, and deals heavy keys: the larger side of a
heavy key is cut into as many pieces as its output asks for, the smaller one
is repeated for each piece. So no task makes more than about ``task_rows``
rows of one key, as far as there are tasks: pieces that would share a task
anyway are not cut, so copies grow with the input, not with the output. Only
rows of heavy keys are repeated.

Where some key is heavy and the right side is small, nothing is repeated or
dealt by key: the left rows are dealt evenly, and each meets its key's right
rows as lists that every task has, one pair after the other. A pair then costs a
step in a list instead of a row of a sort-merge join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.joins import checked_broadcast, max_broadcast_bytes, max_broadcast_rows as most_rows, size_up_to, written

# Output rows of one key that may be made in one task, and the most pieces a side of a key is cut into.
DEFAULT_TASK_ROWS = 5_000_000
MOST_PIECES = 10_000
# Pieces of a key that one task may get, so that tasks are about as large as one another.
PIECES_A_TASK = 4
# Pairs made by one task, and right rows in one list, where the right side is sent to every task.
PAIRS_A_TASK = 250_000_000
LIST_ROWS = 4_096


def key_counts(left: DataFrame, right: DataFrame, on: Sequence[str], null_safe: bool = False) -> DataFrame:
    """``__k`` (struct of the keys), ``n_left`` and ``n_right`` of the keys both sides hold.

    Combined map-side, so a hot key is a row a task. Keys with a null part
    count only with ``null_safe``.
    """
    def counted(df: DataFrame, name: str) -> DataFrame:
        df = df if null_safe else df.dropna(subset=list(on))
        return df.groupBy(F.struct(*on).alias("__k")).agg(F.count(F.lit(1)).alias(name))

    return counted(left, "n_left").join(counted(right, "n_right"), "__k")


def join_size(left: DataFrame, right: DataFrame, on: str | Sequence[str], null_safe: bool = False) -> DataFrame:
    """One row: keys both sides hold, rows an inner join gives, and those of its largest key."""
    on = [on] if isinstance(on, str) else list(on)
    size = F.col("n_left").cast("decimal(38,0)") * F.col("n_right")
    return key_counts(left, right, on, null_safe).agg(
        F.count("*").alias("n_keys"), F.coalesce(F.sum(size), F.lit(0)).cast("decimal(38,0)").alias("n_rows"),
        F.coalesce(F.max(size), F.lit(0)).cast("decimal(38,0)").alias("n_rows_of_largest"))


def _sent_rows(right: DataFrame, bound: int | None) -> int | None:
    """Rows of ``right`` if it may be sent to every task, in lists by key.

    Its bytes are bounded as those of any broadcast side, and a list's
    overhead is counted to each row; rows are bounded only by ``bound`` or the
    session's setting.
    """
    given = bound is not None or right.sparkSession.conf.get("tessera.broadcast.maxRows", None)
    most = max_broadcast_bytes(right)
    n, size = size_up_to(right, most_rows(right, bound) if given else most // 64)
    fits = size <= most and (not given or n <= most_rows(right, bound))
    return n if fits else None


def _listed(right: DataFrame, names: dict[str, str], n: int) -> DataFrame:
    """``__rk`` and ``__list``: rows of each key in lists of about ``LIST_ROWS``, of the columns ``names`` and whether there is a row."""
    fields = F.struct(*[F.col(c).alias(new) for c, new in names.items()], F.lit(True).alias("__hit"))
    lists = F.floor(F.rand(5) * max(1, -(-n // LIST_ROWS)))
    return (right.select("__rk", lists.alias("__part"), fields.alias("__row")).groupBy("__rk", "__part")
            .agg(F.collect_list("__row").alias("__list")).drop("__part"))


def many_to_many_join(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner", null_safe: bool = False,
                      task_rows: int = DEFAULT_TASK_ROWS, max_rows: int | None = None, suffix: str = "_right",
                      max_broadcast_rows: int | None = None) -> DataFrame:
    """``left`` joined to ``right`` on columns of the same names, ``inner`` or ``left``.

    The key columns are the left side's; other columns of ``right`` whose
    names ``left`` has get ``suffix``. With ``null_safe`` a null key matches a
    null key. ``max_rows`` refuses a larger inner result before any of it is
    made. Repeated keys on either side are joined as they are. Sides should be
    read from files or be written: rows of heavy keys are dealt by a draw that a
    repeated task must be able to repeat.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unknown join {how!r}")
    on = [on] if isinstance(on, str) else list(on)
    taken = {c.lower() for c in left.columns}
    names = {c: c + suffix if c.lower() in taken else c for c in right.columns if c not in on}
    counts = written(key_counts(left, right, on, null_safe))
    size = F.col("n_left").cast("decimal(38,0)") * F.col("n_right")
    total, largest = counts.agg(F.coalesce(F.sum(size), F.lit(0)), F.coalesce(F.max(size), F.lit(0))).first()
    if max_rows is not None and total > max_rows:
        raise ValueError(f"the join would give {total} rows, more than {max_rows}")
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = F.least(F.ceil(size / task_rows), F.lit(min(MOST_PIECES, PIECES_A_TASK * tasks))).cast("int")
    heavy = counts.where(size > task_rows).select(F.col("__k").alias("__h"), pieces.alias("__p"), (F.col("n_left") >= F.col("n_right")).alias("__cut_left"))
    heavy, _ = checked_broadcast(heavy, max_broadcast_rows)
    if largest > task_rows:
        keyed = (right if null_safe else right.dropna(subset=on)).select(F.struct(*on).alias("__rk"), *names)
        if (sent := _sent_rows(keyed, max_broadcast_rows)) is not None:
            tasks = min(MOST_PIECES, int(total) // PAIRS_A_TASK)
            rows = left.repartition(tasks) if tasks > 1 else left
            met = rows.select("*", F.struct(*on).alias("__k")).join(F.broadcast(_listed(keyed, names, sent)), F.col("__k") == F.col("__rk"), how)
            each = F.inline_outer("__list") if how == "left" else F.inline("__list")
            return met.select(*left.columns, each).select(*left.columns, *names.values())

    def dealt(df: DataFrame, cut: str) -> DataFrame:
        """The cut side's rows get one piece each, the other side's rows a copy per piece."""
        # The salt is drawn where the rows are read, so a repeated task draws it again as it was.
        salt = F.xxhash64(*df.columns).bitwiseXOR(F.floor(F.rand(5) * (1 << 20)).cast("long"))
        keyed = df.select("*", F.struct(*on).alias("__k"), salt.alias("__salt"))
        keyed = keyed.join(heavy, F.col("__k").eqNullSafe(F.col("__h")) if null_safe else F.col("__k") == F.col("__h"), "left")
        own = F.pmod(F.xxhash64("__salt"), F.col("__p"))
        every = F.sequence(F.lit(0), F.col("__p") - 1)
        slots = F.when(F.col("__p").isNull(), F.array(F.lit(0))).when(F.expr(cut), F.array(own.cast("int"))).otherwise(every)
        keyed = keyed.withColumn("__heavy", F.col("__p").isNotNull())
        return keyed.withColumn("__s", F.explode(slots)).drop("__h", "__p", "__cut_left", "__salt")

    a = dealt(left, "__cut_left")
    b = dealt(right, "not __cut_left").select(F.col("__k").alias("__rk"), F.col("__s").alias("__rs"), F.lit(True).alias("__hit"), *[F.col(c).alias(n) for c, n in names.items()])
    same = F.col("__k").eqNullSafe(F.col("__rk")) if null_safe else F.col("__k") == F.col("__rk")
    if not null_safe:
        # Struct equality takes null parts as equal; a plain join does not.
        b = b.where(~F.exists(F.array(*[F.col(f"__rk.{c}").isNull() for c in on]), lambda x: x))
    joined = a.join(b, same & (F.col("__s") == F.col("__rs")), how)
    if how == "left":
        # A heavy key is on both sides: a copy of a left row that meets no piece has one that does.
        joined = joined.where("__hit or not __heavy")
    return joined.select(*left.columns, *names.values())
