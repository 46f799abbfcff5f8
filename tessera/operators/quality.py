"""Data-quality checks: referential integrity, reconciliation, schema.

Reconciliation replaces pairing rows by generated row ids (those ids encode
the partition layout, so two reads of equal data pair up differently) with a
multiset comparison: tag each side, union, group by all compared columns and
count per side. One shuffle, rows with equal values collapse map-side, nulls
group together (null-safe), and no ordering is needed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    DataType,
    DateType,
    DoubleType,
    FloatType,
    NumericType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from tessera.operators.joins import checked_broadcast, checkpointed
from tessera.operators.numbering import number_rows


@dataclass(frozen=True)
class ForeignKey:
    column: str
    dim: DataFrame
    dim_key: str


def _comparable(a: DataType, b: DataType):
    """How to compare a fact column with a dimension key: the type both are cast to, or None for as they are.

    Equal types, two numbers, and two of date and timestamp are compared as
    they are: Spark widens them to their common type (a date is its first
    moment). Anything else is compared as text.
    """
    for kinds in (NumericType, (DateType, TimestampType, TimestampNTZType)):
        if isinstance(a, kinds) and isinstance(b, kinds):
            return None
    if a == b:
        return None
    return StringType()


def _dim_keys(fact: DataFrame, fk: str, dim: DataFrame, dim_key: str) -> tuple[Column, DataFrame]:
    """The fact's key expression and the distinct non-null dimension keys, as ``__k``, in one comparable type."""
    kind = _comparable(fact.schema[fk].dataType, dim.schema[dim_key].dataType)
    value, key = F.col(fk), F.col(dim_key)
    if kind is not None:
        value, key = value.cast(kind), key.cast(kind)
    return value, dim.where(F.col(dim_key).isNotNull()).select(key.alias("__k")).distinct()


def orphans(fact: DataFrame, fk: str, dim: DataFrame, dim_key: str,
            max_broadcast_rows: int | None = None) -> DataFrame:
    """Fact rows whose ``fk`` has no match in ``dim`` (a null ``fk`` is an orphan).

    Dimension keys within the broadcast bounds (checked) are anti-joined in
    one pass over the fact. Otherwise the orphan *values* are found first,
    from the distinct key values of the fact (collapsed map-side, so a hot
    value costs one row per map task): if they are few, the fact is filtered
    in one pass; if not, it is anti-joined to the dimension keys.
    """
    value, keys = _dim_keys(fact, fk, dim, dim_key)
    keys, small = checked_broadcast(keys, max_broadcast_rows)
    if small:
        return fact.join(keys, value == keys["__k"], "left_anti")
    values = fact.select(value.alias("__v")).where(F.col("__v").isNotNull()).distinct()
    missing, few = checked_broadcast(values.join(keys, values["__v"] == keys["__k"], "left_anti"), max_broadcast_rows)
    if few:
        flagged = fact.join(missing, value == missing["__v"], "left")
        return flagged.where(F.col(fk).isNull() | F.col("__v").isNotNull()).select(*fact.columns)
    return fact.join(keys, value == keys["__k"], "left_anti")


def fk_report(fact: DataFrame, fks: Sequence[ForeignKey],
              max_broadcast_rows: int | None = None) -> DataFrame:
    """One row per foreign key: ``fk_column, n_rows, n_null, n_orphan``.

    ``n_orphan`` counts non-null values missing from the dimension. Each key
    is compared with its own dimension in their common type (as text if they
    have none, such as a number and a text). Keys whose dimension is within the broadcast
    bounds (checked, each on its own) are looked up together in one pass over
    the fact; a key with a larger dimension is counted by distinct value
    (combined map-side) and the counts are joined to the dimension keys.
    """
    small, large = [], []
    for i, fk in enumerate(fks):
        value, keys = _dim_keys(fact, fk.column, fk.dim, fk.dim_key)
        keys, ok = checked_broadcast(keys, max_broadcast_rows)
        (small if ok else large).append((i, fk, value.alias(f"__v{i}"), keys.withColumnRenamed("__k", f"__k{i}")))

    def counts(i: int, n: Column | None = None) -> list[Column]:
        one = F.lit(1) if n is None else n
        value, key = F.col(f"__v{i}"), F.col(f"__k{i}")
        zero = F.lit(0).cast("long")
        return [F.coalesce(F.sum(one), zero).alias("n_rows"),
                F.coalesce(F.sum(F.when(value.isNull(), one)), zero).alias("n_null"),
                F.coalesce(F.sum(F.when(value.isNotNull() & key.isNull(), one)), zero).alias("n_orphan")]

    out = []
    if small:
        rows = fact.select(*[v for _, _, v, _ in small])
        for i, _, _, keys in small:
            hinted = F.broadcast(keys)
            rows = rows.join(hinted, F.col(f"__v{i}") == F.col(f"__k{i}"), "left")
        totals = rows.agg(*[c.alias(f"c{i}_{j}") for i, _, _, _ in small for j, c in enumerate(counts(i))])
        lines = F.array(*[F.struct(F.lit(fk.column).alias("fk_column"), *[F.col(f"c{i}_{j}").alias(n) for j, n in
                                   enumerate(("n_rows", "n_null", "n_orphan"))]) for i, fk, _, _ in small])
        out.append(totals.select(F.inline(lines)))
    for i, fk, value, keys in large:
        freq = fact.select(value).groupBy(f"__v{i}").agg(F.count(F.lit(1)).alias("__n"))
        joined = freq.join(keys, F.col(f"__v{i}") == F.col(f"__k{i}"), "left")
        out.append(joined.agg(*counts(i, F.col("__n"))).select(F.lit(fk.column).alias("fk_column"), "n_rows", "n_null", "n_orphan"))
    return reduce(DataFrame.unionByName, out)


def _tagged_counts(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> DataFrame:
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    both = (left.select(*cols, one.alias("__l"), zero.alias("__r"))
                .unionByName(right.select(*cols, zero.alias("__l"), one.alias("__r"))))
    return both.groupBy(*cols).agg(F.sum("__l").alias("n_left"), F.sum("__r").alias("n_right"))


def common_columns(left: DataFrame, right: DataFrame) -> list[str]:
    return [c for c in left.columns if c in set(right.columns)]


def reconcile(left: DataFrame, right: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows whose multiplicity differs: ``cols..., n_left, n_right``.

    Empty exactly when the two sides hold the same multiset of rows.
    """
    cols = list(cols) if cols else common_columns(left, right)
    counts = _tagged_counts(left, right, cols)
    return counts.where(F.col("n_left") != F.col("n_right"))


def reconcile_summary(left: DataFrame, right: DataFrame,
                      cols: Sequence[str] | None = None) -> DataFrame:
    """One row: ``n_left, n_right, n_distinct_mismatch, n_only_left, n_only_right``.

    All counts come from one aggregate over the per-row counts, so the
    comparison runs once (not once per printed number).
    """
    cols = list(cols) if cols else common_columns(left, right)
    counts = _tagged_counts(left, right, cols)
    diff = F.col("n_left") - F.col("n_right")
    return counts.agg(
        F.sum("n_left").alias("n_left"),
        F.sum("n_right").alias("n_right"),
        F.count(F.when(diff != 0, F.lit(1))).alias("n_distinct_mismatch"),
        F.sum(F.greatest(diff, F.lit(0))).alias("n_only_left"),
        F.sum(F.greatest(-diff, F.lit(0))).alias("n_only_right"))


#: ``diff_columns`` of a key whose columns agree one by one while its rows do not.
PAIRING = "*"


def _value_text(df: DataFrame, c: str) -> Column:
    """A value as text, different for different values of the column (null stays null)."""
    kind = df.schema[c].dataType
    if isinstance(kind, BinaryType):
        return F.hex(c)
    if isinstance(kind, (FloatType, DoubleType)):
        return (F.col(c) + F.lit(0.0)).cast("string")  # -0.0 and 0.0 are equal
    return F.col(c).cast("string")


def reconcile_keyed(left: DataFrame, right: DataFrame, key: str,
                    cols: Sequence[str] | None = None) -> DataFrame:
    """Per business key whose rows differ: ``key, n_left, n_right, diff_columns``.

    Rows are compared as multisets, null-safely. ``diff_columns`` lists
    (comma-separated, in column order) the columns whose own multisets of
    values differ; it is ``*`` if they all agree and only their pairing into
    rows differs.

    Rows are counted per (key, all columns) and side (long sums, combined
    map-side); only rows with unequal counts are then taken apart by column.
    A duplicated key never produces a cross product.
    """
    cols = list(cols) if cols else [c for c in common_columns(left, right) if c != key]
    counts, _ = checkpointed(_tagged_counts(left, right, [key, *cols]))
    wrong = counts.where(F.col("n_left") != F.col("n_right"))
    per_key = counts.groupBy(key).agg(F.sum("n_left").alias("n_left"), F.sum("n_right").alias("n_right"),
                                      F.max(F.col("n_left") != F.col("n_right")).alias("__bad")).where("__bad")
    values = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), _value_text(counts, c).alias("v"))
                                 for i, c in enumerate(cols)])) if cols else None
    out = F.lit(PAIRING)
    if values is not None:
        melted = wrong.select(F.struct(key).alias("__key"), (F.col("n_left") - F.col("n_right")).alias("d"), values.alias("x"))
        differ = (melted.groupBy("__key", "x.i", "x.v").agg(F.sum("d").alias("d")).where("d <> 0")
                  .groupBy("__key").agg(F.sort_array(F.collect_set("i")).alias("__i")))
        names = F.array(*[F.lit(c) for c in cols])
        text = F.array_join(F.transform("__i", lambda i: F.element_at(names, i + 1)), ",")
        per_key = per_key.withColumn("__key", F.struct(key)).join(differ, "__key", "left")
        out = F.coalesce(text, out)
    return per_key.select(key, "n_left", "n_right", out.alias("diff_columns"))


def reconcile_positions(left: DataFrame, right: DataFrame, order: Sequence[str | Column],
                        cols: Sequence[str] | None = None) -> DataFrame:
    """Positions at which two tables differ once both are put in ``order``: ``position, found_in, diff_columns``.

    Positions are dense row numbers (``numbering.number_rows``), so equal
    tables pair up however they are partitioned. ``found_in`` is ``both``, ``left``
    or ``right`` (one side is longer); ``diff_columns`` names the columns that
    differ, null-safely, in column order, and is null where a side has no row.
    One row missing on a side shifts all after it: that is what a
    comparison by position reports; ``reconcile`` compares without one. Rows that tie in
    ``order`` pair up in any order, so name enough columns.
    """
    cols = list(cols) if cols else common_columns(left, right)
    a = number_rows(left, order, "position").select("position", F.struct(*cols).alias("l"))
    b = number_rows(right, order, "position").select("position", F.struct(*cols).alias("r"))
    differ = [F.when(~F.col("l")[c].eqNullSafe(F.col("r")[c]), F.lit(c)) for c in cols]
    found = F.when(F.col("r").isNull(), "left").when(F.col("l").isNull(), "right").otherwise("both")
    paired = a.join(b, "position", "full").where(~F.col("l").eqNullSafe(F.col("r")))
    return paired.select("position", found.alias("found_in"),
                         F.when(F.col("l").isNotNull() & F.col("r").isNotNull(), F.concat_ws(",", *differ)).alias("diff_columns"))


def expect_schema(df: DataFrame, expected: StructType, check_nullable: bool = False) -> list[str]:
    """Differences between ``df.schema`` and ``expected`` (empty list when equal).

    Reads only the schema; runs no job."""
    problems = []
    have = {f.name: f for f in df.schema.fields}
    for f in expected.fields:
        got = have.get(f.name)
        if got is None:
            problems.append(f"missing column {f.name}")
        elif got.dataType != f.dataType:
            problems.append(f"{f.name}: {got.dataType.simpleString()} != {f.dataType.simpleString()}")
        elif check_nullable and got.nullable != f.nullable:
            problems.append(f"{f.name}: nullable {got.nullable} != {f.nullable}")
    extra = set(have) - {f.name for f in expected.fields}
    problems += [f"unexpected column {c}" for c in sorted(extra)]
    return problems
