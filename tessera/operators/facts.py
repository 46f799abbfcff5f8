"""Fact resolution: natural keys to surrogate keys, and derived measures.

``resolve_keys`` left-joins a fact to one dimension on its natural key: the
path for dimensions from elsewhere. The lookup side (natural key + surrogate
key only) is broadcast when its size is checked small; otherwise the join is
a shuffle join and AQE splits partitions of a hot natural key.

The SHA keys of ``build_dimension`` are a pure function of the natural key.
For a dimension marked so (``DimSpec.sha``), ``resolve_star`` computes the key
on the fact and checks membership apart, on the fact's distinct natural keys:
the fact itself is never shuffled for a lookup, however large the dimension.
Natural keys are compared, not their hashes, so ``("a||b", "c")`` and
``("a", "b||c")``, which share a key, are told apart as by a join.

Fact rows with a null or unknown natural key get a null surrogate key, or the
key of the dimension's own default member with ``unknown_member``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StringType

from tessera.functions.keys import KEY_SEPARATOR, all_present, sha_key
from tessera.operators.joins import checked_broadcast


@dataclass(frozen=True)
class DimSpec:
    """A dimension to resolve against: its frame, natural key and surrogate key.

    ``sha`` says that the surrogate key is ``sha_key`` of the natural key, with
    ``sep`` and ``null_token``, as ``build_dimension`` makes it.
    """
    dim: DataFrame
    natural_key: Sequence[str]
    surrogate_key: str
    sha: bool = False
    sep: str = KEY_SEPARATOR
    null_token: str | None = None

    def key(self) -> Column:
        """The surrogate key, computed; null if a part of the natural key is."""
        return F.when(all_present(self.natural_key), sha_key(self.natural_key, self.sep, self.null_token))


def default_key(spec: DimSpec, member: str) -> Column:
    """The surrogate key of the dimension's own default member (``member`` in every text column, null elsewhere)."""
    same = reduce(lambda a, b: a & b, [
        F.col(c) == F.lit(member) if isinstance(spec.dim.schema[c].dataType, StringType) else F.col(c).isNull()
        for c in spec.natural_key])
    found = spec.dim.where(same).select(spec.surrogate_key).limit(1).collect()
    if not found:
        raise ValueError(f"the dimension has no member {member!r} to take unknown facts")
    return F.lit(found[0][0])


def _duplicates(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    return dim.groupBy(*keys).count().where("count > 1")


def resolve_keys(fact: DataFrame, spec: DimSpec, unknown_member: str | None = None,
                 max_broadcast_rows: int | None = None, check_unique: bool = True) -> DataFrame:
    """Left-join ``fact`` to ``spec.dim`` on the natural key; adds the surrogate key.

    ``check_unique`` first verifies that no natural key appears twice in the
    dimension (a duplicate would multiply fact rows); it runs on the
    materialised lookup, not on the fact.
    """
    keys = list(spec.natural_key)
    lookup = spec.dim.select(*keys, spec.surrogate_key)
    lookup, _ = checked_broadcast(lookup, max_broadcast_rows)
    if check_unique and _duplicates(lookup, keys).limit(1).count():
        raise ValueError(f"dimension natural key {keys} is not unique; the join would fan out")
    out = fact.join(lookup, on=keys, how="left")
    if unknown_member is not None:
        out = out.withColumn(spec.surrogate_key, F.coalesce(F.col(spec.surrogate_key), default_key(spec, unknown_member)))
    return out


def _key_columns(spec: DimSpec, mark: str) -> list[str]:
    return [f"__{mark}{j}" for j in range(len(spec.natural_key))]


def _matches(spec: DimSpec, frame: DataFrame, other: DataFrame, names: Sequence[str]) -> Column:
    """Equality of the natural key, part by part, as in a join."""
    return reduce(lambda a, b: a & b, [frame[c] == other[n] for c, n in zip(spec.natural_key, names)])


def _strangers(keys: DataFrame, spec: DimSpec) -> DataFrame:
    """Distinct natural keys without nulls that the dimension does not hold, as ``__w0``, ``__w1``, ..."""
    wanted = keys.select(*spec.natural_key).where(all_present(spec.natural_key)).distinct()
    members = spec.dim.select(*[F.col(c).alias(n) for c, n in zip(spec.natural_key, _key_columns(spec, "m"))])
    lost = wanted.join(members, _matches(spec, wanted, members, _key_columns(spec, "m")), "left_anti")
    return lost.toDF(*_key_columns(spec, "w"))


def resolve_star(fact: DataFrame, specs: Sequence[DimSpec], keep: Sequence[str] | None = None,
                 unknown_member: str | None = None,
                 max_broadcast_rows: int | None = None, check_unique: bool = True, keys_from: DataFrame | None = None) -> DataFrame:
    """Resolve every dimension, then project surrogate keys + ``keep``.

    For all ``sha`` dimensions together one job counts the fact's distinct
    natural keys that are no member and (``check_unique``) natural and
    surrogate keys that appear twice. Only a dimension with strangers needs its facts looked
    up, against the strangers. ``keys_from`` is a frame with the same natural
    keys as ``fact`` (or more) that is cheaper to read, such as the stage the
    fact is computed from.
    """
    sha = [s for s in specs if s.sha]
    counts: dict[tuple[int, str], int] = {}
    if sha:
        source = fact if keys_from is None else keys_from
        checks = [_strangers(source, s).select(F.lit(i).alias("i"), F.lit("stranger").alias("what")) for i, s in enumerate(sha)]
        if check_unique:
            checks += [_duplicates(s.dim, key).select(F.lit(i).alias("i"), F.lit(what).alias("what")) for i, s in enumerate(sha)
                       for key, what in ((s.natural_key, "twice"), ([s.surrogate_key], "shared"))]
        found = reduce(DataFrame.unionByName, checks).groupBy("i", "what").count().collect()
        counts = {(r["i"], r["what"]): r["count"] for r in found}
    out = fact
    for i, spec in enumerate(sha):
        if check_unique and counts.get((i, "twice")):
            raise ValueError(f"dimension natural key {list(spec.natural_key)} is not unique; the join would fan out")
        if counts.get((i, "shared")):
            raise ValueError(f"{spec.surrogate_key} is not unique: two members share a key; use a wider hash or a null token")
        key = spec.key()
        if counts.get((i, "stranger")):
            strange, _ = checked_broadcast(_strangers(source, spec), max_broadcast_rows)
            names = _key_columns(spec, "w")
            out = out.join(strange, _matches(spec, out, strange, names), "left").withColumn(
                spec.surrogate_key, F.when(F.col(names[0]).isNull(), key)).drop(*names)
        else:
            out = out.withColumn(spec.surrogate_key, key)
        if unknown_member is not None:
            out = out.withColumn(spec.surrogate_key, F.coalesce(F.col(spec.surrogate_key), default_key(spec, unknown_member)))
    for spec in specs:
        if not spec.sha:
            out = resolve_keys(out, spec, unknown_member, max_broadcast_rows, check_unique)
    if keep is None:
        return out
    return out.select(*[s.surrogate_key for s in specs], *keep)


def net_revenue(df: DataFrame, units: str = "UnitsSold", price: str = "UnitPrice",
                discount: str = "Discount", out: str = "NetRevenue",
                discount_unit: str = "fraction", scale: int | None = None) -> DataFrame:
    """``units * price * (1 - discount)``; null if any input is null.

    ``discount_unit="percent"`` reads 5 as 5 %. With ``scale`` the inputs are
    taken as decimals with so many places and the product is exact."""
    u, p, d = F.col(units), F.col(price), F.col(discount)
    if discount_unit == "percent":
        d = d / F.lit(100.0)
    if scale is not None:
        u, p, d = (x.cast(DecimalType(12, scale)) for x in (u, p, d))
    return df.withColumn(out, u * p * (F.lit(1) - d))
