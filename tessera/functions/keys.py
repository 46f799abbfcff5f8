"""Surrogate-key expressions.

Two families, as in a star schema built without a key-lookup service:

* ``sha_key``: SHA-256 hex of the natural-key columns joined by a separator.
  Wide (256 bits), so collisions are not a practical concern.
* ``hash_key``: a shorter integer key. ``murmur3_32`` is Spark's ``hash``
  widened to bigint (the classic choice, but 32 bits collide: about 470 keys
  lost in 2,000,000); ``xxhash64`` is the 64-bit alternative.

Both are pure functions of the natural key, so a fact row can compute the key
of its dimension member without a join when the dimension is known to hold it.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

# Separator between natural-key parts, and the Murmur3 algorithm
# name used by default for integer keys.
KEY_SEPARATOR = "||"
DEFAULT_HASH_ALGO = "murmur3_32"


def _c(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize(c: ColumnLike) -> Column:
    """Trim surrounding spaces and upper-case (the conformed form of a code)."""
    return F.upper(F.trim(_c(c)))


def all_present(cols: Iterable[ColumnLike]) -> Column:
    """True when every column is non-null."""
    return reduce(lambda a, b: a & b, [_c(c).isNotNull() for c in cols])


def sha_key(cols: Iterable[ColumnLike], sep: str = KEY_SEPARATOR,
            null_token: str | None = None) -> Column:
    """SHA-256 hex of ``concat_ws(sep, cols)``.

    ``concat_ws`` skips nulls, so ``('A', null, 'B')`` and ``('A', 'B', null)``
    share a key. That is the default (it is what existing tables hold); pass
    ``null_token`` to write nulls as a visible token and keep such tuples apart.
    """
    parts = [_c(c).cast("string") for c in cols]
    if null_token is not None:
        parts = [F.coalesce(p, F.lit(null_token)) for p in parts]
    return F.sha2(F.concat_ws(sep, *parts), 256)


def hash_key(cols: Iterable[ColumnLike], algo: str = DEFAULT_HASH_ALGO) -> Column:
    """Integer (or hex, for ``sha256``) key of one or more columns."""
    cols = [_c(c) for c in cols]
    if algo == "murmur3_32":
        return F.hash(*cols).cast("bigint")
    if algo == "xxhash64":
        return F.xxhash64(*cols)
    if algo == "sha256":
        return sha_key(cols)
    raise ValueError(f"unknown hash algorithm {algo!r}")
