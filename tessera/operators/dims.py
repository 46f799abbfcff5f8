"""Dimension building.

* ``build_dimension``  distinct natural keys + SHA-256 surrogate key, with an
  optional default member (``N/A`` in every text column) for unknown facts
* ``add_hash_key``     conform a code column (trim/upper) and add an integer key
* ``build_mapping``    a bridge dimension over several codes with a label and a
  key derived from the raw codes
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tessera.functions.keys import DEFAULT_HASH_ALGO, KEY_SEPARATOR, hash_key, normalize, sha_key
from tessera.operators.joins import written
from tessera.operators.numbering import assign_keys

# Fixed value: text of the default ("unknown") member of a dimension.
DEFAULT_MEMBER = "N/A"


def default_member(df: DataFrame, cols: Sequence[str], value: str = DEFAULT_MEMBER) -> DataFrame:
    """One row: ``value`` in text columns, null in the others, typed like ``df``."""
    types = {f.name: f.dataType for f in df.schema.fields}
    exprs = [(F.lit(value) if isinstance(types[c], StringType) else F.lit(None)).cast(types[c]).alias(c)
             for c in cols]
    return df.sparkSession.range(1).select(*exprs)


def unique_keys(dim: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """``dim`` as written, after a check that no ``key`` stands for two members (values of ``cols``)."""
    dim = written(dim)
    twice = dim.select(key, F.struct(*cols).alias("m")).distinct().groupBy(key).count().where("count > 1")
    if twice.limit(1).count():
        raise ValueError(f"{key} is not unique: two members share a key; use a wider hash or a null token")
    return dim


def build_dimension(df: DataFrame, cols: Sequence[str], key: str,
                    default: str | None = DEFAULT_MEMBER, null_token: str | None = None,
                    sep: str = KEY_SEPARATOR, check_unique: bool = True) -> DataFrame:
    """Distinct ``cols`` of ``df`` with ``key = sha256(concat_ws(sep, cols))``.

    ``check_unique`` writes the dimension and refuses one in which two members
    share a key (null parts in different places do, without ``null_token``).

    The default member is unioned in *before* the distinct, so a source that
    already holds the ``N/A`` tuple does not get it twice (one aggregate does
    both). The key is computed after the distinct, once per member.
    """
    members = df.select(*cols)
    if default is not None:
        members = members.unionByName(default_member(df, cols, default))
    dim = members.distinct().withColumn(key, sha_key(cols, sep, null_token))
    return unique_keys(dim, key, cols) if check_unique else dim


def add_hash_key(df: DataFrame, cols: Sequence[str], key: str, algo: str = DEFAULT_HASH_ALGO,
                 conform: bool = True, check_unique: bool = True, resolve: bool = False,
                 earlier: DataFrame | None = None) -> DataFrame:
    """Trim/upper-case ``cols`` (when ``conform``) and add ``key = hash(cols)``.

    ``check_unique`` refuses keys that two members share, which a 32-bit hash
    gives from some tens of thousands of members on. ``resolve`` gives such
    members numbers past the hash instead, and members of an ``earlier`` build
    (``cols`` and ``key``) the keys they have there; see
    ``numbering.assign_keys``. Repeated rows of ``df`` are kept.
    """
    out = df
    if conform:
        out = out.withColumns({c: normalize(c) for c in cols})
    if resolve or earlier is not None:
        return assign_keys(out, cols, key, algo, earlier)
    out = out.withColumn(key, hash_key(cols, algo))
    return unique_keys(out, key, cols) if check_unique else out


def _resolved_mapping(df: DataFrame, cols: Sequence[str], label: str, key: str, algo: str, digest: Column,
                      earlier: DataFrame | None, conformed: bool) -> DataFrame:
    """The bridge with keys by ``assign_keys``: a member is the digest of its codes."""
    past = None if earlier is None else earlier.select(digest.alias("__digest"), key).distinct()
    out = assign_keys(df.withColumn("__digest", digest), ["__digest"], key, algo, past)
    codes = [F.col(c) if conformed else normalize(c).alias(c) for c in cols]
    return out.select(key, *codes, label)


def build_mapping(df: DataFrame, cols: Sequence[str], label: str, key: str,
                  algo: str = DEFAULT_HASH_ALGO, normalize_first: bool = False,
                  sep: str = KEY_SEPARATOR, check_unique: bool = True, resolve: bool = False,
                  earlier: DataFrame | None = None) -> DataFrame:
    """Bridge dimension: ``key, cols..., label``.

    The key is ``hash(sha256(concat_ws(sep, cols)))`` (``algo="sha256"``
    keeps the hex digest itself). By default it is computed on the codes as
    they arrive and the codes are conformed afterwards, so two spellings of one
    combination get two keys; ``normalize_first=True`` conforms first.

    ``resolve`` and ``earlier`` (``cols`` and ``key``) are those of
    ``add_hash_key``; a member is then a combination of the codes the key is
    computed on, and those of ``earlier`` must be as they were then.
    """
    out = df.withColumns({c: normalize(c) for c in cols}) if normalize_first else df
    digest = sha_key(cols, sep)
    if resolve or earlier is not None:
        return _resolved_mapping(out, cols, label, key, algo, digest, earlier, normalize_first)
    ident = digest if algo == "sha256" else hash_key([digest], algo)
    out = out.withColumn(key, ident)
    if not normalize_first:
        out = out.withColumns({c: normalize(c) for c in cols})
    out = out.select(key, *cols, label)
    return unique_keys(out, key, cols) if check_unique else out
