"""The data work, as functions over DataFrames."""

from tessera.operators import (  # noqa: F401
    attendance,
    clean,
    dims,
    facts,
    joins,
    profile,
    quality,
    recipes,
    sequence,
    stats,
)
