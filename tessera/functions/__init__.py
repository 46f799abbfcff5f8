"""Column expressions used across the operators (all JVM-side built-ins)."""

from tessera.functions.keys import all_present, hash_key, normalize, sha_key
from tessera.functions.values import exact_avg, exact_sum, is_missing, seconds_between

__all__ = [
    "all_present", "hash_key", "normalize", "sha_key",
    "exact_avg", "exact_sum", "is_missing", "seconds_between",
]
