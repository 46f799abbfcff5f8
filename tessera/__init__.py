"""tessera: warehouse ETL and analytics operators on the Spark DataFrame API.

Every operator is a plain function ``DataFrame -> DataFrame`` (or a few
DataFrames in, one out). The driver receives only counts and sizes that
decide a plan; Catalyst plans each call, and the operators only choose *where*
a shuffle or a broadcast is worth it.

Subpackages
-----------
``sources``    reading and writing stage tables, CSV, catalog tables, views
``functions``  Column expressions: surrogate keys, sentinels, exact sums
``operators``  the data work: cleaning, profiling, dimensions, facts, QA,
               attendance, recipes, joins
``plans``      derived inputs built from the test tables and the query catalogue
``streaming``  running a batch operator over micro-batches of arriving files
"""

from tessera.session import checkpoint_dir, get_session, scratch_path

__all__ = ["checkpoint_dir", "get_session", "scratch_path"]
