"""Statistics per group that are stored by batch and merged: new rows do not rescan old ones.

A batch adds one row per group: count, sum, smallest and largest value, and a
KLL quantile sketch of at most a few kilobytes. Statistics over any set of
batches come from merging their rows. Count, sum and extremes are exact (sums of
decimals; sums of doubles depend on their order); quantiles have a rank error
that falls with the sketch size ``k``: at k = 200 within 1.65 % of the
rows in 99 of 100 cases, at the default k = 800 about 0.45 %.

For exact quantiles see ``tessera.operators.stats``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.io import remove

DEFAULT_K = 800


def summarise(df: DataFrame, by: str | Sequence[str], col: str, k: int = DEFAULT_K, scale: int | None = None) -> DataFrame:
    """One row per group of ``by``: ``n``, ``total``, ``least``, ``most`` and ``sketch`` of the non-null values of ``col``.

    ``scale`` sums in decimals of that many places. Combined map-side.
    """
    by = [by] if isinstance(by, str) else list(by)
    value = F.col(col) if scale is None else F.col(col).cast(f"decimal(28,{scale})")
    return df.where(F.col(col).isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.min(col).alias("least"), F.max(col).alias("most"),
        F.kll_sketch_agg_double(F.col(col).cast("double"), k).alias("sketch"))


def merged(summaries: DataFrame, by: str | Sequence[str], k: int = DEFAULT_K) -> DataFrame:
    """Summaries of several batches as one row per group."""
    by = [by] if isinstance(by, str) else list(by)
    return summaries.groupBy(*by).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("least").alias("least"), F.max("most").alias("most"),
        F.kll_merge_agg_double("sketch", k).alias("sketch"))


def with_quantile(summaries: DataFrame, q: float = 0.5, out: str = "quantile") -> DataFrame:
    """Adds the ``q`` quantile that the sketch gives."""
    return summaries.withColumn(out, F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))))


class Store:
    """Summaries of a growing table under one folder, a folder per batch."""

    def __init__(self, spark: SparkSession, root: str, by: str | Sequence[str], col: str, k: int = DEFAULT_K, scale: int | None = None):
        self.spark, self.root, self.by, self.col, self.k, self.scale = spark, root.rstrip("/"), by, col, k, scale

    def _path(self, batch: str) -> str:
        if not batch or set(batch) & set("/=:*?{}[]"):
            raise ValueError(f"a batch cannot be named {batch!r}")
        return f"{self.root}/batch={batch}"

    def add(self, batch: str, rows: DataFrame) -> None:
        """Summarise a batch's rows; a batch that is there is replaced, so a repeated load counts once."""
        summarise(rows, self.by, self.col, self.k, self.scale).write.mode("overwrite").parquet(self._path(batch))

    def drop(self, batch: str) -> None:
        remove(self.spark, self._path(batch))

    def read(self, batches: Sequence[str] | None = None) -> DataFrame:
        """Merged statistics of the named batches, of all by default."""
        paths = [self.root] if batches is None else [self._path(b) for b in batches]
        there = self.spark.read.option("basePath", self.root).parquet(*paths)
        return merged(there, self.by, self.k)
