"""Connected components of an edge table, by alternating large-star and small-star steps.

Each step is a map-side combined minimum per vertex and a join back, so a
vertex with very many neighbours is never gathered into one task. The result
of every step is written to the shared folder, which bounds the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stored


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    hooked = both.join(_least(both), "u").where("v > u")
    return hooked.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    hooked = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hooked.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def component_roots(edges: DataFrame) -> DataFrame:
    """Return ``vertex``, ``root`` (the smallest vertex of its component).

    ``edges`` has two long columns ``u`` and ``v``. Rows with a null end and
    loops are ignored; vertices without an edge to another vertex have no row.
    An empty table gives an empty result.
    """
    edges = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .distinct(), "components")
    seen = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if state == seen or not state["n"]:
            return edges.select(F.col("u").alias("vertex"), F.col("v").alias("root"))
        seen = state
        edges = stored(_small_star(_large_star(edges)), "components")
