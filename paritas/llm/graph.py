"""Connected components of an edge table, with star contractions.

Rounds of large-star and small-star steps (each a grouped minimum and a join) until the edges are stars around the
least node of each component. Every round is written to the shared folder, so no lineage grows and lost executors
cost a reread; the round before it is dropped then. A node with very many neighbours is a grouped minimum that starts per task, and a join that
adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paritas.llm.common import dropped, stored
from paritas.sources.results import shuffles_removed


def _hooked(pairs: DataFrame, keep_own: bool) -> DataFrame:
    """For each u the least of u and its neighbours; every neighbour (and u itself with ``keep_own``) points there."""
    least = pairs.groupBy(F.col("u").alias("hub")).agg(F.min("v").alias("least")) \
        .select("hub", F.least("hub", "least").alias("least"))
    moved = pairs.join(least, F.col("u") == F.col("hub"))
    out = moved.select(F.col("v").alias("u"), F.col("least").alias("v"))
    if keep_own:
        out = out.unionAll(least.select(F.col("hub").alias("u"), F.col("least").alias("v")))
    return out.where("u <> v").distinct()


def _state(pairs: DataFrame) -> tuple:
    with shuffles_removed(pairs.sparkSession):
        return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """node, component (least node) for every node of ``edges(u, v)`` that is not the least of its component."""
    pairs = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while before != (now := _state(pairs)):
        before = now
        both = pairs.unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("hub")).agg(F.min("v").alias("least")).select("hub", F.least("hub", "least").alias("least"))
        large = both.where("v > u").join(least, F.col("u") == F.col("hub")) \
            .select(F.col("v").alias("u"), F.col("least").alias("v")).where("u <> v").distinct()
        last, pairs = pairs, stored(_hooked(large, True).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        dropped(last)
    out = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    out.scratch_path = pairs.scratch_path
    return out
