"""The meta check over a list of table pairs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.crosswalk import COMPARABLE
from ..sources.local import local_rows
from .pair import ReconPair

SUMMARY_SCHEMA = (
    "table_name string, left_accessible boolean, right_accessible boolean, excluded_reason string")


def open_pairs(makers: dict[str, Callable[[], ReconPair]], access: dict[str, tuple[bool, bool]]
               ) -> tuple[dict[str, ReconPair], list[tuple]]:
    """Pairs whose two tables can be read, and the others with the reason they are left out.

    The list is as long as the control table, one entry per pair of tables.
    """
    opened, listed = {}, []
    for name, make in makers.items():
        left, right = access[name]
        reason = None if left and right else "not accessible"
        if reason is None:
            opened[name] = make()
        listed.append((name, left, right, reason))
    return opened, listed


def meta_summary(spark: SparkSession, pairs: dict[str, ReconPair], listed: list[tuple]) -> DataFrame:
    """One row per listed pair: access, rows, days, comparable columns, or why it is left out."""
    tables = local_rows(spark, listed, SUMMARY_SCHEMA)
    counted = None
    for name, pair in pairs.items():
        rows = pair.day_counts.agg(
            F.sum("n_left").alias("left_rows"), F.sum("n_right").alias("right_rows"),
            F.count_if(F.col("n_left") != F.col("n_right")).alias("unequal_days"),
            F.count(F.lit(1)).alias("total_days"),
        ).withColumns({
            "table_name": F.lit(name),
            COMPARABLE: F.lit(len(pair.columns)).cast("bigint"),
        })
        counted = rows if counted is None else counted.unionByName(rows)
    if counted is None:
        return tables
    return tables.join(counted, "table_name", "left").withColumn(
        "all_match", F.coalesce((F.col("unequal_days") == 0) & (F.col("total_days") > 0), F.lit(False)))
