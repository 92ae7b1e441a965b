"""Report tables assembled from check results."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def transpose_stats(long: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """Statistics as rows, table columns as columns, one block per group and side.

    ``columns`` are the known column names, so the pivot needs no extra pass.
    """
    sides = F.array(
        F.struct(F.lit("left").alias("side"), F.col("left_value").alias("value")),
        F.struct(F.lit("right").alias("side"), F.col("right_value").alias("value")),
    )
    tall = long.select(*by, "column", "stat", F.inline(sides))
    return tall.groupBy(*by, "side", "stat").pivot("column", columns).agg(F.first("value"))


def mismatched_first(flagged: DataFrame, by: list[str]) -> DataFrame:
    return flagged.orderBy(*by, F.col("is_match").asc(), F.col("column").asc())


def sections(table: str, parts: dict[str, DataFrame]) -> DataFrame:
    """Several result tables as one: ``(table_name, section, payload)`` with JSON rows."""
    out = None
    for name, part in parts.items():
        rows = part.select(
            F.lit(table).alias("table_name"), F.lit(name).alias("section"),
            F.to_json(F.struct(*part.columns), {"ignoreNullFields": "false"}).alias("payload"))
        out = rows if out is None else out.unionByName(rows)
    return out


def section_sizes(parts: dict[str, DataFrame]) -> DataFrame:
    """``(section, n)``: the rows of each part, 0 for an empty one."""
    out = None
    for name, part in parts.items():
        one = part.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("section"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def register_views(views: dict[str, DataFrame]) -> None:
    """Expose results under names that SQL users can query."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def of_run(view: DataFrame, run_name: str, only_mismatches: bool = False) -> DataFrame:
    out = view.where(F.col("run_name") == run_name)
    return out.where("NOT has_match") if only_mismatches else out
