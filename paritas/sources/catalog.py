"""Schemas as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .local import local_rows

CATALOG_SCHEMA = "table_name string, ordinal int, column_name string, data_type string"


def columns_of(df: DataFrame, table: str, case: str | None = None) -> DataFrame:
    """``(table_name, ordinal, column_name, data_type)`` in column order."""
    spell = {"upper": str.upper, "lower": str.lower}.get(case, lambda s: s)
    rows = [(table, i, spell(f.name), f.dataType.simpleString()) for i, f in enumerate(df.schema.fields, 1)]
    return local_rows(df.sparkSession, rows, CATALOG_SCHEMA)


def catalog_of(spark: SparkSession, tables: dict[str, DataFrame], case: str | None = None) -> DataFrame:
    out = None
    for name, df in tables.items():
        part = columns_of(df, name, case)
        out = part if out is None else out.unionByName(part)
    return out


def with_fill(df: DataFrame, table: str) -> DataFrame:
    """The catalog of a table with its row count and non-NULL count per column.

    All columns are counted in one aggregation of one row per task.
    """
    counted = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(F.col(c)).alias(c) for c in df.columns])
    filled = counted.select(
        "__rows",
        F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("non_null")) for c in df.columns])))
    return columns_of(df, table).join(F.broadcast(filled), "column_name").select(
        "table_name", "ordinal", "column_name", "data_type", F.col("__rows").alias("n_rows"), "non_null")
