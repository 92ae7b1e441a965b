"""Row filters that keep their predicates within reach of the file scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import dates


def in_window(df: DataFrame, column: str, start: str | None, end: str | None, where: str | None = None,
              fmt: str | None = None, half_open: bool = False, mixed: bool = True) -> DataFrame:
    """Rows between two days, both included unless ``half_open``, and an extra condition.

    Every part is optional. ``mixed=False`` promises that text dates all have the format, and lets the window reach the scan.
    """
    if start is not None or end is not None:
        df = df.where(dates.within(F.col(column), df.schema[column].dataType, fmt, start, end, half_open, mixed))
    return df.where(where) if where else df


def day_column(df: DataFrame, column: str, fmt: str | None = None) -> Column:
    return dates.to_day(F.col(column), df.schema[column].dataType, fmt)


def without_days(df: DataFrame, column: str, days: DataFrame, fmt: str | None = None,
                 keep_null: bool = False) -> DataFrame:
    """Drop rows of the listed days (``days`` has one DATE column ``day``).

    The list is broadcast: it holds distinct days, so the calendar bounds it. Rows
    without a date are dropped as ``NOT IN`` would, unless asked to stay.
    """
    day = day_column(df, column, fmt)
    kept = df if keep_null else df.where(day.isNotNull())
    excluded = F.broadcast(days.select(F.col("day").alias("__day")).distinct())
    return kept.join(excluded, day == F.col("__day"), "left_anti")


def equals_scalar(df: DataFrame, column: str, value: Column) -> DataFrame:
    """``column = (scalar subquery)``, resolved inside the one statement."""
    return df.where(F.col(column) == value)


def as_extract(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns as plain text, NULL as a word."""
    from ..functions.hashing import extract_text

    return df.select(*[extract_text(F.col(c)).alias(c) for c in columns])


def in_scope(df: DataFrame, day: Column, scope: DataFrame) -> DataFrame:
    """Keep rows of the days in ``scope`` and label them with its ``vintage``.

    One join applies window, exclusion and label. ``scope`` has one row per day, which
    the calendar bounds, so it is broadcast and the table itself is not shuffled.
    """
    labelled = F.broadcast(scope.select(F.col("day").alias("__day"), "vintage"))
    return df.join(labelled, day == F.col("__day"), "inner").drop("__day")


def scope_status(tables: DataFrame) -> DataFrame:
    """Why a table can or cannot go on: needs meta results, both accesses, shared columns."""
    status = (
        F.when(~F.coalesce(F.col("has_meta"), F.lit(False)), "no_meta_results")
        .when(~(F.coalesce(F.col("left_accessible"), F.lit(False))
                & F.coalesce(F.col("right_accessible"), F.lit(False))), "not_accessible")
        .when(F.coalesce(F.col("comparable_columns"), F.lit(0)) == 0, "no_comparable_columns")
        .otherwise("ready")
    )
    return tables.withColumn("status", status)


def is_text(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.StringType)
