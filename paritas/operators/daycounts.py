"""Row counts per day of both sides, and what follows from comparing them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import dates

NULL_DATE = "null_date"


def row_counts(df: DataFrame, day: Column) -> DataFrame:
    """``(day, n)``; rows without a day are counted under a NULL day."""
    return df.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n"))


def total_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def bounds(counts: DataFrame) -> DataFrame:
    """First and last day, NULL when there is none."""
    return counts.agg(F.min("day").alias("min_day"), F.max("day").alias("max_day"))


def distinct_days(df: DataFrame, day: Column) -> DataFrame:
    return df.select(day.alias("day")).where("day IS NOT NULL").distinct()


def both_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """Union of the days of two count tables with both counts, 0 where a side has none.

    The sides are stacked and summed, which is one exchange of a few rows per task and
    keeps a NULL day as a day of its own.
    """
    zero = F.lit(0).cast("bigint")
    stacked = left.select("day", F.col("n").alias("n_left"), zero.alias("n_right")).unionByName(
        right.select("day", zero.alias("n_left"), F.col("n").alias("n_right")))
    return stacked.groupBy("day").agg(F.sum("n_left").alias("n_left"), F.sum("n_right").alias("n_right"))


def common_mismatches(left: DataFrame, right: DataFrame) -> DataFrame:
    """Days on both sides whose counts differ, with the signed difference."""
    l, r = left.select("day", F.col("n").alias("n_left")), right.select("day", F.col("n").alias("n_right"))
    return l.join(r, "day").where("n_left <> n_right").withColumn("diff", F.col("n_left") - F.col("n_right"))


def only_left(left: DataFrame, right: DataFrame) -> DataFrame:
    """Days of the first table that the second lacks."""
    return left.join(right, "day", "left_anti").select("day")


def match_summary(both: DataFrame) -> DataFrame:
    """Days in all, matched and not, and whether all of at least one day match."""
    dated = both.where("day IS NOT NULL")
    matched = F.count_if(F.col("n_left") == F.col("n_right"))
    total = F.count(F.lit(1))
    return dated.agg(
        total.alias("total_days"),
        matched.alias("matched_days"),
        (total - matched).alias("unmatched_days"),
        ((total == matched) & (total > 0)).alias("all_match"),
    )


def scope_days(both: DataFrame, unit: str) -> DataFrame:
    """``(day, vintage)`` of the days that go on to the costly checks.

    A day with equal counts exists on both sides, hence its vintage does too.
    """
    return both.where("day IS NOT NULL AND n_left = n_right").select(
        "day", dates.vintage_label(F.col("day"), unit).alias("vintage"))


def observed_windows(days: DataFrame, unit: str) -> DataFrame:
    """Windows of the observed days only, the end excluded."""
    return days.groupBy(dates.observed_label(F.col("day"), unit).alias("vintage")).agg(
        F.min("day").alias("start_date"), F.date_add(F.max("day"), 1).alias("end_date"))


def days_in_windows(days: DataFrame, windows: DataFrame, unit: str) -> DataFrame:
    """Assign days to the windows that contain them.

    A window holds only days of its own label, so the range condition rides on an
    equi-join and never compares every day with every window.
    """
    labelled = days.withColumn("vintage", dates.vintage_label(F.col("day"), unit))
    return labelled.join(windows, "vintage").where(
        (F.col("day") >= F.col("start_date")) & (F.col("day") <= F.col("end_date")))


def all_windows(left: DataFrame, right: DataFrame, both: DataFrame, unit: str) -> DataFrame:
    """Vintages of either side: ``sides`` (both, left_only, right_only), the window (the left one where there
    is one) and the number of unequal days."""
    theirs = right.select("vintage", F.col("start_date").alias("r_start"), F.col("end_date").alias("r_end"), F.lit(True).alias("in_right"))
    mine = left.withColumn("in_left", F.lit(True)).join(theirs, "vintage", "full_outer")
    bad = (
        both.where("day IS NOT NULL AND n_left <> n_right")
        .groupBy(dates.vintage_label(F.col("day"), unit).alias("vintage"))
        .agg(F.count(F.lit(1)).alias("excluded_days"))
    )
    sides = F.when(F.col("in_right").isNull(), "left_only").when(F.col("in_left").isNull(), "right_only").otherwise("both")
    return mine.join(bad, "vintage", "left").select(
        "vintage", sides.alias("sides"), F.coalesce("start_date", "r_start").alias("start_date"),
        F.coalesce("end_date", "r_end").alias("end_date"),
        F.coalesce("excluded_days", F.lit(0).cast("bigint")).alias("excluded_days"))


def paired_windows(left: DataFrame, right: DataFrame, both: DataFrame, unit: str) -> DataFrame:
    """Vintages on both sides with the left window and its number of unequal days.

    Days are matched to a vintage by label, an equi-join, rather than by range.
    """
    shared = left.join(right.select("vintage"), "vintage", "left_semi")
    bad = (
        both.where("day IS NOT NULL AND n_left <> n_right")
        .groupBy(dates.vintage_label(F.col("day"), unit).alias("vintage"))
        .agg(F.count(F.lit(1)).alias("excluded_days"))
    )
    return shared.join(bad, "vintage", "left").withColumn(
        "excluded_days", F.coalesce("excluded_days", F.lit(0).cast("bigint")))
