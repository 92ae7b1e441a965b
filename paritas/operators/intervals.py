"""Days and the windows that contain them, whatever the windows: overlapping, nested, of any length, open at an end.

Windows are cut into bins of days. A day lies in one bin, a window in those it touches, so both meet in an equi-join on the
bin and the bounds decide among the few that meet; no plan compares every day with every window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Days a bin.
WIDTH = 32


def _bin(day: Column, width: int) -> Column:
    return F.floor(F.unix_date(day) / width).cast("int")


def in_intervals(days: DataFrame, windows: DataFrame, day: str = "day", start: str = "start_date", end: str = "end_date",
                 width: int = WIDTH) -> DataFrame:
    """Each row of ``days`` with each window that contains its day, both ends included.

    A NULL start or end leaves the window open there. Windows are cut to the days there are before they are binned, so a
    window up to the year 9999 costs no more than one that ends with the data; windows that end before they start hold no
    day, and rows without a day are in no window. Windows without a day are not in the result.
    """
    seen = days.agg(F.min(day).alias("low"), F.max(day).alias("high"))
    low, high = seen.select("low").scalar(), seen.select("high").scalar()
    first, last = F.greatest(F.col(start).cast("date"), low), F.least(F.col(end).cast("date"), high)
    cut = windows.withColumns({"__first": first, "__last": last}).where("__first <= __last")
    binned = cut.withColumn("__bin", F.explode(F.sequence(_bin(F.col("__first"), width), _bin(F.col("__last"), width))))
    met = days.where(F.col(day).isNotNull()).withColumn("__bin", _bin(F.col(day), width)).join(binned, "__bin")
    return met.where(F.col(day).between(F.col("__first"), F.col("__last"))).drop("__bin", "__first", "__last")


def labels_of_days(days: DataFrame, windows: DataFrame, width: int = WIDTH) -> DataFrame:
    """``(day, vintage)``: every label a day falls under, once. A label may stand for several windows."""
    return in_intervals(days.select("day").distinct(), windows, width=width).select("day", "vintage").distinct()


def window_counts(both: DataFrame, labels: DataFrame, windows: DataFrame) -> DataFrame:
    """Per label with days of either side: its bounds, rows of both sides, and the days whose counts differ."""
    counted = both.join(labels, "day").groupBy("vintage").agg(
        F.sum("n_left").alias("day_rows_left"), F.sum("n_right").alias("day_rows_right"),
        F.count_if(F.col("n_left") != F.col("n_right")).alias("excluded_days"))
    bounds = windows.groupBy("vintage").agg(F.min("start_date").cast("date").alias("start_date"), F.max("end_date").cast("date").alias("end_date"))
    return counted.join(bounds, "vintage")
