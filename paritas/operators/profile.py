"""Column statistics per group, for all columns of a table at once.

Numbers get a continuous profile (count, distinct, extremes, moments); everything else
a categorical one taken over its value frequencies. The work is two aggregations over
an unpivoted stream, both combined map-side before any shuffle:

* moments, grouped by ``(by, column)`` - a handful of rows per task leave the scan;
* value frequencies, grouped by ``(by, column, value)`` - the one large exchange. It
  replaces one ``count(distinct)`` per column, each of which would copy every row.

A value that holds a third of all rows shrinks to one row per task before it is moved.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions import moments
from ..functions.normalize import number_text
from ..functions.types import NUMBER
from .columns import ColumnPair

# Lengths of the frequency list in the two report styles.
TOP_VALUES, TOP_VALUES_WIDE = 10, 20

STATS = ["count", "distinct", "missing", "min", "max", "avg", "std", "sum", "sum_sq", "freq"]
FREQ_TYPE = "array<struct<value:string,n:bigint>>"


def unpivot_lanes(df: DataFrame, by: list[str], lanes: dict[str, dict[str, Column]]) -> DataFrame:
    """Rows ``(by..., column, lane...)``, one per input row and profiled column.

    ``lanes`` maps a column name to its value per lane; all columns share the lanes, so
    each value keeps a native type instead of being turned into text.
    """
    # inline rather than UNPIVOT: its plan compares equal when two consumers share it, so the
    # exchange behind the value frequencies is run once and reused
    rows = F.array(*[
        F.struct(F.lit(column).alias("column"), *[value.alias(lane) for lane, value in per.items()])
        for column, per in lanes.items()
    ])
    return df.select(*by, F.inline(rows))


def continuous_lanes(value: Column, dtype: T.DataType, digits: Column | None = None) -> dict[str, Column]:
    """Lanes of a number: exact identity for distinct counts, a double for moments. Text is told apart by its ``digits``."""
    none = lambda t: F.lit(None).cast(t)
    if isinstance(dtype, T.IntegralType):
        return {"v_long": value.cast("bigint"), "v_dbl": none("double"), "v_text": none("string")}
    if isinstance(dtype, T.DecimalType):
        return {"v_long": none("bigint"), "v_dbl": value.cast("double"), "v_text": value.cast("string")}
    return {"v_long": none("bigint"), "v_dbl": value.cast("double"), "v_text": none("string") if digits is None else digits}


@dataclass
class LongForm:
    """Unpivoted values of one side: numbers and everything else apart."""

    continuous: DataFrame | None
    categorical: DataFrame | None

    def union(self, other: LongForm) -> LongForm:
        both = lambda a, b: a.unionByName(b) if a is not None and b is not None else (a if a is not None else b)
        return LongForm(both(self.continuous, other.continuous), both(self.categorical, other.categorical))


def long_form(df: DataFrame, pairs: list[ColumnPair], side: str, by: list[str],
              normalised: bool = False) -> LongForm:
    """Unpivot the mapped columns of one side; ``normalised`` profiles cleaned text."""
    numbers, others = {}, {}
    for pair in pairs:
        if pair.family == NUMBER:
            column, _ = pair.source(side)
            dtype = df.schema[column].dataType
            written = isinstance(dtype, T.StringType)
            numbers[pair.name] = continuous_lanes(
                pair.value(df, side), T.DoubleType() if written else dtype, number_text(df[column], dtype) if written else None)
        else:
            value = pair.normal(df, side) if normalised else pair.value(df, side)
            if not normalised and pair.family == "timestamp":
                value = value.cast("date")
            others[pair.name] = {"v_text": value.cast("string")}
    return LongForm(
        unpivot_lanes(df, by, numbers) if numbers else None,
        unpivot_lanes(df, by, others) if others else None,
    )


def value_frequencies(categorical: DataFrame, by: list[str]) -> DataFrame:
    """``(by..., column, v_text, n)``: how often each value occurs, NULL included."""
    return categorical.groupBy(*by, "column", "v_text").agg(F.count(F.lit(1)).alias("n"))


def rank_frequencies(freq: DataFrame, by: list[str], top: int | None = None) -> DataFrame:
    """Rank by frequency, then value, NULL last; ``top`` keeps the head of each column.

    Spark turns the filter into a group limit before the exchange, so at most ``top``
    rows per task and column are moved.
    """
    order = Window.partitionBy(*by, "column").orderBy(F.col("n").desc(), F.col("v_text").asc_nulls_last())
    ranked = freq.withColumn("rn", F.row_number().over(order))
    return ranked if top is None else ranked.where(F.col("rn") <= top)


def top_frequencies(freq: DataFrame, by: list[str], top: int = TOP_VALUES) -> DataFrame:
    """``(by..., column, freq)`` with the ``top`` most frequent values in rank order."""
    head = rank_frequencies(freq, by, top)
    packed = F.array_sort(F.collect_list(F.struct("rn", F.col("v_text").alias("value"), "n")))
    return head.groupBy(*by, "column").agg(
        F.transform(packed, lambda s: F.struct(s["value"].alias("value"), s["n"].alias("n"))).alias("freq")
    )


def categorical_stats(freq: DataFrame, by: list[str]) -> DataFrame:
    """Statistics over the value frequencies; the NULL group counts as one value."""
    n = F.col("n").cast("double")
    return freq.groupBy(*by, "column").agg(
        F.sum("n").alias("count"),
        F.count(F.lit(1)).alias("distinct"),
        F.coalesce(F.max(F.when(F.col("v_text").isNull(), F.col("n"))), F.lit(0).cast("bigint")).alias("missing"),
        F.min("n").cast("string").alias("min"),
        F.max("n").cast("string").alias("max"),
        F.avg("n").alias("avg"),
        F.stddev_samp("n").alias("std"),
        F.sum(n).alias("sum"),
        F.sum(n * n).alias("sum_sq"),
    )


def _merged(parts: list[DataFrame], by: list[str], kind: str) -> DataFrame:
    """Partial results of the same columns as one row each.

    Every statistic comes from exactly one part, so stacking and one aggregation of a few
    rows replaces joins between the parts.
    """
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    have = [s for s in STATS if s in stacked.columns]
    out = stacked.groupBy(*by, "column").agg(*[F.first(s, ignorenulls=True).alias(s) for s in have])
    zero = F.lit(0).cast("bigint")
    out = out.withColumns({s: F.coalesce(s, zero) for s in ("distinct", "missing")})
    if "freq" not in have:
        out = out.withColumn("freq", F.lit(None).cast(FREQ_TYPE))
    return out.withColumn("kind", F.lit(kind)).select(*by, "column", "kind", *STATS)


def profile_categorical(categorical: DataFrame, by: list[str], top: int = TOP_VALUES) -> DataFrame:
    freq = value_frequencies(categorical, by)
    return _merged([categorical_stats(freq, by), top_frequencies(freq, by, top)], by, "categorical")


def profile_categorical_top(categorical: DataFrame, by: list[str], top: int = TOP_VALUES_WIDE) -> DataFrame:
    """The same statistics over the most frequent values only; missing stays exact."""
    freq = value_frequencies(categorical, by)
    head = rank_frequencies(freq, by, top)
    missing = freq.where("v_text IS NULL").select(*by, "column", F.col("n").alias("missing"))
    packed = top_frequencies(freq, by, top).withColumn("freq", F.array_sort("freq"))
    return _merged([categorical_stats(head, by).drop("missing"), missing, packed], by, "categorical")


def _moments(continuous: DataFrame, by: list[str]) -> DataFrame:
    """Counts, extremes and moments per column; sums are exact per magnitude, so they are the same in any partitioning."""
    number = F.coalesce(F.col("v_dbl"), F.col("v_long").cast("double"))
    rows = continuous.select(*by, "column", "v_long", "v_dbl", number.alias("x")).withColumn("magnitude", moments.magnitude(F.col("x")))
    parts = moments.part_columns(F.col("x"), F.col("magnitude"))
    grouped = rows.select(*by, "column", "v_long", "v_dbl", "x", "magnitude", *[c.alias(name) for name, c in parts.items()]) \
        .groupBy(*by, "column", "magnitude").agg(
            F.count("x").alias("count"), F.count(F.lit(1)).alias("rows"),
            *[f(c).alias(f"{name}_{c}") for name, f in (("min", F.min), ("max", F.max)) for c in ("v_long", "v_dbl")],
            F.sum(F.when(~moments.finite(F.col("x")), F.col("x"))).alias("odd"), *moments.part_sums())
    packed = F.struct("magnitude", *[f"m_{k}" for k in range(moments.SUMS)], *[f"q_{k}" for k in range(moments.SQUARES)])
    extreme = lambda f, name: F.coalesce(*[f(f"{name}_{c}").cast("string") for c in ("v_long", "v_dbl")])
    # a handful of magnitudes a column
    out = grouped.groupBy(*by, "column").agg(
        F.sum("count").alias("count"), (F.sum("rows") - F.sum("count")).alias("missing"), extreme(F.min, "min").alias("min"), extreme(F.max, "max").alias("max"),
        F.max("odd").alias("odd"), F.sort_array(F.collect_list(F.when(F.col("magnitude").isNotNull(), packed)), asc=False).alias("groups"))
    out = out.withColumn("exponent", moments.scale(F.col("groups")))
    total = lambda prefix, n, powers: moments.total(F.col("groups"), F.col("exponent"), prefix, n, powers)
    out = out.withColumns({"s": total("m", moments.SUMS, 1), "q": total("q", moments.SQUARES, 2), "unit": F.pow(F.lit(2.0), "exponent")})
    some, odd = F.col("count") > 0, F.col("odd")
    value = lambda usual, other: F.when(some, F.when(odd.isNull(), usual).otherwise(other))
    return out.select(
        *by, "column", "count", "missing", "min", "max",
        value(F.col("s.hi") * F.col("unit") / F.col("count"), odd).alias("avg"),
        value(moments.deviation(F.col("count"), F.col("s"), F.col("q")) * F.col("unit"), F.when(F.col("count") > 1, F.lit(float("nan")))).alias("std"),
        value(F.col("s.hi") * F.col("unit"), odd).alias("sum"), value(F.col("q.hi") * F.col("unit") * F.col("unit"), F.abs(odd)).alias("sum_sq"))


def profile_continuous(continuous: DataFrame, by: list[str]) -> DataFrame:
    number = F.coalesce(F.col("v_dbl"), F.col("v_long").cast("double"))
    distinct = (
        continuous.where(number.isNotNull())
        .groupBy(*by, "column", "v_long", "v_dbl", "v_text").agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*by, "column").agg(F.count(F.lit(1)).alias("distinct"))
    )
    return _merged([_moments(continuous, by), distinct], by, "continuous")


def profile_long(values: LongForm, by: list[str], top: int = TOP_VALUES) -> DataFrame:
    """Both profiles as one table, one row per ``(by..., column)``."""
    parts = []
    if values.continuous is not None:
        parts.append(profile_continuous(values.continuous, by))
    if values.categorical is not None:
        parts.append(profile_categorical(values.categorical, by, top))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def profile(df: DataFrame, pairs: list[ColumnPair], by: list[str], side: str = "left",
            top: int = TOP_VALUES, normalised: bool = False) -> DataFrame:
    """All columns and all groups of one table in a single job."""
    return profile_long(long_form(df, pairs, side, by, normalised), by, top)


def with_defaults(stats: DataFrame) -> DataFrame:
    """Lower-case names, and zero where a counter is missing."""
    lowered = stats.toDF(*[c.lower() for c in stats.columns])
    zero = F.lit(0).cast("bigint")
    return lowered.withColumns({c: F.coalesce(c, zero) for c in ("count", "distinct", "missing") if c in lowered.columns})


