"""Compare the statistics of both sides and derive clean and key columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import compare

# Which comparer decides on which statistic.
STAT_RULES: dict[str, Callable[[Column, Column], Column]] = {
    "count": compare.exact,
    "distinct": compare.exact,
    "min": compare.flexible,
    "max": compare.flexible,
    "avg": compare.tolerance,
    "std": compare.tolerance,
    "missing": compare.exact_zero_null,
    "freq": compare.freq_list,
}

# The statistics of the graded (three-way) comparison.
GRADED_STATS = ["count", "distinct", "missing", "max", "min", "avg", "std", "sum", "sum_sq"]

# Number of key columns, and of extra high-cardinality hash columns.
KEY_COLUMNS, EXTRA_HASH_COLUMNS = 5, 2
# Fixed value: match rate from which a table is shown as good.
GOOD_RATE = 95.0

STRUCT_STATS = ["kind", "count", "distinct", "missing", "min", "max", "avg", "std", "sum", "sum_sq", "freq"]


def side_by_side(stats: DataFrame, by: list[str]) -> DataFrame:
    """``(by..., column, l, r)`` from statistics that carry a ``side`` column.

    A conditional aggregate instead of a self join: the profile is computed once.
    """
    packed = F.struct(*STRUCT_STATS)
    pick = lambda side: F.first(F.when(F.col("side") == side, packed), ignorenulls=True)
    return stats.groupBy(*by, "column").agg(pick("left").alias("l"), pick("right").alias("r"))


def pair_by_mapping(left: DataFrame, right: DataFrame, mapping: DataFrame, by: list[str]) -> DataFrame:
    """The same from two separate tables whose columns are named differently.

    ``mapping`` has ``left_col`` and ``right_col``; it is broadcast because it holds one
    row per column of a schema. A group or column on one side only keeps its row.
    """
    packed = F.struct(*STRUCT_STATS)
    names = F.broadcast(mapping.select("left_col", "right_col"))
    l = left.join(names, F.col("column") == F.col("left_col")).select(*by, "left_col", packed.alias("l"))
    r = right.join(names, F.col("column") == F.col("right_col")).select(*by, "left_col", packed.alias("r"))
    return l.join(r, [*by, "left_col"], "full_outer").withColumnRenamed("left_col", "column")


def stat_flags(paired: DataFrame, rules: dict = STAT_RULES) -> DataFrame:
    """One flag per statistic plus ``is_match``; a missing side never matches."""
    present = F.col("l").isNotNull() & F.col("r").isNotNull()
    flags = {name: present & rule(F.col(f"l.{name}"), F.col(f"r.{name}")) for name, rule in rules.items()}
    every = F.lit(True)
    for name in rules:
        every = every & F.col(f"{name}_ok")
    return paired.withColumns({f"{n}_ok": F.coalesce(c, F.lit(False)) for n, c in flags.items()}).withColumn("is_match", every)


def column_verdicts(flagged: DataFrame, table: list[str] | None = None) -> DataFrame:
    """Per column over all vintages: mismatched when any vintage differs, and its cardinality."""
    table = table or []
    return flagged.groupBy(*table, "column").agg(
        F.count(F.lit(1)).alias("vintages"),
        F.count_if(~F.col("is_match")).alias("vintages_mismatched"),
        F.bool_or(~F.col("is_match")).alias("is_mismatched"),
        F.coalesce(F.max("l.distinct"), F.lit(0).cast("bigint")).alias("max_distinct"),
    )


def key_columns(verdicts: DataFrame, table: list[str] | None = None, n: int = KEY_COLUMNS) -> DataFrame:
    """The ``n`` clean columns with the most distinct values, with their rank."""
    order = Window.partitionBy(*(table or [])).orderBy(F.col("max_distinct").desc(), "column")
    ranked = verdicts.where("NOT is_mismatched").withColumn("key_rank", F.row_number().over(order))
    return ranked.where(F.col("key_rank") <= n)


def hash_columns(verdicts: DataFrame, table: list[str] | None = None, extra: int = EXTRA_HASH_COLUMNS) -> DataFrame:
    """Clean columns plus the ``extra`` columns of highest cardinality, whatever their verdict."""
    table = table or []
    order = Window.partitionBy(*table).orderBy(F.col("max_distinct").desc(), "column")
    ranked = verdicts.withColumn("rn", F.row_number().over(order))
    return ranked.where(~F.col("is_mismatched") | (F.col("rn") <= extra)).select(*table, "column", "is_mismatched", "max_distinct")


def match_rate(flagged: DataFrame, by: list[str]) -> DataFrame:
    """Columns in all, matched and not per group, and the rate as text."""
    total, ok = F.count(F.lit(1)), F.count_if("is_match")
    rate = F.when(total > 0, ok * 100.0 / total).otherwise(F.lit(0.0))
    return flagged.groupBy(*by).agg(
        total.alias("total_columns"), ok.alias("matched_columns"), (total - ok).alias("mismatched_columns"),
        F.format_string("%.1f%%", rate).alias("match_rate"))


def rate_band(rate_text: Column) -> Column:
    """``good`` from the threshold on, ``bad`` below, NULL when it is not a rate."""
    rate = F.rtrim(rate_text, F.lit("%")).try_cast("double")
    return F.when(rate >= GOOD_RATE, "good").when(rate.isNotNull(), "bad")


def graded(paired: DataFrame) -> DataFrame:
    """PASS, PARTIAL (only frequencies differ) or FAIL, with the differing statistics."""
    text = lambda c: F.col(c).cast("string")
    ok = {s: compare.robust(text(f"l.{s}"), text(f"r.{s}")) for s in GRADED_STATS}
    no_freq = F.array().cast("array<struct<value:string,n:bigint>>")
    sorted_freq = lambda side: compare.freq_sorted(F.coalesce(F.col(f"{side}.freq"), no_freq))
    ok["freq"] = compare.freq_list(sorted_freq("l"), sorted_freq("r"), compare.robust)
    flagged = paired.withColumns({f"{s}_ok": c for s, c in ok.items()})
    differs = F.array(*[
        F.struct(F.lit(s).alias("statistic"),
                 (text(f"l.{s}") if s != "freq" else compare.freq_text(F.col("l.freq"))).alias("left_value"),
                 (text(f"r.{s}") if s != "freq" else compare.freq_text(F.col("r.freq"))).alias("right_value"),
                 F.col(f"{s}_ok").alias("same"))
        for s in ok
    ])
    plain = F.lit(True)
    for s in GRADED_STATS:
        plain = plain & F.col(f"{s}_ok")
    return flagged.withColumn("mismatches", F.filter(differs, lambda d: ~d["same"])).withColumns({
        "mismatch_count": F.size("mismatches"),
        "status": F.when(plain & F.col("freq_ok"), "PASS").when(plain, "PARTIAL").otherwise("FAIL"),
    })


def status_counts(graded_columns: DataFrame, table: list[str]) -> DataFrame:
    one = lambda s: F.count_if(F.col("status") == s).alias(s.lower())
    return graded_columns.groupBy(*table).agg(F.count(F.lit(1)).alias("columns"), one("PASS"), one("PARTIAL"), one("FAIL"))


def failed_columns(graded_columns: DataFrame) -> DataFrame:
    keep = [c for c in graded_columns.columns if c in ("table_name", "vintage", "column")]
    return graded_columns.where("status = 'FAIL'").select(
        *keep,
        F.col("l.count").alias("left_count"), F.col("r.count").alias("right_count"),
        F.col("l.distinct").alias("left_distinct"), F.col("r.distinct").alias("right_distinct"))


def long_stats(paired: DataFrame, by: list[str], rounded=None) -> DataFrame:
    """One row per statistic, all ten, with both values as text and an equality flag.

    ``rounded`` maps statistics to functions that shape them before they are printed.
    """
    shown, rounded = [s for s in STRUCT_STATS if s != "kind"], rounded or {}
    plain = lambda c: c

    def value(side: str, s: str) -> Column:
        if s == "freq":
            return compare.freq_text(F.col(f"{side}.freq"))
        return rounded.get(s, plain)(F.col(f"{side}.{s}")).cast("string")

    entries = F.array(*[
        F.struct(F.lit(s).alias("stat"), value("l", s).alias("left_value"), value("r", s).alias("right_value"))
        for s in shown
    ])
    return paired.select(*by, "column", F.inline(entries)).withColumn(
        "is_equal", F.col("left_value").eqNullSafe(F.col("right_value")))
