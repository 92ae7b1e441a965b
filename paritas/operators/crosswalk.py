"""Column crosswalks against the column catalogs of both sides.

Catalog: ``(col_map, column_name, data_type)``. Crosswalk: ``(col_map, left_col,
right_col, is_tokenized, ord)``. All joins run on ``(col_map, column)``, so many tables
are classified at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import is_missing
from ..functions.types import types_compatible

COMPARABLE, TOKENIZED, UNMAPPED = "comparable", "tokenized", "unmapped"


def _spelled(c: Column, side: str) -> Column:
    return F.upper(F.trim(c)) if side == "left" else F.lower(F.trim(c))


def _entries(crosswalk: DataFrame, side: str) -> DataFrame:
    """One crosswalk row per ``(col_map, column)`` of a side, the last one listed wins."""
    mine, other = (("left_col", "right_col") if side == "left" else ("right_col", "left_col"))
    rows = crosswalk.select(
        F.lower("col_map").alias("col_map"),
        _spelled(F.col(mine), side).alias("column_name"),
        F.coalesce("is_tokenized", F.lit(False)).alias("is_tokenized"),
        (~is_missing(F.col(other))).alias("has_other"),
        "ord",
    )
    return rows.groupBy("col_map", "column_name").agg(
        F.max_by(F.struct("is_tokenized", "has_other"), "ord").alias("entry")
    ).select("col_map", "column_name", "entry.is_tokenized", "entry.has_other")


def classify(catalog: DataFrame, crosswalk: DataFrame, side: str) -> DataFrame:
    """Class of every actual column: comparable, tokenized, one-sided or unmapped."""
    actual = catalog.select(F.lower("col_map").alias("col_map"), _spelled(F.col("column_name"), side).alias("column_name")).distinct()
    joined = actual.join(_entries(crosswalk, side), ["col_map", "column_name"], "left")
    return joined.select(
        "col_map", "column_name",
        F.when(F.col("has_other").isNull(), UNMAPPED)
        .when(F.col("is_tokenized"), TOKENIZED)
        .when(F.col("has_other"), COMPARABLE)
        .otherwise(f"{side}_only").alias("class"),
    )


def class_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy("col_map", "class").agg(F.count(F.lit(1)).alias("n"))


def _mapped(crosswalk: DataFrame) -> DataFrame:
    """Usable crosswalk rows, one per left column (the last one listed)."""
    rows = crosswalk.where(~is_missing(F.col("left_col")) & ~is_missing(F.col("right_col"))).select(
        F.lower("col_map").alias("col_map"),
        _spelled(F.col("left_col"), "left").alias("left_col"),
        _spelled(F.col("right_col"), "right").alias("right_col"),
        F.coalesce("is_tokenized", F.lit(False)).alias("is_tokenized"),
        "ord",
    )
    return rows


def _last_per_left(rows: DataFrame) -> DataFrame:
    last = F.max_by("right_col", "ord").alias("right_col")
    return rows.groupBy("col_map", "left_col").agg(last)


def _columns_of(df: DataFrame, name: str, side: str) -> DataFrame:
    return df.select(F.lower("col_map").alias("col_map"), _spelled(F.col("column_name"), side).alias(name)).distinct()


def column_mapping(left_classes: DataFrame, right_classes: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """``(col_map, left_col, right_col)`` for columns comparable on both sides."""
    comparable = lambda df, name, side: _columns_of(df.where(F.col("class") == COMPARABLE), name, side)
    usable = (
        _mapped(crosswalk).where(~F.col("is_tokenized"))
        .join(comparable(left_classes, "left_col", "left"), ["col_map", "left_col"], "left_semi")
        .join(comparable(right_classes, "right_col", "right"), ["col_map", "right_col"], "left_semi")
    )
    return _last_per_left(usable)


def unmapped_comparable(classes: DataFrame, mapping: DataFrame, side: str) -> DataFrame:
    """Comparable columns of a side that ended up in no mapping."""
    name = f"{side}_col"
    mine = _columns_of(classes.where(F.col("class") == COMPARABLE), name, side)
    return mine.join(mapping, ["col_map", name], "left_anti")


def documented(crosswalk: DataFrame) -> DataFrame:
    """Every usable crosswalk pair, tokenised or not, one per left column.

    A left column counts as tokenised when any of its rows says so.
    """
    rows = _mapped(crosswalk)
    return rows.groupBy("col_map", "left_col").agg(
        F.max_by("right_col", "ord").alias("right_col"), F.bool_or("is_tokenized").alias("is_tokenized"))


def typed_mapping(left_catalog: DataFrame, right_catalog: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Full classification with types, one row per column or mapped pair.

    ``section`` is comparable, tokenized, left_only or right_only; comparable pairs of
    incompatible types are flagged in ``type_mismatch``.
    """
    def typed(catalog: DataFrame, side: str) -> DataFrame:
        return catalog.groupBy(
            F.lower("col_map").alias("col_map"), _spelled(F.col("column_name"), side).alias(f"{side}_col")
        ).agg(F.max("data_type").alias(f"{side}_type"))

    left, right = typed(left_catalog, "left"), typed(right_catalog, "right")
    pairs = documented(crosswalk)
    both = pairs.join(left, ["col_map", "left_col"], "left").join(right, ["col_map", "right_col"], "left")
    comparable = both.where("NOT is_tokenized AND left_type IS NOT NULL AND right_type IS NOT NULL").select(
        "col_map", F.lit(COMPARABLE).alias("section"), "left_col", "right_col", "left_type", "right_type",
        (~types_compatible(F.col("left_type"), F.col("right_type"))).alias("type_mismatch"))
    no = lambda name: F.lit(None).cast("string").alias(name)
    tokenized = both.where("is_tokenized AND left_type IS NOT NULL").select(
        "col_map", F.lit(TOKENIZED).alias("section"), "left_col", no("right_col"), "left_type", no("right_type"),
        F.lit(False).alias("type_mismatch"))
    left_only = left.join(pairs, ["col_map", "left_col"], "left_anti").select(
        "col_map", F.lit("left_only").alias("section"), "left_col", no("right_col"), "left_type", no("right_type"),
        F.lit(False).alias("type_mismatch"))
    right_only = right.join(pairs, ["col_map", "right_col"], "left_anti").select(
        "col_map", F.lit("right_only").alias("section"), no("left_col"), "right_col", no("left_type"), "right_type",
        F.lit(False).alias("type_mismatch"))
    return comparable.unionByName(tokenized).unionByName(left_only).unionByName(right_only)


def used_by_pairs(crosswalk: DataFrame, pairs: DataFrame) -> DataFrame:
    """Crosswalk rows some enabled pair refers to, by ``col_map`` or else its table name."""
    from ..functions.text import base_name

    wanted = pairs.where("enabled").select(
        F.lower(F.coalesce("col_map", base_name(F.col("left_tbl")))).alias("__wanted")).distinct()
    return crosswalk.join(wanted, F.lower("col_map") == F.col("__wanted"), "left_semi")


def pivot_classes(classified: DataFrame, side: str) -> DataFrame:
    """Tables against classes with 0 where a class is absent."""
    classes = [COMPARABLE, TOKENIZED, f"{side}_only", UNMAPPED]
    counted = class_counts(classified)
    return counted.groupBy("col_map").pivot("class", classes).agg(F.sum("n")).na.fill(0)


