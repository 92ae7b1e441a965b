"""A pair of tables and the three dependent checks between them.

The checks gate each other: days whose counts differ are set aside before columns are
profiled, and only columns with equal statistics are hashed. What passes from one stage
to the next is small - days, and one row per vintage and column - and is written to
shared storage, so no later stage repeats the scans of an earlier one.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import dates
from ..operators import crosswalk as cw, daycounts, digest_tree, filters, gate, intervals, kept_hashes, profile, quality, reports, rowhash
from ..operators.columns import LEFT, RIGHT, ColumnPair, pair_columns
from ..sources import catalog
from ..sources.local import local_rows
from ..sources.results import exists, stored
from ..sources.scan import files_of

ALL = "all"

# What a vintage comes out as. MATCH and the three kinds of difference are for rows that were compared.
ROWS_DIFFER, COLUMNS_DIFFER, DAYS_DIFFER, MATCH = "ROWS_DIFFER", "COLUMNS_DIFFER", "DAYS_DIFFER", "MATCH"
VERDICT_SCHEMA = ("table_name string, column string, vintages bigint, vintages_mismatched bigint, is_mismatched boolean, "
                  "max_distinct bigint, key_rank int")
LEFT_ONLY, RIGHT_ONLY = "LEFT_ONLY", "RIGHT_ONLY"
NULL_DATES, NO_COLUMNS, NOT_HASHED = "NULL_DATES", "NO_COMPARABLE_COLUMNS", "NOT_HASHED"


@dataclass
class ReconPair:
    """Two tables that should hold the same data.

    ``crosswalk`` has left_col, right_col, is_tokenized and optionally col_map and ord; with a col_map only the rows
    of ``col_map``, or else of ``name``, count.
    Date columns may be dates, timestamps or text; the most frequent format of a text date is found
    by profiling the column unless it is given, and text in another notation is read as what it is.

    ``vintage_windows(vintage, start_date, end_date)`` gives the vintages in place of ``partition``; windows may overlap, and a
    row counts in each that holds its day. Rows outside of all of them take part in none.

    ``gated`` profiles only columns whose value fingerprints differ. The verdicts are the same; the cardinality of the others,
    by which key columns are chosen, is then estimated.

    ``base`` is the folder on shared storage for what passes between the stages; the session's own if None.
    """

    name: str
    left: DataFrame
    right: DataFrame
    crosswalk: DataFrame
    left_date: str | None = None
    right_date: str | None = None
    partition: str = ALL
    start: str | None = None
    end: str | None = None
    left_where: str | None = None
    right_where: str | None = None
    left_fmt: str | None = None
    right_fmt: str | None = None
    col_map: str | None = None
    key_count: int = quality.KEY_COLUMNS
    normalised_profile: bool = False
    keys: list[str] | None = None
    hash_all: bool = False
    base: str | None = None
    vintage_windows: DataFrame | None = None
    gated: bool = False
    rules: dict = field(default_factory=lambda: dict(quality.STAT_RULES))

    def __post_init__(self) -> None:
        self.unit = dates.partition_unit(self.partition)
        self._notations: dict[str, bool] = {}
        if (self.left_date is None) != (self.right_date is None):
            raise ValueError("give a date column on both sides or on none")
        if self.vintage_windows is not None and self.left_date is None:
            raise ValueError("windows need date columns")
        for side in (LEFT, RIGHT):
            _, column, fmt = self._date(side)
            if column and fmt is None and filters.is_text(self._table(side), column):
                setattr(self, f"{side}_fmt", self._detect(side, column))

    # ------------------------------------------------------------ sides

    def _table(self, side: str) -> DataFrame:
        return self.left if side == LEFT else self.right

    def _date(self, side: str) -> tuple[DataFrame, str | None, str | None]:
        if side == LEFT:
            return self.left, self.left_date, self.left_fmt
        return self.right, self.right_date, self.right_fmt

    def _detect(self, side: str, column: str) -> str | None:
        """The most frequent format of a text date; the profile has a handful of rows."""
        found = dates.format_profile(self._table(side), column).orderBy(F.col("n").desc(), "fmt").first()
        return found["fmt"] if found else None

    @property
    def dated(self) -> bool:
        return self.left_date is not None

    def rows(self, side: str) -> DataFrame:
        """A side under its own condition and the pair's date window."""
        df, column, fmt = self._date(side)
        where = self.left_where if side == LEFT else self.right_where
        if not column:
            return df.where(where) if where else df
        return filters.in_window(df, column, self.start, self.end, where, fmt, mixed=self._mixed(side))

    def _mixed(self, side: str) -> bool:
        """Does a text date column hold more notations than its main one? Asked, by profiling it, only for a window."""
        df, column, fmt = self._date(side)
        if (self.start or self.end) is None or not filters.is_text(df, column):
            return False
        if side not in self._notations:
            found = dates.format_profile(df, column).select("fmt").collect()  # one row per known format
            self._notations[side] = [r["fmt"] for r in found] != [fmt]
        return self._notations[side]

    def day(self, side: str) -> Column:
        df, column, fmt = self._date(side)
        return filters.day_column(df, column, fmt)

    def scoped(self, side: str) -> DataFrame:
        """Rows that take part in the costly checks, labelled with their vintage."""
        df = self.rows(side)
        if not self.dated:
            return df.withColumn("vintage", F.lit(ALL))
        return filters.in_scope(df, self.day(side), self.scope)

    # ------------------------------------------------------------ meta check

    @cached_property
    def _crosswalk(self) -> DataFrame:
        rows = self.crosswalk
        if "col_map" in rows.columns:
            rows = rows.where(F.lower("col_map") == (self.col_map or self.name).lower())
        rows = rows.withColumn("col_map", F.lit(self.name.lower()))
        if "ord" not in rows.columns:  # the values decide which of two rows for a column wins, not how the input was split
            rows = rows.withColumn("ord", F.row_number().over(Window.orderBy("left_col", "right_col")))
        # one table's share of the crosswalk is schema-sized: one partition spares every exchange
        return rows.coalesce(1)

    def _catalog(self, side: str) -> DataFrame:
        case = "upper" if side == LEFT else "lower"
        return catalog.columns_of(self._table(side), self.name.lower(), case).withColumnRenamed("table_name", "col_map").coalesce(1)

    def column_classes(self, side: str) -> DataFrame:
        return cw.classify(self._catalog(side), self._crosswalk, side)

    def typed_columns(self) -> DataFrame:
        return cw.typed_mapping(self._catalog(LEFT), self._catalog(RIGHT), self._crosswalk)

    @cached_property
    def columns(self) -> list[ColumnPair]:
        """Comparable column pairs, in left column order; bounded by the schema."""
        mapping = cw.column_mapping(self.column_classes(LEFT), self.column_classes(RIGHT), self._crosswalk)
        found = {r["left_col"]: r["right_col"] for r in mapping.collect()}
        actual_left = {c.upper(): c for c in self.left.columns}
        actual_right = {c.lower(): c for c in self.right.columns}
        ordered = {c: actual_right[found[u]] for u, c in actual_left.items() if u in found}
        return pair_columns(
            self.left, self.right, ordered,
            {self.left_date: self.left_fmt} if self.left_fmt else {},
            {self.right_date: self.right_fmt} if self.right_fmt else {},
        )

    @cached_property
    def day_counts(self) -> DataFrame:
        """``(day, n_left, n_right)`` over the union of days; one row for undated pairs."""
        if self.dated:
            left = daycounts.row_counts(self.rows(LEFT), self.day(LEFT))
            right = daycounts.row_counts(self.rows(RIGHT), self.day(RIGHT))
        else:
            nothing = F.lit(None).cast("date").alias("day")
            left = daycounts.total_rows(self.rows(LEFT)).select(nothing, "n")
            right = daycounts.total_rows(self.rows(RIGHT)).select(nothing, "n")
        return stored(daycounts.both_counts(left, right), f"{self.name}-days", self.base)

    @cached_property
    def day_labels(self) -> DataFrame:
        """``(day, vintage)`` of all days, several vintages for a day of overlapping windows; bounded by the calendar."""
        if self.vintage_windows is None:
            dated = self.day_counts.where("day IS NOT NULL")
            return dated.select("day", dates.vintage_label(F.col("day"), self.unit).alias("vintage"))
        return stored(intervals.labels_of_days(self.day_counts, self.vintage_windows), f"{self.name}-labels", self.base)

    @cached_property
    def scope(self) -> DataFrame:
        if self.vintage_windows is None:
            return daycounts.scope_days(self.day_counts, self.unit)
        return self.day_counts.where("n_left = n_right").join(self.day_labels, "day").select("day", "vintage")

    def windows(self, side: str) -> DataFrame:
        mine = self.day_counts.where(F.col(f"n_{side}") > 0)
        return dates.windows(daycounts.bounds(mine), self.unit)

    def vintages(self) -> DataFrame:
        """Vintages of either side: which sides have it, its window, the number of days set aside.

        Rows without a date are a vintage of their own, ``null_date``, which no later stage compares.
        """
        none = F.lit(None).cast("date")
        if not self.dated:
            return self.day_counts.select(
                F.lit(ALL).alias("vintage"), F.lit("both").alias("sides"), none.alias("start_date"), none.alias("end_date"),
                F.lit(0).cast("bigint").alias("excluded_days"))
        undated = self.day_counts.where("day IS NULL").select(
            F.lit(daycounts.NULL_DATE).alias("vintage"), F.lit("undated").alias("sides"), none.alias("start_date"),
            none.alias("end_date"), F.lit(0).cast("bigint").alias("excluded_days"))
        if self.vintage_windows is not None:
            sides = F.when(F.col("day_rows_left") == 0, "right_only").when(F.col("day_rows_right") == 0, "left_only").otherwise("both")
            counted = intervals.window_counts(self.day_counts, self.day_labels, self.vintage_windows)
            return counted.select("vintage", sides.alias("sides"), "start_date", "end_date", "excluded_days").unionByName(undated)
        return daycounts.all_windows(self.windows(LEFT), self.windows(RIGHT), self.day_counts, self.unit).unionByName(undated)

    def vintage_rows(self) -> DataFrame:
        """``(vintage, day_rows_left, day_rows_right)``: all rows of a vintage, compared or not, from the day counts."""
        counts = self.day_counts
        if self.vintage_windows is not None:
            undated = counts.where("day IS NULL").withColumn("label", F.lit(daycounts.NULL_DATE))
            counts, label = counts.join(self.day_labels.withColumnRenamed("vintage", "label"), "day").unionByName(undated), F.col("label")
        else:
            label = F.coalesce(dates.vintage_label(F.col("day"), self.unit), F.lit(daycounts.NULL_DATE)) if self.dated else F.lit(ALL)
        return counts.groupBy(label.alias("vintage")).agg(
            F.sum("n_left").alias("day_rows_left"), F.sum("n_right").alias("day_rows_right"))

    def day_summary(self) -> DataFrame:
        if self.dated:
            return daycounts.match_summary(self.day_counts)
        whole = self.day_counts.withColumn("day", F.lit("1970-01-01").cast("date"))
        return daycounts.match_summary(whole)

    def meta(self) -> DataFrame:
        """One row per vintage with the day and column summary of the table."""
        summary = self.day_summary().select(F.struct("total_days", "matched_days", "all_match")).scalar()
        return self.vintages().join(self.vintage_rows(), "vintage", "left").withColumn("s", summary).select(
            F.lit(self.name).alias("table_name"), "vintage", "sides", "start_date", "end_date", "excluded_days",
            "day_rows_left", "day_rows_right",
            "s.total_days", "s.matched_days", "s.all_match",
            F.lit(len(self.columns)).cast("bigint").alias("comparable_columns"))

    # ------------------------------------------------------------ column check

    def stats(self) -> DataFrame:
        """Profiles of both sides, one row per ``(side, vintage, column)``."""
        by = ["side", "vintage"]

        def side(name: str) -> profile.LongForm:
            df = self.scoped(name).withColumn("side", F.lit(name))
            return profile.long_form(df, self._profiled, name, by, self.normalised_profile)

        return profile.profile_long(side(LEFT).union(side(RIGHT)), by)

    @cached_property
    def value_gate(self) -> DataFrame:
        """``(vintage, column, is_equal)`` by value fingerprints; kept, it has one row per vintage and column."""
        found = gate.gate(self.scoped(LEFT), self.scoped(RIGHT), self.columns, ["vintage"], self.normalised_profile)
        return stored(found, f"{self.name}-gate", self.base)

    @cached_property
    def _profiled(self) -> list[ColumnPair]:
        """Columns that are profiled; names are read, one per column."""
        if not self.gated:
            return self.columns
        differing = {r["column"] for r in self.value_gate.where("NOT is_equal").select("column").distinct().collect()}
        return [p for p in self.columns if p.name in differing]

    def _unprofiled(self) -> DataFrame:
        """The gate's rows of columns that all vintages agree on."""
        return self.value_gate.where(~F.col("column").isin([p.name for p in self._profiled]))

    @cached_property
    def compared(self) -> DataFrame:
        """Statistics side by side with a flag each; kept, as the later stages read it."""
        flagged = quality.stat_flags(quality.side_by_side(self.stats(), ["vintage"]), self.rules)
        return stored(flagged, f"{self.name}-statistics", self.base)

    def verdicts(self) -> DataFrame:
        if len(self._profiled) == len(self.columns):
            return quality.column_verdicts(self.compared)
        agreed = [p for p in self.columns if p not in self._profiled]
        sizes = gate.estimated_distinct(self.scoped(LEFT), agreed, LEFT, ["vintage"])
        equal = self._unprofiled().groupBy("column").agg(F.count(F.lit(1)).alias("vintages")).join(sizes, "column").select(
            "column", "vintages", F.lit(0).cast("bigint").alias("vintages_mismatched"), F.lit(False).alias("is_mismatched"), "max_distinct")
        return quality.column_verdicts(self.compared).unionByName(equal) if self._profiled else equal

    def column_check(self) -> DataFrame:
        """One row per column: verdict, cardinality and rank among the key columns; none without comparable columns."""
        if not self.columns:
            return local_rows(self.left.sparkSession, [], VERDICT_SCHEMA)
        verdicts = self.verdicts()
        ranks = quality.key_columns(verdicts, n=self.key_count).select("column", "key_rank")
        return verdicts.join(ranks, "column", "left").select(F.lit(self.name).alias("table_name"), "*")

    def match_rates(self) -> DataFrame:
        if len(self._profiled) == len(self.columns):
            return quality.match_rate(self.compared, ["vintage"])
        flags = self._unprofiled().select("vintage", "column", F.col("is_equal").alias("is_match"))
        if self._profiled:
            flags = flags.unionByName(self.compared.select("vintage", "column", "is_match"))
        return quality.match_rate(flags, ["vintage"])

    @cached_property
    def _chosen(self) -> tuple[list[ColumnPair], list[ColumnPair]]:
        """Columns to hash and key columns; one row per column is read."""
        by_name = {p.name: p for p in self.columns}
        if not self.columns:
            return [], []
        if self.hash_all and self.keys is not None:
            return self.columns, [by_name[k] for k in self.keys]
        rows = self.column_check().collect()
        clean = {r["column"] for r in rows if not r["is_mismatched"]}
        ranked = sorted((r["key_rank"], r["column"]) for r in rows if r["key_rank"] is not None)
        keys = self.keys if self.keys is not None else [c for _, c in ranked]
        hashed = self.columns if self.hash_all else [p for p in self.columns if p.name in clean]
        return hashed, [by_name[k] for k in keys]

    # ------------------------------------------------------------ hash check

    def hashes(self, side: str, scoped: bool = True) -> DataFrame:
        """Row hashes of a side; ``scoped=False`` also takes the days set aside."""
        hashed, keys = self._chosen
        df = self.scoped(side) if scoped else self.labelled(side)
        return rowhash.row_hashes(df, hashed, keys, side, ["vintage"])

    def labelled(self, side: str) -> DataFrame:
        """Every row with its vintage, equal counts or not."""
        if self.vintage_windows is not None:
            undated = self.rows(side).where(self.day(side).isNull()).withColumn("vintage", F.lit(daycounts.NULL_DATE))
            return filters.in_scope(self.rows(side), self.day(side), self.day_labels).unionByName(undated)
        label = dates.vintage_label(self.day(side), self.unit) if self.dated else F.lit(ALL)
        return self.rows(side).withColumn("vintage", F.coalesce(label, F.lit(daycounts.NULL_DATE)))

    def compared_rows(self, scoped: bool = True) -> DataFrame:
        keys = [k.name for k in self._chosen[1]]
        return rowhash.compare_keys(self.hashes(LEFT, scoped), self.hashes(RIGHT, scoped), keys, ["vintage"])

    def hash_check(self, scoped: bool = True) -> DataFrame:
        """Matched, differing and one-sided rows per vintage; without keys, rows are compared as multisets."""
        hashed, keys = self._chosen
        if not hashed:
            return self._nothing_to_hash(scoped)
        if not keys:
            return rowhash.multiset_counts(self.hashes(LEFT, scoped), self.hashes(RIGHT, scoped), ["vintage"])
        return rowhash.compare_counts(self.compared_rows(scoped), ["vintage"])

    def _left_made_from(self) -> dict:
        """What the kept hashes of the left side depend on; the right side counts with its types, which decide how values are written."""
        hashed, keys = self._chosen
        given = ("left_date", "partition", "start", "end", "left_where", "left_fmt")
        windows = None if self.vintage_windows is None else sorted(self.vintage_windows.toJSON().collect())
        return {"files": files_of(self.left), "plan": self.left.semanticHash(), "schemas": [self.left.schema.simpleString(), self.right.schema.simpleString()],
                "columns": [str(hashed), str(keys)], "windows": windows, **{name: getattr(self, name) for name in given}}

    def keep_left(self, path: str, buckets: int = kept_hashes.BUCKETS) -> kept_hashes.KeptHashes:
        """The row hashes of the left side below ``path``, bucketed by key; taken as they are if nothing they were made from has changed."""
        spark, digest = self.left.sparkSession, kept_hashes.digest_of(self._left_made_from())
        if exists(spark, f"{path}/note/_SUCCESS"):
            kept = kept_hashes.opened(spark, path)
            if kept.digest == digest and kept.buckets >= buckets:
                return kept
        return kept_hashes.keep(self.hashes(LEFT, scoped=False), path, [k.name for k in self._chosen[1]], ["vintage"], buckets, digest=digest)

    def compared_to_kept(self, kept: kept_hashes.KeptHashes) -> DataFrame:
        """``compared_rows(scoped=False)`` with the left side from what is kept: only rows of the right one are exchanged."""
        return kept_hashes.compare(kept, self.hashes(RIGHT, scoped=False))

    def sides(self, scoped: bool = True) -> digest_tree.Sides:
        """Both tables as the search for differences sees them."""
        hashed, keys = self._chosen
        rows = lambda side: self.scoped(side) if scoped else self.labelled(side)
        return digest_tree.Sides(rows(LEFT), rows(RIGHT), hashed, keys, ["vintage"], self.base)

    def differences(self, scoped: bool = True, **options) -> DataFrame:
        """Keys whose rows differ, with the columns that changed; rows of ranges with equal digests are not exchanged."""
        return digest_tree.differences(self.sides(scoped), **options)

    def changed_columns(self, scoped: bool = True) -> DataFrame:
        """``(vintage, column, n)``: in how many keys a column differs."""
        return digest_tree.changed_counts(self.differences(scoped), ["vintage"])

    def changed_samples(self, n: int = rowhash.SAMPLE_ROWS, scoped: bool = True) -> DataFrame:
        """The first ``n`` differing keys of each vintage, in key order, with hashes and changed columns."""
        keys = [k.name for k in self._chosen[1]]
        order = Window.partitionBy("vintage").orderBy(*keys)
        found = self.differences(scoped).where("changed IS NOT NULL").withColumn("rn", F.row_number().over(order))
        return found.where(F.col("rn") <= n).select("vintage", *keys, "left_hash", "right_hash", "changed")

    def _nothing_to_hash(self, scoped: bool) -> DataFrame:
        """Vintages without a column to hash; under ``scoped`` those that have days to compare, as where columns are hashed."""
        zero = lambda t="bigint": F.lit(0).cast(t)
        found = self.vintages()
        if scoped and self.dated:
            found = found.join(self.scope.select("vintage").distinct(), "vintage", "left_semi")
        return found.select(
            "vintage", zero().alias("left_rows"), zero().alias("right_rows"),
            zero("decimal(38,0)").alias("matched"), zero().alias("left_only"), zero().alias("right_only"),
            zero("decimal(38,0)").alias("hash_mismatch"))

    def fingerprints(self, by_vintage: bool = False, scoped: bool = True) -> DataFrame:
        by = ["vintage"] if by_vintage else []
        df = lambda side: self.scoped(side) if scoped else self.labelled(side)
        prints = lambda side: rowhash.fingerprints(df(side), self.columns, side, by)
        return rowhash.compare_fingerprints(prints(LEFT), prints(RIGHT), by)

    def column_fingerprints(self, scoped: bool = True) -> DataFrame:
        df = lambda side: self.scoped(side) if scoped else self.labelled(side)
        day = lambda side: self.day(side) if self.dated else None
        prints = lambda side: rowhash.column_fingerprints(df(side), self.columns, side, day(side), [])
        return rowhash.compare_fingerprints(prints(LEFT), prints(RIGHT), ["column"])

    # ------------------------------------------------------------ all of it

    def reconcile(self) -> DataFrame:
        """Meta, column and hash check in a row: one line per vintage with a status.

        MATCH means that rows were compared and agree. Vintages on one side, rows without a date, tables without a
        comparable column and vintages of which nothing was hashed have a status of their own, with the rows the
        day counts know of.
        """
        none = F.lit(0).cast("bigint")
        hashed = self.hash_check()
        counts = [c for c in hashed.columns if c != "vintage"]
        joined = self.vintages().join(self.vintage_rows(), "vintage", "left").join(hashed, "vintage", "left")
        summary = ["total_columns", "matched_columns", "mismatched_columns"]
        if self.columns:
            joined = joined.join(self.match_rates(), "vintage", "left")
        else:
            joined = joined.withColumns({c: none for c in summary})
        out = joined.withColumns({c: F.coalesce(F.col(c).cast("bigint"), none)
                                  for c in [*counts, *summary, "day_rows_left", "day_rows_right"]})
        one_sided = F.col("left_only") + F.col("right_only")
        status = (
            F.when(F.col("sides") == "undated", NULL_DATES)
            .when((F.col("day_rows_left") > 0) & (F.col("day_rows_right") == 0), LEFT_ONLY)
            .when((F.col("day_rows_right") > 0) & (F.col("day_rows_left") == 0), RIGHT_ONLY)
            .when(F.lit(not self.columns), NO_COLUMNS)
            .when((F.col("hash_mismatch") > 0) | (one_sided > 0), ROWS_DIFFER)
            .when(F.col("mismatched_columns") > 0, COLUMNS_DIFFER)
            .when(F.col("excluded_days") > 0, DAYS_DIFFER)
            .when((F.col("left_rows") == 0) & (F.col("day_rows_left") + F.col("day_rows_right") > 0), NOT_HASHED)
            .otherwise(MATCH)
        )
        return out.select(
            F.lit(self.name).alias("table_name"), "vintage", "start_date", "end_date", "excluded_days",
            "day_rows_left", "day_rows_right", *summary, *counts, status.alias("status"))

    def sections(self) -> dict[str, DataFrame]:
        """The results of the checks by section of the report."""
        return {
            "day_summary": self.day_summary(),
            "day_mismatches": self.day_counts.where("n_left <> n_right"),
            "vintages": self.vintages(),
            "columns": self.typed_columns().drop("col_map"),
            "column_check": self.column_check().drop("table_name"),
            "match_rates": self.match_rates(),
            "hash_check": self.hash_check(),
        }

    def report(self) -> DataFrame:
        """The checks as typed sections of one table."""
        return reports.sections(self.name, self.sections())

