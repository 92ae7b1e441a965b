"""Where two tables differ, found by digests over nested ranges of key hashes.

A row's place is a 32-bit hash of its group and key, so both sides put a key in the same range. One pass digests all
rows into 2**bits ranges: sums of digest limbs, which merge in any order, so a task hands on at most one row for each
range. Ranges whose digests agree hold the same rows and are left. The next pass looks at the rows of the other ranges only and
cuts each into 2**STEP parts, and so on; what remains is compared row by row, and that alone exchanges rows.

How many passes are made changes the work, never the result: a pass more where the remaining rows are many and the last
one left most rows behind, none where nearly every range differs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import hashing
from ..sources.results import stored
from .columns import LEFT, RIGHT, ColumnPair
from .rowhash import key_bucket, row_hashes

PLACE_BITS, STEP = 32, 12
#: So many rows a side are compared without another pass.
FEW_ROWS = 1_000_000
#: Another pass pays when the last one left no more than this share of the rows it read.
WORTH = 0.5
PLACE = "__place"


@dataclass(frozen=True)
class Sides:
    """Both tables as the comparison sees them: labelled rows, column pairs to compare, keys, and group columns."""

    left: DataFrame
    right: DataFrame
    pairs: list[ColumnPair]
    keys: list[ColumnPair]
    by: list[str]
    base: str | None = None

    def __post_init__(self) -> None:
        if not self.keys:
            raise ValueError("no key columns: rows without a key have no place")

    def rows(self, side: str) -> DataFrame:
        """A side with the place of each row; nothing but group and key columns is looked at for it."""
        df = self.left if side == LEFT else self.right
        return df.withColumn(PLACE, key_bucket([*[F.col(b) for b in self.by], *[k.key(df, side) for k in self.keys]]))

    def within(self, side: str, ranges: DataFrame | None, bits: int) -> DataFrame:
        """Rows of some ranges. Spark broadcasts the ranges if they are small, by their size."""
        rows = self.rows(side)
        return rows if ranges is None else rows.join(ranges.select("range"), _range(bits) == F.col("range"), "left_semi")

    def digests(self, side: str, bits: int, ranges: DataFrame | None = None, range_bits: int = 0) -> DataFrame:
        """``(range, n, limb_0..limb_5)`` over 2**bits ranges; with ``ranges`` only over the parts of those."""
        rows = self.within(side, ranges, range_bits)
        told = [*[F.col(b) for b in self.by], *[k.key(rows, side) for k in self.keys], *[p.normal(rows, side) for p in self.pairs]]
        digested = rows.select(_range(bits).alias("range"), hashing.row_md5(told).alias("digest"))
        return digested.groupBy("range").agg(F.count(F.lit(1)).alias("n"), *hashing.fingerprint_sums(F.col("digest")))


def _range(bits: int) -> Column:
    return F.shiftright(PLACE, PLACE_BITS - bits)


def differing_ranges(left: DataFrame, right: DataFrame) -> DataFrame:
    """``(range, n_left, n_right)`` of the ranges whose digests differ."""
    limbs = [f"limb_{i}" for i in range(6)]
    zero = F.lit(0).cast("bigint")

    def signed(df: DataFrame, sign: int) -> DataFrame:
        counts = ("n", zero) if sign > 0 else (zero, "n")
        one = lambda c: F.col(c) if isinstance(c, str) else c
        return df.select("range", one(counts[0]).alias("n_left"), one(counts[1]).alias("n_right"), *[(F.col(c) * sign).alias(c) for c in limbs])

    both = signed(left, 1).unionByName(signed(right, -1)).groupBy("range").agg(*[F.sum(c).alias(c) for c in ["n_left", "n_right", *limbs]])
    differs = F.col("n_left") != F.col("n_right")
    for c in limbs:
        differs = differs | (F.col(c) != 0)
    return both.where(differs).select("range", "n_left", "n_right")


def rolled_up(digests: DataFrame, bits: int, to_bits: int) -> DataFrame:
    """Digests of coarser ranges, without another look at the rows."""
    wider = F.shiftright("range", bits - to_bits).alias("range")
    return digests.groupBy(wider).agg(*[F.sum(c).alias(c) for c in digests.columns if c != "range"])


def descend(sides: Sides, step: int = STEP, few: int = FEW_ROWS, worth: float = WORTH) -> tuple[DataFrame, int]:
    """The ranges left to compare row by row, and their bits. The driver reads two row counts a pass."""
    ranges, bits, before = None, 0, None
    while bits + step <= PLACE_BITS:
        both = [sides.digests(side, bits + step, ranges, bits) for side in (LEFT, RIGHT)]
        if before is None:
            both = [stored(d, "digests", sides.base) for d in both]
            before = max(d.agg(F.sum("n")).first()[0] or 0 for d in both)
        ranges, bits = stored(differing_ranges(*both), "differing-ranges", sides.base), bits + step
        most = max(x or 0 for x in ranges.agg(F.sum("n_left"), F.sum("n_right")).first())
        if most <= few or most > worth * before:
            break
        before = most
    return ranges, bits


def surplus(left: DataFrame, right: DataFrame, names: list[str], columns: list[str], by: list[str]) -> DataFrame:
    """Keys whose rows differ, from ``(by..., key..., hash_value, cells)`` of both sides.

    ``n_left`` / ``n_right`` count a key's rows without an equal on the other side, ``left_hash`` / ``right_hash`` show one of
    them, and ``changed`` names the columns whose values differ between the surplus rows; it is NULL for keys that have
    some on one side only. Hot keys are split by their hashes first, and equal rows are gone before the second exchange.
    """
    one, none, group = F.lit(1).cast("bigint"), F.lit(0).cast("bigint"), [*by, *names]

    cells = [f"__cell_{i}" for i in range(len(columns))]

    def tagged(df: DataFrame, l: Column, r: Column) -> DataFrame:
        # hashes travel as 32 bytes and cells as numbers of their own, which are aggregated without sorting
        return df.select(*group, F.unhex("hash_value").alias("hash_bin"), *[F.col("cells")[i].alias(c) for i, c in enumerate(cells)], l.alias("l"), r.alias("r"))

    both = tagged(left, one, none).unionByName(tagged(right, none, one))
    rows = both.groupBy(*group, "hash_bin").agg((F.sum("l") - F.sum("r")).alias("more"), *[F.min(c).alias(c) for c in cells]).where("more <> 0")
    more = F.col("more")
    wide = lambda c: c.cast("decimal(19,0)")
    # equal cells of the surplus rows cancel; a sum is zero by chance once in 2**64 differing cells
    sums = F.array(*[F.sum(wide(F.col(c)) * wide(more)) for c in cells])
    per_key = rows.groupBy(*group).agg(
        F.sum(F.greatest(more, F.lit(0))).alias("n_left"), F.sum(F.greatest(-more, F.lit(0))).alias("n_right"),
        F.hex(F.min(F.when(more > 0, F.col("hash_bin")))).alias("left_hash"), F.hex(F.min(F.when(more < 0, F.col("hash_bin")))).alias("right_hash"),
        sums.alias("sums"))
    named = F.arrays_zip(F.array(*[F.lit(c) for c in columns]).alias("column"), F.col("sums").alias("sum"))
    changed = F.transform(F.filter(named, lambda x: x["sum"] != 0), lambda x: x["column"])
    both_sides = (F.col("n_left") > 0) & (F.col("n_right") > 0)
    return per_key.select(*group, "n_left", "n_right", "left_hash", "right_hash", F.when(both_sides, changed).alias("changed"))


def differing_keys(sides: Sides, ranges: DataFrame, bits: int) -> DataFrame:
    """Every key of ``ranges`` whose rows differ, with the columns that changed."""
    def hashed(side: str) -> DataFrame:
        rows = sides.within(side, ranges, bits)
        cells = F.array(*[F.xxhash64(F.coalesce(p.normal(rows, side), F.lit(hashing.NULL_SENTINEL))) for p in sides.pairs])
        return row_hashes(rows, sides.pairs, sides.keys, side, sides.by, cells.alias("cells"))

    return surplus(hashed(LEFT), hashed(RIGHT), [k.name for k in sides.keys], [p.name for p in sides.pairs], sides.by)


def differences(sides: Sides, **options) -> DataFrame:
    """All differing keys of two tables."""
    return differing_keys(sides, *descend(sides, **options))


def changed_counts(found: DataFrame, by: list[str]) -> DataFrame:
    """``(by..., column, n)``: keys in which a column differs."""
    return found.select(*by, F.explode("changed").alias("column")).groupBy(*by, "column").agg(F.count(F.lit(1)).alias("n"))

