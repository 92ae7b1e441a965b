"""The most frequent values of every column, exact, without exchanging all frequencies.

Three steps, each over what the one before leaves open:

1. A mergeable summary of frequent items per group and column names candidates, and a count per bucket of value hashes
   bounds every other value: it occurs at most as often as its bucket has rows that are no candidate's.
2. The candidates are counted exactly. The count of the ``top``-th is the floor; buckets whose bound is below it hold no
   value of the result, which is the proof, and they are done with.
3. Values of the other buckets (all of them, where a column is unique) are counted by a 64-bit hash and the first ``PREFIX`` bytes,
   so no text is exchanged. The first ``top`` of these by count and prefix, with all that tie, hold the result; their
   texts are counted exactly. Where two texts share a hash, wider hashes are taken.

Values rank by frequency, then in byte order, NULL last. Values that agree in their first ``PREFIX`` bytes and in their
count tie in step 3, and as texts they are then all exchanged; that costs work, the result is the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from ..sources.results import stored
from .profile import TOP_VALUES, rank_frequencies

BUCKETS, TRACKED, PREFIX = 4096, 1024, 16
#: Value hashes from narrow to wide; the first without a clash among the values looked at is used.
DIGESTS = (lambda v: F.xxhash64(v), lambda v: F.unhex(F.md5(v.cast("binary"))), lambda v: F.unhex(F.sha2(v, 256)))


def _bucket() -> Column:
    return F.pmod(F.xxhash64("v_text"), F.lit(BUCKETS)).cast("int").alias("bucket")


def _matching(rows: DataFrame, other: DataFrame, on: list[str], how: str) -> DataFrame:
    """``rows`` that agree (NULL with NULL) with a row of ``other`` in the columns ``on``, or those that do not."""
    names = [f"__{c}" for c in on]
    renamed = other.select(*[F.col(c).alias(n) for c, n in zip(on, names)])
    same = [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(on, names)]
    return rows.join(renamed, same, how)


def candidates(values: DataFrame, by: list[str], top: int = TOP_VALUES) -> DataFrame:
    """``(by..., column, v_text, n)``: values that the summary names, at most ``2 * top`` a group, counted exactly."""
    group = [*by, "column"]
    named = values.groupBy(*group).agg(F.expr(f"approx_top_k(v_text, {2 * top}, {max(TRACKED, 2 * top)})").alias("items"))
    named = stored(named.select(*group, F.explode("items.item").alias("v_text")), "top-named")
    return _matching(values, named, [*group, "v_text"], "left_semi").groupBy(*group, "v_text").agg(F.count(F.lit(1)).alias("n"))


def open_buckets(values: DataFrame, counted: DataFrame, by: list[str], top: int = TOP_VALUES) -> DataFrame:
    """``(by..., column, bucket)`` that may hold a value of the result besides the candidates ``counted``."""
    group = [*by, "column"]
    none = F.lit(0).cast("bigint")
    whole = values.groupBy(*group, _bucket()).agg(F.count(F.lit(1)).alias("n")).select(*group, "bucket", "n", none.alias("known"))
    known = counted.select(*group, _bucket(), none.alias("n"), F.col("n").alias("known"))
    rest = whole.unionByName(known).groupBy(*group, "bucket").agg((F.sum("n") - F.sum("known")).alias("rest"))
    ranked = rank_frequencies(counted, by, top).where(F.col("rn") == top)
    floors = ranked.select(*[F.col(c).alias(f"__{c}") for c in group], F.col("n").alias("floor"))
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in group]
    return rest.where("rest > 0").join(floors, same, "left").where(F.col("rest") >= F.coalesce("floor", none)).select(*group, "bucket")


def _recounted(rows: DataFrame, by: list[str], top: int) -> DataFrame:
    """The head of ``rows(by..., column, v_text)``, found by hashes; whatever ties with it may follow."""
    group = [*by, "column"]
    order = Window.partitionBy(*group).orderBy(F.col("n").desc(), F.col("prefix"))
    for digest in DIGESTS:
        told = rows.select(*group, digest(F.col("v_text")).alias("digest"), F.substring(F.col("v_text").cast("binary"), 1, PREFIX).alias("prefix"))
        counts = told.groupBy(*group, "digest", "prefix").agg(F.count(F.lit(1)).alias("n"))
        head = counts.withColumn("place", F.rank().over(order)).where(F.col("place") <= top)
        head = stored(head.select(*group, "digest"), "top-head")
        texts = _matching(rows.withColumn("digest", digest(F.col("v_text"))), head, [*group, "digest"], "left_semi")
        found = stored(texts.groupBy(*group, "digest", "v_text").agg(F.count(F.lit(1)).alias("n")), "top-found")
        if found.groupBy(*group, "digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
            return found.select(*group, "v_text", "n")
    raise ValueError("two values share a SHA-256 digest")


def top_values(values: DataFrame, by: list[str], top: int = TOP_VALUES) -> DataFrame:
    """``(by..., column, v_text, n, rn)``: the ``top`` most frequent values of each group and column of ``values(by..., column, v_text)``."""
    group = [*by, "column"]
    given, missing = values.where("v_text IS NOT NULL"), values.where("v_text IS NULL")
    counted = stored(candidates(given, by, top), "top-counted")
    left_open = stored(open_buckets(given, counted, by, top), "top-open")
    nulls = missing.groupBy(*group, "v_text").agg(F.count(F.lit(1)).alias("n"))
    found = counted.unionByName(nulls)
    if not left_open.isEmpty():
        rows = _matching(given.select(*group, "v_text", _bucket()), left_open, [*group, "bucket"], "left_semi")
        rows = _matching(rows, counted, [*group, "v_text"], "left_anti")
        found = found.unionByName(_recounted(rows.drop("bucket"), by, top))
    return rank_frequencies(found, by, top)
