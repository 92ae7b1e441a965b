"""Row hashes of a table that are kept, bucketed by key, and compared again and again without being exchanged.

``keep`` writes one row per key: its id (a digest of group and key), and the hashes of its rows with their numbers, bucketed and
sorted by id. A comparison exchanges the other side once and meets the kept rows by a merge join on the id, in which the kept
side is read as it lies. Keys with more than ``MANY`` different hashes, on either side, are no single rows: they are kept apart, and
compared by :func:`rowhash.compare_keys`, which splits a key by its hashes first.

Both folders are plain Parquet on shared storage; a later session finds the buckets by registering them as a table.
"""

from __future__ import annotations

import hashlib
import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources.results import dropped, remove, shuffles_removed, stored
from . import rowhash

BUCKETS, MANY = 1024, 1000
#: So many rows are enough for a bucket; so many bins at least tell whether any key can be hot.
ROWS_A_BUCKET, BINS = 250_000, 1 << 16
ID, HASHES = "__id", "__hashes"
NOTE_SCHEMA = "buckets int, keys array<string>, by array<string>, digest string"


@dataclass(frozen=True)
class KeptHashes:
    """A kept side below ``path``: ``cold`` in buckets, ``hot`` (rows of keys with very many hashes) as they come."""

    spark: SparkSession
    path: str
    buckets: int
    keys: list[str]
    by: list[str]
    digest: str | None = None

    @property
    def table(self) -> str:
        return f"kept_{hashlib.sha256(self.path.encode()).hexdigest()[:24]}"

    def cold(self) -> DataFrame:
        """``(__id, by..., key..., __hashes)`` through the catalog, which tells Spark of the buckets."""
        return self.spark.table(self.table)

    def hot(self) -> DataFrame:
        """``(__id, by..., key..., hash_bin, n)``"""
        return self.spark.read.parquet(f"{self.path}/hot")


def _id(columns: list[str]) -> Column:
    return F.unhex(F.sha2(F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in columns])), 256))


def _counted(hashes: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """``(__id, by..., key..., hash_bin, n)``; equal rows of a hot key are one row per task before they move."""
    rows = hashes.select(*by, *keys, F.unhex("hash_value").alias("hash_bin"))
    counted = rows.groupBy(*by, *keys, "hash_bin").agg(F.count(F.lit(1)).alias("n"))
    return stored(counted.select(_id([*by, *keys]).alias(ID), *by, *keys, "hash_bin", "n"), "hashes-counted")


def _hot_ids(counted: DataFrame, many: int, rows: int) -> DataFrame:
    """Ids with more than ``many`` hashes. Rows are counted in bins of ids first; only ids of bins that hold so many are exchanged."""
    bins = max(BINS, 8 * math.ceil(rows / many))
    bin_of = F.pmod(F.xxhash64(ID), F.lit(bins))
    full = stored(counted.groupBy(bin_of.alias("bin")).agg(F.count(F.lit(1)).alias("hashes")).where(F.col("hashes") > many).select("bin"), "full-bins")
    if full.isEmpty():
        return counted.select(ID).where("false")
    ids = counted.join(full, bin_of == F.col("bin"), "left_semi").groupBy(ID).agg(F.count(F.lit(1)).alias("hashes")).where(F.col("hashes") > many)
    return stored(ids.select(ID), "hot-keys")


def _per_key(counted: DataFrame, keys: list[str], by: list[str], buckets: int) -> DataFrame:
    """One row per key; its hashes in order, at most as many as a hot key begins with. Rows move once, to the bucket of their id."""
    packed = F.array_sort(F.collect_list(F.struct("hash_bin", "n")))
    return counted.repartition(buckets, ID).groupBy(ID).agg(*[F.first(c).alias(c) for c in [*by, *keys]], packed.alias(HASHES))


def _unpacked(cold: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    return cold.select(ID, *by, *keys, F.inline(HASHES))


def keep(hashes: DataFrame, path: str, keys: list[str], by: list[str], buckets: int = BUCKETS, many: int = MANY,
         digest: str | None = None) -> KeptHashes:
    """Write ``hashes(by..., key..., hash_value)`` below ``path``, in place of what is there; ``digest`` says what they were made from.

    There are at least as many buckets as shuffle partitions: Spark would deal fewer out again for the sake of parallelism. Large tables
    get more, so that a task's share does not grow with the rows.
    The note goes first and is written last, so an interrupted run leaves nothing that looks whole.
    """
    if not keys:
        raise ValueError("no key columns: there is nothing to bucket by")
    spark = hashes.sparkSession
    remove(spark, f"{path.rstrip('/')}/note")
    counted = _counted(hashes, keys, by)
    rows = counted.count()
    buckets = max(buckets, int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / ROWS_A_BUCKET))
    kept = KeptHashes(spark, path.rstrip("/"), buckets, keys, by, digest)
    hot = _hot_ids(counted, many, rows)
    counted.join(hot, ID, "left_semi").write.mode("overwrite").parquet(f"{kept.path}/hot")
    spark.sql(f"DROP TABLE IF EXISTS {kept.table}")
    cold = _per_key(counted.join(hot, ID, "left_anti"), keys, by, kept.buckets).write.mode("overwrite") \
        .bucketBy(kept.buckets, ID).sortBy(ID).option("path", f"{kept.path}/cold")
    with shuffles_removed(spark):
        cold.saveAsTable(kept.table)
    dropped(counted)
    note = [(kept.buckets, keys, by, digest)]
    spark.createDataFrame(note, NOTE_SCHEMA).coalesce(1).write.mode("overwrite").json(f"{kept.path}/note")
    return kept


def opened(spark: SparkSession, path: str) -> KeptHashes:
    """What :func:`keep` wrote, in this session or another one."""
    path = path.rstrip("/")
    note = spark.read.schema(NOTE_SCHEMA).json(f"{path}/note").first()
    kept = KeptHashes(spark, path, note["buckets"], note["keys"], note["by"], note["digest"])
    schema = spark.read.parquet(f"{path}/cold").schema
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"DROP TABLE IF EXISTS {kept.table}")
    spark.sql(f"CREATE TABLE {kept.table} ({columns}) USING parquet CLUSTERED BY ({ID}) SORTED BY ({ID}) INTO {kept.buckets} BUCKETS LOCATION '{path}/cold'")
    return kept


def _met(cold: DataFrame, right: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """Rows as :func:`rowhash.compare_keys` gives them, from one row per key and side."""
    named = lambda df, s: df.select(F.col(ID).alias(f"{ID}_{s}"), *[F.col(c).alias(f"{c}_{s}") for c in [*by, *keys]], F.col(HASHES).alias(s))
    both = named(cold, "l").join(named(right, "r"), F.col(f"{ID}_l") == F.col(f"{ID}_r"), "full_outer")
    wide = lambda c: c.cast("decimal(19,0)")
    rows = lambda side: F.coalesce(F.aggregate(side, F.lit(0).cast("bigint"), lambda total, x: total + x["n"]), F.lit(0).cast("bigint"))
    nothing = F.lit(0).cast("decimal(38,0)")
    same = lambda x: F.aggregate("r", nothing, lambda total, y: F.when(
        y["hash_bin"] == x["hash_bin"], (total + wide(x["n"]) * wide(y["n"])).cast("decimal(38,0)")).otherwise(total))
    matched = F.when(F.col("l").isNull() | F.col("r").isNull(), nothing).otherwise(
        F.aggregate("l", nothing, lambda total, x: (total + same(x)).cast("decimal(38,0)")))
    out = both.select(*[F.coalesce(f"{c}_l", f"{c}_r").alias(c) for c in [*by, *keys]], rows(F.col("l")).alias("n_left"), rows(F.col("r")).alias("n_right"),
                      matched.alias("matched"), *[pick(side)["hash_bin"].alias(f"{side}_{name}") for side in "lr"
                                                  for name, pick in (("low", F.array_min), ("high", F.array_max))])
    mismatch = (wide(F.col("n_left")) * wide(F.col("n_right")) - F.col("matched")).cast("decimal(38,0)")
    return rowhash.told(out.withColumnsRenamed({"l_low": "left_low", "l_high": "left_high", "r_low": "right_low", "r_high": "right_high"}), mismatch, [*by, *keys])


def compare(kept: KeptHashes, hashes: DataFrame, many: int = MANY) -> DataFrame:
    """The kept side as left against the right ``hashes(by..., key..., hash_value)``: one row per key, as ``rowhash.compare_keys``."""
    keys, by = kept.keys, kept.by
    right, cold, hot = _counted(hashes, keys, by), kept.cold(), kept.hot()
    hot_right = _hot_ids(right, many, right.count())
    all_hot = stored(hot_right.unionByName(hot.select(ID)).distinct(), "hot-keys")
    met = _met(cold.join(hot_right, ID, "left_anti"), _per_key(right.join(all_hot, ID, "left_anti"), keys, by, kept.buckets), keys, by)
    if all_hot.isEmpty():
        return met
    left_rows = hot.unionByName(_unpacked(cold.join(hot_right, ID, "left_semi"), keys, by))
    right_rows = right.join(all_hot, ID, "left_semi")
    return met.unionByName(rowhash.compare_counted(left_rows, right_rows, keys, by))


def digest_of(made_from: dict) -> str:
    return hashlib.sha256(json.dumps(made_from, sort_keys=True, default=str).encode()).hexdigest()
