"""What keeps the work of a task bounded when tables grow."""

from pyspark.sql import functions as F

from paritas.functions import normalize
from paritas.operators import digest_tree
from paritas.sources import scan
from paritas.sources.results import SHUFFLE_CLEANUP, stored
from paritas.workload import q_scalars


def test_rows_of_one_split_are_dealt_over_the_cores(spark, tmp_path):
    spark.range(0, 250_000, 1, 1).write.parquet(str(tmp_path / "large"))
    spark.range(0, 1_000, 1, 1).write.parquet(str(tmp_path / "small"))
    dealt, left = (scan.spread(spark.read.parquet(str(tmp_path / name))) for name in ("large", "small"))
    splits = lambda df: df.groupBy(F.spark_partition_id()).count().count()
    cores = spark.sparkContext.defaultParallelism
    assert splits(dealt) == min(cores, 3) and splits(left) == 1
    assert dealt.distinct().count() == 250_000 == dealt.count()


def test_a_bounded_join_has_more_parts_for_more_rows(spark, monkeypatch):
    monkeypatch.setattr(q_scalars, "JOINED_ROWS", 20)
    keys = spark.range(2_000)
    joined = q_scalars._joined(keys.withColumn("l", F.col("id") * 2), keys.withColumn("r", F.col("id") * 3), "id", True)
    rows = joined.withColumn("part", F.spark_partition_id()).collect()
    assert {(r.id, r.l, r.r) for r in rows} == {(i, 2 * i, 3 * i) for i in range(2_000)} and len(rows) == 2_000
    assert len({r.part for r in rows}) > 90


def test_parts_of_nested_values_are_normalised_once(spark):
    df = spark.sql("SELECT array(' a ', 'n/a', NULL, 'x\ty  z') AS a, map('k', ' v ', 'J', NULL) AS m")
    for name, steps, text in (("a", 1, "[1:A,~,~,4:XY Z]"), ("m", 2, "{1:J=~,1:K=1:V}")):
        found = df.select(normalize.norm_nested(F.col(name), df.schema[name].dataType).alias("t"))
        assert found.first().t == text
        assert found._jdf.queryExecution().analyzed().toString().count("upper(") == steps


def test_differing_rows_are_aggregated_without_sorting(spark):
    side = lambda shift: spark.range(50).select(
        F.lit("v").alias("vintage"), F.col("id").alias("k"), F.upper(F.sha2((F.col("id") + F.when(F.col("id") == 7, shift).otherwise(0)).cast("string"), 256)).alias("hash_value"),
        F.array(F.xxhash64("id"), F.xxhash64(F.col("id") + F.when(F.col("id") == 7, shift).otherwise(0))).alias("cells"))
    left, right = side(0), side(100)
    found = digest_tree.surplus(left, right, ["k"], ["a", "b"], ["vintage"])
    row, = found.collect()
    assert (row.k, row.n_left, row.n_right, row.changed) == (7, 1, 1, ["b"])
    assert [row.left_hash, row.right_hash] == [df.where("k = 7").first().hash_value for df in (left, right)]
    assert "first(cells" not in found._jdf.queryExecution().analyzed().toString()


def test_what_is_exchanged_for_a_stored_table_goes_with_the_write(spark, tmp_path):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffle_files():
        files = disk.getAllFiles()
        return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}

    before = shuffle_files()
    rows = spark.range(100_000).groupBy((F.col("id") % 1000).alias("k")).agg(F.sum("id").alias("total"))
    found = stored(rows, "rows", str(tmp_path))
    assert not shuffle_files() - before
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false" and found.count() == rows.count() == 1000
