"""Kept row hashes: the comparison of compare_keys, without an exchange of what is kept."""

import random
import re

import pytest
from pyspark.sql import functions as F

from paritas.operators import kept_hashes, rowhash
from paritas.plans import ReconPair

SCHEMA = "vintage string, k long, t timestamp, hash_value string"


def sides(spark, n=600):
    """Duplicated, null and hot keys on either side; lost, added and changed rows."""
    random.seed(9)

    def row(i, mark):
        key = random.choice([i, i % 11, None, 5 if mark == "l" else 6])
        return random.choice("xy"), key, None, f"{random.choice([i % 4, i]):064X}"

    left = [row(i, "l") for i in range(n)]
    right = [r for r in left if random.random() > 0.1] + [row(i, "r") for i in range(n // 3)]
    frames = [spark.createDataFrame(rows, SCHEMA).repartition(3) for rows in (left, right)]
    return [df.withColumn("t", F.when(F.col("k") % 2 == 0, F.timestamp_micros(F.col("k")))) for df in frames]


def bag(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


@pytest.mark.parametrize("many", [1, 4, 1000])
def test_kept_hashes_compare_as_rows_do(spark, tmp_path, many):
    left, right = sides(spark)
    kept = kept_hashes.keep(left, str(tmp_path / "kept"), ["k", "t"], ["vintage"], buckets=4, many=many)
    want = bag(rowhash.compare_keys(left, right, ["k", "t"], ["vintage"]))
    assert bag(kept_hashes.compare(kept, right, many=many)) == want
    spark.sql(f"DROP TABLE {kept.table}")  # as a later session finds it
    again = kept_hashes.opened(spark, str(tmp_path / "kept"))
    assert again == kept and bag(kept_hashes.compare(again, right, many=many)) == want
    nothing = left.where("false")
    assert bag(kept_hashes.compare(again, nothing, many=many)) == bag(rowhash.compare_keys(left, nothing, ["k", "t"], ["vintage"]))
    empty = kept_hashes.keep(nothing, str(tmp_path / "empty"), ["k", "t"], ["vintage"], buckets=4)
    assert bag(kept_hashes.compare(empty, right)) == bag(rowhash.compare_keys(nothing, right, ["k", "t"], ["vintage"]))
    with pytest.raises(ValueError, match="no key"):
        kept_hashes.keep(left, str(tmp_path / "none"), [], ["vintage"])


def test_the_kept_side_is_not_exchanged(spark, tmp_path):
    rows = [("x", i, None, f"{i:064X}") for i in range(3000)]
    left = spark.createDataFrame(rows, SCHEMA)
    kept = kept_hashes.keep(left, str(tmp_path / "kept"), ["k"], ["vintage"], buckets=4)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = kept_hashes.compare(kept, left.where("k <> 7"))._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    depth = lambda line: len(re.match(r"[ :+-]*", line)[0])
    scan = next(i for i, line in enumerate(plan) if "FileScan" in line and kept.table in line)
    assert "Bucketed: true" in plan[scan]
    above, level = [], depth(plan[scan])
    for line in reversed(plan[:scan]):
        if depth(line) < level:
            above.append(line)
            level = depth(line)
    assert any("FullOuter" in line for line in above) and not any("Exchange" in line for line in above)


def test_rows_move_once_for_the_buckets(spark, tmp_path, monkeypatch):
    """The right side goes straight to the buckets of the kept one; only keys that share a full bin are counted for being hot."""
    rows = [("x", i, None, f"{i:064X}") for i in range(3000)] + [("x", 7, None, f"{i:064X}") for i in range(5000, 5100)]
    left = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(kept_hashes, "ROWS_A_BUCKET", 300)
    kept = kept_hashes.keep(left, str(tmp_path / "kept"), ["k"], ["vintage"], buckets=4, many=50)
    assert kept.buckets == 11 and kept.hot().count() == 101  # 3,100 rows in parts of 300
    assert kept_hashes._hot_ids(kept_hashes._counted(left, ["k"], ["vintage"]), 50, 3100).count() == 1
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = kept_hashes.compare(kept, left.where("k <> 7"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    met = plan[plan.index("FullOuter"):]
    assert met[:met.index("REPARTITION_BY_NUM")].count("Exchange") == 1


def test_hashes_are_kept_until_the_left_side_changes(spark, tmp_path):
    table = lambda rows: spark.createDataFrame(rows, "ID long, V string").coalesce(1)
    rows = [(i, f"v{i}") for i in range(50)]
    table(rows).write.parquet(str(tmp_path / "left"))
    crosswalk = spark.createDataFrame([("ID", "id", False), ("V", "v", False)], "left_col string, right_col string, is_tokenized boolean")

    def pair(right):
        return ReconPair("t", spark.read.parquet(str(tmp_path / "left")), table(right).toDF("id", "v"), crosswalk, keys=["ID"], hash_all=True)

    path, made = str(tmp_path / "kept"), []
    keep = kept_hashes.keep

    def counting(*given, **named):
        made.append(1)
        return keep(*given, **named)

    kept_hashes.keep = counting
    try:
        first, second = pair(rows), pair(rows[1:])
        assert {r["status"] for r in first.compared_to_kept(first.keep_left(path, buckets=2)).collect()} == {"matched"}
        counts = rowhash.compare_counts(second.compared_to_kept(second.keep_left(path, buckets=2)), ["vintage"]).first()
        assert (counts["matched"], counts["left_only"], len(made)) == (49, 1, 1)
        table([(0, "other"), *rows[1:]]).write.mode("overwrite").parquet(str(tmp_path / "left"))
        third = pair(rows)
        counts = rowhash.compare_counts(third.compared_to_kept(third.keep_left(path, buckets=2)), ["vintage"]).first()
        assert (counts["matched"], counts["hash_mismatch"], len(made)) == (49, 1, 2)
    finally:
        kept_hashes.keep = keep
