"""Whole checks: invariants, seeded defects with known counts, and plan shapes."""

import os

import parity
import pytest
from pyspark.sql import functions as F

from paritas.plans import ReconPair
from paritas.workload import pairs

SF = os.path.join(parity.DATA, "sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables not present")


def test_a_table_matches_itself(spark):
    rows = pairs.nation_pair(spark, SF).reconcile().collect()
    assert [r["status"] for r in rows] == ["MATCH"]
    assert rows[0]["left_rows"] == rows[0]["matched"] == 25


def test_orders_defects_are_all_found(spark):
    full = pairs.orders_pair(spark, SF, keys=["ORDER_ID"], hash_all=True)
    total = full.hash_check(scoped=False).agg(*[F.sum(c).cast("bigint").alias(c) for c in (
        "left_rows", "right_rows", "matched", "hash_mismatch", "left_only", "right_only")]).first()
    assert total.asDict() == dict(left_rows=1500, right_rows=1501, matched=1468, hash_mismatch=29, left_only=3, right_only=4)
    days = full.day_summary().first()
    assert (days["total_days"], days["unmatched_days"]) == (1094, 7)
    scoped = full.hash_check().agg(F.sum("hash_mismatch").cast("bigint"), F.sum(F.col("left_only") + F.col("right_only"))).first()
    assert tuple(scoped) == (28, 0)


def test_orders_columns(spark):
    raw = {r["column"]: r["vintages_mismatched"] for r in pairs.orders_pair(spark, SF).column_check().collect()}
    assert raw == {"ORDER_ID": 0, "CUST_ID": 0, "ORDER_DT": 0, "PRICE": 23, "STATUS": 53, "PRIORITY": 41}
    clean = {r["column"]: r["is_mismatched"] for r in pairs.orders_pair(spark, SF, normalised_profile=True).column_check().collect()}
    assert clean == {"ORDER_ID": False, "CUST_ID": False, "ORDER_DT": False, "PRICE": True, "STATUS": False, "PRIORITY": False}


def test_cancelling_defects_pass_the_day_check_only(spark):
    """Lost and added rows on the same days: equal counts, found by the hash join."""
    left, right = pairs.orders_left(spark, SF), pairs.orders_right(spark, SF, cancelling=True)
    pair = ReconPair("orders", left, right, pairs.crosswalk(spark, pairs.ORDERS_CROSSWALK), "ORDER_DT", "order_dt",
                     partition="all", keys=["ORDER_ID"], hash_all=True)
    assert pair.right_fmt == "yyyyMMdd"
    counts = pair.hash_check(scoped=False).first()
    assert counts["left_rows"] == counts["matched"] + counts["hash_mismatch"] + counts["left_only"]
    assert counts["left_only"] > 0 and counts["right_only"] > 0


def test_zero_and_null_hash_alike_and_timestamps_meet_at_the_second(spark):
    pair = pairs.events_pair(spark, SF, keys=["EVENT_ID"], hash_all=True)
    total = pair.hash_check(scoped=False).agg(F.sum("hash_mismatch").cast("bigint"), F.sum("left_only")).first()
    lost = pairs.table(spark, SF, "events").where("event_id % 97 = 1").count()
    assert tuple(total) == (0, lost)


def test_nothing_left_to_hash(spark):
    pair = pairs.events_pair(spark, SF)
    # every day lost a row at some scale; whatever is left, the plan runs to the end
    assert {r["status"] for r in pair.reconcile().collect()} <= {"DAYS_DIFFER", "COLUMNS_DIFFER", "ROWS_DIFFER", "MATCH"}


def test_empty_side(spark):
    left, right = pairs.orders_left(spark, SF), pairs.orders_right(spark, SF).where("false")
    pair = ReconPair("orders", left, right, pairs.crosswalk(spark, pairs.ORDERS_CROSSWALK), "ORDER_DT", "order_dt", right_fmt="yyyyMMdd")
    rows = pair.reconcile().collect()
    assert [r["status"] for r in rows] == ["LEFT_ONLY"] and rows[0]["day_rows_left"] == left.count() and rows[0]["day_rows_right"] == 0
    assert [r["sides"] for r in pair.meta().collect()] == ["left_only"]


def test_missing_date_on_one_side_is_refused(spark):
    with pytest.raises(ValueError):
        ReconPair("x", pairs.orders_left(spark, SF), pairs.orders_right(spark, SF), pairs.crosswalk(spark, []), "ORDER_DT", None)


def test_scope_is_broadcast_and_columns_are_pruned(spark):
    pair = pairs.orders_pair(spark, SF, keys=["ORDER_ID"], hash_all=True)
    plan = pair.hashes("left").select("ORDER_ID")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "o_totalprice" not in plan and "o_orderpriority" not in plan


def test_counts_need_no_join_and_no_sort(spark):
    pair = pairs.orders_pair(spark, SF, keys=["ORDER_ID"], hash_all=True)
    plan = pair.hash_check(scoped=False)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "SortAggregate" not in plan and "CartesianProduct" not in plan
