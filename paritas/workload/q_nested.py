"""Nested columns: canonical text, and a check of tables that hold them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import normalize
from ..plans import ReconPair
from . import pairs
from .registry import query
from .shape import big
from .sqlparts import PARTS, month, n_dbl, n_int, n_label


def _nested_left(spark, sf):
    """Orders with an array of numbers, a struct of a decimal, a date and a list of labels, and a map."""
    o = pairs.orders_left(spark, sf)
    return o.select(
        "ORDER_ID", "ORDER_DT",
        F.when(F.col("ORDER_ID") % 13 != 0, F.array("CUST_ID", F.when(F.col("ORDER_ID") % 3 != 0, F.col("ORDER_ID")))).alias("NUMBERS"),
        F.struct(F.col("PRICE").cast("decimal(18,4)").alias("price"), F.col("ORDER_DT").alias("day"), F.array("STATUS", "PRIORITY").alias("labels")).alias("DETAIL"),
        F.create_map(F.lit("status"), F.col("STATUS"), F.lit("priority"), F.col("PRIORITY"), F.lit("a,b"), F.lit(" n/a ")).alias("MARKS"))


def _nested_right(spark, sf):
    """Fields and entries in another order, other number types, and every 31st map with another value."""
    l = _nested_left(spark, sf)
    other = F.when(F.col("ORDER_ID") % 31 == 0, F.lit("X")).otherwise(F.col("MARKS")["status"])
    return l.select(
        F.col("ORDER_ID").alias("order_id"), F.col("ORDER_DT").alias("order_dt"), F.col("NUMBERS").cast("array<double>").alias("numbers"),
        F.struct(F.col("DETAIL.labels").alias("Labels"), F.col("DETAIL.day").alias("Day"), F.col("DETAIL.price").cast("decimal(20,6)").alias("Price")).alias("detail"),
        F.create_map(F.lit("a,b"), F.lit("N/A"), F.lit("priority"), F.col("MARKS")["priority"], F.lit("status"), F.concat(F.lit(" "), F.lower(other))).alias("marks"))


_told = lambda x: f"coalesce(length({x}) || ':' || {x}, '~')"
_some = lambda x, norm: f"CASE WHEN {x} IS NOT NULL THEN {norm} END"
_PRICE = "CAST(CAST(round(CAST(price AS DECIMAL(18,4)), 3) AS DECIMAL(38,3)) AS VARCHAR)"
_LABELS = f"('[' || {_told(n_label('status'))} || ',' || {_told(_some('priority', n_label('priority')))} || ']')"
PARTS["c_nested"] = f"""
SELECT order_id, order_dt, {month('order_dt')} AS vintage,
  CASE WHEN order_id % 13 <> 0 THEN '[' || {_told(n_int('cust_id'))} || ',' || CASE WHEN order_id % 3 <> 0 THEN {_told(n_int('order_id'))} ELSE '~' END || ']' END AS numbers,
  '(day=' || {_told('CAST(order_dt AS VARCHAR)')} || ',labels=' || {_told(_LABELS)} || ',price=' || {_told(_PRICE)} || ')' AS detail,
  list_sort(['3:A,B=~', '8:PRIORITY=' || {_told(_some('priority', n_label('priority')))}, '6:STATUS=' || {_told(n_label('status'))}]) AS entries
FROM c_ol"""


@query("norm_nested", "SELECT order_id, numbers, detail, '{' || list_aggregate(entries, 'string_agg', ',') || '}' AS marks FROM c_nested")
def norm_nested(spark, sf):
    df = _nested_left(spark, sf)
    canonical = lambda name: normalize.norm_nested(F.col(name), df.schema[name].dataType).alias(name.lower())
    return df.select(F.col("ORDER_ID").alias("order_id"), *[canonical(c) for c in ("NUMBERS", "DETAIL", "MARKS")])


@query("nested_hash_check", """
SELECT vintage, count(*) AS left_rows, count(*) AS right_rows, count(*) FILTER (WHERE order_id % 31 <> 0) AS matched, 0 AS left_only, 0 AS right_only,
  count(*) FILTER (WHERE order_id % 31 = 0) AS hash_mismatch, concat_ws(',', 'MARKS:' || nullif(count(*) FILTER (WHERE order_id % 31 = 0), 0)) AS changed
FROM c_nested GROUP BY 1""")
def nested_hash_check(spark, sf):
    """Maps with entries in any order and structs with fields in any order hash alike; what differs is named."""
    names = ["ORDER_ID", "ORDER_DT", "NUMBERS", "DETAIL", "MARKS"]
    pair = ReconPair("nested", _nested_left(spark, sf), _nested_right(spark, sf), pairs.crosswalk(spark, [(c, c.lower(), None) for c in names]),
                     "ORDER_DT", "order_dt", partition="month", keys=["ORDER_ID"], hash_all=True)
    per_vintage = pair.changed_columns().groupBy("vintage").agg(
        F.array_join(F.array_sort(F.collect_list(F.concat("column", F.lit(":"), "n"))), ",").alias("changed"))  # as many as there are columns
    counts = ["left_rows", "right_rows", "matched", "left_only", "right_only", "hash_mismatch"]
    return pair.hash_check().join(per_vintage, "vintage", "left").select("vintage", *big(*counts), F.coalesce("changed", F.lit("")).alias("changed"))


@query("nested_value_gate", """
SELECT col AS column_name, count(*) AS vintages, count(*) FILTER (WHERE col = 'MARKS' AND bad > 0) AS vintages_differing
FROM (SELECT vintage, count(*) FILTER (WHERE order_id % 31 = 0) AS bad FROM c_nested GROUP BY 1), (SELECT unnest(['ORDER_ID', 'ORDER_DT', 'NUMBERS', 'DETAIL', 'MARKS']) AS col) GROUP BY 1""")
def nested_value_gate(spark, sf):
    """Fingerprints of nested values: equal where only the order of fields and entries, the spelling or the number types differ."""
    names = ["ORDER_ID", "ORDER_DT", "NUMBERS", "DETAIL", "MARKS"]
    pair = ReconPair("nested", _nested_left(spark, sf), _nested_right(spark, sf), pairs.crosswalk(spark, [(c, c.lower(), None) for c in names]),
                     "ORDER_DT", "order_dt", partition="month", normalised_profile=True)
    return pair.value_gate.groupBy(F.col("column").alias("column_name")).agg(
        F.count(F.lit(1)).alias("vintages"), F.count_if(~F.col("is_equal")).alias("vintages_differing"))
