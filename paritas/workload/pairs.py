"""Two-sided data derived from the given tables by deterministic rules.

The given tables have one side and no NULLs. The right side is the left one as another
platform would hold it (types, spelling) with seeded defects, chosen by remainders of
the key so that the number of defects grows with the table. No row is left out to make
a check cheaper: a dropped row *is* a defect that the checks have to find.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..plans import ReconPair
from ..sources import scan
from ..sources.local import local_rows

CROSSWALK_SCHEMA = "ord int, left_col string, right_col string, comment string, is_tokenized boolean"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return scan.spread(spark.read.parquet(f"{sf}/{name}.parquet"))


def crosswalk(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Crosswalk of one pair: ``(left, right, comment)`` rows, a schema-sized table."""
    full = [(i, l, r, c, c is not None and c.lower().startswith("tokenise")) for i, (l, r, c) in enumerate(rows)]
    return local_rows(spark, full, CROSSWALK_SCHEMA)


def every(key: str, modulus: int, rest: int = 0) -> Column:
    return F.col(key) % modulus == rest


ORDERS_CROSSWALK = [
    ("ORDER_ID", "order_id", None), ("CUST_ID", "cust_id", None), ("STATUS", "status", None),
    ("PRICE", "price", None), ("ORDER_DT", "order_dt", None), ("PRIORITY", "priority", None),
    ("CUST_TOKEN", "cust_token", "Tokenise at source."), ("LOAD_TS", None, None),
]


def orders_left(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("ORDER_ID"),
        F.col("o_custkey").alias("CUST_ID"),
        F.col("o_orderstatus").alias("STATUS"),
        F.col("o_totalprice").alias("PRICE"),
        F.col("o_orderdate").cast("date").alias("ORDER_DT"),
        F.when(~every("o_orderkey", 29), F.col("o_orderpriority")).alias("PRIORITY"),
        F.col("o_custkey").alias("CUST_TOKEN"),
        F.col("o_orderdate").alias("LOAD_TS"),
        F.lit("n").alias("NOTE"),
    )


def orders_right(spark: SparkSession, sf: str, cancelling: bool = False) -> DataFrame:
    """``cancelling`` lets lost and added rows fall on any day, so day counts can agree by chance."""
    o = table(spark, sf, "orders")
    even = F.dayofmonth("o_orderdate") % 2 == 0
    lost = every("o_orderkey", 101, 7) & (F.lit(True) if cancelling else even)
    kept = o.where(~lost)
    base = kept.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("cust_id"),
        F.when(every("o_orderkey", 17), F.concat(F.lit("  "), F.lower("o_orderstatus"), F.lit(" ")))
        .otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(every("o_orderkey", 53), F.col("o_totalprice") * 1.5)
        .otherwise(F.col("o_totalprice") + 1e-7).alias("price"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("order_dt"),
        F.when(every("o_orderkey", 29), F.lit("n/a")).otherwise(F.col("o_orderpriority")).alias("priority"),
        F.sha2(F.col("o_custkey").cast("string"), 256).alias("cust_token"),
        F.lit("b1").alias("etl_batch"),
        F.lit("n").alias("note"),
        (every("o_orderkey", 211, 5) & (F.lit(True) if cancelling else ~even)).alias("__again"),
    )
    # a repeated row is emitted next to its original, without a second scan
    copies = F.explode(F.when(F.col("__again"), F.array(F.lit(0), F.lit(100_000_000))).otherwise(F.array(F.lit(0))))
    return base.withColumn("__shift", copies).withColumn(
        "order_id", F.col("order_id") + F.col("__shift")).drop("__again", "__shift")


def orders_mixed(spark: SparkSession, sf: str) -> DataFrame:
    """The right side with every seventh and eleventh date in another notation."""
    day = F.to_date("order_dt", "yyyyMMdd")
    written = F.when(every("order_id", 7), F.date_format(day, "yyyy-MM-dd")).when(every("order_id", 11), F.date_format(day, "MMM d, yyyy"))
    return orders_right(spark, sf).withColumn("order_dt", F.coalesce(written, "order_dt"))


def orders_pair(spark: SparkSession, sf: str, **options) -> ReconPair:
    options = {"partition": "month", "right_fmt": "yyyyMMdd", **options}
    return ReconPair("orders", orders_left(spark, sf), orders_right(spark, sf),
                     crosswalk(spark, ORDERS_CROSSWALK), "ORDER_DT", "order_dt", **options)


LINEITEM_CROSSWALK = [
    ("ORDER_ID", "order_id", None), ("LINE_NO", "line_no", None), ("PART_ID", "part_id", None),
    ("SUPP_ID", "supp_id", None), ("QTY", "qty", None), ("PRICE", "price", None), ("DISC", "disc", None),
    ("TAX", "tax", None), ("RFLAG", "rflag", None), ("LSTATUS", "lstatus", None), ("SHIP_DT", "ship_dt", None),
]


def lineitem_left(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("ORDER_ID"), F.col("l_linenumber").alias("LINE_NO"),
        F.col("l_partkey").alias("PART_ID"), F.col("l_suppkey").alias("SUPP_ID"),
        F.col("l_quantity").alias("QTY"), F.col("l_extendedprice").alias("PRICE"),
        F.col("l_discount").alias("DISC"), F.col("l_tax").alias("TAX"),
        F.col("l_returnflag").alias("RFLAG"), F.col("l_linestatus").alias("LSTATUS"),
        F.col("l_shipdate").alias("SHIP_DT"),
    )


def lineitem_right(spark: SparkSession, sf: str) -> DataFrame:
    l = table(spark, sf, "lineitem")
    lost = every("l_suppkey", 37, 3) & (F.col("l_linenumber") == 1)
    return l.where(~lost).select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("part_id"), F.col("l_suppkey").alias("supp_id"),
        F.col("l_quantity").cast("decimal(12,2)").alias("qty"), F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("disc"), F.col("l_tax").alias("tax"),
        F.when(every("l_partkey", 19), F.lower("l_returnflag")).otherwise(F.col("l_returnflag")).alias("rflag"),
        F.col("l_linestatus").alias("lstatus"), F.col("l_shipdate").alias("ship_dt"),
    )


def lineitem_pair(spark: SparkSession, sf: str, **options) -> ReconPair:
    options = {"partition": "week", **options}
    return ReconPair("lineitem", lineitem_left(spark, sf), lineitem_right(spark, sf),
                     crosswalk(spark, LINEITEM_CROSSWALK), "SHIP_DT", "ship_dt", **options)


EVENTS_CROSSWALK = [
    ("EVENT_ID", "event_id", None), ("TS", "ts", None), ("USER_ID", "user_id", None),
    ("EVENT_TYPE", "event_type", None), ("VALUE", "value", None), ("PROPS", "props", None),
]


def events_left(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("event_id").alias("EVENT_ID"), F.col("ts").alias("TS"), F.col("user_id").alias("USER_ID"),
        F.col("event_type").alias("EVENT_TYPE"),
        F.when(every("event_id", 41), F.lit(0.0)).otherwise(F.col("value")).alias("VALUE"),
        F.col("props").alias("PROPS"),
    )


def events_right(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").where(~every("event_id", 97, 1)).select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "user_id", "event_type",
        F.when(~every("event_id", 41), F.col("value")).alias("value"), "props",
    )


def events_pair(spark: SparkSession, sf: str, **options) -> ReconPair:
    options = {"partition": "day", "right_fmt": "yyyy-MM-dd HH:mm:ss", **options}
    return ReconPair("events", events_left(spark, sf), events_right(spark, sf),
                     crosswalk(spark, EVENTS_CROSSWALK), "TS", "ts", **options)


CUSTOMER_CROSSWALK = [
    ("CUST_ID", "cust_id", None), ("NAME", "name", None), ("NATION_ID", "nation_id", None),
    ("BALANCE", "balance", None), ("SEGMENT", "segment", None),
]


def customer_left(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").toDF("CUST_ID", "NAME", "NATION_ID", "BALANCE", "SEGMENT")


def customer_right(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    return c.select(
        F.col("c_custkey").alias("cust_id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation_id"),
        F.col("c_acctbal").cast("string").alias("balance"),
        F.concat(F.lit(" "), F.substring("c_mktsegment", 1, 3), F.lit("\t"), F.expr("substring(c_mktsegment, 4)")).alias("segment"),
    )


def customer_pair(spark: SparkSession, sf: str, **options) -> ReconPair:
    return ReconPair("customer", customer_left(spark, sf), customer_right(spark, sf),
                     crosswalk(spark, CUSTOMER_CROSSWALK), **options)


PART_CROSSWALK = [
    ("PART_ID", "part_id", None), ("NAME", "name", None), ("BRAND", "brand", None),
    ("TYPE", "type", None), ("SIZE", "size", None), ("RETAIL", "retail", None),
]


def part_left(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").toDF("PART_ID", "NAME", "BRAND", "TYPE", "SIZE", "RETAIL")


def part_right(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("part_id"), F.col("p_name").alias("name"),
        F.when(every("p_partkey", 67), F.lit("Brand#X")).otherwise(F.col("p_brand")).alias("brand"),
        F.col("p_type").alias("type"), F.col("p_size").cast("string").alias("size"),
        F.col("p_retailprice").alias("retail"),
    )


def part_pair(spark: SparkSession, sf: str, **options) -> ReconPair:
    return ReconPair("part", part_left(spark, sf), part_right(spark, sf), crosswalk(spark, PART_CROSSWALK), **options)


def nation_pair(spark: SparkSession, sf: str, **options) -> ReconPair:
    n = table(spark, sf, "nation")
    rows = [(c.upper(), c, None) for c in n.columns]
    return ReconPair("nation", n.toDF(*[c.upper() for c in n.columns]), n, crosswalk(spark, rows), **options)
