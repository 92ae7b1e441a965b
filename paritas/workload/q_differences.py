"""Where two tables differ: digest tree, differing keys, changed columns; and vintages from given windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import digest_tree, intervals, rowhash
from ..sources.results import scratch
from . import pairs
from .registry import query
from .shape import big, text
from .sqlparts import ORDER_NAMES, PARTS, limbs, month, order_norms

for _s in "lr":
    PARTS[f"c_o{_s}n"] = (f"SELECT order_id, {month('order_dt')} AS vintage, " + ", ".join(
        f"coalesce({n}, '') AS n_{c}" for c, n in zip(ORDER_NAMES, order_norms())) + f" FROM c_o{_s}")
    PARTS[f"c_o{_s}p"] = f"""
SELECT CAST('0x' || substr(md5(vintage || '|' || order_id), 1, 8) AS BIGINT) AS place,
  md5(concat_ws('|', vintage, order_id, {', '.join(f"coalesce({n}, 'NULL')" for n in order_norms())})) AS g
FROM (SELECT *, {month('order_dt')} AS vintage FROM c_o{_s})"""
    PARTS[f"c_o{_s}t"] = f"SELECT place >> 20 AS range, count(*) AS n, {limbs('g')} FROM c_o{_s}p GROUP BY 1"

PARTS["c_diff"] = f"""
SELECT coalesce(l.vintage, r.vintage) AS vintage, coalesce(l.order_id, r.order_id) AS order_id,
  CAST(l.order_id IS NOT NULL AS BIGINT) AS n_left, CAST(r.order_id IS NOT NULL AS BIGINT) AS n_right,
  CASE WHEN l.order_id IS NOT NULL AND r.order_id IS NOT NULL
       THEN concat_ws(',', {', '.join(f"CASE WHEN l.n_{c} <> r.n_{c} THEN '{c}' END" for c in ORDER_NAMES)}) END AS changed
FROM c_oln l FULL OUTER JOIN c_orn r ON l.vintage = r.vintage AND l.order_id = r.order_id
WHERE l.order_id IS NULL OR r.order_id IS NULL OR {' OR '.join(f'l.n_{c} <> r.n_{c}' for c in ORDER_NAMES)}"""


def _orders(spark, sf):
    return pairs.orders_pair(spark, sf, keys=["ORDER_ID"], hash_all=True)


@query("digest_tree_ranges", " UNION ALL ".join(f"""
SELECT {bits} AS bits, count(*) AS ranges, count(*) FILTER (WHERE l IS DISTINCT FROM r) AS differing, CAST(sum(n) AS BIGINT) AS n_rows
FROM (SELECT coalesce(l.k, r.k) AS k, l.t AS l, r.t AS r, coalesce(l.n, 0) + coalesce(r.n, 0) AS n FROM
  (SELECT range >> {12 - bits} AS k, sum(n) AS n, (sum(n), sum(limb_0), sum(limb_1), sum(limb_2), sum(limb_3), sum(limb_4), sum(limb_5)) AS t FROM c_olt GROUP BY 1) l
  FULL OUTER JOIN (SELECT range >> {12 - bits} AS k, sum(n) AS n, (sum(n), sum(limb_0), sum(limb_1), sum(limb_2), sum(limb_3), sum(limb_4), sum(limb_5)) AS t
    FROM c_ort GROUP BY 1) r ON l.k = r.k)""" for bits in (4, 8, 12)))
def digest_tree_ranges(spark, sf):
    """Ranges and differing ones at three levels of one tree; the coarser levels are sums of the finest."""
    sides, out = _orders(spark, sf).sides(scoped=False), None
    finest = [sides.digests(side, 12) for side in ("left", "right")]
    for bits in (4, 8, 12):
        left, right = (digest_tree.rolled_up(d, 12, bits) for d in finest)
        whole = left.select("range", "n").unionByName(right.select("range", "n")).groupBy("range").agg(F.sum("n").alias("n"))
        marked = whole.join(digest_tree.differing_ranges(left, right).select("range", F.lit(True).alias("differs")), "range", "left")
        one = marked.agg(F.lit(bits).alias("bits"), F.count(F.lit(1)).alias("ranges"), F.count_if("differs").alias("differing"), F.sum("n").alias("n_rows"))
        out = one if out is None else out.unionByName(one)
    return out


@query("digest_tree_differences", """
SELECT d.vintage, d.order_id, n_left, n_right, l.h AS left_hash, r.h AS right_hash, changed
FROM c_diff d LEFT JOIN c_olh l ON d.order_id = l.order_id AND d.vintage = l.vintage LEFT JOIN c_orh r ON d.order_id = r.order_id AND d.vintage = r.vintage""")
def digest_tree_differences(spark, sf):
    found = _orders(spark, sf).differences(scoped=False, few=1000)
    return found.select("vintage", F.col("ORDER_ID").alias("order_id"), "n_left", "n_right", "left_hash", "right_hash",
                        F.array_join("changed", ",").alias("changed"))


@query("changed_column_counts", "SELECT vintage, column_name, count(*) AS n FROM (SELECT vintage, unnest(string_split(changed, ',')) AS column_name FROM c_diff) GROUP BY 1, 2")
def changed_column_counts(spark, sf):
    return _orders(spark, sf).changed_columns(scoped=False).withColumnRenamed("column", "column_name")


@query("changed_columns_of_samples", """
SELECT vintage, order_id, changed FROM c_diff WHERE changed IS NOT NULL QUALIFY row_number() OVER (PARTITION BY vintage ORDER BY order_id) <= 100""")
def changed_columns_of_samples(spark, sf):
    return _orders(spark, sf).changed_samples(scoped=False).select(
        "vintage", F.col("ORDER_ID").alias("order_id"), F.array_join("changed", ",").alias("changed"))


@query("hash_check_kept", "SELECT * FROM c_a14")
def hash_check_kept(spark, sf):
    """Counts of the hash check with the left side kept in buckets and opened again."""
    pair, path = _orders(spark, sf), scratch(spark, "kept-orders")
    pair.keep_left(path, buckets=16)
    counts = rowhash.compare_counts(pair.compared_to_kept(pair.keep_left(path, buckets=16)), ["vintage"])
    return counts.select("vintage", *big("left_rows", "right_rows", "matched", "left_only", "right_only", "hash_mismatch"))


@query("kept_hashes_by_key", """
SELECT vintage, order_id, CAST(count(left_hash) AS BIGINT) AS n_left, CAST(count(right_hash) AS BIGINT) AS n_right,
  count(*) FILTER (WHERE status = 'matched') AS matched, count(*) FILTER (WHERE status = 'hash_mismatch') AS hash_mismatch,
  min(left_hash) AS left_hash, max(right_hash) AS right_hash, min(status) AS status FROM c_j1 GROUP BY 1, 2""")
def kept_hashes_by_key(spark, sf):
    pair = _orders(spark, sf)
    found = pair.compared_to_kept(pair.keep_left(scratch(spark, "kept-orders"), buckets=16))
    return found.select("vintage", F.col("ORDER_ID").alias("order_id"), *big("n_left", "n_right", "matched", "hash_mismatch"), "left_hash", "right_hash", "status")


# ---------------------------------------------------------------- given windows

# every month that has orders gives an overlapping window of 75 days, a reversed one, and one open at the end each January
PARTS["c_given"] = """
SELECT 'S' || strftime(m, '%Y%m') AS vintage, m AS start_date, CAST(m + INTERVAL 74 DAY AS DATE) AS end_date FROM c_given_months
UNION ALL SELECT 'R' || strftime(m, '%Y%m'), m, CAST(m - INTERVAL 1 DAY AS DATE) FROM c_given_months
UNION ALL SELECT 'O' || strftime(m, '%Y'), m, NULL FROM c_given_months WHERE month(m) = 1"""
PARTS["c_given_months"] = "SELECT DISTINCT CAST(date_trunc('month', order_dt) AS DATE) AS m FROM c_ol"


def _given_windows(spark, sf):
    months = pairs.orders_left(spark, sf).select(F.trunc("ORDER_DT", "month").alias("m")).distinct()
    label = lambda kind, fmt: F.concat(F.lit(kind), F.date_format("m", fmt)).alias("vintage")
    start, open_end = F.col("m").alias("start_date"), F.lit(None).cast("date")
    return months.select(label("S", "yyyyMM"), start, F.date_add("m", 74).alias("end_date")) \
        .unionByName(months.select(label("R", "yyyyMM"), start, F.date_sub("m", 1).alias("end_date"))) \
        .unionByName(months.where("month(m) = 1").select(label("O", "yyyy"), start, open_end.alias("end_date")))


@query("days_in_given_windows", """
SELECT CAST(d AS VARCHAR) AS day, vintage, CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date, n_left, n_right
FROM c_both JOIN c_given ON d >= start_date AND (end_date IS NULL OR d <= end_date)""")
def days_in_given_windows(spark, sf):
    found = intervals.in_intervals(pairs.orders_pair(spark, sf).day_counts, _given_windows(spark, sf))
    return found.select(*text("day"), "vintage", *text("start_date", "end_date"), "n_left", "n_right")


def _given_pair(spark, sf):
    return pairs.orders_pair(spark, sf, keys=["ORDER_ID"], hash_all=True, vintage_windows=_given_windows(spark, sf))


PARTS["c_given_days"] = "SELECT DISTINCT d, vintage FROM c_both JOIN c_given ON d >= start_date AND (end_date IS NULL OR d <= end_date)"
for _s in "lr":
    PARTS[f"c_given_{_s}"] = f"SELECT g.vintage, o.order_id, o.h FROM c_o{_s}h o JOIN c_given_days g ON o.order_dt = g.d JOIN c_both b ON b.d = g.d AND n_left = n_right"


@query("meta_given_windows", """
SELECT w.vintage, CAST(w.start_date AS VARCHAR) AS start_date, CAST(w.end_date AS VARCHAR) AS end_date, CAST(sum(n_left) AS BIGINT) AS day_rows_left,
  CAST(sum(n_right) AS BIGINT) AS day_rows_right, count(*) FILTER (WHERE n_left <> n_right) AS excluded_days
FROM c_given w JOIN c_given_days g USING (vintage) JOIN c_both USING (d) GROUP BY ALL""")
def meta_given_windows(spark, sf):
    return _given_pair(spark, sf).meta().select("vintage", *text("start_date", "end_date"), "day_rows_left", "day_rows_right", "excluded_days")


@query("hash_check_given_windows", """
SELECT coalesce(l.vintage, r.vintage) AS vintage, count(l.h) AS left_rows, count(r.h) AS right_rows, count(*) FILTER (WHERE l.h = r.h) AS matched,
  count(*) FILTER (WHERE r.h IS NULL) AS left_only, count(*) FILTER (WHERE l.h IS NULL) AS right_only, count(*) FILTER (WHERE l.h <> r.h) AS hash_mismatch
FROM c_given_l l FULL OUTER JOIN c_given_r r ON l.vintage = r.vintage AND l.order_id = r.order_id GROUP BY 1""")
def hash_check_given_windows(spark, sf):
    return _given_pair(spark, sf).hash_check().select(
        "vintage", *big("left_rows", "right_rows", "matched", "left_only", "right_only", "hash_mismatch"))
