"""Column statistics, row hashes, verdicts, reports and the whole checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import compare, dates
from ..functions.types import NUMBER
from ..operators import profile, quality, reports, rowhash, top_values
from ..operators.columns import same_columns
from ..sources import scan
from ..plans import ReconPair
from . import pairs
from .registry import query
from .shape import SHOWN_STATS_SQL, big, printed, shown_stats, steady, steady_square, text
from .sqlparts import (FINGERPRINT, ORDER_NAMES, PARTS, continuous_sql, categorical_sql, frequencies_sql, full_compare, limbs, month,
                       n_dbl, n_int, n_label, order_norms, robust, week, year)

# ---------------------------------------------------------------- profiles

_LINE_NUMBERS = {"ORDER_ID": "order_id", "QTY": "qty", "PRICE": "price", "DISC": "disc", "TAX": "tax"}
PARTS["c_llw"] = f"SELECT *, {week('ship_dt')} AS vintage FROM c_ll"
PARTS["c_lly"] = f"SELECT *, {year('ship_dt')} AS vintage FROM c_ll"
PARTS["c_olm"] = f"SELECT *, {month('order_dt')} AS vintage FROM c_ol"


def _lines_by(spark, sf, unit):
    left = pairs.lineitem_left(spark, sf)
    return left.withColumn("vintage", dates.vintage_label(F.col("SHIP_DT").cast("date"), unit))


def _orders_by_month(spark, sf):
    left = pairs.orders_left(spark, sf)
    return left.withColumn("vintage", dates.vintage_label(F.col("ORDER_DT"), "month"))


def _profile(df, columns):
    return profile.long_form(df, same_columns(df, columns), "left", ["vintage"])


@query("profile_continuous", f"SELECT vintage, {SHOWN_STATS_SQL} FROM ({continuous_sql('c_llw', _LINE_NUMBERS)})")
def profile_continuous(spark, sf):
    values = _profile(_lines_by(spark, sf, "week"), list(_LINE_NUMBERS))
    return shown_stats(profile.profile_continuous(values.continuous, ["vintage"]), ["vintage"])


_CATS = {"STATUS": "status", "PRIORITY": "priority"}
PARTS["c_catfreq"] = frequencies_sql("c_olm", _CATS)


@query("profile_categorical", f"SELECT vintage, {SHOWN_STATS_SQL} FROM ({categorical_sql('c_catfreq')})")
def profile_categorical(spark, sf):
    values = _profile(_orders_by_month(spark, sf), list(_CATS))
    return shown_stats(profile.profile_categorical(values.categorical, ["vintage"]), ["vintage"])


PARTS["c_partfreq"] = frequencies_sql("c_lly", {"PART_TXT": "CASE WHEN part_id % 50 = 0 THEN NULL ELSE CAST(part_id AS VARCHAR) END", "RFLAG": "rflag"})


@query("profile_categorical_top20", """
SELECT vintage, col AS column_name, CAST(sum(n) FILTER (WHERE rn <= 20) AS BIGINT) AS "count",
  count(*) FILTER (WHERE rn <= 20) AS "distinct", coalesce(max(n) FILTER (WHERE v IS NULL), 0) AS missing,
  CAST(min(n) FILTER (WHERE rn <= 20) AS VARCHAR) AS "min", CAST(max(n) FILTER (WHERE rn <= 20) AS VARCHAR) AS "max",
  round(avg(n) FILTER (WHERE rn <= 20) + 3.7e-6, 4) AS "avg",
  round(stddev_samp(n) FILTER (WHERE rn <= 20) + 3.7e-6, 4) AS std,
  string_agg(coalesce(v, '') || '(' || n || ')', '; ' ORDER BY v NULLS FIRST) FILTER (WHERE rn <= 20) AS freq
FROM c_partfreq GROUP BY 1, 2""")
def profile_categorical_top20(spark, sf):
    lines = _lines_by(spark, sf, "year").withColumn(
        "PART_TXT", F.when(F.col("PART_ID") % 50 != 0, F.col("PART_ID").cast("string")))
    values = _profile(lines, ["PART_TXT", "RFLAG"])
    stats = profile.profile_categorical_top(values.categorical, ["vintage"])
    return shown_stats(stats, ["vintage"]).drop("kind", "sum", "sum_sq")


@query("top_freq_string", """
SELECT vintage, col AS column_name, string_agg(coalesce(v, '') || '(' || n || ')', '; ' ORDER BY rn) FILTER (WHERE rn <= 10) AS freq
FROM c_partfreq GROUP BY 1, 2""")
def top_freq_string(spark, sf):
    lines = _lines_by(spark, sf, "year").withColumn(
        "PART_TXT", F.when(F.col("PART_ID") % 50 != 0, F.col("PART_ID").cast("string")))
    freq = profile.value_frequencies(_profile(lines, ["PART_TXT", "RFLAG"]).categorical, ["vintage"])
    top = profile.top_frequencies(freq, ["vintage"])
    return top.select("vintage", F.col("column").alias("column_name"), compare.freq_text(F.col("freq")).alias("freq"))


PARTS["c_keyfreq"] = frequencies_sql("c_lly", {
    "LINE_KEY": "'line-of-order-' || order_id || '-' || line_no", "PART_TXT": "CASE WHEN part_id % 50 = 0 THEN NULL ELSE CAST(part_id AS VARCHAR) END",
    "RFLAG": "rflag"})


@query("top_values_recounted", "SELECT vintage, col AS column_name, v AS value, n, CAST(rn AS INTEGER) AS rn FROM c_keyfreq WHERE rn <= 10")
def top_values_recounted(spark, sf):
    """Top values of a key, a number with gaps and a flag by summary, bound and recount."""
    lines = _lines_by(spark, sf, "year").withColumns({
        "LINE_KEY": F.concat(F.lit("line-of-order-"), F.col("ORDER_ID").cast("string"), F.lit("-"), F.col("LINE_NO").cast("string")),
        "PART_TXT": F.when(F.col("PART_ID") % 50 != 0, F.col("PART_ID").cast("string"))})
    found = top_values.top_values(_profile(lines, ["LINE_KEY", "PART_TXT", "RFLAG"]).categorical, ["vintage"])
    return found.select("vintage", F.col("column").alias("column_name"), F.col("v_text").alias("value"), "n", "rn")


@query("vintage_profile", f"SELECT vintage, {SHOWN_STATS_SQL} FROM c_sl UNION ALL SELECT vintage, {SHOWN_STATS_SQL} FROM c_sr")
def vintage_profile(spark, sf):
    return shown_stats(pairs.orders_pair(spark, sf).stats(), ["vintage"])


@query("stats_concat", f"""
SELECT 'left' AS side, vintage, {SHOWN_STATS_SQL} FROM c_sl WHERE kind = 'continuous'
UNION ALL SELECT 'right', vintage, {SHOWN_STATS_SQL} FROM c_sr WHERE kind = 'categorical'""")
def stats_concat(spark, sf):
    pair = pairs.orders_pair(spark, sf)
    numbers = profile.profile(pair.scoped("left"), [p for p in pair.columns if p.family == NUMBER], ["vintage"], "left")
    others = profile.profile(pair.scoped("right"), [p for p in pair.columns if p.family != NUMBER], ["vintage"], "right")
    both = numbers.drop("freq").withColumn("side", F.lit("left")).unionByName(others.withColumn("side", F.lit("right")), allowMissingColumns=True)
    return shown_stats(both, ["side", "vintage"])


@query("freq_rank", "SELECT vintage, col AS column_name, v AS value, n, CAST(rn AS INTEGER) AS rn FROM c_partfreq")
def freq_rank(spark, sf):
    lines = _lines_by(spark, sf, "year").withColumn(
        "PART_TXT", F.when(F.col("PART_ID") % 50 != 0, F.col("PART_ID").cast("string")))
    freq = profile.value_frequencies(_profile(lines, ["PART_TXT", "RFLAG"]).categorical, ["vintage"])
    return profile.rank_frequencies(freq, ["vintage"]).select(
        "vintage", F.col("column").alias("column_name"), F.col("v_text").alias("value"), "n", "rn")


# ---------------------------------------------------------------- fingerprints

PARTS["c_fpl"] = f"SELECT vintage, md5(concat_ws('|', {', '.join(f'coalesce({n}, ' + chr(39) + 'NULL' + chr(39) + ')' for n in order_norms())})) AS g FROM c_ols"
PARTS["c_fpr"] = PARTS["c_fpl"].replace("c_ols", "c_ors")
for _s in "lr":
    PARTS[f"c_fpt{_s}"] = f"SELECT n, {FINGERPRINT} AS h FROM (SELECT count(*) AS n, {limbs('g')} FROM c_fp{_s})"
    PARTS[f"c_fpv{_s}"] = f"SELECT vintage, n, {FINGERPRINT} AS h FROM (SELECT vintage, count(*) AS n, {limbs('g')} FROM c_fp{_s} GROUP BY 1)"
    _cols = " UNION ALL ".join(
        f"SELECT '{c}' AS col, md5(coalesce(CAST(order_dt AS VARCHAR), 'NULL') || '|' || coalesce({n}, 'NULL')) AS g FROM c_o{_s}s"
        for c, n in zip(ORDER_NAMES, order_norms()))
    PARTS[f"c_fpc{_s}"] = f"SELECT col, n, {FINGERPRINT} AS h FROM (SELECT col, count(*) AS n, {limbs('g')} FROM ({_cols}) GROUP BY 1)"
PARTS["c_tfp"] = "SELECT l.n AS left_rows, r.n AS right_rows, l.h AS left_hash, r.h AS right_hash, l.h = r.h AS is_match FROM c_fptl l, c_fptr r"
PARTS["c_vfp"] = """SELECT l.vintage, l.n AS left_rows, r.n AS right_rows, l.h AS left_hash, r.h AS right_hash, l.h = r.h AS is_match
FROM c_fpvl l JOIN c_fpvr r USING (vintage)"""
PARTS["c_cfp"] = """SELECT l.col AS column_name, l.n AS left_rows, r.n AS right_rows, l.h AS left_hash, r.h AS right_hash, l.h = r.h AS is_match
FROM c_fpcl l JOIN c_fpcr r ON l.col = r.col"""


@query("table_fingerprint", "SELECT * FROM c_tfp")
def table_fingerprint(spark, sf):
    return pairs.orders_pair(spark, sf).fingerprints()


@query("vintage_fingerprint", "SELECT * FROM c_vfp")
def vintage_fingerprint(spark, sf):
    return pairs.orders_pair(spark, sf).fingerprints(by_vintage=True)


@query("column_fingerprint", "SELECT * FROM c_cfp")
def column_fingerprint(spark, sf):
    return pairs.orders_pair(spark, sf).column_fingerprints().withColumnRenamed("column", "column_name")


def _long_digests(src: str, norms: dict[str, str], day: str) -> str:
    row = f"md5(concat_ws('|', {', '.join(f"coalesce({n}, 'NULL')" for n in norms.values())}))"
    levels = [f"SELECT 'table' AS level, '' AS part, {row} AS g FROM {src}", f"SELECT 'vintage', vintage, {row} FROM {src}"]
    levels += [f"SELECT 'column', '{c}', md5(coalesce({day}, 'NULL') || '|' || coalesce({n}, 'NULL')) FROM {src}" for c, n in norms.items()]
    return f"SELECT level, part, {FINGERPRINT} AS h FROM (SELECT level, part, count(*) AS n, {limbs('g')} FROM ({' UNION ALL '.join(levels)}) GROUP BY 1, 2)"


def _table_status_sql(name: str, left: str, right: str, norms: dict[str, str], day: str) -> str:
    both = f"""SELECT coalesce(l.level, r.level) AS level, coalesce(l.h = r.h, false) AS ok FROM ({_long_digests(left, norms, day)}) l
FULL OUTER JOIN ({_long_digests(right, norms, day)}) r ON l.level = r.level AND l.part = r.part"""
    of = lambda level, ok="": f"count(*) FILTER (WHERE level = '{level}'{ok})"
    return f"""SELECT '{name}' AS table_name, bool_and(ok) FILTER (WHERE level = 'table') AS table_match, {of('vintage', ' AND ok')} AS vintages_matched,
  {of('vintage')} AS vintages, {of('column', ' AND ok')} AS columns_matched, {of('column')} AS columns,
  CASE WHEN NOT bool_and(ok) FILTER (WHERE level = 'table') THEN 'FAIL' WHEN bool_and(ok) THEN 'PASS' ELSE 'PARTIAL' END AS status FROM ({both})"""


# every 97th order is dated 40 days later on the right, and the date is not compared: the same rows, but not in the same vintages
PARTS["c_moved_l"] = f"SELECT order_id, cust_id, order_dt, {month('order_dt')} AS vintage FROM c_ol"
PARTS["c_moved_r"] = f"SELECT order_id, cust_id, order_dt, {month('order_dt')} AS vintage FROM (SELECT order_id, cust_id, order_dt + CASE WHEN order_id % 97 = 0 THEN 40 ELSE 0 END AS order_dt FROM c_ol)"
PARTS["c_nations"] = "SELECT *, 'all' AS vintage FROM nation"


def _moved_orders(spark, sf):
    left = pairs.orders_left(spark, sf).select("ORDER_ID", "CUST_ID", "ORDER_DT")
    later = F.date_add("ORDER_DT", F.when(pairs.every("ORDER_ID", 97), 40).otherwise(0))
    right = left.select(F.col("ORDER_ID").alias("order_id"), F.col("CUST_ID").alias("cust_id"), later.alias("order_dt"))
    mapped = pairs.crosswalk(spark, [("ORDER_ID", "order_id", None), ("CUST_ID", "cust_id", None)])
    return ReconPair("moved", left, right, mapped, "ORDER_DT", "order_dt", partition="month")


@query("hash_table_status", " UNION ALL ".join([
    _table_status_sql("orders", "c_ols", "c_ors", dict(zip(ORDER_NAMES, order_norms())), "CAST(order_dt AS VARCHAR)"),
    _table_status_sql("moved", "c_moved_l", "c_moved_r", {c: n_int(c) for c in ("order_id", "cust_id")}, "CAST(order_dt AS VARCHAR)"),
    _table_status_sql("nation", "c_nations", "c_nations", {"n_nationkey": n_int("n_nationkey"), "n_name": n_label("n_name"), "n_regionkey": n_int("n_regionkey")}, "NULL")]))
def hash_table_status(spark, sf):
    out = None
    for name, make, scoped in (("orders", pairs.orders_pair, True), ("moved", _moved_orders, False), ("nation", pairs.nation_pair, True)):
        pair = make(spark, sf)
        levels = pair.fingerprints(scoped=scoped), pair.fingerprints(by_vintage=True, scoped=scoped), pair.column_fingerprints(scoped=scoped)
        one = rowhash.table_status(*levels).select(F.lit(name).alias("table_name"), "*")
        out = one if out is None else out.unionByName(one)
    return out


# ---------------------------------------------------------------- row hashes

def _full_pair(spark, sf):
    """Every comparable column hashed, all days, keyed by the order."""
    return pairs.orders_pair(spark, sf, keys=["ORDER_ID"], hash_all=True)


_COUNTS = ["left_rows", "right_rows", "matched", "left_only", "right_only", "hash_mismatch"]


@query("hash_full_outer", """
SELECT vintage, order_id, CAST(count(left_hash) AS BIGINT) AS n_left, CAST(count(right_hash) AS BIGINT) AS n_right,
  count(*) FILTER (WHERE status = 'matched') AS matched, count(*) FILTER (WHERE status = 'hash_mismatch') AS hash_mismatch,
  min(left_hash) AS left_hash, max(right_hash) AS right_hash, min(status) AS status FROM c_j1 GROUP BY 1, 2""")
def hash_full_outer(spark, sf):
    return _full_pair(spark, sf).compared_rows(scoped=False).select(
        "vintage", F.col("ORDER_ID").alias("order_id"), *big("n_left", "n_right", "matched", "hash_mismatch"), "left_hash", "right_hash", "status")


@query("hash_compare_counts", "SELECT * FROM c_a14")
def hash_compare_counts(spark, sf):
    return _full_pair(spark, sf).hash_check(scoped=False).select("vintage", *big(*_COUNTS))


@query("hash_counts", " UNION ALL ".join(
    f"SELECT '{side}' AS side, vintage, count(*) AS total_rows, count(DISTINCT h) AS unique_hashes FROM c_l{side[0]}h GROUP BY 2"
    for side in ("left", "right")))
def hash_counts(spark, sf):
    _, left, right = _line_hashes(spark, sf)
    one = lambda side, hashes: rowhash.hash_counts(hashes, ["vintage"]).select(F.lit(side).alias("side"), "*")
    return one("left", left).unionByName(one("right", right))


@query("hash_mismatch_total", """
SELECT 'orders' AS table_name, count(*) AS vintages, CAST(sum(hash_mismatch) AS BIGINT) AS mismatches, sum(hash_mismatch) = 0 AS is_match,
  sum(hash_mismatch) = 0 AND sum(left_only + right_only) = 0 AS is_strict FROM c_a14""")
def hash_mismatch_total(spark, sf):
    counts = _full_pair(spark, sf).hash_check(scoped=False).withColumn("table_name", F.lit("orders"))
    return rowhash.mismatch_totals(counts, ["table_name"]).select("table_name", "vintages", *big("mismatches"), "is_match", "is_strict")


PARTS["c_lj"] = """
SELECT coalesce(l.vintage, r.vintage) AS vintage, l.h AS lh, r.h AS rh
FROM c_llh l FULL OUTER JOIN c_lrh r ON l.vintage = r.vintage AND l.order_id = r.order_id AND l.line_no = r.line_no"""
for _s in "lr":
    PARTS[f"c_dup{_s}"] = f"""
SELECT vintage, CAST(sum(n) AS BIGINT) AS n, count(*) FILTER (WHERE n > 1) AS dup_keys
FROM (SELECT vintage, order_id, line_no, count(*) AS n FROM c_l{_s}h GROUP BY 1, 2, 3) GROUP BY 1"""


def _line_hashes(spark, sf):
    pair = pairs.lineitem_pair(spark, sf, keys=["ORDER_ID", "LINE_NO"], hash_all=True)
    return pair, pair.hashes("left", scoped=False), pair.hashes("right", scoped=False)


@query("dup_key_fanout", """
SELECT j.vintage, coalesce(l.n, 0) AS left_rows, coalesce(r.n, 0) AS right_rows, coalesce(l.dup_keys, 0) AS left_dup_keys,
  coalesce(r.dup_keys, 0) AS right_dup_keys, matched, left_only, right_only, hash_mismatch
FROM (SELECT vintage, count(*) FILTER (WHERE lh = rh) AS matched, count(*) FILTER (WHERE rh IS NULL) AS left_only,
        count(*) FILTER (WHERE lh IS NULL) AS right_only, count(*) FILTER (WHERE lh <> rh) AS hash_mismatch FROM c_lj GROUP BY 1) j
LEFT JOIN c_dupl l USING (vintage) LEFT JOIN c_dupr r USING (vintage)""")
def dup_key_fanout(spark, sf):
    _, left, right = _line_hashes(spark, sf)
    compared = rowhash.compare_keys(left, right, ["ORDER_ID", "LINE_NO"], ["vintage"])
    return rowhash.compare_counts(compared, ["vintage"], duplicates=True).select(
        "vintage", *big(*_COUNTS), "left_dup_keys", "right_dup_keys")


@query("duplicate_keys", """
SELECT side, vintage, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys, count(*) FILTER (WHERE n > 1) AS dup_keys,
  CAST(sum(n - 1) AS BIGINT) AS surplus_rows
FROM (SELECT 'left' AS side, vintage, order_id, line_no, count(*) AS n FROM c_llh GROUP BY ALL
      UNION ALL SELECT 'right', vintage, order_id, line_no, count(*) FROM c_lrh GROUP BY ALL) GROUP BY 1, 2""")
def duplicate_keys(spark, sf):
    _, left, right = _line_hashes(spark, sf)
    return rowhash.duplicate_keys(left, right, ["ORDER_ID", "LINE_NO"], ["vintage"])


@query("row_id_fallback", """
SELECT vintage, h AS hash_value, CAST(sum(l) AS BIGINT) AS n_left, CAST(sum(r) AS BIGINT) AS n_right
FROM (SELECT vintage, h, 1 AS l, 0 AS r FROM c_llh UNION ALL SELECT vintage, h, 0, 1 FROM c_lrh)
GROUP BY 1, 2 HAVING sum(l) <> sum(r)""")
def row_id_fallback(spark, sf):
    _, left, right = _line_hashes(spark, sf)
    return rowhash.compare_multisets(left, right, ["vintage"])


@query("sample_mismatches", """
SELECT vintage, order_id, left_hash, right_hash FROM (
  SELECT *, row_number() OVER (PARTITION BY vintage ORDER BY order_id) AS rn FROM c_j1 WHERE status = 'hash_mismatch') WHERE rn <= 100""")
def sample_mismatches(spark, sf):
    compared = _full_pair(spark, sf).compared_rows(scoped=False)
    return rowhash.sample_mismatches(compared, ["ORDER_ID"], ["vintage"]).withColumnRenamed("ORDER_ID", "order_id")


@query("mismatch_cap", """
SELECT vintage, order_id, left_hash, right_hash, count(*) OVER () AS total FROM c_j1 WHERE status = 'hash_mismatch'""")
def mismatch_cap(spark, sf):
    compared = _full_pair(spark, sf).compared_rows(scoped=False)
    return rowhash.capped_mismatches(compared, ["ORDER_ID"], ["vintage"], None).withColumnRenamed("ORDER_ID", "order_id")


PARTS["c_drawn"] = """SELECT order_id FROM (SELECT order_id FROM c_ol UNION SELECT order_id FROM c_or)
ORDER BY CAST('0x' || substr(md5(CAST(order_id AS VARCHAR)), 1, 15) AS BIGINT), CAST(order_id AS VARCHAR) LIMIT 1000"""


@query("hash_sample_rows", """
SELECT side, order_id FROM (SELECT 'left' AS side, order_id FROM c_ol UNION ALL SELECT 'right', order_id FROM c_or) SEMI JOIN c_drawn USING (order_id)""")
def hash_sample_rows(spark, sf):
    left, right = rowhash.hash_sample(pairs.orders_left(spark, sf), pairs.orders_right(spark, sf), ["ORDER_ID"], ["order_id"], 1000)
    one = lambda df, key, side: df.select(F.lit(side).alias("side"), F.col(key).alias("order_id"))
    return one(left, "ORDER_ID", "left").unionByName(one(right, "order_id", "right"))


@query("vintage_batches", """
SELECT vintage, CAST('0x' || substr(h, 1, 8) AS BIGINT) % b AS batch, count(*) AS n
FROM c_llh JOIN (SELECT vintage, CAST(ceil(count(*) / 50.0) AS BIGINT) AS b FROM c_llh GROUP BY 1) USING (vintage) GROUP BY 1, 2""")
def vintage_batches(spark, sf):
    pair, left, _ = _line_hashes(spark, sf)
    counts = pair.vintage_rows().select("vintage", F.col("day_rows_left").alias("n"))
    return rowhash.vintage_batches(left, counts, 50).groupBy("vintage", "batch").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- verdicts

_OK = ["count_ok", "distinct_ok", "min_ok", "max_ok", "avg_ok", "std_ok", "missing_ok", "freq_ok", "is_match"]


@query("compare_stats", f"SELECT vintage, col AS column_name, {', '.join(_OK)} FROM c_flags")
def compare_stats(spark, sf):
    return pairs.orders_pair(spark, sf).compared.select("vintage", F.col("column").alias("column_name"), *_OK)


@query("stats_pair_join", """
SELECT vintage, col AS column_name, CAST(l_cnt AS BIGINT) AS left_count, CAST(r_cnt AS BIGINT) AS right_count,
  CAST(l_dist AS BIGINT) AS left_distinct, CAST(r_dist AS BIGINT) AS right_distinct, is_match FROM c_flags""")
def stats_pair_join(spark, sf):
    pair = pairs.orders_pair(spark, sf)
    stats = pair.stats()
    left = stats.where("side = 'left'").drop("side")
    # the right side under its own names, as it would come from a separate run
    right = stats.where("side = 'right'").drop("side").withColumn("column", F.lower("column"))
    names = pairs.crosswalk(spark, [(p.left, p.right, None) for p in pair.columns])
    flagged = quality.stat_flags(quality.pair_by_mapping(left, right, names, ["vintage"]))
    return flagged.select("vintage", F.col("column").alias("column_name"), F.col("l.count").alias("left_count"), F.col("r.count").alias("right_count"),
                          F.col("l.distinct").alias("left_distinct"), F.col("r.distinct").alias("right_distinct"), "is_match")


@query("mismatched_columns", """
SELECT col AS column_name, vintages, vintages_mismatched, is_mismatched FROM c_verdict""")
def mismatched_columns(spark, sf):
    return pairs.orders_pair(spark, sf).verdicts().select(
        F.col("column").alias("column_name"), "vintages", "vintages_mismatched", "is_mismatched")


@query("max_distinct", "SELECT col AS column_name, CAST(max_distinct AS BIGINT) AS max_distinct FROM c_verdict")
def max_distinct(spark, sf):
    return pairs.orders_pair(spark, sf).verdicts().select(F.col("column").alias("column_name"), "max_distinct")


@query("column_match_rate", "SELECT * FROM c_rate")
def column_match_rate(spark, sf):
    return pairs.orders_pair(spark, sf).match_rates()


@query("top_key_columns", "SELECT col AS column_name, CAST(max_distinct AS BIGINT) AS max_distinct, CAST(key_rank AS INTEGER) AS key_rank FROM c_keys")
def top_key_columns(spark, sf):
    return quality.key_columns(pairs.orders_pair(spark, sf).verdicts()).select(
        F.col("column").alias("column_name"), "max_distinct", "key_rank")


@query("hash_column_pick", """
SELECT col AS column_name, is_mismatched, CAST(max_distinct AS BIGINT) AS max_distinct FROM (
  SELECT *, row_number() OVER (ORDER BY max_distinct DESC, col) AS rn FROM c_verdict) WHERE NOT is_mismatched OR rn <= 2""")
def hash_column_pick(spark, sf):
    return quality.hash_columns(pairs.orders_pair(spark, sf).verdicts()).withColumnRenamed("column", "column_name")


_GRADED = ["cnt", "dist", "missing", "mx", "mn", "av", "sd", "sm", "sq"]
_NAMES = ["count", "distinct", "missing", "max", "min", "avg", "std", "sum", "sum_sq"]


def _v(alias, c):
    return f"CAST({alias}.{c} AS VARCHAR)"


PARTS["c_graded0"] = "SELECT l.vintage, l.col, l.cnt AS l_cnt, r.cnt AS r_cnt, l.dist AS l_dist, r.dist AS r_dist, " + ", ".join(
    f"{robust(_v('l', c), _v('r', c))} AS {n}_ok" for c, n in zip(_GRADED, _NAMES)
) + ", l.freq IS NOT DISTINCT FROM r.freq AS freq_ok FROM c_sl l JOIN c_sr r ON l.vintage = r.vintage AND l.col = r.col"
_PLAIN = " AND ".join(f"{n}_ok" for n in _NAMES)
PARTS["c_graded"] = f"""
SELECT *, CASE WHEN {_PLAIN} AND freq_ok THEN 'PASS' WHEN {_PLAIN} THEN 'PARTIAL' ELSE 'FAIL' END AS status,
  {' + '.join(f'CAST(NOT {n}_ok AS INTEGER)' for n in [*_NAMES, 'freq'])} AS mismatch_count,
  concat_ws(',', {', '.join(f"CASE WHEN NOT {n}_ok THEN '{n}' END" for n in [*_NAMES, 'freq'])}) AS differing FROM c_graded0"""


def _graded(spark, sf):
    return quality.graded(pairs.orders_pair(spark, sf).compared)


@query("column_status", "SELECT vintage, col AS column_name, status, mismatch_count, differing FROM c_graded")
def column_status(spark, sf):
    return _graded(spark, sf).select(
        "vintage", F.col("column").alias("column_name"), "status", "mismatch_count",
        F.array_join(F.transform("mismatches", lambda m: m["statistic"]), ",").alias("differing"))


@query("column_status_counts", """
SELECT 'orders' AS table_name, count(*) AS columns, count(*) FILTER (WHERE status = 'PASS') AS pass,
  count(*) FILTER (WHERE status = 'PARTIAL') AS partial, count(*) FILTER (WHERE status = 'FAIL') AS fail FROM c_graded""")
def column_status_counts(spark, sf):
    return quality.status_counts(_graded(spark, sf), []).select(F.lit("orders").alias("table_name"), "*")


@query("failed_columns", """
SELECT vintage, col AS column_name, CAST(l_cnt AS BIGINT) AS left_count, CAST(r_cnt AS BIGINT) AS right_count,
  CAST(l_dist AS BIGINT) AS left_distinct, CAST(r_dist AS BIGINT) AS right_distinct FROM c_graded WHERE status = 'FAIL'""")
def failed_columns(spark, sf):
    return quality.failed_columns(_graded(spark, sf)).withColumnRenamed("column", "column_name")


@query("mismatch_first_order", """
SELECT vintage, col AS column_name, is_match FROM c_flags ORDER BY vintage, is_match, col""")
def mismatch_first_order(spark, sf):
    compared = pairs.orders_pair(spark, sf).compared
    return reports.mismatched_first(compared, ["vintage"]).select("vintage", F.col("column").alias("column_name"), "is_match")


# ---------------------------------------------------------------- reports


@query("meta_summary", """
SELECT 'orders' AS table_name, true AS left_accessible, true AS right_accessible, (SELECT count(*) FROM c_ol) AS left_rows,
  (SELECT count(*) FROM c_or) AS right_rows, count(*) AS total_days, count(*) FILTER (WHERE n_left = n_right) AS matched_days,
  bool_and(n_left = n_right) AS all_match, 6 AS comparable, 1 AS tokenized, 1 AS left_only, 1 AS unmapped FROM c_both""")
def meta_summary(spark, sf):
    pair = pairs.orders_pair(spark, sf)
    from ..operators.crosswalk import pivot_classes

    rows = pair.day_counts.agg(F.sum("n_left").alias("left_rows"), F.sum("n_right").alias("right_rows"))
    classes = pivot_classes(pair.column_classes("left"), "left")
    one = lambda df: df.withColumn("table_name", F.lit("orders"))
    return (one(rows).join(one(pair.day_summary()), "table_name").join(one(classes), "table_name").select(
        "table_name", F.lit(True).alias("left_accessible"), F.lit(True).alias("right_accessible"), "left_rows", "right_rows",
        "total_days", "matched_days", "all_match", *[F.col(c).cast("int").alias(c) for c in ("comparable", "tokenized", "left_only", "unmapped")]))


@query("meta_details", """
SELECT 'day_summary' AS section, count(*) AS n FROM (SELECT 1) UNION ALL
SELECT 'day_mismatches', count(*) FROM c_both WHERE n_left <> n_right UNION ALL
SELECT 'vintages', count(*) FROM c_vint UNION ALL SELECT 'columns', 11 UNION ALL SELECT 'column_check', count(*) FROM c_verdict
UNION ALL SELECT 'match_rates', count(*) FROM c_rate UNION ALL SELECT 'hash_check', count(*) FROM c_p3c""")
def meta_details(spark, sf):
    return reports.section_sizes(pairs.orders_pair(spark, sf).sections())


@query("day_mismatch_section", """
SELECT 'orders' AS table_name, 'day_mismatches' AS section,
  '{"day":"' || CAST(d AS VARCHAR) || '","n_left":' || n_left || ',"n_right":' || n_right || '}' AS payload FROM c_both WHERE n_left <> n_right""")
def day_mismatch_section(spark, sf):
    bad = pairs.orders_pair(spark, sf).day_counts.where("n_left <> n_right")
    return reports.sections("orders", {"day_mismatches": bad})


@query("column_summary", "SELECT 'orders' AS dataset, * FROM c_rate")
def column_summary(spark, sf):
    return pairs.orders_pair(spark, sf).match_rates().select(F.lit("orders").alias("dataset"), "*")


PARTS["c_long"] = """
SELECT vintage, col, side, stat, value FROM (""" + " UNION ALL ".join(f"""
  SELECT vintage, col, '{_s}' AS side, CAST(cnt AS VARCHAR) AS "count", CAST(dist AS VARCHAR) AS "distinct", mn AS "min", mx AS "max",
    CAST(missing AS VARCHAR) AS missing, freq, CAST(CAST(round(av + 3.7e-6, 4) AS DECIMAL(38,4)) AS VARCHAR) AS "avg",
    CAST(CAST(round(sd + 3.7e-6, 4) AS DECIMAL(38,4)) AS VARCHAR) AS std, CAST(CAST(round(sm, 2) AS DECIMAL(38,2)) AS VARCHAR) AS "sum",
    CAST(CAST(CASE WHEN abs(sq) < 1e6 THEN round(sq, 4) ELSE round(sq, -4) END AS DECIMAL(38,4)) AS VARCHAR) AS sum_sq FROM c_s{_s[0]}"""
    for _s in ("left", "right")) + """)
UNPIVOT INCLUDE NULLS (value FOR stat IN ("count", "distinct", "min", "max", missing, freq, "avg", std, "sum", sum_sq))"""
# floats are printed by each engine in its own way, so they are rounded first
_ROUNDED = {"avg": lambda c: printed(steady(c), 4), "std": lambda c: printed(steady(c), 4),
            "sum": lambda c: printed(F.round(c, 2), 2), "sum_sq": lambda c: printed(steady_square(c), 4)}


def _long(spark, sf):
    return quality.long_stats(pairs.orders_pair(spark, sf).compared, ["vintage"], _ROUNDED)


@query("column_details", "SELECT vintage, side, stat, " + ", ".join(
    f"max(value) FILTER (WHERE col = '{c}') AS {c.lower()}" for c in ORDER_NAMES) + " FROM c_long GROUP BY 1, 2, 3")
def column_details(spark, sf):
    wide = reports.transpose_stats(_long(spark, sf), ORDER_NAMES, ["vintage"])
    return wide.toDF(*[c.lower() for c in wide.columns])


@query("cell_diff", """
SELECT l.vintage, l.col AS column_name, l.stat, l.value IS NOT DISTINCT FROM r.value AS is_equal
FROM c_long l JOIN c_long r ON l.vintage = r.vintage AND l.col = r.col AND l.stat = r.stat AND l.side = 'left' AND r.side = 'right'""")
def cell_diff(spark, sf):
    return _long(spark, sf).select("vintage", F.col("column").alias("column_name"), "stat", "is_equal")


@query("match_rate_band", "SELECT vintage, match_rate, CASE WHEN matched_columns * 100.0 / total_columns >= 95 THEN 'good' ELSE 'bad' END AS band FROM c_rate")
def match_rate_band(spark, sf):
    rates = pairs.orders_pair(spark, sf).match_rates()
    return rates.select("vintage", "match_rate", quality.rate_band(F.col("match_rate")).alias("band"))


@query("stat_mismatch_view", "SELECT vintage, col AS column_name, l_dist AS left_distinct, r_dist AS right_distinct FROM c_flags WHERE NOT is_match")
def stat_mismatch_view(spark, sf):
    pair = pairs.orders_pair(spark, sf)
    reports.register_views({"differing_statistics": pair.compared.where("NOT is_match")})
    return spark.sql("""SELECT vintage, column AS column_name, l.distinct AS left_distinct, r.distinct AS right_distinct
                        FROM differing_statistics""")


@query("hash_summary", """
SELECT 'orders' AS table_name, (SELECT count(*) FROM c_verdict WHERE NOT is_mismatched) AS clean_columns,
  (SELECT string_agg(col, ', ' ORDER BY key_rank) FROM c_keys) AS key_columns, count(*) AS vintages,
  CAST(sum(hash_mismatch) AS BIGINT) AS mismatches, sum(hash_mismatch) = 0 AS is_match FROM c_p3c""")
def hash_summary(spark, sf):
    pair = pairs.orders_pair(spark, sf)
    verdicts = pair.verdicts()
    # key columns are at most five names; each of the three is one row, also where nothing was compared
    ranked = F.array_sort(F.collect_list(F.struct("key_rank", "column")))
    named = quality.key_columns(verdicts).agg(
        F.when(F.size(ranked) > 0, F.array_join(F.transform(ranked, lambda s: s["column"]), ", ")).alias("key_columns"))
    clean = verdicts.agg(F.count_if(~F.col("is_mismatched")).alias("clean_columns"))
    totals = rowhash.mismatch_totals(pair.hash_check(), [])
    return totals.crossJoin(named).crossJoin(clean).select(
        F.lit("orders").alias("table_name"), "clean_columns", "key_columns", "vintages", *big("mismatches"), "is_match")


@query("hash_details", """
SELECT c.vintage, c.left_rows, c.right_rows, c.matched, c.left_only, c.right_only, c.hash_mismatch, f.is_match AS fingerprint_match,
  substr(f.left_hash, 1, 16) || '...' AS left_digest, substr(f.right_hash, 1, 16) || '...' AS right_digest
FROM c_p3c c JOIN c_vfp f USING (vintage)""")
def hash_details(spark, sf):
    from ..functions.text import render_digest

    pair = pairs.orders_pair(spark, sf)
    prints = pair.fingerprints(by_vintage=True).select(
        "vintage", F.col("is_match").alias("fingerprint_match"), render_digest(F.col("left_hash")).alias("left_digest"),
        render_digest(F.col("right_hash")).alias("right_digest"))
    return pair.hash_check().select("vintage", *big(*_COUNTS)).join(prints, "vintage")


# ---------------------------------------------------------------- whole checks


@query("meta_check", """
SELECT 'orders' AS table_name, vintage, CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date,
  CAST(excluded_days AS BIGINT) AS excluded_days, (SELECT count(*) FROM c_both) AS total_days,
  (SELECT count(*) FROM c_both WHERE n_left = n_right) AS matched_days, (SELECT bool_and(n_left = n_right) FROM c_both) AS all_match,
  6 AS comparable_columns FROM c_vint""")
def meta_check(spark, sf):
    m = pairs.orders_pair(spark, sf).meta()
    return m.select("table_name", "vintage", *text("start_date", "end_date"), *big("excluded_days"), "total_days", "matched_days", "all_match",
                    F.col("comparable_columns").cast("int").alias("comparable_columns"))


@query("column_check", """
SELECT 'orders' AS table_name, v.col AS column_name, v.vintages, v.vintages_mismatched, v.is_mismatched,
  CAST(v.max_distinct AS BIGINT) AS max_distinct, CAST(k.key_rank AS INTEGER) AS key_rank FROM c_verdict v LEFT JOIN c_keys k ON v.col = k.col""")
def column_check(spark, sf):
    return pairs.orders_pair(spark, sf).column_check().withColumnRenamed("column", "column_name")


def _value_lists(side: str) -> str:
    return " UNION ALL ".join(f"SELECT vintage, '{c}' AS col, list_sort(list(coalesce(CAST({c.lower()} AS VARCHAR), '~'))) AS vs FROM c_o{side}s GROUP BY 1" for c in ORDER_NAMES)


PARTS["c_gate"] = f"""SELECT coalesce(l.vintage, r.vintage) AS vintage, coalesce(l.col, r.col) AS col, coalesce(l.vs = r.vs, false) AS is_equal
FROM ({_value_lists('l')}) l FULL OUTER JOIN ({_value_lists('r')}) r ON l.vintage = r.vintage AND l.col = r.col"""


@query("value_gate", "SELECT vintage, col AS column_name, is_equal FROM c_gate")
def value_gate(spark, sf):
    return pairs.orders_pair(spark, sf).value_gate.select("vintage", F.col("column").alias("column_name"), "is_equal")


@query("gated_column_check", """
SELECT col AS column_name, vintages, vintages_mismatched, is_mismatched, NOT g.agreed AS profiled
FROM c_verdict JOIN (SELECT col, bool_and(is_equal) AS agreed FROM c_gate GROUP BY 1) g USING (col)""")
def gated_column_check(spark, sf):
    """The verdicts of the column check, while only columns whose fingerprints differ are profiled."""
    pair = pairs.orders_pair(spark, sf, gated=True)
    profiled = F.col("column").isin([p.name for p in pair._profiled])
    return pair.column_check().select(F.col("column").alias("column_name"), "vintages", "vintages_mismatched", "is_mismatched", profiled.alias("profiled"))


@query("gated_match_rates", "SELECT * FROM c_rate")
def gated_match_rates(spark, sf):
    return pairs.orders_pair(spark, sf, gated=True).match_rates()


@query("hash_check", "SELECT vintage, left_rows, right_rows, matched, left_only, right_only, hash_mismatch FROM c_p3c")
def hash_check(spark, sf):
    return pairs.orders_pair(spark, sf).hash_check().select("vintage", *big(*_COUNTS))


@query("reconcile", """
SELECT 'orders' AS table_name, v.vintage, CAST(v.start_date AS VARCHAR) AS start_date, CAST(v.end_date AS VARCHAR) AS end_date,
  CAST(v.excluded_days AS BIGINT) AS excluded_days, coalesce(r.total_columns, 0) AS total_columns, coalesce(r.matched_columns, 0) AS matched_columns,
  coalesce(r.mismatched_columns, 0) AS mismatched_columns, coalesce(h.left_rows, 0) AS left_rows, coalesce(h.right_rows, 0) AS right_rows,
  coalesce(h.matched, 0) AS matched, coalesce(h.left_only, 0) AS left_only, coalesce(h.right_only, 0) AS right_only,
  coalesce(h.hash_mismatch, 0) AS hash_mismatch,
  CASE WHEN coalesce(h.hash_mismatch, 0) > 0 OR coalesce(h.left_only + h.right_only, 0) > 0 THEN 'ROWS_DIFFER'
       WHEN coalesce(r.mismatched_columns, 0) > 0 THEN 'COLUMNS_DIFFER' WHEN v.excluded_days > 0 THEN 'DAYS_DIFFER' ELSE 'MATCH' END AS status
FROM c_vint v LEFT JOIN c_rate r USING (vintage) LEFT JOIN c_p3c h USING (vintage)""")
def reconcile(spark, sf):
    return pairs.orders_pair(spark, sf).reconcile().select(
        "table_name", "vintage", *text("start_date", "end_date"), *big("excluded_days"), "total_columns", "matched_columns",
        "mismatched_columns", *_COUNTS, "status")


# ---------------------------------------------------------------- what no vintage may hide


def _customers_without_key(spark, sf):
    """Every customer, some lost and some repeated on the right, and no key to tell them by."""
    right = pairs.customer_right(spark, sf).where("cust_id % 31 <> 3")
    right = right.unionByName(right.where("cust_id % 37 = 5"))
    return ReconPair("customer", pairs.customer_left(spark, sf), right, pairs.crosswalk(spark, pairs.CUSTOMER_CROSSWALK), keys=[], hash_all=True)


@query("reconcile_keyless", """
SELECT 'all' AS vintage, l AS left_rows, r AS right_rows, l - lost AS matched, lost AS left_only, again AS right_only, 0 AS hash_mismatch,
  CASE WHEN lost + again > 0 THEN 'ROWS_DIFFER' ELSE 'COLUMNS_DIFFER' END AS status
FROM (SELECT count(*) AS l, count(*) FILTER (WHERE c_custkey % 31 <> 3) + count(*) FILTER (WHERE c_custkey % 31 <> 3 AND c_custkey % 37 = 5) AS r,
        count(*) FILTER (WHERE c_custkey % 31 = 3) AS lost, count(*) FILTER (WHERE c_custkey % 31 <> 3 AND c_custkey % 37 = 5) AS again FROM customer)""")
def reconcile_keyless(spark, sf):
    return _customers_without_key(spark, sf).reconcile().select("vintage", *_COUNTS, "status")


def _orders_with(spark, sf, left=lambda df: df, right=lambda df: df):
    return ReconPair("orders", left(pairs.orders_left(spark, sf)), right(pairs.orders_right(spark, sf)), pairs.crosswalk(spark, pairs.ORDERS_CROSSWALK),
                     "ORDER_DT", "order_dt", partition="month", keys=["ORDER_ID"], hash_all=True)


_BOTH_BY_MONTH = """
SELECT coalesce(l.vintage, r.vintage) AS vintage, coalesce(l.n, 0) AS day_rows_left, coalesce(r.n, 0) AS day_rows_right
FROM ({left}) l FULL OUTER JOIN ({right}) r ON l.vintage = r.vintage"""


def _by_month(table, day="order_dt", where="true"):
    return f"SELECT coalesce({month(day)}, 'null_date') AS vintage, count(*) AS n FROM {table} WHERE {where} GROUP BY 1"


PARTS["c_js"] = full_compare("c_olsh", "c_orsh")
PARTS["c_status"] = """
SELECT vintage, excluded_days, coalesce(r.mismatched_columns, 0) AS mismatched_columns, coalesce(h.matched, 0) AS matched, coalesce(h.hash_mismatch, 0) AS hash_mismatch,
  CASE WHEN coalesce(h.hash_mismatch, 0) > 0 OR coalesce(h.one_sided, 0) > 0 THEN 'ROWS_DIFFER' WHEN coalesce(r.mismatched_columns, 0) > 0 THEN 'COLUMNS_DIFFER'
       WHEN excluded_days > 0 THEN 'DAYS_DIFFER' ELSE 'MATCH' END AS status
FROM c_vint LEFT JOIN c_rate r USING (vintage) LEFT JOIN (SELECT vintage, count(*) FILTER (WHERE status = 'matched') AS matched,
  count(*) FILTER (WHERE status = 'hash_mismatch') AS hash_mismatch, count(*) FILTER (WHERE status IN ('left_only', 'right_only')) AS one_sided FROM c_js GROUP BY 1) h USING (vintage)"""


@query("reconcile_one_sided_months", "SELECT vintage, day_rows_left, day_rows_right, CASE WHEN day_rows_right = 0 THEN 'LEFT_ONLY' "
       "WHEN day_rows_left = 0 THEN 'RIGHT_ONLY' ELSE status END AS status FROM (" + _BOTH_BY_MONTH.format(
           left=_by_month("c_ol", where="month(order_dt) % 6 <> 1"), right=_by_month("c_or", where="month(order_dt) % 6 <> 4")) + ") JOIN c_status USING (vintage)")
def reconcile_one_sided_months(spark, sf):
    pair = _orders_with(spark, sf, lambda df: df.where("month(ORDER_DT) % 6 <> 1"),
                        lambda df: df.where("cast(substring(order_dt, 5, 2) as int) % 6 <> 4"))
    return pair.reconcile().where("day_rows_left + day_rows_right > 0").select("vintage", "day_rows_left", "day_rows_right", "status")


@query("reconcile_null_dates", "SELECT vintage, day_rows_left, day_rows_right, vintage = 'null_date' AS undated FROM (" + _BOTH_BY_MONTH.format(
    left=_by_month("c_ol", "CASE WHEN order_id % 97 <> 0 THEN order_dt END"),
    right=_by_month("c_or", "CASE WHEN order_id % 89 <> 0 THEN order_dt END")) + ")")
def reconcile_null_dates(spark, sf):
    pair = _orders_with(spark, sf, lambda df: df.withColumn("ORDER_DT", F.when(~pairs.every("ORDER_ID", 97), F.col("ORDER_DT"))),
                        lambda df: df.withColumn("order_dt", F.when(~pairs.every("order_id", 89), F.col("order_dt")).otherwise("not known")))
    found = pair.reconcile().where("day_rows_left + day_rows_right > 0")
    return found.select("vintage", "day_rows_left", "day_rows_right", (F.col("status") == "NULL_DATES").alias("undated"))


@query("reconcile_mixed_formats", "SELECT vintage, day_rows_left, day_rows_right, excluded_days, mismatched_columns, matched, hash_mismatch, status FROM ("
       + _BOTH_BY_MONTH.format(left=_by_month("c_ol"), right=_by_month("c_or")) + ") JOIN c_status USING (vintage) WHERE vintage BETWEEN 'M199602' AND 'M199711'")
def reconcile_mixed_formats(spark, sf):
    """Dates in three notations on the right, in a window of whole months: as if all were written alike."""
    pair = ReconPair("orders", pairs.orders_left(spark, sf), pairs.orders_mixed(spark, sf), pairs.crosswalk(spark, pairs.ORDERS_CROSSWALK), "ORDER_DT", "order_dt",
                     partition="month", start="1996-02-01", end="1997-11-30", keys=["ORDER_ID"], hash_all=True)
    return pair.reconcile().select("vintage", "day_rows_left", "day_rows_right", *big("excluded_days"), "mismatched_columns", *big("matched", "hash_mismatch"), "status")


WIDE_KEY = "9007199254740993 + {key}"


def _wide_pair(spark, sf, left, right):
    """Parts under another key: an expression over ``p_partkey`` for each side."""
    part = pairs.table(spark, sf, "part")
    sides = part.selectExpr(f"{left} AS ID", "p_brand AS BRAND"), part.selectExpr(f"{right} AS id", "p_brand AS brand")
    return ReconPair("wide", *sides, pairs.crosswalk(spark, [("ID", "id", None), ("BRAND", "brand", None)]), keys=["ID"], hash_all=True)


def _all_parts(status):
    return f"""SELECT count(*) AS left_rows, count(*) AS right_rows, count(*) AS matched, 0 AS left_only, 0 AS right_only, 0 AS hash_mismatch,
  2 AS matched_columns, '{status}' AS status FROM part"""


@query("reconcile_wide_keys", _all_parts("MATCH"))
def reconcile_wide_keys(spark, sf):
    """Neighbouring 17-digit keys: a decimal against text, which a DOUBLE could not tell apart."""
    key = WIDE_KEY.format(key="p_partkey")
    return _wide_pair(spark, sf, f"cast({key} as decimal(19,0))", f"cast({key} as string)").reconcile().select(*_COUNTS, "matched_columns", "status")


@query("reconcile_long_keys", _all_parts("MATCH"))
def reconcile_long_keys(spark, sf):
    """Keys of 38 digits, a decimal against text with leading zeros: no common decimal has room for both sides' digits."""
    key = "repeat('9', 30) || lpad(p_partkey, 8, '0')"
    return _wide_pair(spark, sf, f"cast({key} as decimal(38,0))", f"'+00' || {key}").reconcile().select(*_COUNTS, "matched_columns", "status")


@query("hash_check_text_keys", """
SELECT count(*) AS left_rows, count(*) AS right_rows, count(*) FILTER (WHERE p_partkey % 3 <> 0) AS matched, count(*) FILTER (WHERE p_partkey % 3 = 0) AS left_only,
  count(*) FILTER (WHERE p_partkey % 3 = 0) AS right_only, 0 AS hash_mismatch FROM part""")
def hash_check_text_keys(spark, sf):
    """Every third key is no number on the right: such keys stay apart from each other and meet nothing."""
    pair = _wide_pair(spark, sf, "p_partkey", "if(p_partkey % 3 = 0, 'no. ' || p_partkey, p_partkey || '.0')")
    return pair.hash_check().select(*big(*_COUNTS))
