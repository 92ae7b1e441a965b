"""Filters, joins, sets and counts of the meta check."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates
from ..operators import crosswalk as cw, daycounts, filters, reports
from ..operators.crosswalk import COMPARABLE
from ..sources import controls
from . import pairs
from .derived import derive
from .registry import query
from .shape import big, text
from .sqlparts import ORDER_NAMES, PARTS, month, order_norms

# ---------------------------------------------------------------- filters


@query("filter_date_inclusive", """
SELECT order_id, order_dt_text AS order_dt FROM c_or
WHERE order_dt BETWEEN DATE '1996-02-01' AND DATE '1997-11-30' AND price > 1000""")
def filter_date_inclusive(spark, sf):
    kept = filters.in_window(pairs.orders_right(spark, sf), "order_dt", "1996-02-01", "1997-11-30", "price > 1000", dates.COMPACT)
    return kept.select("order_id", "order_dt")


@query("filter_date_mixed", """
SELECT order_id FROM c_or WHERE order_dt BETWEEN DATE '1996-02-01' AND DATE '1997-11-30'""")
def filter_date_mixed(spark, sf):
    """A window over text dates in three notations, of which one is the column's main format."""
    return filters.in_window(pairs.orders_mixed(spark, sf), "order_dt", "1996-02-01", "1997-11-30", fmt=dates.COMPACT).select("order_id")


@query("filter_date_halfopen", """
SELECT event_id, 'native' AS kind FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20'
UNION ALL
SELECT event_id, 'text' FROM c_er WHERE ts >= '2024-01-05' AND ts < '2024-01-20'""")
def filter_date_halfopen(spark, sf):
    window = lambda df, column, fmt=None: filters.in_window(df, column, "2024-01-05", "2024-01-20", fmt=fmt, half_open=True)
    native = window(pairs.table(spark, sf, "events"), "ts").select("event_id", F.lit("native").alias("kind"))
    written = window(pairs.events_right(spark, sf), "ts", dates.ISO_TIME).select("event_id", F.lit("text").alias("kind"))
    return native.unionByName(written)


def _day_counts(spark, sf):
    left, right = pairs.orders_left(spark, sf), pairs.orders_right(spark, sf)
    return (daycounts.row_counts(left, filters.day_column(left, "ORDER_DT")),
            daycounts.row_counts(right, filters.day_column(right, "order_dt", dates.COMPACT)))


@query("filter_exclude_dates", """
SELECT order_id, order_dt_text AS order_dt FROM c_or
WHERE order_dt NOT IN (SELECT d FROM c_both WHERE n_left <> n_right)""")
def filter_exclude_dates(spark, sf):
    bad = daycounts.both_counts(*_day_counts(spark, sf)).where("n_left <> n_right")
    return filters.without_days(pairs.orders_right(spark, sf), "order_dt", bad, dates.COMPACT).select("order_id", "order_dt")


@query("filter_scalar_subquery", """
SELECT order_id, cust_id FROM c_ol WHERE order_dt = (SELECT max(order_dt) FROM c_or)""")
def filter_scalar_subquery(spark, sf):
    right = pairs.orders_right(spark, sf)
    latest = right.select(F.max(filters.day_column(right, "order_dt", dates.COMPACT))).scalar()
    return filters.equals_scalar(pairs.orders_left(spark, sf), "ORDER_DT", latest).select(
        F.col("ORDER_ID").alias("order_id"), F.col("CUST_ID").alias("cust_id"))


@query("extract_cast_strings", """
SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(price AS VARCHAR) AS price, CAST(order_dt AS VARCHAR) AS order_dt,
       coalesce(priority, 'NULL') AS priority FROM c_ol""")
def extract_cast_strings(spark, sf):
    left = pairs.orders_left(spark, sf)
    return filters.as_extract(left, ["ORDER_ID", "PRICE", "ORDER_DT", "PRIORITY"]).toDF("order_id", "price", "order_dt", "priority")


@query("vintage_predicate", f"""
SELECT order_id, {month('order_dt')} AS vintage FROM c_ol
WHERE status = 'F' AND order_dt BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'
  AND order_dt NOT IN (SELECT d FROM c_both WHERE n_left <> n_right)""")
def vintage_predicate(spark, sf):
    scope = daycounts.scope_days(daycounts.both_counts(*_day_counts(spark, sf)), "month")
    left = filters.in_window(pairs.orders_left(spark, sf), "ORDER_DT", "1997-01-01", "1998-12-31", "STATUS = 'F'")
    return filters.in_scope(left, F.col("ORDER_DT"), scope).select(F.col("ORDER_ID").alias("order_id"), "vintage")


@query("scope_by_status", """
SELECT p_partkey AS pair_id, CASE WHEN p_partkey % 19 = 0 THEN 'no_meta_results' WHEN p_partkey % 7 = 0 OR p_partkey % 5 = 0
  THEN 'not_accessible' WHEN p_size % 10 = 0 THEN 'no_comparable_columns' ELSE 'ready' END AS status FROM part""")
def scope_by_status(spark, sf):
    p = pairs.table(spark, sf, "part").select(
        F.col("p_partkey").alias("pair_id"), (F.col("p_partkey") % 19 != 0).alias("has_meta"),
        F.when(F.col("p_partkey") % 7 != 0, F.lit(True)).alias("left_accessible"),
        (F.col("p_partkey") % 5 != 0).alias("right_accessible"), (F.col("p_size") % 10).alias("comparable_columns"))
    return filters.scope_status(p).select("pair_id", "status")


@query("common_view_filters", """
SELECT 'nightly' AS run_name, CAST(d AS VARCHAR) AS day, n_left, n_right, n_left = n_right AS has_match
FROM c_both WHERE n_left <> n_right""")
def common_view_filters(spark, sf):
    both = daycounts.both_counts(*_day_counts(spark, sf)).withColumn("has_match", F.col("n_left") == F.col("n_right"))
    runs = both.withColumn("run_name", F.explode(F.array(F.lit("nightly"), F.lit("adhoc"))))
    return reports.of_run(runs, "nightly", only_mismatches=True).select("run_name", *text("day"), "n_left", "n_right", "has_match")


# ---------------------------------------------------------------- counts


@query("row_count_by_day", """
SELECT coalesce(CAST(CASE WHEN order_id % 29 <> 0 THEN order_dt END AS VARCHAR), 'null_date') AS day, count(*) AS n
FROM c_or GROUP BY 1""")
def row_count_by_day(spark, sf):
    right = pairs.orders_right(spark, sf)
    day = filters.day_column(right, "order_dt", dates.COMPACT)
    holed = F.when(F.col("order_id") % 29 != 0, day)
    return daycounts.row_counts(right, holed).select(
        F.coalesce(F.col("day").cast("string"), F.lit(daycounts.NULL_DATE)).alias("day"), "n")


@query("row_count_total", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS n FROM {c}" for n, c in (
        ("orders_left", "c_ol"), ("orders_right", "c_or"), ("lineitem_left", "c_ll"), ("lineitem_right", "c_lr"),
        ("events_right", "c_er"), ("customer", "customer"))))
def row_count_total(spark, sf):
    tables = {"orders_left": pairs.orders_left, "orders_right": pairs.orders_right, "lineitem_left": pairs.lineitem_left,
              "lineitem_right": pairs.lineitem_right, "events_right": pairs.events_right, "customer": pairs.customer_left}
    out = None
    for name, make in tables.items():
        one = daycounts.total_rows(make(spark, sf)).select(F.lit(name).alias("table_name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("date_bounds", """
SELECT 'left' AS side, CAST(min(d) AS VARCHAR) AS min_day, CAST(max(d) AS VARCHAR) AS max_day FROM c_dl
UNION ALL SELECT 'right', CAST(min(d) AS VARCHAR), CAST(max(d) AS VARCHAR) FROM c_dr
UNION ALL SELECT 'no_dates', NULL, NULL""")
def date_bounds(spark, sf):
    left, right = _day_counts(spark, sf)
    none = left.select(F.lit(None).cast("date").alias("day"), "n")
    out = None
    for name, counts in (("left", left), ("right", right), ("no_dates", none)):
        one = daycounts.bounds(counts).select(F.lit(name).alias("side"), *text("min_day", "max_day"))
        out = one if out is None else out.unionByName(one)
    return out


@query("distinct_days", "SELECT DISTINCT CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events WHERE event_id % 41 <> 0")
def distinct_days(spark, sf):
    e = pairs.table(spark, sf, "events")
    day = F.when(F.col("event_id") % 41 != 0, F.col("ts").cast("date"))
    return daycounts.distinct_days(e, day).select(*text("day"))


@query("day_match_summary", """
SELECT count(*) AS total_days, count(*) FILTER (WHERE n_left = n_right) AS matched_days,
       count(*) FILTER (WHERE n_left <> n_right) AS unmatched_days, bool_and(n_left = n_right) AS all_match FROM c_both""")
def day_match_summary(spark, sf):
    return daycounts.match_summary(daycounts.both_counts(*_day_counts(spark, sf)))


@query("counts_desc", "SELECT CAST(d AS VARCHAR) AS day, n FROM c_dl ORDER BY d DESC")
def counts_desc(spark, sf):
    return _day_counts(spark, sf)[0].orderBy(F.col("day").desc()).select(*text("day"), "n")


# ---------------------------------------------------------------- joins of days


@query("daycount_full_outer", """
SELECT CAST(d AS VARCHAR) AS day, CAST(n_left AS BIGINT) AS n_left, CAST(n_right AS BIGINT) AS n_right,
       n_left <> n_right AS is_mismatch FROM c_both""")
def daycount_full_outer(spark, sf):
    both = daycounts.both_counts(*_day_counts(spark, sf))
    return both.select(*text("day"), "n_left", "n_right", (F.col("n_left") != F.col("n_right")).alias("is_mismatch"))


@query("daycount_inner", """
SELECT CAST(l.d AS VARCHAR) AS day, l.n AS n_left, r.n AS n_right, l.n - r.n AS diff
FROM c_dl l JOIN c_dr r ON l.d = r.d WHERE l.n <> r.n""")
def daycount_inner(spark, sf):
    return daycounts.common_mismatches(*_day_counts(spark, sf)).select(*text("day"), "n_left", "n_right", "diff")


def _with_lost_days(spark, sf):
    """Day counts of the pair after each side lost whole days of every row: other days on either side."""
    left, right = pairs.orders_left(spark, sf), pairs.orders_right(spark, sf)
    right_day = filters.day_column(right, "order_dt", dates.COMPACT)
    left, right = left.where("NOT dayofyear(ORDER_DT) % 11 = 3"), right.where(~(F.dayofyear(right_day) % 13 == 5))
    return daycounts.row_counts(left, F.col("ORDER_DT")), daycounts.row_counts(right, right_day)


@query("days_left_only", """
SELECT CAST(d AS VARCHAR) AS day FROM c_dl WHERE NOT (dayofyear(d) % 11 = 3) AND d NOT IN (SELECT d FROM c_dr WHERE NOT (dayofyear(d) % 13 = 5))""")
def days_left_only(spark, sf):
    left, right = _with_lost_days(spark, sf)
    return daycounts.only_left(left, right).select(*text("day")).orderBy("day")


@query("days_right_only", """
SELECT CAST(d AS VARCHAR) AS day FROM c_dr WHERE NOT (dayofyear(d) % 13 = 5) AND d NOT IN (SELECT d FROM c_dl WHERE NOT (dayofyear(d) % 11 = 3))""")
def days_right_only(spark, sf):
    left, right = _with_lost_days(spark, sf)
    return daycounts.only_left(right, left).select(*text("day")).orderBy("day")


@query("vintage_pair_join", """
SELECT vintage, CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date,
       CAST(excluded_days AS BIGINT) AS excluded_days FROM c_vint""")
def vintage_pair_join(spark, sf):
    left, right = _day_counts(spark, sf)
    windows = lambda counts: dates.windows(daycounts.bounds(counts), "month")
    joined = daycounts.paired_windows(windows(left), windows(right), daycounts.both_counts(left, right), "month")
    return joined.select("vintage", *text("start_date", "end_date"), *big("excluded_days"))


@query("days_in_vintage_range", """
SELECT w.vintage, count(*) AS n_days, count(*) FILTER (WHERE b.n_left <> b.n_right) AS excluded_days
FROM c_both b JOIN c_wl w ON b.d BETWEEN w.start_date AND w.end_date GROUP BY 1""")
def days_in_vintage_range(spark, sf):
    left, right = _day_counts(spark, sf)
    days = daycounts.both_counts(left, right)
    inside = daycounts.days_in_windows(days, dates.windows(daycounts.bounds(left), "month"), "month")
    return inside.groupBy("vintage").agg(
        F.count(F.lit(1)).alias("n_days"), F.count_if(F.col("n_left") != F.col("n_right")).alias("excluded_days"))


# ---------------------------------------------------------------- sets of days


@query("days_union", "SELECT CAST(d AS VARCHAR) AS day FROM c_dl UNION SELECT CAST(d AS VARCHAR) FROM c_dr")
def days_union(spark, sf):
    left, right = _day_counts(spark, sf)
    return left.select("day").union(right.select("day")).distinct().select(*text("day"))


@query("days_intersect", "SELECT CAST(d AS VARCHAR) AS day FROM c_dl INTERSECT SELECT CAST(d AS VARCHAR) FROM c_dr")
def days_intersect(spark, sf):
    left, right = _day_counts(spark, sf)
    return left.select("day").intersect(right.select("day")).select(*text("day"))


@query("days_except", """
SELECT 'left' AS side, CAST(d AS VARCHAR) AS day FROM (SELECT d FROM c_dl WHERE NOT (dayofyear(d) % 11 = 3) EXCEPT SELECT d FROM c_dr WHERE NOT (dayofyear(d) % 13 = 5))
UNION ALL SELECT 'right', CAST(d AS VARCHAR) FROM (SELECT d FROM c_dr WHERE NOT (dayofyear(d) % 13 = 5) EXCEPT SELECT d FROM c_dl WHERE NOT (dayofyear(d) % 11 = 3))""")
def days_except(spark, sf):
    left, right = (counts.select("day") for counts in _with_lost_days(spark, sf))
    one = lambda name, df: df.select(F.lit(name).alias("side"), *text("day"))
    return one("left", left.subtract(right)).unionByName(one("right", right.subtract(left)))


@query("vintages_intersect", f"""
SELECT DISTINCT {month('d')} AS vintage FROM c_dl INTERSECT SELECT DISTINCT {month('d')} FROM c_dr""")
def vintages_intersect(spark, sf):
    left, right = _day_counts(spark, sf)
    labels = lambda counts: counts.select(dates.vintage_label(F.col("day"), "month").alias("vintage"))
    return labels(left).intersect(labels(right))


@query("sorted_lists", f"""
SELECT {month('d')} AS vintage, string_agg(CAST(d AS VARCHAR), ',' ORDER BY d) AS unequal_days, count(*) AS n
FROM c_both WHERE n_left <> n_right GROUP BY 1""")
def sorted_lists(spark, sf):
    bad = daycounts.both_counts(*_day_counts(spark, sf)).where("n_left <> n_right")
    label = dates.vintage_label(F.col("day"), "month").alias("vintage")
    # at most 31 days a month: the list is bounded by the calendar
    return bad.groupBy(label).agg(
        F.array_join(F.array_sort(F.collect_set(F.col("day").cast("string"))), ",").alias("unequal_days"),
        F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- crosswalks over a catalogue estate

PARTS["c_xe"] = """
SELECT lower(col_map) AS col_map, upper(trim(left_col)) AS l, lower(trim(right_col)) AS r, is_tokenized AS t, ord FROM c_xw"""
PARTS["c_catl_u"] = "SELECT DISTINCT lower(col_map) AS col_map, upper(trim(column_name)) AS c FROM c_catl"
PARTS["c_catr_u"] = "SELECT DISTINCT lower(col_map) AS col_map, lower(trim(column_name)) AS c FROM c_catr"
_NONE = "('', 'nat', 'nan', 'none', 'null')"
PARTS["c_xl"] = f"""
SELECT col_map, l AS c, arg_max(t, ord) AS t, arg_max(r IS NOT NULL AND r NOT IN {_NONE}, ord) AS has_other FROM c_xe GROUP BY 1, 2"""
PARTS["c_xr"] = f"""
SELECT col_map, r AS c, arg_max(t, ord) AS t, arg_max(l IS NOT NULL AND lower(l) NOT IN {_NONE}, ord) AS has_other
FROM c_xe WHERE r IS NOT NULL GROUP BY 1, 2"""
for _s, _only in (("l", "left_only"), ("r", "right_only")):
    PARTS[f"c_class{_s}"] = f"""
SELECT a.col_map, a.c, CASE WHEN x.c IS NULL THEN 'unmapped' WHEN x.t THEN 'tokenized' WHEN x.has_other THEN 'comparable'
  ELSE '{_only}' END AS class FROM c_cat{_s}_u a LEFT JOIN c_x{_s} x ON a.col_map = x.col_map AND a.c = x.c"""
PARTS["c_mapping"] = f"""
SELECT col_map, l, arg_max(r, ord) AS r FROM c_xe
WHERE NOT t AND r IS NOT NULL AND r NOT IN {_NONE} AND lower(l) NOT IN {_NONE}
  AND (col_map, l) IN (SELECT (col_map, c) FROM c_classl WHERE class = 'comparable')
  AND (col_map, r) IN (SELECT (col_map, c) FROM c_classr WHERE class = 'comparable')
GROUP BY 1, 2"""
PARTS["c_doc"] = f"""
SELECT col_map, l, arg_max(r, ord) AS r, bool_or(t) AS t FROM c_xe
WHERE r IS NOT NULL AND r NOT IN {_NONE} AND lower(l) NOT IN {_NONE} GROUP BY 1, 2"""
PARTS["c_typl"] = "SELECT lower(col_map) AS col_map, upper(trim(column_name)) AS l, max(data_type) AS lt FROM c_catl GROUP BY 1, 2"
PARTS["c_typr"] = "SELECT lower(col_map) AS col_map, lower(trim(column_name)) AS r, max(data_type) AS rt FROM c_catr GROUP BY 1, 2"
PARTS["c_typed"] = """
SELECT d.col_map, 'comparable' AS section, d.l AS left_col, d.r AS right_col, lt AS left_type, rt AS right_type,
  NOT CASE WHEN lt LIKE 'NUMBER%' THEN rt IN ('double', 'decimal(10,2)', 'bigint') WHEN lt LIKE 'VARCHAR%' THEN rt = 'string'
       WHEN lt = 'DATE' THEN rt IN ('date', 'timestamp') WHEN lt LIKE 'TIMESTAMP%' THEN rt = 'timestamp' ELSE false END AS type_mismatch
FROM c_doc d JOIN c_typl a ON d.col_map = a.col_map AND d.l = a.l JOIN c_typr b ON d.col_map = b.col_map AND d.r = b.r WHERE NOT d.t
UNION ALL SELECT d.col_map, 'tokenized', d.l, NULL, lt, NULL, false FROM c_doc d JOIN c_typl a ON d.col_map = a.col_map AND d.l = a.l WHERE d.t
UNION ALL SELECT col_map, 'left_only', l, NULL, lt, NULL, false FROM c_typl WHERE (col_map, l) NOT IN (SELECT (col_map, l) FROM c_doc)
UNION ALL SELECT col_map, 'right_only', NULL, r, NULL, rt, false FROM c_typr WHERE (col_map, r) NOT IN (SELECT (col_map, r) FROM c_doc)"""


def _estate(spark, sf):
    return derive(spark, sf, "c_catl"), derive(spark, sf, "c_catr"), derive(spark, sf, "c_xw")


@query("crosswalk_classify_left", "SELECT col_map, c AS column_name, class FROM c_classl")
def crosswalk_classify_left(spark, sf):
    left, _, xw = _estate(spark, sf)
    return cw.classify(left, xw, "left")


@query("crosswalk_classify_right", "SELECT col_map, c AS column_name, class FROM c_classr")
def crosswalk_classify_right(spark, sf):
    _, right, xw = _estate(spark, sf)
    return cw.classify(right, xw, "right")


@query("column_mapping", "SELECT col_map, l AS left_col, r AS right_col FROM c_mapping")
def column_mapping(spark, sf):
    left, right, xw = _estate(spark, sf)
    return cw.column_mapping(cw.classify(left, xw, "left"), cw.classify(right, xw, "right"), xw)


@query("column_mapping_gaps", """
SELECT 'left' AS side, col_map, c AS column_name FROM c_classl WHERE class = 'comparable' AND (col_map, c) NOT IN (SELECT (col_map, l) FROM c_mapping)
UNION ALL SELECT 'right', col_map, c FROM c_classr WHERE class = 'comparable' AND (col_map, c) NOT IN (SELECT (col_map, r) FROM c_mapping)""")
def column_mapping_gaps(spark, sf):
    """Comparable columns that the mapping leaves out, on both sides."""
    left, right, xw = _estate(spark, sf)
    classes = {"left": cw.classify(left, xw, "left"), "right": cw.classify(right, xw, "right")}
    mapping = cw.column_mapping(classes["left"], classes["right"], xw)
    gaps = lambda side: cw.unmapped_comparable(classes[side], mapping, side).select(
        F.lit(side).alias("side"), "col_map", F.col(f"{side}_col").alias("column_name"))
    return gaps("left").unionByName(gaps("right"))


@query("column_mapping_typed", "SELECT * FROM c_typed")
def column_mapping_typed(spark, sf):
    return cw.typed_mapping(*_estate(spark, sf))


@query("crosswalk_semi", r"""
SELECT ord, left_col FROM c_xw WHERE lower(col_map) IN (
  SELECT lower(coalesce(trim(col_map), split_part(lower(trim(regexp_replace(left_tbl, '\(.*\)', ''))), '.', -1)))
  FROM c_pairs_raw WHERE regexp_full_match(trim(right_tbl), '[^.]+\.[^.]+') AND regexp_matches(enabled, '(?i)\b(yes|y)\b'))""")
def crosswalk_semi(spark, sf):
    read = controls.read_pairs(derive(spark, sf, "c_pairs_raw"), rename={"unit": "partition"})
    return cw.used_by_pairs(derive(spark, sf, "c_xw"), read).select("ord", "left_col")


@query("columns_only", """
SELECT 'left' AS side, col_map, left_col AS column_name FROM c_typed WHERE section = 'left_only'
UNION ALL SELECT 'right', col_map, right_col FROM c_typed WHERE section = 'right_only'""")
def columns_only(spark, sf):
    left, right, xw = _estate(spark, sf)
    pairs_ = cw.documented(xw)
    actual = lambda cat, spell: cat.select(F.lower("col_map").alias("col_map"), spell(F.trim("column_name")).alias("column_name"))
    only_left = actual(left, F.upper).subtract(pairs_.select("col_map", "left_col"))
    only_right = actual(right, F.lower).subtract(pairs_.select("col_map", "right_col"))
    tag = lambda df, side: df.select(F.lit(side).alias("side"), "col_map", "column_name")
    return tag(only_left, "left").unionByName(tag(only_right, "right"))


@query("columns_unmapped", """
SELECT 'left' AS side, col_map, c AS column_name FROM c_classl WHERE class = 'unmapped'
UNION ALL SELECT 'right', col_map, c FROM c_classr WHERE class = 'unmapped'""")
def columns_unmapped(spark, sf):
    left, right, xw = _estate(spark, sf)
    def rest(cat, side, spell, mine):
        actual = cat.select(F.lower("col_map").alias("col_map"), spell(F.trim("column_name")).alias("column_name"))
        listed = xw.select(F.lower("col_map").alias("col_map"), spell(F.trim(mine)).alias("column_name"))
        return actual.subtract(listed).select(F.lit(side).alias("side"), "col_map", "column_name")
    return rest(left, "left", F.upper, "left_col").unionByName(rest(right, "right", F.lower, "right_col"))


@query("tokenized_existing", "SELECT col_map, left_col AS column_name FROM c_typed WHERE section = 'tokenized'")
def tokenized_existing(spark, sf):
    left, _, xw = _estate(spark, sf)
    tokenized = cw.documented(xw).where("is_tokenized").select("col_map", F.col("left_col").alias("column_name"))
    actual = left.select(F.lower("col_map").alias("col_map"), F.upper(F.trim("column_name")).alias("column_name"))
    return tokenized.intersect(actual)


@query("crosswalk_counts", """
SELECT 'left' AS side, col_map, class, count(*) AS n FROM c_classl GROUP BY ALL
UNION ALL SELECT 'right', col_map, class, count(*) FROM c_classr GROUP BY ALL""")
def crosswalk_counts(spark, sf):
    left, right, xw = _estate(spark, sf)
    one = lambda cat, side: cw.class_counts(cw.classify(cat, xw, side)).select(F.lit(side).alias("side"), "*")
    return one(left, "left").unionByName(one(right, "right"))


@query("crosswalk_pivot", """
SELECT col_map, count(*) FILTER (WHERE class = 'comparable') AS comparable, count(*) FILTER (WHERE class = 'tokenized') AS tokenized,
  count(*) FILTER (WHERE class = 'left_only') AS left_only, count(*) FILTER (WHERE class = 'unmapped') AS unmapped
FROM c_classl GROUP BY 1""")
def crosswalk_pivot(spark, sf):
    left, _, xw = _estate(spark, sf)
    return cw.pivot_classes(cw.classify(left, xw, "left"), "left").select(
        "col_map", *big(COMPARABLE, "tokenized", "left_only", "unmapped"))


# ---------------------------------------------------------------- pair metadata


@query("pair_meta_lookup", r"""
SELECT CAST(m.id AS BIGINT) AS pair_id, trim(p.right_tbl) AS right_tbl, coalesce(trim(p.unit), 'all') AS unit,
  CASE WHEN p.pair_id IS NULL THEN 'not in the pair list' WHEN NOT coalesce(regexp_matches(p.enabled, '(?i)\b(yes|y)\b'), false)
       THEN 'disabled' END AS excluded_reason
FROM (SELECT p_partkey AS id FROM part) m
LEFT JOIN (SELECT * FROM c_pairs_raw WHERE regexp_full_match(trim(right_tbl), '[^.]+\.[^.]+')) p ON p.pair_id = m.id""")
def pair_meta_lookup(spark, sf):
    done = pairs.table(spark, sf, "part").select(F.col("p_partkey").alias("pair_id"))
    listed = controls.read_pairs(derive(spark, sf, "c_pairs_raw"), rename={"unit": "partition"}).withColumn("listed", F.lit(True))
    return done.join(listed, "pair_id", "left").select(
        "pair_id", "right_tbl", F.coalesce("partition", F.lit("all")).alias("unit"),
        F.when(F.col("listed").isNull(), "not in the pair list").when(~F.col("enabled"), "disabled").alias("excluded_reason"))


# ---------------------------------------------------------------- views and layout


@query("row_meta_view", f"""
SELECT {month('d')} AS vintage, CAST(sum(n_left) AS BIGINT) AS left_rows, CAST(sum(n_right) AS BIGINT) AS right_rows,
  bool_and(n_left = n_right) AS has_match FROM c_both GROUP BY 1""")
def row_meta_view(spark, sf):
    both = daycounts.both_counts(*_day_counts(spark, sf))
    reports.register_views({"day_count_comparison": both.withColumn("vintage", dates.vintage_label(F.col("day"), "month"))})
    return spark.sql("""
        SELECT vintage, sum(n_left) AS left_rows, sum(n_right) AS right_rows, bool_and(n_left = n_right) AS has_match
        FROM day_count_comparison GROUP BY vintage""")


@query("canonical_order", f"""
SELECT {', '.join(f'{n} AS {c.lower()}' for n, c in zip(order_norms(), ORDER_NAMES))} FROM c_ol""")
def canonical_order(spark, sf):
    pair_columns = pairs.orders_pair(spark, sf).columns
    left = pairs.orders_left(spark, sf)
    rest = sorted(p.name for p in pair_columns if p.name != "ORDER_DT")
    return left.select(*[p.normal(left, "left").alias(p.name.lower()) for p in pair_columns]).orderBy(
        "order_dt", *[c.lower() for c in rest])


@query("null_date_scope", """
SELECT CAST(count(*) FILTER (WHERE order_id % 29 <> 0) AS BIGINT) AS dated, CAST(count(*) FILTER (WHERE order_id % 29 = 0) AS BIGINT) AS null_date
FROM c_ol""")
def null_date_scope(spark, sf):
    left = pairs.orders_left(spark, sf)
    counts = daycounts.row_counts(left, F.when(F.col("ORDER_ID") % 29 != 0, F.col("ORDER_DT")))
    return counts.agg(
        F.sum(F.when(F.col("day").isNotNull(), F.col("n"))).alias("dated"),
        F.sum(F.when(F.col("day").isNull(), F.col("n"))).alias("null_date")).select(*big("dated", "null_date"))
