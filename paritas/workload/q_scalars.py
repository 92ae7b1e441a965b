"""Dates, normalisation, hashes and comparers, each over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from ..functions import compare, dates, hashing, normalize
from ..operators import daycounts, profile, rowhash
from . import pairs
from .derived import derive
from .registry import query
from .shape import text
from .sqlparts import (DATELIKE, ORDER_NAMES, PARTS, day, flexible, month, n_dbl, n_int, n_label, n_text, order_norms,
                       robust, row_text, strict_date, tolerance, week, year)

# ---------------------------------------------------------------- dates


@query("parse_date_std", "SELECT id, CASE WHEN id % 10 IN (8, 9) THEN NULL ELSE CAST(d AS VARCHAR) END AS day FROM c_dates "
       "WHERE id % 10 <> 3 AND id % 10 <> 7 UNION ALL SELECT id, CAST(d AS VARCHAR) FROM c_dates WHERE id % 10 = 3 "
       "UNION ALL SELECT id, CASE WHEN day(d) > 12 THEN CAST(d AS VARCHAR) ELSE strftime(d, '%Y-%d-%m') END FROM c_dates WHERE id % 10 = 7")
def parse_date_std(spark, sf):
    return derive(spark, sf, "c_dates").select("id", dates.parse_any(F.col("s")).cast("string").alias("day"))


@query("detect_date_format", """
SELECT kind, fmt, n, round(n / sum(n) OVER (), 6) AS share FROM (
  SELECT CASE WHEN id % 10 IN (0, 1, 2, 5, 9) THEN 'string' ELSE 'unknown' END AS kind,
    CASE id % 10 WHEN 0 THEN 'yyyy-MM-dd' WHEN 1 THEN 'yyyyMMdd' WHEN 2 THEN 'yyyy/MM/dd' WHEN 5 THEN 'yyyy-MM-dd HH:mm:ss'
         WHEN 9 THEN 'yyyyMMdd' END AS fmt, count(*) AS n FROM c_dates GROUP BY 1, 2)
UNION ALL SELECT 'date', NULL, count(*), 1.0 FROM orders""")
def detect_date_format(spark, sf):
    written = dates.format_profile(derive(spark, sf, "c_dates"), "s")
    native = dates.format_profile(pairs.table(spark, sf, "orders"), "o_orderdate")
    return written.unionByName(native).select("kind", "fmt", "n", F.round("share", 6).alias("share"))


@query("date_to_native", """
SELECT order_id, 'DATE ''' || CAST(order_dt AS VARCHAR) || '''' AS native, strftime(order_dt, '%Y%m%d') AS compact,
  strftime(order_dt, '%Y/%m/%d') AS slashed FROM c_ol""")
def date_to_native(spark, sf):
    left = pairs.orders_left(spark, sf)
    write = lambda fmt: dates.to_native(F.col("ORDER_DT"), fmt)
    return left.select(F.col("ORDER_ID").alias("order_id"), write(None).alias("native"),
                       write(dates.COMPACT).alias("compact"), write(dates.SLASHED).alias("slashed"))


@query("date_to_std", """
SELECT order_id, CAST(order_dt AS VARCHAR) AS from_compact, CAST(order_dt AS VARCHAR) AS from_slashed FROM c_or""")
def date_to_std(spark, sf):
    right = pairs.orders_right(spark, sf)
    compact = dates.parse_with(F.col("order_dt"), dates.COMPACT)
    slashed = F.date_format(compact, dates.SLASHED)
    return right.select("order_id", compact.cast("string").alias("from_compact"),
                        dates.parse_with(slashed, dates.SLASHED).cast("string").alias("from_slashed"))


@query("excel_serial_date", """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 = 4 THEN '' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day FROM orders""")
def excel_serial_date(spark, sf):
    day = F.col("o_orderdate").cast("date")
    serial = F.datediff(day, F.lit(dates.EXCEL_EPOCH).cast("date"))
    cell = (F.when(F.col("o_orderkey") % 5 == 0, serial.cast("string"))
            .when(F.col("o_orderkey") % 5 == 1, F.concat(serial.cast("string"), F.lit(".75")))
            .when(F.col("o_orderkey") % 5 == 4, F.lit("tbd"))
            .otherwise(F.date_format(day, "MMM d, yyyy")))
    return pairs.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), dates.excel_serial(cell).alias("day"))


@query("timestamp_to_day", "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, count(*) AS n FROM events GROUP BY ALL")
def timestamp_to_day(spark, sf):
    e = pairs.table(spark, sf, "events")
    day = dates.to_day(F.col("ts"), e.schema["ts"].dataType)
    return e.groupBy(day.cast("string").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n"))


def _windows(spark, sf, unit):
    left = pairs.orders_left(spark, sf)
    bounds = daycounts.bounds(left.select(F.col("ORDER_DT").alias("day")))
    return dates.windows(bounds, unit).select("vintage", *text("start_date", "end_date"))


def _windows_sql(label, first, step, last):
    return f"""SELECT {label} AS vintage, CAST(s AS VARCHAR) AS start_date, CAST(least({last}, hi) AS VARCHAR) AS end_date FROM (
SELECT CAST(unnest(generate_series(CAST({first} AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL {step})) AS DATE) AS s, hi
FROM (SELECT min(order_dt) AS lo, max(order_dt) AS hi FROM c_ol))"""


@query("vintages_day", _windows_sql(day("s"), "lo", "1 DAY", "s"))
def vintages_day(spark, sf):
    return _windows(spark, sf, "day")


@query("vintages_week", _windows_sql(week("s"), "date_trunc('week', lo)", "7 DAY", "s + 6"))
def vintages_week(spark, sf):
    return _windows(spark, sf, "week")


@query("vintages_month", _windows_sql(month("s"), "date_trunc('month', lo)", "1 MONTH", "last_day(s)"))
def vintages_month(spark, sf):
    return _windows(spark, sf, "month")


@query("vintages_observed", """
SELECT 'week' AS unit, strftime(d, '%Y-W%W') AS vintage, CAST(min(d) AS VARCHAR) AS start_date, CAST(max(d) + 1 AS VARCHAR) AS end_date
FROM c_dl GROUP BY 1, 2
UNION ALL SELECT 'month', strftime(d, '%Y-%m'), CAST(min(d) AS VARCHAR), CAST(max(d) + 1 AS VARCHAR) FROM c_dl GROUP BY 1, 2
UNION ALL SELECT 'day', strftime(d, '%Y-%m-%d'), CAST(min(d) AS VARCHAR), CAST(max(d) + 1 AS VARCHAR) FROM c_dl GROUP BY 1, 2
UNION ALL SELECT 'all', 'all', CAST(min(d) AS VARCHAR), CAST(max(d) + 1 AS VARCHAR) FROM c_dl""")
def vintages_observed(spark, sf):
    days = daycounts.distinct_days(pairs.orders_left(spark, sf), F.col("ORDER_DT"))
    out = None
    for unit in ("week", "month", "day", "all"):
        one = daycounts.observed_windows(days, unit).select(F.lit(unit).alias("unit"), "vintage", *text("start_date", "end_date"))
        out = one if out is None else out.unionByName(one)
    return out


@query("vintages_year_all", _windows_sql(year("s"), "date_trunc('year', lo)", "1 YEAR", "make_date(year(s), 12, 31)") + """
UNION ALL SELECT 'all', CAST(min(order_dt) AS VARCHAR), CAST(max(order_dt) AS VARCHAR) FROM c_ol
UNION ALL SELECT 'all', CAST(min(order_dt) AS VARCHAR), CAST(max(order_dt) AS VARCHAR) FROM c_ol""")
def vintages_year_all(spark, sf):
    return _windows(spark, sf, "year").unionByName(_windows(spark, sf, "all")).unionByName(_windows(spark, sf, "snapshot"))


@query("week_label_monday", "SELECT strftime(ship_dt, '%Y-W%W') AS label, count(*) AS n FROM c_ll GROUP BY 1")
def week_label_monday(spark, sf):
    day = F.col("l_shipdate").cast("date")
    return pairs.table(spark, sf, "lineitem").groupBy(dates.monday_week_label(day).alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query("week_label_iso", "SELECT strftime(ship_dt, '%G-W%V') AS label, count(*) AS n FROM c_ll GROUP BY 1")
def week_label_iso(spark, sf):
    day = F.col("l_shipdate").cast("date")
    return pairs.table(spark, sf, "lineitem").groupBy(dates.iso_week_label(day).alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query("iso_week_bounds", """
SELECT y, w, n, CAST(greatest(s, make_date(y, 1, 1)) AS VARCHAR) AS start_date, CAST(least(s + 6, make_date(y, 12, 31)) AS VARCHAR) AS end_date
FROM (SELECT y, w, n, CAST(date_trunc('week', make_date(y, 1, 1)) AS DATE) + 7 * (w - 1) AS s
      FROM (SELECT CAST(year(ship_dt) AS INTEGER) AS y, CAST(weekofyear(ship_dt) AS INTEGER) AS w, count(*) AS n FROM c_ll GROUP BY 1, 2))""")
def iso_week_bounds(spark, sf):
    day = F.col("l_shipdate").cast("date")
    weeks = pairs.table(spark, sf, "lineitem").groupBy(F.year(day).alias("y"), F.weekofyear(day).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    start, end = dates.iso_week_bounds(F.col("y"), F.col("w"))
    return weeks.select("y", "w", "n", start.cast("string").alias("start_date"), end.cast("string").alias("end_date"))


@query("contains_datelike", f"""
SELECT 'd' || id AS id, regexp_matches(s, '{DATELIKE}') AS datelike FROM c_dates
UNION ALL SELECT 'p' || page_id, regexp_matches(html, '{DATELIKE}') FROM pages""")
def contains_datelike(spark, sf):
    d = derive(spark, sf, "c_dates").select(F.concat(F.lit("d"), "id").alias("id"), dates.contains_datelike(F.col("s")).alias("datelike"))
    p = pairs.table(spark, sf, "pages").select(F.concat(F.lit("p"), "page_id").alias("id"), dates.contains_datelike(F.col("html")).alias("datelike"))
    return d.unionByName(p)


@query("parse_date_value", f"SELECT id, CAST({strict_date('s')} AS VARCHAR) AS day FROM c_dates")
def parse_date_value(spark, sf):
    return derive(spark, sf, "c_dates").select("id", dates.parse_strict(F.col("s")).cast("string").alias("day"))


@query("compact_date_rebuild", "SELECT order_id, CAST(order_dt AS VARCHAR) AS day FROM c_or")
def compact_date_rebuild(spark, sf):
    return pairs.orders_right(spark, sf).select("order_id", dates.compact_rebuild(F.col("order_dt")).alias("day"))


# ---------------------------------------------------------------- normalisation


PARTS["c_texts"] = """
SELECT 'p' || p_partkey AS id, CASE p_partkey % 6 WHEN 0 THEN '  ' || p_name || chr(9) || chr(9) || p_type WHEN 1 THEN ' n/A '
  WHEN 2 THEN lower(p_brand) || '   ' || p_type WHEN 3 THEN chr(10) || 'None' WHEN 4 THEN '.' ELSE p_name END AS s FROM part
UNION ALL SELECT 'o' || order_id, status FROM c_or
UNION ALL SELECT 'e' || event_id, props FROM events"""


def _texts(spark, sf):
    part = pairs.table(spark, sf, "part")
    k = F.col("p_partkey") % 6
    s = (F.when(k == 0, F.concat(F.lit("  "), "p_name", F.lit("\t\t"), "p_type")).when(k == 1, F.lit(" n/A "))
         .when(k == 2, F.concat(F.lower("p_brand"), F.lit("   "), "p_type")).when(k == 3, F.lit("\nNone"))
         .when(k == 4, F.lit(".")).otherwise(F.col("p_name")))
    a = part.select(F.concat(F.lit("p"), "p_partkey").alias("id"), s.alias("s"))
    b = pairs.orders_right(spark, sf).select(F.concat(F.lit("o"), "order_id").alias("id"), F.col("status").alias("s"))
    c = pairs.table(spark, sf, "events").select(F.concat(F.lit("e"), "event_id").alias("id"), F.col("props").alias("s"))
    return a.unionByName(b).unionByName(c)


@query("norm_text", f"SELECT id, {n_text('s')} AS s FROM c_texts")
def norm_text(spark, sf):
    return _texts(spark, sf).select("id", normalize.norm_text(F.col("s")).alias("s"))


@query("norm_pseudo_null", f"SELECT id, {n_label('s')} AS s FROM c_texts")
def norm_pseudo_null(spark, sf):
    return _texts(spark, sf).select("id", normalize.norm_label(F.col("s")).alias("s"))


@query("norm_number", f"""
SELECT 'e' || event_id AS id, {n_dbl('value')} AS as_double, {n_int('user_id')} AS as_long, 
  {n_dbl('CAST(value AS DECIMAL(18,6))')} AS as_decimal FROM c_er
UNION ALL SELECT 'o' || order_id, {n_dbl('price')}, {n_int('cust_id')}, {n_dbl('CAST(price AS DECIMAL(18,6))')} FROM c_or""")
def norm_number(spark, sf):
    def one(df, key, mark, x, n):
        dec = F.col(x).cast("decimal(18,6)")
        return df.select(
            F.concat(F.lit(mark), key).alias("id"), normalize.norm_number(F.col(x), T.DoubleType()).alias("as_double"),
            normalize.norm_number(F.col(n), T.LongType()).alias("as_long"),
            normalize.norm_number(dec, T.DecimalType(18, 6)).alias("as_decimal"))
    return one(pairs.events_right(spark, sf), "event_id", "e", "value", "user_id").unionByName(
        one(pairs.orders_right(spark, sf), "order_id", "o", "price", "cust_id"))


@query("norm_date", "SELECT order_id, CASE WHEN order_id % 29 <> 0 THEN CAST(order_dt AS VARCHAR) END AS day FROM c_ol")
def norm_date(spark, sf):
    day = F.when(F.col("ORDER_ID") % 29 != 0, F.col("ORDER_DT"))
    return pairs.orders_left(spark, sf).select(F.col("ORDER_ID").alias("order_id"), normalize.norm_date(day).alias("day"))


@query("norm_timestamp", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS ts FROM events")
def norm_timestamp(spark, sf):
    return pairs.table(spark, sf, "events").select("event_id", normalize.norm_timestamp(F.col("ts")).alias("ts"))


@query("norm_binary", "SELECT doc_id, hex(encode(text)) AS payload FROM documents")
def norm_binary(spark, sf):
    d = pairs.table(spark, sf, "documents").select("doc_id", F.col("text").cast("binary").alias("payload"))
    return d.select("doc_id", normalize.norm_by_type(d["payload"], d.schema["payload"].dataType).alias("payload"))


@query("norm_by_type", f"""
SELECT 'left' AS side, {', '.join(f'{n} AS {c.lower()}' for n, c in zip(order_norms(), ORDER_NAMES))} FROM c_ol
UNION ALL SELECT 'right', {', '.join(order_norms())} FROM c_or""")
def norm_by_type(spark, sf):
    pair = pairs.orders_pair(spark, sf)
    one = lambda df, side: df.select(F.lit(side).alias("side"), *[p.normal(df, side).alias(p.name.lower()) for p in pair.columns])
    return one(pair.left, "left").unionByName(one(pair.right, "right"))


# ---------------------------------------------------------------- row hashes


@query("row_concat", f"SELECT order_id, {row_text(*order_norms())} AS row_text FROM c_or")
def row_concat(spark, sf):
    pair = pairs.orders_pair(spark, sf)
    return pair.right.select("order_id", hashing.row_concat([p.normal(pair.right, "right") for p in pair.columns]).alias("row_text"))


@query("row_sha256", f"SELECT order_id, upper(sha256({row_text(*order_norms())})) AS hash_value, CAST(NULL AS VARCHAR) AS no_columns FROM c_or")
def row_sha256(spark, sf):
    pair = pairs.orders_pair(spark, sf)
    return pair.right.select("order_id", hashing.row_sha256([p.normal(pair.right, "right") for p in pair.columns]).alias("hash_value"),
                             hashing.row_sha256([]).alias("no_columns"))


@query("row_hash_debug", f"""
SELECT order_id AS key_order_id, {', '.join(f'{n} AS {c.lower()}' for n, c in zip(order_norms(), ORDER_NAMES))},
  {row_text(*order_norms())} AS "__concat_string", upper(sha256({row_text(*order_norms())})) AS "__hash_hex" FROM c_ol""")
def row_hash_debug(spark, sf):
    pair = pairs.orders_pair(spark, sf)
    out = rowhash.row_hash_debug(pair.left, pair.columns, pair.columns[:1], "left")
    return out.toDF(*[c.lower() for c in out.columns])


@query("row_md5_extract", """
SELECT order_id, md5(concat_ws('|', CAST(order_id AS VARCHAR), status, CAST(price AS VARCHAR), CAST(order_dt AS VARCHAR),
  coalesce(priority, 'NULL'))) AS digest FROM c_ol""")
def row_md5_extract(spark, sf):
    cols = [F.col(c) for c in ("ORDER_ID", "STATUS", "PRICE", "ORDER_DT", "PRIORITY")]
    return pairs.orders_left(spark, sf).select(F.col("ORDER_ID").alias("order_id"), hashing.row_md5(cols).alias("digest"))


# ---------------------------------------------------------------- comparers, over value pairs of both sides

PARTS["c_pairs_v"] = """
SELECT l.order_id, l.status AS ls, r.status AS rs, l.price AS lp, r.price AS rp, l.priority AS lq, r.priority AS rq,
  CAST(l.order_dt AS VARCHAR) AS ld, CASE WHEN l.order_id % 31 = 0 THEN 'x' || r.order_dt_text ELSE r.order_dt_text END AS rd
FROM c_ol l JOIN c_or r ON l.order_id = r.order_id"""
PARTS["c_pairs_e"] = """
SELECT l.event_id, l.value AS lv, r.value AS rv FROM c_el l JOIN c_er r ON l.event_id = r.event_id"""


#: So many rows a side and task are joined at once where a join is bounded.
JOINED_ROWS = 200_000


def _joined(left, right, key, bounded):
    """An inner join; ``bounded`` deals both sides into parts of about ``JOINED_ROWS`` rows by key, whatever their size."""
    if not bounded:
        return left.join(right, key)
    parts = max(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), left.count() // JOINED_ROWS)
    return left.repartition(parts, key).join(right.repartition(parts, key).hint("merge"), key)


def _order_values(spark, sf, bounded=False):
    l, r = pairs.orders_left(spark, sf), pairs.orders_right(spark, sf)
    left = l.select(F.col("ORDER_ID").alias("order_id"), F.col("STATUS").alias("ls"), F.col("PRICE").alias("lp"),
                    F.col("PRIORITY").alias("lq"), F.col("ORDER_DT").cast("string").alias("ld"))
    right = r.select("order_id", F.col("status").alias("rs"), F.col("price").alias("rp"), F.col("priority").alias("rq"),
                     F.when(F.col("order_id") % 31 == 0, F.concat(F.lit("x"), "order_dt")).otherwise(F.col("order_dt")).alias("rd"))
    return _joined(left, right, "order_id", bounded)


def _event_values(spark, sf, bounded=False):
    l, r = pairs.events_left(spark, sf), pairs.events_right(spark, sf)
    return _joined(l.select(F.col("EVENT_ID").alias("event_id"), F.col("VALUE").alias("lv")), r.select("event_id", F.col("value").alias("rv")), "event_id", bounded)


@query("cmp_exact", """
SELECT order_id, ls IS NOT DISTINCT FROM rs AS status_ok, lq IS NOT DISTINCT FROM rq AS priority_ok, lp IS NOT DISTINCT FROM rp AS price_ok
FROM c_pairs_v""")
def cmp_exact(spark, sf):
    ok = lambda a, b: compare.exact(F.col(a), F.col(b))
    return _order_values(spark, sf).select("order_id", ok("ls", "rs").alias("status_ok"), ok("lq", "rq").alias("priority_ok"), ok("lp", "rp").alias("price_ok"))


@query("cmp_tolerance", f"""
SELECT 'o' || order_id AS id, {tolerance('lp', 'rp')} AS ok FROM c_pairs_v
UNION ALL SELECT 'e' || event_id, {tolerance('lv', 'rv')} FROM c_pairs_e
UNION ALL SELECT 's' || order_id, lq IS NULL AND rq IS NULL FROM c_pairs_v""")
def cmp_tolerance(spark, sf):
    o, e = _order_values(spark, sf), _event_values(spark, sf)
    one = lambda df, mark, key, a, b: df.select(F.concat(F.lit(mark), key).alias("id"), compare.tolerance(F.col(a), F.col(b)).alias("ok"))
    return one(o, "o", "order_id", "lp", "rp").unionByName(one(e, "e", "event_id", "lv", "rv")).unionByName(one(o, "s", "order_id", "lq", "rq"))


@query("cmp_zero_null", """
SELECT event_id, coalesce(lv IS NOT DISTINCT FROM rv OR (lv = 0 AND rv IS NULL), false) AS one_way,
  coalesce(rv IS NOT DISTINCT FROM lv OR (rv = 0 AND lv IS NULL), false) AS other_way,
  coalesce(rv IS NOT DISTINCT FROM lv OR (rv = 0 AND lv IS NULL) OR (lv = 0 AND rv IS NULL), false) AS both_ways FROM c_pairs_e""")
def cmp_zero_null(spark, sf):
    l, r = F.col("lv"), F.col("rv")
    return _event_values(spark, sf).select(
        "event_id", compare.exact_zero_null(l, r).alias("one_way"), compare.exact_zero_null(r, l).alias("other_way"),
        compare.exact_zero_null(r, l, both_ways=True).alias("both_ways"))


PARTS["c_typed_pairs"] = """
SELECT 'd' || order_id AS id, ld AS a, rd AS b FROM c_pairs_v
UNION ALL SELECT 'p' || order_id, CAST(lp AS VARCHAR), CAST(rp AS VARCHAR) FROM c_pairs_v
UNION ALL SELECT 's' || order_id, ls, rs FROM c_pairs_v
UNION ALL SELECT 'v' || event_id, CAST(lv AS VARCHAR), CAST(rv AS VARCHAR) FROM c_pairs_e"""


def _typed_pairs(spark, sf):
    """Values of both sides as text. Each two tables are joined once, in parts whose number grows with the rows, so a task sorts no more of a larger table."""
    o, e = _order_values(spark, sf, bounded=True), _event_values(spark, sf, bounded=True)
    one = lambda mark, key, a, b: F.struct(F.concat(F.lit(mark), key).alias("id"), F.col(a).cast("string").alias("a"), F.col(b).cast("string").alias("b"))
    kinds = F.array(one("d", "order_id", "ld", "rd"), one("p", "order_id", "lp", "rp"), one("s", "order_id", "ls", "rs"))
    return o.select(F.inline(kinds)).unionByName(e.select(F.inline(F.array(one("v", "event_id", "lv", "rv")))))


@query("cmp_flexible", f"SELECT id, {flexible('a', 'b')} AS ok FROM c_typed_pairs")
def cmp_flexible(spark, sf):
    return _typed_pairs(spark, sf).select("id", compare.flexible(F.col("a"), F.col("b")).alias("ok"))


@query("cmp_robust", f"SELECT id, {robust('a', 'b')} AS ok FROM c_typed_pairs")
def cmp_robust(spark, sf):
    return _typed_pairs(spark, sf).select("id", compare.robust(F.col("a"), F.col("b")).alias("ok"))


PARTS["c_freq_l"] = f"SELECT {month('order_dt')} AS vintage, priority AS v, count(*) AS n FROM c_ol GROUP BY 1, 2"
PARTS["c_freq_r"] = f"SELECT {month('order_dt')} AS vintage, {n_label('priority')} AS v, count(*) AS n FROM c_or GROUP BY 1, 2"
_LIST = "string_agg(coalesce(v, '<null>') || '=' || n, ',' ORDER BY n DESC, v NULLS LAST)"


def _freq_lists(spark, sf):
    def one(df, day, value):
        tall = df.select(dates.vintage_label(day, "month").alias("vintage"), F.lit("q").alias("column"), value.alias("v_text"))
        return profile.top_frequencies(profile.value_frequencies(tall, ["vintage"]), ["vintage"])
    l, r = pairs.orders_left(spark, sf), pairs.orders_right(spark, sf)
    left = one(l, F.col("ORDER_DT"), F.col("PRIORITY")).select("vintage", F.col("freq").alias("l"))
    right = one(r, dates.parse_with(F.col("order_dt"), dates.COMPACT), normalize.norm_label(F.col("priority"))).select("vintage", F.col("freq").alias("r"))
    return left.join(right, "vintage", "full_outer")


@query("cmp_freq_list", f"""
SELECT vintage, l.f IS NOT DISTINCT FROM r.f AS ok FROM (SELECT vintage, {_LIST} AS f FROM c_freq_l GROUP BY 1) l
FULL OUTER JOIN (SELECT vintage, {_LIST} AS f FROM c_freq_r GROUP BY 1) r USING (vintage)""")
def cmp_freq_list(spark, sf):
    return _freq_lists(spark, sf).select("vintage", compare.freq_list(F.col("l"), F.col("r")).alias("ok"))


@query("freq_sorted_by_value", f"""
SELECT vintage, string_agg(coalesce(v, '') || '(' || n || ')', '; ' ORDER BY v NULLS FIRST) AS freq FROM c_freq_l GROUP BY 1""")
def freq_sorted_by_value(spark, sf):
    lists = _freq_lists(spark, sf).where("l IS NOT NULL")
    return lists.select("vintage", compare.freq_text(compare.freq_sorted(F.col("l"))).alias("freq"))


@query("freq_parse", """
SELECT vintage, string_agg(replace(v, '-', '::-') || '(' || n || ')', '; ' ORDER BY replace(v, '-', '::-')) AS freq FROM c_freq_l
WHERE v IS NOT NULL GROUP BY 1""")
def freq_parse(spark, sf):
    lists = _freq_lists(spark, sf).where("l IS NOT NULL").select("vintage", F.filter("l", lambda s: s["value"].isNotNull()).alias("l"))
    entry = lambda s: F.concat(F.replace(s["value"], F.lit("-"), F.lit("::-")), F.lit("::"), s["n"].cast("string"))
    raw = F.concat(F.array_join(F.transform("l", entry), "||"), F.lit("||no count||bad::x"))
    return lists.select("vintage", compare.freq_text(compare.freq_parse(raw)).alias("freq"))


@query("descriptor_json", """
SELECT order_id, '{"var":"ORDER_DT","type":"date","fmt":null}' AS descriptor,
  '{"ORDER_ID":' || order_id || ',"CUST_ID":' || cust_id || '}' AS key_json, order_id AS parsed_id FROM c_ol""")
def descriptor_json(spark, sf):
    left = pairs.orders_left(spark, sf)
    keep_null = {"ignoreNullFields": "false"}
    described = F.to_json(dates.descriptor("ORDER_DT", left.schema["ORDER_DT"].dataType, None), keep_null)
    key = F.to_json(F.struct("ORDER_ID", "CUST_ID"))
    return left.select(F.col("ORDER_ID").alias("order_id"), described.alias("descriptor"), key.alias("key_json"),
                       F.from_json(key, "ORDER_ID bigint, CUST_ID bigint")["ORDER_ID"].alias("parsed_id"))


@query("stats_row_defaults", """
SELECT o_orderstatus AS status, count(*) FILTER (WHERE o_totalprice > 100000) AS "count",
  count(DISTINCT o_custkey) FILTER (WHERE o_totalprice > 100000) AS "distinct", 0 AS missing, max(o_totalprice) AS "max"
FROM orders GROUP BY 1""")
def stats_row_defaults(spark, sf):
    high = F.col("o_totalprice") > 100000
    stats = pairs.table(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("STATUS")).agg(
        F.count_if(high).alias("COUNT"), F.count_distinct(F.when(high, F.col("o_custkey"))).alias("DISTINCT"),
        F.sum(F.lit(None).cast("bigint")).alias("MISSING"), F.max("o_totalprice").alias("MAX"))
    return profile.with_defaults(stats)

