"""SQL building blocks of the twins: named subqueries and expression templates."""

from __future__ import annotations

import re

from . import derived

PARTS: dict[str, str] = {}


def with_parts(sql: str) -> str:
    """Prepend the named subqueries a statement needs, each after those it uses itself."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\bc_\w+\b", text):
            if name not in PARTS:  # a column of customer
                continue
            if name not in order:
                visit(PARTS[name])
                if name not in order:
                    order.append(name)

    visit(sql)
    if not order:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({PARTS[n]})" for n in order) + "\n" + sql


# ---------------------------------------------------------------- expressions


def n_text(x: str) -> str:
    return (f"regexp_replace(regexp_replace(upper(trim(CAST({x} AS VARCHAR))), '[\\x00-\\x1F\\x7F]', '', 'g'), "
            f"'\\s+', ' ', 'g')")


def n_label(x: str) -> str:
    return (f"CASE WHEN {n_text(x)} IN ('', 'NULL', 'NUL', 'NONE', 'N/A', '<NA>', 'EMPTY', 'NIL', '.') "
            f"THEN NULL ELSE {n_text(x)} END")


def n_int(x: str) -> str:
    return f"CASE WHEN {x} IS NULL OR {x} = 0 THEN '0' ELSE CAST({x} AS VARCHAR) || '.000' END"


def n_dbl(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL OR {x} = 0 THEN '0' "
            f"ELSE CAST(CAST(round({x}, 3) AS DECIMAL(38,3)) AS VARCHAR) END")


def row_text(*parts: str) -> str:
    return " || '|' || ".join(f"coalesce({p}, '')" for p in parts)


def steady(x: str) -> str:
    return f"round({x} + 3.7e-6, 4)"


def steady_square(x: str) -> str:
    return f"CASE WHEN abs({x}) < 1e6 THEN round({x}, 4) ELSE round({x}, -4) END"


def month(d: str) -> str:
    return f"'M' || strftime({d}, '%Y%m')"


def week(d: str) -> str:
    return f"'W' || strftime({d}, '%G') || 'W' || strftime({d}, '%V')"


def year(d: str) -> str:
    return f"'Y' || strftime({d}, '%Y')"


def day(d: str) -> str:
    return f"'D' || strftime({d}, '%Y%m%d')"


def limbs(digest: str) -> str:
    out = []
    for start in (1, 16):
        w = f"CAST('0x' || substr({digest}, {start}, 15) AS BIGINT)"
        out += [f"({w} >> 40)", f"(({w} >> 20) & 1048575)", f"({w} & 1048575)"]
    return ", ".join(f"CAST(sum({e}) AS BIGINT) AS limb_{i}" for i, e in enumerate(out))


FINGERPRINT = ("md5(concat_ws('-', limb_0, limb_1, limb_2, limb_3, limb_4, limb_5, n))")

DATELIKE = r"\d{4}-\d{2}-\d{2}|\d{2}-\d{2}-\d{4}|\d{4}/\d{2}/\d{2}|\d{2}/\d{2}/\d{4}|\d{8}"


def strict_date(x: str) -> str:
    """Year-first, day-first and compact notations to DATE."""
    h = f"regexp_replace(trim({x}), '^(\\d{{4}}[-/]\\d{{1,2}}[-/]\\d{{1,2}}) \\d{{1,2}}:\\d{{1,2}}:\\d{{1,2}}$', '\\1')"
    return (
        f"CASE WHEN regexp_full_match({h}, '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') THEN TRY_CAST({h} AS DATE) "
        f"WHEN regexp_full_match({h}, '\\d{{4}}/\\d{{1,2}}/\\d{{1,2}}') THEN TRY_CAST(replace({h}, '/', '-') AS DATE) "
        f"WHEN regexp_full_match({h}, '\\d{{1,2}}-\\d{{1,2}}-\\d{{4}}|\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}') "
        f"THEN TRY_CAST(regexp_replace({h}, '^(\\d+)[-/](\\d+)[-/](\\d+)$', '\\3-\\2-\\1') AS DATE) "
        f"WHEN regexp_full_match({h}, '\\d{{8}}') "
        f"THEN TRY_CAST(substr({h},1,4) || '-' || substr({h},5,2) || '-' || substr({h},7,2) AS DATE) END"
    )


def close(l: str, r: str) -> str:
    return f"({l} = {r} OR abs({l} - {r}) <= 1e-6 + 1e-6 * abs({r}))"


def flexible(l: str, r: str) -> str:
    dl, dr = strict_date(l), strict_date(r)
    nl, nr = f"TRY_CAST({l} AS DOUBLE)", f"TRY_CAST({r} AS DOUBLE)"
    return (f"CASE WHEN {l} IS NULL AND {r} IS NULL THEN true WHEN {l} IS NULL OR {r} IS NULL THEN false "
            f"WHEN ({dl}) IS NOT NULL AND ({dr}) IS NOT NULL THEN ({dl}) = ({dr}) "
            f"WHEN {nl} IS NOT NULL AND {nr} IS NOT NULL THEN {close(nl, nr)} ELSE {l} = {r} END")


def tolerance(l: str, r: str) -> str:
    return (f"CASE WHEN {l} IS NULL AND {r} IS NULL THEN true WHEN {l} IS NULL OR {r} IS NULL THEN false "
            f"ELSE {close(l, r)} END")


def robust(l: str, r: str) -> str:
    dl, dr = strict_date(l), strict_date(r)
    nl, nr = f"TRY_CAST({l} AS DOUBLE)", f"TRY_CAST({r} AS DOUBLE)"
    like = f"(regexp_matches({l}, '{DATELIKE}') OR regexp_matches({r}, '{DATELIKE}'))"
    return (f"CASE WHEN {l} IS NULL AND {r} IS NULL THEN true WHEN {l} IS NULL THEN coalesce({nr} = 0, false) "
            f"WHEN {r} IS NULL THEN coalesce({nl} = 0, false) "
            f"WHEN {nl} IS NOT NULL AND {nr} IS NOT NULL THEN {close(nl, nr)} "
            f"WHEN {like} AND ({dl}) IS NOT NULL AND ({dr}) IS NOT NULL THEN ({dl}) = ({dr}) ELSE {l} = {r} END")


def missing(x: str) -> str:
    return f"({x} IS NULL OR lower(trim(CAST({x} AS VARCHAR))) IN ('', 'nat', 'nan', 'none', 'null'))"


# ---------------------------------------------------------------- orders, both sides

PARTS["c_ol"] = """
SELECT o_orderkey AS order_id, o_custkey AS cust_id, o_orderstatus AS status, o_totalprice AS price,
       CAST(o_orderdate AS DATE) AS order_dt,
       CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_orderpriority END AS priority
FROM orders"""

PARTS["c_or_base"] = """
SELECT o_orderkey AS order_id, o_custkey AS cust_id,
       CASE WHEN o_orderkey % 17 = 0 THEN '  ' || lower(o_orderstatus) || ' ' ELSE o_orderstatus END AS status,
       CASE WHEN o_orderkey % 53 = 0 THEN o_totalprice * 1.5 ELSE o_totalprice + 1e-7 END AS price,
       strftime(o_orderdate, '%Y%m%d') AS order_dt_text, CAST(o_orderdate AS DATE) AS order_dt,
       CASE WHEN o_orderkey % 29 = 0 THEN 'n/a' ELSE o_orderpriority END AS priority
FROM orders WHERE NOT (o_orderkey % 101 = 7 AND day(o_orderdate) % 2 = 0)"""

PARTS["c_or"] = """
SELECT * FROM c_or_base
UNION ALL
SELECT order_id + 100000000, cust_id, status, price, order_dt_text, order_dt, priority
FROM c_or_base WHERE order_id % 211 = 5 AND day(order_dt) % 2 = 1"""

PARTS["c_dl"] = "SELECT order_dt AS d, count(*) AS n FROM c_ol GROUP BY 1"
PARTS["c_dr"] = "SELECT order_dt AS d, count(*) AS n FROM c_or GROUP BY 1"
PARTS["c_both"] = """
SELECT coalesce(l.d, r.d) AS d, coalesce(l.n, 0) AS n_left, coalesce(r.n, 0) AS n_right
FROM c_dl l FULL OUTER JOIN c_dr r ON l.d = r.d"""
PARTS["c_scope"] = f"SELECT d, {month('d')} AS vintage FROM c_both WHERE n_left = n_right"
PARTS["c_ols"] = "SELECT o.*, s.vintage FROM c_ol o JOIN c_scope s ON o.order_dt = s.d"
PARTS["c_ors"] = "SELECT o.*, s.vintage FROM c_or o JOIN c_scope s ON o.order_dt = s.d"


def order_norms(side: str = "") -> list[str]:
    p = f"{side}." if side else ""
    return [n_int(p + "order_id"), n_int(p + "cust_id"), n_label(p + "status"), n_dbl(p + "price"),
            f"CAST({p}order_dt AS VARCHAR)", n_label(p + "priority")]


ORDER_NAMES = ["ORDER_ID", "CUST_ID", "STATUS", "PRICE", "ORDER_DT", "PRIORITY"]

for _name, _src in (("c_olh", "c_ol"), ("c_orh", "c_or")):
    PARTS[_name] = (f"SELECT order_id, {month('order_dt')} AS vintage, order_dt, "
                    f"upper(sha256({row_text(*order_norms())})) AS h FROM {_src}")
for _name, _src in (("c_olsh", "c_ols"), ("c_orsh", "c_ors")):
    PARTS[_name] = (f"SELECT order_id, vintage, order_dt, "
                    f"upper(sha256({row_text(*order_norms())})) AS h FROM {_src}")


def windows_month(bounds: str) -> str:
    return f"""SELECT {month('s')} AS vintage, s AS start_date,
       least(CAST(s + INTERVAL 1 MONTH AS DATE) - 1, hi) AS end_date
FROM (SELECT CAST(unnest(generate_series(date_trunc('month', lo)::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 MONTH)) AS DATE) AS s, hi
      FROM (SELECT min(d) AS lo, max(d) AS hi FROM {bounds}))"""


PARTS["c_wl"] = windows_month("c_dl")
PARTS["c_wr"] = windows_month("c_dr")
PARTS["c_vint"] = f"""
SELECT l.vintage, l.start_date, l.end_date, coalesce(b.n, 0) AS excluded_days
FROM c_wl l JOIN c_wr r ON l.vintage = r.vintage
LEFT JOIN (SELECT {month('d')} AS vintage, count(*) AS n FROM c_both WHERE n_left <> n_right GROUP BY 1) b
  ON b.vintage = l.vintage"""

# ---------------------------------------------------------------- statistics of orders

_CONT = {"ORDER_ID": ("order_id", "BIGINT"), "CUST_ID": ("cust_id", "BIGINT"), "PRICE": ("price", "DOUBLE")}
_CATS = {"STATUS": "status", "PRIORITY": "priority", "ORDER_DT": "CAST(order_dt AS VARCHAR)"}


def continuous_sql(src: str, columns: dict[str, str], by: str = "vintage") -> str:
    """Continuous profile, one SELECT per column."""
    return "\nUNION ALL\n".join(
        f"""SELECT {by}, '{name}' AS col, 'continuous' AS kind, count({x}) AS cnt, count(DISTINCT {x}) AS dist,
       count(*) - count({x}) AS missing, CAST(min({x}) AS VARCHAR) AS mn, CAST(max({x}) AS VARCHAR) AS mx,
       avg(CAST({x} AS DOUBLE)) AS av, stddev_samp(CAST({x} AS DOUBLE)) AS sd, sum(CAST({x} AS DOUBLE)) AS sm,
       sum(CAST({x} AS DOUBLE) * CAST({x} AS DOUBLE)) AS sq, CAST(NULL AS VARCHAR) AS freq
FROM {src} GROUP BY {by}""" for name, x in columns.items())


def frequencies_sql(src: str, columns: dict[str, str], by: str = "vintage") -> str:
    inner = "\nUNION ALL\n".join(
        f"SELECT {by}, '{name}' AS col, {x} AS v, count(*) AS n FROM {src} GROUP BY ALL" for name, x in columns.items())
    return (f"SELECT *, row_number() OVER (PARTITION BY {by}, col ORDER BY n DESC, v ASC NULLS LAST) AS rn "
            f"FROM ({inner})")


def freq_text(limit: int = 10) -> str:
    return (f"string_agg(coalesce(v, '') || '(' || n || ')', '; ' ORDER BY n DESC, v ASC NULLS LAST) "
            f"FILTER (WHERE rn <= {limit})")


def categorical_sql(freq: str, by: str = "vintage") -> str:
    return f"""SELECT {by}, col, 'categorical' AS kind, sum(n) AS cnt, count(*) AS dist,
       coalesce(max(n) FILTER (WHERE v IS NULL), 0) AS missing,
       CAST(min(n) AS VARCHAR) AS mn, CAST(max(n) AS VARCHAR) AS mx, avg(n) AS av, stddev_samp(n) AS sd,
       sum(CAST(n AS DOUBLE)) AS sm, sum(CAST(n AS DOUBLE) * n) AS sq, {freq_text()} AS freq
FROM {freq} GROUP BY {by}, col"""


for _side, _src in (("l", "c_ols"), ("r", "c_ors")):
    PARTS[f"c_f{_side}"] = frequencies_sql(_src, _CATS)
    PARTS[f"c_s{_side}"] = continuous_sql(_src, {k: v[0] for k, v in _CONT.items()}) + "\nUNION ALL\n" + categorical_sql(f"c_f{_side}")

PARTS["c_cmp"] = f"""
SELECT l.vintage, l.col, l.dist AS l_dist, r.dist AS r_dist, l.cnt AS l_cnt, r.cnt AS r_cnt,
       l.cnt = r.cnt AS count_ok, l.dist = r.dist AS distinct_ok,
       {flexible('l.mn', 'r.mn')} AS min_ok, {flexible('l.mx', 'r.mx')} AS max_ok,
       {tolerance('l.av', 'r.av')} AS avg_ok, {tolerance('l.sd', 'r.sd')} AS std_ok,
       l.missing = r.missing AS missing_ok, l.freq IS NOT DISTINCT FROM r.freq AS freq_ok
FROM c_sl l JOIN c_sr r ON l.vintage = r.vintage AND l.col = r.col"""
PARTS["c_flags"] = """
SELECT *, count_ok AND distinct_ok AND min_ok AND max_ok AND avg_ok AND std_ok AND missing_ok AND freq_ok AS is_match
FROM c_cmp"""
PARTS["c_verdict"] = """
SELECT col, count(*) AS vintages, count(*) FILTER (WHERE NOT is_match) AS vintages_mismatched,
       bool_or(NOT is_match) AS is_mismatched, max(l_dist) AS max_distinct
FROM c_flags GROUP BY col"""
PARTS["c_keys"] = """
SELECT * FROM (SELECT *, row_number() OVER (ORDER BY max_distinct DESC, col) AS key_rank
               FROM c_verdict WHERE NOT is_mismatched) WHERE key_rank <= 5"""

# ---------------------------------------------------------------- hash check over clean columns

PARTS["c_use"] = "SELECT " + ", ".join(
    f"bool_or(col = '{c}' AND NOT is_mismatched) AS hash_{c}, "
    f"coalesce((SELECT true FROM c_keys k WHERE k.col = '{c}'), false) AS key_{c}" for c in ORDER_NAMES
) + " FROM c_verdict"

_KEY_TEXT = {"ORDER_ID": "CAST(order_id AS VARCHAR)", "CUST_ID": "CAST(cust_id AS VARCHAR)", "STATUS": "status",
             "PRICE": "CAST(price AS VARCHAR)", "ORDER_DT": "CAST(order_dt AS VARCHAR)", "PRIORITY": "priority"}

for _name, _src in (("c_p3l", "c_ols"), ("c_p3r", "c_ors")):
    hashed = ", ".join(f"CASE WHEN hash_{c} THEN coalesce({n}, '') END" for c, n in zip(ORDER_NAMES, order_norms()))
    keyed = ", ".join(f"CASE WHEN key_{c} THEN coalesce({_KEY_TEXT[c]}, '<null>') END" for c in ORDER_NAMES)
    PARTS[_name] = (f"SELECT vintage, concat_ws('|', {keyed}) AS k, upper(sha256(concat_ws('|', {hashed}))) AS h "
                    f"FROM {_src}, c_use")

PARTS["c_p3"] = """
SELECT vintage, count(*) FILTER (WHERE l IS NOT NULL AND r IS NOT NULL AND l = r) AS matched,
       count(*) FILTER (WHERE r IS NULL) AS left_only, count(*) FILTER (WHERE l IS NULL) AS right_only,
       count(*) FILTER (WHERE l <> r) AS hash_mismatch
FROM (SELECT coalesce(a.vintage, b.vintage) AS vintage, a.h AS l, b.h AS r
      FROM c_p3l a FULL OUTER JOIN c_p3r b ON a.vintage = b.vintage AND a.k = b.k) GROUP BY vintage"""
PARTS["c_p3c"] = """
SELECT p.vintage, l.n AS left_rows, r.n AS right_rows, matched, left_only, right_only, hash_mismatch
FROM c_p3 p JOIN (SELECT vintage, count(*) AS n FROM c_p3l GROUP BY 1) l USING (vintage)
JOIN (SELECT vintage, count(*) AS n FROM c_p3r GROUP BY 1) r USING (vintage)"""
PARTS["c_rate"] = """
SELECT vintage, count(*) AS total_columns, count(*) FILTER (WHERE is_match) AS matched_columns,
       count(*) FILTER (WHERE NOT is_match) AS mismatched_columns,
       printf('%.1f%%', count(*) FILTER (WHERE is_match) * 100.0 / count(*)) AS match_rate
FROM c_flags GROUP BY vintage"""

# ---------------------------------------------------------------- hash compare over all columns and days


def full_compare(left: str, right: str) -> str:
    return f"""SELECT coalesce(l.vintage, r.vintage) AS vintage, coalesce(l.order_id, r.order_id) AS order_id,
       l.h AS left_hash, r.h AS right_hash,
       CASE WHEN r.h IS NULL THEN 'left_only' WHEN l.h IS NULL THEN 'right_only'
            WHEN l.h = r.h THEN 'matched' ELSE 'hash_mismatch' END AS status
FROM {left} l FULL OUTER JOIN {right} r ON l.vintage = r.vintage AND l.order_id IS NOT DISTINCT FROM r.order_id"""


PARTS["c_j1"] = full_compare("c_olh", "c_orh")
PARTS["c_a14"] = """
SELECT vintage, count(left_hash) AS left_rows, count(right_hash) AS right_rows,
       count(*) FILTER (WHERE status = 'matched') AS matched, count(*) FILTER (WHERE status = 'left_only') AS left_only,
       count(*) FILTER (WHERE status = 'right_only') AS right_only,
       count(*) FILTER (WHERE status = 'hash_mismatch') AS hash_mismatch
FROM c_j1 GROUP BY vintage"""

# ---------------------------------------------------------------- lineitem and events

PARTS["c_ll"] = """
SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_partkey AS part_id, l_suppkey AS supp_id,
       l_quantity AS qty, l_extendedprice AS price, l_discount AS disc, l_tax AS tax, l_returnflag AS rflag,
       l_linestatus AS lstatus, l_shipdate AS ship_ts, CAST(l_shipdate AS DATE) AS ship_dt FROM lineitem"""
PARTS["c_lr"] = """
SELECT order_id, line_no, part_id, supp_id, CAST(qty AS DECIMAL(12,2)) AS qty, price, disc, tax,
       CASE WHEN part_id % 19 = 0 THEN lower(rflag) ELSE rflag END AS rflag, lstatus, ship_ts, ship_dt
FROM c_ll WHERE NOT (supp_id % 37 = 3 AND line_no = 1)"""

_LINE = [n_int("order_id"), n_int("line_no"), n_int("part_id"), n_int("supp_id"), n_dbl("qty"), n_dbl("price"),
         n_dbl("disc"), n_dbl("tax"), n_label("rflag"), n_label("lstatus"), "strftime(ship_ts, '%Y-%m-%d %H:%M:%S.%g')"]
for _name, _src in (("c_llh", "c_ll"), ("c_lrh", "c_lr")):
    PARTS[_name] = (f"SELECT order_id, line_no, {week('ship_dt')} AS vintage, "
                    f"upper(sha256({row_text(*_LINE)})) AS h FROM {_src}")

PARTS["c_el"] = """
SELECT event_id, ts, user_id, event_type, CASE WHEN event_id % 41 = 0 THEN 0.0 ELSE value END AS value, props
FROM events"""
PARTS["c_er"] = """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type,
       CASE WHEN event_id % 41 = 0 THEN NULL ELSE value END AS value, props
FROM events WHERE NOT event_id % 97 = 1"""

PARTS.update(derived.duckdb_parts())
