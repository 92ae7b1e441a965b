"""Several table pairs at once."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import Run, pair_of
from ..plans.estate import meta_summary, open_pairs
from ..sources import controls, results, scan
from ..sources.local import local_rows
from . import pairs
from .registry import query
from .shape import big, text
from .sqlparts import PARTS, day

PARTS["c_eb"] = """
SELECT coalesce(l.d, r.d) AS d, coalesce(l.n, 0) AS n_left, coalesce(r.n, 0) AS n_right
FROM (SELECT CAST(ts AS DATE) AS d, count(*) AS n FROM c_el GROUP BY 1) l
FULL OUTER JOIN (SELECT CAST(substr(ts, 1, 10) AS DATE) AS d, count(*) AS n FROM c_er GROUP BY 1) r ON l.d = r.d"""
PARTS["c_lb"] = """
SELECT coalesce(l.d, r.d) AS d, coalesce(l.n, 0) AS n_left, coalesce(r.n, 0) AS n_right
FROM (SELECT ship_dt AS d, count(*) AS n FROM c_ll GROUP BY 1) l
FULL OUTER JOIN (SELECT ship_dt AS d, count(*) AS n FROM c_lr GROUP BY 1) r ON l.d = r.d"""


def _summary_sql(name: str, both: str, columns: int) -> str:
    return f"""SELECT '{name}' AS table_name, true AS left_accessible, true AS right_accessible, CAST(NULL AS VARCHAR) AS excluded_reason,
  CAST(sum(n_left) AS BIGINT) AS left_rows, CAST(sum(n_right) AS BIGINT) AS right_rows, count(*) FILTER (WHERE n_left <> n_right) AS unequal_days,
  count(*) AS total_days, CAST({columns} AS BIGINT) AS comparable, bool_and(n_left = n_right) AS all_match FROM {both}"""


def _same(table: str) -> str:
    return f"(SELECT count(*) AS n_left, count(*) AS n_right FROM {table})"


@query("meta_summary_all", " UNION ALL ".join([
    _summary_sql("orders", "c_both", 6), _summary_sql("lineitem", "c_lb", 11), _summary_sql("events", "c_eb", 6),
    _summary_sql("customer", _same("customer"), 5), _summary_sql("part", _same("part"), 6), _summary_sql("nation", _same("nation"), 3),
    "SELECT 'supplier', true, false, 'not accessible', NULL, NULL, NULL, NULL, NULL, false"]))
def meta_summary_all(spark, sf):
    makers = {name: (lambda m=getattr(pairs, f"{name}_pair"): m(spark, sf))
              for name in ("orders", "lineitem", "events", "customer", "part", "nation")}
    makers["supplier"] = lambda: None  # its right side does not exist, so it is never opened
    found = scan.probe
    access = {name: (found(spark, f"{sf}/{name}.parquet")[0],
                     found(spark, f"{sf}/{name}{'_copy' if name == 'supplier' else ''}.parquet")[0]) for name in makers}
    return meta_summary(spark, *open_pairs(makers, access))


@query("meta_check_events", f"""
SELECT 'events' AS table_name, {day('d')} AS vintage, CAST(d AS VARCHAR) AS start_date, CAST(d AS VARCHAR) AS end_date,
  CAST(CAST(n_left <> n_right AS INTEGER) AS BIGINT) AS excluded_days, (SELECT count(*) FROM c_eb) AS total_days,
  (SELECT count(*) FROM c_eb WHERE n_left = n_right) AS matched_days, CAST(6 AS BIGINT) AS comparable_columns
FROM c_eb""")
def meta_check_events(spark, sf):
    m = pairs.events_pair(spark, sf).meta()
    return m.select("table_name", "vintage", *text("start_date", "end_date"), *big("excluded_days"), "total_days", "matched_days", "comparable_columns")


PARTS["c_evj"] = f"""
SELECT coalesce(l.event_id, r.event_id) AS event_id, {day('CAST(coalesce(l.t, r.t) AS DATE)')} AS vintage, l.h AS lh, r.h AS rh
FROM (SELECT event_id, date_trunc('second', ts) AS t, concat_ws('|', event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S'), user_id, event_type,
        upper(props), CAST(round(coalesce(value, 0), 3) AS DECIMAL(38,3))) AS h FROM c_el) l
FULL OUTER JOIN (SELECT event_id, CAST(ts AS TIMESTAMP) AS t, concat_ws('|', event_id, ts, user_id, event_type,
        upper(props), CAST(round(coalesce(value, 0), 3) AS DECIMAL(38,3))) AS h FROM c_er) r ON l.event_id = r.event_id"""


@query("hash_check_events", """
SELECT vintage, count(lh) AS left_rows, count(rh) AS right_rows, count(*) FILTER (WHERE lh = rh) AS matched,
  count(*) FILTER (WHERE rh IS NULL) AS left_only, count(*) FILTER (WHERE lh IS NULL) AS right_only,
  count(*) FILTER (WHERE lh <> rh) AS hash_mismatch FROM c_evj GROUP BY 1""")
def hash_check_events(spark, sf):
    pair = pairs.events_pair(spark, sf, keys=["EVENT_ID"], hash_all=True)
    return pair.hash_check(scoped=False).select(
        "vintage", *big("left_rows", "right_rows", "matched", "left_only", "right_only", "hash_mismatch"))


@query("hash_check_part", """
SELECT 'all' AS vintage, count(*) AS left_rows, count(*) AS right_rows, count(*) FILTER (WHERE p_partkey % 67 <> 0) AS matched,
  CAST(0 AS BIGINT) AS left_only, CAST(0 AS BIGINT) AS right_only, count(*) FILTER (WHERE p_partkey % 67 = 0) AS hash_mismatch FROM part""")
def hash_check_part(spark, sf):
    pair = pairs.part_pair(spark, sf, keys=["PART_ID"], hash_all=True)
    return pair.hash_check(scoped=False).select(
        "vintage", *big("left_rows", "right_rows", "matched", "left_only", "right_only", "hash_mismatch"))


@query("reconcile_undated", """
SELECT 'customer' AS table_name, 'all' AS vintage, CAST(5 AS BIGINT) AS total_columns, CAST(4 AS BIGINT) AS matched_columns,
  count(*) AS left_rows, count(*) AS right_rows, count(*) AS matched, 'COLUMNS_DIFFER' AS status FROM customer
UNION ALL SELECT 'part', 'all', 6, 5, count(*), count(*), count(*), 'COLUMNS_DIFFER' FROM part
UNION ALL SELECT 'nation', 'all', 3, 3, count(*), count(*), count(*), 'MATCH' FROM nation""")
def reconcile_undated(spark, sf):
    out = None
    for make in (pairs.customer_pair, pairs.part_pair, pairs.nation_pair):
        one = make(spark, sf).reconcile().select(
            "table_name", "vintage", "total_columns", "matched_columns", "left_rows", "right_rows", "matched", "status")
        out = one if out is None else out.unionByName(one)
    return out




# ---------------------------------------------------------------- runs from the pair list


LISTED = [("crm", "Orders (legacy)", "order_dt", "lake.orders", "ORDER_DT", "month"), ("crm", " customer ", None, "lake.customer", None, None),
          ("crm", "part", None, "lake.part", None, "all"), ("crm", "nation", None, "lake.nation", None, ""), ("crm", "gone", None, "lake.gone", None, None)]
_LIST_SCHEMA = "left_svc string, left_tbl string, left_var string, right_tbl string, right_var string, partition string, enabled string, start_dt string, end_dt string"


def _listed_makers(spark, sf, note=None):
    """Pairs as the pair list names them; one names a table that does not exist. ``note`` is mapped to a column of orders."""
    rows = [(*row[:5], row[5] or None, "yes", None, None) for row in LISTED]
    listed = controls.enabled_pairs(controls.read_pairs(local_rows(spark, rows, _LIST_SCHEMA))).collect()  # as long as the control table
    mappings = {"orders": [*pairs.ORDERS_CROSSWALK, *([("NOTE", note, None)] if note else [])], "customer": pairs.CUSTOMER_CROSSWALK, "part": pairs.PART_CROSSWALK,
                "nation": [(c.upper(), c, None) for c in pairs.table(spark, sf, "nation").columns]}
    crosswalk = None
    for name, mapping in mappings.items():
        rows = pairs.crosswalk(spark, mapping).withColumn("col_map", F.lit(name))
        crosswalk = rows if crosswalk is None else crosswalk.unionByName(rows)
    sides = {"orders": (pairs.orders_left, pairs.orders_right), "customer": (pairs.customer_left, pairs.customer_right),
             "part": (pairs.part_left, pairs.part_right), "nation": (lambda *a: pairs.nation_pair(*a).left, lambda *a: pairs.nation_pair(*a).right)}

    def opener(side):
        def open_(name):
            table = name.split(".")[-1]
            return sides[table][side](spark, sf) if table in sides else spark.read.parquet(f"{sf}/{table}.parquet")
        return open_

    return {row["right_tbl"].split(".")[-1]: (lambda row=row: pair_of(row, opener(0), opener(1), crosswalk)) for row in listed}


def _run(spark, sf, *stages):
    makers = _listed_makers(spark, sf)
    run = Run(spark, results.scratch(spark, "runs"), "nightly")
    return run, makers, run.carry_out(makers, stages)


_FAILED = "SELECT 'gone' AS table_name, 'FAILED' AS status, {nulls}"
_SIZES = {"orders": ("c_ol", "c_or"), "customer": ("customer",) * 2, "part": ("part",) * 2, "nation": ("nation",) * 2}


@query("run_meta", " UNION ALL ".join([
    *(f"SELECT '{t}' AS table_name, 'DONE' AS status, (SELECT count(*) FROM {l}) AS left_rows, (SELECT count(*) FROM {r}) AS right_rows"
      for t, (l, r) in _SIZES.items()), _FAILED.format(nulls="CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)")]))
def run_meta(spark, sf):
    run, makers, outcome = _run(spark, sf, "meta_check")
    rows = run.results("meta_check", makers).groupBy("table_name").agg(F.sum("day_rows_left").alias("left_rows"), F.sum("day_rows_right").alias("right_rows"))
    return outcome.select("table_name", "status").join(rows, "table_name", "left")


@query("run_columns", "SELECT 'orders' AS table_name, 'DONE' AS status, count(*) FILTER (WHERE is_mismatched) AS mismatched FROM c_verdict "
       "UNION ALL SELECT 'customer', 'DONE', 1 UNION ALL SELECT 'part', 'DONE', 1 UNION ALL SELECT 'nation', 'DONE', 0 UNION ALL SELECT 'gone', 'FAILED', NULL")
def run_columns(spark, sf):
    run, makers, outcome = _run(spark, sf, "column_check")
    rows = run.results("column_check", makers).groupBy("table_name").agg(F.count_if("is_mismatched").alias("mismatched"))
    # a table whose check ran but compared no column has none that differs
    mismatched = F.when(F.col("status") != "FAILED", F.coalesce("mismatched", F.lit(0))).alias("mismatched")
    return outcome.select("table_name", "status").join(rows, "table_name", "left").select("table_name", "status", mismatched)


@query("run_hashes", "SELECT 'orders' AS table_name, 'DONE' AS status, CAST(sum(matched) AS BIGINT) AS matched FROM c_p3c "
       "UNION ALL SELECT 'customer', 'DONE', count(*) FROM customer UNION ALL SELECT 'part', 'DONE', count(*) FROM part "
       "UNION ALL SELECT 'nation', 'DONE', count(*) FROM nation UNION ALL SELECT 'gone', 'FAILED', NULL")
def run_hashes(spark, sf):
    run, makers, outcome = _run(spark, sf, "hash_check")
    rows = run.results("hash_check", makers).groupBy("table_name").agg(F.sum("matched").cast("bigint").alias("matched"))
    return outcome.select("table_name", "status").join(rows, "table_name", "left")


@query("run_resume", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{a}' AS first_run, '{b}' AS second_run, '{c}' AS changed_run, {cols} AS columns, {n} AS left_rows" for t, a, b, c, cols, n in [
        *((t, "DONE", "RESUMED", "DONE" if t == "orders" else "RESUMED", {"orders": 7, "customer": 5, "part": 6, "nation": 3}[t], f"(SELECT count(*) FROM {l})")
          for t, (l, _) in _SIZES.items()), ("gone", "FAILED", "FAILED", "FAILED", "NULL", "NULL")]))
def run_resume(spark, sf):
    """A second run resumes; after a change of one pair's mapping that pair alone is computed again."""
    run, makers, first = _run(spark, sf, "meta_check")
    second = run.carry_out(makers, ["meta_check"])
    changed = _listed_makers(spark, sf, note="note")
    third = run.carry_out(changed, ["meta_check"])
    rows = run.results("meta_check", changed).groupBy("table_name").agg(F.max("comparable_columns").alias("columns"), F.sum("day_rows_left").alias("left_rows"))
    told = lambda outcome, name: outcome.select("table_name", F.col("status").alias(name))
    return told(first, "first_run").join(told(second, "second_run"), "table_name").join(told(third, "changed_run"), "table_name").join(rows, "table_name", "left")
