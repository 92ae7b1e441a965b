"""Scans, control tables, catalogs and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..functions.types import is_numeric_name, types_compatible
from ..sources import catalog, controls, results, scan
from . import pairs
from .derived import derive
from .registry import query
from .shape import big
from .sqlparts import missing


@query("scan_where", """
SELECT l_orderkey AS "L_ORDERKEY", l_linenumber AS "L_LINENUMBER", l_quantity AS "L_QUANTITY", l_returnflag AS "L_RETURNFLAG"
FROM lineitem WHERE l_quantity > 30 AND l_returnflag = 'R'""")
def scan_where(spark, sf):
    return scan.scan(pairs.table(spark, sf, "lineitem"),
                     ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"],
                     "l_quantity > 30 AND l_returnflag = 'R'", "upper")


_SERIAL = """CASE WHEN {c} IS NULL THEN '' WHEN regexp_full_match(trim({c}), '\\d{{1,6}}')
  THEN CAST(DATE '1899-12-30' + CAST(trim({c}) AS INTEGER) AS VARCHAR)
  WHEN regexp_full_match(trim({c}), '\\d{{4}}[-/]\\d{{1,2}}[-/]\\d{{1,2}}') THEN CAST(CAST(replace(trim({c}), '/', '-') AS DATE) AS VARCHAR)
  WHEN regexp_full_match(trim({c}), '\\d{{2}}/\\d{{2}}/\\d{{4}}') THEN CAST(CAST(strptime(trim({c}), '%m/%d/%Y') AS DATE) AS VARCHAR)
  ELSE '' END"""


@query("pair_list", f"""
SELECT pair_id, trim(regexp_replace(left_svc, '\\(.*\\)', '')) AS left_svc,
  coalesce(trim(regexp_replace(left_svc, '\\(.*\\)', '')), 'no_server') || '.'
    || lower(trim(regexp_replace(left_tbl, '\\(.*\\)', ''))) AS left_tbl,
  upper(trim(left_var)) AS left_var, trim(right_tbl) AS right_tbl, lower(trim(right_var)) AS right_var,
  coalesce(trim(unit), 'all') AS unit, coalesce(regexp_matches(enabled, '(?i)\\b(yes|y)\\b'), false) AS enabled,
  {_SERIAL.format(c='start_dt')} AS start_dt, {_SERIAL.format(c='end_dt')} AS end_dt, trim(col_map) AS col_map
FROM c_pairs_raw WHERE regexp_full_match(trim(right_tbl), '[^.]+\\.[^.]+')""")
def pair_list(spark, sf):
    read = controls.read_pairs(derive(spark, sf, "c_pairs_raw"), rename={"unit": "partition"})
    return read.withColumnRenamed("partition", "unit")


_SHEETS = """
SELECT 'parts' AS sheet, p_brand AS left_view, p_name AS left_col, '' AS right_view, p_type AS right_col, p_type AS comment FROM part
UNION ALL SELECT 'suppliers', s_name, 'NATION_' || s_nationkey, '', lower(s_name), '' FROM supplier"""


@query("crosswalk_union", f"""
SELECT sheet, left_view, left_col, right_view, right_col, comment, sheet AS col_map,
       NOT {missing('comment')} AS is_tokenized FROM ({_SHEETS})""")
def crosswalk_union(spark, sf):
    part, supplier = pairs.table(spark, sf, "part"), pairs.table(spark, sf, "supplier")
    sheets = {
        "Parts": part.selectExpr("p_brand AS view", "p_name AS source", "p_type AS target", "p_type AS remark"),
        "Suppliers": supplier.selectExpr("s_name AS view", "concat('NATION_', s_nationkey) AS source", "lower(s_name) AS target"),
        "Readme": pairs.table(spark, sf, "region").selectExpr("r_name AS view"),
    }
    fields = {"left_view": [["view"]], "left_col": [["source"]], "right_col": [["target"]], "comment": [["remark"]], "right_view": [["target view"]]}
    return controls.load_crosswalk(sheets, fields, keyed_by="sheet", exclude={"Readme"})


@query("crosswalk_coalesce_cols", """
SELECT p_partkey, p_name AS first_found, coalesce(p_brand, '') || '.' || coalesce(nullif(p_type, 'PROMO'), '') AS joined, '' AS absent
FROM part""")
def crosswalk_coalesce_cols(spark, sf):
    part = pairs.table(spark, sf, "part").withColumn("kind", F.expr("nullif(p_type, 'PROMO')"))
    pick = lambda *groups: controls.column_from(part, [g.split() for g in groups])
    return part.select(
        "p_partkey", pick("target", "p_name", "p_type").alias("first_found"),
        pick("p_brand no_such", "p_brand kind").alias("joined"), pick("no_such").alias("absent"))


@query("crosswalk_tokenized", f"""
SELECT note_id, coalesce(contains(lower(split_part(note, '.', 1)), 'tokenise'), false) AS by_comment,
       NOT {missing('note')} AS by_presence FROM c_notes""")
def crosswalk_tokenized(spark, sf):
    notes = derive(spark, sf, "c_notes")
    return notes.select("note_id", text.tokenised_by_comment(F.col("note")).alias("by_comment"),
                        text.tokenised_by_presence(F.col("note")).alias("by_presence"))


@query("null_tokens_on_read", """
SELECT o_orderkey, CASE WHEN o_orderpriority IN ('4-NOT SPECIFIED', '-') THEN NULL ELSE o_orderpriority END AS priority FROM orders""")
def null_tokens_on_read(spark, sf):
    o = pairs.table(spark, sf, "orders")
    return o.select("o_orderkey", text.null_if_missing(F.col("o_orderpriority"), ["4-NOT SPECIFIED", "-"]).alias("priority"))


CATALOGUED = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def _catalog_sql(table: str, columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, CAST({i} AS INTEGER) AS ordinal, '{name}' AS column_name, '{kind}' AS data_type, "
        f"count(*) AS n_rows, count({name}) AS non_null FROM {table}"
        for i, (name, kind) in enumerate((c.split() for c in columns.split(", ")), 1))


@query("column_catalog", " UNION ALL ".join(_catalog_sql(t, c) for t, c in CATALOGUED.items()))
def column_catalog(spark, sf):
    out = None
    for name in CATALOGUED:
        one = catalog.with_fill(pairs.table(spark, sf, name), name)
        out = one if out is None else out.unionByName(one)
    return out


PROBED = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@query("access_probe", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) >= 0 AS accessible, CAST(NULL AS VARCHAR) AS error" for t in PROBED)
    + " UNION ALL SELECT 'supplier_copy', false, 'PATH_NOT_FOUND'")
def access_probe(spark, sf):
    return scan.access_report(spark, {t: f"{sf}/{t}.parquet" for t in [*PROBED, "supplier_copy"]})


_ORDERS_OUT = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_day,
  o_orderpriority FROM orders"""


def _orders_out(spark, sf):
    return pairs.table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.col("o_orderdate").cast("date").cast("string").alias("o_day"), "o_orderpriority")


def _roundtrip(spark, sf, fmt):
    df = _orders_out(spark, sf)
    path = results.run_path(results.scratch(spark, "roundtrip"), "run_1", "meta_check", f"/orders_{fmt}/")
    results.write_result(df, path, fmt)
    return results.read_result(spark, path, fmt, None if fmt == "parquet" else df.schema)


@query("parquet_roundtrip", _ORDERS_OUT)
def parquet_roundtrip(spark, sf):
    return _roundtrip(spark, sf, "parquet")


@query("json_roundtrip", _ORDERS_OUT)
def json_roundtrip(spark, sf):
    return _roundtrip(spark, sf, "json")


@query("csv_roundtrip", _ORDERS_OUT)
def csv_roundtrip(spark, sf):
    return _roundtrip(spark, sf, "csv")


@query("run_layout", """
SELECT 'run_1' AS run_name, 'meta_check' AS step, o_orderstatus AS label, count(*) AS n FROM orders GROUP BY 3
UNION ALL SELECT 'run_1', 'column_check', o_orderpriority, count(*) FROM orders GROUP BY 3""")
def run_layout(spark, sf):
    o = pairs.table(spark, sf, "orders")
    base = results.scratch(spark, "runs")
    for step, column in (("meta_check", "o_orderstatus"), ("column_check", "o_orderpriority")):
        counted = o.groupBy(F.col(column).alias("label")).agg(F.count(F.lit(1)).alias("n"))
        for _ in range(2):  # a step that is run again replaces its rows
            results.write_run(counted, base, "run_1", step)
    return results.read_result(spark, base).select("run_name", "step", "label", *big("n"))


# ---------------------------------------------------------------- flags and names


@query("is_missing", f"SELECT note_id, {missing('note')} AS is_missing FROM c_notes")
def is_missing(spark, sf):
    return derive(spark, sf, "c_notes").select("note_id", text.is_missing(F.col("note")).alias("is_missing"))


@query("enabled_flag", r"SELECT note_id, coalesce(regexp_matches(flag, '(?i)\b(yes|y)\b'), false) AS enabled FROM c_notes")
def enabled_flag(spark, sf):
    return derive(spark, sf, "c_notes").select("note_id", text.enabled_flag(F.col("flag")).alias("enabled"))


@query("enabled_pairs", r"""
SELECT pair_id, trim(right_tbl) AS right_tbl FROM c_pairs_raw
WHERE regexp_full_match(trim(right_tbl), '[^.]+\.[^.]+') AND regexp_matches(enabled, '(?i)\b(yes|y)\b')""")
def enabled_pairs(spark, sf):
    read = controls.read_pairs(derive(spark, sf, "c_pairs_raw"), rename={"unit": "partition"})
    return controls.enabled_pairs(read).select("pair_id", "right_tbl")


@query("is_numeric_type", """
SELECT col_map, column_name, data_type LIKE 'NUMBER%' AS is_numeric FROM c_catl
UNION ALL SELECT col_map, column_name, data_type IN ('double', 'float', 'bigint', 'decimal(10,2)') FROM c_catr""")
def is_numeric_type(spark, sf):
    both = derive(spark, sf, "c_catl").unionByName(derive(spark, sf, "c_catr"))
    return both.select("col_map", "column_name", is_numeric_name(F.col("data_type")).alias("is_numeric"))


@query("types_compatible", """
SELECT l.column_name, l.data_type AS left_type, r.data_type AS right_type,
  CASE WHEN l.data_type LIKE 'NUMBER%' THEN r.data_type IN ('double', 'decimal(10,2)', 'bigint')
       WHEN l.data_type LIKE 'VARCHAR%' THEN r.data_type = 'string'
       WHEN l.data_type = 'DATE' THEN r.data_type IN ('date', 'timestamp')
       WHEN l.data_type LIKE 'TIMESTAMP%' THEN r.data_type = 'timestamp' ELSE false END AS is_compatible
FROM c_catl l JOIN c_catr r ON l.col_map = r.col_map AND lower(l.column_name) = r.column_name""")
def types_compatible_(spark, sf):
    l = derive(spark, sf, "c_catl").select("col_map", "column_name", F.col("data_type").alias("left_type"))
    r = derive(spark, sf, "c_catr").select("col_map", F.upper("column_name").alias("column_name"), F.col("data_type").alias("right_type"))
    return l.join(r, ["col_map", "column_name"]).select(
        "column_name", "left_type", "right_type", types_compatible(F.col("left_type"), F.col("right_type")).alias("is_compatible"))


@query("split_qualified", """
SELECT pair_id, CASE WHEN contains(t, '.') THEN split_part(t, '.', 1) END AS qualifier,
       split_part(t, '.', -1) AS base_name FROM (SELECT pair_id, trim(right_tbl) AS t FROM c_pairs_raw)""")
def split_qualified(spark, sf):
    name = F.trim("right_tbl")
    return derive(spark, sf, "c_pairs_raw").select(
        "pair_id", text.qualifier(name).alias("qualifier"), text.base_name(name).alias("base_name"))


@query("render_value", """
SELECT doc_id, CASE WHEN length(text) > 50 THEN substr(text, 1, 50) || '...' ELSE text END AS shown_text,
  CAST(n_chars AS VARCHAR) AS shown_whole, CAST(n_chars + 0.5 AS VARCHAR) AS shown_part,
  substr(md5(text), 1, 16) || '...' AS shown_digest FROM documents""")
def render_value(spark, sf):
    n = F.col("n_chars").cast("double")
    return pairs.table(spark, sf, "documents").select(
        "doc_id", text.render_value(F.col("text")).alias("shown_text"),
        text.render_value(n, numeric=True).alias("shown_whole"),
        text.render_value(n + 0.5, numeric=True).alias("shown_part"),
        text.render_digest(F.md5("text")).alias("shown_digest"))
