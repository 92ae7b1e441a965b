"""Control-table inputs derived from the given tables.

A catalogue estate the size of ``part``: every part stands for one table pair and for
one mapped column, so the control-table operators see work that grows with the data.
The derivations are plain SQL that both engines read; they produce *inputs* only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .pairs import table

PAIR_LIST = """
SELECT p_partkey AS pair_id,
  CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE '  svc' || CAST(p_size AS STRING) || ' (legacy) ' END AS left_svc,
  ' ' || p_type || '_' || CAST(p_partkey AS STRING)
      || CASE WHEN p_partkey % 4 = 0 THEN ' (old copy)' ELSE '' END || ' ' AS left_tbl,
  ' Load_Dt' AS left_var,
  CASE WHEN p_partkey % 13 = 0 THEN 'no_dot_' || CAST(p_partkey AS STRING)
       WHEN p_partkey % 17 = 0 THEN 'a.b.c' || CAST(p_partkey AS STRING)
       ELSE ' db' || CAST(p_size AS STRING) || '.' || lower(p_type) || '_' || CAST(p_partkey AS STRING) END AS right_tbl,
  'Load_Dt ' AS right_var,
  CASE p_partkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'all' WHEN 2 THEN ' week' WHEN 3 THEN 'month ' WHEN 4 THEN 'year'
       ELSE 'snapshot' END AS unit,
  CASE p_partkey % 5 WHEN 0 THEN 'Yes' WHEN 1 THEN 'y - ok' WHEN 2 THEN 'no' WHEN 3 THEN 'yesterday' ELSE NULL END AS enabled,
  CASE p_partkey % 4 WHEN 0 THEN CAST(45292 + p_size AS STRING)
       WHEN 1 THEN '2024-01-' || lpad(CAST(1 + p_size % 28 AS STRING), 2, '0')
       WHEN 2 THEN 'n/a' ELSE '01/15/2024' END AS start_dt,
  CASE p_partkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '2025/12/31' ELSE 'nat' END AS end_dt,
  CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_brand END AS col_map
FROM {part}"""

CROSSWALK = """
SELECT p_partkey AS ord, p_brand AS col_map,
  ' ' || replace(p_name, ' ', '_') || '_' || CAST(p_partkey AS STRING) AS left_col,
  CASE p_partkey % 8 WHEN 0 THEN NULL WHEN 1 THEN 'nan'
       ELSE upper(replace(p_name, ' ', '_')) || '_' || CAST(p_partkey AS STRING) || ' ' END AS right_col,
  p_partkey % 7 = 0 AS is_tokenized
FROM {part}
UNION ALL
SELECT p_partkey + 1000000000, p_brand,
  upper(replace(p_name, ' ', '_')) || '_' || CAST(p_partkey AS STRING),
  lower(replace(p_name, ' ', '_')) || '_' || CAST(p_partkey AS STRING) || '_v2',
  false
FROM {part} WHERE p_partkey % 23 = 0"""

LEFT_CATALOG = """
SELECT p_brand AS col_map, upper(replace(p_name, ' ', '_')) || '_' || CAST(p_partkey AS STRING) AS column_name,
  CASE p_partkey % 5 WHEN 0 THEN 'NUMBER(10,2)' WHEN 1 THEN 'VARCHAR2(20)' WHEN 2 THEN 'DATE'
       WHEN 3 THEN 'TIMESTAMP(6)' ELSE 'RAW(16)' END AS data_type
FROM {part} WHERE NOT p_partkey % 10 = 9
UNION ALL
SELECT 'Brand#' || CAST(1 + s_suppkey % 25 AS STRING), 'EXTRA_' || CAST(s_suppkey AS STRING), 'NUMBER'
FROM {supplier}"""

RIGHT_CATALOG = """
SELECT p_brand AS col_map,
  lower(replace(p_name, ' ', '_')) || '_' || CAST(p_partkey AS STRING)
      || CASE WHEN p_partkey % 23 = 0 THEN '_v2' ELSE '' END AS column_name,
  CASE p_partkey % 6 WHEN 0 THEN 'double' WHEN 1 THEN 'string' WHEN 2 THEN 'date' WHEN 3 THEN 'timestamp'
       WHEN 4 THEN 'decimal(10,2)' ELSE 'float' END AS data_type
FROM {part} WHERE NOT p_partkey % 9 = 8
UNION ALL
SELECT 'Brand#' || CAST(1 + s_suppkey % 25 AS STRING), 'extra_r_' || CAST(s_suppkey AS STRING), 'bigint'
FROM {supplier}"""

# notes as people write them, for the tokenised flag, the enabled flag and missing values
NOTES = """
SELECT p_partkey AS note_id, p_brand AS sheet,
  CASE p_partkey % 8 WHEN 0 THEN 'Tokenise at source. See ' || p_name WHEN 1 THEN p_name || '. tokenise later'
       WHEN 2 THEN NULL WHEN 3 THEN ' NaN ' WHEN 4 THEN '' WHEN 5 THEN 'None' WHEN 6 THEN 'will be tokenised, ' || p_name
       ELSE p_name END AS note,
  CASE p_partkey % 7 WHEN 0 THEN 'YES please' WHEN 1 THEN 'n/y' WHEN 2 THEN 'yesterday' WHEN 3 THEN NULL
       WHEN 4 THEN 'no' WHEN 5 THEN 'Y' ELSE p_type END AS flag
FROM {part}"""

# dates of orders written in the notations people use, and some that are none
WRITTEN_DATES = """
SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS d,
  CASE o_orderkey % 10
    WHEN 0 THEN {iso} WHEN 1 THEN {compact} WHEN 2 THEN {slashed} WHEN 3 THEN {us} WHEN 4 THEN {named}
    WHEN 5 THEN {iso} || ' 10:15:00' WHEN 6 THEN {iso} || 'T23:59:59.123' WHEN 7 THEN {european}
    WHEN 8 THEN 'invalid_' || CAST(o_orderkey AS STRING) ELSE {month_13} END AS s
FROM {orders}"""

_SPARK_DATES = {
    "iso": "date_format(o_orderdate, 'yyyy-MM-dd')", "compact": "date_format(o_orderdate, 'yyyyMMdd')",
    "slashed": "date_format(o_orderdate, 'yyyy/MM/dd')", "us": "date_format(o_orderdate, 'MM/dd/yyyy')",
    "named": "date_format(o_orderdate, 'MMM d, yyyy')", "european": "date_format(o_orderdate, 'dd/MM/yyyy')",
    "month_13": "date_format(o_orderdate, 'yyyy') || '13' || date_format(o_orderdate, 'dd')",
}
_DUCK_DATES = {
    "iso": "strftime(o_orderdate, '%Y-%m-%d')", "compact": "strftime(o_orderdate, '%Y%m%d')",
    "slashed": "strftime(o_orderdate, '%Y/%m/%d')", "us": "strftime(o_orderdate, '%m/%d/%Y')",
    "named": "strftime(o_orderdate, '%b %-d, %Y')", "european": "strftime(o_orderdate, '%d/%m/%Y')",
    "month_13": "strftime(o_orderdate, '%Y') || '13' || strftime(o_orderdate, '%d')",
}

_TEXTS = {"c_pairs_raw": PAIR_LIST, "c_xw": CROSSWALK, "c_catl": LEFT_CATALOG, "c_catr": RIGHT_CATALOG,
          "c_notes": NOTES, "c_dates": WRITTEN_DATES}
_TABLES = ("part", "supplier", "orders")


def duckdb_parts() -> dict[str, str]:
    fill = {**{t: t for t in _TABLES}, **_DUCK_DATES}
    return {name: text.format(**{k: v for k, v in fill.items() if "{" + k + "}" in text}) for name, text in _TEXTS.items()}


def derive(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """One of the derived inputs as a DataFrame."""
    text = _TEXTS[name].format(**{t: "{" + t + "}" for t in _TABLES}, **_SPARK_DATES)
    used = {t: table(spark, sf, t) for t in _TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)
