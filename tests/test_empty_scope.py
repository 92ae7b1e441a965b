"""Large statistics as the twins print them, and checks of tables whose days all differ, so that nothing is in scope."""

import duckdb
import parity
import pytest
from pyspark.sql import functions as F

from paritas.operators import rowhash
from paritas.sources.local import local_rows
from paritas.workload.catalogue import QUERIES, TWINS
from paritas.workload.shape import printed


def test_large_statistics_are_printed_like_the_twins(spark):
    values = [389171550790000.0, 508700048910000.0, 1.4036359859e15, 3.5e19, 1.25e20, 8839.4262, -12.5, 0.0, 7e-5, None]
    for decimals in (2, 4):
        want = [r[0] for v in values for r in duckdb.execute(f"SELECT CAST(CAST(CAST(? AS DOUBLE) AS DECIMAL(38,{decimals})) AS VARCHAR)", [v]).fetchall()]
        rows = local_rows(spark, list(enumerate(values)), "i int, v double").orderBy("i").select(printed(F.col("v"), decimals).cast("string")).collect()
        assert [r[0] for r in rows] == want


def written(folder, orders):
    """Orders ``(key, day)`` and a few rows of the other tables that a run reads."""
    con = duckdb.connect()
    con.execute("CREATE TABLE given (k BIGINT, d INTEGER)")
    con.executemany("INSERT INTO given VALUES (?, ?)", orders)
    tables = {
        "orders": "SELECT k AS o_orderkey, k % 7 AS o_custkey, 'O' AS o_orderstatus, 100.0 + k AS o_totalprice, "
                  "TIMESTAMP '1996-01-01' + to_days(d) AS o_orderdate, '1-URGENT' AS o_orderpriority FROM given",
        "customer": "SELECT range AS c_custkey, 'c' || range AS c_name, 1 AS c_nationkey, 1.5 AS c_acctbal, 'BUILDING' AS c_mktsegment FROM range(5)",
        "part": "SELECT range AS p_partkey, 'p' || range AS p_name, 'Brand#1' AS p_brand, 'T' AS p_type, 1 AS p_size, 2.5 AS p_retailprice FROM range(70)",
        "nation": "SELECT 1 AS n_nationkey, 'N' AS n_name, 2 AS n_regionkey"}
    for name, sql in tables.items():
        sql = sql.replace("100.0 + k", "CAST(100 + k AS DOUBLE)").replace("1.5", "CAST(1.5 AS DOUBLE)").replace("2.5", "CAST(2.5 AS DOUBLE)")
        con.execute(f"COPY ({sql}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.fixture(scope="module")
def all_days_differ(tmp_path_factory):
    """Every even day of the month loses an order on the right and every odd one gains one."""
    defect = lambda d: 7 + 101 * (d + 1) if (d + 1) % 2 == 0 else 5 + 211 * (d + 1)
    return written(tmp_path_factory.mktemp("differ"), [row for d in range(30) for row in ((defect(d), d), (100_002 + 101 * 211 * d, d))])


@pytest.mark.parametrize("name", ["column_status_counts", "hash_summary", "hash_table_status", "meta_details", "run_columns", "run_hashes", "table_fingerprint"])
def test_nothing_in_scope(spark, all_days_differ, name):
    assert parity.difference(spark, parity.connect(all_days_differ), name, QUERIES[name], TWINS[name], all_days_differ) is None


def test_no_vintage_is_reported_where_nothing_is_in_scope(spark, all_days_differ):
    assert parity.connect(all_days_differ).execute(TWINS["hash_check"]).fetchall() == []
    assert QUERIES["hash_check"](spark, all_days_differ).collect() == []


def test_a_table_with_rows_on_one_side_fails(spark):
    prints = lambda left, right: local_rows(spark, [(left, right, left == right)], "left_rows bigint, right_rows bigint, is_match boolean")
    none = prints(0, 0).where("false")
    assert [tuple(rowhash.table_status(prints(*n), none, none).first())[::5] for n in ((3, 0), (0, 0), (2, 2))] == [(False, "FAIL"), (None, "PARTIAL"), (True, "PASS")]


def test_every_differing_key_is_listed(spark, tmp_path):
    """10,060 orders, all on the 1st of January and all dearer by half on the right."""
    sf = written(tmp_path, [(53 * i, 0) for i in range(1, 10_061)])
    assert QUERIES["mismatch_cap"](spark, sf).count() > 10_000
    assert parity.difference(spark, parity.connect(sf), "mismatch_cap", QUERIES["mismatch_cap"], TWINS["mismatch_cap"], sf) is None
