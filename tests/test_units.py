"""Literal cases and edge cases of single operators."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from paritas.functions import compare, dates, hashing, normalize, text
from paritas.functions.types import is_numeric_name, types_compatible
from paritas.operators import crosswalk as cw, daycounts, profile, quality, rowhash
from paritas.operators.columns import same_columns
from paritas.sources import controls, results, scan
from paritas.sources.local import local_rows


def values(spark, items, expr, kind="string"):
    df = local_rows(spark, [(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


@pytest.mark.parametrize("written,expected", [
    ("2024-01-15", "2024-01-15"), ("20240115", "2024-01-15"), ("2024/01/15", "2024-01-15"), ("01/15/2024", "2024-01-15"),
    ("Jan 15, 2024", "2024-01-15"), ("January 15, 2024", "2024-01-15"), ("15 Jan 2024", "2024-01-15"),
    ("2024-01-15 10:30:00", "2024-01-15"), ("2024-01-15T10:30:00.123", "2024-01-15"), ("15/01/2024", "2024-01-15"),
    ("NaT", None), ("invalid_date", None), ("20241399", None), ("2024", None), ("", None), (None, None),
])
def test_parse_any(spark, written, expected):
    assert values(spark, [written], lambda c: dates.parse_any(c).cast("string")) == [expected]


def test_parse_strict_reads_day_first_and_no_bare_numbers(spark):
    got = values(spark, ["03/02/2024", "2024-02-03 23:59:59", "150000", "2024", "12345678"], lambda c: dates.parse_strict(c).cast("string"))
    assert got == ["2024-02-03", "2024-02-03", None, None, None]


def test_excel_serial(spark):
    assert values(spark, ["45292", "45292.5", "2024-01-01", "01/15/2024", "tbd", None], dates.excel_serial) == [
        "2024-01-01", "2024-01-01", "2024-01-01", "2024-01-15", "", ""]


def test_day_counts_of_mixed_notations(spark):
    rows = [("2024-01-01",)] * 100 + [("20240102",)] * 150 + [("2024-01-03",)] * 200
    df = local_rows(spark, rows, "d string")
    got = {str(r["day"]): r["n"] for r in daycounts.row_counts(df, dates.parse_any(F.col("d"))).collect()}
    assert got == {"2024-01-01": 100, "2024-01-02": 150, "2024-01-03": 200}


def test_null_day_is_its_own_bucket_and_leaves_the_scope(spark):
    df = local_rows(spark, [(dt.date(2024, 1, 1), 1, 1), (None, 5, 4)], "day date, n_left bigint, n_right bigint")
    assert [r["vintage"] for r in daycounts.scope_days(df, "month").collect()] == ["M202401"]


def test_bounds_and_windows_of_nothing(spark):
    empty = local_rows(spark, [], "day date, n bigint")
    assert dates.windows(daycounts.bounds(empty), "month").collect() == []
    assert daycounts.match_summary(local_rows(spark, [], "day date, n_left bigint, n_right bigint")).first()["all_match"] is False


def test_week_windows_start_before_and_end_at_the_bounds(spark):
    bounds = local_rows(spark, [(dt.date(2024, 12, 31), dt.date(2025, 1, 8))], "min_day date, max_day date")
    got = [(r[0], str(r[1]), str(r[2])) for r in dates.windows(bounds, "week").orderBy("start_date").collect()]
    assert got == [("W2025W01", "2024-12-30", "2025-01-05"), ("W2025W02", "2025-01-06", "2025-01-08")]


def test_single_day_and_single_window(spark):
    one = local_rows(spark, [(dt.date(2024, 2, 29), dt.date(2024, 2, 29))], "min_day date, max_day date")
    for unit, label in (("day", "D20240229"), ("month", "M202402"), ("year", "Y2024"), ("snapshot", "all")):
        rows = dates.windows(one, unit).collect()
        assert [(r["vintage"], str(r["end_date"])) for r in rows] == [(label, "2024-02-29")]


def test_unknown_partition_is_refused():
    with pytest.raises(ValueError):
        dates.partition_unit("fortnight")


def test_window_predicate_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id", "date_format(date_add(date'2024-01-01', cast(id as int)), 'yyyyMMdd') AS d").write.parquet(path)
    df = spark.read.parquet(path)
    kept = df.where(dates.within(F.col("d"), df.schema["d"].dataType, dates.COMPACT, "2024-01-03", "2024-01-05"))
    assert sorted(r["d"] for r in kept.collect()) == ["20240103", "20240104", "20240105"]
    assert "GreaterThanOrEqual(d,20240103)" in kept._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------- normalisation and hashes


def test_pseudo_nulls_and_cleaning(spark):
    cases = ["null", " NUL ", "None", "n/a", "<na>", "empty", "NIL", ".", "", None, " a\t b ", "x  y", "a\x00b"]
    assert values(spark, cases, normalize.norm_label) == [None] * 10 + ["A B", "X Y", "AB"]


def test_numbers(spark):
    got = values(spark, [1001.0, 500.0, 0.0, None, -0.0004, 1.0005, 1e30, float("nan"), -12.3456], lambda c: normalize.norm_number(c, T.DoubleType()), "double")
    assert got == ["1001.000", "500.000", "0", "0", "0.000", "1.001", "1" + "0" * 30 + ".000", "NaN", "-12.346"]
    assert values(spark, [1001, 0, None], lambda c: normalize.norm_number(c, T.LongType()), "bigint") == ["1001.000", "0", "0"]
    assert values(spark, ["711.56", "abc", "", None], lambda c: normalize.norm_number(c, T.StringType())) == ["711.560", "ABC", "0", "0"]
    assert values(spark, [Decimal("1.2345")], lambda c: normalize.norm_number(c, T.DecimalType(10, 4)), "decimal(10,4)") == ["1.235"]


def test_row_text_and_empty_hash(spark):
    df = local_rows(spark, [(1001.0, 500.0)], "a double, b double")
    normal = [normalize.norm_number(F.col(c), T.DoubleType()) for c in "ab"]
    assert df.select(hashing.row_concat(normal)).first()[0] == "1001.000|500.000"
    assert df.select(hashing.row_sha256([])).first()[0] is None


def _hashes(spark, rows, schema="k bigint, hash_value string, vintage string"):
    return local_rows(spark, rows, schema)


HA, HB, HC = "AA" * 32, "BB" * 32, "CC" * 32


def test_key_comparison(spark):
    left = _hashes(spark, [(1001, HA, "v"), (1002, HB, "v"), (1003, HC, "v")])
    right = _hashes(spark, [(1001, HA, "v"), (1002, HC, "v"), (1004, HA, "v")])
    compared = rowhash.compare_keys(left, right, ["k"], ["vintage"])
    c = rowhash.compare_counts(compared, ["vintage"]).first()
    assert (c["matched"], c["hash_mismatch"], c["left_only"], c["right_only"]) == (1, 1, 1, 1)
    sample = rowhash.sample_mismatches(compared, ["k"], ["vintage"]).collect()
    assert [(r["k"], r["left_hash"], r["right_hash"]) for r in sample] == [(1002, HB, HC)]


def test_null_keys_pair_up_and_empty_sides(spark):
    null = _hashes(spark, [(None, HA, "v")])
    assert [r["status"] for r in rowhash.compare_keys(null, null, ["k"], ["vintage"]).collect()] == ["matched"]
    empty = _hashes(spark, [])
    assert rowhash.compare_counts(rowhash.compare_keys(empty, empty, ["k"], ["vintage"]), ["vintage"]).collect() == []
    one = rowhash.compare_counts(rowhash.compare_keys(null, empty, ["k"], ["vintage"]), ["vintage"]).first()
    assert (one["left_only"], one["right_only"], one["matched"]) == (1, 0, 0)


def test_duplicate_keys_count_like_a_join(spark):
    """Against a brute-force join, with a key that holds most rows."""
    left = _hashes(spark, [(1, HA, "v")] * 30 + [(1, HB, "v")] * 5 + [(2, HA, "v")] * 2 + [(3, HC, "v")])
    right = _hashes(spark, [(1, HA, "v")] * 20 + [(1, HC, "v")] * 4 + [(2, HA, "v")] + [(4, HC, "v")] * 3)
    got = rowhash.compare_counts(rowhash.compare_keys(left, right, ["k"], ["vintage"]), ["vintage"]).first()
    l, r = left.collect(), right.collect()
    pairs = [(a["hash_value"], b["hash_value"]) for a in l for b in r if a["k"] == b["k"]]
    assert got["matched"] == sum(a == b for a, b in pairs)
    assert got["hash_mismatch"] == sum(a != b for a, b in pairs)
    assert (got["left_only"], got["right_only"]) == (1, 3)
    for row in rowhash.compare_keys(left, right, ["k"], ["vintage"]).where("hash_mismatch > 0").collect():
        assert row["left_hash"] != row["right_hash"]


def test_shown_pair_differs_when_low_and_high_coincide(spark):
    left = _hashes(spark, [(1, HA, "v"), (1, HB, "v")])
    right = _hashes(spark, [(1, HA, "v")])
    row = rowhash.compare_keys(left, right, ["k"], ["vintage"]).first()
    assert (row["left_hash"], row["right_hash"]) == (HB, HA)


def test_no_keys_is_refused_and_multisets_work(spark):
    left = _hashes(spark, [(None, HA, "v"), (None, HA, "v"), (None, HB, "v")])
    right = _hashes(spark, [(None, HA, "v"), (None, HB, "v")])
    with pytest.raises(ValueError):
        rowhash.compare_keys(left, right, [], ["vintage"])
    assert [(r["hash_value"], r["n_left"], r["n_right"]) for r in rowhash.compare_multisets(left, right, ["vintage"]).collect()] == [(HA, 2, 1)]


def test_hash_counts(spark):
    df = _hashes(spark, [(1, HA, "v"), (2, HB, "v"), (3, HA, "v")])
    row = rowhash.hash_counts(df, ["vintage"]).first()
    assert (row["total_rows"], row["unique_hashes"]) == (3, 2)


def test_fingerprint_ignores_order_and_merges(spark):
    df = spark.range(1000).selectExpr("id AS a", "cast(id % 7 AS string) AS b", "'v' || id % 3 AS vintage")
    columns = same_columns(df, ["a", "b"])
    one = rowhash.fingerprints(df, columns, "left", []).first()
    other = rowhash.fingerprints(df.repartition(13, "b").orderBy(F.rand(1)), columns, "left", []).first()
    assert one == other
    digest = hashing.row_md5([p.normal(df, "left") for p in columns]).alias("d")
    whole = df.select(digest).agg(*hashing.fingerprint_sums(F.col("d"))).first()
    parts = df.select("vintage", digest).groupBy("vintage").agg(*hashing.fingerprint_sums(F.col("d"))).collect()
    assert all(whole[f"limb_{i}"] == sum(p[f"limb_{i}"] for p in parts) for i in range(6))
    twice = rowhash.fingerprints(df.union(df.limit(1)), columns, "left", []).first()
    assert twice["fingerprint"] != one["fingerprint"]


# ---------------------------------------------------------------- profiles and verdicts


def test_profile_edge_columns(spark):
    df = local_rows(spark, [(1, None, "v"), (1, None, "v"), (None, None, "v"), (3, "x", "v")], "n bigint, t string, vintage string")
    got = {r["column"]: r for r in profile.profile(df, same_columns(df, ["n", "t"]), ["vintage"]).collect()}
    n, t = got["n"], got["t"]
    assert (n["count"], n["distinct"], n["missing"], n["min"], n["max"], n["sum"]) == (3, 2, 1, "1", "3", 5.0)
    # NULL is the most frequent value: one value of its own, shown as nothing
    assert (t["count"], t["distinct"], t["missing"], t["min"], t["max"]) == (4, 2, 3, "1", "3")
    assert [(f["value"], f["n"]) for f in t["freq"]] == [(None, 3), ("x", 1)]


def test_profile_of_one_row_and_all_null(spark):
    df = local_rows(spark, [(7, "v"), ], "n bigint, vintage string")
    row = profile.profile(df, same_columns(df, ["n"]), ["vintage"]).first()
    assert row["std"] is None and row["avg"] == 7.0
    nulls = local_rows(spark, [(None, "v")], "n bigint, vintage string")
    row = profile.profile(nulls, same_columns(nulls, ["n"]), ["vintage"]).first()
    assert (row["count"], row["distinct"], row["missing"], row["min"]) == (0, 0, 1, None)


def test_large_longs_keep_their_identity(spark):
    big = 2 ** 60
    df = local_rows(spark, [(big, "v"), (big + 1, "v"), (big + 2, "v")], "n bigint, vintage string")
    assert profile.profile(df, same_columns(df, ["n"]), ["vintage"]).first()["distinct"] == 3


def _stat(side, column, vintage="v1", **over):
    base = dict(kind="continuous", count=10, distinct=5, missing=0, min="1", max="9", avg=4.0, std=1.0, sum=40.0, sum_sq=200.0, freq=None)
    base.update(over)
    return (side, vintage, column, *[base[s] for s in quality.STRUCT_STATS])


STATS_SCHEMA = ("side string, vintage string, column string, kind string, count bigint, distinct bigint, missing bigint, min string, "
                "max string, avg double, std double, sum double, sum_sq double, freq array<struct<value:string,n:bigint>>")


def test_quality_over_vintages(spark):
    rows = []
    for v in ("v1", "v2"):
        for c in ("ACCT_ID", "BALANCE", "STATUS"):
            rows.append(_stat("left", c, v, count=1100 if c == "BALANCE" and v == "v2" else 1050))
            rows.append(_stat("right", c, v, count=1050))
    stats = local_rows(spark, rows, STATS_SCHEMA)
    flagged = quality.stat_flags(quality.side_by_side(stats, ["vintage"]))
    got = {r["column"]: r["is_mismatched"] for r in quality.column_verdicts(flagged).collect()}
    assert got == {"ACCT_ID": False, "BALANCE": True, "STATUS": False}
    missing_side = quality.stat_flags(quality.side_by_side(stats.where("side = 'left'"), ["vintage"]))
    assert not any(r["is_match"] for r in missing_side.collect())


def test_key_columns_by_cardinality(spark):
    rows = [(f"COL_{c}", False, d) for c, d in zip("ABCDE", (1000, 500, 300, 100, 10))]
    df = local_rows(spark, rows, "column string, is_mismatched boolean, max_distinct bigint")
    assert [r["column"] for r in quality.key_columns(df, n=3).orderBy("key_rank").collect()] == ["COL_A", "COL_B", "COL_C"]
    assert quality.key_columns(df.where("false")).collect() == []


def test_stat_tolerances(spark):
    stats = local_rows(spark, [_stat("left", "X", avg=150.25, missing=0), _stat("right", "X", avg=150.25000001, missing=None)], STATS_SCHEMA)
    assert quality.stat_flags(quality.side_by_side(stats, ["vintage"])).first()["is_match"] is True


def test_graded_status(spark):
    same, other = [("a", 2), ("b", 1)], [("a", 2), ("c", 1)]
    rows = [_stat("left", "P", freq=same), _stat("right", "P", freq=list(reversed(same))),
            _stat("left", "Q", freq=same), _stat("right", "Q", freq=other),
            _stat("left", "R", freq=same, sum=1.0), _stat("right", "R", freq=same, sum=2.0)]
    got = {r["column"]: (r["status"], r["mismatch_count"]) for r in quality.graded(quality.side_by_side(local_rows(spark, rows, STATS_SCHEMA), ["vintage"])).collect()}
    assert got == {"P": ("PASS", 0), "Q": ("PARTIAL", 1), "R": ("FAIL", 1)}


@pytest.mark.parametrize("l,r,flex,rob", [
    ("20240115", "2024-01-15", True, True), ("20240115", "20240116", False, True), ("2024-01-15", "2024/01/15", True, True), ("1.0", "1.0000001", True, True),
    ("1", "2", False, False), ("a", "a", True, True), ("a", "b", False, False), (None, None, True, True),
    ("0", None, False, True), (None, "0.0", False, True), ("x", None, False, False),
])
def test_comparers(spark, l, r, flex, rob):
    df = local_rows(spark, [(l, r)], "l string, r string")
    row = df.select(compare.flexible(F.col("l"), F.col("r")), compare.robust(F.col("l"), F.col("r"))).first()
    assert tuple(row) == (flex, rob)


def test_freq_parse_and_text(spark):
    got = values(spark, ["b::2||a::b::10||broken||x::y", "", None], lambda c: compare.freq_text(compare.freq_parse(c)))
    assert got == ["a::b(10); b(2)", "", None]


# ---------------------------------------------------------------- control tables


def test_crosswalk_classes(spark):
    catalog = local_rows(spark, [("t", c, "NUMBER") for c in ("ACCT_ID", "ACCT_NAME", "SSN", "BALANCE", "EXTRA_COL")], "col_map string, column_name string, data_type string")
    xw = local_rows(spark, [(1, "t", "acct_id", "acct_id", False), (2, "t", "ACCT_NAME", "name", False), (3, "t", "SSN", "ssn", True)],
                    "ord int, col_map string, left_col string, right_col string, is_tokenized boolean")
    got = {r["column_name"]: r["class"] for r in cw.classify(catalog, xw, "left").collect()}
    assert got == {"ACCT_ID": "comparable", "ACCT_NAME": "comparable", "SSN": "tokenized", "BALANCE": "unmapped", "EXTRA_COL": "unmapped"}
    nothing = cw.classify(catalog, xw.where("false"), "left")
    assert {r["class"] for r in nothing.collect()} == {"unmapped"}


def test_numeric_type_names(spark):
    numeric = ["NUMBER(10,2)", "DECIMAL(15,3)", "FLOAT(126)", "int", "bigint", "smallint", "tinyint", "double"]
    other = ["varchar(10)", "date", "timestamp", "boolean", "array<int>", "struct<a:int>", "unknown", "interval day"]
    assert values(spark, numeric + other, is_numeric_name) == [True] * len(numeric) + [False] * len(other)


def test_type_compatibility(spark):
    cases = [("NUMBER(10)", "decimal(10,2)", True), ("VARCHAR2(5)", "string", True), ("DATE", "timestamp", True), ("TIMESTAMP(6)", "date", False), ("RAW(16)", "string", False)]
    df = local_rows(spark, [(a, b) for a, b, _ in cases], "a string, b string")
    assert [r[0] for r in df.select(types_compatible(F.col("a"), F.col("b"))).collect()] == [c for _, _, c in cases]


def test_pair_list_rejects_unknown_partitions(spark):
    row = ("svc", "t", "d", "db.t", "d", "fortnight", "yes", None, None)
    raw = local_rows(spark, [row], "left_svc string, left_tbl string, left_var string, right_tbl string, right_var string, partition string, enabled string, start_dt string, end_dt string")
    assert [r["partition"] for r in controls.invalid_partitions(raw).collect()] == ["fortnight"]
    with pytest.raises(Exception, match="fortnight"):
        controls.read_pairs(raw).collect()


def test_missing_words(spark):
    assert values(spark, ["", " NaN ", "NaT", "none", "NULL", None, "x"], text.is_missing) == [True] * 6 + [False]


def test_run_paths_and_probe(spark, tmp_path):
    assert results.run_path("s3://b/", "run", None, "/x.json") == "s3://b/run/x.json"
    assert results.run_path("/b", "run", "/step/", "x") == "/b/run/step/x"
    ok, error = scan.probe(spark, str(tmp_path / "absent"))
    assert not ok and error == "PATH_NOT_FOUND"


def test_shared_dir_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert results.shared_dir(spark) == configured
