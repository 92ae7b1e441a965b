"""Exact numbers, mixed notations, nested values, gates, samples and reruns, each against a plain account."""

import datetime as dt
import math
import random
from collections import Counter
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F, types as T

from paritas.functions import dates, normalize
from paritas.operators import filters, gate, profile, rowhash
from paritas.operators.columns import DIGITS, exact_type, pair_columns, same_columns
from paritas.plans import ReconPair
from paritas.sources import results
from paritas.sources.local import local_rows


def values(spark, items, expr, kind="string"):
    df = local_rows(spark, [(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


# ---------------------------------------------------------------- numbers


def test_digits_of_numbers(spark):
    text = lambda c: normalize.number_text(c, T.StringType())
    assert values(spark, ["007", "+7", "7.0", "-0", "-0.00", "0012.340", "1e3", ".5", " 5. ", "9" * 60, "0" + "9" * 60, "x 1", "", None, "100", "-0100.10", "1,000"], text) == [
        "7", "7", "7", "0", "0", "12.34", "1000", "0.5", "5", "9" * 60, "9" * 60, "x 1", "", None, "100", "-100.1", "1,000"]
    assert values(spark, [Decimal("12.3400"), Decimal("-100"), Decimal("0")], lambda c: normalize.number_text(c, T.DecimalType(10, 4)), "decimal(10,4)") == ["12.34", "-100", "0"]
    assert values(spark, [12.5, 1e10, -0.0, 100.0], lambda c: normalize.number_text(c, T.DoubleType()), "double") == ["12.5", "10000000000", "0", "100"]
    assert values(spark, [120, -5, 0, None], lambda c: normalize.number_text(c, T.LongType()), "bigint") == ["120", "-5", "0", None]


@pytest.mark.parametrize("left,right,want", [
    (T.LongType(), T.IntegerType(), "bigint"), (T.LongType(), T.DecimalType(10, 2), "decimal(38,2)"), (T.DecimalType(38, 0), T.LongType(), "decimal(38,0)"),
    (T.DecimalType(38, 0), T.DecimalType(20, 5), DIGITS), (T.LongType(), T.StringType(), DIGITS), (T.DoubleType(), T.LongType(), DIGITS)])
def test_key_types(left, right, want):
    assert exact_type(left, right) == want


def test_long_digits_are_hashed_exactly(spark):
    norm = lambda c: normalize.norm_number(c, T.StringType())
    assert values(spark, ["9" * 30, "9" * 30 + ".1234", "9" * 36, "9" * 50], norm) == ["9" * 30 + ".000", "9" * 30 + ".123", "9" * 36, "9" * 50]
    wide = lambda c: normalize.norm_number(c, T.DecimalType(38, 0))
    assert values(spark, [Decimal("9" * 30), Decimal("9" * 36)], wide, "decimal(38,0)") == ["9" * 30 + ".000", "9" * 36]


def keyed(spark, left, right, left_kind, right_kind):
    mapped = spark.createDataFrame([("K", "k", False), ("V", "v", False)], "left_col string, right_col string, is_tokenized boolean")
    return ReconPair("t", local_rows(spark, left, f"K {left_kind}, V string"), local_rows(spark, right, f"k {right_kind}, v string"), mapped, keys=["K"], hash_all=True)


def test_no_key_becomes_null(spark):
    """32-digit keys, and text that is no number: what was all one key before."""
    long = [Decimal("1" * 24 + f"{i:08d}") for i in range(50)]
    row = keyed(spark, [(k, "a") for k in long], [(str(k), "a") for k in long], "decimal(38,0)", "string").hash_check().first()
    assert (row["matched"], row["hash_mismatch"], row["left_only"]) == (50, 0, 0)
    row = keyed(spark, [(i, "a") for i in range(20)], [(f"no {i}", "a") for i in range(20)], "bigint", "string").hash_check().first()
    assert (row["matched"], row["hash_mismatch"], row["left_only"], row["right_only"]) == (0, 0, 20, 20)
    row = keyed(spark, [(1.5, "a"), (None, "a")], [("1.50", "a"), (None, "a")], "double", "string").hash_check().first()
    assert (row["matched"], row["hash_mismatch"]) == (2, 0)


# ---------------------------------------------------------------- moments

AWKWARD = [1e16, 1.0, -1e16, 1e-20, 3.3, 2.0**20, 2.0**20 - 2.0**-32, 2.0**40, -(2.0**60), 5e-324, 0.1, 0.1, 0.2, -0.3, 1e150, -1e150, 123456.789, 0.0, None]


def bits(x):
    return None if x is None else x.hex()


def test_moments_are_bit_equal_however_the_rows_are_split(spark):
    rng = random.Random(8)
    rows = [("awkward", x) for x in AWKWARD] + [("far", 1.7e9 + rng.random()) for _ in range(500)] + [("one", 7.25), ("none", None)]
    rows += [("price", round(rng.uniform(1, 5e5), 2)) for _ in range(900)] + [("inf", float("inf")), ("inf", 1.0), ("nan", float("nan")), ("nan", 2.0)]
    seen = set()
    for n in (1, 7, 64):
        rng.shuffle(rows)
        df = local_rows(spark, rows, "vintage string, x double").repartition(n)
        found = profile.profile(df, same_columns(df, ["x"]), ["vintage"]).collect()
        seen.add(tuple(sorted((r["vintage"], r["count"], r["missing"], *[bits(r[s]) for s in ("avg", "std", "sum", "sum_sq")]) for r in found)))
    assert len(seen) == 1
    told = {r["vintage"]: r for r in found}
    for name in ("awkward", "far", "price"):
        exact = [Fraction(x) for v, x in rows if v == name and x is not None]
        assert told[name]["sum"] == pytest.approx(float(sum(exact)), rel=1e-15)
        assert told[name]["sum_sq"] == pytest.approx(float(sum(x * x for x in exact)), rel=1e-15)
        assert told[name]["avg"] == pytest.approx(float(sum(exact) / len(exact)), rel=1e-15)
        mean = sum(exact) / len(exact)
        assert told[name]["std"] == pytest.approx(math.sqrt(sum((x - mean) ** 2 for x in exact) / (len(exact) - 1)), rel=1e-14)
    assert (told["one"]["avg"], told["one"]["std"], told["none"]["avg"], told["none"]["count"], told["inf"]["sum"]) == (7.25, None, None, 0, float("inf"))
    assert math.isnan(told["nan"]["avg"]) and math.isnan(told["inf"]["std"])


# ---------------------------------------------------------------- dates in several notations


def test_window_keeps_other_notations(spark):
    days = ["20240115", "2024-02-01", "01/15/2024", "Jan 15, 2024", "2023-12-31", "20231231", "20250101", "12/31/2023", "nothing", None, "2024-01-15T10:00:00", "20230601"]
    df = local_rows(spark, [(d,) for d in days], "d string")
    inside = lambda fmt, **more: sorted(r["d"] for r in filters.in_window(df, "d", "2024-01-01", "2024-12-31", fmt=fmt, **more).collect())
    want = sorted(["20240115", "2024-02-01", "01/15/2024", "Jan 15, 2024", "2024-01-15T10:00:00"])
    assert all(inside(fmt) == want for fmt in (dates.COMPACT, dates.ISO, dates.SLASHED, dates.ISO_TIME, None))
    assert inside(dates.COMPACT, mixed=False) != want


def test_pair_looks_for_other_notations_only_under_a_window(spark):
    mapped = spark.createDataFrame([("D", "d", False)], "left_col string, right_col string, is_tokenized boolean")
    left = local_rows(spark, [(dt.date(2024, 1, 1 + i % 28),) for i in range(100)], "D date")
    right = local_rows(spark, [(f"01/{1 + i % 28:02d}/2024" if i % 5 == 0 else f"2024-01-{1 + i % 28:02d}",) for i in range(100)], "d string")
    make = lambda right, **more: ReconPair("t", left, right, mapped, "D", "d", **more)
    pair = make(right, start="2024-01-01", end="2024-12-31")
    assert pair.rows("right").count() == pair.rows("left").count() == 100 and pair._mixed("right")
    assert not make(right)._mixed("right")
    plain = make(right.where("d LIKE '2024%'"), start="2024-01-01", end="2024-12-31")
    assert not plain._mixed("right") and plain.rows("right").count() == 80


# ---------------------------------------------------------------- nested values


def test_nested_values(spark):
    schema = "a array<int>, m map<string, double>, s struct<b: decimal(9,2), a: array<struct<d: date>>>"
    rows = [([1, None], {"x": 1.0, "a": None}, (Decimal("1.50"), [(dt.date(2024, 1, 2),)])), ([], {}, (None, [])), (None, None, None), ([None], {"": 0.5}, (None, None))]
    df = spark.createDataFrame(rows, schema)
    canonical = [normalize.norm_nested(F.col(c), df.schema[c].dataType).alias(c) for c in df.columns]
    got = [tuple(r) for r in df.select(*canonical).collect()]
    assert got == [("[5:1.000,~]", "{1:A=~,1:X=5:1.000}", "(a=22:[17:(d=10:2024-01-02)],b=5:1.500)"), ("[]", "{}", "(a=2:[],b=~)"),
                   (None, None, None), ("[~]", "{~=5:0.500}", "(a=~,b=~)")]
    assert len({tuple(r) for r in got}) == 4


def test_sequences_of_parts_do_not_read_alike(spark):
    rows = [(["a,1:b"],), (["a", "b"],), (["a", None],), (["a"],), ([None, "a"],), (["~", "a"],)]
    df = spark.createDataFrame(rows, "a array<string>")
    assert df.select(normalize.norm_nested(F.col("a"), df.schema["a"].dataType)).distinct().count() == len(rows)


# ---------------------------------------------------------------- gate


def test_gate_tells_multisets_apart(spark):
    left = local_rows(spark, [(i, i % 3, "x" if i % 2 else None, Decimal(i)) for i in range(100)], "k bigint, g int, t string, d decimal(20,0)")
    right = local_rows(spark, [(99 - i, (99 - i) % 3, "x" if i % 2 else None, str(99 - i)) for i in range(100)], "k bigint, g int, t string, d string")
    columns = pair_columns(left, right, {c: c for c in ("k", "t", "d")})
    answers = lambda r: {(x["g"], x["column"]): x["is_equal"] for x in gate.gate(left, r, columns, ["g"]).collect()}
    same = answers(right)
    assert same[0, "k"] and same[0, "d"] and len(same) == 9
    one_more = answers(right.unionByName(right.where("k = 4")))
    assert {k for k, ok in one_more.items() if not ok} >= {(1, "k"), (1, "d")} and one_more[0, "k"]
    swapped = answers(right.withColumn("d", F.when(F.col("k") == 3, "6").otherwise(F.col("d"))))
    assert not swapped[0, "d"] and swapped[1, "d"] and swapped[0, "k"]
    assert not any(x["is_equal"] for x in gate.gate(left, right.where("false"), columns, ["g"]).collect())


@pytest.mark.parametrize("change", [None, "V"])
def test_gated_check_profiles_what_differs(spark, change):
    mapped = spark.createDataFrame([(c, c.lower(), False) for c in ("K", "V", "W")], "left_col string, right_col string, is_tokenized boolean")
    left = local_rows(spark, [(i, f"v{i % 7}", float(i % 11)) for i in range(300)], "K bigint, V string, W double")
    right = left.toDF("k", "v", "w")
    right = right if change is None else right.withColumn("v", F.when(F.col("k") == 8, "other").otherwise(F.col("v")))
    exact, gated = (ReconPair("t", left, right, mapped, gated=g) for g in (False, True))
    told = lambda pair: {r["column"]: (r["vintages"], r["vintages_mismatched"], r["is_mismatched"]) for r in pair.column_check().collect()}
    assert [p.name for p in gated._profiled] == ([] if change is None else [change])
    assert told(exact) == told(gated)
    assert exact.match_rates().collect() == gated.match_rates().collect()
    assert exact.reconcile().first()["status"] == gated.reconcile().first()["status"] == ("MATCH" if change is None else "COLUMNS_DIFFER")


# ---------------------------------------------------------------- samples, caps, reruns


@pytest.mark.parametrize("k", [1, 40, 5000])
def test_samples_hold_exactly_so_many_keys(spark, k):
    """Also with one key that holds most rows, null keys, and fewer keys than asked for."""
    rows = [(i, "x") for i in range(200)] + [(7, "hot")] * 2000 + [(None, "n")] * 3
    left = local_rows(spark, rows, "k bigint, v string").repartition(4)
    right = local_rows(spark, [r for r in rows if r[0] is None or r[0] % 10], "k bigint, v string").withColumn("k", F.col("k").cast("string"))
    l, r = (df.collect() for df in rowhash.hash_sample(left, right, ["k"], ["k"], k))
    keys = {None if x["k"] is None else int(x["k"]) for x in l}
    assert len(keys) == min(k, 201) and {None if x["k"] is None else int(x["k"]) for x in r} <= keys
    assert Counter(x["k"] for x in l) == Counter(x[0] for x in rows if x[0] in keys)


def test_listed_mismatches_are_capped_and_counted(spark):
    hashes = lambda mark: local_rows(spark, [(i, f"{mark if i % 2 else 0:064d}", "v") for i in range(100)], "k bigint, hash_value string, vintage string")
    compared = rowhash.compare_keys(hashes(1), hashes(2), ["k"], ["vintage"])
    rows = rowhash.capped_mismatches(compared, ["k"], ["vintage"], 7).collect()
    assert [r["k"] for r in rows] == [1, 3, 5, 7, 9, 11, 13] and {r["total"] for r in rows} == {50}
    assert rowhash.MISMATCH_CAP == 10_000 and len(rowhash.capped_mismatches(compared, ["k"], ["vintage"]).collect()) == 50


def test_a_step_written_again_replaces_its_rows(spark, tmp_path):
    base, rows = str(tmp_path / "runs"), lambda n: spark.range(n)
    for run, step, n in (("a", "meta", 5), ("a", "hash", 3), ("b", "meta", 2), ("a", "meta", 5), ("a", "hash", 0)):
        results.write_run(rows(n), base, run, step)
    got = {(r["run_name"], r["step"]): r["count"] for r in results.read_result(spark, base).groupBy("run_name", "step").count().collect()}
    assert got == {("a", "meta"): 5, ("b", "meta"): 2}


def test_scratch_on_a_cluster_needs_a_shared_folder():
    assert results.below_warehouse("file:/a/wh", "local[8]") == "file:/a/wh/scratch"
    assert results.below_warehouse("hdfs://n/wh", "yarn") == "hdfs://n/wh/scratch"
    for warehouse in ("file:/a/wh", "/a/wh"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            results.below_warehouse(warehouse, "yarn")


# ---------------------------------------------------------------- runs that know their inputs


def test_a_stage_is_complete_only_for_what_it_was_made_from(spark, tmp_path):
    from paritas.plans import Run

    data, mapping = str(tmp_path / "left"), [("K", "k", False), ("V", "v", False)]
    spark.range(20).selectExpr("id AS K", "'v' AS V").write.parquet(data)

    def makers(mapping=mapping, **options):
        crosswalk = spark.createDataFrame(mapping, "left_col string, right_col string, is_tokenized boolean")
        left = spark.read.parquet(data)
        return {"t": lambda: ReconPair("t", left, left.toDF("k", "v"), crosswalk, **options), "bad": lambda: ReconPair("bad", left, left, crosswalk, "K", None)}

    run = Run(spark, str(tmp_path / "runs"), "nightly")
    told = lambda makers: {r["table_name"]: r["status"] for r in run.carry_out(makers, ["meta_check"]).collect()}
    assert told(makers()) == {"t": "DONE", "bad": "FAILED"}
    assert told(makers()) == {"t": "RESUMED", "bad": "FAILED"}
    assert told(makers(mapping[:1]))["t"] == "DONE" and told(makers(mapping[:1]))["t"] == "RESUMED"
    assert run.results("meta_check", ["t", "bad"]).first()["comparable_columns"] == 1
    assert told(makers(left_where="K < 5"))["t"] == "DONE"
    assert told(makers())["t"] == "DONE" and told(makers())["t"] == "RESUMED"
    spark.range(5).selectExpr("id AS K", "'w' AS V").write.mode("append").parquet(data)
    assert told(makers())["t"] == "DONE" and run.results("meta_check", ["t"]).first()["day_rows_left"] == 25
