"""Digest tree, changed columns and given windows against brute force."""

import datetime
import itertools
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from paritas.operators import digest_tree, intervals
from paritas.operators.columns import pair_columns, same_columns
from paritas.plans import ReconPair

SCHEMA = "vintage string, k long, a string, b long"


def two_sides(spark, n=400):
    """Duplicated keys, null keys and cells, lost, added and changed rows; equal rows in any order."""
    random.seed(4)
    left = [(random.choice("xy"), random.choice([i, i % 7, None]), random.choice(["u", "v", None, " u "]), random.choice([0, 1, None])) for i in range(n)]
    right = [r if random.random() > 0.1 else (r[0], r[1], random.choice("uvw"), random.choice([0, 5])) for r in left if random.random() > 0.03] + left[:3]
    random.shuffle(right)
    return left, right


def plain(row):
    """A row as the hash sees it: trimmed upper-case text, zero for a missing number."""
    return row[0], row[1], (row[2] or "").strip().upper(), row[3] or 0


def differing(left, right):
    l, r = Counter(map(plain, left)), Counter(map(plain, right))
    out = defaultdict(lambda: ([], []))
    for side, more in ((0, l - r), (1, r - l)):
        for row, times in more.items():
            out[row[:2]][side].extend([row] * times)
    return dict(out)


def changed_of(lost, added):
    return None if not lost or not added else [c for i, c in ((2, "a"), (3, "b")) if Counter(x[i] for x in lost) != Counter(x[i] for x in added)]


def sides_of(spark, left, right):
    frames = [spark.createDataFrame(rows, SCHEMA).repartition(3) for rows in (left, right)]
    columns = pair_columns(*frames, {c: c for c in ("a", "b")})
    return digest_tree.Sides(*frames, columns, same_columns(frames[0], ["k"]), ["vintage"])


@pytest.mark.parametrize("options", [{}, {"step": 4, "few": 0, "worth": 1.0}, {"step": 8, "few": 50}])
def test_differing_keys_are_those_of_the_full_comparison(spark, options):
    left, right = two_sides(spark)
    found = digest_tree.differences(sides_of(spark, left, right), **options).collect()
    want = differing(left, right)
    assert {(r["vintage"], r["k"]): (r["n_left"], r["n_right"], r["changed"] and sorted(r["changed"])) for r in found} == {
        key: (len(l), len(r), changed_of(l, r)) for key, (l, r) in want.items()}
    assert len(found) == len(want) and all((r["left_hash"] is None) == (r["n_left"] == 0) for r in found)


def test_equal_tables_have_no_differing_range_whatever_their_order(spark):
    left, _ = two_sides(spark)
    sides = sides_of(spark, left, left[::-1])
    ranges, _ = digest_tree.descend(sides)
    assert ranges.count() == 0 and digest_tree.differences(sides).count() == 0
    nothing = sides_of(spark, left[:0], left[:0])
    assert digest_tree.differences(nothing).count() == 0


def test_row_hashes_are_made_for_differing_ranges_only(spark):
    rows = [("x", i, "u", i) for i in range(5000)]
    sides = sides_of(spark, rows, [r if r[1] != 77 else ("x", 77, "u", -1) for r in rows])
    ranges, bits = digest_tree.descend(sides)
    assert ranges.count() == 1 and bits == 12
    left = sides.within("left", ranges, bits)
    assert left.count() < 50
    plan = digest_tree.differing_keys(sides, ranges, bits)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = lambda line: len(re.match(r"[ :+-]*", line)[0])
    joins = [i for i, line in enumerate(plan) if "LeftSemi" in line]
    assert len(joins) == 2 and any("sha2" in line for line in plan)
    for i in joins:  # below the semi-join there is the place of a row, but no row hash
        below = list(itertools.takewhile(lambda line: depth(line) > depth(plan[i]), plan[i + 1:]))
        assert below and not any("sha2" in line for line in below)
    assert [r["changed"] for r in digest_tree.differing_keys(sides, ranges, bits).collect()] == [["b"]]


def test_coarse_digests_are_sums_of_fine_ones(spark):
    left, right = two_sides(spark)
    sides = sides_of(spark, left, right)
    fine = [sides.digests(s, 12) for s in ("left", "right")]
    for bits in (2, 6):
        direct = [sides.digests(s, bits) for s in ("left", "right")]
        rolled = [digest_tree.rolled_up(d, 12, bits) for d in fine]
        rows = lambda df: {tuple(r) for r in df.collect()}
        assert rows(direct[0]) == rows(rolled[0])
        assert rows(digest_tree.differing_ranges(*direct)) == rows(digest_tree.differing_ranges(*rolled))


def test_rows_without_a_key_have_no_place(spark):
    left, right = two_sides(spark, 5)
    with pytest.raises(ValueError, match="no key"):
        s = sides_of(spark, left, right)
        digest_tree.Sides(s.left, s.right, s.pairs, [], s.by)


# ---------------------------------------------------------------- windows


def day(n):
    return datetime.date(2024, 1, 1) + datetime.timedelta(days=n)


WINDOWS = [("a", day(-400), day(3)), ("b", day(2), day(2)), ("c", day(0), day(90)), ("c", day(80), day(120)), ("d", None, day(10)), ("e", day(50), None),
           ("f", day(9), day(8)), ("g", day(900), day(901)), ("h", None, None), ("far", day(0), datetime.date(9999, 12, 31))]


@pytest.mark.parametrize("width", [1, 7, 32, 1000])
def test_days_meet_every_window_that_holds_them(spark, width):
    days = [day(n) for n in range(-40, 130, 3)] + [day(2), None, None]
    df = spark.createDataFrame([(d, i) for i, d in enumerate(days)], "day date, n int")
    windows = spark.createDataFrame(WINDOWS, "vintage string, start_date date, end_date date")
    found = intervals.in_intervals(df, windows, width=width)
    want = Counter((d, i, *w) for i, d in enumerate(days) for w in WINDOWS
                   if d is not None and (w[1] is None or w[1] <= d) and (w[2] is None or d <= w[2]))
    assert Counter((r["day"], r["n"], r["vintage"], r["start_date"], r["end_date"]) for r in found.collect()) == want
    assert intervals.in_intervals(df.where("false"), windows).count() == intervals.in_intervals(df, windows.where("false")).count() == 0


def test_no_nested_loop(spark):
    df = spark.range(1000).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("day"))
    windows = spark.createDataFrame(WINDOWS, "vintage string, start_date date, end_date date")
    plan = intervals.labels_of_days(df, windows)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_reconcile_over_given_windows(spark):
    rows = [(i, day(i % 40), "v") for i in range(200)]
    left = spark.createDataFrame([*rows, (900, None, "v")], "ID long, DT date, V string")
    right = spark.createDataFrame([(i, d, "w" if i == 5 else v) for i, d, v in rows if i != 130], "id long, dt date, v string")
    crosswalk = spark.createDataFrame([("ID", "id", False), ("DT", "dt", False), ("V", "v", False)], "left_col string, right_col string, is_tokenized boolean")
    windows = spark.createDataFrame([("early", day(0), day(9)), ("wide", day(5), day(30)), ("late", day(31), None), ("none", day(70), day(80))],
                                    "vintage string, start_date date, end_date date")
    pair = ReconPair("t", left, right, crosswalk, "DT", "dt", keys=["ID"], hash_all=True, vintage_windows=windows)
    found = {r["vintage"]: r for r in pair.reconcile().collect()}
    assert {v: (r["day_rows_left"], r["day_rows_right"], r["excluded_days"], r["hash_mismatch"], r["status"]) for v, r in found.items()} == {
        "early": (50, 50, 0, 1, "ROWS_DIFFER"), "wide": (130, 129, 1, 1, "ROWS_DIFFER"), "late": (45, 45, 0, 0, "MATCH"), "null_date": (1, 0, 0, 0, "NULL_DATES")}
    by_vintage = Counter((r["vintage"], r["ID"], tuple(r["changed"] or ())) for r in pair.differences(scoped=False).collect())
    assert by_vintage == Counter([("early", 5, ("V",)), ("wide", 5, ("V",)), ("wide", 130, ()), ("null_date", 900, ())])
    assert {(r["vintage"], r["column"], r["n"]) for r in pair.changed_columns().collect()} == {("early", "V", 1), ("wide", "V", 1)}
    with pytest.raises(ValueError, match="windows"):
        ReconPair("t", left, right, crosswalk, vintage_windows=windows)
