"""Exact top values against a plain count, and what they exchange."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from paritas.operators import profile, top_values

SCHEMA = "vintage string, column string, v_text string"


def brute(rows, top):
    groups = defaultdict(Counter)
    for vintage, column, value in rows:
        groups[vintage, column][value] += 1
    out = set()
    for (vintage, column), counts in groups.items():
        ranked = sorted(counts.items(), key=lambda x: (-x[1], x[0] is None, (x[0] or "").encode()))
        out |= {(vintage, column, value, n, place) for place, (value, n) in enumerate(ranked[:top], 1)}
    return out


def found(df, by, top):
    return {(r["vintage"], r["column"], r["v_text"], r["n"], r["rn"]) for r in top_values.top_values(df, by, top).collect()}


def many_shapes():
    random.seed(11)
    rows = []
    for i in range(6000):
        rows.append(("x", "unique", f"a rather long common beginning {i:09d}"))
        rows.append((random.choice(["x", None]), "skewed", f"v{int(random.paretovariate(0.6)) % 3000}"))
        rows.append(("y", "twice", f"{i // 2:07d}é"))
        rows.append(("y", "few", random.choice(["", "a", "b", None])))
        rows.append(("z", "hot", "same" if i % 3 else f"{i}"))
    return rows + [("z", "nothing", None)] * 5


@pytest.mark.parametrize("top", [1, 10])
def test_top_values_are_those_of_a_plain_count(spark, top):
    rows = many_shapes()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(df, ["vintage"], top) == brute(rows, top)
    assert found(df.where("false"), ["vintage"], top) == set()


def test_clashing_hashes_are_widened(spark, monkeypatch):
    rows = many_shapes()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    monkeypatch.setattr(top_values, "DIGESTS", (lambda v: F.length(v).cast("bigint"), *top_values.DIGESTS[1:]))
    monkeypatch.setattr(top_values, "PREFIX", 2)
    assert found(df, ["vintage"], 10) == brute(rows, 10)


def test_frequent_values_close_every_bucket(spark):
    rows = [("x", "c", f"frequent {i % 10}") for i in range(50_000)] + [("x", "c", f"rare {i}") for i in range(9000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    counted = top_values.candidates(df, ["vintage"])
    assert top_values.open_buckets(df, counted, ["vintage"]).count() == 0
    assert found(df, ["vintage"], 10) == brute(rows, 10)


def written(spark):
    return spark.sparkContext._jsc.sc().statusStore().executorList(True).apply(0).totalShuffleWrite()


def test_less_is_exchanged_on_a_unique_column(spark):
    texts = F.concat(F.sha2(F.col("id").cast("string"), 512), F.sha2((-F.col("id")).cast("string"), 512))
    df = spark.range(60_000).select(F.lit("x").alias("vintage"), F.lit("c").alias("column"), texts.alias("v_text"))

    def shuffled(make):
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        before = written(spark)
        rows = make().collect()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        return rows, written(spark) - before

    plain, all_moved = shuffled(lambda: profile.rank_frequencies(profile.value_frequencies(df, ["vintage"]), ["vintage"], 10))
    mine, moved = shuffled(lambda: top_values.top_values(df, ["vintage"], 10))
    assert {tuple(r) for r in mine} == {tuple(r) for r in plain}
    assert 0 < moved < all_moved / 3
