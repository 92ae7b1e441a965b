"""Vector groups, spelling variants and hard negatives against brute force, with awkward rows and forced small blocks."""

import itertools
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from paritas.llm import hard_negatives, spelling, vector_groups

NAN, INF = float("nan"), float("inf")
VECTORS = "vec_id long, embedding array<float>, label int, id string, dim string, n_links int, score string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], label, "x", "y", 3, "z") for i, v, label in rows], VECTORS).repartition(3)


# ---------------------------------------------------------------- near vectors


def linked_by_force(rows, cosine):
    """n_links and component per row, rows under one id being one node."""
    good = [k for k, (_, v, _) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links, near = Counter(), defaultdict(set)
    for a, b in itertools.combinations(good, 2):
        x, y = (np.array(rows[k][1], np.float32).astype(float) for k in (a, b))
        if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= cosine:
            links.update([a, b])
            near[a].add(b)
            near[b].add(a)
    out = Counter()
    for k, (i, _, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for other in near[todo.pop()] - seen:
                seen.add(other)
                todo.append(other)
        out[i, links[k], min((rows[x][0] for x in seen if rows[x][0] is not None), default=None)] += 1
    return out


def balls(n, dim=16, seed=1):
    """Groups of two to many near vectors, tight and loose, and single ones."""
    rng = np.random.default_rng(seed)
    rows, sizes = [], [1] * (n // 3)
    while sum(sizes) < n:
        sizes.append(int(rng.integers(2, n // 8)))
    for size in sizes:
        centre = rng.standard_normal(dim)
        rows += [tuple(centre + rng.uniform(0.02, 0.3) * rng.standard_normal(dim)) for _ in range(size)]
    rng.shuffle(rows)
    return [(int(i), [float(np.float32(x)) for x in v], 0) for i, v in enumerate(rows)]


def got(df, **options):
    return Counter(tuple(r) for r in vector_groups.near_vectors(df, **options).select("vec_id", "n_links", "component_id").collect())


def test_awkward_vectors(spark):
    rows = [(1, [1, 0, 0], 0), (2, [1, 0.01, 0], 1), (2, [1, 0.01, 0], 1), (3, [2, 0, 0], None), (4, None, 1), (5, [0, 0, 0], 1), (6, [1, None, 0], 1),
            (7, [1, NAN, 0], 1), (8, [INF, 0, 0], 1), (9, [1, 0], 0), (None, [0, 1, 0], 0), (None, [0, 1, 0.01], 0), (10, [], 0), (11, [-0.0, 0, 1], 0),
            (12, [0.0, 0, 1], 0), (13, [1e30, 0, 0], 0), (14, [1e-40, 0, 0], 0)]
    assert got(frame(spark, rows)) == linked_by_force(rows, 0.95)
    assert vector_groups.near_vectors(frame(spark, [])).count() == 0


@pytest.mark.parametrize("leaf,levels", [(4096, 7), (40, 7), (24, 2)])
def test_forest_finds_the_links(spark, leaf, levels):
    """One leaf, one round of splits, and many rounds with dense nodes compared in blocks; far pairs never link."""
    rows = balls(900)
    want, found = linked_by_force(rows, 0.95), got(frame(spark, rows), leaf=leaf, levels=levels)
    total = lambda c: sum(k[1] * n for k, n in c.items())
    assert total(found) <= total(want) and total(found) >= 0.99 * total(want)
    if leaf > 900:
        assert found == want


def test_dense_ball_is_compared_in_blocks(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(np.float32(x)) for x in 1 + 0.001 * rng.standard_normal(16)], 0) for i in range(300)]
    assert got(frame(spark, rows), leaf=32) == Counter({(i, 299, 0): 1 for i in range(300)})


# ---------------------------------------------------------------- spelling


def near(a, b):
    a, b = sorted((a, b), key=len, reverse=True)
    if a == b or len(a) - len(b) > 1:
        return False
    at = next((k for k in range(len(b)) if a[k] != b[k]), len(b))
    return a[at + 1:] == (b[at + 1:] if len(a) == len(b) else b[at:])


def spelt_by_force(counts, least=6):
    n = {w: c for w, c in counts.items() if w is not None and len(w) >= least}
    near_of = {w: [v for v in n if near(w, v)] for w in n}
    best = {w: min(near_of[w], key=lambda v: (-n[v], v), default=None) for w in n}
    form = {w: v if v is not None and n[v] >= 5 * n[w] else None for w, v in best.items()}
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, n[w], len(near_of[w]), form[w], form[w] and n[form[w]], root))
    return out


def test_composition_accepts_exactly_the_near_pairs():
    random.seed(3)
    for letters in ("ab", "abc", "aéz"):
        for _ in range(60):
            words = list({"".join(random.choices(letters, k=random.randint(0, 6))) for _ in range(50)})
            pairs = [frozenset(p) for p in spelling.near_pairs(words)]
            assert len(pairs) == len(set(pairs))
            assert set(pairs) == {frozenset(p) for p in itertools.combinations(words, 2) if near(*p)}


def test_acceptor_is_minimal():
    acceptor = spelling.Acceptor(["tap", "taps", "top", "tops", "tap"])
    assert len(acceptor.arcs) == 5 and sum(acceptor.final) == 2
    assert spelling.Acceptor([]).arcs == [{}]


def some_words():
    random.seed(7)
    counts = Counter({"receive": 4000, "recieve": 30, "receve": 700, "recieves": 2, "hundré": 9, "hundrés": 45, "straße": 10, "strasse": 60, "short": 99, None: 8,
                      "a" * 40: 3, "a" * 41: 15, "a" * 42: 75, "a" * 43: 375})
    for _ in range(400):
        counts["ab" + "".join(random.choices("abc", k=random.randint(3, 6)))] += random.choice((1, 5, 30, 200))
    return counts


@pytest.mark.parametrize("block", [20_000, 30])
def test_variants(spark, monkeypatch, block):
    """Also with the hot head ``ab`` cut into blocks; repeated words count together."""
    monkeypatch.setattr(spelling, "BLOCK", block)
    counts = some_words()
    rows = [(w, n - 1, "x") for w, n in counts.items() if n > 1] + [(w, 1, "y") for w in counts]
    df = spark.createDataFrame(rows, "word string, n long, root string").repartition(3)
    assert {tuple(r) for r in spelling.variants(df).collect()} == spelt_by_force(counts)
    assert spelling.variants(df.where("n < 0")).count() == 0


def test_very_long_words(spark):
    long = "xy" * 4000
    df = spark.createDataFrame([(long, 100), (long + "z", 5)], "word string, n long")
    assert {(r["n"], r["n_near"], r["form"] == long, r["root"] == long) for r in spelling.variants(df).collect()} == {(100, 1, False, True), (5, 1, True, True)}


def test_runs_of_awkward_texts(spark, odd):
    found = Counter(tuple(r) for r in spelling.runs(odd.where("doc_id IN (4, 5, 6, 12, 14)")).collect())
    assert found == Counter([(12, "été"), (12, "là"), (12, "bas"), (12, "où"), (12, "ça"), (14, "one")])
    assert [r["run"] for r in spelling.runs(spark.createDataFrame([(1, "ÀBC x×y")], "doc_id long, text string")).collect()] == ["Àbc", "x×y"]


# ---------------------------------------------------------------- hard negatives


def test_strassen_is_exact():
    rng = np.random.default_rng(2)
    for m, k, n in ((1, 1, 1), (0, 3, 2), (5, 64, 9), (33, 47, 129), (100, 17, 64)):
        a, b = rng.integers(-2**62, 2**62, (m, k)), rng.integers(-2**62, 2**62, (k, n))
        with np.errstate(over="ignore"):
            for leaf in (1, 4, 16):
                assert (hard_negatives.strassen(a, b, leaf) == a @ b).all()


def mined_by_force(rows, every):
    good = {(i, label, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, v, label in rows
            if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    order = lambda pair: (-pair[0], pair[1][0] is None, pair[1][0] or 0)
    out = Counter()
    for a in good:
        if a[0] is None or a[0] % every:
            continue
        scored = sorted(((sum(x * y for x, y in zip(a[2], b[2])), b) for b in good if b != a), key=order)
        for top, b in [s for s in scored if s[1][1] == a[1]][:5]:
            window = [s for s in scored if s[1][1] != a[1] and 80 * top <= 100 * s[0] <= 100 * top][:5]
            out.update((a[0], b[0], rank, c[0], top, score) for rank, (score, c) in enumerate(window, 1))
    return out


@pytest.mark.parametrize("sizes", [(8192, 2048, 512), (3, 17, 2)])
def test_mining(spark, monkeypatch, sizes):
    for name, size in zip(("ANCHORS", "CANDIDATES", "TILE"), sizes):
        monkeypatch.setattr(hard_negatives, name, size)
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(np.float32(x)) for x in rng.uniform(-1, 2, 9)], int(rng.integers(3))) for i in range(150)]
    rows += [(200 + k, [1.0] * 9, k % 2) for k in range(12)]  # ties
    rows += [rows[0], rows[0], (4, None, 1), (8, [1.0], None), (12, [1.0, NAN], 1), (16, [1.0, None], 1), (20, [INF], 1), (24, [], 1),
             (28, [3.0, 1.0], 1), (None, [1.0] * 9, 0), (300, rows[0][1], 2)]
    df = frame(spark, rows)
    mined = hard_negatives.mine(df, F.col("vec_id") % 4 == 0)
    assert Counter(tuple(r) for r in mined.collect()) == mined_by_force(rows, 4)
    assert hard_negatives.mine(df, F.lit(False)).count() == hard_negatives.mine(df.where("false"), F.lit(True)).count() == 0


def test_vectors_too_long_for_exact_scores_end_the_job(spark):
    with pytest.raises(Exception, match="too long"):
        hard_negatives.mine(frame(spark, [(4, [1e10], 1)]), F.lit(True)).collect()
