"""LM scoring, mixing, language identification, packing, token counts and near dedup against plain versions."""

import itertools
import math
import random
import re
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from paritas.llm import language_id, lm_scoring, mixing, near_dedup, packing, token_counts
from paritas.llm.common import crc_bucket
from paritas.sources import results
from paritas.llm.tokens import ByteEncoder

WORDS = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lowered(text):
    return WORDS.findall((text or "").translate(LOWER))


# ---------------------------------------------------------------- LM scoring


def test_lm_base_and_held_out_gain(documents):
    df = documents.select("doc_id", "text", (crc_bucket(F.col("doc_id"), 7) != 2).alias("learns"))
    rows = {r["doc_id"]: r for r in lm_scoring.score(df, "learns", hot=50).collect()}
    texts = {r["doc_id"]: (lowered(r["text"]) + ["\n"], r["learns"]) for r in df.collect()}
    seen = Counter(w for words, learns in texts.values() if learns for w in words)
    n, v = sum(seen.values()), len(seen)
    for i, (words, _) in texts.items():
        r = rows[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(words), sum(w in seen for w in words), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in words))
    held = [i for i, (_, learns) in texts.items() if not learns]
    assert sum(rows[i]["score"] for i in held) > sum(rows[i]["base_score"] for i in held)


def test_lm_does_not_depend_on_what_is_hot(documents):
    df = documents.limit(60).select("doc_id", "text", (F.col("doc_id") % 3 > 0).alias("learns"))
    few, many = ({r["doc_id"]: r for r in lm_scoring.score(df, "learns", hot=n).collect()} for n in (1, 100_000))
    assert all(few[i]["score"] == pytest.approx(many[i]["score"]) and few[i]["n_known"] == many[i]["n_known"] for i in few)


def test_lm_odd_rows(odd, nothing):
    rows = lm_scoring.score(odd.withColumn("learns", F.lit(True)), "learns").collect()
    assert len(rows) == odd.count() and all(r["score"] < 0 and math.isfinite(r["score"]) for r in rows)
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (4, 5, 6)} == {1}
    assert len([r for r in rows if r["doc_id"] == 9]) == 2
    none = lm_scoring.score(odd.withColumn("learns", F.lit(False)), "learns").collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and math.isfinite(r["score"]) for r in none)
    assert lm_scoring.score(nothing.withColumn("learns", F.lit(True)), "learns").count() == 0


def test_spelling_is_a_distribution():
    """All continuations of a context together have probability 1: the code is complete and each bit sums to 1."""
    lengths, _ = lm_scoring.byte_code([n % 17 for n in range(256)])
    assert sum(2.0 ** -int(n) for n in lengths) == pytest.approx(1.0)


def test_urn_sums_are_sequential_predictions():
    order, p, b = ["a", "b", "a", "a"], {"a": 0.3, "b": 0.1}, 50.0
    seen, total = Counter(), 0.0
    for t, w in enumerate(order):
        total += math.log((seen[w] + b * p[w]) / (t + b))
        seen[w] += 1
    assert total == pytest.approx(sum(lm_scoring.urn_sum(p[w], k, b) for w, k in seen.items()) - lm_scoring.urn_sum(1.0, len(order), b))


def test_a_text_scores_by_the_order_of_its_words(spark):
    """Words are predicted after the words before them: the same words in another order score otherwise, and lower."""
    rng = random.Random(5)
    follow = {w: rng.sample(range(40), 2) for w in range(40)}
    chain = [rng.randrange(40)]
    for _ in range(60 * 300):
        chain.append(rng.choice(follow[chain[-1]]))
    texts = [" ".join(f"w{x}" for x in chain[i:i + 60]) for i in range(0, len(chain) - 60, 60)]
    mixed = [" ".join(rng.sample(t.split(), 60)) for t in texts[:40]]
    rows = [(i, t, i >= 40) for i, t in enumerate(texts)] + [(1000 + i, t, False) for i, t in enumerate(mixed)]
    df = spark.createDataFrame(rows, "doc_id long, text string, learns boolean")
    got = {r["doc_id"]: r for r in lm_scoring.score(df, "learns").collect()}
    assert all(got[i]["base_score"] == pytest.approx(got[1000 + i]["base_score"]) for i in range(40))
    assert all(got[i]["score"] > got[1000 + i]["score"] + 5 for i in range(40))


def test_word_code_is_complete():
    """All words after a context together have probability 1, whatever the tables hold."""
    counts = [900, 400, 300, 70, 70, 3, 2, 2, 1, 0]
    code = lm_scoring.word_code(counts)
    assert sum(2.0 ** -int(n) for n in code[0]) == pytest.approx(1.0)
    rng = np.random.default_rng(1)
    tables = [rng.integers(0, 1 << 16, 1 << b).astype(np.uint16) for b in (12, 13)]
    p = [math.exp(lm_scoring.ln_p(np.array([1, 3, s]), np.array([0, 3]), code, tables, lm_scoring.first_word_weights())[-1]) for s in range(len(counts))]
    assert sum(p) == pytest.approx(1.0, rel=1e-4)


def test_places_count_earlier_ones():
    assert lm_scoring.earlier(np.array([4, 2, 4, 4, 2, 9])).tolist() == [0, 0, 1, 2, 1, 0]


# ---------------------------------------------------------------- mixing


def water(sizes, weights=(1, 2, 3)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[k % 3] for k, s in enumerate(names)}
    target, open_, rest = {}, set(names), float(sum(sizes.values()))
    while open_:
        level = rest / sum(w[s] for s in open_)
        over = {s for s in open_ if level * w[s] > 3 * sizes[s]}
        for s in over or open_:
            target[s] = 3.0 * sizes[s] if over else level * w[s]
        rest -= sum(target[s] for s in over)
        open_ = open_ - over if over else set()
    return target


def check_mix(df, near):
    docs = [(r["source"], len(WORDS.findall(r["text"] or ""))) for r in df.collect()]
    sizes = defaultdict(int)
    for s, n in docs:
        sizes[s] += n
    want = water(sizes)
    units = mixing.allocate(df).collect()
    taken = defaultdict(int)
    for u in units:
        assert u["target"] == pytest.approx(want[u["unit_source"]]) and u["source_size"] == sizes[u["unit_source"]] and 0 <= u["copies"] <= 3
    joined, (size, copies) = mixing.joined(df, mixing.allocate(df), "size", "copies")
    rows = joined.collect()
    assert len(rows) == len(docs)
    for r in rows:
        taken[r["source"]] += r[size] * r[copies]
    for s, t in want.items():
        assert taken[s] <= t + 1e-6 and (not near or taken[s] >= 0.85 * t)
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns and mixed.count() == sum(r[copies] for r in rows)
    again = {(u["unit_id"], u["unit_fp"]): u["copies"] for u in mixing.allocate(df.repartition(5)).collect()}
    assert again == {(u["unit_id"], u["unit_fp"]): u["copies"] for u in units}


def test_mixing(odd, nothing, documents):
    check_mix(documents, near=True)
    check_mix(odd, near=False)
    assert mixing.allocate(nothing).count() == 0 and mixing.mix(nothing).count() == 0


def test_mixing_targets_with_ceilings(spark):
    docs = [(i, "w " * 10, s) for i, s in enumerate(["a"] * 200 + ["b"] * 3 + ["c"] * 5 + [None] * 7)]
    check_mix(spark.createDataFrame(docs, "doc_id long, text string, source string"), near=True)


def test_unequal_inclusion(spark):
    docs = [(i, f"x{i} " * 10, "a", 4.0 if i % 2 else 1.0) for i in range(400)] + [(1000 + i, f"y{i} " * 10, "b", 1.0) for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, odds double")
    units = mixing.allocate(df, weight="odds").collect()
    by_odds = defaultdict(list)
    for u in units:
        if u["unit_source"] == "a":
            by_odds[u["unit_id"] % 2].append(u["copies"])
    assert np.mean(by_odds[1]) > 2.5 * np.mean(by_odds[0]) and max(by_odds[1]) <= 3
    assert sum(u["copies"] * u["size"] for u in units if u["unit_source"] == "a") == pytest.approx(8000 / 3, abs=10)


def test_rows_that_cannot_be_drawn_are_not_sorted_in_one_task(spark):
    rows = spark.createDataFrame([(i, f"{i}", "a", 5, 5, 0.0, 1, 0, None, None, 10_000.0) for i in range(2000)],
                                 "unit_id long, unit_fp string, unit_source string, size int, words int, odds double, certain long, extra int, place double, bin int, target double")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = Counter(r[0] for r in mixing._take(rows.repartition(4)).select(F.spark_partition_id(), "extra").collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(parts.values()) == 2000 and max(parts.values()) < 1000


# ---------------------------------------------------------------- language identification


def test_language_accuracy_on_held_out_rows(spark, documents):
    df = documents.withColumn("held_out", crc_bucket(F.col("doc_id"), 5) == 0)
    content = language_id.dictionaries(df.where("not held_out"))
    rows = language_id.predict(df.select("doc_id", "lang", "held_out", "text"), content).where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.85
    sure = [r for r in rows if not r["rejected"]]
    assert np.mean([r["lang"] == r["lang_pred"] for r in sure]) >= np.mean([r["lang"] == r["lang_pred"] for r in rows])


def test_language_odd_rows(spark, odd, nothing):
    content = language_id.dictionaries(odd)
    rows = language_id.predict(odd.select("doc_id", "text"), content).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (4, 5, 6)} == {"und"}
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (1, 7, 12)} <= set(content)
    assert language_id.dictionaries(nothing) == {}
    assert {r["lang_pred"] for r in language_id.predict(odd.select("doc_id", "text"), {}).collect()} == {"und"}
    assert language_id.predict(nothing.select("doc_id", "text"), content).count() == 0


def test_language_samples_of_many_copies_and_of_long_texts(spark):
    texts = [f"word{i} and some more text of its own {i * i}" for i in range(40)]
    order = spark.createDataFrame([(t,) for t in texts], "text string").orderBy(F.xxhash64("text")).collect()
    rows = [("copied", order[0]["text"])] * 200 + [("copied", r["text"]) for r in order]
    long = " 12 " * 10 + "donde estaba la casa grande " * 1000
    rows += [("long", long), ("none", None), (None, "unlabelled"), ("digits", "1 2 3")]
    content = language_id.dictionaries(spark.createDataFrame(rows, "lang string, text string").repartition(3))
    assert set(content) == {"copied", "long"}
    assert Counter(content["copied"].decode().split("\n")) == Counter(texts)
    assert content["long"].decode() == long.lstrip(" 12")[:language_id.SAMPLE_CHARS]


# ---------------------------------------------------------------- packing

public_tokenizers = pytest.importorskip("public_tokenizers")


def random_texts(seed, n):
    rng = random.Random(seed)
    letters = [chr(c) for c in (9, 10, 11, 12, 13, 28, 31, 32, 32, 32, 32, 0x85, 0xA0, 0x2003, 0x200B, 0x3000, 0x301, 0x327, 65, 97, 98, 115, 116, 39, 39,
                                0xE9, 0x130, 0x3A3, 0x661, 0xB2, 0xBD, 0x1F600, 0x4E2D, 0x1100, 0x1161, 33, 60, 124, 62, 0)]
    letters += ["<|endoftext|>", "<|startoftext|>", "'ll", " the"]
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 50))) for _ in range(n)]


def tokenizer(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name))


def test_byte_encoder_equals_the_library(documents):
    encoder, library = ByteEncoder(public_tokenizers.path("byte_bpe_50k.json")), tokenizer("byte_bpe_50k.json")
    texts = random_texts(1, 4000) + [r["text"] for r in documents.limit(60).collect()]
    for text, e in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert encoder.encode(text) == np.array(e.ids, "<u4").tobytes(), ascii(text)


def test_pattern_plan_uses_each_piece_once():
    rng = random.Random(3)
    histogram = dict(Counter(min(2048, int(rng.lognormvariate(6.4, 1.1)) + 1) for _ in range(5000)))
    made = packing.plan(histogram)
    used = Counter()
    for sizes, repeats in made:
        assert sum(sizes) <= 2048
        for s in sizes:
            used[s] += repeats
    bound = math.ceil(sum(k * n for k, n in histogram.items()) / 2048)
    assert used == histogram and sum(r for _, r in made) <= 1.02 * bound + 2
    assert packing.plan({}) == [] and packing.plan({5: 1000}) != []


def test_least_squares_finds_an_exact_cover():
    columns = packing.patterns(8, 1)
    counts = np.zeros(9)
    counts[[5, 3, 4, 2]] = [10, 10, 8, 8]
    counts[4] += 0
    x = packing.fit(columns, counts)
    fitted = np.zeros(9)
    for j, pattern in enumerate(columns):
        for u in pattern:
            fitted[u] += x[j]
    assert x.min() >= 0 and np.abs(fitted[1:] - counts[1:]).max() < 0.6


def check_pack(df):
    library = tokenizer("byte_bpe_50k.json")
    rows = packing.pack(df).collect()
    texts = [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]
    ids = defaultdict(list)
    for (i, t), e in zip(texts, library.encode_batch([t for _, t in texts], add_special_tokens=False), strict=True):
        ids[i].append(np.array([*e.ids, 0], "<u4"))
    want = Counter((i, k, s, n, zlib.crc32(x[s:s + n].tobytes())) for i, xs in ids.items() for x in xs for k, (s, n) in enumerate(packing.cut_points(len(x), 2048)))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in held.values():
        end = 0
        for offset, n in sorted(parts):
            assert offset == end
            end += n
        assert end <= 2048
    return rows


def test_packing(odd, nothing, documents):
    check_pack(documents)
    check_pack(odd)
    assert packing.pack(nothing).count() == 0


def test_sequences_hold_the_tokens(odd):
    placed, made = packing.pack(odd).collect(), {r["sequence_id"]: r for r in packing.sequences(odd).collect()}
    for r in placed:
        ids = np.array(made[r["sequence_id"]]["ids"][r["offset"]:r["offset"] + r["length"]], "<u4")
        assert zlib.crc32(ids.tobytes()) == r["ids_crc32"]


# ---------------------------------------------------------------- token counts


def test_word_counts_and_splices_equal_the_library():
    counter = token_counts.WordCounter(public_tokenizers.path("word_bpe_49k.json"))
    for text in random_texts(2, 1500):
        true = len(counter.tokenizer.encode(text, add_special_tokens=False).ids)
        assert counter.count(text) == true, ascii(text)
        assert token_counts.spliced_count(text, counter.encode, chunk=8, overlap=2) == true, ascii(text)


def test_huge_texts_with_and_without_blanks():
    counter = token_counts.WordCounter(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(4)
    for text in (" ".join("".join(rng.choices("abcde", k=rng.randint(1, 9))) for _ in range(12_000)), "ab,c" * 15_000, " " * 40_000, "x " + "é" * 30_000 + " y" * 9000):
        assert len(text) > token_counts.HUGE
        assert token_counts.spliced_count(text, counter.encode) == len(counter.tokenizer.encode(text, add_special_tokens=False).ids)


def test_token_counts_of_odd_rows(odd, nothing):
    library = tokenizer("word_bpe_49k.json")
    rows = token_counts.counts(odd.select("doc_id", "text")).collect()
    want = Counter((r["doc_id"], len((r["text"] or "").encode()), len(library.encode(r["text"] or "", add_special_tokens=False).ids)) for r in odd.collect())
    assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in rows) == want
    assert token_counts.counts(nothing.select("doc_id", "text")).count() == 0
    assert unicodedata.normalize("NFC", "é") == "é"


# ---------------------------------------------------------------- near dedup


def plain_groups(docs, width, percent):
    sets = defaultdict(set)
    for i, t in docs:
        w = lowered(t)
        grams = [tuple(w)] if 0 < len(w) < width else [tuple(w[k:k + width]) for k in range(len(w) - width + 1)]
        sets[i].add(frozenset(grams))
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    flat = [(i, s) for i, all_ in sets.items() for s in all_ if s]
    for (a, x), (b, y) in itertools.combinations(flat, 2):
        if 100 * len(x & y) >= percent * len(x | y):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in sets}


@pytest.mark.parametrize("width", [4, 5])
def test_near_groups_equal_all_pairs(documents, width):
    docs = [(r["doc_id"], r["text"]) for r in documents.collect()]
    want = plain_groups(docs, width, 80)
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_groups(documents, width=width).collect()}
    assert got == want


def test_near_groups_of_planted_copies(spark):
    rng = random.Random(5)
    docs = []
    for g in range(12):
        base = [f"g{g}w{rng.randint(0, 10_000)}" for _ in range(rng.randint(30, 120))]
        for c in range(rng.choice([1, 2, 3, 25])):
            text = list(base)
            for _ in range(rng.choice([0, 1, 2])):
                text[rng.randrange(len(text))] = f"changed{rng.randint(0, 10 ** 9)}"
            docs.append((len(docs), " ".join(text)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_groups(df, width=4).collect()}
    assert got == plain_groups(docs, 4, 80)


def test_near_groups_of_a_large_family(spark, monkeypatch):
    """Most pairs of the family are just not similar enough, so the few links meet in buckets with hundreds of others."""
    monkeypatch.setattr(near_dedup, "CELL", 20_000, raising=False)
    rng = random.Random(7)
    base, docs = [f"w{i}" for i in range(300)], []
    for i in range(400):
        text = list(base)
        for _ in range(rng.randint(5, 8)):
            text[rng.randrange(len(text))] = f"changed{rng.randint(0, 10 ** 9)}"
        docs.append((i, " ".join(text)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    want = plain_groups(docs, 4, 80)
    assert 5 < sum(i != c for i, c in want.items()) < 390
    assert {r["doc_id"]: r["component_id"] for r in near_dedup.near_groups(df, width=4).collect()} == want


def test_near_groups_leave_little_behind(odd, monkeypatch, tmp_path):
    """Full sets, buckets and bands go when they are used up."""
    monkeypatch.setattr(results, "shared_dir", lambda spark: str(tmp_path))
    near_dedup.near_groups(odd)
    left = [x.name for x in tmp_path.iterdir()]
    assert any(x.startswith("members-") for x in left) and not [x for x in left if x.startswith(("bands-", "nodes-", "buckets-", "sets-", "open-", "may-link-"))]


def test_near_odd_rows(odd, nothing):
    rows = near_dedup.near_groups(odd).collect()
    by_id = defaultdict(set)
    for r in rows:
        by_id[r["doc_id"]].add((r["component_id"], r["n_shingles"]))
    assert len(rows) == odd.count()
    assert by_id[2] == {(1, 56)} and by_id[3] == {(1, 57)} and by_id[8] == {(7, near_dedup_size(7, odd))} and by_id[14] == {(9, 1)}
    assert by_id[4] == {(4, 0)} and by_id[5] == {(5, 0)} and by_id[6] == {(6, 0)}
    kept = near_dedup.keep_one(odd)
    assert kept.columns == odd.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids[9] == 1 and not {2, 3, 8, 14} & set(ids) and {1, 4, 5, 6, 7} <= set(ids)
    assert near_dedup.near_groups(nothing).count() == 0 and near_dedup.keep_one(nothing).count() == 0


def near_dedup_size(doc_id, df):
    words = lowered(df.where(F.col("doc_id") == doc_id).first()["text"])
    return len({tuple(words[k:k + near_dedup.WIDTH]) for k in range(len(words) - near_dedup.WIDTH + 1)})


def test_densified_sketches_estimate_similarity():
    rng = np.random.default_rng(6)
    estimates = []
    for _ in range(200):
        both = rng.integers(0, 2 ** 63, 9).astype(np.uint64)
        sets = [np.sort(both[:8]), np.sort(both[1:])]
        sketch = near_dedup.sketches(np.concatenate(sets), np.array([0, 8, 16]))
        estimates.append((sketch[0] == sketch[1]).mean())
    assert np.mean(estimates) == pytest.approx(7 / 9, abs=0.05)
