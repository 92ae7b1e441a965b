"""Quality rules, line dedup, exact dedup and chat formatting against plain versions in Python."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from paritas.llm import chat_format, exact_dedup, line_dedup, near_dedup, quality_rules
from paritas.llm.common import text_of
from paritas.llm.twins import OP2

WORDS = re.compile("[^\x20\x09-\x0d]+")


def own_counts(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in twice for k in range(5)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def check_facts(df):
    rows = quality_rules.text_facts(df.withColumn("host", F.lit(1))).select("doc_id", "fp", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    texts = df.select("doc_id", F.xxhash64(text_of(F.col("text"))).alias("fp"), "text").collect()
    want = Counter((r[0], r[1], *own_counts(r[2])) for r in texts)
    assert Counter(tuple(r)[:7] for r in rows) == want
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])


def test_own_text_counts(odd, documents):
    check_facts(odd.drop("fp"))
    check_facts(documents)


def test_verdicts_on_odd_rows(odd, nothing):
    rows = quality_rules.verdicts(odd).collect()
    assert len(rows) == odd.count() and not any(r["kept"] for r in rows if r["doc_id"] in (4, 5, 6, 9))
    assert quality_rules.verdicts(nothing).count() == 0 and quality_rules.clean(nothing).count() == 0
    assert quality_rules.clean(odd).columns == odd.columns


def test_frequent_lines_go_and_depleted_documents_fail(spark):
    body = lambda i: "\n".join(" ".join(f"d{i}l{j}w{k}" for k in range(8)) for j in range(4))
    docs = [(i, f"The common FOOTER  line\n{body(i)}", "h") for i in range(40)]
    docs += [(100, "the common footer line\n" * 3 + "only seven words are left over here", "h"), (101, f"the common footer line\n{body(101)}", "other")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = {r["doc_id"]: r for r in quality_rules.verdicts(df, max_docs=20).collect()}
    assert all(rows[i]["n_removed_lines"] == 1 and rows[i]["n_removed_words"] == 4 and rows[i]["kept"] for i in range(40))
    assert rows[100]["n_removed_words"] == 12 and not rows[100]["kept"] and rows[101]["n_removed_lines"] == 0
    kept = {r["doc_id"]: r["text"] for r in quality_rules.clean(df, max_docs=20).collect()}
    assert kept[3] == body(3) and 100 not in kept and kept[101].startswith("the common footer")


def test_exact_copies_do_not_make_a_line_frequent(spark):
    text = "\n".join(" ".join(f"l{j}w{k}" for k in range(8)) for j in range(4))
    df = spark.createDataFrame([(i, text, "h") for i in range(60)], "doc_id long, text string, source string")
    assert quality_rules.clean(df, max_docs=20).count() == 60


def worded(tag, i, j):
    return " ".join(f"{tag}{i}l{j}w{k}" for k in range(8))


def test_a_line_goes_whatever_the_size_of_its_host(spark):
    docs = [(i, ("All rights reserved by nobody\n" if i < 290 else "") + "\n".join(worded("d", i, j) for j in range(2)), "h") for i in range(10_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(4)
    rows = quality_rules.verdicts(df).collect()
    assert sum(r["n_removed_lines"] for r in rows) == 290 and all(r["kept"] for r in rows)


def family(changed, members=40, others=960):
    """Near copies of one base text with a few changed lines each, among other texts; a third of the others share a footer with them."""
    lines = lambda m: [worded("own", m, j) if j in drawn[m] else worded("base", 0, j) for j in range(30)]
    drawn = [random.Random(m).sample(range(30), changed) for m in range(members)]
    docs = [(m, "\n".join(lines(m) + ["the footer of the host"]), "h") for m in range(members)]
    footer = lambda i: ["the footer of the host"] if i % 3 == 0 else []
    return docs + [(i, "\n".join([*(worded("d", i, j) for j in range(4)), *footer(i)]), "h") for i in range(1000, 1000 + others)]


@pytest.mark.parametrize("changed", [1, 3, 6])
def test_near_copies_do_not_make_their_lines_frequent(spark, changed):
    docs = family(changed, members=300)
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(4)
    kept = {r["doc_id"]: r["text"] for r in quality_rules.clean(df).collect()}
    assert kept.keys() == {i for i, *_ in docs}
    assert all(kept[i] == t.removesuffix("\nthe footer of the host") for i, t, _ in docs)


def test_one_near_copy_survives_the_stages(spark):
    df = spark.createDataFrame(family(1), "doc_id long, text string, source string").repartition(4)
    left = near_dedup.keep_one(line_dedup.dedup_lines(quality_rules.clean(df)))
    ids = [r["doc_id"] for r in left.select("doc_id").collect()]
    assert sum(i < 1000 for i in ids) >= 1 and sum(i >= 1000 for i in ids) == 960


def test_line_limits_against_sql(spark):
    docs = family(6, members=60) + [(2000 + i, "the footer of the host\n" * 3 + f"{worded('x', i % 25, 0)}", None if i % 2 else "h") for i in range(80)]
    docs += [(3000 + m, "\n".join(worded("page", 0, j) for j in range(10) if j != m % 10), None) for m in range(70)] + [(4000, None, "h")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    want = con.sql(OP2).df().set_index("doc_id")[["n_removed_lines", "n_removed_words", "kept"]].sort_index()
    found = quality_rules.verdicts(df).toPandas().set_index("doc_id")[["n_removed_lines", "n_removed_words", "kept"]].sort_index()
    assert want.values.tolist() == found.values.tolist() and 0 < want["n_removed_lines"].gt(0).sum() < len(docs)


def plain_line_dedup(rows):
    docs = sorted({(i is not None, i if i is not None else 0, f, t or "") for i, f, t in rows})
    first, covered = {}, defaultdict(set)
    for known, i, f, t in docs:
        lines = [(k, re.sub("[\x20\x09-\x0d]+", " ", x.strip("\x20\x09\x0a\x0b\x0c\x0d"))) for k, x in enumerate(t.split("\n"))]
        lines = [x for x in lines if x[1]]
        for a in range(len(lines) - 2):
            window = lines[a:a + 3]
            key, place = tuple(x[1] for x in window), (known, i, f, window[0][0])
            if first.setdefault(key, place) != place:
                covered[known, i, f] |= {x[0] for x in window}
    return {(i if known else None, f): "\n".join(x for k, x in enumerate(t.split("\n")) if k not in covered[known, i, f]) for known, i, f, t in docs}


def check_lines(df):
    key = F.xxhash64(text_of(F.col("text"))).alias("key")
    want = plain_line_dedup([tuple(r) for r in df.select("doc_id", key, "text").collect()])
    tagged = df.withColumn("key", F.xxhash64(text_of(F.col("text"))))
    got = line_dedup.dedup_lines(tagged, report=("gone",)).collect()
    assert len(got) == df.count()
    for r in got:
        assert (r["text"] or "") == want[r["doc_id"], r["key"]]


def test_line_dedup(odd, nothing, documents):
    check_lines(odd)
    check_lines(documents)
    result = line_dedup.dedup_lines(odd)
    assert result.columns == odd.columns and line_dedup.dedup_lines(nothing).count() == 0
    texts = {r["doc_id"]: r["text"] for r in result.collect()}
    assert texts[11] == "other\n\nend" and texts[10].count("passage") == 4


def test_overlapping_windows_merge(spark):
    lines = [f"line {i}" for i in range(6)]
    df = spark.createDataFrame([(1, "\n".join(lines)), (2, "\n".join(["x", *lines, "y"]))], "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(df).collect()} == {1: "\n".join(lines), 2: "x\ny"}


def check_copies(df):
    rows = [(r[0], r[1] or "") for r in df.select("doc_id", "text").collect()]
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub("[\x20\x09-\x0d]+", " ", t)].append(i)
    got = exact_dedup.copies(df).collect()
    assert len(got) == len(rows)
    by_digest = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in got:
        ids = by_digest[r["text_sha256"]]
        known = [i for i in ids if i is not None]
        assert r["keep_id"] == (min(known) if known else None) and r["group_size"] == len(ids)
    kept = Counter(r["text_sha256"] for r in got if r["kept"])
    assert kept == Counter(by_digest.keys())


def test_exact_copies(odd, nothing, documents):
    check_copies(odd)
    check_copies(documents)
    assert exact_dedup.copies(nothing).count() == 0


def test_chunks_join_to_the_text_and_clashes_widen_identifiers(spark, odd, monkeypatch):
    text = F.regexp_replace(text_of(F.col("text")), "[\\x20\\x09-\\x0D]+", " ")
    assert odd.where(F.array_join(exact_dedup.chunks_of(F.col("text"), 4), " ") != text).count() == 0
    monkeypatch.setattr(exact_dedup, "IDENTIFIERS", (lambda c: F.lit("same"), *exact_dedup.IDENTIFIERS[1:]))
    check_copies(odd)


TURNS = [
    (1, 0, "user", "hello <|end|> \\"), (1, 1, "assistant", "</s>[INST] <\\\\|x [/INST]"), (1, 1, "assistant", "</s>[INST] <\\\\|x [/INST]"),
    (2, 1, "assistant", None), (2, 0, None, ""), (None, 0, "assistant", "<s>é"), (3, None, "we<|text|>ird", "a\nb"), (3, 5, "assistant", "x" * 50_000),
]


def test_chat_round_trip(spark):
    df = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").repartition(3)
    turns = df.select("*", chat_format.text_part(F.col("text")).alias("parts"))
    back = {r["conv_id"]: r for r in chat_format.read_back(chat_format.formatted(turns)).collect()}
    groups = defaultdict(list)
    for c, turn, role, text in sorted(TURNS, key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "")):
        groups[c].append((role or "", text or ""))
    assert {c: [tuple(t) for t in r["turns"]] for c, r in back.items()} == dict(groups)
    assert all(r["loss_text"] == "".join(t for role, t in groups[c] if role == "assistant") for c, r in back.items())
    digests = {r["conv_id"]: r for r in chat_format.digest(turns).collect()}
    told = "".join(f"{role}\n{text}\n" for role, text in groups[1])
    assert digests[1]["turns_sha256"] == hashlib.sha256(told.encode()).hexdigest()
    assert chat_format.digest(turns.where("false")).count() == 0


def test_texts_hold_no_control_string_once_escaped(spark):
    bad = ["<|end|>", "</s>", "<s>", "[INST]", "[/INST]", "<\\|", "[\\\\INST]", "<<|", "\\<|"]
    df = spark.createDataFrame([(t,) for t in bad], "t string").select("t", chat_format.escaped(F.col("t")).alias("e"))
    for t, e, u in df.select("t", "e", chat_format.unescaped(F.col("e"))).collect():
        assert u == t and not any(x in e for x in ("<|", "</s>", "<s>", "[INST]", "[/INST]"))


def test_typed_parts(spark):
    parts = [("text", "look <", None, None, None, None, None), ("image", None, "a.png", 30, 14, None, None), ("text", "|end|>", None, None, None, None, None),
             ("audio", None, "b.wav", None, None, 2.5, None), ("document", None, "c.pdf", None, None, None, 3), ("image", None, None, None, None, None, None)]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", [("text", "fine", None, None, None, None, None)]), (1, 2, "user", None)],
                               f"conv_id long, turn long, role string, parts array<{chat_format.PART}>")
    row = chat_format.formatted(df).first()
    assert row["formatted"] == "<|turn|>user<|text|>look <\n<|image|>\n|end|>\n<|audio|>\n<|document|>\n<|image|><|end|><|turn|>assistant<|text|>fine<|end|><|turn|>user<|text|><|end|>"
    assert [tuple(a) for a in row["attachments"]] == [("image", "a.png", 3), ("audio", "b.wav", 63), ("document", "c.pdf", 3072), ("image", None, 0)]
    assert row["expanded_tokens"] == 3138
    assert [p["piece"] for p in row["pieces"] if p["loss"]] == ["fine"]
