"""Cross-document line frequency: boilerplate lines go, and so do documents they leave depleted.

Lines are normalised (blanks squeezed, letters lowered) and hashed. A line is a candidate on a host (``source``) when it stands
on more than ``max_docs`` of the host's distinct texts, however large the host. Exact copies of a document count once. So that near
copies are not mistaken for boilerplate either, a text which would lose more than ``1 - min_left`` of the words of its distinct lines to
candidates does not count by itself, but once for all texts that share its least candidate line: members of a family share nearly
all of their lines, so a family counts a few times, whatever its size. A candidate that still stands on more than ``max_docs`` of such
classes is removed on the host. A document fails when its own text is too short or repeats itself, or when less than ``min_left`` of its
words is left.

Defined results: null text is empty and fails; a null source is a host of its own; blank lines are neither
counted nor removed; repeated rows get equal results; an empty table gives an empty result. Other columns
pass through ``clean`` unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paritas.llm.common import bare, fresh, let, squeezed, stored, text_of, words_of

MAX_DOCS, MIN_LEFT = 20, 0.5
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
SYMBOLS = "#*$%&|<>"


def _repeat_words(words: Column) -> Column:
    """Words inside a window of ``WINDOW`` words that stands twice or more in the text."""

    def from_windows(windows: Column) -> Column:
        def from_sorted(ranked: Column) -> Column:
            twice = F.filter(ranked, lambda x, j: F.coalesce(F.get(ranked, j - 1)["h"] == x["h"], F.lit(False))
                             | F.coalesce(F.get(ranked, j + 1)["h"] == x["h"], F.lit(False)))
            return let(F.array_sort(F.transform(twice, lambda x: x["at"])), covered)

        ranked = F.array_sort(F.transform(windows, lambda h, at: F.struct(h.alias("h"), at.alias("at"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(let(ranked, from_sorted))

    def covered(starts: Column) -> Column:
        fresh_words = F.transform(
            starts, lambda at, j: F.least(F.lit(WINDOW), at - F.coalesce(F.get(starts, j - 1), F.lit(-WINDOW))))
        return F.aggregate(fresh_words, F.lit(0), lambda total, n: total + n)

    def windows_of(hashes: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(hashes) - WINDOW),
                           lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]))

    windows = let(F.transform(words, lambda w: F.xxhash64(w)), windows_of)
    return F.when(F.size(words) < WINDOW, F.lit(0)).otherwise(let(windows, from_windows)).cast("long")


def line_hashes(text: Column) -> Column:
    """One hash per ``\\n``-split line (60 bits of its MD5, so that SQL can order lines alike), null for a line without a word."""
    hashed = lambda line: F.conv(F.substring(F.md5(squeezed(bare(line)).cast("binary")), 1, 15), 16, 10).cast("long")
    return F.transform(F.split(F.lower(text_of(text)), "\n"), lambda line: F.when(bare(line) != "", hashed(line)))


def text_facts(docs: DataFrame) -> DataFrame:
    """doc_id, host, fp (of the text), the counts of the own text, ``base_failed``, and (line hash, words) of its lines."""
    text = text_of(F.col("text"))
    rows = docs.select(
        "doc_id", F.col("source").alias("host"), F.xxhash64(text).alias("fp"), text.alias("text"),
        words_of(F.col("text")).alias("words"))
    worded = F.filter(F.split(F.col("text"), "\n"), lambda line: bare(line) != "")
    rows = rows.select(
        "doc_id", "host", "fp", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", f"[{SYMBOLS}]", ""))).cast("long").alias("n_symbols"),
        let(worded, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("words")).alias("n_repeat_words"), _lines(F.col("text")).alias("lines"))
    return rows.withColumn("base_failed", _fails(F.col("n_words"), F.col("n_repeat_words")))


def _fails(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


def own_text_fails(words: Column) -> Column:
    """Whether a document of these words is too short or repeats itself."""
    return _fails(F.size(words), _repeat_words(words))


def _lines(text: Column) -> Column:
    """(line hash, words) of every worded line, in order."""
    counted = F.transform(F.split(text_of(text), "\n"), lambda line: F.size(words_of(line)))
    pairs = F.arrays_zip(line_hashes(text).alias("line"), counted.alias("n"))
    return F.filter(pairs, lambda x: x["line"].isNotNull())


def frequent_lines(lined: DataFrame, max_docs: int = MAX_DOCS, min_left: float = MIN_LEFT) -> DataFrame:
    """limit_host, limit_line: lines above the limit of their host, of ``lined(host, fp, lines)``.

    All counts start per task; a host or line that holds a third of all rows is a handful of rows by then. Only
    candidates meet again: at most one line in ``max_docs``.
    """
    own = lined.select("host", "fp", F.array_distinct("lines").alias("lines"))
    words = F.aggregate("lines", F.lit(0).cast("long"), lambda total, x: total + x["n"])
    texts = own.select("host", "fp", words.alias("n_all"), F.inline("lines")).distinct()
    often = texts.groupBy(F.col("host").alias("limit_host"), F.col("line").alias("limit_line")).agg(F.count("*").alias("line_docs")) \
        .where(F.col("line_docs") > max_docs).drop("line_docs")
    found = stored(texts.join(often, _on_limit()).drop("limit_host", "limit_line"), "candidate-lines")
    lost = found.groupBy(F.col("host").alias("of_host"), F.col("fp").alias("of_fp")).agg(
        F.max("n_all").alias("n_all"), F.sum("n").alias("n_lost"), F.min("line").alias("least_line"))
    alone = F.col("n_all") - F.col("n_lost") >= F.lit(min_left) * F.col("n_all")
    classes = lost.select("of_host", "of_fp", alone.alias("alone"), F.when(alone, F.col("of_fp")).otherwise(F.col("least_line")).alias("class"))
    counted = found.join(classes, F.col("host").eqNullSafe(F.col("of_host")) & (F.col("fp") == F.col("of_fp"))) \
        .select("host", "line", "alone", "class").distinct()
    return counted.groupBy(F.col("host").alias("limit_host"), F.col("line").alias("limit_line")).agg(F.count("*").alias("line_classes")) \
        .where(F.col("line_classes") > max_docs).drop("line_classes")


def _on_limit() -> Column:
    return F.col("host").eqNullSafe(F.col("limit_host")) & (F.col("line") == F.col("limit_line"))


def _hits(lined: DataFrame, max_docs: int, min_left: float) -> DataFrame:
    """hit_id, hit_host, hit_fp, removed: the frequent lines of each document that has any."""
    lines = lined.select("host", "doc_id", "fp", F.explode(F.array_distinct("lines.line")).alias("line"))
    found = lines.join(frequent_lines(lined, max_docs, min_left), _on_limit())
    return found.groupBy(F.col("doc_id").alias("hit_id"), F.col("host").alias("hit_host"), F.col("fp").alias("hit_fp")) \
        .agg(F.collect_set("line").alias("removed"))


def verdicts(docs: DataFrame, max_docs: int = MAX_DOCS, min_left: float = MIN_LEFT) -> DataFrame:
    """One row per document: the counts of its own text, what the line limits take, and ``kept``.

    The texts are read once; what is known of them is written to the shared folder.
    """
    facts = stored(text_facts(docs), "text-facts")
    rows = facts.join(
        _hits(facts, max_docs, min_left), F.col("doc_id").eqNullSafe(F.col("hit_id")) & F.col("host").eqNullSafe(F.col("hit_host"))
        & (F.col("fp") == F.col("hit_fp")), "left")
    gone = F.when(F.col("removed").isNull(), F.array().cast("array<struct<line:bigint,n:int>>")) \
        .otherwise(F.filter("lines", lambda x: F.array_contains("removed", x["line"])))
    rows = rows.withColumn("gone", gone).withColumns({
        "n_removed_lines": F.size("gone").cast("long"),
        "n_removed_words": F.aggregate("gone", F.lit(0).cast("long"), lambda total, x: total + x["n"])})
    left = F.col("n_words") - F.col("n_removed_words")
    rows = rows.withColumn("kept", ~F.col("base_failed") & (left >= F.lit(min_left) * F.col("n_words")))
    return rows.drop("hit_id", "hit_host", "hit_fp", "host", "fp", "lines", "removed", "gone")


def clean(docs: DataFrame, max_docs: int = MAX_DOCS, min_left: float = MIN_LEFT) -> DataFrame:
    """The documents that pass, without their frequent lines; every column of ``docs`` stays, ``n_chars`` follows the text."""
    names = fresh(docs, "q_failed", "q_words", "q_fp", "q_lines", "hit_id", "hit_host", "hit_fp", "removed")
    failed, words, fp, lines, hit_id, hit_host, hit_fp, removed = names
    own = text_of(F.col("text"))
    lined = stored(docs.select("doc_id", F.col("source").alias("host"), F.xxhash64(own).alias("fp"), _lines(F.col("text")).alias("lines")), "lines")
    hits = _hits(lined, max_docs, min_left).toDF(hit_id, hit_host, hit_fp, removed)
    rows = docs.withColumns({fp: F.xxhash64(own)}).join(
        hits, F.col("doc_id").eqNullSafe(F.col(hit_id)) & F.col("source").eqNullSafe(F.col(hit_host))
        & (F.col(fp) == F.col(hit_fp)), "left")
    all_words = words_of(F.col("text"))
    kept_text = F.when(F.col(removed).isNull(), own).otherwise(F.array_join(F.transform(
        F.filter(F.arrays_zip(F.split(own, "\n").alias("t"), line_hashes(F.col("text")).alias("h")),
                 lambda x: x["h"].isNull() | ~F.array_contains(removed, x["h"])), lambda x: x["t"]), "\n"))
    rows = rows.withColumns({words: F.size(all_words), failed: let(all_words, own_text_fails), lines: kept_text})
    rows = rows.where(~F.col(failed) & (F.size(words_of(F.col(lines))) >= F.lit(min_left) * F.col(words)))
    changed = {"text": F.col(lines)}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length(lines).cast(docs.schema["n_chars"].dataType)
    return rows.withColumns(changed).select(*[F.col(f"`{c}`") for c in docs.columns])
