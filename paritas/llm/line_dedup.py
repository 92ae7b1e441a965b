"""Repeated passages of three lines: hash overlapping windows, keep the first place, remove the later ones.

A line counts when it has a word; blanks inside it are squeezed before hashing. Every three consecutive such
lines of a document form a window. A window that stands in several places keeps its first (smallest doc_id,
then text fingerprint, then position); at every later place its three lines are covered, overlapping covers
merge, and covered lines go. A removed line always stands in an earlier place too, so no line is lost.

Defined results: null text is empty; a document with fewer than three worded lines keeps all; a null doc_id
comes first; rows that agree in doc_id and text are one document and get equal results; blank lines stay;
an empty table gives an empty result. Other columns pass through unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paritas.llm.common import bare, fresh, let, squeezed, text_of

WINDOW = 3


def _windows(text: Column) -> Column:
    """(key, key2, at, spots) of every window: two hashes of 96 bits together, first line, all its lines."""

    def of_lines(lines: Column) -> Column:
        def window(i: Column) -> Column:
            texts = [F.get(lines, i + k)["line"] for k in range(WINDOW)]
            spots = F.array(*[F.get(lines, i + k)["at"] for k in range(WINDOW)])
            return F.struct(F.xxhash64(*texts).alias("key"), F.hash(*texts).alias("key2"), spots.alias("spots"))

        starts = F.when(F.size(lines) >= WINDOW, F.sequence(F.lit(0), F.size(lines) - WINDOW)) \
            .otherwise(F.array().cast("array<int>"))
        return F.transform(starts, window)

    plain = F.transform(F.split(text, "\n"), lambda line, at: F.struct(at.alias("at"), squeezed(bare(line)).alias("line")))
    return let(F.filter(plain, lambda x: x["line"] != ""), of_lines)


def later_places(docs: DataFrame) -> DataFrame:
    """place_id, place_fp, covered: the lines of each document that lie in a window standing earlier elsewhere.

    The search for first places starts per task, so a window on a third of all documents is a row per task; the
    join back is on the window's key, where adaptive execution splits what is hot.
    """
    text = text_of(F.col("text"))
    windows = docs.select(F.col("doc_id").alias("place_id"), F.xxhash64(text).alias("place_fp"), F.explode(_windows(text)).alias("w")) \
        .select("place_id", "place_fp", "w.key", "w.key2", "w.spots")
    place = F.struct("place_id", "place_fp", F.get("spots", F.lit(0)).alias("at"))
    first = windows.groupBy(F.col("key").alias("first_key"), F.col("key2").alias("first_key2")) \
        .agg(F.min(place).alias("first"), F.max(place).alias("last")).where(F.col("first") < F.col("last")).drop("last")
    later = windows.join(first, (F.col("key") == F.col("first_key")) & (F.col("key2") == F.col("first_key2"))) \
        .where(place > F.col("first"))
    return later.groupBy("place_id", "place_fp").agg(F.array_distinct(F.flatten(F.collect_list("spots"))).alias("covered"))


def _left_over(text: Column, covered: Column) -> Column:
    """The text without the covered lines."""

    def lines_left(lines: Column) -> Column:
        spots = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), covered)
        return F.array_join(F.transform(spots, lambda at: F.get(lines, at)), "\n")

    return F.when(covered.isNull(), text).otherwise(let(F.split(text, "\n"), lines_left))


def dedup_lines(docs: DataFrame, report: tuple[str, ...] = ()) -> DataFrame:
    """Every document without its later passages; ``report`` names a column for the number of lines removed."""
    fp, place_id, place_fp, covered = fresh(docs, "line_fp", "place_id", "place_fp", "covered")
    own = text_of(F.col("text"))
    rows = docs.withColumn(fp, F.xxhash64(own)).join(
        later_places(docs).toDF(place_id, place_fp, covered),
        F.col("doc_id").eqNullSafe(F.col(place_id)) & (F.col(fp) == F.col(place_fp)), "left")
    changed = {"text": F.when(F.col(covered).isNull(), F.col("text")).otherwise(_left_over(own, F.col(covered)))}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col(covered).isNull(), F.col("n_chars")).otherwise(F.length(changed["text"])) \
            .cast(docs.schema["n_chars"].dataType)
    changed |= {c: F.coalesce(F.size(covered), F.lit(0)).cast("long") for c in report}
    return rows.withColumns(changed).select(*[F.col(f"`{c}`") for c in (*docs.columns, *report)])
