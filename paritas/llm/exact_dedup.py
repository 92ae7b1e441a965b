"""Exact copies by content-defined chunk recipes.

The squeezed text is cut into chunks where the hash of two neighbouring words is a multiple of ``SPACING``, so equal passages are cut
alike wherever they stand. Each chunk gets an identifier, and the identifiers are verified: every distinct
chunk text is moved once, to the others of its identifier, and no two texts may share one. Should two, wider
identifiers are taken. A document's recipe, the ordered list of its identifiers, then stands for its text: recipes
are equal exactly when the texts are, and no long text moves again.

Defined results: null text is empty, and empty texts are equal; a null id comes after every other; of rows that
agree in id and text exactly one is kept; an empty table gives an empty result; only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paritas.llm.common import let, squeezed, stored, text_of

SPACING = 64
#: Identifiers from narrow to wide; the first without a clash is used.
IDENTIFIERS = (
    lambda chunk: F.hex(F.xxhash64(chunk)),
    lambda chunk: F.md5(chunk.cast("binary")),
    lambda chunk: F.sha2(chunk, 256),
)


def chunks_of(text: Column, spacing: int = SPACING) -> Column:
    """The chunks of the squeezed text; joined by single spaces they are the text."""
    return _chunks(squeezed(text), spacing)


def _chunks(flat: Column, spacing: int) -> Column:
    """The chunks of a text that is squeezed already."""

    def cut(words: Column) -> Column:
        def pieces(ends: Column) -> Column:
            def piece(end: Column, k: Column) -> Column:
                before = F.coalesce(F.get(ends, k - 1), F.lit(0))
                return F.array_join(F.slice(words, before + 1, end - before), " ")

            return F.transform(ends, piece)

        # the last word's hash has no neighbour in it; its mark, if any, is the end that is added anyway
        marks = F.transform(words, lambda w, i: F.when(
            F.xxhash64(w, F.get(words, i + 1)) % F.lit(spacing).cast("long") == 0, i + 1))
        return let(F.array_distinct(F.concat(F.array_compact(marks), F.array(F.size(words)))), pieces)

    return let(F.split(flat, " "), cut)


def _verified(chunked: DataFrame) -> int:
    """The first of ``IDENTIFIERS`` by which no two chunk texts of ``chunked(chunks)`` are one."""
    for k, identifier in enumerate(IDENTIFIERS):
        texts = chunked.select(F.explode("chunks").alias("chunk")).select(identifier(F.col("chunk")).alias("id"), "chunk").distinct()
        if texts.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
            return k
    raise ValueError("two chunks share a SHA-256 digest")


def copies(docs: DataFrame, spacing: int = SPACING) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row.

    The words of a text are looked at once: its chunks are written to the shared folder, from where they are verified and
    turned into recipes. Groups are counted before the shuffle; the join back is on the recipe, where adaptive execution splits a group
    that is a large part of all rows.
    """
    text = docs.select("doc_id", text_of(F.col("text")).alias("own"), squeezed(F.col("text")).alias("flat"))
    chunked = stored(text.select(
        "doc_id", F.xxhash64("own").alias("fp"), F.sha2("flat", 256).alias("text_sha256"), _chunks(F.col("flat"), spacing).alias("chunks")), "chunks")
    identifier = IDENTIFIERS[_verified(chunked)]
    rows = stored(chunked.select("doc_id", "fp", "text_sha256", F.array_join(F.transform("chunks", identifier), " ").alias("recipe")), "recipes")
    groups = rows.groupBy(F.col("recipe").alias("group_recipe")).agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    rows = rows.join(groups, F.col("recipe") == F.col("group_recipe")).drop("recipe", "group_recipe")
    same = W.partitionBy("doc_id", "text_sha256").orderBy("fp")
    first = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.row_number().over(same) == 1)
    return rows.withColumn("kept", first).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
