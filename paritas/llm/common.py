"""Helpers shared by the operators of this subpackage.

A *word* is a maximal run of characters outside ``[\\x20\\x09-\\x0D]``. A document row is told apart by
``(doc_id, fingerprint of its text)``, so null or repeated ids never mix rows of different texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paritas.sources.results import dropped, stored

__all__ = ["BLANKS", "bare", "crc_bucket", "dropped", "fresh", "let", "n_words_of", "read", "squeezed", "stored", "text_of", "words_of"]

BLANKS = "\t\n\x0b\x0c\r "
BLANK_RUN = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(text: Column) -> Column:
    """The text, null read as empty."""
    return F.coalesce(text, F.lit(""))


def bare(text: Column) -> Column:
    """Without the blanks at both ends."""
    return F.btrim(text, F.lit(BLANKS))


def words_of(text: Column) -> Column:
    """Words in order."""
    trimmed = bare(text_of(text))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_RUN))


def n_words_of(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def squeezed(text: Column) -> Column:
    """Every run of blanks as one space."""
    return F.regexp_replace(text_of(text), BLANK_RUN, " ")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also where the body uses it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def crc_bucket(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as the empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n).cast("int")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have, one for each wanted name."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out
