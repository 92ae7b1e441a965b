"""Small text helpers for control tables and reports."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Spellings of "no value" in hand-kept control tables.
MISSING_WORDS = ["", "nat", "nan", "none", "null"]
# Words that switch a table pair on.
ENABLED_WORDS = ["yes", "y"]
# Display cut for long text, and for digests.
TEXT_CUT, DIGEST_CUT = 50, 16


def is_missing(c: Column) -> Column:
    """NULL, or a spelling of "no value" once trimmed and lower-cased."""
    return c.isNull() | F.lower(F.trim(c.cast("string"))).isin(MISSING_WORDS)


def null_if_missing(c: Column, tokens: list[str] | None = None) -> Column:
    """NULL for the configured tokens (or every spelling of "no value"), else the value."""
    hit = c.isin(tokens) if tokens is not None else is_missing(c)
    return F.when(~hit, c)


def enabled_flag(c: Column) -> Column:
    """True when one of the enabling words occurs as a whole word."""
    return F.coalesce(c.rlike(r"(?i)\b(" + "|".join(ENABLED_WORDS) + r")\b"), F.lit(False))


def strip_remark(name: Column) -> Column:
    """Drop a trailing remark in parentheses from a name."""
    return F.trim(F.regexp_replace(name, r"\(.*\)", ""))


def qualifier(name: Column) -> Column:
    """Part before the first dot; NULL without a dot."""
    return F.when(F.instr(name, ".") > 0, F.substring_index(name, ".", 1))


def base_name(name: Column) -> Column:
    """Part after the last dot; the whole name without a dot."""
    return F.substring_index(name, ".", -1)


def tokenised_by_comment(comment: Column) -> Column:
    """Rule of the view-keyed crosswalk: the first sentence mentions tokenising."""
    first_sentence = F.lower(F.substring_index(comment, ".", 1))
    return F.coalesce(first_sentence.contains("tokenise"), F.lit(False))


def tokenised_by_presence(comment: Column) -> Column:
    """Rule of the sheet-keyed crosswalk: any comment marks the column."""
    return ~is_missing(comment)


def render_value(c: Column, numeric: bool = False, cut: int = TEXT_CUT) -> Column:
    """Text shown in a report: NULL as '', whole floats as ints, long text cut."""
    if numeric:
        whole = c.try_cast("decimal(38,0)")
        return F.coalesce(F.when(whole == c, whole.cast("string")), c.cast("string"), F.lit(""))
    text = c.cast("string")
    return F.coalesce(
        F.when(F.length(text) > cut, F.concat(F.substring(text, 1, cut), F.lit("..."))).otherwise(text),
        F.lit(""),
    )


def render_digest(c: Column) -> Column:
    """A digest cut for display."""
    return F.concat(F.substring(F.coalesce(c, F.lit("N/A")), 1, DIGEST_CUT), F.lit("..."))
