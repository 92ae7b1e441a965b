"""Dates: parsing, native formats and the labels and bounds of time partitions.

Parsing never goes through a failing formatter: text is brought to ISO order with
string functions and ``try_cast`` decides, so one bad value costs no exception.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

ISO, COMPACT, SLASHED = "yyyy-MM-dd", "yyyyMMdd", "yyyy/MM/dd"
ISO_TIME = "yyyy-MM-dd HH:mm:ss"

# Recognised shapes of a date held as text, with the pattern they follow.
TEXT_SHAPES = [
    (COMPACT, r"^\d{8}$"),
    (ISO, r"^\d{4}-\d{2}-\d{2}$"),
    (SLASHED, r"^\d{4}/\d{2}/\d{2}$"),
    (ISO_TIME, r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"),
]

# A text "looks like it holds a date" when one of these occurs in it.
DATELIKE = r"\d{4}-\d{2}-\d{2}|\d{2}-\d{2}-\d{4}|\d{4}/\d{2}/\d{2}|\d{2}/\d{2}/\d{4}|\d{8}"

MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()

# Spellings of the partition unit.
PARTITION_UNITS = {
    "day": "day", "daily": "day",
    "week": "week", "year_week": "week",
    "month": "month", "year_month": "month",
    "year": "year",
    "all": "all", "whole": "all", "snapshot": "all",
}

EXCEL_EPOCH = "1899-12-30"


def partition_unit(name: str) -> str:
    if name not in PARTITION_UNITS:
        raise ValueError(f"unknown partition {name!r}; use one of {sorted(PARTITION_UNITS)}")
    return PARTITION_UNITS[name]


# ---------------------------------------------------------------- parsing


# Rewrites to ISO order, tried from the top; each leaves text of another shape alone.
_YEAR_FIRST = (r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})$", "$1-$2-$3")
_COMPACT = (r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
_MONTH_FIRST = (r"^(0?[1-9]|1[0-2])[-/.](\d{1,2})[-/.](\d{4})$", "$3-$1-$2")
_DAY_FIRST = (r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})$", "$3-$2-$1")
_NAMED_MONTH_DAY = (r"^([A-Za-z]{3})[A-Za-z]{0,6}\.? (\d{1,2}),? (\d{4})$", "$3-$1-$2")
_NAMED_DAY_MONTH = (r"^(\d{1,2})[ -]([A-Za-z]{3})[A-Za-z]{0,6}[ -](\d{4})$", "$3-$2-$1")

_ISO_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2}$"
_CLOCK = r"([01]?\d|2[0-3]):[0-5]?\d(:[0-5]?\d(\.\d+)?)?"


def _rewritten(s: Column, *rules: tuple[str, str]) -> Column:
    for pattern, order in rules:
        s = F.regexp_replace(s, pattern, order)
    return s


def _iso_date(s: Column) -> Column:
    """DATE of text in ISO order, NULL for any other text (a bare year is no date)."""
    return F.when(s.rlike(_ISO_SHAPE), s.try_cast("date"))


def parse_any(c: Column) -> Column:
    """Text in any common notation to DATE, NULL when it is none.

    Year-first and compact forms, day/month forms read month first unless the first
    number cannot be a month, and English month names; a time of day is ignored.
    """
    plain = F.trim(c.cast("string"))
    s = F.regexp_replace(plain, r"[T ]" + _CLOCK + r"Z?$", "")
    named = _rewritten(s, _NAMED_MONTH_DAY, _NAMED_DAY_MONTH)
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(F.substring(named, 6, 3)))
    numbered = F.concat_ws("-", F.substring(named, 1, 4), month.cast("string"), F.regexp_extract(named, r"(\d+)$", 1))
    # the forms tables are full of are settled by the first branches
    return (
        F.when(plain.rlike(_ISO_SHAPE), plain.try_cast("date"))
        .when(plain.rlike(_COMPACT[0]), compact_to_date(plain))
        .when(s.rlike(r"[A-Za-z]"), _iso_date(numbered))
        .otherwise(_iso_date(_rewritten(s, _YEAR_FIRST, _MONTH_FIRST, _DAY_FIRST)))
    )


def compact_rebuild(c: Column) -> Column:
    """``yyyymmdd`` to ``yyyy-mm-dd`` by position, without validation."""
    return F.concat_ws("-", F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2))


def compact_to_date(c: Column) -> Column:
    return compact_rebuild(c).try_cast("date")


def parse_strict(c: Column) -> Column:
    """DATE from the year-first, day-first and compact notations only; else NULL.

    Unlike :func:`parse_any` a day/month pair is always read day first, which is what
    the statistics comparers expect of a rendered minimum or maximum.
    """
    year_first = (r"^(\d{4})([-/])(\d{1,2})\2(\d{1,2})( " + _CLOCK + r")?$", "$1-$3-$4")
    day_first = (r"^(\d{1,2})([-/])(\d{1,2})\2(\d{4})$", "$4-$3-$1")
    return _iso_date(_rewritten(F.trim(c.cast("string")), year_first, day_first, _COMPACT))


def contains_datelike(c: Column) -> Column:
    return F.coalesce(c.cast("string").rlike(DATELIKE), F.lit(False))


def parse_with(c: Column, fmt: str | None) -> Column:
    """Text mostly in a known format to DATE; what does not fit it is read in any notation, so no minority is lost."""
    return parse_any(c) if fmt is None else F.coalesce(_parse_in(c, fmt), parse_any(c))


def _parse_in(c: Column, fmt: str) -> Column:
    """Text in one format to DATE, NULL for other text; the common formats avoid a formatter."""
    if fmt == COMPACT:
        return F.when(F.length(c) == 8, compact_to_date(c))
    if fmt == ISO:
        return F.when(F.length(c) == 10, c.try_cast("date"))
    if fmt == ISO_TIME:
        return F.substring(c, 1, 10).try_cast("date")
    if fmt == SLASHED:
        return F.when(F.length(c) == 10, F.translate(c, "/", "-").try_cast("date"))
    return F.try_to_date(c, fmt)


def to_day(c: Column, dtype: T.DataType, fmt: str | None = None) -> Column:
    """Any date column to DATE: timestamps are cut to the day, text is parsed."""
    if isinstance(dtype, T.DateType):
        return c
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return c.cast("date")
    return parse_with(c, fmt)


def iso_text(day: Column) -> Column:
    return day.cast("string")


def excel_serial(c: Column) -> Column:
    """Spreadsheet cell to ISO text: serial day numbers, else parsed; '' when neither."""
    s = F.trim(c.cast("string"))
    number = s.rlike(r"^\d{1,6}(\.\d+)?$")
    from_serial = F.date_add(F.lit(EXCEL_EPOCH).cast("date"), F.floor(s.try_cast("double")).cast("int"))
    return F.coalesce(iso_text(F.when(number, from_serial).otherwise(parse_any(s))), F.lit(""))


# ---------------------------------------------------------------- native formats


def text_shape(c: Column) -> Column:
    """Pattern a text value follows, ``'unknown'`` for other text, NULL for none."""
    out = F.when(c.isNotNull() & (F.trim(c) != ""), F.lit("unknown"))
    for fmt, shape in reversed(TEXT_SHAPES):
        out = F.when(c.rlike(shape), F.lit(fmt)).otherwise(out)
    return out


def format_profile(df: DataFrame, column: str) -> DataFrame:
    """How many values of a column follow which date format: ``(kind, fmt, n, share)``.

    The whole column is read, so a minority format cannot hide behind one sampled row.
    """
    if not isinstance(df.schema[column].dataType, T.StringType):
        typed = df.groupBy().agg(F.count(F.col(column)).alias("n"))
        return typed.select(
            F.lit("date").alias("kind"), F.lit(None).cast("string").alias("fmt"), "n",
            F.lit(1.0).alias("share"),
        )
    counts = df.groupBy(text_shape(F.col(column)).alias("fmt")).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.where("fmt IS NOT NULL")
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(
        F.when(F.col("fmt") == "unknown", "unknown").otherwise("string").alias("kind"),
        F.when(F.col("fmt") != "unknown", F.col("fmt")).alias("fmt"),
        "n",
        (F.col("n") / total).alias("share"),
    )


def to_native(day: Column, fmt: str | None) -> Column:
    """A day as its source writes it; typed sources get a DATE literal."""
    if fmt is None:
        return F.concat(F.lit("DATE '"), iso_text(day), F.lit("'"))
    return F.date_format(day, fmt)


def within(column: Column, dtype: T.DataType, fmt: str | None, start: str | None, end: str | None,
           half_open: bool = False, mixed: bool = False) -> Column:
    """Window predicate on the *raw* column so that it reaches the file scan.

    The bounds, not the rows, are converted: typed columns compare with typed literals
    and sortable text with the bound written in the column's own format. With ``mixed``, text of another shape than the
    format's is parsed as what it is and meets the bounds as a date; such a predicate is not pushed down.
    """
    if mixed and isinstance(dtype, T.StringType) and fmt in dict(TEXT_SHAPES):
        bounds = (start, end, half_open)
        return F.when(column.rlike(dict(TEXT_SHAPES)[fmt]), within(column, dtype, fmt, *bounds)) \
            .otherwise(within(parse_any(column), T.DateType(), None, *bounds))
    if isinstance(dtype, T.StringType) and fmt not in (COMPACT, ISO, SLASHED, ISO_TIME):
        column, dtype = parse_with(column, fmt), T.DateType()
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        literal = lambda d, plus: F.lit(d).cast("date") + F.expr(f"INTERVAL {plus} DAY")
        cast = lambda x: x.cast(dtype)
    elif isinstance(dtype, T.DateType):
        literal = lambda d, plus: F.date_add(F.lit(d).cast("date"), plus)
        cast = lambda x: x
    else:
        literal = lambda d, plus: F.date_add(F.lit(d).cast("date"), plus)
        cast = lambda x: F.date_format(x, ISO if fmt == ISO_TIME else fmt)
    out = F.lit(True)
    if start is not None:
        out = out & (column >= cast(literal(start, 0)))
    if end is not None:
        # an inclusive end is the next day exclusive: right for values with a time of day
        out = out & (column < cast(literal(end, 0 if half_open else 1)))
    return out


# ---------------------------------------------------------------- labels and bounds


def iso_week_label(day: Column, joint: str = "-W") -> Column:
    """ISO week, labelled with the ISO year it belongs to."""
    year = F.extract(F.lit("YEAROFWEEK"), day).cast("string")
    return F.concat(year, F.lit(joint), F.lpad(F.weekofyear(day).cast("string"), 2, "0"))


def monday_week_label(day: Column) -> Column:
    """Week of the calendar year counted from its first Monday, ``2024-W00`` before it."""
    week = F.floor((F.dayofyear(day) + 6 - F.weekday(day)) / 7).cast("string")
    return F.concat(F.year(day).cast("string"), F.lit("-W"), F.lpad(week, 2, "0"))


def vintage_label(day: Column, unit: str) -> Column:
    """Label of the time partition a day falls into."""
    unit = partition_unit(unit)
    label = {
        "day": lambda: F.concat(F.lit("D"), F.date_format(day, "yyyyMMdd")),
        "week": lambda: F.concat(F.lit("W"), iso_week_label(day, "W")),
        "month": lambda: F.concat(F.lit("M"), F.date_format(day, "yyyyMM")),
        "year": lambda: F.concat(F.lit("Y"), F.date_format(day, "yyyy")),
        "all": lambda: F.lit("all"),
    }[unit]()
    return F.when(day.isNotNull(), label)


def observed_label(day: Column, unit: str) -> Column:
    """Label in the dashed style used for windows built from observed days."""
    unit = partition_unit(unit)
    if unit == "week":
        return monday_week_label(day)
    if unit == "month":
        return F.date_format(day, "yyyy-MM")
    if unit == "day":
        return iso_text(day)
    return F.lit("all")


def windows(bounds: DataFrame, unit: str, by: list[str] | None = None) -> DataFrame:
    """``(vintage, start_date, end_date)`` covering ``min_day..max_day``.

    Whole partitions are laid out, the first may start before the minimum, the last is
    cut at the maximum. NULL bounds give no window.
    """
    unit, by = partition_unit(unit), by or []
    low, high = F.col("min_day"), F.col("max_day")
    if unit == "all":
        starts = F.array(low)
    else:
        step = {"day": "1 DAY", "week": "7 DAY", "month": "1 MONTH", "year": "1 YEAR"}[unit]
        first = low if unit == "day" else F.trunc(low, unit)
        starts = F.sequence(first, high, F.expr(f"INTERVAL {step}"))
    last = {
        "day": lambda s: s,
        "week": lambda s: F.date_add(s, 6),
        "month": lambda s: F.last_day(s),
        "year": lambda s: F.make_date(F.year(s), F.lit(12), F.lit(31)),
        "all": lambda s: high,
    }[unit]
    laid = bounds.where(low.isNotNull() & high.isNotNull()).select(*by, high.alias("max_day"), F.explode(starts).alias("start_date"))
    start = F.col("start_date")
    return laid.select(
        *by,
        vintage_label(start, unit).alias("vintage"),
        start,
        F.least(last(start), F.col("max_day")).alias("end_date"),
    )


def iso_week_bounds(year: Column, week: Column) -> tuple[Column, Column]:
    """First and last day of a numbered week, cut to its calendar year."""
    jan1, dec31 = F.make_date(year, F.lit(1), F.lit(1)), F.make_date(year, F.lit(12), F.lit(31))
    start = F.date_add(F.trunc(jan1, "week"), (7 * (week - 1)).cast("int"))
    return F.greatest(start, jan1), F.least(F.date_add(start, 6), dec31)


def descriptor(var: str, dtype: T.DataType, fmt: str | None) -> Column:
    """``(var, type, fmt)`` of a date column as a struct, ready for JSON."""
    kind = "string" if isinstance(dtype, T.StringType) else "date"
    return F.struct(
        F.lit(var).alias("var"), F.lit(kind).alias("type"), F.lit(fmt).cast("string").alias("fmt")
    )
