"""Column expressions used by the pipeline. All are built-in Spark functions,
so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import AMT, OPEN_END

# Business date embedded in a landing file name: eight digits between the last
# '_' and the following '.', written day-month-year (fixed value).
FILE_DATE_PATTERN = r".*_(\d{8})\."
FILE_DATE_FORMAT = "ddMMyyyy"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_of(c: str | Column) -> Column:
    """``date(x)``: the calendar day of a timestamp."""
    return F.to_date(col_(c))


def shift_days(c: str | Column, days: int = 1) -> Column:
    """``date(x, '+N day')``; NULL in, NULL out."""
    return F.date_add(day_of(c), days)


def prev_second(c: str | Column) -> Column:
    """``datetime(x, '-1 second')``: day D becomes D-1 23:59:59."""
    return col_(c).cast("timestamp_ntz") - F.expr("INTERVAL 1 SECOND")


def seconds(n: int | float) -> Column:
    """A day-time interval literal of ``n`` seconds."""
    return F.expr(f"INTERVAL '{int(n)}' SECOND")


def elapsed(later: str | Column, earlier: str | Column) -> Column:
    """Elapsed time between two timestamp_ntz values as a day-time interval.

    Comparing the interval with :func:`seconds` keeps sub-second precision,
    unlike truncating both sides to whole epoch seconds.
    """
    return col_(later) - col_(earlier)


def epoch_second(c: str | Column) -> Column:
    """Whole seconds since 1970-01-01 of a timestamp_ntz, without any time zone.

    Used only for bucketing, never for a rule threshold.
    """
    c = col_(c)
    return (F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("long") * 86400
            + F.hour(c) * 3600 + F.minute(c) * 60 + F.floor(F.second(c)).cast("long"))


def full_name(*parts: str | Column, sep: str = " ") -> Column:
    """``a || ' ' || b || ...``: NULL when any part is NULL (unlike concat_ws)."""
    items: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            items.append(F.lit(sep))
        items.append(col_(p))
    return F.concat(*items)


def file_date(path: str | Column) -> Column:
    """Business date taken from a landing file path (NULL when absent)."""
    digits = F.regexp_extract(col_(path), FILE_DATE_PATTERN, 1)
    return F.when(F.length(digits) == 8,
                  F.try_to_timestamp(digits, F.lit(FILE_DATE_FORMAT)).cast("date"))


def file_tag(date_col: str | Column) -> Column:
    """The DDMMYYYY tag used in landing file names."""
    return F.date_format(col_(date_col), FILE_DATE_FORMAT)


def amount(c: str | Column) -> Column:
    """Text amount to decimal(12,2); a decimal comma is accepted, junk is NULL."""
    text = F.regexp_replace(F.trim(col_(c).cast("string")), ",", ".")
    return text.try_cast(AMT)


def open_end() -> Column:
    return F.lit(OPEN_END).cast("timestamp_ntz")


def as_timestamp(value) -> Column:
    """A literal or column as timestamp_ntz (dates become midnight)."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    return F.lit(value).cast("timestamp_ntz")
