"""Keys, dates, small numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import to_number
from .text import _c


def blank(value: Column | str) -> Column:
    """NULL or only blanks."""
    text = _c(value).cast("string")
    return text.isNull() | (F.trim(text) == "")


def composite_key(*columns: Column | str, delimiter: str = "_") -> Column:
    """Delimited key; NULL counts as the empty text."""
    return F.concat_ws(delimiter, *[F.coalesce(_c(c).cast("string"), F.lit("")) for c in columns])


def grade_or_default(grade: Column | str, default: str = "99") -> Column:
    """Whole number text of a grade, or the default when it is not a number."""
    number = to_number(grade)
    return F.coalesce(number.try_cast("int").cast("string"), F.lit(default))


def compose_date(year, month, day, text: bool = False, year_range: tuple[int, int] | None = None) -> Column:
    """Validated date of three parts, else NULL (``text`` gives ``MM/DD/YYYY``)."""
    y, m, d = (to_number(p).try_cast("int") for p in (year, month, day))
    if year_range is not None:
        y = F.when(y.between(*year_range), y)
    date = F.try_to_date(F.format_string("%04d-%02d-%02d", y, m, d), "yyyy-MM-dd")
    date = F.when(y.isNotNull() & m.isNotNull() & d.isNotNull(), date)
    return F.date_format(date, "MM/dd/yyyy") if text else date


def median3(a, b, c) -> Column:
    """Middle of three numbers; NULL if one is NULL."""
    a, b, c = _c(a), _c(b), _c(c)
    middle = F.greatest(F.least(a, b), F.least(F.greatest(a, b), c))
    return F.when(a.isNotNull() & b.isNotNull() & c.isNotNull(), middle)


def min3(a, b, c) -> Column:
    a, b, c = _c(a), _c(b), _c(c)
    return F.when(a.isNotNull() & b.isNotNull() & c.isNotNull(), F.least(a, b, c))


def band_number(row_number, size: int = 5, cap: int = 10) -> Column:
    """Number of the block of ``size`` rows, at most ``cap``."""
    return F.least(F.ceil(_c(row_number) / F.lit(size)).cast("int"), F.lit(cap))


def clean_label(value: Column | str) -> Column:
    """NULL to empty, ``- -`` to ``-``, whitespace collapsed and trimmed."""
    text = F.replace(F.coalesce(_c(value).cast("string"), F.lit("")), F.lit("- -"), F.lit("-"))
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def trim_float_text(value: Column | str) -> Column:
    """``3.0`` becomes ``3`` so that levels of two sources match; NULL becomes empty."""
    text = _c(value).cast("string")
    number = to_number(text)
    whole = text.contains(".") & number.isNotNull() & (number == F.floor(number)) & (F.abs(number) < 1e15)
    return F.when(text.isNull() | (text == "None"), F.lit("")).when(
        whole, number.try_cast("bigint").cast("string")).otherwise(text)
