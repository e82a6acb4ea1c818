"""Fixed-width text."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators.predicates import sheet_rows, text_of
from .delimited import ReadResult, clean_cell
from .lines import numbered_lines


def layout_spans(layout) -> list[tuple[str, int, int]]:
    """(name, start, end) per layout row, from start/end or running lengths."""
    spans, at = [], 1
    for row in sheet_rows(layout):
        name = text_of(row.get("varname") or row.get("variable_name") or row.get("name"))
        start, end = text_of(row.get("start")), text_of(row.get("end"))
        if start and end:
            first, last = int(float(start)), int(float(end))
        else:
            first, last = at, at + int(float(row["length"])) - 1
        if first < 1 or last < first:
            raise ValueError(f"bad span {first}..{last} of {name}")
        at = last + 1
        spans.append((name, first, last))
    return spans


def read_fixed_width(spark: SparkSession, path, layout, first_row: int = 1, encoding: str = "UTF-8",
                     strip: bool = True, skip: tuple[str, ...] = ("filler",), one_text: bool = False) -> ReadResult:
    """Slices of each line as text columns; blank and lone-period cells are NULL.

    A field that ends beyond its line is an error row and NULL.  With ``one_text``
    the files of ``path`` are parts of one text.
    """
    spans = [s for s in layout_spans(layout) if s[0].lower() not in skip]
    lines = numbered_lines(spark, path, encoding, one_text).where(F.col("line_number") >= first_row)
    length = F.length("value")

    def cell(first: int, last: int):
        raw = F.substring("value", first, last - first + 1)
        return F.when(length >= last, clean_cell(raw) if strip else raw)

    data = lines.select("line_number", *[cell(a, b).alias(n) for n, a, b in spans])
    short = F.filter(F.array(*[
        F.when(length < b, F.struct(F.lit(n).alias("variable"))) for n, _, b in spans]), lambda x: x.isNotNull())
    errors = lines.where(length < max(b for _, _, b in spans)).select("line_number", F.inline(short)).select(
        "line_number", "variable", F.lit(None).cast("string").alias("value"),
        F.lit("Start < 0 or end > line width").alias("point_of_failure"))
    return ReadResult(data, errors)
