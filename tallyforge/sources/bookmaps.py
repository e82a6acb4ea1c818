"""Answer keys (bookmaps): one table of items per grade, subject and form."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import to_number
from ..operators.predicates import sheet_rows, text_of

LOCATION_COLUMNS = ("location", "grade_values", "subject", "subject_values", "form_values")
# Columns every bookmap must have.
ITEM_COLUMNS = (
    "item position", "book position", "its id", "grade", "subject", "form", "session", "reporting subscore", "role",
    "item format", "point value", "answer key", "numeric key", "weight", "test", "tagged for release",
    "content standard", "grade level",
)


def filter_locations(locations, subject: str | None = None, grade: str | None = None, form: str | None = None) -> list[dict]:
    """Location rows of a subject, grade and form; ``all`` and ``g`` match any grade."""
    rows = sheet_rows(locations)

    def fits(row, column, value, wild=()):
        have = text_of(row.get(column)).lower()
        return value is None or have == str(value).lower() or have in wild

    return [r for r in rows if fits(r, "subject_values", subject) and fits(r, "grade_values", grade, ("all", "g"))
            and fits(r, "form_values", form)]


def rewrite_location(location: str, substitutions: Mapping[str, str] | Sequence[tuple[str, str]] = ()) -> str:
    """Apply ordered regex substitutions to a location text."""
    pairs = substitutions.items() if isinstance(substitutions, Mapping) else substitutions
    for pattern, replacement in pairs:
        location = re.sub(pattern, replacement, location)
    return location


def read_bookmaps(locations, reader: Callable[[str], DataFrame], substitutions=(),
                  required: Sequence[str] = ITEM_COLUMNS) -> DataFrame:
    """Stack the bookmaps named by a locations sheet, with their keys attached.

    The driver loops over the few location rows; the items stay in Spark.
    Item columns come out as text under their declared names, the location
    keys as grade_values, subject_values, form_values and location_subject.
    """
    out = None
    for row in sheet_rows(locations):
        missing = [c for c in LOCATION_COLUMNS if c not in row]
        if missing:
            raise ValueError(f"bookmap locations lack columns: {', '.join(missing)}")
        location = rewrite_location(text_of(row["location"]), substitutions)
        frame = reader(location)
        by_name = {re.sub(r"[\s_]+", " ", c.strip().lower()): c for c in frame.columns}
        absent = [c for c in required if c not in by_name]
        if absent:
            raise ValueError(f"bookmap {location} lacks columns: {', '.join(absent)}")
        part = frame.select(
            *[F.trim(F.col(f"`{by_name[c]}`").cast("string")).alias(c) for c in required],
            *[F.lit(text_of(row[k])).alias(k) for k in ("grade_values", "subject_values", "form_values")],
            F.lit(text_of(row["subject"])).alias("location_subject"))
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no bookmap locations")
    return out


def bookmap_item_lists(bookmaps: DataFrame) -> DataFrame:
    """Per subject, grade and form: released multiple-choice items, items not
    released, and the highest item number (operational items)."""
    position = to_number("`item position`").try_cast("int")
    operational = F.upper(F.trim("role")) == "OPERATIONAL"
    released = F.upper(F.trim("`tagged for release`")).isin("Y", "YES", "1", "TRUE", "X")
    choice = F.upper(F.trim("`item format`")) == "MC"
    return bookmaps.groupBy("subject_values", "grade_values", "form_values").agg(
        F.array_sort(F.collect_set(F.when(operational & choice & released, position))).alias("mc_released"),
        F.array_sort(F.collect_set(F.when(operational & ~F.coalesce(released, F.lit(False)), position))).alias("not_released"),
        F.max(position).alias("max_item"))
