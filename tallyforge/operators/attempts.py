"""Attempt flags and priorities ahead of a complementary merge."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import compose_date
from ..functions.numbers import to_number
from ..functions.text import to_proper_case
from ..session import maybe_broadcast


def operational_items(bookmap: DataFrame, subject: str, grade=None, forms=None) -> DataFrame:
    """(position, form, format) of the operational items of a subject."""
    rows = bookmap.where(
        (F.upper(F.trim("subject_values")) == subject.upper())
        & (F.upper(F.trim("role")) == "OPERATIONAL")
        & F.col("`item position`").isNotNull())
    if grade is not None:
        rows = rows.where(F.col("grade_values").cast("string") == str(grade))
    if forms is not None:
        rows = rows.where(F.col("form_values").isin(list(forms)))
    return rows.select(
        F.col("`item position`").cast("int").alias("_position"), F.col("form_values").alias("_form"),
        F.upper(F.trim("`item format`")).alias("_format"))


def answered(format_: Column, answer: Column, final: Column) -> Column:
    """Multiple choice answered, or an open-ended score other than A, B, blank."""
    choice = (format_ == "MC") & answer.isNotNull() & ~answer.isin("", "-")
    open_ended = (format_ != "MC") & final.isNotNull() & ~final.isin("A", "B", "")
    return F.coalesce(choice | open_ended, F.lit(False))


def derive_attempt_flags(flat: DataFrame, items: Mapping[str, DataFrame], bookmap: DataFrame, grade=None,
                         forms=("A", "B"), name_columns=("ucrxfnm", "ucrxlnm"), roman_limit: int = 10) -> DataFrame:
    """Adds dob, gender, attempt_<subject> and variable_priority.

    A subject is attempted when any operational item was answered and the
    record is not invalid in it.  Items are reduced to one flag per record
    before they meet the flat table.
    """
    out = flat
    for subject, frame in items.items():
        keys = maybe_broadcast(operational_items(bookmap, subject, grade, forms).select("_position", "_format").distinct())
        raw, final = F.col(f"up{subject}x_raw_item"), F.col(f"up{subject}x_oe_final")
        flags = (
            frame.select(F.col("flat_table_id").alias("_fid"), F.col("id").cast("int").alias("_position"),
                         F.rtrim(raw.cast("string")).alias("_raw"), F.rtrim(final.cast("string")).alias("_final"))
            .join(keys, "_position")
            .groupBy("_fid")
            .agg(F.max(answered(F.col("_format"), F.col("_raw"), F.col("_final")).cast("int")).alias("_any"))
        )
        invalid = F.coalesce(to_number(f"uf{subject}x_invalid") == 1, F.lit(False))
        out = out.join(flags, out["id"] == flags["_fid"], "left").drop("_fid").withColumn(
            f"attempt_{subject}", F.when(invalid, 0).otherwise(F.coalesce("_any", F.lit(0)))).drop("_any")
    gender = to_number("ucrxgen")
    preid = F.coalesce(to_number("preidflag") == 1, F.lit(False))
    attempts = F.lit(0)
    for subject in items:
        attempts = attempts + F.col(f"attempt_{subject}")
    return out.withColumns({
        **{c: to_proper_case(c, roman_limit) for c in name_columns},
        "dob": compose_date("dob_year", "dob_month", "dob_day", year_range=(1801, 2100)),
        "gender": F.when(gender == 1, "1").when(gender == 2, "2").otherwise(""),
        "variable_priority": F.when(preid, 10).otherwise(0) + attempts,
    })
