"""Checks of scores against answer keys, conversion tables and rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import is_numeric
from ..functions.keys import median3, min3
from ..functions.numbers import to_number
from ..session import maybe_broadcast
from .attempts import operational_items
from .predicates import where_computed

MISSING_ANSWER = 99
MISSING_KEY = 98


class RescoreResult(NamedTuple):
    output: DataFrame
    report: DataFrame


def _whole_text(value: Column) -> Column:
    return to_number(value).try_cast("bigint")


def rescore_check(responses: DataFrame, key: DataFrame) -> RescoreResult:
    """Recompute multiple-choice scores from an answer key.

    ``responses``: test_id, form_id, item_id, finalraw_item, score_item;
    ``key``: form_id, item_id, numeric_key, point_value.  The report lists
    wrong scores, unknown forms, unknown items and unreadable scores.
    """
    form = F.trim(F.lower(F.col("form_id").cast("string")))
    k = key.select(
        form.alias("_form"), _whole_text(F.col("item_id")).alias("_item"),
        F.coalesce(_whole_text(F.col("numeric_key")), F.lit(MISSING_KEY)).alias("_key"),
        _whole_text(F.col("point_value")).alias("_points"), F.lit(True).alias("_known_item"))
    forms = k.select("_form").distinct().withColumn("_known_form", F.lit(True))
    raw, score = F.col("finalraw_item").cast("string"), F.col("score_item").cast("string")
    answer = F.when(raw.isin("-", "", "*"), F.lit(None)).otherwise(_whole_text(raw))
    blank_score = score.isNull() | score.isin("", "None")
    rows = responses.select(
        _whole_text(F.col("test_id")).alias("test_id"), form.alias("_form"), _whole_text(F.col("item_id")).alias("_item"),
        F.coalesce(answer, F.lit(MISSING_ANSWER)).alias("_answer"),
        F.when(blank_score, F.lit(MISSING_ANSWER)).otherwise(_whole_text(score)).alias("_score"), score.alias("_score_text"))
    joined = rows.join(maybe_broadcast(forms), "_form", "left").join(maybe_broadcast(k), ["_form", "_item"], "left")
    right = F.col("_key") == F.col("_answer")
    correct = F.when(right, F.col("_points")).otherwise(F.lit(0))
    usable = F.col("_score").isNotNull() & F.col("_known_form") & F.col("_known_item")
    wrong = usable & (F.col("_score") != correct)
    message = (
        F.when(F.col("_score").isNull(), F.concat(F.lit("score_item '"), "_score_text", F.lit("' is not a number")))
        .when(F.col("_known_form").isNull(), F.concat(F.lit("form '"), "_form", F.lit("' is not in the answer key")))
        .when(F.col("_known_item").isNull(), F.concat(
            F.lit("item "), F.col("_item").cast("string"), F.lit(" is not a multiple-choice item of form '"), "_form", F.lit("'")))
        .when(wrong, F.concat(F.lit("score = "), correct.cast("string"), F.lit(", but input shows "),
                              F.col("_score").cast("string")))
    )
    report = where_computed(joined.withColumn("message", message), F.col("message").isNotNull()).select(
        "test_id", F.col("_form").alias("form_id"), F.col("_item").alias("item_id"),
        F.when(wrong, F.col("_answer")).alias("test_answer"), F.when(wrong, F.col("_score")).alias("test_score"),
        F.when(wrong, F.col("_key")).alias("correct_answer"), F.when(wrong, correct).alias("correct_score"), "message")
    output = where_computed(joined, usable).select(
        "test_id", F.col("_form").alias("form_id"), F.col("_item").alias("item_id"),
        F.col("_answer").alias("finalraw_item"), correct.alias("score_item"))
    return RescoreResult(output, report)


class ConversionResult(NamedTuple):
    output: DataFrame
    report: DataFrame


def score_conversion_check(df: DataFrame, conversions: DataFrame, raw_variables: Mapping[str, Mapping[str, str]],
                           row_id: str = "id") -> ConversionResult:
    """Check converted scores against conversion tables.

    ``raw_variables`` maps a raw score column to {converted column:
    conversion measure}; ``conversions`` is long: raw_variable, raw_score,
    measure, value.  Raw variables are unpivoted once, so all of them take
    one lookup join.  The output has one row per (id, raw variable, column)
    with the correct value; the report lists mismatches, missing entries and
    non-numeric scores.
    """
    cells = F.array(*[
        F.struct(F.lit(raw).alias("raw_variable"), F.col(raw).cast("string").alias("raw_text"),
                 F.lit(column).alias("variable"), F.lit(measure).alias("measure"),
                 F.col(column).cast("string").alias("data_text"))
        for raw, targets in raw_variables.items() for column, measure in targets.items()])
    long = df.select(F.col(row_id).alias("id"), F.inline(cells)).withColumns({
        "raw_score": to_number("raw_text"), "data_value": to_number("data_text")})
    table = conversions.select(
        "raw_variable", F.col("raw_score").cast("double").alias("raw_score"), "measure",
        F.col("value").cast("double").alias("correct_value"), F.lit(True).alias("_known"))
    joined = long.join(maybe_broadcast(table), ["raw_variable", "raw_score", "measure"], "left")
    raw_bad, absent = F.col("raw_score").isNull(), F.col("_known").isNull()
    empty = F.col("_known").isNotNull() & F.col("correct_value").isNull()
    differs = F.col("data_value").isNull() | (F.col("data_value") != F.col("correct_value"))
    message = (
        F.when(raw_bad, F.concat(F.lit("raw score variable "), "raw_variable", F.lit(" is not a number")))
        .when(absent, F.concat(F.lit("no conversion for "), "raw_variable", F.lit(" = "), F.col("raw_score").cast("string")))
        .when(empty, F.concat(F.lit("no conversion value for "), "variable"))
        .when(differs, F.concat(F.lit("value of "), "variable", F.lit(" differs from the conversion table")))
    )
    joined = joined.withColumn("message", message)
    report = where_computed(joined, F.col("message").isNotNull()).select(
        "id", "raw_variable", "raw_text", "variable", "data_text", "correct_value", "message")
    # A raw variable that cannot be converted is one finding, not one per column.
    single = report.where(raw_bad_text(raw_variables)).dropDuplicates(["id", "raw_variable", "message"])
    report = report.where(~raw_bad_text(raw_variables)).unionByName(
        single.withColumns({"variable": F.lit(None).cast("string"), "data_text": F.lit(None).cast("string")}))
    output = joined.where(F.col("correct_value").isNotNull()).select(
        "id", "raw_variable", "raw_score", "variable", "correct_value")
    return ConversionResult(output, report)


def raw_bad_text(raw_variables) -> Column:
    return F.col("message").startswith("raw score variable") | F.col("message").startswith("no conversion for ")


def conversion_output_wide(result: ConversionResult, raw_variables: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Correct scores with one column per variable; ids with a row-level
    finding are left out, as in the reference."""
    columns = [c for t in raw_variables.values() for c in t]
    failed = result.report.where(~F.col("message").startswith("value of ")).select("id").distinct()
    wide = result.output.groupBy("id").pivot("variable", columns).agg(F.first("correct_value", ignorenulls=True))
    return wide.join(failed, "id", "left_anti")


def sum_check(df: DataFrame, parts: Sequence[str], total: str, row_id: str = "id") -> RescoreResult:
    """Strand scores must add up to the total; unreadable strands are reported."""
    numbers = [to_number(p) for p in parts]
    correct = reduce(lambda a, b: a + b, numbers)
    rows = df.select(
        F.col(row_id).alias("id"), *[F.col(p) for p in parts], F.col(total).alias("total"), correct.alias("correct_total"))
    given = to_number("total")
    bad_parts = F.concat_ws(", ", *[F.when(n.isNull(), F.lit(p)) for n, p in zip(numbers, parts)])
    message = F.when(F.col("correct_total").isNull(), F.concat(F.lit("not a number: "), bad_parts)).when(
        given.isNull() | (given != F.col("correct_total")), F.lit("total differs from the sum of its parts"))
    report = rows.withColumn("message", message).where(F.col("message").isNotNull()).select(
        "id", "total", "correct_total", "message")
    return RescoreResult(rows, report)


class AttemptResult(NamedTuple):
    mismatches: DataFrame
    detail: DataFrame


def _form_of(flat: DataFrame, subject: str) -> Column:
    return F.when(F.col(f"uc{subject}x_form") == "BR", "B").otherwise("A")


def attempt_check(flat: DataFrame, items: DataFrame, bookmap: DataFrame, subject: str,
                  threshold: int = 5) -> AttemptResult:
    """Stored attempt flags against flags computed from the item rows.

    Attempted means at least ``threshold`` answered operational items, or a
    raw score of at least that.
    """
    s = subject.lower()
    keys = maybe_broadcast(operational_items(bookmap, subject))
    records = flat.select(
        F.col("id").alias("flat_table_id"), F.col("lithocode") if "lithocode" in flat.columns else F.lit(None).alias("lithocode"),
        _form_of(flat, s).alias("_form"), F.col(f"up{s}xraw").alias("raw"),
        F.col(f"uf{s}x_attempt").cast("string").try_cast("int").alias("attempt_value"))
    answer, final = F.col(f"up{s}x_finalraw_item").cast("string"), F.col(f"up{s}x_oe_final").cast("string")
    marked = items.select(
        "flat_table_id", F.col("id").alias("item_id"), F.col("id").cast("int").alias("_position"), answer.alias("answer"),
        final.alias("oe_final"),
        F.coalesce(F.rtrim(answer).isin("1", "2", "3", "4", "*").cast("int"), F.lit(0)).alias("mc_items"),
        F.coalesce((~F.rtrim(final).isin("A", "B", "")).cast("int"), F.lit(0)).alias("oe_items"))
    joined = marked.join(records.select("flat_table_id", "_form"), "flat_table_id").join(keys, ["_position", "_form"])
    counts = joined.groupBy("flat_table_id").agg(F.sum(F.col("mc_items") + F.col("oe_items")).alias("answered"))
    raw = to_number("raw")
    found = counts.join(records, "flat_table_id").withColumn(
        "calc_attempt", F.when(F.col("answered") >= threshold, 1).when(raw >= threshold, 1).otherwise(0)
    ).where(F.col("calc_attempt") != F.col("attempt_value"))
    mismatches = found.select("flat_table_id", "calc_attempt", "attempt_value")
    detail = joined.drop("_form").join(found, "flat_table_id").select(
        "flat_table_id", "item_id", "lithocode", "raw", F.col("_form").alias("form"), "answer", "mc_items",
        "oe_final", "oe_items", F.col("_format").alias("item_format"), "attempt_value", "calc_attempt")
    return AttemptResult(mismatches, detail)


def resolved_score(rule: str) -> Column:
    """Final score by the rule set ``short``, ``writing`` or ``extended``.

    Reads the texts oe_first .. oe_reso and the numbers _first .. _reso; the
    numbers are columns, so that each score is parsed once per row.
    """
    first, second, third, resolution = (F.col(f"oe_{n}") for n in ("first", "second", "third", "reso"))
    f, s, t, e, r = (F.col(f"_{n}") for n in ("first", "second", "third", "final", "reso"))
    d12, d13, d23 = F.abs(f - s), F.abs(f - t), F.abs(s - t)
    text = lambda c: c.cast("string")
    if rule == "short":
        return (
            F.when(first == second, first).when(d12 == 1, text((f + s) / 2))
            .when(first == third, first).when(second == third, second)
            .otherwise(text(median3(f, s, e))))
    if rule == "extended":
        return (
            F.when(first == second, first).when(first == third, first).when(second == third, second)
            .when((d13 == 1) & (d23 == 1), text(median3(f, s, e)))
            .when(d12 == 1, text((f + s) / 2)).when(d13 == 1, text((f + t) / 2))
            .when(d23 == 1, text((s + t) / 2)).otherwise(resolution))
    if rule == "writing":
        smallest = F.coalesce(min3(f, s, t), F.lit(0.0))
        numeric = (
            F.when(first == second, text(f + s)).when(d12 == 1, text(f + s))
            .when(first == third, text(f + t)).when(second == third, text(s + t))
            .when((d13 == 1) & (d23 == 1) & (smallest != 0), text(t * 2))
            .when(d13 == 1, text(f + t)).when(d23 == 1, text(s + t))
            .otherwise(text(r * 2)))
        return F.when(f.isNotNull() & s.isNotNull(), numeric).otherwise(F.when(first == second, first))
    raise ValueError("rule must be short, writing or extended")


def handscore_check(flat: DataFrame, items: DataFrame, bookmap: DataFrame, subject: str, rule: str,
                    item_format: str | None = None) -> DataFrame:
    """Open-ended items whose final score is not what the readers' scores give."""
    s = subject.lower()
    wanted = item_format or ("SA" if rule == "short" else "ER")
    keys = maybe_broadcast(operational_items(bookmap, subject).where(F.col("_format") == wanted))
    score = {n: F.rtrim(F.col(f"up{s}x_oe_{n}").cast("string")) if f"up{s}x_oe_{n}" in items.columns
             else F.lit(None).cast("string") for n in ("first", "second", "third", "final", "reso")}
    rows = items.select("flat_table_id", F.col("id").alias("item_id"), F.col("id").cast("int").alias("_position"),
                        *[c.alias(f"oe_{n}") for n, c in score.items()])
    records = flat.select(
        F.col("id").alias("flat_table_id"), F.col("lithocode") if "lithocode" in flat.columns else F.lit(None).alias("lithocode"),
        _form_of(flat, s).alias("_form"))
    joined = rows.join(keys.select("_position").distinct(), "_position", "left_semi")
    joined = joined.join(records, "flat_table_id").join(keys, ["_position", "_form"])
    joined = joined.withColumns({f"_{n}": to_number(f"oe_{n}") for n in score})
    joined = joined.withColumn("_calc", resolved_score(rule)).withColumn("_number", to_number("_calc"))
    number = F.col("_number")
    shown = F.when(number.isNotNull(), F.round(number, 1).cast("decimal(6,1)").cast("string")).otherwise(F.col("_calc"))
    joined = joined.withColumn("calc_oe_final", shown)
    differs = F.when(F.col("_final").isNotNull() & number.isNotNull(), F.round("_final", 1) != F.round(number, 1)).otherwise(
        F.col("oe_final") != F.col("calc_oe_final"))
    return where_computed(joined, differs).select(
        "flat_table_id", "item_id", "lithocode", F.col("_form").alias("form"), "oe_first", "oe_second", "oe_third",
        "oe_reso", "oe_final", "calc_oe_final")


def handscore_check_short(flat, items, bookmap, subject):
    return handscore_check(flat, items, bookmap, subject, "short")


def handscore_check_writing(flat, items, bookmap, subject="w"):
    return handscore_check(flat, items, bookmap, subject, "writing")


def handscore_check_extended(flat, items, bookmap, subject):
    return handscore_check(flat, items, bookmap, subject, "extended")
