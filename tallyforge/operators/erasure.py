"""Erasure analysis of scanned answer sheets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import decode_intensity, recode_levels, to_number_or_zero
from ..session import maybe_broadcast

ITEM_MEASURES = ("raw_intensity", "second_inten", "raw_editor", "second_dark", "raw_item", "score_item")
SHEET_COLUMNS = ("lithocode", "studentid", "ssid", "grade", "dcrxid_attend", "dcrxnm_attend", "bcrxid_attend",
                 "bcrxnm_attend")
# Erased items above the first, share of items from the second.
LIMITS = {"default": (9, 0.3), "writing": (4, 0.5)}


def sheet_items(sheets: DataFrame, subject: str, positions: Sequence[int], row_id: str = "lithocode") -> DataFrame:
    """Wide item columns of one subject as rows (sheet, item_position, measures)."""
    s = subject.lower()
    have = {c.lower() for c in sheets.columns}

    def cell(measure: str, n: int) -> Column:
        name = f"up{s}x_{measure}_{n}"
        value = F.col(name).cast("string") if name in have else F.lit(None).cast("string")
        return value.alias(measure)

    cells = F.array(*[
        F.struct(F.lit(n).alias("item_position"), *[cell(m, n) for m in ITEM_MEASURES]) for n in positions])
    return sheets.select(F.col(row_id).alias("sheet"), F.inline(cells))


def erasure_counts(items: DataFrame, keys: DataFrame, sheets: DataFrame) -> DataFrame:
    """Counts per (sheet, subject).

    ``items``: sheet, subject, item_position and the measures; ``keys``:
    subject, form, item_position, numeric_key of operational multiple-choice
    items; ``sheets``: sheet, subject, form.  Rules 2 and 3 may both hold for
    an item and then count twice.
    """
    raw, second = decode_intensity("raw_intensity"), decode_intensity("second_inten")
    editor, dark, answer = (to_number_or_zero(c) for c in ("raw_editor", "second_dark", "raw_item"))
    # Items that no key names go before their marks are decoded and before any shuffle.
    named = items.join(maybe_broadcast(keys.select("subject", "item_position").distinct()), ["subject", "item_position"], "left_semi")
    rows = named.select(
        "sheet", "subject", "item_position", raw.alias("raw"), second.alias("second"), (editor == 1).alias("edited"),
        dark.alias("dark"), answer.alias("answer"), to_number_or_zero("score_item").alias("score"))
    joined = rows.join(sheets.select("sheet", "subject", "form"), ["sheet", "subject"]).join(
        maybe_broadcast(keys), ["subject", "form", "item_position"])
    multi1 = (F.col("raw") > 10) & (F.col("second") > 10)
    multi2 = (F.col("raw") >= 5) & (F.col("raw") - F.col("second") < 3)
    erased = [
        (F.col("raw") >= 5) & (F.col("second") >= 3) & ~multi1 & ~multi2,
        multi1 & F.col("edited"),
        multi2 & F.col("edited"),
    ]
    times = erased[0].cast("int") + erased[1].cast("int") + erased[2].cast("int")
    key = F.col("numeric_key").cast("double")
    was_right, is_right = F.col("dark") == key, F.col("answer") == key

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("_times")).otherwise(0)).cast("bigint")

    return joined.withColumns({"_times": times, "_was": was_right, "_is": is_right}).groupBy("sheet", "subject").agg(
        F.sum("_times").cast("bigint").alias("erased"),
        total(~F.col("_was") & F.col("_is")).alias("w_r"),
        total(~F.col("_was") & ~F.col("_is")).alias("w_w"),
        total(F.col("_was") & ~F.col("_is")).alias("r_w"),
        F.sum("score").alias("raw"), F.count("*").alias("itemcount"))


def flag_erasures(counts: DataFrame, writing_subjects: Sequence[str] = ("W", "w")) -> DataFrame:
    """Sheets over the limits: erased items and the share that became right."""
    writing = F.col("subject").isin(list(writing_subjects))
    point = F.when(writing, LIMITS["writing"][0]).otherwise(LIMITS["default"][0])
    share = F.when(writing, LIMITS["writing"][1]).otherwise(LIMITS["default"][1])
    return counts.where((F.col("erased") > point) & (F.col("w_r") >= F.col("itemcount") * share))


def erasure_keys(bookmap: DataFrame) -> DataFrame:
    """Operational multiple-choice keys of a bookmap."""
    return bookmap.where(
        (F.upper(F.trim("`item format`")) == "MC") & (F.upper(F.trim("role")) == "OPERATIONAL")
    ).select(
        F.lower("subject_values").alias("subject"), F.col("form_values").alias("form"),
        F.col("`item position`").cast("int").alias("item_position"), F.col("`numeric key`").cast("double").alias("numeric_key"))


def erasure_analysis(part1: DataFrame, part2: DataFrame, bookmap: DataFrame, subjects: Sequence[str],
                     writing_subjects: Sequence[str] = ("w",)) -> DataFrame:
    """Flagged sheets of all subjects (one row per sheet and subject).

    The two vertical parts are joined on the lithocode; home-schooled sheets
    and raw codes A and I are left out.
    """
    extra = [c for c in part2.columns if c.lower() not in {x.lower() for x in part1.columns}]
    sheets = part1.join(part2.select("lithocode", *extra), "lithocode").where(F.col("schtype_attend") != "H")
    keys = erasure_keys(bookmap)
    positions = {}
    for r in keys.select("subject", "item_position").distinct().collect():
        positions.setdefault(r[0], []).append(r[1])
    out = None
    for subject in subjects:
        s = subject.lower()
        if s not in positions:
            continue
        items = sheet_items(sheets, s, sorted(positions[s])).withColumn("subject", F.lit(s))
        form = sheets.select(F.col("lithocode").alias("sheet"), F.lit(s).alias("subject"), F.col(f"form_{s}").alias("form"))
        flagged = flag_erasures(erasure_counts(items, keys, form), writing_subjects)
        about = sheets.where(~F.col(f"up{s}xraw").cast("string").isin("A", "I")).select(
            *SHEET_COLUMNS, recode_levels(f"up{s}xlev").alias("pass_fail"))
        part = about.join(flagged, about["lithocode"] == flagged["sheet"]).select(
            *SHEET_COLUMNS, "pass_fail", "subject", F.col("raw"), "erased", "w_r", "w_w", "r_w")
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no subject has operational multiple-choice items in the bookmap")
    return out.distinct()
