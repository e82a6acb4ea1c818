"""From typed intake rows to checked tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.longitudinal import longitudinal_compare
from ..operators.predicates import conditional_update, lookup_update, split_by_flag
from ..operators.quality import (
    MissingReferences,
    conflicting_records,
    discrepancy_report,
    id_check,
    missing_reference_report,
)
from ..operators.scoring import ConversionResult, RescoreResult, rescore_check, score_conversion_check
from ..operators.stats import count_failures
from ..operators.windows import nodupkey

HOME_SCHOOL = "999999"


class CorrectedIntake(NamedTuple):
    intake: DataFrame
    discrepancies: DataFrame
    conflicts: DataFrame
    missing: MissingReferences
    home_districts: DataFrame


def correct_intake(preqc: DataFrame, master: DataFrame, subjects: Sequence[str] = ("r", "m", "w", "s", "c"),
                   order: Sequence[str] = ("dcrxid_c",), width: int = 30) -> CorrectedIntake:
    """Master list corrections, reports and breach flags."""
    unique = nodupkey(master, ["bcrxid_c"], list(order))
    rows = lookup_update(preqc.withColumn("dcxx_county", F.lit("")), unique, {"bcrxid_attend": "bcrxid_c"},
                         {"dcxx_county": F.coalesce(F.substring("m_dcxx_county", 1, width), F.lit(""))})
    empty = F.lit("")
    home_fixes = [
        ("dcrxid_home = dcrxid_attend", {"dcrxid_home": empty, "bcrxid_home": empty}),
        ("bcrxid_attend = bcrxid_home", {"bcrxid_home": empty}),
        ("dcrxid_home = bcrxid_attend", {"dcrxid_home": empty, "bcrxid_home": empty, "dcrxnm_home": empty, "bcrxnm_home": empty}),
    ]
    rows = conditional_update(rows, [
        *home_fixes,
        (F.col("bcrxid_attend") == HOME_SCHOOL, {"bcrxnm_attend": F.lit("Home School"), "schtype_attend": F.lit("H")}),
    ])
    rows, discrepancies = discrepancy_report(rows, master, order, width)
    rows = conditional_update(rows, [("dcrxid_home = 'BBBBBB' AND schtype_attend = 'J'", {"dcrxid_home": empty})])
    conflicts = conflicting_records(rows.drop("Reason"))
    moved = (F.col("schtype_attend") == "N") & ~F.col("bcrxid_attend").eqNullSafe(F.col("dcrxid_attend"))
    # All targets are read before any is written: one projection.
    rows = rows.withColumns({
        "dcrxid_home": F.when(moved, F.col("dcrxid_attend")).otherwise(F.col("dcrxid_home")),
        "dcrxid_attend": F.when(moved, F.col("bcrxid_attend")).otherwise(F.col("dcrxid_attend")),
        "dcrxnm_attend": F.when(moved, F.col("bcrxnm_attend")).otherwise(F.col("dcrxnm_attend")),
        "distrtype_attend": F.when(moved, F.lit("N")).otherwise(F.col("distrtype_attend")),
    })
    rows = conditional_update(rows, [(F.col("schtype_attend") == "D", {"dcxx_county": F.col("dcrxnm_attend")})])
    missing = missing_reference_report(rows, master, order, HOME_SCHOOL)
    breach = {}
    for s in subjects:
        broken = F.coalesce(F.col(f"uc{s}x_form") == "BR", F.lit(False))
        breach[f"form_{s}"] = F.when(broken, "B").otherwise("A")
        breach[f"uf{s}x_breach"] = broken.cast("int")
    rows = rows.withColumns(breach)
    rows = conditional_update(rows, [
        home_fixes[0], home_fixes[1], (F.col("schtype_attend") == "Y", {"dcrxid_home": empty}), home_fixes[2]])
    districts = nodupkey(master, ["dcrxid_c"], ["dcrxnm", "distrtype"])
    other_name = ~F.lower("dcrxnm_attend").eqNullSafe(F.substring(F.lower("m_dcrxnm"), 1, width))
    rows = lookup_update(rows, districts, {"dcrxid_attend": "dcrxid_c"},
                         {"distrtype_attend": F.col("m_distrtype"), "dcrxnm_attend": F.substring("m_dcrxnm", 1, width)},
                         (F.col("schtype_attend") == "H") & other_name)
    rows = conditional_update(rows, [
        (~F.coalesce(F.col("ethnicity").isin("1", "2", "3", "4", "5", "6"), F.lit(True)), {"ethnicity": F.lit("7")})])
    rows = rows.drop("Reason")
    here = rows.select("id", "dcrxid_attend", "dcrxnm_attend", "distrtype_attend")
    at_home = rows.where(F.trim("dcrxid_home") != "").select(
        "id", F.col("dcrxid_home").alias("dcrxid_attend"), F.col("dcrxnm_home").alias("dcrxnm_attend"),
        F.col("distrtype_home").alias("distrtype_attend"))
    home = here.unionByName(at_home).withColumn("dcrxnm_attend", F.trim(F.lower("dcrxnm_attend")))
    return CorrectedIntake(rows, discrepancies, conflicts, missing, home)


class IntakeResult(NamedTuple):
    corrected: CorrectedIntake
    id_failures: DataFrame | None
    failure_counts: DataFrame | None
    district_failures: DataFrame | None
    bad_schools: DataFrame | None
    longitudinal: DataFrame | None
    rescore: dict[tuple[str, str], RescoreResult]
    conversion: dict[tuple[str, str], ConversionResult]


def intake_pipeline(preqc: DataFrame, master: DataFrame, id_sheet=None, earlier: DataFrame | None = None,
                    compare_sheet=None, item_tables: Mapping[str, DataFrame] | None = None,
                    answer_keys: Mapping[str, DataFrame] | None = None,
                    conversions: Mapping[str, tuple[DataFrame, Mapping]] | None = None,
                    subjects: Sequence[str] = ("r", "m", "w", "s", "c"), order: Sequence[str] = ("dcrxid_c",)) -> IntakeResult:
    """Corrections, then every check as an independent lazy output.

    Rescore and conversion run per subject, apart for breach and regular forms.
    """
    corrected = correct_intake(preqc, master, subjects, order)
    rows = corrected.intake
    failures = counts = districts = bad_schools = None
    if id_sheet is not None:
        failures = id_check(rows, id_sheet)
        counts = count_failures(failures)
        names = rows.select("id", "dcrxnm_attend", "dcrxnm_home")
        districts = failures.where(F.col("bad_variable").isin("dcrxid_attend", "dcrxid_home")).join(names, "id", "left")
        bad_schools = failures.where(F.col("bad_variable") == "bcrxid_attend").select(F.col("bad_value").alias("bcrxid")).distinct()
    longitudinal = longitudinal_compare(earlier, rows, compare_sheet) if compare_sheet is not None else None
    rescored, converted = {}, {}
    for s in subjects:
        breach, regular = split_by_flag(rows, F.col(f"uf{s}x_breach") == 1)
        for kind, part in (("breach", breach), ("regular", regular)):
            if item_tables and answer_keys and s in item_tables and s in answer_keys:
                form = part.select(F.col("id").alias("flat_table_id"), F.col(f"form_{s}").alias("form_id"))
                items = item_tables[s].join(form, "flat_table_id").select(
                    F.col("flat_table_id").alias("test_id"), "form_id", F.col("id").alias("item_id"),
                    F.col(f"up{s}x_finalraw_item").alias("finalraw_item"), F.col(f"up{s}x_score_item").alias("score_item"))
                rescored[(s, kind)] = rescore_check(items, answer_keys[s])
            if conversions and s in conversions:
                table, variables = conversions[s]
                converted[(s, kind)] = score_conversion_check(part, table, variables)
    return IntakeResult(corrected, failures, counts, districts, bad_schools, longitudinal, rescored, converted)
