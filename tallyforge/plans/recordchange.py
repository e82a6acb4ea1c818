"""Record changes: registration extract against the score file."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import blank
from ..operators.merge import MergeResult, MergeSpec, attach_dimension, keyed_merge, missing_from_dimension
from ..operators.predicates import conditional_update, lookup_update, split_by_flag
from ..operators.windows import nodupkey, union_all
from ..sources.export import fixed_width_line

HOME_SCHOOL = "999999"


class RecordChange(NamedTuple):
    final: DataFrame
    merge: MergeResult
    unknown_ids: DataFrame | None
    lines: DataFrame | None


def clean_registration(df: DataFrame) -> DataFrame:
    """Codes, home columns and missing values of the registration extract."""
    empty = F.lit("")
    same = {"dcrxid_home": empty, "bcrxid_home": empty, "dcrxnm_home": empty, "bcrxnm_home": empty}
    rows = conditional_update(df, [
        ("ucrxgen = 'F'", {"ucrxgen": F.lit("1")}), ("ucrxgen = 'M'", {"ucrxgen": F.lit("2")}),
        ("ucrxgen = '0'", {"migrant": empty}),
        ("dcrxid_home = dcrxid_attend", same),
        ("bcrxid_attend = bcrxid_home", {"bcrxid_home": empty, "bcrxnm_home": empty}),
        ("dcrxid_home = bcrxid_attend", same),
    ])
    return rows.withColumns({
        c: F.nullif(F.col(c), F.lit(".")) for c in ("grade", "dob_day", "dob_month", "dob_year") if c in df.columns})


def record_change_pipeline(scores: DataFrame, registration: DataFrame, master: DataFrame, spec: MergeSpec, score_id: str,
                           registration_id: str, district_map: Mapping[str, str] | None = None,
                           id_column: str | None = None, layout=None, order: Sequence[Column | str] = ("ssid", "lithocode"),
                           zero_padded: Sequence[str] = ("grade", "dob_day", "dob_month", "dob_year"),
                           thresholds: float = 0.8, width: int = 30) -> RecordChange:
    """Merge, complete from the master list, and write fixed-width lines.

    ``district_map`` replaces merged home districts; ids of ``id_column`` not
    found in the registration are blanked and returned.
    """
    clean = clean_registration(registration)
    merged = keyed_merge(scores, clean, score_id, registration_id, spec.required, spec.optional, spec.fuzzy,
                         thresholds, spec.fields, "I", allow_dups_both=False, store=True)
    rows = union_all([merged.output.drop("fk_left", "fk_right"), merged.left_remainder.drop("fk_left", "merge_report")])
    if district_map:
        table = F.create_map(*[F.lit(x) for pair in district_map.items() for x in pair])
        rows = rows.withColumn("dcrxid_home", F.coalesce(F.try_element_at(table, F.col("dcrxid_home")), F.col("dcrxid_home")))
    rows = conditional_update(rows, [("dcrxid_home = 'BBBBBB'", {"dcrxid_home": F.lit("")})])
    rows = rows.drop("dcrxnm_home", "distrtype_home", "bcrxnm_home", "schtype_home")
    rows = attach_dimension(rows, master, {"dcrxid_home": "dcrxid_c"}, {"dcrxnm_home": "dcrxnm", "distrtype_home": "distrtype"},
                            ["bcrxid_c"], {"dcxx_county": "dcxx_county"})
    rows = attach_dimension(rows, master, {"bcrxid_home": "bcrxid_c"}, {"bcrxnm_home": "bcrxnm", "schtype_home": "schtype"},
                            ["dcrxid_c"])
    home_school, others = split_by_flag(rows, F.col("bcrxid_attend") == HOME_SCHOOL)
    others = attach_dimension(others, master, {"bcrxid_attend": "bcrxid_c", "dcrxid_attend": "dcrxid_c"},
                              {"dcrxnm_attend": "dcrxnm", "bcrxnm_attend": "bcrxnm"}, ["schtype"])
    home_school = attach_dimension(home_school, master, {"dcrxid_attend": "dcrxid_c"}, {"dcrxnm_attend": "dcrxnm"}, ["bcrxid_c"])
    final = union_all([others, home_school])
    county = nodupkey(master, ["dcrxid_c"], ["bcrxid_c"])
    final = lookup_update(final, county, {"dcrxid_attend": "dcrxid_c"}, {"dcxx_county": F.substring("m_dcxx_county", 1, width)})
    unknown = lines = None
    if id_column:
        present = final.where(~blank(id_column))
        unknown = missing_from_dimension(present, registration, {id_column: id_column}).select(F.trim(id_column).alias(id_column)).distinct()
        known = registration.select(F.col(id_column).alias("_known")).distinct()
        checked = final.join(known, F.col(id_column) == F.col("_known"), "left")
        final = checked.withColumn(id_column, F.when(F.col("_known").isNotNull() | F.col(id_column).isNull(), F.col(id_column))
                                   .otherwise(F.lit(""))).drop("_known")
    if layout is not None:
        out = conditional_update(final, [
            ("ucrxgen = '1'", {"ucrxgen": F.lit("F")}), ("ucrxgen = '2'", {"ucrxgen": F.lit("M")}),
            ("studentmid = '*'", {"studentmid": F.lit("")})])
        # Spark orders text by its bytes, which is the order the file needs.
        ordered = out.where(F.coalesce(F.col("schtype_attend") != "H", F.lit(True))).orderBy(*order)
        lines = ordered.select(fixed_width_line(layout, zero_padded).alias("value"))
    return RecordChange(final, merged, unknown, lines)
