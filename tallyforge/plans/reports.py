"""Tables for the report writer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import sentinel_to_null
from ..operators.stats import list_distinct
from ..operators.windows import number_in_group

INTERVENTION_TYPES = ("J", "D", "Y")


def _recoded(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "grade_recoded": sentinel_to_null(F.col("grade").cast("string"), "99"),
        "grade_r_recoded": sentinel_to_null(F.col("rgrade").cast("string"), "99"),
        "sorting_grade": F.col("grade"),
    })


def report_tables(district: DataFrame, state: DataFrame, school: DataFrame, school_intervention: DataFrame,
                  student: DataFrame, subjects: Sequence[str] = ("r", "m", "w", "s", "c"),
                  intervention_types: Sequence[str] = INTERVENTION_TYPES) -> dict[str, DataFrame]:
    """All report tables by name; each is lazy, and no job runs before one is read.

    Schools are numbered in their district by a window: a district has as many rows as schools and grades.
    """
    from_district = F.substring("g_dcrxid", 4, 6)
    kinds = list(intervention_types)
    names = list_distinct([district, student], ["dcrxid", "dcrxnm"])
    pages = number_in_group(_recoded(school), ["g_dcrxid"], [F.col(c) for c in ("g_bcrxid", "bcrxid", "schtype", "rgrade", "bcrxnm")],
                            "count", "reportnum", group_rows_limit=None)
    page_text = F.lpad(F.col("reportnum").cast("string"), 2, "0")
    pages = pages.withColumns({
        "reportnum_s": page_text, "g_dcrxid_n": F.concat_ws("_", F.trim("g_dcrxid"), page_text), "dcrxid": from_district})
    schools = _recoded(school).withColumn("dcrxid", from_district)
    intervention = school_intervention.withColumn("dcrxid_recoded", F.col("dcrxid_attend"))
    all_districts = district.select("dcrxid").distinct().withColumn("mergeid", F.col("dcrxid"))
    home_schooled = student.where(F.col("schtype") == "H").select("dcrxid").distinct().withColumn("mergeid", F.lit(" "))
    students = _recoded(student).withColumns({
        **{f"uf{s}x_breach_recoded": sentinel_to_null(F.col(f"uf{s}x_breach").cast("int"), 1)
           for s in subjects if f"uf{s}x_breach" in student.columns},
        "labelid": F.concat("dcrxid", "bcrxid"), "latebatchflag": F.lit(0),
    })
    elsewhere = (
        (F.col("dcrxid") != F.col("dcrxid_home")) & (F.trim("dcrxid_home") != "") & (F.col("schtype") != "Y"))
    elsewhere = F.coalesce(elsewhere, F.lit(False))
    home = students.withColumns({
        "g_dcrxid": F.when(elsewhere, F.concat_ws("_", F.col("sorting_grade").cast("string"), "dcrxid_home")).otherwise(F.col("g_dcrxid")),
        "dcrxnm": F.col("dcrxnm_home"),
        "dcrxid": F.when(elsewhere, F.col("dcrxid_home")).otherwise(F.col("dcrxid")),
    })
    return {
        "districtnames": names, "state": _recoded(state), "school_repnum": pages, "school": schools,
        "school_intervention": intervention,
        "school_intervention_jd": intervention.where(F.col("schtype").isin(kinds)),
        "alldistricts": all_districts,
        "all_districts": home_schooled.unionByName(all_districts).distinct(),
        "allschools": schools.select("dcrxid", "bcrxid").distinct(),
        "allschools_jd": school.where(F.col("schtype").isin(kinds)).select("bcrxid", "schtype").distinct(),
        "district": _recoded(district), "student": students, "studenthomedistrict": home,
    }
