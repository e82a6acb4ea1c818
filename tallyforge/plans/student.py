"""Student records for reporting: derived columns, home rows and cuts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import letters_to_null, pass_flag
from ..functions.keys import composite_key, grade_or_default
from ..functions.numbers import to_number
from ..functions.text import compose_name, proper_case_words
from ..operators.predicates import drop_unattempted, split_by_flag
from ..session import checkpointed

SUBJECTS = ("r", "m", "w", "s", "c")
SPECIAL_SCHOOLS = ("000001", "000002", "000003")
ACCOMMODATIONS = ("read_aloud", "extended", "dictionary", "scribe", "other")
MISSING = ""


def split_special_schools(df: DataFrame, schools: Sequence[str] = SPECIAL_SCHOOLS) -> tuple[DataFrame, DataFrame]:
    """(special schools, all other rows)."""
    ids = list(schools)
    return split_by_flag(df, F.col("bcrxid_attend").isin(ids) | F.col("dcrxid_attend").isin(ids))


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in conditions])


def _flag(condition: Column, yes="1", no="0") -> Column:
    return F.when(F.coalesce(condition, F.lit(False)), F.lit(yes)).otherwise(F.lit(no))


def student_derivations(df: DataFrame, strands: Mapping[str, Sequence[str]], subjects: Sequence[str] = SUBJECTS,
                        nominal_columns: Sequence[str] = (), dropped_types: Sequence[str] = ("H",)) -> DataFrame:
    """All per-student report columns, generated from subject and strand lists.

    Every stage is a single projection, however many columns it makes, and
    the whole chain is one map-only stage.
    """
    rows = drop_unattempted(df, [f"uf{s}x_attempt" for s in subjects])
    name = compose_name("ucrxfnm", "studentmid", "ucrxlnm")
    parts = [to_number(c).try_cast("int") for c in ("dob_month", "dob_day", "dob_year")]
    given = parts[0].isNotNull() & parts[1].isNotNull() & parts[2].isNotNull()
    rows = rows.withColumns({
        "student_name": name,
        "birthdate": F.when(given, F.format_string("%02d/%02d/%04d", *parts)).otherwise(F.lit(MISSING)),
        "_schtype": F.col("schtype_attend"), "_distrtype": F.col("distrtype_attend"),
    })
    if nominal_columns:
        rows = letters_to_null(rows, list(nominal_columns), ("A",), MISSING)
    grade = grade_or_default("grade")
    writing = {1: "upwx_oe_final_1", 2: "upwx_oe_final_4"}
    have = {c.lower() for c in df.columns}
    no_writing = F.col("ufwx_attempt").cast("string") == "0"
    stage = {c: F.coalesce(proper_case_words(c), F.lit("")) for c in ("dcxx_county", "ucrxfnm", "ucrxlnm")}
    stage.update({
        "myid": F.col("lithocode"), "bcrxid": F.col("bcrxid_attend"), "dcrxid": F.col("dcrxid_attend"),
        "bcrxnm": F.col("bcrxnm_attend"), "dcrxnm": F.col("dcrxnm_attend"), "schtype": F.col("_schtype"),
        "distrtype": F.col("_distrtype"), "rgrade": F.col("grade"), "grade": grade, "scrxid": F.lit("1"),
        "g_dcrxid": composite_key(grade, F.trim("dcrxid_attend")), "g_bcrxid": composite_key(grade, F.trim("bcrxid_attend")),
        "g_scrxid": composite_key(grade, F.lit("1")), "dummy_record_flag": F.lit("0"),
    })
    for k, column in writing.items():
        value = F.coalesce(F.col(column), F.lit(MISSING)) if column in have else F.lit(MISSING)
        stage[f"writing_prompt{k}"] = F.when(no_writing, F.lit(MISSING)).otherwise(value)
    rows = rows.withColumns(stage).drop("_schtype", "_distrtype")

    made: dict[str, Column] = {}
    valid, off_track, passed = [], [], []
    for s in subjects:
        lev = F.col(f"up{s}xlev").cast("string")
        attempt, invalid = F.col(f"uf{s}x_attempt").cast("string"), F.col(f"uf{s}x_invalid").cast("string")
        valid.append((attempt == "1") & (invalid == "0"))
        off_track.append(lev.isin("1", "2") | (attempt == "0") | (invalid == "1"))
        passed.append(lev.isin("3", "4", "5"))
        made[f"up{s}x_accom"] = _flag(_any([F.col(f"up{s}x_{a}").cast("string") == "1" for a in ACCOMMODATIONS]), "1", MISSING)
        made[f"up{s}xlep"] = _flag(F.col("upxxlep").cast("string") == "1")
        made[f"up{s}xiep"] = _flag(F.col("upxxiep").cast("string") == "1")
        for suffix in ("pscal", "plev", "merged"):
            made[f"up{s}x{suffix}"] = F.lit(MISSING)
        made[f"up{s}xpass"] = pass_flag(lev)
        gone = F.coalesce(lev, F.lit("")) == MISSING
        for k in range(1, 6):
            made[f"up{s}xdum{k}"] = F.when(gone, MISSING).when(lev == str(k), "100").otherwise("0")
        made[f"proforhigher{s}"] = F.when(lev.isin("3", "4", "5"), "100").when(lev.isin("1", "2"), "0").otherwise(MISSING)
        made[f"belowprof{s}"] = F.when(lev.isin("3", "4", "5"), "0").when(lev.isin("1", "2"), "100").otherwise(MISSING)
        made[f"advacc{s}"] = F.when(lev.isin("4", "5"), "100").when(lev.isin("1", "2", "3"), "0").otherwise(MISSING)
        number = lambda c: to_number(c).try_cast("int")
        made[f"inclusionflag{s}"] = _flag(
            (number(attempt) == 1) & (F.coalesce(number(invalid), F.lit(0)) != 1)
            & (F.coalesce(F.col("schtype"), F.lit("")) != "H"))
        for strand in strands.get(s, ()):
            if strand == "x":
                continue
            value = F.coalesce(F.col(f"up{s}{strand}lev").cast("string"), F.lit(""))
            missing = value == MISSING
            for k in range(4):
                hit = F.when(value == str(k), "100").otherwise("0") if k else F.lit("0")
                made[f"up{s}{strand}dum{k}"] = F.when(missing, MISSING).otherwise(hit)
            made[f"up{s}{strand}dum4"] = F.when(value.isin("2", "3"), "100").otherwise(MISSING)
    school = F.upper(F.trim(F.coalesce("schtype", F.lit(""))))
    joint = (F.upper(F.trim("distrtype")) == "J") & F.upper(F.trim("distrtype_home")).isin("N", "D")
    counted = reduce(lambda a, b: a + b, [F.coalesce(p.cast("int"), F.lit(0)) for p in passed])
    every = reduce(lambda a, b: a & b, [F.col(f"uf{s}x_attempt").cast("string") == "1" for s in subjects])
    made.update({
        "reported_flag": _flag(_any(valid)), "pass_count": counted.cast("string"),
        "ucxxpon": _flag(_any(off_track), "0", "1"),
        "stateinclusionflag": F.when(F.coalesce(joint, F.lit(False)), "0").otherwise(_flag(~school.isin("N", "H", "D"))),
        "districtinclusionflag": _flag(~school.isin("N", "H", "C", "U")),
        "attempt_all": F.coalesce(every, F.lit(False)).cast("int"),
    })
    out = rows.withColumns(made)
    return out.where(~F.coalesce(F.col("schtype").isin(list(dropped_types)), F.lit(False)))


def home_district_rows(df: DataFrame) -> DataFrame:
    """A second row under the home district for rows that name one.

    Rows are doubled in place, so the input is read once.
    """
    has_home = F.coalesce(F.trim("dcrxid_home") != "", F.lit(False))
    copies = F.when(has_home, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    doubled = df.withColumn("_home", F.explode(copies))

    def at_home(name: str, value: Column) -> Column:
        return F.when(F.col("_home"), value).otherwise(F.col(name))

    changed = {
        "dummy_record_flag": F.lit("1"), "stateinclusionflag": F.lit("0"), "districtinclusionflag": F.lit("1"),
        "dcrxid": F.col("dcrxid_home"), "dcrxnm": F.col("dcrxnm_home"), "distrtype": F.col("distrtype_home"),
        "g_dcrxid": composite_key(F.trim("grade"), F.trim("dcrxid_home")), "dcrxnm_attend": F.col("dcrxnm_home"),
        "bcrxid_attend": F.lit(""), "schtype": F.lit(""), "g_bcrxid": F.lit(""),
        "g_scrxid": composite_key("grade", F.trim("scrxid")),
    }
    return doubled.withColumns({k: at_home(k, v) for k, v in changed.items()}).select(*df.columns)


# The columns that make a row of each cut, and those taken from its first row.
CUT_KEYS = {
    "district": ("g_dcrxid",),
    "state": ("g_scrxid", "grade", "rgrade"),
    "school": ("g_bcrxid", "g_dcrxid", "g_scrxid", "bcrxid", "bcrxnm", "grade", "rgrade", "schtype"),
    "school_intervention": ("bcrxid_attend", "bcrxnm_attend", "dcrxid_attend", "dcrxnm_attend", "scrxid", "schtype"),
}
CUT_FIRST = {"district": ("g_scrxid", "dcrxid", "dcrxnm", "grade", "rgrade")}


def _place(df: DataFrame, name: str) -> Column | None:
    """A number of fixed width in the order of the column, unlike values possibly alike; None: the type has none.

    Text is placed by its first 14 bytes; NULL comes first.
    """
    kind, c = dict(df.dtypes)[name], F.col(name)
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return F.coalesce(c.cast("decimal(36,0)"), F.lit("-1e20").cast("decimal(36,0)"))
    if kind != "string":
        return None
    digits = F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, 14)), 28, "0")
    high, low = [F.conv(F.substring(digits, at, 14), 16, 10).cast("decimal(17,0)") for at in (1, 15)]
    return F.coalesce((high * F.lit(2 ** 56).cast("decimal(17,0)") + low).cast("decimal(36,0)"), F.lit(-1).cast("decimal(36,0)"))


def _first_of_cut(df: DataFrame, keys: Sequence[str], first: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each group by ``order``: its keys and the columns ``first``.

    Text cannot be kept in a hashed aggregate, and sorting all students for it
    would take memory in proportion to a task's rows.  So the least place of
    each group is found by hashing, and only rows at that place are compared.
    """
    rows = df.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)], F.struct(*[F.col(c).alias(c) for c in first]).alias("_first"),
                     F.struct(*order).alias("_order"), *([] if (place := _place(df, order[0])) is None else [place.alias("_place")]))
    names = [f"_k{i}" for i in range(len(keys))]
    if place is not None:
        least = rows.groupBy(*names).agg(F.min("_place").alias("_least")).select(*[F.col(k).alias(f"l{k}") for k in names], "_least")
        here = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"l{k}")) for k in names], F.col("_place") == F.col("_least"))
        rows = rows.join(least, here).select(*names, "_first", "_order")
    return rows.groupBy(*names).agg(F.min_by("_first", "_order").alias("_first")).select(
        *[F.col(k).alias(c) for k, c in zip(names, keys)], *[F.col(f"_first.{c}").alias(c) for c in first])


def cut_rows(df: DataFrame, order: Sequence[str] = ("lithocode", "dummy_record_flag")) -> DataFrame:
    """The rows of all cuts.

    A row is repeated for each cut that takes nothing but keys from it, with that
    cut's keys alone, and all are made distinct at once, hashed on the map side;
    cuts that take columns of their first row find it apart.  ``cut`` names the
    cut; columns it does not have are NULL.
    """
    in_school = (F.col("bcrxid") != "") & (F.upper(F.trim(F.coalesce("schtype", F.lit("")))) != "H")
    names = list(dict.fromkeys(c for cut, keys in CUT_KEYS.items() for c in (*keys, *CUT_FIRST.get(cut, ()))))
    kinds = dict(df.dtypes)

    def keys_of(cut: str) -> Column:
        values = [F.col(c) if c in CUT_KEYS[cut] else F.lit(None).cast(kinds[c]) for c in names]
        return F.struct(F.lit(cut).alias("cut"), *[v.alias(c) for v, c in zip(values, names)])

    distinct = [c for c in CUT_KEYS if c not in CUT_FIRST]
    everywhere, schools = [c for c in distinct if not c.startswith("school")], [c for c in distinct if c.startswith("school")]
    cuts = F.when(in_school, F.array(*map(keys_of, everywhere + schools))).otherwise(F.array(*map(keys_of, everywhere)))
    parts = [df.select(F.explode(cuts).alias("_k")).select("_k.*").distinct()]
    for cut, first in CUT_FIRST.items():
        rows = _first_of_cut(df.where(in_school) if cut.startswith("school") else df, CUT_KEYS[cut], first, order)
        parts.append(rows.select(F.lit(cut).alias("cut"), *[(F.col(c) if c in rows.columns else F.lit(None).cast(kinds[c])).alias(c) for c in names]))
    return reduce(DataFrame.unionByName, parts)


def reporting_cuts(df: DataFrame, order: Sequence[str] = ("lithocode", "dummy_record_flag"), store: bool = True) -> dict[str, DataFrame]:
    """District, state, school and intervention tables of the student rows.

    The cuts are made together and stored (they are small), so that none of
    the four reads the students again; ``store=False`` leaves all lazy.
    """
    rows = cut_rows(df, order)
    rows = checkpointed(rows) if store else rows
    return {cut: rows.where(F.col("cut") == cut).select(*keys, *CUT_FIRST.get(cut, ())) for cut, keys in CUT_KEYS.items()}
