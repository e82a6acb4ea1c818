"""Checks of ids and tables, and reports against a master list."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import blank
from ..functions.numbers import to_number
from ..session import checkpointed, maybe_broadcast
from .predicates import field_type, require_columns, sheet_rows, text_of
from .skew import HOT_ROWS, hot_keys, join_on_keys
from .windows import common_columns, nodupkey


# ------------------------------------------------------------- id checks

def check_nonmissing(df: DataFrame, column: str, row_id: str) -> DataFrame:
    """Rows where the column is NULL, empty or a lone period."""
    text = F.rtrim(F.col(column).cast("string"))
    bad = text.isNull() | text.isin("", ".")
    return df.where(bad).select(
        F.lit(column).alias("bad_variable"), F.col(column).cast("string").alias("bad_value"),
        F.lit("missing ID").alias("bad_reason"), F.col(row_id).alias("id"), F.lit("").alias("bad_label"))


def check_unique_key(df: DataFrame, column: str, row_id: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every row whose value occurs at least twice."""
    rows = df.where(F.col(column).isNotNull()).select(F.col(column).alias("_k"), F.col(row_id).alias("id"))
    repeated = rows.groupBy("_k").count().where(F.col("count") >= 2).select("_k")
    hot = hot_keys(rows, ["_k"], hot_rows)
    if hot is not None:
        hot = hot.select("_k", F.col("_rows").alias("_nl"), F.lit(1).alias("_nr"))
    bad = join_on_keys(rows, repeated, ["_k"], hot, hot_rows)
    return bad.select(
        F.lit(column).alias("bad_variable"), F.col("_k").cast("string").alias("bad_value"),
        F.lit("not unique").alias("bad_reason"), "id", F.lit("").alias("bad_label"))


def check_unique_label(df: DataFrame, column: str, label: str, row_id: str) -> DataFrame:
    """One row per (value, label) of values with two or more labels.

    NULL is a label.  Rows are first reduced to their distinct pairs, with
    the smallest row id of each.
    """
    pairs = df.where(F.col(column).isNotNull()).groupBy(
        F.col(column).alias("_k"), F.col(label).alias("_l")).agg(F.min(row_id).alias("id"))
    several = pairs.groupBy("_k").count().where(F.col("count") >= 2).select("_k")
    return pairs.join(several, "_k").select(
        F.lit(column).alias("bad_variable"), F.col("_k").cast("string").alias("bad_value"),
        F.lit("bad label").alias("bad_reason"), "id", F.col("_l").cast("string").alias("bad_label"))


def id_check(df: DataFrame, sheet, row_id: str = "id") -> DataFrame:
    """All checks of an id sheet (checktype, variable, labelvariable) in one plan."""
    rows = sheet_rows(sheet)
    require_columns(rows, ("checktype", "variable"), "id check sheet")
    parts = []
    for row in rows:
        kind, variable = text_of(row["checktype"]).lower(), text_of(row["variable"])
        field_type(df, variable)
        if kind == "nonmissing":
            parts.append(check_nonmissing(df, variable, row_id))
        elif kind == "uniquekey":
            parts.append(check_unique_key(df, variable, row_id))
        elif kind == "uniquelabel":
            parts.append(check_unique_label(df, variable, text_of(row.get("labelvariable")), row_id))
        else:
            raise ValueError(f"unknown check type {row['checktype']!r}")
    return reduce(lambda a, b: a.unionByName(b), parts)


# -------------------------------------------------------- table comparison

class TableComparison(NamedTuple):
    differences: DataFrame
    only_left: DataFrame
    only_right: DataFrame
    summary: DataFrame
    schema_differences: list[tuple[str, str | None, str | None]]


def _differs(left: Column, right: Column, kind_l: T.DataType, kind_r: T.DataType, tolerance: float) -> Column:
    numeric = isinstance(kind_l, T.NumericType) and isinstance(kind_r, T.NumericType)
    if numeric:
        a, b = left.cast("double"), right.cast("double")
        size = F.greatest(F.abs(a), F.abs(b))
        far = F.when(a == b, F.lit(False)).otherwise(F.abs(a - b) / size >= F.lit(tolerance))
        return F.coalesce(far, left.isNull() != right.isNull())
    if type(kind_l) is type(kind_r) and not isinstance(kind_l, T.StringType):
        return ~left.eqNullSafe(right)
    return ~F.trim(left.cast("string")).eqNullSafe(F.trim(right.cast("string")))


def _digest(df: DataFrame, names: Sequence[str], kinds: Sequence[T.DataType | None]) -> Column:
    """128 bits of a row's compared values; rows whose digests are equal have equal values.

    A kind of None marks a column whose values must be compared whatever they
    are; text compares without outer blanks.
    """
    parts = [F.lit(0)]
    for name, kind in zip(names, kinds):
        value = F.col(name) if kind is None else F.col(name).cast(kind)
        value = F.trim(value) if isinstance(kind, T.StringType) else value
        parts += [value, value.isNull()]  # hashes pass over nulls
    return F.struct(F.xxhash64(F.lit(1), *parts), F.xxhash64(F.lit(2), *parts))


def compare_tables(left: DataFrame, right: DataFrame, keys: Sequence[str], exclude: Sequence[str] = (),
                   tolerance: float = 1e-8, testers: Mapping[str, object] | None = None,
                   detail_limit: int | None = None, store: bool = False) -> TableComparison:
    """Keyed comparison of two tables.

    Rows meet as keys and digests first; only rows of keys with unlike digests
    meet with all their values, so what is equal in both tables is never
    shuffled.  ``store`` keeps both meetings in the checkpoint folder, for
    callers that read several of the outputs.

    ``testers`` maps a column to a function ``(left, right) -> Column`` that is
    true where the values differ (equal values of one type must not).
    ``detail_limit`` caps the detail rows per column; by default all are
    returned.
    """
    sets = common_columns(left, right)
    skip = {c.lower() for c in (*keys, *exclude)}
    compared = [c for c in sets.common if c.lower() not in skip]
    names_right = {c.lower(): c for c in right.columns}
    custom = {k.lower(): v for k, v in (testers or {}).items()}
    kinds = {c: (field_type(left, c), field_type(right, c)) for c in compared}

    def digest_kind(c: str) -> T.DataType | None:
        a, b = kinds[c]
        if a == b and (c.lower() in custom or not isinstance(a, T.StringType)):
            return None
        return T.DoubleType() if isinstance(a, T.NumericType) and isinstance(b, T.NumericType) else T.StringType()

    def hashable(kind: T.DataType) -> bool:
        return not isinstance(kind, (T.MapType, T.VariantType))

    # A tester may tell apart what other types share, and maps have no digest: such columns are compared for every row.
    digests = [c for c in compared if kinds[c][0] == kinds[c][1] or c.lower() not in custom]
    every = len(digests) < len(compared) or not all(hashable(k) for c in compared for k in kinds[c])
    k = [f"_k{i}" for i in range(len(keys))]

    def side(df: DataFrame, tag: str, names: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
        own = [F.col(names[key.lower()]).alias(n) for key, n in zip(keys, k)]
        columns = [names[c.lower()] for c in compared]
        digest = F.lit(tag) if every else _digest(df, columns, [digest_kind(c) for c in compared])
        return (df.select(*own, digest.alias(f"_{tag}"), F.lit(True).alias(f"_in_{tag}")),
                df.select(*own, *[F.col(c).alias(f"{tag}_{n}") for c, n in zip(columns, compared)]))

    (l, l_wide), (r, r_wide) = side(left, "l", {c.lower(): c for c in left.columns}), side(right, "r", names_right)
    met = l.join(r, k, "full_outer")
    met = checkpointed(met) if store else met
    both = F.col("_in_l").isNotNull() & F.col("_in_r").isNotNull()
    unlike = met.where(both & (F.lit(True) if every else ~F.col("_l").eqNullSafe(F.col("_r")))).select(*k).distinct()
    flags = []
    for c in compared:
        a, b = F.col(f"l_{c}"), F.col(f"r_{c}")
        rule = custom.get(c.lower())
        differs = rule(a, b) if rule else _differs(a, b, *kinds[c], tolerance)
        flags.append(F.when(differs, F.struct(
            F.lit(c).alias("variable"), a.cast("string").alias("left_value"), b.cast("string").alias("right_value"))))
    wide = l_wide.join(unlike, k, "left_semi").join(r_wide.join(unlike, k, "left_semi"), k)
    wide = wide.select(*[F.col(n).alias(key) for n, key in zip(k, keys)], F.filter(F.array(*flags), lambda x: x.isNotNull()).alias("_bad"))
    wide = checkpointed(wide.where(F.size("_bad") > 0)) if store else wide
    differences = wide.select(*keys, F.inline("_bad"))
    if detail_limit is not None:
        from .windows import worst_n_per_report

        differences = worst_n_per_report(
            differences.withColumn("_one", F.lit(1)), ["variable"], "_one", detail_limit, keys).drop("_one")
    summary = met.agg(
        F.count("_in_l").alias("rows_left"), F.count("_in_r").alias("rows_right"),
        F.count(F.when(both, 1)).alias("rows_matched"),
        F.count(F.when(F.col("_in_r").isNull(), 1)).alias("rows_only_left"),
        F.count(F.when(F.col("_in_l").isNull(), 1)).alias("rows_only_right")).withColumn("_one", F.lit(1)).join(
        wide.agg(F.count(F.when(F.size("_bad") > 0, 1)).alias("rows_unequal"), F.coalesce(F.sum(F.size("_bad")), F.lit(0)).alias("values_unequal"))
        .withColumn("_one", F.lit(1)), "_one").drop("_one")  # one row each
    types_l = {f.name.lower(): f.dataType.simpleString() for f in left.schema.fields}
    types_r = {f.name.lower(): f.dataType.simpleString() for f in right.schema.fields}
    schema = [(c, types_l.get(c), types_r.get(c)) for c in dict.fromkeys([*types_l, *types_r])
              if types_l.get(c) != types_r.get(c)]
    named = [F.col(n).alias(key) for n, key in zip(k, keys)]
    return TableComparison(
        differences, met.where(F.col("_in_r").isNull()).select(*named),
        met.where(F.col("_in_l").isNull()).select(*named), summary, schema)


def differs_as_integer(left: Column, right: Column) -> Column:
    """Values differ after rounding to whole numbers."""
    return ~F.round(to_number(left), 0).eqNullSafe(F.round(to_number(right), 0))


def differs_as_mixed(left: Column, right: Column) -> Column:
    """Numbers compare as numbers, everything else as trimmed text."""
    a, b = left.cast("string"), right.cast("string")
    x, y = to_number(a), to_number(b)
    same = F.when(x.isNotNull() & y.isNotNull(), x == y).otherwise(
        F.coalesce(F.trim(a), F.lit("")) == F.coalesce(F.trim(b), F.lit("")))
    return ~same


def differs_truncated(length: int):
    """Values differ within their first ``length`` characters."""

    def test(left: Column, right: Column) -> Column:
        a = F.rtrim(F.substring(F.coalesce(left.cast("string"), F.lit("")), 1, length))
        b = F.rtrim(F.substring(F.coalesce(right.cast("string"), F.lit("")), 1, length))
        return a != b

    return test


def compare_to_specimen(df: DataFrame, specimen: DataFrame, keys: Sequence[str],
                        testers: Mapping[str, object] | None = None, exclude: Sequence[str] = (),
                        tolerance: float = 1e-8) -> TableComparison:
    """Comparison with an expected table, column by column testers."""
    return compare_tables(df, specimen, keys, exclude, tolerance, testers)


# ------------------------------------------------------ master list reports

DISCREPANCIES = ("DistrictID", "DistrictName", "SchoolName", "SchoolType", "DistrictType")


def _master(master: DataFrame, order: Sequence) -> DataFrame:
    unique = nodupkey(master, ["bcrxid_c"], order)
    return unique.select(*[F.col(c).alias(f"m_{c}") for c in
                           ("bcrxid_c", "bcrxnm", "dcrxid_c", "dcrxnm", "schtype", "distrtype", "dcxx_county")])


def discrepancy_report(df: DataFrame, master: DataFrame, order: Sequence = ("dcrxid_c",),
                       width: int = 30) -> tuple[DataFrame, DataFrame]:
    """(corrected rows with a Reason column, report).

    The reasons of a row are joined by ``*``; corrections follow them.  The
    report has one row per school and reason.
    """
    joined = df.join(maybe_broadcast(_master(master, order)), F.col("bcrxid_attend") == F.col("m_bcrxid_c"), "left")
    known = F.col("m_bcrxid_c").isNotNull()

    def unlike(a: Column, b: Column) -> Column:
        return known & ~a.eqNullSafe(b)

    cut = lambda c: F.substring(c, 1, width)
    move_home = (
        known & (F.rtrim("bcrxid_home") == "") & ~F.col("dcrxid_attend").eqNullSafe(F.col("m_dcrxid_c"))
        & ~F.col("dcrxid_attend").eqNullSafe(F.col("bcrxid_attend")))
    joined = joined.withColumn("dcrxid_home", F.when(move_home, F.col("dcrxid_attend")).otherwise(F.col("dcrxid_home")))
    tests = [
        unlike(F.col("dcrxid_attend"), F.col("m_dcrxid_c")),
        unlike(cut(F.lower("dcrxnm_attend")), cut(F.lower("m_dcrxnm"))),
        unlike(F.lower("bcrxnm_attend"), cut(F.lower("m_bcrxnm"))),
        unlike(F.lower("schtype_attend"), F.lower("m_schtype")),
        unlike(F.lower("distrtype_attend"), F.lower("m_distrtype")),
    ]
    # The first reason stands alone; later ones are appended with a star.
    parts = [F.when(tests[0], F.lit(DISCREPANCIES[0])).otherwise(F.lit(""))]
    parts += [F.when(t, F.lit("*" + n)).otherwise(F.lit("")) for t, n in zip(tests[1:], DISCREPANCIES[1:])]
    joined = joined.withColumn("Reason", F.concat(*parts))
    report = joined.where(F.col("Reason") != "").groupBy("bcrxid_attend", "Reason").agg(
        F.min(F.struct("dcrxid_attend", "m_bcrxid_c", "m_dcrxid_c", "schtype_attend", "bcrxnm_attend",
                       "dcrxnm_attend")).alias("r"))
    report = report.select(
        "Reason", F.col("r.m_bcrxid_c").alias("bcrxid_c"), F.col("r.m_dcrxid_c").alias("dcrxid_c"),
        F.col("r.schtype_attend"), F.col("r.bcrxnm_attend"), "bcrxid_attend", F.col("r.dcrxid_attend"),
        F.col("r.dcrxnm_attend"))
    has = lambda n: F.col("Reason").contains(n)
    corrected = joined.withColumns({
        "dcrxid_attend": F.when(known & has("DistrictID"), F.substring("m_dcrxid_c", 1, 10)).otherwise(F.col("dcrxid_attend")),
        "dcrxnm_attend": F.when(known, cut("m_dcrxnm")).otherwise(F.col("dcrxnm_attend")),
        "bcrxnm_attend": F.when(known, cut("m_bcrxnm")).otherwise(F.col("bcrxnm_attend")),
        "schtype_attend": F.when(known & has("SchoolType"), F.col("m_schtype")).otherwise(F.col("schtype_attend")),
        "distrtype_attend": F.when(known & has("DistrictType"), F.col("m_distrtype")).otherwise(F.col("distrtype_attend")),
    })
    return corrected.select(*df.columns, "Reason"), report


def conflicting_records(df: DataFrame) -> DataFrame:
    """Vocational schools equal to their district or without home district,
    and type N schools whose district id differs, with the reason."""
    school, district = F.col("bcrxid_attend"), F.col("dcrxid_attend")
    no_home = F.rtrim("dcrxid_home") == ""
    vocational = F.col("schtype_attend") == "J"
    same_id = (school == district) & vocational
    reason = F.when(no_home & vocational, "Missing dcrxid_home").when(
        same_id, "DCRXID=BCRXID for JVS schools").otherwise("")
    first = F.struct(reason.alias("Reason"), F.when(reason != "", "Not Fixed").otherwise("").alias("Resolution"))
    second = F.struct(F.lit("School type N has bcrxid <> dcrxid").alias("Reason"), F.lit("Fixed").alias("Resolution"))
    found = F.array(
        F.when(same_id | no_home, first),
        F.when((F.col("schtype_attend") == "N") & (school != district), second))
    return df.select(*df.columns, F.inline(F.filter(found, lambda x: x.isNotNull())))


class MissingReferences(NamedTuple):
    missing_from_master: DataFrame
    missing_county: DataFrame
    diocese_mismatch: DataFrame


def missing_reference_report(df: DataFrame, master: DataFrame, order: Sequence = ("dcrxid_c",),
                             home_school: str = "999999") -> MissingReferences:
    """Schools missing from the master list, districts without county, and
    diocese types that differ from the master list."""
    dim = maybe_broadcast(_master(master, order))
    columns = ["schtype_attend", "lithocode", "ssid", "bcrxnm_attend", "bcrxid_attend", "dcrxid_attend", "dcrxnm_attend"]
    have = [c for c in columns if c in df.columns]
    absent = df.join(dim, F.col("bcrxid_attend") == F.col("m_bcrxid_c"), "left_anti").select(*have)
    first = [F.col(c) for c in have if c != "bcrxid_attend"]
    county = df.where(blank("dcxx_county") & (F.col("bcrxid_attend") != home_school)).select(
        "bcrxnm_attend", "bcrxid_attend", "dcrxid_attend", "dcxx_county", "dcrxnm_attend", "schtype_attend")
    typed = df.join(dim, F.col("bcrxid_attend") == F.col("m_bcrxid_c"), "left")
    mismatch = typed.where(
        ((F.col("schtype_attend") == "D") & (F.col("m_schtype") != "D"))
        | ((F.col("m_schtype") == "D") & (F.col("schtype_attend") != "D"))
    ).select("bcrxid_attend", "bcrxnm_attend", "schtype_attend")
    return MissingReferences(
        nodupkey(absent, ["bcrxid_attend"], first),
        nodupkey(county, ["dcrxid_attend"], [F.col("bcrxid_attend"), F.col("bcrxnm_attend"), F.col("schtype_attend")]),
        mismatch)
