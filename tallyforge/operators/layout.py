"""Layout checks, value checks, typing, recoding and item rows."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import to_number
from ..session import maybe_broadcast
from .predicates import field_type, sheet_rows, text_of
from .skew import carried_forward, next_value

# Columns and types of a layout sheet, the longest name, and the form of a numeric code.
REQUIRED_COLUMNS = ("start", "end", "type", "min", "max", "nominal_values", "std_code", "variable_name",
                    "description", "comments", "counts_needed")
LAYOUT_TYPES = r"(?i)^(INTEGER|STRING|REAL|NOMINAL|NOMINAL_N|ID[0-9]|NOMINAL_ID[0-9])$"
MAX_NAME = 28
NUMERIC_CODE = r"^(-?\d+(\.\d*)?|\.[A-Z]?)$"


def check_layout(layout: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Rule violations of a layout table: (rule, import_order, variable_name, detail).

    A missing required column is an exception.  Continuation rows (blank
    start) hold further codes of the variable above them.
    """
    have = {c.lower() for c in layout.columns}
    absent = [c for c in required if c not in have]
    if absent:
        raise ValueError(f"layout lacks required columns: {', '.join(absent)}")
    text = {c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit("")))
            for c in ("start", "end", "type", "nominal_values", "comments", "variable_name", "std_code")}
    start, end = to_number(text["start"]), to_number(text["end"])
    name = text["variable_name"]
    rows = layout.select(
        F.col("import_order").cast("bigint").alias("import_order"), name.alias("variable_name"),
        text["start"].alias("start_text"), start.alias("start"), end.alias("end"), text["type"].alias("type"),
        text["nominal_values"].alias("nominal"), text["comments"].alias("comments"), text["std_code"].alias("code"))
    named = F.col("variable_name") != ""
    rows = rows.withColumn("_own", F.nullif("type", F.lit("")))
    rows = carried_forward(rows, "_own", ["import_order"], "_vartype").withColumn("_vartype", F.lower("_vartype"))
    # Names are counted without the rows that have none, and a repeated name's rows are found by its count.
    repeated = layout.select(name.alias("variable_name")).where(named).groupBy(F.col("variable_name").alias("_key")).agg(
        F.count("*").alias("_dups")).where("_dups > 1")
    key = F.when(named, F.col("variable_name")).otherwise(F.concat(F.lit("\n"), F.col("import_order").cast("string")))
    rows = rows.withColumn("_key", key).join(maybe_broadcast(repeated), "_key", "left").drop("_key")
    has_start = F.col("start").isNotNull()
    numeric = (F.col("_vartype").isin("integer", "real") | F.col("_vartype").startswith("id")) & (F.col("type") == "")
    bad_code = ~F.col("code").rlike(NUMERIC_CODE) & (F.col("code") != "")
    tests = [
        ("blank row", (F.col("start_text") == "") & (F.col("nominal") == "") & (F.col("comments") == ""), F.lit("")),
        ("name has a space", named & F.col("variable_name").contains(" "), F.col("variable_name")),
        ("name too long", named & (F.length("variable_name") > MAX_NAME), F.length("variable_name").cast("string")),
        ("name starts with bad_", named & F.lower("variable_name").startswith("bad_"), F.col("variable_name")),
        ("name ends with _tmp", named & F.lower("variable_name").endswith("_tmp"), F.col("variable_name")),
        ("duplicate name", F.coalesce(F.col("_dups") > 1, F.lit(False)), F.col("_dups").cast("string")),
        ("start without end", named & has_start & (F.col("end").isNull() | (F.col("end") == 0)), F.col("start_text")),
        ("start after end", named & has_start & (F.col("start") > F.col("end")), F.col("start_text")),
        ("negative start", named & (F.col("start") < 0), F.col("start_text")),
        ("type missing", has_start & named & (F.col("type") == ""), F.lit("")),
        ("unknown type", has_start & (F.col("type") != "") & ~F.col("type").rlike(LAYOUT_TYPES), F.col("type")),
        ("code not numeric", bad_code & (numeric | (F.col("_vartype") == "nominal_n")), F.col("code")),
    ]
    found = F.array(*[
        F.when(F.coalesce(t, F.lit(False)), F.struct(F.lit(r).alias("rule"), d.alias("detail"))) for r, t, d in tests])
    single = rows.select("import_order", "variable_name", F.inline(F.filter(found, lambda x: x.isNotNull())))
    fields = rows.where(named)
    overlap = next_value(fields, "start", ["import_order"], "_next").where(F.col("end") > F.col("_next")).select(
        "import_order", "variable_name", F.lit("overlaps next").alias("rule"),
        F.concat(F.col("end").cast("int").cast("string"), F.lit(" > "), F.col("_next").cast("int").cast("string")).alias("detail"))
    return single.unionByName(overlap).select("rule", "import_order", "variable_name", "detail")


# ------------------------------------------------------------ layout rows

_SIMPLE_TYPES = {
    "char": T.StringType(), "varchar": T.StringType(), "nvarchar": T.StringType(), "nchar": T.StringType(),
    "text": T.StringType(), "string": T.StringType(), "float": T.DoubleType(), "real": T.DoubleType(),
    "num": T.DoubleType(), "numeric": T.DoubleType(), "decimal": T.DoubleType(), "tinyint": T.ShortType(),
    "smallint": T.ShortType(), "int": T.IntegerType(), "integer": T.IntegerType(), "bigint": T.LongType(),
    "datetime": T.TimestampType(),
}


class LayoutField(NamedTuple):
    name: str
    type: T.DataType
    length: int | None
    informat: str
    regex: str
    low: float | None
    high: float | None


def read_layout_rows(layout) -> list[LayoutField]:
    """Validate the rows of a simple layout (varname, type, length, informat,
    regex, min, max)."""
    out, seen = [], set()
    for line, row in enumerate(sheet_rows(layout), start=1):
        name, kind = text_of(row.get("varname")), text_of(row.get("type")).lower()
        if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name) or len(name) > 128:
            raise ValueError(f"line {line}: {name!r} is not a valid variable name")
        if name.lower() in seen:
            raise ValueError(f"line {line}: variable {name} appears twice")
        seen.add(name.lower())
        if kind not in _SIMPLE_TYPES:
            raise ValueError(f"line {line}: unknown type {kind!r}")
        length = text_of(row.get("length"))
        is_text = isinstance(_SIMPLE_TYPES[kind], T.StringType)
        if is_text and not length:
            raise ValueError(f"line {line}: text variable {name} needs a length")
        if kind in ("num", "float", "real") and length not in ("", "8"):
            raise ValueError(f"line {line}: a numeric variable has length 8")
        bounds = []
        for which in ("min", "max"):
            value = text_of(row.get(which))
            try:
                bounds.append(float(value) if value else None)
            except ValueError:
                raise ValueError(f"line {line}: {which} of {name} is not a number") from None
        if ("start" in row) != ("end" in row) or (text_of(row.get("start")) == "") != (text_of(row.get("end")) == ""):
            raise ValueError(f"line {line}: start and end of {name} go together")
        regex = text_of(row.get("regex"))
        re.compile(regex)
        out.append(LayoutField(name, _SIMPLE_TYPES[kind], int(float(length)) if length else None,
                               text_of(row.get("informat")).lower(), regex, *bounds))
    return out


def parse_us_date(value: Column | str, informat: str = "mmddyyyy") -> Column:
    """``mmddyyyy`` text to a timestamp; anything else is NULL."""
    # Informats and their patterns.
    patterns = {"mmddyyyy": "MMddyyyy", "mmddyy8.": "MMddyyyy", "mmddyy8": "MMddyyyy", "mmddyy10.": "MM/dd/yyyy",
                "mmddyy10": "MM/dd/yyyy", "": "MMddyyyy"}
    if informat.lower() not in patterns:
        raise ValueError(f"unknown informat {informat!r}")
    return F.try_to_timestamp(value if isinstance(value, Column) else F.col(value), F.lit(patterns[informat.lower()]))


def _failures(rows: Sequence[tuple[str, Column, Column, str]]) -> Column:
    """Array of error structs of one row, from (variable, value, test, message)."""
    cells = [
        F.when(F.coalesce(test, F.lit(False)), F.struct(
            F.lit(n).alias("variable"), v.cast("string").alias("value"), F.lit(m).alias("point_of_failure")))
        for n, v, test, m in rows
    ]
    return F.filter(F.array(*cells), lambda x: x.isNotNull())


def _value_tests(fields: Sequence[LayoutField]) -> list[tuple[str, Column, Column, str]]:
    tests = []
    for f in fields:
        v = F.col(f.name)
        number = to_number(v)
        if f.regex:
            # a pattern has to match from the start of the value, not all of it
            tests.append((f.name, v, ~v.cast("string").rlike("^(?:" + f.regex + ")"), "Regular Expression"))
        if f.low is not None:
            tests.append((f.name, v, number < f.low, "Min value check"))
        if f.high is not None:
            tests.append((f.name, v, number > f.high, "Max value check"))
    return tests


def check_values(df: DataFrame, layout, line: str = "line_number") -> DataFrame:
    """Regex, minimum and maximum failures, one row per failing cell.

    All tests of a row are evaluated in one pass; NULL cells are skipped.
    """
    tests = _value_tests(read_layout_rows(layout))
    if not tests:
        return df.limit(0).select(line, *[F.lit("").alias(c) for c in ("variable", "value", "point_of_failure")])
    return df.select(line, F.inline(_failures(tests)))


class TypedResult(NamedTuple):
    data: DataFrame
    errors: DataFrame


def apply_layout_types(df: DataFrame, layout, line: str = "line_number") -> TypedResult:
    """Cast text columns by a layout: text is cut to its length, a value that
    cannot be cast becomes NULL and an error row."""
    columns, tests = [], []
    for f in read_layout_rows(layout):
        field_type(df, f.name)
        text = F.trim(F.col(f.name).cast("string"))
        value = F.when(~text.isin("", "."), text)
        if isinstance(f.type, T.StringType):
            columns.append(F.substring(value, 1, f.length).alias(f.name))
            continue
        cast = parse_us_date(value, f.informat) if isinstance(f.type, T.TimestampType) else value.try_cast(f.type)
        if isinstance(f.type, (T.ShortType, T.IntegerType, T.LongType)):
            cast = F.coalesce(cast, to_number(value).try_cast(f.type))
        columns.append(cast.alias(f.name))
        tests.append((f.name, value, value.isNotNull() & cast.isNull(), "Error inserting data"))
    keep = [F.col(line)] if line in df.columns else []
    data = df.select(*keep, *columns)
    if not tests:
        empty = df.limit(0).select(line, *[F.lit("").alias(c) for c in ("variable", "value", "point_of_failure")])
        return TypedResult(data, empty)
    return TypedResult(data, df.select(line, F.inline(_failures(tests))))


# --------------------------------------------------------------- recoding

def layout_codes(layout) -> dict[str, tuple[str, dict[str, str | None]]]:
    """Per variable: (type, {original code: standard code}) of a full layout."""
    out: dict[str, tuple[str, dict]] = {}
    current = None
    rows = sorted(sheet_rows(layout), key=lambda r: float(r.get("import_order") or 0))
    for row in rows:
        if text_of(row.get("start")) and text_of(row.get("end")):
            current = text_of(row["variable_name"])
            out[current] = (text_of(row.get("type")).upper(), {})
        if current is None:
            raise ValueError("the first layout row has no start")
        original = text_of(row.get("nominal_values"))
        if original and out[current][0] != "STRING":
            code = row.get("std_code")
            out[current][1][original] = None if code is None else text_of(code)
    return out


def implied_decimal(value: Column | str, layout_type: str, reference_divisor: bool = True) -> Column:
    """Digits-only text of an IDn column divided by 10 (or 10**n)."""
    match = re.fullmatch(r"(?:NOMINAL_)?ID([0-9])", layout_type.upper())
    if not match:
        raise ValueError(f"{layout_type!r} is not an ID type")
    divisor = 10.0 if reference_divisor else 10.0 ** int(match[1])
    column = F.col(value) if isinstance(value, str) else value
    return F.when(column.rlike(r"^\d+$"), (column.try_cast("double") / divisor).cast("string")).otherwise(column)


def recode_values(df: DataFrame, layout, reference_divisor: bool = True) -> DataFrame:
    """Map original codes to standard codes; unmapped values stay.

    In numeric columns a period means missing and other text is blanked; the
    result is text, with a single blank for missing, as in the item files.
    """
    columns = []
    codes = {k.lower(): v for k, v in layout_codes(layout).items()}
    for c in df.columns:
        if c.lower() not in codes:
            columns.append(F.col(c))
            continue
        kind, table = codes[c.lower()]
        value = F.col(c).cast("string")
        if table:
            pairs = [F.lit(x).cast("string") for pair in table.items() for x in pair]
            value = F.coalesce(F.try_element_at(F.create_map(*pairs), value), value)
        if kind not in ("STRING", "NOMINAL", "NOMINAL_ID1", "NOMINAL_ID2"):
            number = to_number(value)
            value = F.when(value == ".", F.lit(" ")).when(number.isNotNull(), value)
        if re.fullmatch(r"(NOMINAL_)?ID[0-9]", kind):
            value = implied_decimal(value, kind, reference_divisor)
        columns.append(F.coalesce(value, F.lit(" ")).alias(c))
    return df.select(*columns)


def recode_by_table(df: DataFrame, column: str, codes: DataFrame, original: str = "original", standard: str = "standard") -> DataFrame:
    """Recode by a code table too long for an expression (a lookup join)."""
    from ..session import maybe_broadcast

    table = codes.select(F.col(original).alias("_o"), F.col(standard).alias("_s"))
    joined = df.join(maybe_broadcast(table), F.col(column) == F.col("_o"), "left")
    return joined.select(*[F.coalesce("_s", column).alias(c) if c == column else F.col(c) for c in df.columns])


def missing_flag_columns(df: DataFrame, layout, filled: bool = False) -> DataFrame:
    """Add MISSING_<column> beside every column whose code list holds a period.

    The flag is a blank; with ``filled`` it is 1 where the value is missing.
    """
    chosen = {k.lower() for k, (_, table) in layout_codes(layout).items() if "." in {*table, *table.values()}}
    out = []
    for c in df.columns:
        out.append(F.col(c))
        if c.lower() in chosen:
            gone = F.col(c).isNull() | F.trim(F.col(c).cast("string")).isin("", ".")
            out.append((F.when(gone, "1").otherwise(" ") if filled else F.lit(" ")).alias(f"MISSING_{c}"))
    return df.select(*out)


# -------------------------------------------------------------- item rows

def detect_item_columns(columns: Sequence[str], pattern: str) -> dict[str, list[str]]:
    """Item families of a wide table: stem name -> columns of item 1..max.

    ``pattern`` holds ``{icnt}`` where the item number stands; a family must
    be complete from 1 to the highest number.
    """
    regex = re.compile(pattern.replace("{icnt}", r"(?P<n>\d+)", 1).replace("{icnt}", r"(?P=n)"), re.IGNORECASE)
    families: dict[str, dict[int, str]] = {}
    for c in columns:
        m = regex.search(c)
        if not m:
            continue
        # the greedy part of a pattern may swallow digits: take the last number
        number = re.search(r"(\d+)(?!.*\d)", c)
        stem = (c[:number.start()].rstrip("_") + c[number.end():]).lower()
        families.setdefault(stem, {})[int(number[1])] = c
    if not families:
        return {}
    highest = max(max(f) for f in families.values())
    return {s: [f[i] for i in range(1, highest + 1)] for s, f in families.items()
            if set(range(1, highest + 1)) <= set(f)}


def itemize(df: DataFrame, row_id: str, families: Mapping[str, Sequence[str]], flat_id: str = "flat_table_id",
            item_id: str = "id") -> DataFrame:
    """One row per (flat id, item number), one column per family, in one pass."""
    length = {len(c) for c in families.values()}
    if len(length) != 1:
        raise ValueError("all item families must have the same number of items")
    cells = F.array(*[
        F.struct(F.lit(i + 1).alias(item_id), *[F.col(cols[i]).alias(stem) for stem, cols in families.items()])
        for i in range(length.pop())])
    return df.select(F.col(row_id).alias(flat_id), F.inline(cells))


def attach_open_ended(df: DataFrame, row_id: str, families: Mapping[str, Sequence[str]], positions: Sequence[str],
                      scores: Mapping[str, Sequence[str]], flat_id: str = "flat_table_id", item_id: str = "id",
                      default: str = " ") -> DataFrame:
    """Itemized rows with open-ended scores placed at their position columns.

    ``positions[k]`` names the column holding the item number of the k-th
    open-ended item, ``scores[name][k]`` its score columns.  The placement is
    a look-up inside the wide row, so no join or shuffle is needed.
    """
    length = {len(c) for c in families.values()}
    if len(length) != 1:
        raise ValueError("all item families must have the same number of items")
    place = [F.trim(F.col(p).cast("string")).try_cast("int") for p in positions]

    def score(columns: Sequence[str], number: int) -> Column:
        out = None
        for at, c in zip(place, columns):
            value = F.col(c).cast("string")
            out = F.when(at == number, value) if out is None else out.when(at == number, value)
        return F.lit(default) if out is None else out.otherwise(F.lit(default))

    cells = F.array(*[
        F.struct(F.lit(i + 1).alias(item_id), *[F.col(cols[i]).alias(s) for s, cols in families.items()],
                 *[score(cols, i + 1).alias(s) for s, cols in scores.items()])
        for i in range(length.pop())])
    return df.select(F.col(row_id).alias(flat_id), F.inline(cells))


class SplitResult(NamedTuple):
    flat: DataFrame
    items: dict[str, DataFrame]


def flat_item_split(df: DataFrame, row_id: str, subject_patterns: Mapping[str, str],
                    open_ended: Mapping[str, tuple[Sequence[str], Mapping[str, Sequence[str]]]] | None = None) -> SplitResult:
    """Flat table without item columns, and one long item table per subject."""
    used, items = set(), {}
    for subject, pattern in subject_patterns.items():
        families = detect_item_columns(df.columns, pattern)
        if not families:
            raise ValueError(f"no complete item family for subject {subject}")
        used |= {c for cols in families.values() for c in cols}
        if open_ended and subject in open_ended:
            positions, scores = open_ended[subject]
            used |= set(positions) | {c for cols in scores.values() for c in cols}
            items[subject] = attach_open_ended(df, row_id, families, positions, scores)
        else:
            items[subject] = itemize(df, row_id, families)
    return SplitResult(df.select(*[c for c in df.columns if c not in used]), items)
