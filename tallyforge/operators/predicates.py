"""Control-sheet conditions, conditional updates and row routing."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import to_number
from ..session import maybe_broadcast


def sheet_rows(sheet) -> list[dict]:
    """Rows of a control sheet (list of mappings or a small DataFrame).

    Column names are lower-cased.  A sheet is a hand-written table; it is the
    only thing this library collects besides bounded aggregates.
    """
    if isinstance(sheet, DataFrame):
        sheet = [r.asDict() for r in sheet.collect()]
    out = []
    for row in sheet:
        row = row.asDict() if isinstance(row, Row) else row
        out.append({str(k).strip().lower(): v for k, v in row.items()})
    return out


def require_columns(rows: list[dict], names: Sequence[str], what: str) -> None:
    missing = [n for n in names if any(n not in r for r in rows)]
    if not rows:
        raise ValueError(f"{what} is empty")
    if missing:
        raise ValueError(f"{what} lacks required columns: {', '.join(missing)}")


def text_of(value) -> str:
    """Trimmed text of a sheet cell; NULL, NaN and whole floats read naturally."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, float) and value.is_integer():
        return str(int(value))
    return str(value).strip()


def field_type(df: DataFrame, name: str) -> T.DataType:
    for field in df.schema.fields:
        if field.name.lower() == name.lower():
            return field.dataType
    raise ValueError(f"column {name!r} not found in {df.columns}")


def equals_value(df: DataFrame, name: str, value: str) -> Column:
    """Equality with sheet text: by number for numeric columns, else as text.

    Text compares without regard to case and trailing blanks.
    """
    kind = field_type(df, name)
    if isinstance(kind, T.StringType):
        return F.upper(F.rtrim(F.col(name))) == F.lit(value.upper().rstrip())
    if isinstance(kind, T.BooleanType):
        return F.col(name).cast("int") == F.lit(int(float(value)))
    if isinstance(kind, (T.DateType, T.TimestampType)):
        return F.col(name) == F.lit(value).cast(kind)
    return F.col(name) == F.lit(float(value) if not value.lstrip("+-").isdigit() else int(value))


def split_conditions(variables, values, separator: str = "*") -> list[tuple[str, str]]:
    names = [v.strip() for v in text_of(variables).split(separator) if v.strip()]
    items = text_of(values).split()
    if len(names) != len(items):
        raise ValueError(f"{len(names)} condition variables but {len(items)} values: {variables!r} / {values!r}")
    return list(zip(names, items))


def spec_predicate(df: DataFrame, variables, values) -> Column:
    """``'A*B'`` with ``'1 2'`` to ``A = 1 AND B = 2``; blank is always true."""
    conditions = [equals_value(df, n, v) for n, v in split_conditions(variables, values)]
    return reduce(lambda a, b: a & b, conditions) if conditions else F.lit(True)


def where_computed(df: DataFrame, condition: Column) -> DataFrame:
    """Rows where a condition over computed columns holds.

    A plain filter would be pushed below the projections that compute those
    columns, copying their expressions into every place the condition names
    them.  Exploding a one-element array keeps each column computed once.
    """
    return df.select("*", F.explode(F.when(condition, F.array(F.lit(True)))).alias("_kept")).drop("_kept")


def conditional_update(df: DataFrame, rules: Sequence[tuple[Column | str, Mapping[str, Column | str]]],
                       independent: bool = False) -> DataFrame:
    """Apply ordered ``(condition, {column: expression})`` rules.

    Each rule sees the results of the ones before it.  With ``independent``
    the rules do not read each other's targets and become a single select, in
    which the last matching rule wins.
    """

    def as_column(x):
        return F.expr(x) if isinstance(x, str) else x

    if independent:
        current: dict[str, Column] = {}
        for condition, changes in rules:
            for name, value in changes.items():
                base = current.get(name, F.col(name))
                current[name] = F.when(as_column(condition), as_column(value)).otherwise(base)
        return df.withColumns(current)
    for condition, changes in rules:
        df = df.withColumns({
            name: F.when(as_column(condition), as_column(value)).otherwise(F.col(name))
            for name, value in changes.items()
        })
    return df


def lookup_update(df: DataFrame, dimension: DataFrame, on: Mapping[str, str],
                  updates: Mapping[str, Column | str], condition: Column | str | None = None,
                  prefix: str = "m_") -> DataFrame:
    """Update columns from a dimension row; unmatched rows stay as they are.

    ``on`` maps a column of ``df`` to one of the dimension.  Expressions and
    the condition may use dimension columns as ``m_<name>``.  The dimension
    must be unique on its key.
    """
    renamed = dimension.select(*[F.col(c).alias(prefix + c) for c in dimension.columns])
    test = reduce(lambda a, b: a & b, [F.col(k) == F.col(prefix + v) for k, v in on.items()])
    joined = df.join(maybe_broadcast(renamed), test, "left")
    hit = reduce(lambda a, b: a & b, [F.col(prefix + v).isNotNull() for v in on.values()])
    if condition is not None:
        hit = hit & (F.expr(condition) if isinstance(condition, str) else condition)
    changed = {
        name: F.when(hit, F.expr(v) if isinstance(v, str) else v).otherwise(F.col(name))
        for name, v in updates.items()
    }
    return joined.withColumns(changed).select(*df.columns)


def split_by_flag(df: DataFrame, condition: Column | str) -> tuple[DataFrame, DataFrame]:
    """Rows where the condition holds, and all others (NULL goes to the others)."""
    test = F.expr(condition) if isinstance(condition, str) else condition
    test = F.coalesce(test, F.lit(False))
    return df.where(test), df.where(~test)


def drop_unattempted(df: DataFrame, attempt_columns: Sequence[str], type_column: str | None = None,
                     dropped_types: Sequence[str] = ("H",)) -> DataFrame:
    """Drop rows whose attempt flags are all 0, and rows of the dropped types."""
    attempted = reduce(lambda a, b: a | b, [
        F.coalesce(to_number(c).try_cast("int"), F.lit(0)) != 0
        for c in attempt_columns
    ])
    out = df.where(attempted)
    if type_column is not None:
        out = out.where(~F.coalesce(F.col(type_column).isin(list(dropped_types)), F.lit(False)))
    return out
