"""Tables as text, type inference, stacking of part files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import blank
from ..functions.numbers import to_number, to_whole
from ..operators.windows import union_all
from .lines import add_import_order


def drop_blank_rows(df: DataFrame) -> DataFrame:
    """Drop rows in which every column is NULL or blank."""
    return df.where(~reduce(lambda a, b: a & b, [blank(c) for c in df.columns]))


class ColumnGuess(NamedTuple):
    kind: str
    type: T.DataType
    max_length: int


# Whole-number kinds with their ranges, narrowest first.
_WHOLE = (
    ("tinyint", T.ShortType(), 0, 255), ("smallint", T.ShortType(), -32768, 32767),
    ("int", T.IntegerType(), -2147483648, 2147483647),
    ("bigint", T.LongType(), -9223372036854775808, 9223372036854775807),
)


def _as_date(text):
    """Timestamp of a date text; only text that looks like a date is parsed."""
    forms = ((r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$", "yyyy-MM-dd HH:mm:ss"), (r"^\d{4}-\d\d-\d\d$", "yyyy-MM-dd"),
             (r"^\d\d/\d\d/\d{4}$", "MM/dd/yyyy"))
    return F.coalesce(*[F.when(text.rlike(r), F.try_to_timestamp(text, F.lit(p))) for r, p in forms])


def infer_column_types(df: DataFrame) -> tuple[dict[str, ColumnGuess], DataFrame]:
    """Narrowest type of each text column, and the cast table.

    One aggregate pass over all rows, so no later cell can fail to cast: text
    wins over everything, dates mixed with numbers are text, whole numbers get
    the narrowest range that holds them.
    """
    # Each cell is parsed once, in a projection below the aggregate.
    parsed, aggs = {}, []
    for i, c in enumerate(df.columns):
        text = F.trim(F.col(c).cast("string"))
        parsed[f"_full{i}"] = F.col(c).isNotNull() & (text != "")
        parsed[f"_num{i}"] = to_number(text)
        parsed[f"_text{i}"] = text
        parsed[f"_len{i}"] = F.length(F.col(c).cast("string"))
    source = df.select(*[v.alias(k) for k, v in parsed.items()])
    second = {}
    for i in range(len(df.columns)):
        number, text = F.col(f"_num{i}"), F.col(f"_text{i}")
        # 3.0 counts as a whole number, as spreadsheets store every number as a double
        exact = (number == F.floor(number)) & (F.abs(number) < 9e15)
        second[f"_int{i}"] = F.when(exact, number.try_cast("bigint")).when(number == F.floor(number), to_whole(text))
        second[f"_date{i}"] = F.when(number.isNull(), _as_date(text).isNotNull()).otherwise(F.lit(False))
    source = source.withColumns(second)
    for i in range(len(df.columns)):
        full, number, whole, date = (F.col(f"_{k}{i}") for k in ("full", "num", "int", "date"))
        aggs += [
            F.max(F.when(full, (number.isNull() & ~date).cast("int"))).alias(f"s{i}"),
            F.max(F.when(full, date.cast("int"))).alias(f"d{i}"),
            F.max(F.when(full, number.isNotNull().cast("int"))).alias(f"n{i}"),
            F.max(F.when(full & number.isNotNull(), whole.isNull().cast("int"))).alias(f"f{i}"),
            F.max(f"_len{i}").alias(f"l{i}"), F.min(whole).alias(f"lo{i}"), F.max(whole).alias(f"hi{i}"),
        ]
    seen = source.agg(*aggs).first()
    guesses, columns = {}, []
    for i, c in enumerate(df.columns):
        string, date, number, fraction = (seen[f"{k}{i}"] for k in "sdnf")
        length = seen[f"l{i}"] or 0
        text = F.trim(F.col(c).cast("string"))
        value = F.when(text != "", text)
        if string or (date and number) or not (date or number):
            guess, column = ColumnGuess("nvarchar", T.StringType(), length), F.col(c).cast("string")
        elif date:
            guess = ColumnGuess("datetime", T.TimestampType(), length)
            column = _as_date(value)
        elif fraction:
            guess, column = ColumnGuess("float", T.DoubleType(), length), to_number(value)
        else:
            name, kind = next((n, t) for n, t, lo, hi in _WHOLE if lo <= seen[f"lo{i}"] and seen[f"hi{i}"] <= hi)
            guess = ColumnGuess(name, kind, length)
            column = F.coalesce(to_whole(value), to_number(value).try_cast("bigint")).cast(kind)
        guesses[c] = guess
        columns.append(column.alias(c))
    return guesses, df.select(*columns)


def read_many(spark: SparkSession, paths: Sequence[str], reader=None, id_name: str | None = None,
              order: Sequence | None = None) -> DataFrame:
    """Stack part files (parquet unless ``reader(path)`` is given).

    Ids are made after the stacking, so they are unique over all parts.
    """
    if reader is None:
        out = spark.read.parquet(*paths)
        return add_import_order(out, id_name, order) if id_name else out
    out = union_all([reader(p) for p in paths])
    if id_name is None:
        return out
    if order is None:
        raise ValueError("an order is needed to number rows of custom readers")
    return add_import_order(out, id_name, order)


def read_table_as_text(spark: SparkSession, source: str, names: Sequence[str] | None = None,
                       query: bool = False) -> DataFrame:
    """A table, or the result of a query, as trimmed text; NULL is kept."""
    df = spark.sql(source) if query else spark.table(source)
    out = df.select(*[F.trim(F.col(c).cast("string")).alias(c) for c in df.columns])
    if names is not None:
        if len(names) != len(out.columns):
            raise ValueError(f"{len(names)} names for {len(out.columns)} columns")
        out = out.toDF(*names)
    return out
