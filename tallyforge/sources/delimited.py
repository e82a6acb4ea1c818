"""Delimited text under a layout, and value/header file pairs."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.predicates import sheet_rows, text_of
from .lines import numbered_lines

ERROR_SCHEMA = "line_number bigint, variable string, value string, point_of_failure string"


class ReadResult(NamedTuple):
    data: DataFrame
    errors: DataFrame


def _error(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, ERROR_SCHEMA)


def clean_cell(value):
    """Strip blanks and quotes; empty and lone-period cells are NULL."""
    text = F.trim(F.regexp_replace(F.trim(value), "^['\"]+|['\"]+$", ""))
    return F.when(~text.isin("", "."), text)


def read_delimited(spark: SparkSession, path, layout, delimiter: str = ",", encoding: str = "UTF-8",
                   first_row: int = 2, names: bool = True, one_text: bool = False) -> ReadResult:
    """Text columns of a delimited file, matched to a layout by name.

    With ``names`` the first line names the columns in any order; an unknown
    name is an error row, a missing layout column an exception.  Cells beyond
    the header are error rows.  Each file of ``path`` begins with the same header;
    with ``one_text`` the files are parts of one text, whose first line alone is
    the header.
    """
    wanted = [text_of(r["varname"]) for r in sheet_rows(layout)]
    lines = numbered_lines(spark, path, encoding, one_text)
    errors = []
    header = list(wanted)
    if names and first_row > 1:
        first = lines.where("line_number = 1").select("value").limit(1).collect()
        if not first:
            raise ValueError(f"no header line in {path}")
        header = [h.strip().strip("'\"").strip() for h in next(csv.reader([first[0][0]], delimiter=delimiter))]
        known = {w.lower(): w for w in wanted}
        errors = [(1, h, h, "Variable Not Found In Layout") for h in header if h.lower() not in known]
        absent = [w for w in wanted if w.lower() not in {h.lower() for h in header}]
        if absent:
            raise ValueError(f"not all variables of the layout are in the file: {', '.join(absent)}")
    fields = [T.StructField(f"c{i}", T.StringType()) for i in range(len(header))]
    schema = T.StructType([*fields, T.StructField("_rest", T.StringType())])
    parsed = F.from_csv("value", schema.simpleString()[7:-1].replace(":", " "), {
        "sep": delimiter, "quote": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_rest"})
    rows = lines.where(F.col("line_number") >= first_row).withColumn("_p", parsed)
    place = {h.lower(): i for i, h in reversed(list(enumerate(header)))}
    data = rows.select("line_number", *[clean_cell(F.col(f"_p.c{place[w.lower()]}")).alias(w) for w in wanted])
    # Delimiters outside quotes tell how many cells a malformed line has.
    bare = F.regexp_replace(F.col("_p._rest"), '"[^"]*"', "")
    cells = F.length(bare) - F.length(F.replace(bare, F.lit(delimiter), F.lit(""))) + 1
    surplus = rows.where(F.col("_p._rest").isNotNull() & (cells > len(header))).select(
        "line_number", F.lit(None).cast("string").alias("variable"), F.col("_p._rest").alias("value"),
        F.lit("More columns than specified in layout").alias("point_of_failure"))
    return ReadResult(data, _error(spark, errors).unionByName(surplus))


# Column types of a .cty file.
_TYPES = {
    "char": T.StringType(), "varchar": T.StringType(), "nvarchar": T.StringType(), "nchar": T.StringType(),
    "text": T.StringType(), "string": T.StringType(), "float": T.DoubleType(), "real": T.FloatType(),
    "tinyint": T.ShortType(), "smallint": T.ShortType(), "int": T.IntegerType(), "integer": T.IntegerType(),
    "bigint": T.LongType(), "bit": T.BooleanType(), "datetime": T.TimestampType(), "date": T.DateType(),
}


def column_type(text: str) -> T.DataType:
    """Spark type of a declared column type such as ``varchar(17)`` or ``decimal(8,2)``."""
    base, _, rest = text.strip().lower().partition("(")
    if base in ("decimal", "numeric", "dec"):
        parts = [int(x) for x in rest.rstrip(") ").split(",") if x.strip()]
        return T.DecimalType(*(parts or [38, 0]))
    if base not in _TYPES:
        raise ValueError(f"unknown column type {text!r}")
    return _TYPES[base]


def read_typed_pair(spark: SparkSession, values_path, names_path, style: str = "tvp",
                    overrides: Mapping[str, str] | None = None) -> DataFrame:
    """Tab-separated values whose names (hvp) or names and types (tvp) are in
    a second file; overrides of unknown columns are an error."""
    lines = [r["value"] for r in numbered_lines(spark, names_path).orderBy("line_number").select("value").collect()]
    if style == "hvp":
        columns = [(n.strip(), T.StringType()) for line in lines for n in line.split("\t") if n.strip()]
    elif style == "tvp":
        pairs = [line.split("\t") for line in lines if line.strip()]
        columns = [(p[0].strip(), column_type(p[1])) for p in pairs]
    else:
        raise ValueError("style must be hvp or tvp")
    by_name = {n.lower() for n, _ in columns}
    changes = {k.lower(): v for k, v in (overrides or {}).items()}
    unknown = set(changes) - by_name
    if unknown:
        raise ValueError(f"type overrides for unknown columns: {sorted(unknown)}")
    schema = T.StructType([
        T.StructField(n, column_type(changes[n.lower()]) if n.lower() in changes else t) for n, t in columns])
    return spark.read.schema(schema).csv(values_path, sep="\t", header=False)
