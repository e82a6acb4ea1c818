"""Text lines with exact line numbers, and row numbers in source order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..operators.skew import number_rows
from ..session import maybe_broadcast

_FILE, _BLOCK, _AT = "_src_file", "_src_block", "_src_at"


def _tagged(df: DataFrame) -> DataFrame:
    """Place of each row: file, split of the file, and position in the scan."""
    return df.select(
        "*", F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.file_block_start").alias(_BLOCK),
        F.monotonically_increasing_id().alias(_AT))


def _numbered(tagged: DataFrame, name: str, per_file: bool) -> DataFrame:
    """Rows of one split are consecutive in the scan, so a number is the rows
    of the splits before it plus the distance from its first row.  Only one
    row per file split is ordered."""
    splits = tagged.groupBy(_FILE, _BLOCK).agg(F.min(_AT).alias("_first"), F.count("*").alias("_rows"))
    window = (W.partitionBy(_FILE).orderBy(_BLOCK) if per_file else W.partitionBy(F.lit(1)).orderBy(_FILE, _BLOCK))
    before = F.coalesce(F.sum("_rows").over(window.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    splits = splits.withColumn("_before", before).drop("_rows")
    joined = tagged.join(maybe_broadcast(splits), [_FILE, _BLOCK])
    number = F.col("_before") + F.col(_AT) - F.col("_first") + 1
    return joined.withColumn(name, number.cast("bigint")).drop("_before", "_first", _AT, _BLOCK)


def numbered_lines(spark: SparkSession, path, encoding: str = "UTF-8", one_text: bool = False) -> DataFrame:
    """Columns: value, line_number, source_file.

    Lines are numbered from 1 within their file; with ``one_text`` the files of
    ``path`` are the parts of one text, as a job writes it, and are numbered on
    in the order of their names.
    """
    if encoding.upper().replace("-", "") == "UTF8":
        lines = spark.read.text(path)
    else:
        lines = (
            spark.read.option("encoding", encoding).option("sep", "\u0001").option("quote", "")
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .schema("value string").csv(path))
    out = _numbered(_tagged(lines), "line_number", per_file=not one_text).withColumnRenamed(_FILE, "source_file")
    bom = (F.col("line_number") == 1) & F.col("value").startswith("\ufeff")
    return out.withColumn("value", F.when(bom, F.col("value").substr(F.lit(2), F.length("value"))).otherwise(F.col("value")))


def add_import_order(df: DataFrame, name: str = "import_order", order: Sequence | None = None) -> DataFrame:
    """1-based row number over the table.

    A frame read directly from files is numbered in file order; give a total
    ``order`` for any other frame.
    """
    if order is not None:
        return number_rows(df, [], order, name)
    return _numbered(_tagged(df), name, per_file=False).drop(_FILE).select(name, *df.columns)
