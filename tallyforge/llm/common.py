"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch sent to Python; with texts of 100 KB a batch stays near 50 MB.
BATCH_ROWS = 512


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Keep Arrow batches small, since one row may hold a very long text."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def whole_text(name: str = "text") -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only id and whole text, whatever other columns there are."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), whole_text(text_col).alias("text"))


def columns_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
    for batch in batches:
        if batch.num_rows:
            yield batch.to_pydict()


def record_batch(schema: pa.Schema, columns: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def free_name(taken: list[str], wanted: str) -> str:
    """``wanted``, with underscores until no column has that name (case does not count)."""
    lower = {c.lower() for c in taken}
    while wanted.lower() in lower:
        wanted = "_" + wanted
    return wanted
