"""Exact duplicates: sorted digest runs, merged in rounds of a tree.

Each partition sorts the digests of its rows into a run in which a digest
stands once, with the identifier that stays and the number of rows.  In round
r the partitions that differ only in digit r of their number exchange their
runs: an entry moves to the partition whose digit r is digit r of its digest.
What arrives is merged in order and equal entries become one again.  After
log(partitions) rounds every partition owns one range of digests, no partition
ever held more than its share, and a text that is a third of all rows crosses
the network as one entry per partition and round.

Runs carry the text's length and a second hash beside SHA-256.  Only entries
that agree in all three are merged: this is the check of equality.

Defined cases: null text is the empty text; all empty texts form one group; of
repeated rows with the same id and text one is kept; a null id loses against
any other id and is kept only if the whole group has no id.  A very long text
is hashed whole where it lies and never moves; equal ids of a group tie, and one
row of them is kept.  Other columns are never read.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import whole_text

RUN = "digest binary, second long, length long, keep_id long, with_id long, rows long"
KEY = ["digest", "second", "length"]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = whole_text(text_col)
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("digest"),
        F.xxhash64(text).alias("second"), F.length(text).cast("long").alias("length"))


def _merge_run(largest: bool):
    """Merge entries that arrive in order of their key; equal neighbours become one."""
    better = np.maximum if largest else np.minimum
    worst = np.iinfo(np.int64).min if largest else np.iinfo(np.int64).max

    def merged(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        n = table.num_rows
        first = np.ones(n, bool)
        for name in KEY:
            column = table[name].combine_chunks()
            differs = pc.not_equal(column.slice(1), column.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            first[1:] = differs if name == KEY[0] else first[1:] | differs
        at = np.flatnonzero(first)
        ids = pc.fill_null(table["keep_id"], int(worst)).to_numpy()
        with_id = np.add.reduceat(table["with_id"].to_numpy(), at)
        keep = pa.array(better.reduceat(ids, at), mask=with_id == 0)
        out = table.take(pa.array(at))
        for name, values in (("keep_id", keep), ("with_id", pa.array(with_id)),
                             ("rows", pa.array(np.add.reduceat(table["rows"].to_numpy(), at)))):
            out = out.set_column(out.schema.get_field_index(name), name, values)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_entry: pa.Table | None = None  # the last key may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = merged(table if open_entry is None else pa.concat_tables([open_entry, table.cast(open_entry.schema)]))
            open_entry = table.slice(table.num_rows - 1)
            yield from table.slice(0, table.num_rows - 1).to_batches()
        if open_entry is not None:
            yield from open_entry.to_batches()

    return run


def _radix(partitions: int, fan_in: int) -> tuple[int, int]:
    """Digits and base of partition numbers: base ** digits >= partitions, base <= fan_in."""
    digits = 1
    while fan_in ** digits < partitions:
        digits += 1
    base = 2
    while base ** digits < partitions:
        base += 1
    return digits, base


def _digit(base: int, r: int) -> Column:
    """Digit r of an entry's digest, from its leading 48 bits."""
    lead = F.conv(F.substring(F.hex("digest"), 1, 12), 16, 10).cast("long")
    return F.pmod(F.floor(lead / F.lit(base ** r)), F.lit(base)).cast("int")


def merge_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest",
               fan_in: int = 8, partitions: int | None = None) -> DataFrame:
    """One row per distinct text: digest, second, length, keep_id, with_id, rows.

    ``fan_in`` bounds how many runs meet in one partition and round;
    ``partitions`` (spark.sql.shuffle.partitions) is rounded up to a power.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep: {keep}")
    wanted = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    digits, base = _radix(max(2, wanted), fan_in)
    merge = _merge_run(keep == "largest")
    rows = _keyed(docs, id_col, text_col).select(
        *KEY, F.col("doc_id").alias("keep_id"), F.col("doc_id").isNotNull().cast("long").alias("with_id"),
        F.lit(1).cast("long").alias("rows"))

    def exchange(run: DataFrame, r: int) -> DataFrame:
        own = F.pmod(F.spark_partition_id(), F.lit(base ** digits))
        own_digit = F.pmod(F.floor(own / F.lit(base ** r)), F.lit(base))
        target = (own + (_digit(base, r) - own_digit) * F.lit(base ** r)).cast("int")
        moved = run.withColumn("_target", target).repartitionById(base ** digits, F.col("_target")).drop("_target")
        return moved.sortWithinPartitions(*KEY).mapInArrow(merge, RUN)

    return reduce(exchange, range(digits), rows.sortWithinPartitions(*KEY).mapInArrow(merge, RUN))


def mark_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest",
               fan_in: int = 8) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    groups = merge_runs(docs, id_col, text_col, keep, fan_in).select(*KEY, "keep_id", F.col("rows").alias("group_size"))
    # Repeated rows are numbered before the join: a window above it would keep a hot text's rows in one task.
    nth = F.row_number().over(Window.partitionBy("doc_id", *KEY).orderBy(F.lit(0)))
    rows = _keyed(docs, id_col, text_col).withColumn("nth", nth).join(groups, KEY)
    return rows.select(
        "doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest",
               fan_in: int = 8) -> DataFrame:
    """The documents without later copies: all columns, one row per distinct text."""
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    plain = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    text, key = whole_text(names[text_col]), F.col(names[id_col]).cast("long")
    groups = merge_runs(docs, id_col, text_col, keep, fan_in).select(*KEY, "keep_id")
    keyed = plain.withColumns({"digest": F.unhex(F.sha2(text, 256)), "second": F.xxhash64(text),
                               "length": F.length(text).cast("long"), "_id": key})
    # Only winners meet in a window, so copies of one text do not gather in a task.
    winners = keyed.join(groups.withColumnRenamed("keep_id", "_keep"),
                         [keyed[k] == groups[k] for k in KEY] + [keyed["_id"].eqNullSafe(F.col("_keep"))], "left_semi")
    others = [n for c, n in names.items() if c not in (id_col, text_col)]
    nth = F.row_number().over(Window.partitionBy("_id", *KEY).orderBy(F.to_json(F.struct(*others)) if others else F.lit(0)))
    return winners.withColumn("_nth", nth).where("_nth = 1").select(*[F.col(n).alias(c) for c, n in names.items()])
