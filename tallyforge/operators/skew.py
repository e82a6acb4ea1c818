"""Joins and numbering that stay balanced when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import checkpointed, maybe_broadcast

# A key with more rows than this is handled apart from the others.  At most
# rows / HOT_ROWS keys can be that hot, so their list is always small.
HOT_ROWS = 1_000_000


# Hot keys a broadcast may carry; a longer list is joined by shuffle.
HOT_LIST_ROWS = 1_000_000


def hot_keys(df: DataFrame, keys: Sequence[str], limit: int = HOT_ROWS) -> DataFrame | None:
    """Keys of more than ``limit`` rows with their ``_rows``, or None when there is none.

    One narrow job: counts combine on the map side before the shuffle.
    """
    hot = _present(df, keys).groupBy(*keys).agg(F.count("*").alias("_rows")).where(F.col("_rows") > limit)
    return None if hot.isEmpty() else checkpointed(hot)


def _present(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    return df


def hot_on_either(left: DataFrame, right: DataFrame, keys: Sequence[str], limit: int = HOT_ROWS) -> DataFrame | None:
    """Keys of more than ``limit`` rows on a side, with their rows on both (``_nl``, ``_nr``), or None."""
    counts = [_present(df, keys).groupBy(*keys).agg(F.count("*").alias(n)) for df, n in ((left, "_nl"), (right, "_nr"))]
    both = counts[0].join(counts[1], list(keys), "full_outer").na.fill(0, ["_nl", "_nr"])
    hot = both.where((F.col("_nl") > limit) | (F.col("_nr") > limit))
    return None if hot.isEmpty() else checkpointed(hot)


def listed(hot: DataFrame, *columns: str) -> DataFrame:
    """A stored list of hot keys, broadcast if its rows, which are counted, are few."""
    frame = hot.select(*columns) if columns else hot
    return F.broadcast(frame) if hot.count() <= HOT_LIST_ROWS else frame


def grid_join(left: DataFrame, right: DataFrame, keys: Sequence[str], hot: DataFrame, cell_rows: int = HOT_ROWS) -> DataFrame:
    """Inner join of the rows of ``hot`` keys, cut into cells.

    The left rows of a key are dealt over as many lines of a grid as they fill,
    the right rows over columns; a left row goes to every column of its line, a
    right row to every line of its column, so each pair meets in one cell of
    about ``cell_rows`` rows a side.  A row's line follows from its content, so
    a task that runs again deals it alike.
    """
    keys = list(keys)
    sizes = listed(hot.select(*keys, F.ceil(F.col("_nl") / cell_rows).cast("int").alias("_lines"),
                              F.ceil(F.col("_nr") / cell_rows).cast("int").alias("_columns")))

    def dealt(df: DataFrame, own: str, other: str, at: str, over: str) -> DataFrame:
        place = F.pmod(F.xxhash64(*df.columns), F.col(own)).cast("int")
        wide = df.join(sizes, keys).where((F.col(own) > 0) & (F.col(other) > 0))
        return wide.withColumns({at: place, over: F.explode(F.sequence(F.lit(0), F.col(other) - 1))}).drop("_lines", "_columns")

    return dealt(left, "_lines", "_columns", "_line", "_column").join(
        dealt(right, "_columns", "_lines", "_column", "_line"), [*keys, "_line", "_column"]).drop("_line", "_column")


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], hot: DataFrame | None = None,
                 cell_rows: int = HOT_ROWS) -> DataFrame:
    """Inner equi-join in which no key's rows, however many on either side, meet in one task.

    Cold keys take the ordinary join, the keys of ``hot`` (from
    ``hot_on_either``) the grid; both parts are then stacked.
    """
    keys = list(keys)
    if hot is None:
        return left.join(right, keys)
    names = listed(hot, *keys)
    cold = left.join(names, keys, "left_anti").join(right.join(names, keys, "left_anti"), keys)
    return cold.unionByName(grid_join(left, right, keys, hot, cell_rows))


def _in_ranges(df: DataFrame, groups: Sequence[str], order: Sequence) -> DataFrame:
    """Rows range-partitioned by group and order, with their range and place;
    checkpointed, because a repeated sampling could move the range bounds."""
    parts = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    ranged = df.repartitionByRange(int(parts), *groups, *order).sortWithinPartitions(*groups, *order)
    return checkpointed(ranged.withColumns({"_range": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}))


def _add_range_cells(laid: DataFrame, cells: DataFrame, groups: Sequence[str]) -> DataFrame:
    condition = F.col("a._range") == F.col("b._range")
    for g in groups:
        condition = condition & F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}"))
    extra = [c for c in cells.columns if c not in (*groups, "_range")]
    return laid.alias("a").join(maybe_broadcast(cells).alias("b"), condition).select("a.*", *[F.col(f"b.{c}").alias(c) for c in extra])


def running_sum(df: DataFrame, value: str, groups: Sequence[str], order: Sequence, name: str,
                group_rows_limit: int = HOT_ROWS) -> DataFrame:
    """Running sum per group in a total order; large groups are summed per
    range, plus the sums of the ranges before."""
    groups = list(groups)
    window = lambda *keys: W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    if groups and hot_keys(df, groups, group_rows_limit) is None:
        return df.withColumn(name, F.sum(value).over(window(*groups)))
    laid = _in_ranges(df, groups, order)
    cells = laid.groupBy(*groups, "_range").agg(F.sum(value).alias("_sum"))
    before = W.partitionBy(*(groups or [F.lit(1)])).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    cells = cells.withColumn("_before", F.sum("_sum").over(before)).drop("_sum")
    joined = _add_range_cells(laid, cells, groups)
    within = F.sum(value).over(window(*groups, "_range"))
    # As in one window: null until the first value of the group, which may stand in a range before.
    total = F.when(within.isNull(), F.col("_before")).otherwise(within + F.coalesce("_before", F.lit(0)))
    return joined.withColumn(name, total).select(*df.columns, name)


def number_rows(df: DataFrame, groups: Sequence[str], order: Sequence, name: str = "row_number",
                group_rows_limit: int | None = HOT_ROWS) -> DataFrame:
    """1-based row number per group in an order that must be total.

    Without large groups this is the window function (``group_rows_limit`` None:
    none is looked for).  Otherwise (and for a
    numbering over all rows) rows are range-partitioned by group and order,
    the layout is checkpointed so that it cannot change, and numbers are made
    of the place inside a range plus the rows of the ranges before it.
    """
    groups = list(groups)
    if groups and (group_rows_limit is None or hot_keys(df, groups, group_rows_limit) is None):
        return df.withColumn(name, F.row_number().over(W.partitionBy(*groups).orderBy(*order)))
    laid = _in_ranges(df, groups, order)
    cells = laid.groupBy(*groups, "_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    before = W.partitionBy(*(groups or [F.lit(1)])).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    cells = cells.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")
    joined = _add_range_cells(laid, cells, groups)
    number = F.col("_before") + F.col("_at") - F.col("_first") + 1
    return joined.select(*df.columns, number.alias(name))


def carried_forward(df: DataFrame, value: str, order: Sequence, name: str) -> DataFrame:
    """The last value present up to each row of a total order over all rows.

    Rows stay in ranges of the order; a range that begins without a value
    takes the last one of the ranges before.
    """
    laid = _in_ranges(df, [], order)
    cells = laid.groupBy("_range").agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col("_at"))).alias("_last"))
    before = W.partitionBy(F.lit(1)).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    cells = cells.withColumn("_carry", F.last("_last", ignorenulls=True).over(before)).drop("_last")
    joined = _add_range_cells(laid, cells, [])
    within = F.last(value, ignorenulls=True).over(W.partitionBy("_range").orderBy("_at").rowsBetween(W.unboundedPreceding, 0))
    return joined.withColumn(name, F.coalesce(within, F.col("_carry"))).select(*df.columns, name)


def next_value(df: DataFrame, value: str, order: Sequence, name: str) -> DataFrame:
    """The value of the following row in a total order over all rows, by a join on row numbers."""
    numbered = number_rows(df, [], order, "_n")
    following = numbered.select((F.col("_n") - 1).alias("_n"), F.col(value).alias(name))
    return numbered.join(following, "_n", "left").select(*df.columns, name)
