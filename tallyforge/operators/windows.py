"""First rows, numbering, top-k, stacking."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.keys import band_number
from .skew import HOT_ROWS, hot_keys, number_rows, running_sum


def nodupkey(df: DataFrame, keys: Sequence[str], order: Sequence, condition: Column | str | None = None) -> DataFrame:
    """First row per key in an order; rows outside the condition stay.

    The filter on ``row_number`` is a literal, so Spark keeps one row per key
    in every map task before the shuffle, whatever the skew.
    """
    if not order:
        raise ValueError("an order is needed: the first row must be determined by the data")
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    if condition is None:
        return df.withColumn("_rn", rank).where(F.col("_rn") == 1).drop("_rn")
    test = F.coalesce(F.expr(condition) if isinstance(condition, str) else condition, F.lit(False))
    inside = df.where(test).withColumn("_rn", rank).where(F.col("_rn") == 1).drop("_rn")
    return inside.unionByName(df.where(~test))


def nodupkey2(df: DataFrame, first_keys: Sequence[str], second_keys: Sequence[str], order: Sequence,
              condition: Column | str | None = None) -> DataFrame:
    """First row by one key, then by another."""
    return nodupkey(nodupkey(df, first_keys, order, condition), second_keys, order, condition)


def number_in_group(df: DataFrame, groups: Sequence[str], order: Sequence, name: str = "count",
                    page: str | None = "page", page_size: int = 5, page_cap: int = 10,
                    group_rows_limit: int | None = HOT_ROWS) -> DataFrame:
    """Row number per group and the page it falls on; no limit: the groups are known to be small."""
    out = number_rows(df, groups, order, name, group_rows_limit)
    return out if page is None else out.withColumn(page, band_number(F.col(name), page_size, page_cap))


def rank_in_group(df: DataFrame, groups: Sequence[str], order: Sequence, count: int, name: str = "rank") -> DataFrame:
    """Rows whose rank within the group is at most ``count`` (ties share a rank)."""
    ranked = df.withColumn(name, F.rank().over(W.partitionBy(*groups).orderBy(*order)))
    return ranked.where(F.col(name) <= count)


def dedupe_report_rows(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """One report row per key."""
    return nodupkey(df, keys, order)


def running_total(df: DataFrame, value: str, groups: Sequence[str], order: Sequence,
                  name: str = "running_total", group_rows_limit: int = HOT_ROWS) -> DataFrame:
    return running_sum(df, value, groups, order, name, group_rows_limit)


def neighbor_overlap(df: DataFrame, start: str, end: str, order: Sequence, groups: Sequence[str] = (),
                     group_rows_limit: int = HOT_ROWS) -> DataFrame:
    """Rows that end after the next row starts.

    In large groups each row meets its successor by an equi-join on the row
    number, which spreads a group over all tasks.
    """
    groups = list(groups)
    large = hot_keys(df, groups, group_rows_limit) is not None if groups else df.count() > group_rows_limit
    if not large:
        nxt = F.lead(start).over(W.partitionBy(*(groups or [F.lit(1)])).orderBy(*order))
        return df.withColumn("next_start", nxt).where(F.col(end) > F.col("next_start"))
    numbered = number_rows(df, groups, order, "_n", group_rows_limit)
    following = numbered.select(*groups, (F.col("_n") - 1).alias("_n"), F.col(start).alias("next_start"))
    test = reduce(lambda a, b: a & b, [F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}")) for g in groups], F.col("a._n") == F.col("b._n"))
    joined = numbered.alias("a").join(following.alias("b"), test).where(F.col(f"a.{end}") > F.col("b.next_start"))
    return joined.select(*[F.col(f"a.{c}").alias(c) for c in df.columns], F.col("b.next_start").alias("next_start"))


def group_size(df: DataFrame, groups: Sequence[str], name: str = "group_size") -> DataFrame:
    """Adds the size of the row's group: sizes are aggregated first and joined
    back, so a large group is not gathered to be counted."""
    sizes = df.groupBy(*groups).agg(F.count("*").alias(name))
    condition = reduce(lambda a, b: a & b, [F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}")) for g in groups])
    joined = df.alias("a").join(sizes.alias("b"), condition, "left")
    return joined.select(*[F.col(f"a.{c}").alias(c) for c in df.columns], F.col(f"b.{name}").alias(name))


def dense_rank_values(df: DataFrame, column: str, name: str = "dense_rank") -> DataFrame:
    """Dense rank of a column's values over the whole table.

    Only the distinct values are numbered; rows look their number up.
    """
    ranks = number_rows(df.select(column).where(F.col(column).isNotNull()).distinct(), [], [F.col(column)], name)
    return df.join(ranks, column, "left").select(*df.columns, name)


def sorted_export(df: DataFrame, order: Sequence) -> DataFrame:
    """Total order over the output (a range-partitioned sort)."""
    return df.orderBy(*order)


def top_n(df: DataFrame, order: Sequence, n: int = 20) -> DataFrame:
    return df.orderBy(*order).limit(n)


def worst_n_per_report(df: DataFrame, report: Sequence[str], statistic: str, n: int, ties: Sequence[str]) -> DataFrame:
    """The n rows of each report with the largest statistic."""
    order = W.partitionBy(*report).orderBy(F.col(statistic).desc(), *ties)
    return df.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= n).drop("_rn")


def union_all(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    return union_all(frames).distinct()


class ColumnSets(NamedTuple):
    common: list[str]
    left_only: list[str]
    right_only: list[str]


def common_columns(left: DataFrame, right: DataFrame) -> ColumnSets:
    """Shared and one-sided column names, compared without regard to case."""
    names_left = {c.lower() for c in left.columns}
    names_right = {c.lower() for c in right.columns}
    return ColumnSets(
        [c for c in left.columns if c.lower() in names_right],
        [c for c in left.columns if c.lower() not in names_right],
        [c for c in right.columns if c.lower() not in names_left],
    )
