"""District performance summary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class PerformanceSummary(NamedTuple):
    districts: DataFrame
    community: DataFrame
    totals: DataFrame
    community_totals: DataFrame


def performance_summary(df: DataFrame, district: str, grade: str, school_type: str,
                        subjects: Mapping[str, tuple[str, str]], levels: Sequence[str] = ("1", "2", "3", "4", "5"),
                        passing: Sequence[str] = ("3", "4", "5"), community_type: str = "C", digits: int = 1,
                        all_label: str = "All Subjects", schools_label: str = "All Schools",
                        community_label: str = "All Community Schools") -> PerformanceSummary:
    """Tested count and percent at each level per district, grade and subject.

    ``subjects`` maps a subject name to (inclusion flag column, level column).
    The all-subjects row counts rows tested in every subject and the percent
    that passed every one; its percent stands in ``pct_pass``.  Totals over
    all districts and over community districts come from the district counts.
    """
    names = list(subjects)
    tested = {s: F.coalesce(F.col(flag).cast("string").try_cast("int") == 1, F.lit(False))
              for s, (flag, _) in subjects.items()}
    level = {s: F.col(column).cast("string") for s, (_, column) in subjects.items()}
    cells = [
        F.struct(
            F.lit(s).alias("subject"), F.lit(i).alias("suborder"), tested[s].alias("tested"),
            level[s].alias("level"),
            F.coalesce(level[s].isin(list(passing)), F.lit(False)).alias("passed"),
        )
        for i, s in enumerate(names, start=1)
    ]
    every = reduce(lambda a, b: a & b, tested.values())
    passed = reduce(lambda a, b: a & b, [F.coalesce(level[s].isin(list(passing)), F.lit(False)) for s in names])
    cells.append(F.struct(
        F.lit(all_label).alias("subject"), F.lit(99).alias("suborder"), every.alias("tested"),
        F.lit(None).cast("string").alias("level"), passed.alias("passed")))
    is_community = F.coalesce(F.trim(school_type) == community_type, F.lit(False))
    long = df.select(district, grade, is_community.alias("is_community"), F.inline(F.array(*cells)))
    counts = long.where("tested").groupBy(district, grade, "subject", "suborder", "is_community").agg(
        F.count("*").alias("n"),
        *[F.count(F.when(F.col("level") == v, 1)).alias(f"n_level{i}") for i, v in enumerate(levels, start=1)],
        F.count(F.when(F.col("passed"), 1)).alias("n_pass"),
    )
    measures = ["n", *[f"n_level{i}" for i in range(1, len(levels) + 1)], "n_pass"]

    def percents(frame: DataFrame, *keys) -> DataFrame:
        base = F.col("n")
        out = [*keys, "subject", "suborder", F.col("n").alias("tested")]
        for i in range(1, len(levels) + 1):
            value = F.round(F.col(f"n_level{i}") * 100 / base, digits)
            out.append(F.when(F.col("suborder") != 99, value).alias(f"pct_level{i}"))
        out.append(F.round(F.col("n_pass") * 100 / base, digits).alias("pct_pass"))
        return frame.select(*out)

    def total(frame: DataFrame, label: str) -> DataFrame:
        summed = frame.groupBy(grade, "subject", "suborder").agg(*[F.sum(m).alias(m) for m in measures])
        return percents(summed.withColumn("label", F.lit(label)), "label", grade)

    community = counts.where("is_community")
    community_totals = total(community, community_label)
    return PerformanceSummary(
        percents(counts.where(~F.col("is_community")), district, grade),
        percents(community, district, grade),
        total(counts, schools_label).unionByName(community_totals),
        community_totals,
    )
