"""Frequency cells of two data sets and their comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.keys import trim_float_text
from .predicates import require_columns, sheet_rows, text_of

LONGCOMP_COLUMNS = ("variable", "by", "treatas", "matchalgorithm", "tolerance", "tolerancetype",
                    "missing_counted", "max_bad")


def _tagged_cells(frames: Sequence[DataFrame], pairs: Sequence[tuple[str | None, str]]) -> DataFrame:
    """Counts per (report, by value, value, source): one scan per data set."""
    parts = []
    for source, frame in enumerate(frames):
        cells = F.array(*[
            F.struct(
                F.lit(i).alias("report"),
                (trim_float_text(by) if by else F.lit("")).alias("by_value"),
                trim_float_text(name).alias("value"),
            )
            for i, (by, name) in enumerate(pairs)
        ])
        parts.append(frame.select(F.inline(cells)).withColumn("source", F.lit(source)))
    both = parts[0].unionByName(parts[1])
    return both.groupBy("report", "by_value", "value").agg(
        F.count(F.when(F.col("source") == 0, 1)).alias("count0"),
        F.count(F.when(F.col("source") == 1, 1)).alias("count1"),
    )


def crosstab_counts(time0: DataFrame, time1: DataFrame, pairs: Sequence[tuple[str | None, str]]) -> DataFrame:
    """Cells of one-way ``(None, variable)`` and two-way ``(by, variable)`` tables.

    Columns: report, by_value, value, count0, count1, total0, total1, where
    the totals are those of the parent (report, by value).
    """
    cells = _tagged_cells((time0, time1), pairs)
    totals = cells.groupBy("report", "by_value").agg(
        F.sum("count0").alias("total0"), F.sum("count1").alias("total1"))
    return cells.join(totals, ["report", "by_value"])


def likelihood_difference(c0: Column, t0: Column, c1: Column, t1: Column) -> Column:
    """Minus log likelihood ratio of two binomials against the pooled one.

    The binomial coefficients cancel, so this is the exact value also where
    the probabilities themselves would underflow.
    """
    c0, t0, c1, t1 = (x.cast("double") for x in (c0, t0, c1, t1))
    pooled = F.try_divide(c0 + c1, t0 + t1)

    def part(c: Column, t: Column) -> Column:
        own = F.try_divide(c, t)
        hit = F.when(c > 0, c * F.ln(F.try_divide(own, pooled))).otherwise(F.lit(0.0))
        miss = F.when(t - c > 0, (t - c) * F.ln(F.try_divide(F.lit(1.0) - own, F.lit(1.0) - pooled))).otherwise(F.lit(0.0))
        return hit + miss

    return F.when((t0 == 0) | (t1 == 0), F.lit(0.0)).otherwise(part(c0, t0) + part(c1, t1))


def longitudinal_compare(time0: DataFrame, time1: DataFrame, sheet) -> DataFrame:
    """Cells whose share changed by at least the tolerance, worst first.

    Every sheet row is one report; at most ``max_bad`` cells of each are
    kept, which is what the sheet asks for.
    """
    rows = sheet_rows(sheet)
    require_columns(rows, LONGCOMP_COLUMNS, "comparison sheet")
    reports = []
    for number, row in enumerate(rows, start=1):
        max_bad = int(float(row["max_bad"]))
        if max_bad < 1:
            continue
        kind = text_of(row["tolerancetype"]).lower()
        if kind not in ("absolute", "stat"):
            raise ValueError(f"line {number}: unknown tolerance type {kind!r}")
        if text_of(row["treatas"]).lower() not in ("", "nominal"):
            raise ValueError(f"line {number}: cannot treat a variable as {text_of(row['treatas'])!r}")
        if text_of(row["matchalgorithm"]).lower() != "proportion":
            raise ValueError(f"line {number}: unknown match algorithm {text_of(row['matchalgorithm'])!r}")
        by = text_of(row["by"]).lower()
        reports.append({
            "number": number, "by": None if by == "(all)" else by, "name": text_of(row["variable"]).lower(),
            "match": text_of(row["matchalgorithm"]).lower() + "-" + kind, "kind": kind,
            "tolerance": float(row["tolerance"]), "max_bad": max_bad,
        })
    if not reports:
        raise ValueError("no report asks for any row")
    cells = crosstab_counts(time0, time1, [(r["by"], r["name"]) for r in reports])

    def pick(field, cast=None):
        table = F.array(*[F.lit(r[field]) for r in reports])
        value = F.element_at(table, F.col("report") + 1)
        return value.cast(cast) if cast else value

    c0, c1, t0, t1 = (F.col(c) for c in ("count0", "count1", "total0", "total1"))
    share0 = F.coalesce(F.try_divide(c0, t0) * 100, F.lit(0.0))
    share1 = F.coalesce(F.try_divide(c1, t1) * 100, F.lit(0.0))
    is_stat = pick("kind") == "stat"
    two_way = F.element_at(F.array(*[F.lit(r["by"] is not None) for r in reports]), F.col("report") + 1)
    scored = cells.withColumns({
        "base": F.when(is_stat, c0.cast("double")).otherwise(share0),
        "compare": F.when(is_stat, c1.cast("double")).otherwise(share1),
        "diff": F.when(is_stat, likelihood_difference(c0, t0, c1, t1)).otherwise(F.abs(share0 - share1)),
    }).where(
        (F.col("diff") >= pick("tolerance"))
        & ~(two_way & ((F.col("value") == "") | (F.col("by_value") == "")))
    )
    order = W.partitionBy("report").orderBy(F.col("diff").desc(), "by_value", "value")
    most = max(r["max_bad"] for r in reports)
    worst = (
        scored.withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= most)  # a literal bound, so each map task keeps only its own worst rows
        .where(F.col("_rank") <= pick("max_bad"))
    )
    by_names = F.array(*[F.lit(r["by"] or "(all)") for r in reports])
    return worst.select(
        F.element_at(by_names, F.col("report") + 1).alias("ByVariable"),
        F.col("by_value").alias("ByValue"), pick("name").alias("Variable"), F.col("value").alias("Value"),
        pick("match").alias("MatchType"), "base", "compare", "diff", pick("number").alias("Comparison"),
        F.col("total0").alias("baseN"), F.col("total1").alias("compareN"),
    )
