"""Comparison of each district with its listed peers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import to_number
from ..session import maybe_broadcast
from .predicates import require_columns, sheet_rows, text_of
from .stats import group_stats

PEER_COLUMNS = ("outputvar", "inputvar", "subject", "wherevar", "wherevalue", "type")


def peer_join(df: DataFrame, peers: DataFrame, on: str, focal: str = "F1",
              peer_columns: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``df`` once per focal row that lists them in any peer column."""
    columns = list(peer_columns or [c for c in peers.columns if c.lower() != focal.lower()])
    typed = peers.select(F.col(focal).cast("double").alias(focal),
                         *[F.col(c).cast("double").alias(c) for c in columns])
    long = (
        typed.unpivot([focal], columns, "_position", "_peer").where(F.col("_peer").isNotNull())
        .select(focal, "_peer").distinct()
    )
    key = to_number(on)
    return df.withColumn("_peer", key).join(maybe_broadcast(long), "_peer").select(focal, *df.columns)


def peer_compare(df: DataFrame, sheet, peers: DataFrame, district: str = "dcrxid", critical: float = 1.96,
                 focal: str = "F1") -> DataFrame:
    """Peer means and 1/2/3 codes per district.

    Rows of type Mean give the weighted mean of the peers; rows of type TTEST
    compare the district's own mean with it.  One ``groupBy`` over the peer
    rows serves all districts.
    """
    rows = sheet_rows(sheet)
    require_columns(rows, PEER_COLUMNS, "peer sheet")
    if not 1.28 <= critical <= 3.89:
        raise ValueError("the critical value must lie between 1.28 and 3.89")
    specs, subjects, mean_rows, test_rows = [], {}, [], []
    for row in rows:
        kind = text_of(row["type"]).upper()
        source, subject = text_of(row["inputvar"]), text_of(row["subject"])
        where = {"wherevar": row["wherevar"], "wherevalue": row["wherevalue"], "levelvar": district}
        if kind == "MEAN":
            mean_rows.append((text_of(row["outputvar"]), source, subject, text_of(row["wherevar"])))
            specs.append({"variable_name": source, "inputvar": source, "type": "MEAN", "rdvalue": None, **where})
        elif kind == "TTEST":
            test_rows.append((text_of(row["outputvar"]), source, subject, text_of(row["wherevar"])))
            specs.append({"variable_name": source + "_seh", "inputvar": source, "type": "STD", "rdvalue": None, **where})
        else:
            raise ValueError(f"peer sheet type {kind!r} is neither Mean nor TTEST")
        if subject not in subjects:
            subjects[subject] = True
            specs.append({"variable_name": "pweight_" + subject, "inputvar": "", "type": "N", "rdvalue": None, **where})
    own = group_stats(df, specs)[district]
    joined = peer_join(own, peers, district, focal)

    def weight(subject):
        return F.coalesce(F.col("pweight_" + subject), F.lit(0)).cast("double")

    def zero(name):
        return F.coalesce(F.col(name), F.lit(0.0))

    aggs = [F.sum(weight(s)).alias("_count_" + s) for s in subjects]
    for output, source, subject, _ in mean_rows:
        aggs.append(F.sum(weight(subject) * zero(source)).alias(f"_total_{output}"))
    for output, source, subject, _ in test_rows:
        w, spread, mean = weight(subject), zero(source + "_seh"), zero(source)
        aggs.append(F.sum((w - 1) * spread * spread + w * mean * mean).alias(f"_square_{output}"))
    pooled = joined.groupBy(focal).agg(*aggs)
    predictions = {(s, subj, w): o for o, s, subj, w in mean_rows}
    columns = {}
    for output, _, subject, _ in mean_rows:
        n = F.col("_count_" + subject)
        columns["_pred_" + output] = F.try_divide(F.col(f"_total_{output}"), n)
    pooled = pooled.withColumns(columns)
    table = own.withColumn(focal, to_number(district)).join(pooled, focal)
    chosen = [F.col(district)]
    for output, *_ in mean_rows:
        chosen.append(F.round(F.col("_pred_" + output) + F.lit(1e-10), 0).alias(output))
    for output, source, subject, where in test_rows:
        if (source, subject, where) not in predictions:
            raise ValueError(f"TTEST row {output} has no Mean row for {source} / {subject}")
        pred = F.col("_pred_" + predictions[(source, subject, where)])
        n, value = F.col("_count_" + subject), F.col(source)
        inner = F.try_divide(F.col(f"_square_{output}") - n * zero(pred_name(predictions, source, subject, where)) ** 2, n * (n - 1))
        error = F.when(n > 1, F.sqrt(F.greatest(inner, F.lit(0.0))))
        t = F.try_divide(value - pred, error)
        by_sign = F.when(value > pred, 3).when(value < pred, 1).otherwise(2)
        code = (
            F.when(F.round(value, 0) == F.round(pred, 0), 2)
            .when(value.isNull(), 2)
            .when(error.isNotNull() & (error != 0), F.when(t < -critical, 1).when(t > critical, 3).otherwise(2))
            .when(n.isNull() | n.isin(0.0, 1.0), 2)
            .otherwise(by_sign)
        )
        chosen.append(code.cast("int").alias(output))
    return table.select(*chosen)


def pred_name(predictions: dict, source: str, subject: str, where: str) -> str:
    return "_pred_" + predictions[(source, subject, where)]
