"""Weakest-strand regression over group means."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .predicates import require_columns, sheet_rows, text_of
from .stats import group_stats

CASCADE_COLUMNS = ("outputvar", "subject", "level", "levelvar", "inputvar", "criterion", "wherevar", "wherevalue")


def regression_residual_t(df: DataFrame, columns: list[str]) -> DataFrame:
    """Studentised prediction residual of each column regressed on all others.

    Adds ``t_<column>``; rows with any NULL are left out.  Only the k means
    and the k x k centred cross-products reach the driver, where one small
    system per column is solved; predictions and leverages are expressions.
    """
    rows = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))
    first = rows.agg(F.count("*").alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    n, k = int(first["n"]), len(columns)
    if n <= k:
        raise ValueError(f"{n} complete groups cannot support a regression with {k} coefficients")
    means = [float(first[f"m{i}"]) for i in range(k)]
    centred = [F.col(c) - F.lit(m) for c, m in zip(columns, means)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    products = rows.agg(*[F.sum(centred[i] * centred[j]).alias(f"s{i}_{j}") for i, j in pairs]).first()
    gram = np.zeros((k, k))
    for i, j in pairs:
        gram[i, j] = gram[j, i] = float(products[f"s{i}_{j}"])
    added = {}
    for y, name in enumerate(columns):
        others = [i for i in range(k) if i != y]
        fitted, leverage, rss = F.lit(means[y]), F.lit(1.0 / n), gram[y, y]
        if others:
            sxx, sxy = gram[np.ix_(others, others)], gram[others, y]
            if np.linalg.matrix_rank(sxx) < len(others):
                raise ValueError(f"the other variables are collinear in the regression of {name}")
            inverse = np.linalg.inv(sxx)
            beta = inverse @ sxy
            rss -= float(sxy @ beta)
            for a, i in enumerate(others):
                fitted = fitted + F.lit(float(beta[a])) * centred[i]
                for b, j in enumerate(others):
                    leverage = leverage + F.lit(float(inverse[a, b])) * centred[i] * centred[j]
        variance = max(rss, 0.0) / (n - k)
        scale = F.sqrt(F.lit(variance) * (leverage + F.lit(1.0)))
        added[f"t_{name}"] = F.when(scale > 0, (F.col(name) - fitted) / scale)
    return rows.withColumns(added)


def cascade(df: DataFrame, sheet) -> dict[tuple[str, str], DataFrame]:
    """One output per (level, subject): code 1, 2 or 3 per output variable."""
    rows = sheet_rows(sheet)
    require_columns(rows, CASCADE_COLUMNS, "cascade sheet")
    means_sheet, layouts = [], {}
    for row in rows:
        name = "mean_" + "_".join(text_of(row[c]) for c in ("levelvar", "subject", "inputvar"))
        layouts[name.lower()] = row
        means_sheet.append({
            "variable_name": name, "levelvar": row["levelvar"], "inputvar": row["inputvar"],
            "wherevar": row["wherevar"], "wherevalue": row["wherevalue"], "type": "MEAN", "rdvalue": None,
        })
    out = {}
    for level_var, means in group_stats(df, means_sheet).items():
        names = [c for c in means.columns if c.lower() != level_var.lower()]
        scored = regression_residual_t(means, names)
        tables: dict[tuple[str, str], list] = {}
        for name in names:
            row = layouts[name.lower()]
            limit = float(row["criterion"])
            t = F.col(f"t_{name}")
            code = F.when(t < -limit, 1).when(t > limit, 3).otherwise(2)
            key = (text_of(row["level"]), text_of(row["subject"]))
            tables.setdefault(key, []).append(code.cast("int").alias(text_of(row["outputvar"])))
        for key, codes in tables.items():
            out[key] = scored.select(level_var, *codes)
    return out
