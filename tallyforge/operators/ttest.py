"""Target group against parent group comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .predicates import field_type, require_columns, sheet_rows, spec_predicate, split_conditions, text_of

DEFAULT_CRITICAL_VALUE = 1.96
CRITICAL_RANGE = (1.28, 3.89)


def _moments(x: Column, name: str) -> list[Column]:
    return [
        F.sum(x).alias(f"{name}_t"),
        F.count(x).alias(f"{name}_n"),
        (F.var_pop(x) * F.count(x)).alias(f"{name}_css"),
    ]


def _summaries(df: DataFrame, targets, parents, inputs: Sequence[str], t_cond: Column, p_cond: Column):
    """Target and parent moments of all inputs from one scan.

    Rows are reduced to (parent, target) groups first; parent moments are then
    merged from those, so the wide rows are shuffled once as partial
    aggregates however large a parent is.
    """
    keys = list(dict.fromkeys([*parents, *targets]))
    aggs = [F.count(F.when(t_cond, F.lit(1))).alias("_t_rows"), F.count(F.when(p_cond, F.lit(1))).alias("_p_rows")]
    for i, name in enumerate(inputs):
        x = F.col(name).cast("double")
        aggs += _moments(F.when(t_cond, x), f"_t{i}") + _moments(F.when(p_cond, x), f"_p{i}")
        aggs.append(F.count(F.when(t_cond & x.isNull(), F.lit(1))).alias(f"_miss{i}"))
    cells = df.where(t_cond | p_cond).groupBy(*keys).agg(*aggs)
    merged = []
    for i in range(len(inputs)):
        t, n, css = (F.col(f"_p{i}_{m}") for m in ("t", "n", "css"))
        total, count = F.sum(t), F.sum(n)
        merged += [
            total.alias(f"_p{i}_t"), count.alias(f"_p{i}_n"),
            F.greatest(F.sum(css) + F.sum(F.try_divide(t * t, n)) - F.try_divide(total * total, count),
                       F.lit(0.0)).alias(f"_p{i}_css"),
        ]
    parent = cells.where(F.col("_p_rows") > 0).groupBy(*parents).agg(*merged)
    keep = [c for c in cells.columns if not c.startswith("_p")]
    target = cells.where(F.col("_t_rows") > 0).select(*keep)
    return target, parent


def _decision(i: int, critical: float, round_value: float) -> tuple[Column, Column, Column]:
    """(code, t value, standard error) for input number ``i``."""
    t_t, t_n, t_css = (F.col(f"_t{i}_{m}") for m in ("t", "n", "css"))
    p_t, p_n, p_css = (F.col(f"_p{i}_{m}") for m in ("t", "n", "css"))
    rest = p_n - t_n
    numerator = F.when(p_n == t_n, F.lit(0.0)).otherwise(
        p_css - t_css + F.try_divide(p_t * p_t, p_n) - F.try_divide(t_t * t_t, t_n)
        - F.try_divide((p_t - t_t) * (p_t - t_t), rest))
    numerator = F.when(numerator > 0, numerator).otherwise(F.lit(0.0))
    error = F.when(rest > 1, F.try_divide(F.sqrt(F.try_divide(numerator * rest, rest - 1)), p_n)).otherwise(F.lit(0.0))
    t_mean, p_mean = F.try_divide(t_t, t_n), F.try_divide(p_t, p_n)
    value = (
        F.when(error > 0, F.try_divide(t_mean - p_mean, error))
        .when((rest > 1) & (t_mean > p_mean), F.lit(10.0 * critical))
        .when((rest > 1) & (t_mean < p_mean), F.lit(-10.0 * critical))
        .otherwise(F.lit(0.0))
    )
    # The rounded means agree: truncation toward zero, so the test is
    # asymmetric for negative means.
    scale = 1.0 / round_value
    agree = (F.lit(0.5) + F.lit(scale) * p_mean).cast("bigint") == (
        F.lit(0.5) + F.lit(scale) * t_mean).cast("bigint")
    code = F.when(agree, 2).when(value < -critical, 1).when(value > critical, 3).otherwise(2)
    return code, value, error


def _checked(target: DataFrame, targets, parents, n_inputs: int) -> DataFrame:
    """Raise inside the plan on missing inputs, orphan targets and targets
    with several parents; no extra job is run."""
    no_target = F.lit(True)
    for t in targets:
        no_target = no_target & F.col(t).isNull()
    orphan = F.lit(False)
    for p in parents:
        orphan = orphan | F.col(p).isNull()
    missing = F.lit(0)
    for i in range(n_inputs):
        missing = missing + F.col(f"_miss{i}")
    per_target = target.groupBy(*targets).agg(F.count("*").alias("_parents"))
    joined = target.join(per_target, list(targets), "left")
    guard = (
        F.when(missing > 0, F.raise_error(F.lit("missing input variable under the target filter")))
        .when(orphan & ~no_target, F.raise_error(F.lit("some target groups have no parent group")))
        .when(F.col("_parents") > 1,
              F.raise_error(F.lit("some target groups belong to more than one parent group")))
        .otherwise(F.lit(True))
    )
    return joined.where(guard.cast("boolean"))


def _with_parent(target: DataFrame, parent: DataFrame, parents, check: bool) -> DataFrame:
    """Join of targets with their parents.

    Under checks the join is null-safe: an ordinary one would drop targets
    without parent before the check could see them.
    """
    if not check:
        return target.join(parent, list(parents))
    renamed = parent.withColumnsRenamed({p: f"_key_{p}" for p in parents})
    test = F.lit(True)
    for p in parents:
        test = test & F.col(p).eqNullSafe(F.col(f"_key_{p}"))
    return target.join(renamed, test)


def ttest_level(df: DataFrame, targets: Sequence[str], parents: Sequence[str], input_col: str, output_col: str,
                critical: float = DEFAULT_CRITICAL_VALUE, target_where: Column | None = None,
                parent_where: Column | None = None, round_value: float = 1.0, check: bool = True,
                details: bool = False) -> DataFrame:
    """Code 1 (below), 2 (same) or 3 (above) per target group against its parent."""
    if not targets or not parents:
        raise ValueError("target and parent group columns are needed")
    for name in (*targets, *parents, input_col):
        field_type(df, name)
    t_cond = F.lit(True) if target_where is None else F.coalesce(target_where, F.lit(False))
    p_cond = F.lit(True) if parent_where is None else F.coalesce(parent_where, F.lit(False))
    target, parent = _summaries(df, targets, parents, [input_col], t_cond, p_cond)
    if check:
        target = _checked(target, targets, parents, 1)
    for t in targets:
        target = target.where(F.col(t).isNotNull())
    code, value, error = _decision(0, critical, round_value)
    keys = list(dict.fromkeys([*parents, *targets]))
    columns = [F.col(k) for k in keys] + [code.cast("int").alias(output_col)]
    if details:
        columns += [value.alias("ttest_value"), error.alias("ttest_se"),
                    F.try_divide("_t0_t", "_t0_n").alias("target_mean"),
                    F.try_divide("_p0_t", "_p0_n").alias("parent_mean"),
                    F.col("_t0_n").alias("target_n"), F.col("_p0_n").alias("parent_n")]
    return _with_parent(target, parent, parents, check).select(*columns)


TTEST_COLUMNS = ("outputvar", "inputvar", "targetlevel", "targetid", "wheret", "wheret_value",
                 "parentlevel", "parentid", "wherep", "wherep_value", "critval")


def ttest(df: DataFrame, sheet, check: bool = True) -> dict[str, DataFrame]:
    """Control-sheet t-tests: one output per target level, one column per row.

    All inputs that share target, parent and filters come from one scan.
    """
    rows = sheet_rows(sheet)
    require_columns(rows, TTEST_COLUMNS, "t-test sheet")
    levels: dict[str, dict] = {}
    for line, row in enumerate(rows, start=1):
        critical = float(row["critval"])
        if not CRITICAL_RANGE[0] <= critical <= CRITICAL_RANGE[1]:
            raise ValueError(f"line {line}: critical value {critical} is outside {CRITICAL_RANGE}")
        split_conditions(row["wheret"], row["wheret_value"])
        split_conditions(row["wherep"], row["wherep_value"])
        for name in (row["inputvar"], row["targetid"], row["parentid"]):
            field_type(df, text_of(name))
        target = text_of(row["targetlevel"]).lower()
        parent = text_of(row["parentlevel"]).lower()
        t_key = (text_of(row["targetid"]), text_of(row["wheret"]), text_of(row["wheret_value"]))
        p_key = (text_of(row["parentid"]), text_of(row["wherep"]), text_of(row["wherep_value"]))
        level = levels.setdefault(target, {"key": t_key, "parents": {}})
        if level["key"][:2] != t_key[:2]:
            raise ValueError(f"line {line}: target id and filter of level {target} must not change")
        group = level["parents"].setdefault(parent, {"key": p_key, "rows": []})
        if group["key"][:2] != p_key[:2]:
            raise ValueError(f"line {line}: parent id and filter of level {parent} must not change")
        group["rows"].append((text_of(row["outputvar"]), text_of(row["inputvar"]), critical))
    out = {}
    for name, level in levels.items():
        target_id, wheret, values = level["key"]
        t_cond = F.coalesce(spec_predicate(df, wheret, values), F.lit(False))
        result = df.where(t_cond & F.col(target_id).isNotNull()).select(target_id).distinct()
        for group in level["parents"].values():
            parent_id, wherep, p_values = group["key"]
            p_cond = F.coalesce(spec_predicate(df, wherep, p_values), F.lit(False))
            inputs = list(dict.fromkeys(r[1] for r in group["rows"]))
            target, parent = _summaries(df, [target_id], [parent_id], inputs, t_cond, p_cond)
            if check:
                target = _checked(target, [target_id], [parent_id], len(inputs))
            codes = [
                _decision(inputs.index(source), critical, 1.0)[0].cast("int").alias(output)
                for output, source, critical in group["rows"]
            ]
            target = target.where(F.col(target_id).isNotNull())
            part = _with_parent(target, parent, [parent_id], check).select(target_id, *codes)
            result = result.join(part, target_id, "left")
        out[name] = result
    return out
