"""Conditional group statistics driven by a control sheet."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .predicates import equals_value, field_type, sheet_rows, spec_predicate, split_conditions, text_of
from .quantiles import exact_group_quantiles, quantile_name
from .skew import running_sum

DEFAULT_ROUNDING = 12
MAX_NAME_LENGTH = 128
AGGREGATES_PER_PASS = 150

_NAME = re.compile(r"[A-Za-z_#@][A-Za-z0-9_#@$ ]*\Z")

QUANTILES = {
    "MEDIAN": (0.5,), "P50": (0.5,), "Q1": (0.25,), "P25": (0.25,), "Q3": (0.75,), "P75": (0.75,),
    "P1": (0.01,), "P5": (0.05,), "P10": (0.10,), "P90": (0.90,), "P95": (0.95,), "P99": (0.99,),
    "QRANGE": (0.25, 0.75),
}
PLAIN = {
    "N", "MEAN", "SUM", "MIN", "MAX", "NMISS", "STD", "STDDEV", "VAR", "SKEW", "SKEWNESS", "KURT",
    "KURTOSIS", "STDERR", "RANGE", "CSS", "USS", "CV", "T", "LCLM", "UCLM", "PROBT", "SUMWGT",
}
# A statistic that stands for two: endings of the output names, and what they are.
TWO_VALUED = {"CLM": {"_lclm": "LCLM", "_uclm": "UCLM"}}
ROUNDED = {"MEAN", "STD", "STDDEV", "VAR", "PERCENT"}


@dataclass(frozen=True)
class StatSpec:
    name: str
    level: str
    kind: str
    input: str
    condition: Column
    denominator: Column | None
    rounding: int


def _check_name(name: str) -> str:
    if not name or len(name) > MAX_NAME_LENGTH or not _NAME.match(name):
        raise ValueError(f"{name!r} is not a valid output column name")
    return name


def _rounding(value, line: int) -> int:
    text = text_of(value)
    if text in ("", "."):
        return DEFAULT_ROUNDING
    try:
        digits = float(text)
    except ValueError:
        raise ValueError(f"line {line}: rdvalue must be missing or a number >= 0") from None
    if digits < 0:
        raise ValueError(f"line {line}: rdvalue must be missing or a number >= 0")
    return int(digits)


def compile_stat_specs(df: DataFrame, sheet=(), percent_sheet=()) -> list[StatSpec]:
    """Validate the means and percent sheets and compile their conditions."""
    specs: list[StatSpec] = []
    for line, row in enumerate(sheet_rows(sheet), start=1):
        kind = text_of(row.get("type")).upper()
        if not kind:
            continue
        if kind not in PLAIN and kind not in QUANTILES and kind not in TWO_VALUED:
            raise ValueError(f"line {line}: {kind} is not a known statistic")
        source = text_of(row.get("inputvar"))
        if kind != "N":
            field_type(df, source)
        specs += [StatSpec(
            _check_name(text_of(row["variable_name"]) + ending), text_of(row["levelvar"]), one, source,
            spec_predicate(df, row.get("wherevar"), row.get("wherevalue")), None,
            _rounding(row.get("rdvalue"), line)) for ending, one in TWO_VALUED.get(kind, {"": kind}).items()]
    for line, row in enumerate(sheet_rows(percent_sheet), start=1):
        specs.append(StatSpec(
            _check_name(text_of(row["variable_name"])), text_of(row["levelvar"]), "PERCENT", "",
            spec_predicate(df, row.get("numeratorvariable"), row.get("numeratorvalue")),
            spec_predicate(df, row.get("denominatorvariable"), row.get("denominatorvalue")),
            _rounding(row.get("rdvalue"), line)))
    names = [s.name.lower() for s in specs]
    repeated = {n for n in names if names.count(n) > 1}
    if repeated:
        raise ValueError(f"output names used twice: {sorted(repeated)}")
    for spec in specs:
        field_type(df, spec.level)
    return specs


def _count(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def student_t_critical(degrees: int, two_sided: float) -> float:
    """Critical value for whole degrees of freedom, by bisection on the finite
    trigonometric form of the distribution function."""

    def inside(t: float) -> float:
        angle = math.atan(t / math.sqrt(degrees))
        cos2, odd = math.cos(angle) ** 2, degrees % 2
        term, series = (math.cos(angle), 0.0) if odd else (1.0, 0.0)
        for k in range(1 + odd, degrees, 2):
            series += term
            term *= cos2 * k / (k + 1)
        if odd:
            return 2 / math.pi * (angle + math.sin(angle) * series)
        return math.sin(angle) * series

    low, high = 0.0, 1e6
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if inside(middle) < 1 - two_sided else (low, middle)
    return (low + high) / 2


def student_t_quantile(degrees: Column, two_sided: float = 0.05) -> Column:
    """Critical value of Student's t: tabulated to 100 degrees of freedom, by
    the expansion around the normal deviate above."""
    z = NormalDist().inv_cdf(1 - two_sided / 2)
    table = F.array(*[F.lit(student_t_critical(v, two_sided)) for v in range(1, 101)])
    terms = (
        z,
        (z**3 + z) / 4,
        (5 * z**5 + 16 * z**3 + 3 * z) / 96,
        (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384,
    )
    inverse = F.try_divide(F.lit(1.0), degrees)
    series = F.lit(terms[3])
    for term in reversed(terms[:3]):
        series = series * inverse + F.lit(term)
    return F.when(degrees.between(1, 100), F.try_element_at(table, degrees.cast("int"))).when(degrees > 100, series)


# Beyond these degrees of freedom the distribution is that of this many (tail areas differ by less than 1e-6).
MOST_DEGREES = 1_000_000


def _log_gamma(z: Column) -> Column:
    """Stirling's series behind eight steps of the recurrence; z > 0."""
    shifted = z + 8
    inverse = F.lit(1.0) / shifted
    square = inverse * inverse
    series = inverse * (1 / 12 - square * (1 / 360 - square * (1 / 1260 - square * (1 / 1680))))
    steps = F.log(z)
    for i in range(1, 8):
        steps = steps + F.log(z + i)
    return (shifted - 0.5) * F.log(shifted) - shifted + 0.5 * math.log(2 * math.pi) + series - steps


def _beta_fraction(x: Column, a: Column, b: Column, steps: Column) -> Column:
    """Continued fraction of the incomplete beta function by convergents' ratios, two terms a step."""
    tiny = 1e-300

    def turn(state: Column, factor: Column) -> Column:
        c = F.lit(1.0) + F.try_divide(factor, state["c"])
        d = F.lit(1.0) + factor * state["d"]
        c, d = (F.when(F.abs(v) < tiny, F.lit(tiny)).otherwise(v) for v in (c, d))
        d = F.lit(1.0) / d
        return F.struct(c.alias("c"), d.alias("d"), (state["h"] * c * d).alias("h"))

    def step(state: Column, m: Column) -> Column:
        even = m * (b - m) * x / ((a + m * 2 - 1) * (a + m * 2))
        odd = -(a + m) * (a + b + m) * x / ((a + m * 2) * (a + m * 2 + 1))
        return turn(turn(state, even), odd)

    d = F.lit(1.0) - (a + b) * x / (a + 1)
    d = F.lit(1.0) / F.when(F.abs(d) < tiny, F.lit(tiny)).otherwise(d)
    start = F.struct(F.lit(1.0).alias("c"), d.alias("d"), d.alias("h"))
    return F.aggregate(F.transform(F.sequence(F.lit(1), steps), lambda m: m.cast("double")), start, step, lambda state: state["h"])


def _with(values: dict[str, Column], formula) -> Column:
    """A formula over values that are computed once (and kept out of the generated code, which it would overfill)."""
    bound = F.array(F.struct(*[v.alias(n) for n, v in values.items()]))
    return F.element_at(F.transform(bound, lambda s: formula(**{n: s[n] for n in values})), 1)


def incomplete_beta(x: Column, a: Column, b: Column) -> Column:
    """The regularised incomplete beta function for 0 <= x <= 1; the number of steps grows with the root of a + b."""
    return _with({"x": x, "a": a, "b": b}, _incomplete_beta)


def _incomplete_beta(x: Column, a: Column, b: Column) -> Column:
    front = F.exp(_log_gamma(a + b) - _log_gamma(a) - _log_gamma(b) + a * F.log(x) + b * F.log(F.lit(1.0) - x))
    steps = (F.lit(25.0) + F.sqrt(a + b) * 2).cast("int")
    near = x < (a + 1) / (a + b + 2)
    inside = F.when(near, front * _beta_fraction(x, a, b, steps) / a).otherwise(
        F.lit(1.0) - front * _beta_fraction(F.lit(1.0) - x, b, a, steps) / b)
    return F.when(x <= 0, F.lit(0.0)).when(x >= 1, F.lit(1.0)).otherwise(inside)


def student_t_tails(t: Column, degrees: Column) -> Column:
    """Chance that Student's t lies at least as far from zero as ``t``."""
    return _with({"t": t, "v": F.least(degrees.cast("double"), F.lit(float(MOST_DEGREES)))}, lambda t, v: F.when(
        v > 0, incomplete_beta(v / (v + t * t), v / 2, F.lit(0.5))))


def stat_column(spec: StatSpec, missing: str = "reference") -> Column:
    """Aggregate expression of one spec (quantiles have a way of their own)."""
    cond, kind = spec.condition, spec.kind
    n_rows = _count(cond)
    if kind == "N":
        return n_rows
    if kind == "PERCENT":
        base = _count(spec.denominator)
        return F.round(F.try_divide(n_rows, base) * 100, spec.rounding)
    raw = F.col(spec.input)
    x = F.when(cond, raw.cast("double"))
    n = F.count(x)
    total = n if missing == "skip" else n_rows
    if kind == "NMISS":
        return _count(cond & raw.isNull())
    if kind == "SUMWGT":
        return n.cast("double")  # the sheet has no weights, so each value weighs one
    if kind == "MIN":
        return F.min(F.when(cond, raw))
    if kind == "MAX":
        return F.max(F.when(cond, raw))
    plain_sum = F.sum(F.when(cond, raw.cast("double")).otherwise(F.lit(0.0)))
    if kind == "SUM":
        return plain_sum
    if kind == "MEAN":
        return F.round(F.try_divide(plain_sum, total), spec.rounding)
    mean, css = F.avg(x), F.var_pop(x) * n
    if kind in ("STD", "STDDEV", "VAR"):
        # sum of squares less sum squared over the row count, in a form that
        # does not cancel: css plus the effect of counted missing inputs
        spread = css + n * mean * mean * (F.lit(1.0) - F.try_divide(n, total))
        value = F.when(total > 1, F.try_divide(spread, total - 1))
        if kind != "VAR":
            value = F.sqrt(F.abs(value))
        return F.round(value, spec.rounding)
    if kind in ("SKEW", "SKEWNESS"):
        return F.nanvl(F.skewness(x), F.lit(None).cast("double")) * F.pow(F.try_divide(n - 1, n), 1.5)
    if kind in ("KURT", "KURTOSIS"):
        shrink = F.lit(1.0) - F.try_divide(F.lit(1.0), n)
        return (F.nanvl(F.kurtosis(x), F.lit(None).cast("double")) + 3.0) * shrink * shrink - 3.0
    error = F.try_divide(F.stddev_samp(x), F.sqrt(n))
    if kind == "STDERR":
        return error
    if kind == "RANGE":
        return F.max(x) - F.min(x)
    if kind == "CSS":
        return css
    if kind == "USS":
        return F.sum(x * x)
    if kind == "CV":
        return F.try_divide(F.stddev_samp(x), mean) * 100
    if kind == "T":
        return F.try_divide(mean, error)
    if kind == "PROBT":
        return student_t_tails(F.try_divide(mean, error), n - 1)
    if kind in ("LCLM", "UCLM"):
        half = student_t_quantile(n - 1) * error
        return mean - half if kind == "LCLM" else mean + half
    raise ValueError(f"{kind} is not an aggregate")


def group_stats(df: DataFrame, sheet=(), percent_sheet=(), missing: str = "reference",
                aggregates_per_pass: int = AGGREGATES_PER_PASS) -> dict[str, DataFrame]:
    """One output per level variable, one column per spec row.

    All specs of a level are conditional aggregates of one ``groupBy``, which
    combines on the map side whatever the skew of the level.  ``missing``
    chooses the divisor of MEAN, STD and VAR: ``reference`` counts missing
    inputs, ``skip`` does not.  Quantiles are found by radix selection, all of a
    level at once.
    """
    if missing not in ("reference", "skip"):
        raise ValueError("missing must be 'reference' or 'skip'")
    levels: dict[str, list[StatSpec]] = {}
    for spec in compile_stat_specs(df, sheet, percent_sheet):
        levels.setdefault(spec.level.lower(), []).append(spec)
    return {
        specs[0].level: _one_level(df, specs, missing, aggregates_per_pass)
        for specs in levels.values()
    }


def _one_level(df, specs: Sequence[StatSpec], missing, per_pass) -> DataFrame:
    level = specs[0].level
    rows = df.where(F.col(level).isNotNull())
    quantile_specs = [s for s in specs if s.kind in QUANTILES]
    direct = [s for s in specs if s.kind not in QUANTILES]
    # Every level that has rows is in the result, whatever its specs find there.
    parts = [] if direct else [rows.select(level).distinct()]
    for start in range(0, len(direct), per_pass):
        chunk = direct[start:start + per_pass]
        parts.append(rows.groupBy(level).agg(*[stat_column(s, missing).alias(s.name) for s in chunk]))
    if quantile_specs:
        parts.append(_quantiles(rows, level, quantile_specs))
    out = parts[0]
    for part in parts[1:]:
        out = out.join(part, level, "left")
    return out.select(level, *[s.name for s in specs])


def _quantiles(rows: DataFrame, level: str, specs: Sequence[StatSpec]) -> DataFrame:
    """One selection for all specs: a row is repeated for each different condition and input."""
    values = {(str(s.condition), s.input.lower()): F.when(s.condition, F.col(s.input).cast("double")) for s in specs}
    number = {key: i for i, key in enumerate(values)}
    tagged = F.array(*[F.struct(F.lit(number[key]).alias("_of"), v.alias("_v")) for key, v in values.items()])
    long = rows.select(F.col(level), F.inline(tagged)).where(F.col("_v").isNotNull())
    found = exact_group_quantiles(long, [level, "_of"], F.col("_v"), sorted({p for s in specs for p in QUANTILES[s.kind]}))

    def value(s: StatSpec) -> Column:
        ends = [F.max(F.when(F.col("_of") == number[str(s.condition), s.input.lower()], F.col(quantile_name(p)))) for p in QUANTILES[s.kind]]
        return ends[0] if len(ends) == 1 else ends[1] - ends[0]

    return found.groupBy(level).agg(*[value(s).alias(s.name) for s in specs])


def frequency_distribution(df: DataFrame, value: str, groups: Sequence[str] = ()) -> DataFrame:
    """Count, percent, running count and running percent of non-missing levels.

    Rows are first counted per (group, level); the running sums see one row
    per level only.
    """
    groups = list(groups)
    counts = df.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count("*").alias("freq"))
    if groups:
        part = W.partitionBy(*groups)
        upto = part.orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow)
        counts = counts.withColumns({"_total": F.sum("freq").over(part), "cum_freq": F.sum("freq").over(upto)})
    else:  # levels may be many: ranges of them are summed, never all in one task
        total = counts.agg(F.sum("freq").alias("_total")).withColumn("_one", F.lit(1))
        counts = running_sum(counts, "freq", [], [value], "cum_freq").withColumn("_one", F.lit(1)).join(F.broadcast(total), "_one")
    return counts.select(
        *groups, value, "freq",
        (F.col("freq") / F.col("_total") * 100).alias("percent_freq"), "cum_freq",
        (F.col("cum_freq") / F.col("_total") * 100).alias("cum_percent_freq"),
    )


def distinct_cut(df: DataFrame, keys: Sequence[str], keep: Sequence[str] = (), order: Sequence = (),
                 no_dups: bool = False) -> DataFrame:
    """Distinct keys with the keep columns of each key's first row in order.

    The first row is a ``min_by`` aggregate, so a hot key is combined on the
    map side.  ``no_dups`` raises inside the plan when a key repeats.
    """
    keys, keep = list(keys), list(keep)
    if not keep and not no_dups:
        return df.select(*keys).distinct()
    if keep and not order:
        raise ValueError("keep columns need an order that names the first row")
    aggs = []
    if keep:
        aggs.append(F.min_by(F.struct(*keep), F.struct(*order)).alias("_first"))
    aggs.append(F.count("*").alias("_n"))
    out = df.groupBy(*keys).agg(*aggs)
    columns = [F.col(k) for k in keys] + [F.col(f"_first.{c}").alias(c) for c in keep]
    if no_dups:
        out = out.where(F.when(F.col("_n") > 1, F.raise_error(F.lit("duplicate keys in distinct cut")))
                        .otherwise(F.lit(True)).cast("boolean"))
    return out.select(*columns)


def count_failures(failures: DataFrame, by: Sequence[str] = ("bad_variable", "bad_reason")) -> DataFrame:
    return failures.groupBy(*by).agg(F.count("*").alias("count"))


def list_distinct(frames: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    """Distinct column combinations over several tables (each reduced first)."""
    out = frames[0].select(*columns).distinct()
    for frame in frames[1:]:
        out = out.unionByName(frame.select(*columns).distinct())
    return out.distinct()
