"""Exact group quantiles by radix selection: no group, however large, meets in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

# Bits of a value's fraction in its order key, and of the key left out by the first and the second digit.
FRACTION_BITS, FIRST_SHIFT, SECOND_SHIFT = 36, 30, 16
EXPONENT_OFFSET = 1100


def quantile_name(probability: float) -> str:
    return "q" + format(probability, ".4f").replace(".", "_")


def order_key(x: Column) -> Column:
    """A whole number that never falls as the value rises: sign, binary exponent, leading bits of the fraction.

    The exponent may come out one too high next to a power of two; the
    fraction is then cut to zero, so that the order holds.
    """
    size = F.abs(x)
    exponent = F.floor(F.log2(size))
    fraction = size / F.pow(F.lit(2.0), exponent.cast("double")) - 1
    bits = F.least(F.greatest(F.floor(fraction * float(1 << FRACTION_BITS)), F.lit(0)), F.lit((1 << FRACTION_BITS) - 1))
    key = (exponent + EXPONENT_OFFSET) * (1 << FRACTION_BITS) + bits
    endless = F.lit(2 * EXPONENT_OFFSET << FRACTION_BITS).cast("long")
    key = F.when(F.isnan(x), endless + 1).when(size == float("inf"), endless).when(size > 0, key).otherwise(F.lit(0).cast("long"))
    return F.when(x < 0, -key).otherwise(key)


def _same(names: Sequence[str], left: str, right: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}")) for n in names])


def exact_group_quantiles(df: DataFrame, keys: Sequence[str], value: Column, probabilities: Sequence[float]) -> DataFrame:
    """Interpolated (type 7) quantiles per group, one column per probability.

    Values of a group are counted by the first digit of their order key, which
    tells the digits of the wanted ranks; values with those digits are counted
    by the next one, and only what shares both is ranked, by distinct value.
    All counts combine on the map side, and the passes behind the first one
    keep few rows: those that share a digit with a wanted rank.
    """
    keys = list(keys)
    data = df.select(*keys, value.cast("double").alias("_x")).where(F.col("_x").isNotNull())
    data = data.withColumn("_key", order_key(F.col("_x"))).select(
        *keys, "_x", F.shiftright("_key", FIRST_SHIFT).alias("_first"), F.shiftright("_key", SECOND_SHIFT).alias("_second"))

    def located(counts: DataFrame, wanted: DataFrame, within: Sequence[str], digit: str) -> DataFrame:
        """The wanted ranks with their digit; ranks count from the beginning of what shares it."""
        upto = W.partitionBy(*keys, *within).orderBy(digit).rowsBetween(W.unboundedPreceding, W.currentRow)
        counts = counts.withColumn("_upto", F.sum("_rows").over(upto))
        found = counts.alias("c").join(wanted.alias("w"), _same([*keys, *within], "c", "w") & (F.col("w._rank") < F.col("c._upto"))
                                       & (F.col("w._rank") >= F.col("c._upto") - F.col("c._rows")))
        return found.select(*[F.col(f"c.{k}").alias(k) for k in keys], F.col(f"c.{digit}").alias(digit), "q", "share", "side",
                            (F.col("w._rank") - F.col("c._upto") + F.col("c._rows")).alias("_rank"))

    def sharing(wanted: DataFrame, digit: str) -> DataFrame:
        """Values that share the digit of a wanted rank."""
        places = wanted.select(*keys, digit).distinct()
        return data.alias("d").join(places.alias("p"), _same([*keys, digit], "d", "p"), "left_semi")

    counts = data.groupBy(*keys, "_first").agg(F.count("*").alias("_rows"))
    place = F.col("_p.p") * (F.col("_n") - 1)
    wanted = counts.groupBy(*keys).agg(F.sum("_rows").alias("_n")).withColumn(
        "_p", F.explode(F.array(*[F.struct(F.lit(i).alias("q"), F.lit(float(p)).alias("p")) for i, p in enumerate(probabilities)])))
    wanted = wanted.withColumn("side", F.explode(F.array(F.lit(0), F.lit(1)))).select(
        *keys, "_p.q", "side", (place - F.floor(place)).alias("share"), F.least(F.floor(place) + F.col("side"), F.col("_n") - 1).alias("_rank"))
    wanted = located(counts, wanted, [], "_first")
    second = sharing(wanted, "_first").groupBy(*keys, "_first", "_second").agg(F.count("*").alias("_rows"))
    wanted = located(second, wanted, ["_first"], "_second")
    last = sharing(wanted, "_second").groupBy(*keys, "_second", "_x").agg(F.count("*").alias("_rows"))
    picked = located(last, wanted, ["_second"], "_x")
    out = []
    for i, p in enumerate(probabilities):
        low, high = (F.max(F.when((F.col("q") == i) & (F.col("side") == side), F.col("_x"))) for side in (0, 1))
        share = F.max(F.when(F.col("q") == i, F.col("share")))
        # No difference is taken of equal ends, which may be infinite.
        out.append(F.when(low == high, low).otherwise(low + share * (high - low)).alias(quantile_name(p)))
    return picked.groupBy(*keys).agg(*out)
