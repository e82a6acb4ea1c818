"""Probabilistic record linkage: few needles, a large haystack."""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_names, clean_similarity
from ..session import checkpointed
from .windows import rank_in_group

SIMILARITY_STEPS = 20
# Up to this distance names narrow the search by equal segments.
NEAR_EDITS = 3
# Names up to this length are cut into segments of about equal information, longer ones of equal length.
PROFILED_LENGTH = 128
# Names that name_calibration compares with the whole haystack, unless told otherwise.
CALIBRATION_NAMES = 20


def nominal_frequencies(haystack: DataFrame, column: str, weight: float, total: int | None = None) -> DataFrame:
    """(value, freq): share of the value among present values, to the weight."""
    counts = haystack.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).count()
    total = haystack.agg(F.count(column)).first()[0] if total is None else total
    return counts.select("value", F.pow(F.col("count") / F.lit(float(total)), F.lit(float(weight))).alias("freq"))


def big_nominal_frequency(haystack: DataFrame, column: str, weight: float, approximate: bool = False) -> float:
    """One over the number of distinct values, to the weight."""
    if approximate:
        n = haystack.agg(F.approx_count_distinct(column)).first()[0]
    else:
        n = haystack.where(F.col(column).isNotNull()).select(column).distinct().count()
    return (1.0 / n) ** weight if n else 1.0


def _statistics(haystack: DataFrame, nominal: Mapping[str, float], big_nominal: Mapping[str, float],
                name: tuple[str, str], approximate: bool) -> tuple[dict[str, int], dict[str, float], int]:
    """Present values of the nominal columns, frequencies of the big ones and the longest name, from one aggregate."""
    distinct = F.approx_count_distinct if approximate else F.countDistinct
    wanted = [F.count(c).alias(f"n_{c}") for c in nominal] + [distinct(F.col(c)).alias(f"d_{c}") for c in big_nominal]
    row = haystack.agg(F.max(F.length(clean_names(*name)[0])).alias("longest"), *wanted).first()
    return ({c: row[f"n_{c}"] for c in nominal},
            {c: (1.0 / row[f"d_{c}"]) ** w if row[f"d_{c}"] else 1.0 for c, w in big_nominal.items()}, row["longest"] or 0)


def name_calibration(haystack: DataFrame, first: str, last: str, key: str, weight: float,
                     names: int = CALIBRATION_NAMES) -> list[float]:
    """Chance of a similarity at least as high, for the steps 0..20.

    The first ``names`` names by the key are compared with every haystack
    name; the comparisons are counted per step on the map side.
    """
    sample = (
        haystack.where(F.col(key).isNotNull()).orderBy(F.col(key), F.col(first), F.col(last))
        .select(first, last).limit(names).collect()
    )
    chosen = _constant([list(r) for r in sample], "array<array<string>>")
    straight, _ = clean_names(first, last)
    # cleaned once per row and once per sample name, not once per comparison
    rows = _dealt(haystack.select(straight.alias("_h"))).withColumn("_s", F.explode(
        F.transform(chosen, lambda r: F.struct(*[c.alias(n) for c, n in zip(clean_names(r[0], r[1]), "sx")]))))
    counts = rows.groupBy(_step(F.col("_s.s"), F.col("_s.x"), F.col("_h")).alias("step")).count().collect()
    by_step = {int(r["step"]): r["count"] for r in counts}
    total, upto, out = sum(by_step.values()), 0, [0.0] * (SIMILARITY_STEPS + 1)
    for step in range(SIMILARITY_STEPS, -1, -1):
        upto += by_step.get(step, 0)
        out[step] = (upto / total) ** weight
    return out


def _dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows over enough tasks for work that their bytes do not show."""
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 4 * df.sparkSession.sparkContext.defaultParallelism)
    return df.repartition(parts, *keys)


def _step(straight: Column, swapped: Column, other: Column) -> Column:
    return F.round(F.lit(float(SIMILARITY_STEPS)) * clean_similarity(straight, swapped, other), 0).cast("int")


def _constant(values, schema: str) -> Column:
    """A constant array or struct (folded into the plan as one literal)."""
    return F.from_json(F.lit(json.dumps(values, default=str)), schema)


def find_matches(needles: DataFrame, haystack: DataFrame, nominal: Mapping[str, float],
                 big_nominal: Mapping[str, float], name: tuple[str, str], name_weight: float, calibrate_key: str,
                 cut: float = 1e-16, count: int = 2, out_columns: Sequence[str] = (),
                 blocking: Sequence[str] | None = None, approximate: bool = False,
                 calibration_names: int = CALIBRATION_NAMES) -> DataFrame:
    """Best haystack rows per needle by the product of agreement frequencies.

    The score of a pair is the product of the frequencies of the values the
    two rows share and of the chance of their name similarity; pairs below
    ``cut`` are kept, the best ``count`` per needle by rank.

    No pair that counts is lost.  Pairs are searched by the columns they agree
    on, the largest sets first.  The product of a set says which chance is left to the names, so how
    similar they must be, so how many edits may lie between them.  What must
    be reached is the cut, or the ``count``-th best pair that a larger set has
    given the needle, so small sets mostly need names that are very near.
    Where more than ``NEAR_EDITS`` are allowed, candidates come from an
    equi-join on the values, else on the values and name segments: of the
    distance + 1 segments of one name, at least one stands unchanged, and
    little moved, in the other.  So a set of columns whose values are
    frequent makes candidates of all rows that share them only where almost
    any name with them would be among the best.  ``blocking`` restricts the search to
    rows equal in those columns as well.
    """
    columns = [*big_nominal, *nominal]
    first, last = name
    calibration = name_calibration(haystack, first, last, calibrate_key, name_weight, calibration_names)
    totals, big, longest = _statistics(haystack, nominal, big_nominal, name, approximate)
    used = list(dict.fromkeys([*columns, first, last]))
    n = needles.select(*[F.col(c).alias(f"N_{c}") for c in used]).distinct()
    for c, w in nominal.items():
        freq = nominal_frequencies(haystack, c, w, totals[c]).select(F.col("value").alias(f"N_{c}"), F.col("freq").alias(f"_w_{c}"))
        n = n.join(freq, f"N_{c}", "left").withColumn(f"_w_{c}", F.coalesce(f"_w_{c}", F.lit(1.0)))
    n = n.withColumns({f"_w_{c}": F.lit(f) for c, f in big.items()})
    straight, swapped = clean_names(f"N_{first}", f"N_{last}")
    n = checkpointed(n.withColumns({"_ns": straight, "_nx": swapped, "_n_id": F.monotonically_increasing_id()}))
    h = haystack.select(*[F.col(c).alias(f"H_{c}") for c in dict.fromkeys([*used, *out_columns])])
    h = checkpointed(_dealt(h).withColumns({"_hs": clean_names(f"H_{first}", f"H_{last}")[0], "_h_id": F.monotonically_increasing_id()}))
    least_chance = min(calibration)

    def score(get_n, get_h) -> Column:
        """Product of a pair; names are compared only as far as they matter."""
        product = F.lit(1.0)
        for c in [*nominal, *big_nominal]:
            product = product * F.when(get_n(f"N_{c}") == get_h(f"H_{c}"), get_n(f"_w_{c}")).otherwise(F.lit(1.0))
        chances = F.array(*[F.lit(p) for p in calibration])
        step = _step(get_n("_ns"), get_n("_nx"), get_h("_hs"))
        return F.when(product * F.lit(least_chance) < F.lit(cut), product * F.element_at(chances, step + 1))

    needle_columns = [f"N_{c}" for c in used]
    best, profile = None, _Profile(h)
    for size in range(len(columns), -1, -1):
        masks = [m for m in range(1 << len(columns)) if m.bit_count() == size]
        # Pairs behind the count-th best one need not be found; the rounding of a product must not lose a pair that is level with it.
        reach = n.withColumn("_cut", F.lit(float(cut))) if best is None else n.join(
            best.groupBy("_n_id").agg(F.count("*").alias("_found"), F.max("prob").alias("_worst")).where(F.col("_found") >= count), "_n_id", "left").withColumn(
            "_cut", F.least(F.lit(float(cut)), F.col("_worst") * (1 + 1e-9))).drop("_found", "_worst")
        pairs = _candidates(reach, h, columns, list(blocking or ()), calibration, longest, masks, profile)
        if pairs is None:
            continue
        # The array keeps Spark from working out a score once more for the filter.
        scored = pairs.select("_n_id", "_h_id", F.explode(F.filter(F.array(score(F.col, F.col)), lambda p: p < F.lit(cut))).alias("prob"))
        best = checkpointed(rank_in_group(scored if best is None else best.drop("rank").unionByName(scored), ["_n_id"], [F.col("prob")], count))
    if best is None:
        best = n.select("_n_id").withColumns({"_h_id": F.lit(0), "prob": F.lit(0.0), "rank": F.lit(0)}).where(F.lit(False))
    best = best.join(h, "_h_id").join(n, "_n_id")
    shared = [F.when(F.col(f"N_{c}") == F.col(f"H_{c}"), F.lit(f"{c} matches, ")).otherwise(F.lit("")) for c in columns]
    report = F.concat(*shared, F.concat_ws(" ", f"N_{first}", f"N_{last}"), F.lit(" vs. "),
                      F.concat_ws(" ", f"H_{first}", f"H_{last}"))
    return best.select(*needle_columns, report.alias("report"),
                       *[F.col(f"H_{c}").alias(c) for c in out_columns], "prob", "rank")


def _agreeing(columns: Sequence[str]) -> Column:
    """Bit i is set where the pair agrees on column i."""
    bits = [F.when(F.col(f"N_{c}").cast("string") == F.col(f"H_{c}").cast("string"), F.lit(1 << i)).otherwise(F.lit(0))
            for i, c in enumerate(columns)]
    return reduce(lambda a, b: a + b, bits, F.lit(0))


def _set_of(columns: Sequence[str], mask: int) -> list[str]:
    return [c for i, c in enumerate(columns) if mask >> i & 1]


def _edits(n_columns: Sequence[str], calibration: Sequence[float], longest: int) -> Column:
    """Edits that may lie between the names of a pair that agrees on these columns; NULL: no names are near enough.

    Similarity s and distance d of a name of length L satisfy d <= (1 - s) / s * L, whatever the length of the other.
    """
    product = reduce(lambda a, b: a * b, [F.col(f"_w_{c}") for c in n_columns], F.lit(1.0))
    # The rounding of the product must not lose a pair at the cut.
    chances = F.array(*[F.lit(float(p)) for p in calibration])
    steps = F.size(F.filter(chances, lambda p: product * p * (1 - 1e-9) >= F.col("_cut")))
    least = (steps - F.lit(0.5)) / F.lit(float(SIMILARITY_STEPS))
    most = F.greatest(F.length("_ns"), F.lit(longest), F.lit(NEAR_EDITS + 1))  # no two names are further apart
    reach = F.floor((1 - least) / least * F.length("_ns") + F.lit(1e-6)).cast("int")
    return F.when(steps == 0, most).when(steps < len(calibration), F.least(reach, most))


def _candidates(n: DataFrame, h: DataFrame, columns: Sequence[str], blocking: Sequence[str], calibration: Sequence[float],
                longest: int, masks: Sequence[int], profile: _Profile) -> DataFrame | None:
    """Pairs that agree on exactly the columns of one of the ``masks`` and may reach ``_cut``, each once; None: there are none."""
    here = {m: reduce(lambda a, b: a & b, [F.col(f"N_{c}").isNotNull() for c in [*blocking, *_set_of(columns, m)]], F.lit(True)) for m in masks}
    n = n.withColumns({f"_d{m}": F.when(here[m], _edits(_set_of(columns, m), calibration, longest)) for m in masks})
    # Without any value to join on, only names can find a partner.
    alone = {m: F.coalesce(F.col(f"_d{m}") > NEAR_EDITS, F.lit(False)) if m or blocking else F.lit(False) for m in masks}
    near = {m: F.col(f"_d{m}").isNotNull() & ~alone[m] for m in masks}
    known = n.agg(*[F.max(alone[m]).alias(f"v{m}") for m in masks], *[F.max(F.when(near[m], F.col(f"_d{m}"))).alias(f"d{m}") for m in masks]).first()
    narrow = [c for c in n.columns if not c.startswith("_d")]
    found = []

    def marked(which: Mapping[int, Column], of: Sequence[int]) -> DataFrame:
        return n.select(*narrow, F.filter(F.array(*[F.when(which[m], F.lit(m)) for m in of]), lambda m: m.isNotNull()).alias("_masks")).where(F.size("_masks") > 0)

    if by_values := [m for m in masks if known[f"v{m}"]]:
        found.append(_by_values(marked(alone, by_values), h, columns, blocking, by_values))
    if distances := {m: known[f"d{m}"] for m in masks if known[f"d{m}"] is not None}:
        found.append(_near_names(marked(near, list(distances)), h, columns, blocking, distances, profile))
    return reduce(DataFrame.unionByName, found) if found else None


def _keys(prefix: str, columns: Sequence[str], blocking: Sequence[str], masks: Sequence[int]) -> Column:
    """For each mask the blocking values and those of its columns; a row without one of them has no key for the mask."""
    def key(mask: int) -> Column:
        values = [F.col(f"{prefix}_{c}").cast("string") for c in [*blocking, *_set_of(columns, mask)]]
        full = reduce(lambda a, b: a & b, [v.isNotNull() for v in values], F.lit(True))
        return F.when(full, F.struct(F.lit(mask).alias("_mask"), F.to_json(F.array(*values, F.lit(""))).alias("_key")))

    return F.filter(F.array(*[key(m) for m in sorted(masks)]), lambda k: k.isNotNull())


def _by_values(n: DataFrame, h: DataFrame, columns: Sequence[str], blocking: Sequence[str], masks: Sequence[int]) -> DataFrame:
    """Pairs that agree on exactly the columns of one of the needle's ``_masks``."""
    n_long = n.select("*", F.inline(_keys("N", columns, blocking, masks))).where(F.array_contains("_masks", F.col("_mask"))).drop("_masks")
    joined = _dealt(h.select("*", F.inline(_keys("H", columns, blocking, masks))), "_mask", "_key").join(_dealt(n_long, "_mask", "_key"), ["_mask", "_key"])
    return joined.where(_agreeing(columns) == F.col("_mask")).drop("_mask", "_key")


class _Profile:
    """How much the letters at each place tell, for the names of each length; looked up once, when names are first joined."""

    def __init__(self, h: DataFrame):
        self.h, self.weights = h, None

    def segments(self, distances: Sequence[int]) -> tuple[list[int], dict[str, list[int]]]:
        """All lengths; by ``length-distance`` the bounds of distance + 1 segments of about equal information."""
        if self.weights is None:
            sizes = self.h.select(F.length("_hs").alias("size"), "_hs")
            self.lengths = sorted(r[0] for r in sizes.select("size").distinct().collect())
            letters = sizes.where(F.col("size") <= PROFILED_LENGTH).select("size", F.posexplode(F.split("_hs", "")).alias("at", "letter"))
            same = letters.groupBy("size", "at", "letter").count().groupBy("size", "at").agg(
                (F.sum(F.col("count").cast("double") * F.col("count")) / F.pow(F.sum("count").cast("double"), F.lit(2.0))).alias("share"))
            self.weights = {}
            for r in same.collect():  # at most the square of PROFILED_LENGTH
                self.weights.setdefault(r["size"], {})[r["at"]] = -math.log(min(r["share"], 1.0))
        return self.lengths, {f"{size}-{d}": self._bounds(size, d, told) for size, told in self.weights.items() for d in set(distances) if size > d}

    @staticmethod
    def _bounds(size: int, d: int, told: Mapping[int, float]) -> list[int]:
        total, bounds, upto, at = sum(told.values()), [0], 0.0, 0
        for k in range(1, d + 1):
            if total > 0:
                while at < size and upto + told.get(at, 0.0) / 2 < total * k / (d + 1):
                    upto, at = upto + told.get(at, 0.0), at + 1
            else:
                at = k * size // (d + 1)
            bounds.append(min(max(at, bounds[-1] + 1), size - (d + 1 - k)))
        return [*bounds, size]


def _near_names(n: DataFrame, h: DataFrame, columns: Sequence[str], blocking: Sequence[str], distances: Mapping[int, int], profile: _Profile) -> DataFrame:
    """Pairs that agree on a mask's columns and no others and whose names differ by the mask's distance at most.

    A haystack name of more than ``distance`` letters is cut into distance + 1
    segments, at bounds that depend on its length alone; a needle name lists,
    for every length the other may have, what could be such a segment.  If one
    stands s places further on, s edits lie before it and as many as the rest
    of the names differ in length behind it.  Shorter names meet by their length.
    """
    lengths, bounds = profile.segments(list(distances.values()))
    limit = F.element_at(F.create_map(*[F.lit(x) for pair in distances.items() for x in pair]), F.col("_mask"))
    d, size, i = F.col("_d"), F.col("size"), F.col("i")
    even = F.transform(F.sequence(F.lit(0), d + 1), lambda k: F.floor(k * size / (d + 1)).cast("int"))
    cuts = F.coalesce(F.try_element_at(_constant(bounds, "map<string,array<int>>"), F.concat_ws("-", size, d)), even)

    def segments(df: DataFrame) -> DataFrame:
        """A row for each segment: ``i``, ``at``, ``width``; -1, 0, 0 for names that are too short."""
        each = F.transform(F.sequence(F.lit(0), d), lambda k: F.struct(k.alias("i"), F.get(cuts, k).alias("at"), (F.get(cuts, k + 1) - F.get(cuts, k)).alias("width")))
        none = F.array(F.struct(F.lit(-1).alias("i"), F.lit(0).alias("at"), F.lit(0).alias("width")))
        return df.select("*", F.inline(F.when(size > d, each).otherwise(none)))

    values = [f"{{}}_{c}" for c in dict.fromkeys([*blocking, *columns])]
    meet = ["_mask", "_key", "size", "i", "part"]
    h_keys = h.select("_h_id", "_hs", *[v.format("H") for v in values], F.inline(_keys("H", columns, blocking, list(distances)))).withColumns(
        {"_d": limit, "size": F.length("_hs")})
    h_keys = segments(h_keys).withColumn("part", F.expr("substring(_hs, at + 1, width)")).drop("at", "width")

    names = _dealt(n).select("_n_id", "_ns", "_nx", "_masks", *[v.format("N") for v in values], F.inline(_keys("N", columns, blocking, list(distances)))).where(
        F.array_contains("_masks", F.col("_mask"))).drop("_masks").withColumn("_d", limit)
    names = names.withColumn("name", F.explode(F.array_distinct(F.array("_ns", "_nx")))).withColumn("own", F.length("name"))
    there = F.array(*map(F.lit, lengths))
    names = segments(names.withColumn("size", F.explode(F.filter(there, lambda x: F.abs(x - F.col("own")) <= F.col("_d")))))
    further = F.col("own") - size
    spare = F.floor((d - F.abs(further)) / 2).cast("int")
    moves = F.when(i < 0, F.array(F.lit(0))).otherwise(F.sequence(F.least(F.lit(0), further) - spare, F.greatest(F.lit(0), further) + spare))
    moved = names.withColumn("move", F.explode(moves)).withColumn("to", F.col("at") + F.col("move")).where((F.col("to") >= 0) & (F.col("to") + F.col("width") <= F.col("own")))
    n_keys = moved.withColumn("part", F.expr("substring(name, to + 1, width)")).drop("name", "own", "_d", "at", "width", "move", "to").distinct()
    near = F.expr("levenshtein(_ns, _hs, _d) >= 0 OR levenshtein(_nx, _hs, _d) >= 0")
    met = _dealt(h_keys, *meet).join(_dealt(n_keys, *meet), meet)
    found = met.where((_agreeing(columns) == F.col("_mask")) & near).select("_n_id", "_h_id").distinct()
    return found.join(h, "_h_id").join(n.drop("_masks"), "_n_id")
