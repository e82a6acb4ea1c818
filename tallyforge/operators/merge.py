"""Keyed merge with optional and fuzzy keys, SAS-style merge, dimension joins."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import name_similarity
from ..session import checkpointed, maybe_broadcast
from .predicates import field_type, sheet_rows, text_of
from .skew import HOT_ROWS, grid_join, hot_on_either, join_on_keys, listed
from .windows import common_columns, nodupkey

DEFAULT_SIMILARITY_THRESHOLD = 0.8
PRIORITIES = ("L", "R", "LN", "RN", "LO", "RO")


@dataclass(frozen=True)
class MergeField:
    """Output field: source column on each side and which side wins."""

    name: str
    left: str | None
    right: str | None
    priority: str = "L"
    type: T.DataType | None = None

    def __post_init__(self):
        if self.priority not in PRIORITIES:
            raise ValueError(f"illegal field priority {self.priority!r}")


class MergeResult(NamedTuple):
    output: DataFrame
    left_remainder: DataFrame | None
    right_remainder: DataFrame | None
    fuzzy_report: DataFrame | None
    pairs: DataFrame


def _pair(key) -> tuple[str, str]:
    return (key, key) if isinstance(key, str) else (key[0], key[1])


def _fuzzy(key) -> list[tuple[str, str]]:
    """A fuzzy key is one column or a list of one or two columns, each either
    a name on both sides or a (left, right) tuple."""
    parts = key if isinstance(key, list) else [key]
    if not 1 <= len(parts) <= 2:
        raise ValueError("a fuzzy key has one or two columns")
    return [_pair(p) for p in parts]


def _target_type(field: MergeField, left: DataFrame, right: DataFrame) -> T.DataType:
    if field.type is not None:
        return field.type
    return field_type(left, field.left) if field.left else field_type(right, field.right)


def meld(field: MergeField, left: Column | None, right: Column | None, kind: T.DataType) -> Column:
    """Value of a matched field under its priority; blank text is missing for
    the non-missing priorities."""
    left = F.lit(None) if left is None else left
    right = F.lit(None) if right is None else right
    left, right = left.try_cast(kind), right.try_cast(kind)
    if field.priority in ("L", "LO"):
        return left
    if field.priority in ("R", "RO"):
        return right
    first, second = (left, right) if field.priority == "LN" else (right, left)
    if isinstance(kind, T.StringType):
        return F.when(F.rtrim(first) == "", second).otherwise(F.coalesce(first, second))
    return F.coalesce(first, second)


def default_fields(left: DataFrame, right: DataFrame, priority: str = "L") -> list[MergeField]:
    sets = common_columns(left, right)
    by_lower = {c.lower(): c for c in right.columns}
    fields = [MergeField(c, c, by_lower[c.lower()], priority) for c in sets.common]
    fields += [MergeField(c, c, None, "LO") for c in sets.left_only]
    fields += [MergeField(c, None, c, "RO") for c in sets.right_only]
    return fields


def keyed_merge(left: DataFrame, right: DataFrame, left_id: str, right_id: str, required: Sequence,
                optional: Sequence = (), fuzzy: Sequence = (), thresholds=DEFAULT_SIMILARITY_THRESHOLD,
                fields: Sequence[MergeField] | None = None, join_type: str = "I", allow_dups_left: bool = False,
                allow_dups_right: bool = False, allow_dups_both: bool = False, null_as_text: bool = True,
                hot_rows: int = HOT_ROWS, store: bool = False) -> MergeResult:
    """Merge two tables on required keys, then test optional and fuzzy keys.

    ``left_id`` and ``right_id`` are unique row ids.  Everything before the
    final meld works on ids and keys only; wide rows are joined once, by id.
    Counts per key decide duplicates, so no key group is gathered; keys above
    ``hot_rows`` rows on a side are joined in a grid (see ``join_on_keys``).
    ``store`` keeps the decisions (row ids, keys, reason) in the checkpoint
    folder, so that the outputs of one merge share one evaluation of its joins.
    """
    if join_type not in ("I", "L", "R", "F"):
        raise ValueError("join_type must be I, L, R or F")
    if not required:
        raise ValueError("no required keys provided for the merge")
    required = [_pair(k) for k in required]
    optional = [_pair(k) for k in optional]
    fuzzy = [_fuzzy(k) for k in fuzzy]
    if isinstance(thresholds, (int, float)):
        thresholds = [float(thresholds)] * len(fuzzy)
    if len(thresholds) != len(fuzzy):
        raise ValueError("one similarity threshold is needed per fuzzy key")
    for name in [left_id, *[k[0] for k in required + optional], *[p[0] for k in fuzzy for p in k]]:
        field_type(left, name)
    for name in [right_id, *[k[1] for k in required + optional], *[p[1] for k in fuzzy for p in k]]:
        field_type(right, name)
    fields = list(fields) if fields is not None else default_fields(left, right)

    keys = [f"_k{i}" for i in range(len(required))]
    key_kinds = [field_type(left, k[0]) for k in required]

    def narrow(df: DataFrame, side: int, row_id: str) -> DataFrame:
        tag = "lr"[side]
        columns = [F.col(row_id).alias(f"_{tag}id")]
        columns += [F.col(k[side]).try_cast(t).alias(n) for n, k, t in zip(keys, required, key_kinds)]
        columns += [F.col(k[side]).alias(f"_{tag}opt{i}") for i, k in enumerate(optional)]
        columns += [F.col(p[side]).cast("string").alias(f"_{tag}fz{i}_{j}")
                    for i, k in enumerate(fuzzy) for j, p in enumerate(k)]
        return df.select(*columns)

    lk, rk = narrow(left, 0, left_id), narrow(right, 1, right_id)
    absent = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    l_ok, r_ok = lk.where(~absent), rk.where(~absent)
    l_count = l_ok.groupBy(*keys).agg(F.count("*").alias("_nl"))
    r_count = r_ok.groupBy(*keys).agg(F.count("*").alias("_nr"))
    info = l_count.join(r_count, keys, "full_outer")
    both = (F.col("_nl") > 1) & (F.col("_nr") > 1)
    both_rejected = both if (allow_dups_left and allow_dups_right and not allow_dups_both) else F.lit(False)

    def duplicate_reason(count: str, allowed: bool, side: str) -> Column:
        dup = (F.col(count) > 1) if not allowed else F.lit(False)
        return F.when(dup, f"Duplicate required key on {side}").when(
            both_rejected, "Duplicate required key on both sides")

    info = info.withColumns({
        "_rl": duplicate_reason("_nl", allow_dups_left, "left"),
        "_rr": duplicate_reason("_nr", allow_dups_right, "right"),
    })
    left_usable = F.col("_nl").isNotNull() & F.col("_rl").isNull()
    right_usable = F.col("_nr").isNotNull() & F.col("_rr").isNull()
    no_match = "No required key match"
    info = info.withColumns({
        "_rl": F.coalesce("_rl", F.when(~right_usable, no_match)),
        "_rr": F.coalesce("_rr", F.when(~left_usable, no_match)),
        "_matched": left_usable & right_usable,
    })

    info = checkpointed(info) if store else info
    hot = hot_on_either(l_ok, r_ok, keys, hot_rows)
    single = {"l": None, "r": None}  # against one row a key, only a side's own rows count
    if hot is not None:
        single = {"l": hot.withColumn("_nr", F.lit(1)), "r": hot.withColumn("_nl", F.col("_nr")).withColumn("_nr", F.lit(1))}
    matched = info.where("_matched").select(*keys)
    pairs = join_on_keys(join_on_keys(l_ok, matched, keys, single["l"], hot_rows), r_ok, keys, hot, hot_rows)

    def shown(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit("{NULL}"))

    def joined_text(columns: Sequence[Column]) -> list[Column]:
        out: list[Column] = []
        for i, c in enumerate(columns):
            out += [F.lit("; "), c] if i else [c]
        return out

    reason = F.lit(None).cast("string")
    if optional:
        mismatch = reduce(lambda a, b: a | b, [
            F.coalesce(F.col(f"_lopt{i}") != F.col(f"_ropt{i}").try_cast(field_type(left, k[0])), F.lit(False))
            for i, k in enumerate(optional)])
        text = F.concat(
            F.lit('Optional key mismatch ("'), *joined_text([shown(f"_lopt{i}") for i in range(len(optional))]),
            F.lit('" vs "'), *joined_text([shown(f"_ropt{i}") for i in range(len(optional))]), F.lit('")'))
        reason = F.when(mismatch, text)
    pairs = pairs.withColumn("_reason", reason)
    if fuzzy:
        def part(side: str, i: int, j: int) -> Column:
            return F.col(f"_{side}fz{i}_{j}") if j < len(fuzzy[i]) else F.lit(None).cast("string")

        pairs = pairs.withColumns({
            f"_sim{i}": name_similarity(part("l", i, 0), part("l", i, 1), part("r", i, 0), part("r", i, 1),
                                        null_as_text)
            for i in range(len(fuzzy))
        })
        pairs = pairs.withColumn("_compared", F.col("_reason").isNull())

        def names(side: str) -> list[Column]:
            return joined_text([
                F.concat_ws(" ", F.coalesce(part(side, i, 0), F.lit("{NULL}")),
                            F.coalesce(part(side, i, 1), F.lit("{NULL}")))
                for i in range(len(fuzzy))])

        low = reduce(lambda a, b: a | b, [F.col(f"_sim{i}") <= t for i, t in enumerate(thresholds)])
        text = F.concat(F.lit('Fuzzy key mismatch ("'), *names("l"), F.lit('" vs "'), *names("r"), F.lit('")'))
        pairs = pairs.withColumn("_reason", F.when(
            low, F.when(F.col("_reason").isNull(), text).otherwise(F.concat("_reason", F.lit("; "), text))
        ).otherwise(F.col("_reason")))

    pairs = checkpointed(pairs) if store else pairs
    report = None
    if fuzzy:
        columns = []
        for i in range(len(fuzzy)):
            columns.append(F.col(f"_sim{i}").alias(f"similarity_{i + 1}"))
            columns += [part(s, i, j).alias(f"{s}fuzzykey_{i + 1}_{j + 1}") for s in "lr" for j in (0, 1)]
        report = pairs.where("_compared").select(
            *[F.col(n).alias(k[0]) for n, k in zip(keys, required)],
            F.col("_lid").alias("fk_left"), F.col("_rid").alias("fk_right"), *columns)
    accepted = pairs.where(F.col("_reason").isNull()).select("_lid", "_rid", *keys)
    l_wide = left.select(F.col(left_id).alias("_lid"), *_prefixed("_l_", [f.left for f in fields]))
    r_wide = right.select(F.col(right_id).alias("_rid"), *_prefixed("_r_", [f.right for f in fields]))
    wide = accepted.join(l_wide, "_lid").join(r_wide, "_rid")
    kinds = {f.name: _target_type(f, left, right) for f in fields}

    def side_column(f: MergeField, side: str) -> Column | None:
        name = f.left if side == "l" else f.right
        return F.col(f"_{side}_{name}") if name else None

    def one_side(df: DataFrame, row_id: str, side: str, fk: str, other_fk: str, other_type) -> DataFrame:
        columns = []
        for f in fields:
            name = f.left if side == "l" else f.right
            value = F.col(name).try_cast(kinds[f.name]) if name else F.lit(None).cast(kinds[f.name])
            columns.append(value.alias(f.name))
        return df.select(F.col(row_id).alias(fk), F.lit(None).cast(other_type).alias(other_fk), *columns)

    output = wide.select(
        F.col("_lid").alias("fk_left"), F.col("_rid").alias("fk_right"),
        *[meld(f, side_column(f, "l"), side_column(f, "r"), kinds[f.name]).alias(f.name) for f in fields])
    l_type, r_type = field_type(left, left_id), field_type(right, right_id)
    if join_type in ("L", "F"):
        rest = left.join(accepted.select(F.col("_lid").alias(left_id)), left_id, "left_anti")
        output = output.unionByName(one_side(rest, left_id, "l", "fk_left", "fk_right", r_type))
    if join_type in ("R", "F"):
        rest = right.join(accepted.select(F.col("_rid").alias(right_id)), right_id, "left_anti")
        output = output.unionByName(one_side(rest, right_id, "r", "fk_right", "fk_left", l_type))

    def remainder(df: DataFrame, nk: DataFrame, usable: DataFrame, side: str, row_id: str, reason_col: str):
        key_id = f"_{side}id"
        missing_text = f"Missing required key on {'left' if side == 'l' else 'right'}"
        rejects = nk.where(absent).select(key_id, F.lit(missing_text).alias("merge_report"))
        by_key = info.where(F.col(reason_col).isNotNull()).select(*keys, F.col(reason_col).alias("merge_report"))
        rejects = rejects.unionByName(
            join_on_keys(usable, by_key, keys, single[side], hot_rows).select(key_id, "merge_report"))
        rejects = rejects.unionByName(
            pairs.where(F.col("_reason").isNotNull()).select(key_id, F.col("_reason").alias("merge_report")))
        wide_side = df.withColumn(key_id, F.col(row_id)).join(rejects, key_id)
        fk = "fk_left" if side == "l" else "fk_right"
        columns = []
        for f in fields:
            name = f.left if side == "l" else f.right
            value = F.col(name).try_cast(kinds[f.name]) if name else F.lit(None).cast(kinds[f.name])
            columns.append(value.alias(f.name))
        return wide_side.select(F.col(key_id).alias(fk), *columns, "merge_report")

    left_rest = remainder(left, lk, l_ok, "l", left_id, "_rl") if join_type in ("I", "R") else None
    right_rest = remainder(right, rk, r_ok, "r", right_id, "_rr") if join_type in ("I", "L") else None
    return MergeResult(output, left_rest, right_rest, report, pairs)


def _prefixed(prefix: str, names: Sequence[str | None]) -> list[Column]:
    return [F.col(n).alias(prefix + n) for n in dict.fromkeys(n for n in names if n)]


# --------------------------------------------------------------- merge spec

_KEY_RULE = re.compile(r"(primary|required|secondary|optional|fuzzy)\s*(\d+)\Z")
SPEC_COLUMNS = ("variable name", "newname", "priority", "keys")


@dataclass
class MergeSpec:
    fields: list[MergeField]
    required: list[tuple[str, str]]
    optional: list[tuple[str, str]]
    fuzzy: list[list[tuple[str, str]]]


def _spec_type(row: dict) -> T.DataType | None:
    kind, length = text_of(row.get("vartype")).upper(), text_of(row.get("length"))
    if length and float(length) <= 0:
        raise ValueError(f"length {length!r} must be positive")
    if not kind:
        return None
    if kind in ("C", "CHAR", "VARCHAR", "NCHAR", "NVARCHAR", "TEXT", "NTEXT"):
        return T.StringType()
    simple = {"N": T.DoubleType(), "FLOAT": T.DoubleType(), "REAL": T.FloatType(), "TINYINT": T.ShortType(),
              "SMALLINT": T.ShortType(), "INT": T.IntegerType(), "BIGINT": T.LongType(),
              "DATETIME": T.TimestampType(), "BIT": T.BooleanType()}
    if kind in simple:
        return simple[kind]
    raise ValueError(f"unknown variable type {kind!r}")


def read_merge_spec(left_sheet, right_sheet, left: DataFrame, right: DataFrame) -> MergeSpec:
    """Validate a two-sided merge spec and compile it for :func:`keyed_merge`."""
    sides = []
    for side, sheet, df in (("left", left_sheet, left), ("right", right_sheet, right)):
        seen, named, keyed = set(), {}, {}
        for row in sheet_rows(sheet):
            source = text_of(row.get("variable name"))
            field_type(df, source)
            if source.lower() in seen:
                raise ValueError(f"{side} column {source} appears twice in the merge spec")
            seen.add(source.lower())
            new = text_of(row.get("newname"))
            name = source if new.lower() in ("", "<same>") else new
            priority = re.sub(r"[\s-]", "", text_of(row.get("priority")).lower())
            if priority not in ("first", "second", "firstnonmissing", ""):
                raise ValueError(f"priority {row.get('priority')!r} must be FIRST, SECOND or FIRST NON-MISSING")
            if name.lower() != "<drop>":
                if name.lower() in named:
                    raise ValueError(f"two merge fields are named {name}")
                named[name.lower()] = (name, source, priority, _spec_type(row))
            key = text_of(row.get("keys")).lower()
            if key:
                match = _KEY_RULE.match(key)
                if not match:
                    raise ValueError(f"key expression {key!r} is not understood")
                kind = {"primary": "required", "secondary": "optional"}.get(match[1], match[1])
                keyed.setdefault((kind, int(match[2])), []).append(source)
        missing = [c for c in df.columns if c.lower() not in seen]
        if missing:
            raise ValueError(f"{side} columns missing from the merge spec: {', '.join(missing)}")
        sides.append((named, keyed))
    (l_named, l_keys), (r_named, r_keys) = sides
    if set(l_keys) != set(r_keys):
        raise ValueError("both sides of a merge spec must define the same keys")
    out = MergeSpec([], [], [], [])
    for kind, number in sorted(l_keys):
        lefts, rights = l_keys[(kind, number)], r_keys[(kind, number)]
        if len(lefts) != len(rights):
            raise ValueError(f"{kind} key {number} has different numbers of columns on the two sides")
        if kind == "fuzzy":
            out.fuzzy.append(list(zip(lefts, rights)))
        elif len(lefts) > 1:
            raise ValueError(f"{kind} key {number} is assigned twice")
        else:
            (out.required if kind == "required" else out.optional).append((lefts[0], rights[0]))
    if not out.required:
        raise ValueError("no required keys in the merge spec")
    for lower in list(l_named) + [n for n in r_named if n not in l_named]:
        l, r = l_named.get(lower), r_named.get(lower)
        if l and r:
            combos = {("first", "second"): "L", ("second", "first"): "R",
                      ("firstnonmissing", "second"): "LN", ("second", "firstnonmissing"): "RN"}
            try:
                priority = combos[(l[2], r[2])]
            except KeyError:
                raise ValueError(f"priorities of {l[0]} do not fit together: {l[2]!r} and {r[2]!r}") from None
            if l[3] is not None and r[3] is not None and l[3] != r[3]:
                raise ValueError(f"types of {l[0]} differ between the two sides")
            out.fields.append(MergeField(l[0], l[1], r[1], priority, l[3] or r[3]))
        else:
            one = l or r
            if one[2]:
                raise ValueError(f"{one[0]} exists on one side only and takes no priority")
            out.fields.append(MergeField(one[0], l[1] if l else None, r[1] if r else None, "LO" if l else "RO", one[3]))
    return out


# --------------------------------------------------------------- SAS merge

def _full_outer(left: DataFrame, right: DataFrame, n_keys: int, hot: DataFrame | None, cell_rows: int) -> DataFrame:
    """Full outer join of ``_lk<i>`` with ``_rk<i>``.

    A full outer join cannot be split on skew.  The counts of a hot key tell
    whether both sides have it: then its rows meet in a grid, and all find a
    partner; otherwise they stand alone.
    """
    test = reduce(lambda a, b: a & b, [F.col(f"_lk{i}") == F.col(f"_rk{i}") for i in range(n_keys)])
    if hot is None:
        return left.join(right, test, "full_outer")
    names = [f"_k{i}" for i in range(n_keys)]

    def part(df: DataFrame, side: str, how: str, keys: DataFrame) -> DataFrame:
        same = reduce(lambda a, b: a & b, [F.col(f"_{side}k{i}") == F.col(f"_h{i}") for i in range(n_keys)])
        return df.join(listed(keys.select(*[F.col(n).alias(f"_h{i}") for i, n in enumerate(names)])), same, how)

    def keyed(df: DataFrame, side: str) -> DataFrame:
        return df.withColumns({n: F.col(f"_{side}k{i}") for i, n in enumerate(names)})

    cold = part(left, "l", "left_anti", hot).join(part(right, "r", "left_anti", hot), test, "full_outer")
    met = grid_join(keyed(left, "l"), keyed(right, "r"), names, hot, cell_rows).drop(*names)
    alone = [part(df, side, "left_semi", hot.where(f"{other} = 0")) for df, side, other in ((left, "l", "_nr"), (right, "r", "_nl"))]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [cold, met, *alone])


def sas_merge(left: DataFrame, right: DataFrame, on: Sequence[str], keep: Sequence[str] = (),
              drop: Sequence[str] = (), distinct: bool = False, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows of both sides; on a match the right-hand values of shared columns win."""
    if keep and drop:
        raise ValueError("give keep columns or drop columns, not both")
    keys = {k.lower() for k in on}
    sets = common_columns(left, right)
    shared = [c for c in sets.common if c.lower() not in keys]
    l = left.select(*_prefixed("_l_", left.columns), *[F.col(k).alias(f"_lk{i}") for i, k in enumerate(on)])
    r = right.select(*_prefixed("_r_", right.columns), *[F.col(k).alias(f"_rk{i}") for i, k in enumerate(on)],
                     F.lit(True).alias("_right"))
    names = [f"_k{i}" for i in range(len(on))]
    hot = hot_on_either(left.select(*[F.col(k).alias(n) for k, n in zip(on, names)]),
                        right.select(*[F.col(k).alias(n) for k, n in zip(on, names)]), names, hot_rows)
    both = _full_outer(l, r, len(on), hot, hot_rows)
    names_right = {c.lower(): c for c in right.columns}
    from_right = F.col("_right").isNotNull()
    columns = [F.coalesce(f"_lk{i}", f"_rk{i}").alias(k) for i, k in enumerate(on)]
    columns += [F.when(from_right, F.col(f"_r_{names_right[c.lower()]}")).otherwise(F.col(f"_l_{c}")).alias(c)
                for c in shared]
    columns += [F.col(f"_l_{c}").alias(c) for c in sets.left_only]
    columns += [F.col(f"_r_{c}").alias(c) for c in sets.right_only]
    out = both.select(*columns)
    if keep:
        out = out.select(*keep)
    if drop:
        out = out.drop(*drop)
    return out.distinct() if distinct else out


# --------------------------------------------------------------- dimensions

def attach_dimension(df: DataFrame, dimension: DataFrame, on: Mapping[str, str], columns: Mapping[str, str],
                     order: Sequence, fill: Mapping[str, str] | None = None) -> DataFrame:
    """Left join of a de-duplicated dimension.

    ``columns`` maps output names to dimension columns; ``fill`` maps columns
    of ``df`` to dimension columns that fill them only where they are blank.
    """
    unique = nodupkey(dimension, list(on.values()), order)
    fill = dict(fill or {})
    picked = unique.select(
        *[F.col(v).alias(f"_d{i}") for i, v in enumerate(on.values())],
        *[F.col(v).alias(f"_c_{k}") for k, v in columns.items()],
        *[F.col(v).alias(f"_f_{k}") for k, v in fill.items()])
    test = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_d{i}") for i, k in enumerate(on)])
    joined = df.join(maybe_broadcast(picked), test, "left")
    kept = [
        F.coalesce(F.nullif(F.trim(c), F.lit("")), F.col(f"_f_{c}"), F.col(c)).alias(c) if c in fill else F.col(c)
        for c in df.columns if c not in columns
    ]
    return joined.select(*kept, *[F.col(f"_c_{k}").alias(k) for k in columns])


def join_parts(parts: Sequence[DataFrame], on: str) -> DataFrame:
    """Rejoin vertical parts of one table; repeated column names come from the first part."""
    out = parts[0]
    for part in parts[1:]:
        have = {c.lower() for c in out.columns}
        extra = [c for c in part.columns if c.lower() not in have]
        out = out.join(part.select(on, *extra), on)
    return out


def missing_from_dimension(df: DataFrame, dimension: DataFrame, on: Mapping[str, str], present: bool = False) -> DataFrame:
    """Rows without (or with, if ``present``) a dimension record; NULL keys never match."""
    keys = dimension.select(*[F.col(v).alias(f"_d{i}") for i, v in enumerate(on.values())])
    test = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_d{i}") for i, k in enumerate(on)])
    return df.join(maybe_broadcast(keys), test, "left_semi" if present else "left_anti")
