"""Complementary merge: partial records of one person become one record.

Two records are partners when all primary keys are present and equal and
every secondary key is equal or missing on one side.  In sort order each
record that is still free leads: it takes in its free partners one by one,
merging those it does not overlap.

What is decided row by row needs only a few narrow columns (sort value,
priorities, unit indicators), and partners are grouped by the distinct
secondary-key patterns, not by pairs.  Rows are folded in ranges of about equal
size, whatever groups they belong to: a range is first summed up as a function
of the lead that enters it (``foldstate``), leads are handed over along the
ranges of a group, and then all ranges are folded at once.  The decisions come back as an event
table; wide values and item rows are then resolved by ordinary aggregates.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import blank
from ..session import checkpointed
from .foldstate import RECORD_PRIORITY_THRESHOLD, FoldRules, LeadState, RangeSummary, apply_summary
from .predicates import field_type, require_columns, sheet_rows, text_of


REPORT_COLUMN = "complementary_merge_report"

# The resolution rules of the rule sheet.
SIMPLE_RULES = ("common", "common, non-missing", "or", "record priority", "variable priority")
TEST_UNIT = re.compile(r"test unit (\d+)\Z")
UNIT_INDICATOR = re.compile(r"unit (\d+) indicator\Z")


@dataclass
class MergeRules:
    rules: dict[str, str] = field(default_factory=dict)
    primary: list[str] = field(default_factory=list)
    secondary: list[str] = field(default_factory=list)
    sort: str = ""
    variable_priority: str = ""
    record_priority: str | None = None
    indicators: dict[int, str] = field(default_factory=dict)


def read_merge_rules(sheet, force_one: bool = False) -> MergeRules:
    """Validate a rule sheet (variable_name, resolution_rule, keys)."""
    rows = sheet_rows(sheet)
    require_columns(rows, ("variable_name", "resolution_rule", "keys"), "merge rule sheet")
    out, sorts, variable, record = MergeRules(), [], [], []
    for row in rows:
        name = text_of(row["variable_name"])
        if not name:
            continue
        rule = re.sub(r"\s+", " ", text_of(row["resolution_rule"]).lower().replace("_", " "))
        rule = "common, non-missing" if re.fullmatch(r"common, ?non-missing", rule) else rule
        unit = UNIT_INDICATOR.match(rule)
        if rule not in SIMPLE_RULES and not unit and not TEST_UNIT.match(rule):
            raise ValueError(f"no resolution rule for variable {name}: {rule!r}")
        if name.lower() in {n.lower() for n in out.rules}:
            raise ValueError(f"variable {name} has two rules")
        out.rules[name] = rule
        if unit:
            out.indicators[int(unit[1])] = name
        if rule == "variable priority":
            variable.append(name)
        if rule == "record priority":
            record.append(name)
        for key in text_of(row["keys"]).lower().replace(";", ",").split(","):
            key = key.strip()
            if key == "primary":
                out.primary.append(name)
            elif key == "secondary":
                out.secondary.append(name)
            elif key == "sort":
                sorts.append(name)
            elif key:
                raise ValueError(f"unknown key {key!r} of variable {name}")
    if len(variable) != 1:
        raise ValueError("exactly one variable must have the rule 'variable priority'")
    if len(sorts) != 1:
        raise ValueError("exactly one variable must be the sort key")
    if len(record) > 1:
        raise ValueError("at most one variable can have the rule 'record priority'")
    if not out.primary:
        raise ValueError("no primary key in the merge rule sheet")
    if force_one and not record:
        raise ValueError("forcing one record needs a 'record priority' rule")
    for name, rule in out.rules.items():
        unit = TEST_UNIT.match(rule)
        if unit and int(unit[1]) not in out.indicators:
            raise ValueError(f"variable {name} names unit {unit[1]}, which has no indicator")
    out.sort, out.variable_priority, out.record_priority = sorts[0], variable[0], record[0] if record else None
    return out


class ComplementaryResult(NamedTuple):
    flat: DataFrame
    items: dict[str, DataFrame]
    events: DataFrame
    counters: DataFrame


# ------------------------------------------------------------- decisions

class Lead:
    """State of the record that is taking in its partners; ``report`` lists its parts, joined once."""

    __slots__ = ("base", "sort", "rp", "vp", "units", "report", "seq")

    def __init__(self, row_id, sort, rp, vp, units):
        self.base, self.sort, self.rp, self.vp, self.units = row_id, sort, rp, vp, list(units)
        self.report, self.seq = [], 0


def prefers_second(a: float | None, b: float | None) -> bool:
    """Does the second value win by variable priority (ties go to the first)?"""
    return b is not None and (a is None or b > a)


def pick_second(a: float | None, b: float | None) -> bool:
    """Does the second record win by record priority?"""
    return b is not None and (a is None or a < b)


def absorb(lead: Lead, row_id, sort, rp, vp, units, force: bool, sort_rule: str,
           flat_units: Sequence[bool]) -> dict:
    """Let ``lead`` meet one partner; returns the event of the partner's row."""
    event = {"role": "merged", "kept_id": None, "seq": 0, "prio": False, "units": [False] * len(units),
             "report": None, "overlap": False, "forced": False, "picked": False, "lost_id": None}
    high = any(p is not None and p >= RECORD_PRIORITY_THRESHOLD for p in (lead.rp, rp))
    overlap = not high and any(a == 1 and b == 1 for a, b in zip(lead.units, units))
    event["overlap"] = overlap
    if high or (overlap and force):
        second = pick_second(lead.rp, rp)
        event.update(picked=True, forced=overlap, role="picked_out")
        if second:
            event.update(role="base", lost_id=lead.base)
            lead.__init__(row_id, sort, rp, vp, units)
        lead.report.append(" Picked one. (B)" if second else " Picked one. (A)")
        if overlap:
            lead.report.append(" Forced.")
        return event
    if overlap:
        text = " Records [{}] and [{}] have an overlapping attempt indicator column."
        event.update(role="kept", kept_id=row_id, report=text.format(sort, lead.sort))
        lead.report.append(text.format(lead.sort, sort))
        return event
    second = prefers_second(lead.vp, vp)
    lead.seq += 1
    event.update(kept_id=lead.base, seq=lead.seq, prio=second)
    for i, (a, b) in enumerate(zip(lead.units, units)):
        if b is not None and b > 0:
            event["units"][i] = True
        elif a == 0 and b == 0:
            event["units"][i] = second
    lead.report.append(f" Merged [{lead.sort}] with  [{sort}].")
    for i, b in enumerate(units):
        if flat_units[i] and b is not None and b > 0:
            lead.units[i] = b
    if second:
        lead.vp = vp
        lead.rp = rp
        if sort_rule == "common" or (sort_rule == "common, non-missing" and sort not in (None, "")):
            lead.sort = sort
    elif sort_rule in ("common, non-missing", "or") and lead.sort in (None, ""):
        lead.sort = sort
    return event


EVENT_FIELDS = [
    T.StructField("role", T.StringType()), T.StructField("kept_id", T.LongType()),
    T.StructField("seq", T.LongType()), T.StructField("prio", T.BooleanType()),
    T.StructField("units", T.ArrayType(T.BooleanType())), T.StructField("report", T.StringType()),
    T.StructField("overlap", T.BooleanType()), T.StructField("forced", T.BooleanType()),
    T.StructField("picked", T.BooleanType()), T.StructField("lost_id", T.LongType()),
    T.StructField("lead_sort", T.StringType()), T.StructField("lead_seq", T.LongType()),
]


def _value(x) -> float | None:
    return None if x is None or x != x else float(x)


def _fold_rows(batches: Iterator[pd.DataFrame], n_units: int) -> Iterator[list[tuple]]:
    """Per batch: (range, cluster, (id, sort, record priority, variable priority, units))."""
    for batch in batches:
        yield [
            (row[0], row[1], (int(row[2]), None if row[3] is None or row[3] != row[3] else row[3], _value(row[4]), _value(row[5]),
                              [_value(u) for u in row[6:6 + n_units]]))
            for row in batch.itertuples(index=False)]


def _no_event(n_units: int) -> dict:
    return {"seq": 0, "prio": False, "units": [False] * n_units, "report": None, "overlap": False, "forced": False,
            "picked": False, "lost_id": None}


def _fold_batches(n_units: int, rules: FoldRules, incoming: Mapping[int, LeadState], going_on: Mapping[str, int]):
    """Stream over a range of rows sorted by cluster; holds one lead at a time.

    ``incoming`` has the lead of the first cluster of a range that an earlier
    range began, ``going_on`` the last range of each cluster that has several.
    A lead that goes on leaves the part of its report made here.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cluster, lead, at = None, None, None

        def close() -> list[dict]:
            if lead is None:
                return []
            role = "part" if going_on.get(cluster, at) > at else "lead"
            return [{"_id": lead.base, "role": role, "kept_id": lead.base, **_no_event(n_units), "report": "".join(lead.report) or None,
                     "lead_sort": lead.sort, "lead_seq": lead.seq, "_cluster": cluster, "_range": at}]

        for rows in _fold_rows(batches, n_units):
            out = []
            for here, own, row in rows:
                if own != cluster:
                    out += close()
                    before = incoming.get(here) if cluster is None else None
                    cluster, at = own, here
                    if before is None:
                        lead = Lead(*row)
                        continue
                    lead = Lead(before.base, before.sort, before.rp, before.vp, before.units)
                    lead.seq = before.seq
                event = absorb(lead, *row, rules.force, rules.sort_rule, rules.flat_units)
                state = {"lead_sort": lead.sort, "lead_seq": lead.seq, "_cluster": cluster, "_range": at}
                if event["role"] != "base":
                    out.append({"_id": row[0], **state, **event})
                if event["lost_id"] is not None:
                    out.append({"_id": event["lost_id"], "role": "picked_out", "kept_id": None, **_no_event(n_units), **state,
                                "overlap": event["overlap"], "forced": event["forced"], "picked": True})
            if out:
                yield pd.DataFrame(out)
        if last := close():
            yield pd.DataFrame(last)

    return run


def _piece_batches(n_units: int, rules: FoldRules, first_range: Mapping[str, int]):
    """What each range does to the lead of a cluster that has several ranges: the lead itself where it begins, a
    decision tree (``foldstate``) behind."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cluster, at, lead, tree = None, None, None, None

        def close():
            if cluster is not None:
                what = tree.tree() if tree else LeadState(lead.base, lead.sort, lead.rp, lead.vp, tuple(lead.units), lead.seq)
                yield pd.DataFrame({"_cluster": [cluster], "_range": [at], "_piece": [pickle.dumps(what)]})

        for rows in _fold_rows(batches, n_units):
            for here, own, row in rows:
                if own != cluster:
                    yield from close()
                    cluster, at, lead, tree = own, here, None, None
                    if first_range[own] == here:
                        lead = Lead(*row)
                        continue
                    tree = RangeSummary(n_units, rules)
                if tree:
                    tree.add(*row)
                else:
                    absorb(lead, *row, rules.force, rules.sort_rule, rules.flat_units)
        yield from close()

    return run


def _hand_over(pieces: pd.DataFrame) -> pd.DataFrame:
    """Leads that reach the later ranges of one cluster."""
    pieces = pieces.sort_values("_range")
    lead, out = pickle.loads(pieces["_piece"].iloc[0]), []
    for at, piece in zip(pieces["_range"].iloc[1:], pieces["_piece"].iloc[1:]):
        out.append((at, pickle.dumps(lead)))
        lead = apply_summary(pickle.loads(piece), lead)
    return pd.DataFrame(out, columns=["_range", "_lead"])


def _fold(rows: DataFrame, n_units: int, rules: FoldRules, schema: T.StructType, ranges: int | None = None) -> DataFrame:
    """Events of all partner groups, folded in ranges of rows of about equal size.

    Rows are laid out by ranges of (cluster, order), so a cluster of any size is
    spread over tasks.  Only a range's first cluster can have begun earlier;
    its lead is handed over from range to range, by one small piece per range.
    """
    wanted = ranges or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # NULL sort values come first among the partners, the lead before all.
    order = [F.col("_cluster").asc(), F.col("_lead_last").asc(), F.col("_order").asc_nulls_first(), F.col("_id").asc()]
    columns = ["_range", "_cluster", "_id", "_sort", "_rp", "_vp", *[f"_u{i}" for i in range(n_units)]]
    # The layout is stored: a sampling that ran again could move the bounds.
    laid = checkpointed(rows.repartitionByRange(wanted, *order).sortWithinPartitions(*order).withColumn(
        "_range", F.spark_partition_id()).select(*columns))
    several = {r["_cluster"]: (r["a"], r["b"]) for r in laid.groupBy("_cluster").agg(
        F.min("_range").alias("a"), F.max("_range").alias("b")).where("a < b").collect()}  # fewer than ranges
    incoming: dict[int, LeadState] = {}
    if several:
        pieces = laid.where(F.col("_cluster").isin(list(several))).mapInPandas(
            _piece_batches(n_units, rules, {c: a for c, (a, _) in several.items()}), "_cluster string, _range int, _piece binary")
        handed = pieces.groupBy("_cluster").applyInPandas(_hand_over, "_range int, _lead binary")
        incoming = {r["_range"]: pickle.loads(r["_lead"]) for r in handed.collect()}  # at most one for each range
    run = _fold_batches(n_units, rules, incoming, {c: b for c, (_, b) in several.items()})
    names = [f.name for f in schema.fields]
    return laid.mapInPandas(lambda batches: (out[names] for out in run(batches)), schema)


# ---------------------------------------------------------- partner groups

def place_patterns(patterns: DataFrame, ps: Sequence[str], ss: Sequence[str]) -> DataFrame:
    """The lead of each secondary-key pattern: ``ps``, ``ss``, ``_l0``... and ``_led``.

    In the order of ``_first`` a pattern joins the earliest lead it is
    compatible with, else it leads; one without ``_first`` may only join.  This
    is the lexicographically first independent set, found in rounds: a pattern
    looks for the earliest one among the leads and the patterns still open that
    it is compatible with.  If that is itself, it leads; if that is a lead, it
    joins; otherwise it waits.  The look-up goes through projections: for every
    set of present keys that another pattern may have, the keys both have.  So
    patterns are never compared in pairs, and a primary group of any size is
    spread by its projections.
    """
    n = len(ss)
    mask = reduce(lambda a, b: a + b, [F.when(F.col(s).isNotNull(), 1 << i).otherwise(0) for i, s in enumerate(ss)])
    known = patterns.withColumns({"_mask": mask, "_can": F.col("_first").isNotNull()})

    def part(shared: Column) -> Column:
        return F.array(*[F.when(shared.bitwiseAND(F.lit(1 << i)) != 0, F.col(s)) for i, s in enumerate(ss)])

    open_ = checkpointed(known)
    masks = sorted(r[0] for r in open_.select("_mask").distinct().collect())  # at most 2 ** secondary keys
    leads, done = None, []
    while not open_.isEmpty():
        may_lead = open_.where("_can").withColumn("_leads", F.lit(False))
        offers = may_lead if leads is None else may_lead.unionByName(leads)
        offers = offers.withColumn("_shared", F.explode(F.array(*map(F.lit, range(1 << n))))).where(
            F.col("_shared").bitwiseAND(F.col("_mask")) == F.col("_shared"))
        offers = offers.groupBy(*ps, F.col("_mask").alias("_other"), "_shared", part(F.col("_shared")).alias("_part")).agg(
            F.min(F.struct("_first", "_leads", *ss)).alias("_offer"))
        seek = open_.withColumn("_other", F.explode(F.array(*map(F.lit, masks)))).withColumn("_shared", F.col("_mask").bitwiseAND(F.col("_other")))
        found = seek.withColumn("_part", part(F.col("_shared"))).alias("k").join(
            offers.alias("o"), _null_safe([*ps, "_other", "_shared", "_part"], "k", "o"), "left").groupBy(*[F.col(f"k.{c}").alias(c) for c in (*ps, *ss)]).agg(
            F.first("k._mask").alias("_mask"), F.first("k._first").alias("_first"), F.first("k._can").alias("_can"), F.min("o._offer").alias("_offer"))
        own = F.col("_first").isNotNull() & (F.col("_offer._first") == F.col("_first"))
        state = F.when(F.col("_offer").isNull(), "alone").when(own, "leads").when(F.col("_offer._leads"), "joins").otherwise("waits")
        step = checkpointed(found.withColumn("_state", state))
        done.append(step.where("_state <> 'waits'").select(
            *ps, *ss, *[F.col(f"_offer.{s}").alias(f"_l{i}") for i, s in enumerate(ss)], (F.col("_state") != "alone").alias("_led")))
        fresh = step.where("_state = 'leads'").select(*known.columns, F.lit(True).alias("_leads"))
        leads = fresh if leads is None else leads.unionByName(fresh)
        open_ = step.where("_state = 'waits'").select(*known.columns)
    if not done:
        return open_.select(*ps, *ss, *[F.col(s).alias(f"_l{i}") for i, s in enumerate(ss)], F.col("_can").alias("_led"))
    return reduce(DataFrame.unionByName, done)


def _null_safe(names: Sequence[str], left: str, right: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}")) for n in names])


def _clusters(narrow: DataFrame, n_primary: int, n_secondary: int) -> DataFrame:
    """Adds ``_cluster`` (text key of the partner group); NULL when the row
    belongs to none because no row of its group may lead."""
    ps, ss = [f"_p{i}" for i in range(n_primary)], [f"_s{i}" for i in range(n_secondary)]

    def cluster_text(secondary: Sequence[str]) -> Column:
        parts = [F.to_json(F.array(*[F.col(p) for p in ps]))]
        if secondary:
            parts.append(F.to_json(F.struct(*[F.coalesce(F.col(s), F.lit("")).alias(f"s{i}")
                                              for i, s in enumerate(secondary)])))
        return F.concat_ws("|", *parts)

    if not n_secondary:
        return narrow.withColumn("_cluster", cluster_text([]))
    has_blank = reduce(lambda a, b: a | b, [F.col(s).isNull() for s in ss])
    patterns = narrow.groupBy(*ps, *ss).agg(F.min(F.when(F.col("_sort").isNotNull(), F.struct("_order", "_id"))).alias("_first"))
    # Only groups that mix patterns and hold a missing secondary key need the
    # greedy pass; elsewhere every pattern is its own partner group.
    mixed = patterns.groupBy(*ps).agg(
        F.count("*").alias("_n"), F.max(has_blank.cast("int")).alias("_b")
    ).where((F.col("_n") > 1) & (F.col("_b") == 1)).select(*ps)
    assigned = place_patterns(patterns.join(mixed, ps, "left_semi"), ps, ss)
    plain = narrow.join(mixed, ps, "left_anti").withColumn("_cluster", cluster_text(ss))
    rows = narrow.join(mixed, ps, "left_semi").alias("r").join(assigned.alias("a"), _null_safe(ps + ss, "r", "a"))
    rows = rows.select(
        "r.*", *[F.col(f"a._l{i}").alias(f"_l{i}") for i in range(n_secondary)], F.col("a._led").alias("_led"))
    rows = rows.withColumn("_cluster", F.when(F.col("_led"), cluster_text([f"_l{i}" for i in range(n_secondary)])))
    return plain.unionByName(rows.select(*narrow.columns, "_cluster"))


def complementary_merge(flat: DataFrame, rules, id_col: str = "id", items: Mapping[str, DataFrame] | None = None,
                        item_flat_id: str = "flat_table_id", item_id: str = "id", force_one: bool = False, ranges: int | None = None) -> ComplementaryResult:
    """Merge complementary records; see the module text for the method.

    Returns the flat table with a report column, the item tables, the event
    table (one row per record that met a partner) and the counters.  Item
    rows of merged records are resolved over all merges in order; item ids
    the base record does not have are not added, as in the reference.
    ``id_col`` must be a unique whole number.  ``ranges`` is the number of
    ranges of rows that are folded apart (spark.sql.shuffle.partitions).
    """
    rules = rules if isinstance(rules, MergeRules) else read_merge_rules(rules, force_one)
    if force_one and rules.record_priority is None:
        raise ValueError("forcing one record needs a 'record priority' rule")
    for name in (*rules.primary, *rules.secondary, rules.sort, rules.variable_priority):
        field_type(flat, name)
    units = sorted(rules.indicators)
    flat_names = {c.lower() for c in flat.columns}
    flat_units = [
        any(TEST_UNIT.match(r) and int(TEST_UNIT.match(r)[1]) == u and n.lower() in flat_names
            for n, r in rules.rules.items())
        for u in units
    ]
    usable = ~reduce(lambda a, b: a | b, [blank(p) for p in rules.primary])
    number = T.DoubleType()
    rp = F.col(rules.record_priority).try_cast(number) if rules.record_priority else F.lit(None).cast(number)
    narrow = flat.where(usable).select(
        F.col(id_col).cast("bigint").alias("_id"),
        *[F.rtrim(F.col(p).cast("string")).alias(f"_p{i}") for i, p in enumerate(rules.primary)],
        *[F.when(~blank(s), F.rtrim(F.col(s).cast("string"))).alias(f"_s{i}") for i, s in enumerate(rules.secondary)],
        F.col(rules.sort).alias("_order"), F.col(rules.sort).cast("string").alias("_sort"),
        rp.alias("_rp"), F.col(rules.variable_priority).try_cast(number).alias("_vp"),
        *[F.col(rules.indicators[u]).try_cast(number).alias(f"_u{i}") for i, u in enumerate(units)],
    )
    # Groups, rows and leaderless rows all read the narrow placement, so it is stored once.
    placed = checkpointed(_clusters(narrow, len(rules.primary), len(rules.secondary)))
    groups = placed.where(F.col("_cluster").isNotNull()).groupBy("_cluster").agg(
        F.count("*").alias("_n"),
        F.min(F.when(F.col("_sort").isNotNull(), F.struct("_order", "_id"))).alias("_lead"))
    several = groups.where((F.col("_n") > 1) & F.col("_lead").isNotNull())
    rows = placed.join(several.select("_cluster", F.col("_lead._id").alias("_lead_id")), "_cluster")
    rows = rows.withColumn("_lead_last", F.col("_id") != F.col("_lead_id"))
    # Rows that share keys with others but may not lead and found no lead.
    unled = placed.where(F.col("_cluster").isNull() & F.col("_sort").isNull()).select("_id").unionByName(
        placed.join(groups.where((F.col("_n") > 1) & F.col("_lead").isNull()).select("_cluster"),
                    "_cluster", "left_semi").select("_id"))

    schema = T.StructType([T.StructField("_id", T.LongType())] + EVENT_FIELDS + [
        T.StructField("_cluster", T.StringType()), T.StructField("_range", T.IntegerType())])
    fold_rules = FoldRules(force_one, rules.rules[rules.sort], tuple(flat_units))
    # ``tie`` orders rows that share a step; the ordered pass has none.
    tie_type = T.StructType([
        T.StructField("has", T.BooleanType()), T.StructField("at", field_type(flat, rules.sort)), T.StructField("id", T.LongType())])
    # Six consumers read the events, so the ordered pass is stored once.
    events = checkpointed(_fold(rows, len(units), fold_rules, schema, ranges).withColumn("tie", F.lit(None).cast(tie_type)))
    return _resolve(flat, dict(items or {}), rules, units, id_col, item_flat_id, item_id, events, unled)


def _truthy(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return F.coalesce(value != "", F.lit(False))
    if isinstance(kind, T.NumericType):
        return F.coalesce(value != 0, F.lit(False))
    return value.isNotNull()


def _resolved_columns(columns: Sequence[T.StructField], rules: MergeRules, units: Sequence[int], skip: set[str]):
    """Aggregates over the members of a merged record, one per column.

    ``base`` marks the record merged into; ``prio`` and ``units`` say which
    later member wins under the priority and test-unit rules.
    """
    order = F.struct("seq", "tie")
    by_name = {n.lower(): r for n, r in rules.rules.items()}
    aggregates = {}
    for f in columns:
        if f.name.lower() in skip:
            continue
        box = F.struct(F.col(f.name).alias("v"))
        base = F.max_by(box, F.when(F.col("base"), order))
        rule = by_name.get(f.name.lower(), "")
        unit = TEST_UNIT.match(rule)
        indicator = UNIT_INDICATOR.match(rule)
        full = _truthy(F.col(f.name), f.dataType)
        if unit:
            taken = F.max_by(box, F.when(F.element_at("units", units.index(int(unit[1])) + 1), order))
        elif indicator and any(r == f"test unit {indicator[1]}" for r in rules.rules.values()):
            taken = F.max_by(box, F.when(~F.col("base") & (F.col(f.name).try_cast("double") > 0), order))
        elif rule in ("common", "record priority", "variable priority"):
            taken = F.max_by(box, F.when(F.col("prio"), order))
        elif rule == "common, non-missing":
            taken = F.coalesce(
                F.max_by(box, F.when(F.col("prio") & full, order)),
                F.min_by(box, F.when(full, order)),
                F.max_by(box, F.when(F.col("prio"), order)))
        elif rule == "or":
            taken = F.coalesce(F.min_by(box, F.when(full, order)), F.max_by(box, order))
        else:
            taken = base
        aggregates[f.name] = F.coalesce(taken, base)
    return aggregates


def _resolve(flat, items, rules, units, id_col, item_flat_id, item_id, events, unled) -> ComplementaryResult:
    merged_bases = events.where("role = 'merged'").select(F.col("kept_id").alias("_base")).distinct()
    leads = events.where("role = 'lead'")
    with_merges = leads.join(merged_bases, leads["kept_id"] == merged_bases["_base"], "left_semi")
    final = with_merges.select(F.col("kept_id").alias("_base"))
    members = events.where("role in ('lead', 'merged')").select("_id", F.col("kept_id").alias("_base"), "seq", "tie", "prio", "units",
        (F.col("role") == "lead").alias("base"))
    members = members.join(final, "_base", "left_semi")
    gone = events.where("role in ('merged', 'picked_out')").select("_id").distinct()
    touched = gone.unionByName(final.select(F.col("_base").alias("_id")))

    def fields_of(df: DataFrame) -> list[T.StructField]:
        return list(df.schema.fields)

    wide = flat.withColumn("_id", F.col(id_col).cast("bigint"))
    aggs = _resolved_columns(fields_of(flat), rules, units, {id_col.lower()})
    merged = wide.join(members, "_id").groupBy("_base").agg(*[a.alias(n) for n, a in aggs.items()])
    merged = merged.select(*[
        F.col("_base").cast(field_type(flat, id_col)).alias(c) if c == id_col else F.col(f"{c}.v").alias(c)
        for c in flat.columns
    ])
    # A merged record replaced by a higher priority later is not a lead, so
    # its members are only in ``gone``.
    plain = wide.join(touched, "_id", "left_anti").select(*flat.columns)
    # A lead's report is made in the ranges it went through; the parts of a lead that was replaced belong to a row that is gone.
    texts = F.transform(F.array_sort(F.collect_list(F.struct("_range", "report"))), lambda part: part["report"])
    reports = events.where("role in ('lead', 'kept', 'part')").groupBy(F.col("kept_id").alias("_rid")).agg(
        F.nullif(F.array_join(texts, ""), F.lit("")).alias(REPORT_COLUMN))
    reports = reports.unionByName(unled.select(F.col("_id").alias("_rid"), F.lit(" Missing sort key.").alias(REPORT_COLUMN)))
    everything = plain.unionByName(merged)
    out = everything.join(reports, F.col(id_col).cast("bigint") == F.col("_rid"), "left").select(
        *flat.columns, REPORT_COLUMN)

    item_out = {}
    for name, frame in items.items():
        tagged = frame.withColumn("_id", F.col(item_flat_id).cast("bigint"))
        untouched = tagged.join(touched, "_id", "left_anti").select(*frame.columns)
        aggs = _resolved_columns(fields_of(frame), rules, units, {item_flat_id.lower(), item_id.lower()})
        has_base = F.max("base").alias("_has_base")
        joined = tagged.join(members, "_id").groupBy("_base", item_id).agg(has_base, *[a.alias(n) for n, a in aggs.items()])
        resolved = joined.where("_has_base").select(*[
            F.col("_base").cast(field_type(frame, item_flat_id)).alias(c) if c == item_flat_id
            else F.col(c) if c == item_id else F.col(f"{c}.v").alias(c)
            for c in frame.columns
        ])
        item_out[name] = untouched.unionByName(resolved)

    tally = events.where("role <> 'part'").select("role", "overlap", "forced", "picked").unionByName(
        unled.select(F.lit("unled").alias("role"), *[F.lit(False).alias(c) for c in ("overlap", "forced", "picked")]))
    counters = tally.agg(
        F.count(F.when(F.col("role") != "unled", 1)).alias("matching_rows_read"),
        F.count(F.when(F.col("role").isin("lead", "kept"), 1)).alias("matching_rows_written"),
        F.count(F.when(F.col("role") == "merged", 1)).alias("merged_records"),
        F.count(F.when(F.col("overlap"), 1)).alias("overlapping_records"),
        F.count(F.when(F.col("forced"), 1)).alias("forced_records"),
        F.count(F.when(F.col("picked"), 1)).alias("picked_records"),
        F.count(F.when(F.col("role") == "unled", 1)).alias("missing_sort_keys"),
    )
    return ComplementaryResult(out, item_out, events.where("role <> 'part'"), counters)
