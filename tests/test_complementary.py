"""Complementary merge against a row-by-row model of its rules."""

import pickle
import random
import time

import pytest

from tallyforge.operators.complementary import Lead, absorb, complementary_merge, place_patterns, read_merge_rules
from tallyforge.operators.foldstate import FoldRules, LeadState, RangeSummary, apply_summary

RULES = [
    {"variable_name": "person", "resolution_rule": "common", "keys": "primary"},
    {"variable_name": "room", "resolution_rule": "common, non-missing", "keys": "secondary"},
    {"variable_name": "teacher", "resolution_rule": "or", "keys": "secondary"},
    {"variable_name": "barcode", "resolution_rule": "common", "keys": "sort"},
    {"variable_name": "vp", "resolution_rule": "variable priority", "keys": ""},
    {"variable_name": "rp", "resolution_rule": "record priority", "keys": ""},
    {"variable_name": "u1", "resolution_rule": "unit 1 indicator", "keys": ""},
    {"variable_name": "u2", "resolution_rule": "unit 2 indicator", "keys": ""},
    {"variable_name": "s1", "resolution_rule": "test unit 1", "keys": ""},
    {"variable_name": "s2", "resolution_rule": "test unit 2", "keys": ""},
    {"variable_name": "answer", "resolution_rule": "test unit 1", "keys": ""},
]
COLUMNS = ("id", "person", "room", "teacher", "barcode", "vp", "rp", "u1", "u2", "s1", "s2")
SCHEMA = ("id bigint, person string, room string, teacher string, barcode bigint, vp int, rp int, u1 int, u2 int, "
          "s1 double, s2 double")


def records(seed, n=70, high=True):
    r = random.Random(seed)
    barcodes = r.sample(range(1000), n)
    out = []
    for i in range(n):
        out.append((
            i + 1, r.choice(["p1", "p2", "p3", "p4", "", None]), r.choice(["a", "b", "", None]), r.choice(["x", "y", None]),
            None if r.random() < 0.08 else barcodes[i], r.choice([None, 0, 1, 2, 3]),
            r.choice([1000, 1001]) if high and r.random() < 0.15 else r.choice([None, 0, 1, 2]),
            int(r.random() < 0.3), int(r.random() < 0.3), r.choice([None, 1.0, 2.0]), r.choice([None, 3.0])))
    return out


def by_priority(a, b, pa, pb):
    return b if pb is not None and (pa is None or pb > pa) else a


def resolve(values_a, values_b, flat_a, flat_b):
    out = dict(values_a)
    pa, pb = flat_a["vp"], flat_b["vp"]
    for rule in RULES:
        name, kind = rule["variable_name"], rule["resolution_rule"]
        if name not in out:
            continue
        a, b = out[name], values_b[name]
        if kind in ("common", "record priority"):
            out[name] = by_priority(a, b, pa, pb)
        elif kind == "common, non-missing":
            out[name] = a if a and not b else b if b and not a else by_priority(a, b, pa, pb)
        elif kind == "or":
            out[name] = a or b
        elif kind.startswith("test unit"):
            unit = "u" + kind[-1]
            if flat_b[unit] > 0:
                if unit in values_b:
                    out[unit] = values_b[unit]
                out[name] = b
            elif flat_a[unit] == 0 and flat_b[unit] == 0:
                out[name] = by_priority(a, b, pa, pb)
    if "vp" in out:
        out["vp"] = by_priority(out["vp"], values_b["vp"], pa, pb)
    return out


def model(data, items, force):
    recs = [dict(zip(COLUMNS, d)) for d in data]
    item_of = {}
    for i in items:
        item_of.setdefault(i["flat_table_id"], {})[i["id"]] = dict(i)
    blank = lambda v: v is None or v == ""

    def partners(a):
        return [b for b in recs if b["id"] != a["id"] and not blank(a["person"]) and a["person"] == b["person"] and all(
            blank(a[k]) or blank(b[k]) or a[k] == b[k] for k in ("room", "teacher"))]

    order = lambda r: (r["barcode"] is not None, r["barcode"] or 0, r["id"])
    out, item_out, done = [], [], set()
    for a in sorted(recs, key=order):
        mine = partners(a)
        if not mine:
            out.append((a, None))
            item_out += item_of.get(a["id"], {}).values()
            done.add(a["id"])
    for a in sorted(recs, key=order):
        if a["id"] in done or a["barcode"] is None:
            continue
        lead, report, its = dict(a), "", {k: dict(v) for k, v in item_of.get(a["id"], {}).items()}
        done.add(a["id"])
        for b in sorted(partners(a), key=order):
            if b["id"] in done:
                continue
            done.add(b["id"])
            ra, rb = lead["rp"], b["rp"]
            high = any(x is not None and x >= 1000 for x in (ra, rb))
            overlap = any(lead[u] == 1 and b[u] == 1 for u in ("u1", "u2"))
            if high or (overlap and force):
                if rb is not None and (ra is None or ra < rb):
                    lead, report = dict(b), " Picked one. (B)"
                    its = {k: dict(v) for k, v in item_of.get(b["id"], {}).items()}
                else:
                    report += " Picked one. (A)"
                if not high:
                    report += " Forced."
            elif overlap:
                text = " Records [{}] and [{}] have an overlapping attempt indicator column."
                report += text.format(lead["barcode"], b["barcode"])
                out.append((b, text.format(b["barcode"], lead["barcode"])))
                item_out += item_of.get(b["id"], {}).values()
            else:
                report += f" Merged [{lead['barcode']}] with  [{b['barcode']}]."
                theirs = item_of.get(b["id"], {})
                for k in its:
                    if k in theirs:
                        kept = its[k]["flat_table_id"]
                        its[k] = resolve(its[k], theirs[k], lead, b)
                        its[k]["flat_table_id"] = kept
                new = resolve(lead, b, lead, b)
                new["id"] = lead["id"]
                lead = new
        out.append((lead, report or None))
        item_out += its.values()
    for a in recs:
        if a["id"] not in done:
            out.append((a, " Missing sort key."))
            item_out += item_of.get(a["id"], {}).values()
    return out, item_out


def item_rows(data, seed):
    r = random.Random(seed)
    return [{"flat_table_id": d[0], "id": k, "answer": r.choice(["1", "2", "3"])} for d in data for k in (1, 2)]


@pytest.mark.parametrize("seed,force,high", [(1, False, True), (2, True, True), (3, False, False)])
def test_matches_row_by_row_model(spark, seed, force, high):
    data = records(seed, high=high)
    items = item_rows(data, seed)
    flat = spark.createDataFrame(data, SCHEMA)
    item_df = spark.createDataFrame([(i["flat_table_id"], i["id"], i["answer"]) for i in items], "flat_table_id bigint, id int, answer string")
    result = complementary_merge(flat, RULES, items={"m": item_df}, force_one=force)
    wanted, wanted_items = model(data, items, force)
    got = {r["id"]: tuple(r) for r in result.flat.collect()}
    assert got == {w["id"]: tuple(w[c] for c in COLUMNS) + (rep,) for w, rep in wanted}
    got_items = sorted(tuple(r) for r in result.items["m"].collect())
    assert got_items == sorted((i["flat_table_id"], i["id"], i["answer"]) for i in wanted_items)
    counters = result.counters.first()
    assert counters["matching_rows_read"] >= counters["matching_rows_written"]


def test_partition_count_does_not_matter(spark):
    flat = spark.createDataFrame(records(5), SCHEMA)
    one = complementary_merge(flat.coalesce(1), RULES).flat
    many = complementary_merge(flat.repartition(7, "barcode"), RULES).flat
    assert sorted(map(repr, one.collect())) == sorted(map(repr, many.collect()))


def test_indicators_above_one(spark):
    # 2 takes the unit over without a conflict; afterwards a 1 conflicts no more with the lead.
    data = [(i + 1, "p", "a", "x", i, 0, 0, u, 0, float(i), None) for i, u in enumerate((1, 1, 2, 1, 2))]
    out = complementary_merge(spark.createDataFrame(data, SCHEMA), RULES).flat
    assert sorted(r["id"] for r in out.collect()) == [1, 2]


class Leads:
    """Model: leads of the patterns of one primary group, one pattern after the other."""

    def __init__(self, n_keys: int):
        self.n_keys, self.seen, self.first, self.leads = n_keys, [], {}, []

    def _part(self, key: tuple, shared: int) -> tuple:
        return tuple(key[i] for i in range(self.n_keys) if shared >> i & 1)

    def place(self, key: tuple, can_lead: bool) -> tuple | None:
        """The lead of a pattern; None if it has none and may not lead."""
        mask = sum(1 << i for i, v in enumerate(key) if v is not None)
        found = (self.first.get((other, mask & other, self._part(key, mask & other))) for other in self.seen)
        best = min((f for f in found if f is not None), default=None)
        if best is None:
            if not can_lead:
                return None
            best = len(self.leads)
            self.leads.append(key)
            if mask not in self.seen:
                self.seen.append(mask)
            for other in range(1 << self.n_keys):
                self.first.setdefault((mask, mask & other, self._part(key, mask & other)), best)
        return self.leads[best]


@pytest.mark.parametrize("seed,keys", [(1, 1), (2, 2), (3, 3), (4, 3)])
def test_places_equal_the_ordered_pass(spark, seed, keys):
    r = random.Random(seed)
    ss = [f"_s{i}" for i in range(keys)]
    seen, rows = set(), []
    for i in range(260):
        key = (r.choice(["hot", "hot", "a", "b"]), *[r.choice(["x", "y", "z", "w", None]) for _ in ss])
        if key not in seen:
            seen.add(key)
            rows.append((*key, None if r.random() < 0.15 else (r.randrange(50), i)))
    df = spark.createDataFrame(rows, "_p0 string, " + ", ".join(f"{s} string" for s in ss) + ", _first struct<_order: int, _id: int>")
    want = {}
    for person in ("hot", "a", "b"):
        leads = Leads(keys)
        for row in sorted((x for x in rows if x[0] == person), key=lambda x: (x[-1] is None, x[-1] or 0, repr(x))):
            want[row[:-1]] = leads.place(row[1:-1], row[-1] is not None)
    got = {tuple(x)[:1 + keys]: (tuple(x)[1 + keys:-1] if x[-1] else None) for x in place_patterns(df, ["_p0"], ss).collect()}
    assert got == want
    assert place_patterns(df.limit(0), ["_p0"], ss).collect() == []


def test_leads_follow_first_rows():
    order = [(("a", None), True), (("a", "x"), True), (("b", "x"), True), ((None, "x"), True), ((None, None), True), (("c", "y"), False)]
    leads = Leads(2)
    assert {key: leads.place(key, can) for key, can in order} == {
        ("a", None): ("a", None), ("a", "x"): ("a", None), ("b", "x"): ("b", "x"), (None, "x"): ("a", None),
        (None, None): ("a", None), ("c", "y"): None}


def test_chain_without_transitivity(spark):
    # A and B agree, B and C agree, A and C do not: C stays on its own.
    data = [(1, "p", "a", None, 1, 0, 0, 0, 0, 1.0, None), (2, "p", None, None, 2, 0, 0, 1, 0, 2.0, None), (3, "p", "b", None, 3, 0, 0, 0, 1, 3.0, 4.0)]
    out = {r["id"]: r for r in complementary_merge(spark.createDataFrame(data, SCHEMA), RULES).flat.collect()}
    assert set(out) == {1, 3} and out[1]["s1"] == 2.0 and out[1]["u1"] == 1 and out[3]["complementary_merge_report"] is None


@pytest.mark.parametrize("change,message", [
    (lambda s: [r for r in s if r["keys"] != "sort"], "sort key"),
    (lambda s: [r for r in s if r["resolution_rule"] != "variable priority"], "variable priority"),
    (lambda s: s + [{"variable_name": "z", "resolution_rule": "record priority", "keys": ""}], "record priority"),
    (lambda s: s + [{"variable_name": "z", "resolution_rule": "largest", "keys": ""}], "no resolution rule"),
    (lambda s: s + [{"variable_name": "z", "resolution_rule": "test unit 9", "keys": ""}], "no indicator"),
    (lambda s: [r for r in s if r["keys"] != "primary"], "primary"),
])
def test_rule_sheet_errors(change, message):
    with pytest.raises(ValueError, match=message):
        read_merge_rules(change(list(RULES)))


def test_forcing_needs_a_record_priority():
    sheet = [r for r in RULES if r["resolution_rule"] != "record priority"]
    with pytest.raises(ValueError, match="record priority"):
        read_merge_rules(sheet, force_one=True)


def test_range_summaries_equal_the_ordered_fold():
    r = random.Random(4)
    for _ in range(400):
        n = r.randrange(4)
        rules = FoldRules(r.random() < 0.5, r.choice(["common", "common, non-missing", "or", "variable priority"]), tuple(r.random() < 0.7 for _ in range(n)))

        def rp():
            return r.choice([None, 0, 1, 2, 3, 5]) if r.random() < 0.85 else r.choice([1000, 1001, 1002])

        def units():
            return [r.choice([None, 0.0, 1.0, 2.0]) if r.random() < 0.3 else 0.0 for _ in range(n)]

        rows = [(100 + i, r.choice([None, "", f"s{i}"]), rp(), r.choice([None, 0, 1, 2, 3, i]), units()) for i in range(r.randrange(25))]
        summary = RangeSummary(n, rules)
        for row in rows:
            summary.add(*row)
        tree = pickle.loads(pickle.dumps(summary.tree()))
        for _ in range(8):
            start = LeadState(1, r.choice(["", "z", None]), rp(), r.choice([None, 0, 1, 2, 3, 10]), tuple(units()), r.randrange(5))
            lead = Lead(*start[:5])
            lead.seq = start.seq
            for row in rows:
                absorb(lead, *row, rules.force, rules.sort_rule, rules.flat_units)
            assert apply_summary(tree, start) == LeadState(lead.base, lead.sort, lead.rp, lead.vp, tuple(lead.units), lead.seq)


def test_summaries_stay_small_when_priorities_rise():
    summary = RangeSummary(2, FoldRules(False, "common", (True, True)))
    for i in range(5000):
        summary.add(i, str(i), float(i % 900), float(i), [0.0, 0.0])
    assert len(summary.alive) <= 3 and len(summary.tree()) <= 10


@pytest.mark.parametrize("force", [False, True])
def test_one_person_in_many_ranges(spark, force):
    data = [(d[0], "p", *d[2:]) for d in records(8, n=150)]
    items = item_rows(data, 8)
    flat = spark.createDataFrame(data, SCHEMA)
    item_df = spark.createDataFrame([(i["flat_table_id"], i["id"], i["answer"]) for i in items], "flat_table_id bigint, id int, answer string")
    wanted, wanted_items = model(data, items, force)
    for ranges in (1, 17):
        result = complementary_merge(flat, RULES, items={"m": item_df}, force_one=force, ranges=ranges)
        assert {r["id"]: tuple(r) for r in result.flat.collect()} == {w["id"]: tuple(w[c] for c in COLUMNS) + (rep,) for w, rep in wanted}
        assert sorted(tuple(r) for r in result.items["m"].collect()) == sorted((i["flat_table_id"], i["id"], i["answer"]) for i in wanted_items)


def test_a_long_report_takes_linear_time():
    """A lead that meets very many partners does not copy its report for each of them."""
    def seconds(n: int) -> float:
        lead, begun = Lead(0, "0", 1006.0, 0.0, [1.0]), time.process_time()
        for i in range(1, n + 1):
            absorb(lead, i, str(i), 1.0, 0.0, [1.0], False, "or", [False])
        assert "".join(lead.report) == " Picked one. (A)" * n
        return time.process_time() - begun

    seconds(1000)
    assert seconds(400_000) < 40 * seconds(40_000) + 1
