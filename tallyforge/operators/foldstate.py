"""The ordered fold of a partner group, summed up for a range of its rows.

A lead meets its partners in order, so a range of rows can only be folded once
the lead is known as the ranges before left it.  ``RangeSummary`` folds a range
for *every* lead at once: what is not known stays symbolic (OWN), and where a
decision depends on it, the fold forks on a test of the incoming lead:

* ``high``: is its record priority above the threshold?
* ``rp`` x: is its record priority below x?      * ``vp`` x: its variable priority?
* ``unit`` i: is its indicator of unit i 1?      * ``blank``: has it no sort value?

Flows that have come to the same state go on as one.  A lead replaces its own
values quickly, so few flows are alive at a time.  What is left is a decision
tree from the incoming to the outgoing lead, in which thresholds with the same
outcome are one; ``apply_summary`` walks it.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any, NamedTuple

RECORD_PRIORITY_THRESHOLD = 1000
OWN = ...  # a value of the incoming lead


class LeadState(NamedTuple):
    """What the next range has to know of a lead."""

    base: int
    sort: Any
    rp: float | None
    vp: float | None
    units: tuple
    seq: int


class FoldRules(NamedTuple):
    force: bool
    sort_rule: str
    flat_units: tuple[bool, ...]


class _Flow:
    """A state of the lead between two forks; ``merges`` and ``base`` are counted from the beginning of the flow."""

    __slots__ = ("own", "rp", "vp", "units", "sort", "not_one", "high", "blank", "rp_floor", "vp_floor", "merges", "base", "end")

    def __init__(self, n_units: int):
        self.own, self.rp, self.vp, self.units, self.sort = True, None, None, (OWN,) * n_units, OWN
        # Facts about the incoming lead, learned by tests; None: not known.
        self.not_one, self.high, self.blank, self.rp_floor, self.vp_floor = frozenset(), None, None, None, None
        self.merges, self.base, self.end = 0, OWN, None

    def follower(self) -> _Flow:
        other = _Flow.__new__(_Flow)
        for name in _Flow.__slots__:
            setattr(other, name, getattr(self, name))
        other.merges, other.base, other.end = 0, OWN, None
        return other

    def fork(self, kind: str, value=None) -> tuple[_Flow, _Flow]:
        yes, no = self.follower(), self.follower()
        self.end = (kind, value, yes, no)
        return yes, no

    def key(self) -> tuple:
        return (self.own, self.rp, self.vp, self.units, self.sort, self.not_one,
                self.high if self.own else None, self.blank if self.sort is OWN else None)

    def outcome(self) -> tuple:
        return (self.own, self.rp, self.vp, self.units, self.sort)


def _lowest(a, b):
    return None if a is None or b is None else min(a, b)


class RangeSummary:
    def __init__(self, n_units: int, rules: FoldRules):
        self.rules, self.root = rules, _Flow(n_units)
        self.alive = [self.root]

    def add(self, row_id: int, sort, rp: float | None, vp: float | None, units: Sequence[float | None]) -> None:
        row = (row_id, sort, rp, vp, tuple(units))
        self.alive = [after for flow in self.alive for after in self._meet(flow, row)]
        if len(self.alive) > 1:
            self._join_equal()

    def _join_equal(self) -> None:
        groups: dict[tuple, list[_Flow]] = {}
        for flow in self.alive:
            groups.setdefault(flow.key(), []).append(flow)
        if len(groups) == len(self.alive):
            return
        self.alive = []
        for same in groups.values():
            joint = same[0]
            if len(same) > 1:
                joint = same[0].follower()
                for flow in same:
                    joint.rp_floor, joint.vp_floor = _lowest(joint.rp_floor, flow.rp_floor), _lowest(joint.vp_floor, flow.vp_floor)
                    flow.end = ("is", None, joint, None)
            self.alive.append(joint)

    def _meet(self, flow: _Flow, row: tuple, second: bool | None = None) -> list[_Flow]:
        """Flows after the partner ``row``; ``second``: is its priority known to win?"""
        row_id, sort, rp, vp, units = row
        high = rp is not None and rp >= RECORD_PRIORITY_THRESHOLD
        if not high and flow.own:
            if flow.high is None:
                yes, no = flow.fork("high")
                yes.high, yes.rp_floor, no.high = True, RECORD_PRIORITY_THRESHOLD, False
                return self._meet(yes, row) + self._meet(no, row)
            high = flow.high
        elif not high:
            high = flow.rp is not None and flow.rp >= RECORD_PRIORITY_THRESHOLD
        overlap = not high and any(a is not OWN and a == 1 and b == 1 for a, b in zip(flow.units, units))
        if not high and not overlap:
            for i, (a, b) in enumerate(zip(flow.units, units)):
                if b == 1 and a is OWN and i not in flow.not_one:
                    yes, no = flow.fork("unit", i)
                    yes.units = (*yes.units[:i], 1.0, *yes.units[i + 1:])
                    no.not_one = no.not_one | {i}
                    return self._meet(yes, row) + self._meet(no, row)
        picks = high or (overlap and self.rules.force)
        if overlap and not picks:
            return [flow]
        if second is None:
            mine, kind = (rp, "rp") if picks else (vp, "vp")
            floor = flow.rp_floor if picks else flow.vp_floor
            if mine is None:
                second = False
            elif not flow.own:
                theirs = flow.rp if picks else flow.vp
                second = theirs is None or theirs < mine
            elif floor is not None and mine <= floor:
                second = False
            elif picks and flow.high is False and mine >= RECORD_PRIORITY_THRESHOLD:
                second = True
            else:
                yes, no = flow.fork(kind, mine)
                setattr(no, f"{kind}_floor", mine)
                return self._meet(yes, row, True) + self._meet(no, row, False)
        rule = self.rules.sort_rule
        if picks:
            if second:
                flow.own, flow.rp, flow.vp, flow.units, flow.sort = False, rp, vp, units, sort
                flow.not_one, flow.merges, flow.base = frozenset(), 0, row_id
            return [flow]
        if not second and rule in ("common, non-missing", "or"):
            if flow.sort is OWN and flow.blank is None:
                yes, no = flow.fork("blank")
                yes.blank, no.blank = True, False
                return self._meet(yes, row, False) + self._meet(no, row, False)
            if flow.blank if flow.sort is OWN else flow.sort in (None, ""):
                flow.sort = sort
        flow.merges += 1
        taken = [i for i, b in enumerate(units) if self.rules.flat_units[i] and b is not None and b > 0]
        if taken:
            flow.units = tuple(units[i] if i in taken else a for i, a in enumerate(flow.units))
            flow.not_one = flow.not_one.difference(taken)
        if second:
            flow.own, flow.rp, flow.vp = False, rp, vp
            if rule == "common" or (rule == "common, non-missing" and sort not in (None, "")):
                flow.sort = sort
        return [flow]

    def tree(self) -> list[tuple]:
        """Nodes of the decision tree, children first and the root last.

        A node is (base, merges, outcome) or (base, merges, kind, value, yes, no); base and merges happen on the way to it.
        """
        nodes: list[tuple] = []
        done: dict[int, tuple[int, object, int]] = {}  # flow -> node without its way, base, merges
        stack = [self.root]

        def after(base, merges, then: tuple[int, object, int]) -> tuple[int, object, int]:
            node, b, m = then
            return (node, b, m) if b is not OWN else (node, base, merges + m)

        known: dict[tuple, int] = {}

        def node_of(node: tuple) -> int:
            if node not in known:
                known[node] = len(nodes)
                nodes.append(node)
            return known[node]

        while stack:
            flow = stack[-1]
            if id(flow) in done:
                stack.pop()
                continue
            children = [c for c in (flow.end or ())[2:] if c is not None]
            waiting = [c for c in children if id(c) not in done]
            if waiting:
                stack += waiting
                continue
            stack.pop()
            if not children:
                then = (node_of(flow.outcome()), OWN, 0)
            elif len(children) == 1:
                then = done[id(children[0])]
            else:
                kind, value = flow.end[:2]
                yes, no = (done[id(c)] for c in children)
                below = nodes[no[0]]
                if yes == no:
                    then = yes
                elif kind in ("rp", "vp") and below[0] == kind and after(no[1], no[2], below[2]) == yes:
                    then = no  # the higher threshold behind it leads to the same
                else:
                    then = (node_of((kind, value, yes, no)), OWN, 0)
            done[id(flow)] = after(flow.base, flow.merges, then)
        return [*nodes, ("root", done[id(self.root)])]


def apply_summary(tree: list[tuple], lead: LeadState) -> LeadState:
    """The lead as the range leaves it."""
    base, seq = lead.base, lead.seq
    way = tree[-1][1]
    while True:
        at, new_base, merges = way
        base, seq = (new_base, merges) if new_base is not OWN else (base, seq + merges)
        node = tree[at]
        if isinstance(node[0], bool):
            own, rp, vp, units, sort = node
            return LeadState(base, lead.sort if sort is OWN else sort, lead.rp if own else rp, lead.vp if own else vp,
                             tuple(a if b is OWN else b for a, b in zip(lead.units, units)), seq)
        kind, value, yes, no = node
        if kind == "high":
            holds = lead.rp is not None and lead.rp >= RECORD_PRIORITY_THRESHOLD
        elif kind == "unit":
            holds = lead.units[value] == 1
        elif kind == "blank":
            holds = lead.sort in (None, "")
        else:
            theirs = lead.rp if kind == "rp" else lead.vp
            holds = theirs is None or theirs < value
        way = yes if holds else no
