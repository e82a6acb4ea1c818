import random

import pytest
from pyspark.sql import functions as F

from tallyforge.llm import mixture
from tallyforge.llm.queries import QUERIES

from .conftest import rows_of_edge


def levels(sizes, weights, most):
    """Reshare the excess until no target is above its stop."""
    total, stop = sum(sizes), [most * s for s in sizes]
    target = [0.0] * len(sizes)
    fixed = set()
    while len(fixed) < len(sizes):
        left = total - sum(stop[i] for i in fixed)
        open_weight = sum(w for i, w in enumerate(weights) if i not in fixed)
        over = [i for i in range(len(sizes)) if i not in fixed and left * weights[i] / open_weight > stop[i]]
        if not over:
            for i in range(len(sizes)):
                target[i] = stop[i] if i in fixed else left * weights[i] / open_weight
            return target
        fixed |= set(over)
    return stop


def test_targets_equal_iterated_resharing(spark):
    rng = random.Random(5)
    for n in (1, 2, 5, 17):
        sizes = [rng.choice([0, 1, 3, 10, 200, 5000]) for _ in range(n)]
        names = sorted(f"s{i:02d}" for i in range(n))
        df = spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long")
        got = {r.source: r.target for r in mixture.source_targets(df).collect()}
        want = levels(sizes, [1 + i % 3 for i in range(n)], 3.0)
        for name, w in zip(names, want):
            assert got[name] == pytest.approx(w, abs=1e-6)


def check(rows, texts):
    import re
    by = {}
    for r in rows:
        by.setdefault((r.source_size, round(r.target, 6)), []).append(r)
        assert 0 <= r.taken <= 3 * r.size
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id] or ""))


def test_mix_of_the_documents(spark, folder, documents):
    rows = QUERIES["op2_mixture"](spark, folder).collect()
    source = {r.doc_id: r.source for r in documents.collect()}
    texts = {r.doc_id: r.text for r in documents.collect()}
    check(rows, texts)
    taken, target, size = {}, {}, {}
    for r in rows:
        s = source[r.doc_id]
        taken[s] = taken.get(s, 0) + r.taken
        size[s] = size.get(s, 0) + r.size
        target[s] = r.target
        assert size[s] <= r.source_size
    names = sorted(taken)
    want = levels([size[s] for s in names], [1 + i % 3 for i in range(len(names))], 3.0)
    for s, w in zip(names, want):
        assert target[s] == pytest.approx(w) and taken[s] == round(w)
    positions = [r.position for r in rows if r.position is not None]
    assert positions == sorted(positions) and 0 <= positions[0] and positions[-1] <= 1
    again = QUERIES["op2_mixture"](spark, folder).collect()
    assert sorted(again) == sorted(rows)


def test_schedule_is_inverted(spark):
    cases = [(x / 20, t) for x in range(21) for t in (-0.9, -0.5, 0.0, 0.5, 0.9)]
    df = spark.createDataFrame(cases, "share double, tilt double")
    for r in df.withColumn("t", mixture.time_of(F.col("share"), F.col("tilt"))).collect():
        assert r.t + r.tilt * r.t * (1 - r.t) == pytest.approx(r.share, abs=1e-9)


def test_repeats_and_stops(frame):
    docs = frame(["a b c"], [1]).withColumn("source", F.lit("x")).unionByName(
        frame(["w " * 100], [2]).withColumn("source", F.lit("y")))
    rows = {r.doc_id: r for r in mixture.mix_plan(docs).collect()}
    assert rows[1].taken == 9 and rows[1].target == 9.0 and rows[2].taken == 94
    mixed = mixture.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert sorted(r.doc_id for r in mixed.collect()) == [1, 1, 1, 2]


def test_edges_and_empty(edge, none):
    rows = mixture.mix_plan(edge).collect()
    assert len(rows) == len(rows_of_edge())
    assert all(r.taken == 0 for r in rows if r.size == 0)
    sources = len({r[3] for r in rows_of_edge()})
    assert abs(sum(r.taken for r in rows) - sum(r.size for r in rows)) <= sources
    assert mixture.mixed_documents(edge).columns == edge.columns
    assert mixture.mix_plan(none).count() == 0 and mixture.mixed_documents(none).count() == 0
