import hashlib
import random

from tallyforge.llm import exact

from .conftest import rows_of_edge


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t in rows:
        ids = groups[t or ""]
        known = [x for x in ids if x is not None]
        out.append((i, max(known, default=None), len(ids), hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df, **k):
    rows = exact.mark_exact(df, **k).collect()
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=repr), rows


def test_hot_groups_and_uneven_partitions(spark, frame):
    rng = random.Random(1)
    texts = [rng.choice(["hot", "hot", f"t{rng.randrange(300)}", "", None]) for _ in range(3000)]
    for parts in (1, 7, 40):
        df = frame(texts).repartition(parts)
        keys, rows = got(df)
        assert keys == brute(list(enumerate(texts)))
        assert sum(r.kept for r in rows) == len({t or "" for t in texts})
    keys, _ = got(frame(texts), fan_in=2)
    assert keys == brute(list(enumerate(texts)))


def test_smallest(frame):
    rows = exact.mark_exact(frame(["a", "a", "b"]), keep="smallest").collect()
    assert sorted((r.doc_id, r.keep_id, r.kept) for r in rows) == [(0, 0, True), (1, 0, False), (2, 2, True)]


def test_edges_and_empty(edge, none):
    rows = [(r[0], r[1]) for r in rows_of_edge()]
    keys, found = got(edge)
    assert keys == brute(rows)
    assert sum(r.kept for r in found) == len({t or "" for _, t in rows})
    assert exact.mark_exact(none).count() == 0
    kept = exact.drop_exact(edge)
    assert kept.columns == edge.columns and kept.count() == len({t or "" for _, t in rows})
    assert {r.doc_id for r in kept.collect() if (r.text or "") == "same"} == {8}
    assert exact.drop_exact(none).count() == 0


def test_merge_continues_over_batches(spark, frame):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        texts = ["a"] * 10 + ["b"] * 2 + ["c"]
        assert got(frame(texts).coalesce(1))[0] == brute(list(enumerate(texts)))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
