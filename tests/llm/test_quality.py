import numpy as np

from tallyforge.llm import quality

from .conftest import rows_of_edge


def test_em_finds_the_labellers_accuracies():
    rng = np.random.default_rng(1)
    n = 20_000
    truth = rng.random(n) < 0.8
    right = [0.95, 0.9, 0.85, 0.9, 0.8, 0.95, 0.9, 0.85, 0.9]
    columns = []
    for share in right:
        ok = rng.random(n) < share
        vote = np.where(ok == truth, "g", "b")
        columns.append(np.where(rng.random(n) < 0.1, "-", vote))
    counts = {}
    for p in map("".join, zip(*columns)):
        counts[p] = counts.get(p, 0) + 1
    model = quality.fit_labels(counts)
    assert abs(model.good - 0.8) < 0.03
    for found, share in zip(model.accuracy().values(), right):
        assert abs(found - share) < 0.03
    assert len(counts) <= 3 ** len(quality.LABELLERS)


def test_agrees_with_human_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.quality_scores(docs).join(labels, "doc_id").collect()
    good = [r for r in rows if r.quality == 1]
    bad = [r for r in rows if r.quality == 0]
    assert sum(r.keep for r in good) / len(good) > 0.98
    assert sum(not r.keep for r in bad) / len(bad) > 0.9


def test_filter_keeps_what_the_scores_keep(spark, documents):
    model = quality.fit_quality(documents)
    keep = {r.doc_id for r in quality.quality_scores(documents, model).where("keep").collect()}
    kept = quality.good_documents(documents, model)
    assert kept.columns == documents.columns and {r.doc_id for r in kept.collect()} == keep
    again = quality.fit_quality(documents.repartition(5))
    assert np.allclose(model.weights, again.weights, atol=1e-3)


def test_edges_and_empty(edge, none):
    rows = quality.quality_scores(edge).collect()
    assert len(rows) == len(rows_of_edge())
    assert all(r.score == 0 and not r.keep for r in rows if r.doc_id in (2, 3, 7))
    assert all(0 <= r.score <= 1 for r in rows)
    assert quality.good_documents(edge).columns == edge.columns
    assert quality.quality_scores(none).count() == 0 and quality.good_documents(none).count() == 0


def test_one_pattern(frame):
    rows = quality.quality_scores(frame(["The cat sat on the mat and it was good."] * 3)).collect()
    assert len({r.score for r in rows}) == 1
