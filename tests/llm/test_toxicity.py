import zlib

from tallyforge.llm import toxicity

from .conftest import rows_of_edge


def auc(pairs):
    pos = [s for s, y in pairs if y]
    neg = [s for s, y in pairs if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    rows = toxicity.toxicity(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert auc(held) > 0.9
    # Held-out labels have no influence.
    flipped = spark.createDataFrame([(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in truth.items()], "doc_id long, toxic int")
    again = {r.doc_id: r.score for r in toxicity.toxicity(docs, flipped).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-9 for r in rows)


def test_features_see_insults_signs_and_second_persons():
    plain, rude = (dict(zip(toxicity.FEATURES, toxicity.Reader({}).features(t))) for t in ("a calm text", "you are an IDIOT, 1d10t!!!"))
    assert plain["seed_hits"] == 0 and rude["seed_hits"] > 0 and rude["near_second_person"] > 0
    assert rude["masked_seeds"] > 0 and rude["capitals"] > 0 and rude["exclamations"] > 0


def test_edges_and_empty(spark, edge, none):
    labels = spark.createDataFrame([(1, 1), (1, 0), (4, None), (6, 0), (9, 0), (None, 1), (10, 1), (11, 0), (2, 0)], "doc_id long, toxic int")
    rows = toxicity.toxicity(edge, labels).collect()
    assert len(rows) == len(rows_of_edge()) and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.toxicity(none, labels).count() == 0
    unlabelled = toxicity.toxicity(edge, labels.limit(0)).collect()
    assert {r.score for r in unlabelled} == {0.0}
