import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyforge.llm import importance
from tallyforge.llm.queries import QUERIES

from .conftest import rows_of_edge

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def features(text):
    w = words(text)
    return Counter(zlib.crc32(" ".join(w[i:i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1))


def brute(docs, target, percent=5, min_words=20):
    """Rows of (id, text): features, weight, score and rank, one document after the other."""
    s = sum((features(t) for _, t in docs), Counter())
    t = sum((features(x) for x in target), Counter())
    S, T = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in s}
    out = []
    for i, text in docs:
        f = features(text)
        weight = sum(gain[b] * n for b, n in f.items())
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, sum(f.values()), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(text))])
    large = sorted((r for r in out if r[5] >= min_words), key=lambda r: (-r[3], -math.inf if r[0] is None else r[0]))
    for rank, r in enumerate(large[:percent * len(large) // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=repr)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"bc", b"\xc3\xa9", b"w" * 63, b"w" * 64, b"w" * 65, b"long" * 700]), max_size=9), max_size=4), st.integers(0, 2))
def test_checksums_of_runs(texts, known):
    flat = [w for t in texts for w in t]
    if not flat:
        return
    import numpy as np
    owner = np.array([i for i, t in enumerate(texts) for _ in t])
    known = min(known, len(flat))
    for k, (of, bucket) in enumerate(importance.run_buckets(flat, owner, known), 1):
        want = [(owner[i], zlib.crc32(b" ".join(flat[i:i + k])) % 10000) for i in range(len(flat) - k + 1)
                if owner[i] == owner[i + k - 1] and i + k > known]
        assert list(zip(of, bucket)) == want


def test_slices_show_every_run_once(monkeypatch):
    import numpy as np
    monkeypatch.setattr(importance, "SLICE_WORDS", 5)
    monkeypatch.setattr(importance, "PIECE_BYTES", 12)
    rng = random.Random(2)
    texts = [" ".join(rng.choices(["ab", "c", "defghij", "É"], k=n)) for n in (0, 1, 40, 2, 3, 0, 17)]
    got = [Counter() for _ in texts]
    for w, owner, known in importance._slices(texts):
        assert len(w) == len(owner)
        for of, bucket in importance.run_buckets(w, owner, known):
            for o, b in zip(of, bucket):
                got[o][int(b)] += 1
    assert got == [features(t) for t in texts]
    assert np.concatenate([o[k:] for _, o, k in importance._slices(texts)]).tolist() == [i for i, t in enumerate(texts) for _ in words(t)]


def bench_frame(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, text string")


def test_ties_and_repeated_rows(spark, frame, rows):
    rng = random.Random(7)
    vocabulary = [f"word{i}" for i in range(60)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.choice([5, 19, 20, 21, 90]))) for _ in range(150)]
    ids = list(range(150)) + [7] * 200 + [None] * 30  # one row two hundred times
    texts += [texts[7] + " more" * 30] * 200 + [texts[3] * 5] * 30
    target = [texts[1], None, "word1 word2 word3"]
    got = rows(importance.resampled(frame(texts, ids), bench_frame(spark, target), percent=40))
    assert sorted(got, key=repr) == brute(list(zip(ids, texts)), target, percent=40)


@pytest.mark.parametrize("partitions", [1, 7])
def test_any_number_of_ranges(spark, frame, rows, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        texts = [f"{i % 9} x y " * 10 for i in range(300)]
        got = rows(importance.resampled(frame(texts).repartition(13), bench_frame(spark, ["x y"]), percent=100))
        assert sorted(got, key=repr) == brute(list(enumerate(texts)), ["x y"], percent=100)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_edges(spark, edge, none, rows):
    plain = [(r[0], r[1]) for r in rows_of_edge()]
    got = rows(importance.resampled(edge, bench_frame(spark, ["lorem ipsum"]), percent=50))
    assert sorted(got, key=repr) == brute(plain, ["lorem ipsum"], percent=50)
    assert rows(importance.resampled(none, bench_frame(spark, ["a"]))) == []
    got = rows(importance.resampled(edge, bench_frame(spark, []).limit(0), percent=50))
    assert sorted(got, key=repr) == brute(plain, [], percent=50)


def test_query(spark, folder, documents, rows):
    target = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    got = rows(QUERIES["op12_importance"](spark, folder))
    assert sorted(got, key=repr) == brute([(r.doc_id, r.text) for r in documents.collect()], target)
