import random
import re

import numpy as np
import pytest

from tallyforge.llm import neardup

from .conftest import rows_of_edge


def shingles(text, width):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if len(words) < width:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def brute(rows, width=3, above=85):
    """Component ids by comparing all pairs; rows: (id, text)."""
    sets = [shingles(t, width) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= above * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        component = min(ids, default=None) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), component, doc_id == component))
    return sorted(out, key=repr)


def got(df, **k):
    return sorted((tuple(r) for r in neardup.mark_near(df, **k).select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


def variants(rng, words, n, most):
    """Texts that differ from one text in up to ``most`` single words."""
    out = []
    for _ in range(n):
        copy = list(words)
        for _ in range(rng.randrange(most + 1)):
            copy[rng.randrange(len(copy))] = f"edit{rng.randrange(10 ** 6)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("width,above", [(3, 85), (5, 80)])
def test_variants_of_one_text_at_the_threshold(frame, width, above):
    rng = random.Random(width)
    # 148 shingles: with 3-word shingles four edits are exactly 136 / 160 = 0.85.
    base = [f"w{i}" for i in range(150)]
    texts = variants(rng, base, 150, 9) + variants(rng, [f"v{i % 37}x{i}" for i in range(80)], 60, 6)
    texts += [f"alone {i} is no copy of any other text at all {i * 7}" for i in range(40)]
    rng.shuffle(texts)
    assert got(frame(texts), width=width, above=above) == brute(list(enumerate(texts)), width, above)


def test_chains_without_a_centre(frame):
    words = [f"c{i}" for i in range(200)]
    texts = []
    for step in range(30):  # each text is near the next one only
        words = words[5:] + [f"n{step}_{k}" for k in range(5)]
        texts.append(" ".join(words))
    rows = list(enumerate(texts))
    assert got(frame(texts)) == brute(rows) and len({r[2] for r in brute(rows)}) == 1


def test_short_texts(frame):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randrange(7))) for _ in range(120)]
    assert got(frame(texts)) == brute(list(enumerate(texts)))


def test_estimates_are_near_the_truth():
    rng = np.random.default_rng(0)
    for share in (0.3, 0.6, 0.9):
        errors = []
        for _ in range(30):
            pool = rng.integers(0, 2 ** 63, 2000).astype(np.uint64) * np.uint64(2)
            same = int(1000 * share)
            a = np.unique(np.concatenate([pool[:same], pool[same:1000]]))
            b = np.unique(np.concatenate([pool[:same], pool[1000:2000 - same]]))
            truth = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            one = neardup.estimate(neardup.registers(a)[None], neardup.registers(b)[None], np.array([len(a)]), np.array([len(b)]))
            errors.append(one[0] - truth)
        assert abs(np.mean(errors)) < 0.03


def test_edges_and_empty(edge, none):
    rows = [(r[0], r[1]) for r in rows_of_edge()]
    assert got(edge) == brute(rows)
    kept = neardup.drop_near(edge)
    assert kept.columns == edge.columns
    left = [r.doc_id for r in kept.collect()]
    assert left.count(6) == 1 and left.count(None) == 1 and 8 not in left and 1 not in left and -5 in left and 2 in left and 3 in left
    assert neardup.mark_near(none).count() == 0 and neardup.drop_near(none).count() == 0
