import random
import re
from collections import Counter, defaultdict

import pytest

from tallyforge.llm import divergence
from tallyforge.llm.queries import QUERIES

from .conftest import rows_of_edge

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, min_docs=3, top=200):
    """Rows of (lang, source, text); every term of every pair of sources."""
    langs = defaultdict(lambda: defaultdict(Counter))
    docs = defaultdict(Counter)
    for lang, source, text in rows:
        words = TERM.findall(lowered(text or ""))
        langs[lang or ""][source or ""].update(words)
        docs[lang or ""].update(set(words))
    out = []
    for lang, sources in langs.items():
        kept = sorted(t for t, n in docs[lang].items() if n >= min_docs)
        whole = sum(sources.values(), Counter())
        total = sum(whole[t] for t in kept)

        def shares(counts, n):
            return {t: 1 + 10**9 * (counts[t] + 1) // (n + len(kept)) for t in kept}

        common = shares(whole, total)
        own = {s: shares(c, sum(c[t] for t in kept)) for s, c in sources.items()}
        for s, p in own.items():
            pairs = [(o, sum((p[t] - q[t]) ** 2 // q[t] for t in kept)) for o, q in own.items() if o != s]
            terms = [(t, (p[t] - common[t]) ** 2 // common[t]) for t in kept if sources[s][t] and p[t] > common[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i) for i, (item, value) in enumerate(items, 1) if part == "pair" or i <= top]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, "lang string, source string, text string")


def test_equals_all_terms_of_all_pairs(spark, rows):
    rng = random.Random(11)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)] + ["Émile", "ÄÖ", "hot"]
    data = []
    for i in range(400):
        source = rng.choice(["a", "a", "a", "b", "c", "dé", None, "e2"])
        text = " ".join(rng.choices(words, k=rng.randrange(0, 30))) + " hot HOT" * rng.randrange(3) + "1x9"
        data.append((rng.choice(["en", "en", "fr", None]), source, rng.choice([text, text, None])))
    data += [("xx", "only", "one two"), ("xx", "other", "three"), ("en", "silent", "123 !?")]
    assert rows(divergence.divergence(frame(spark, data), top_terms=7)) == brute(data, top=7)
    assert rows(divergence.divergence(frame(spark, data), min_docs=1)) == brute(data, min_docs=1)


@pytest.mark.parametrize("limits", [(1, 1, 1, 1), (50, 3, 40, 5)])
def test_bounds_do_not_change_the_sums(limits):
    """Flushed counters and trees cut anywhere give the same parts; run here without workers, which would not see the bounds."""
    import pyarrow as pa

    rng = random.Random(3)
    paths = sorted((rng.choice("xy"), sorted((p, rng.randrange(1, 4) * 10, 3 + p) for p in rng.sample(range(1, 8), rng.randrange(1, 7)))) for _ in range(300))
    node = pa.list_(pa.struct([("place", pa.int64()), ("share", pa.int64()), ("absent", pa.int64())]))
    batches = [pa.RecordBatch.from_arrays([
        pa.array([lang for lang, _ in part]), pa.array([[dict(zip(("place", "share", "absent"), e)) for e in p] for _, p in part], node),
        pa.array([2] * len(part))], names=["lang", "path", "m"]) for part in (paths[:100], paths[100:101], paths[101:])]

    def summed(found):
        out = Counter()
        for batch in found:
            for r in batch.to_pylist():
                out[r["lang"], r["place"], r["other"], r["share"]] += r["value"]
        return out

    want = Counter()
    f = lambda p, q: (p - q) ** 2 // q
    for lang, path in paths:
        for a, p, p0 in path:
            want[lang, a, None, p] += 2
            for b, q, q0 in path:
                if a != b:
                    want[lang, a, b, None] += 2 * (f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0))
    before = divergence.TREE_ROWS, divergence.TREE_ENTRIES, divergence.HELD
    assert summed(divergence._trees(iter(batches))) == want
    try:
        divergence.TREE_ROWS, divergence.TREE_ENTRIES, divergence.HELD = limits[1:]
        assert summed(divergence._trees(iter(batches))) == want
    finally:
        divergence.TREE_ROWS, divergence.TREE_ENTRIES, divergence.HELD = before
    texts = pa.RecordBatch.from_pydict({"lang": ["a", "a", "b"] * 30, "source": ["s", "t", "s"] * 30, "text": ["one two two", "two É", "one"] * 30})
    parts = Counter()
    for batch in divergence._count_terms(limits[0])(iter([texts])):
        for r in batch.to_pylist():
            parts[r["lang"], r["source"], r["term"], "n"] += r["n"]
            parts[r["lang"], r["source"], r["term"], "docs"] += r["docs"]
    assert parts["a", "s", "two", "n"] == 60 and parts["a", "s", "two", "docs"] == 30 and parts["a", "t", "É", "docs"] == 30


def test_edges(spark, edge, none, rows):
    plain = [(r[2], r[3], r[1]) for r in rows_of_edge()]
    assert rows(divergence.divergence(edge)) == brute(plain)
    assert rows(divergence.divergence(none)) == []


def test_long_text_and_ties(spark, rows):
    data = [("en", "a", "tied words here " * 40_000), ("en", "b", "tied words"), ("en", "b", "words here tied"), ("en", "c", None)]
    assert rows(divergence.divergence(frame(spark, data))) == brute(data)


def test_query(spark, folder, documents, rows):
    plain = [(r.lang, r.source, r.text) for r in documents.collect()]
    assert rows(QUERIES["op11_divergence"](spark, folder)) == brute(plain)
