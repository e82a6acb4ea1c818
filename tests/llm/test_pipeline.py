import hashlib

import public_tokenizers as P

import corpus_pipeline
from tallyforge.llm import bpe, quality

from .test_mixture import levels
from .test_neardup import brute as near


def test_stages_against_brute_force(spark, folder, documents):
    docs = {r.doc_id: r for r in documents.collect()}
    model = quality.fit_quality(documents)
    good = {i: r for i, r in docs.items() if model.score(r.text)[2] >= quality.THRESHOLD}
    last = {}
    for i, r in good.items():
        last[r.text] = max(i, last.get(r.text, i))
    exact = {i: good[i] for i in last.values()}
    kept = {i for i, _, component, _ in near([(i, r.text) for i, r in exact.items()], corpus_pipeline.SHINGLE_WORDS, corpus_pipeline.SIMILARITY)
            if i == component}
    size = {i: len(exact[i].text.split()) for i in kept}
    sources = sorted({exact[i].source for i in kept})
    totals = [sum(size[i] for i in kept if exact[i].source == s) for s in sources]
    target = dict(zip(sources, levels(totals, [1 + k % 3 for k in range(len(sources))], 3.0)))

    rows = corpus_pipeline.run(spark, folder).collect()
    enc = bpe.encoding(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    taken = {}
    for r in rows:
        assert r.doc_id in kept
        ids = enc.encode_ordinary(docs[r.doc_id].text)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        taken[docs[r.doc_id].source] = taken.get(docs[r.doc_id].source, 0) + size[r.doc_id]
    for s in sources:  # a document cut by the target is passed on whole
        assert round(target[s]) <= taken[s] <= target[s] + max(size[i] for i in kept if exact[i].source == s) + 1


def test_stages_return_the_columns_of_documents(spark, folder, documents):
    docs = documents
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == documents.columns
