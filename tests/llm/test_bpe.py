import hashlib
import random

import public_tokenizers as P

from tallyforge.llm import bpe
from tallyforge.llm.queries import QUERIES

from .conftest import rows_of_edge

RANKS = P.path("byte_bpe_multi_50k.tiktoken")


def whole(text):
    return bpe.encoding(RANKS, P.PATTERN).encode_ordinary(text or "")


def digest(ids):
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_cuts_are_safe():
    rng = random.Random(2)
    parts = ["a", "bc", " ", "  ", "\n", "'s", "'", "1", "!", "\x1c", "\x85", "　", "é", "\t", "\U0001F600", " ", "\r\n"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(50))
        size = rng.randrange(1, 12)
        cut = list(bpe.pieces(text, size))
        assert "".join(cut) == text
        assert [i for p in cut for i in whole(p)] == whole(text), repr(text)


def test_long_runs():
    enc = bpe.encoding(RANKS, P.PATTERN)
    for text in ("x" + " " * 40_000 + "y  z" + "\n" * 50_000, " " * 40_000, "\n" * 33_000 + "a"):
        assert bpe.encode_piece(enc, text) == enc.encode_ordinary(text)
    huge = " " * 1_200_000 + "a"  # more than the library's own pattern engine takes
    assert enc.decode_bytes([i for p in bpe.pieces(huge) for i in bpe.encode_piece(enc, p)]) == huge.encode()


def test_documents(spark, folder, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in QUERIES["op7_bpe"](spark, folder).collect():
        ids = whole(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), digest(ids))
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_edges_empty_and_decoding(edge, none):
    rows = bpe.bpe_digests(edge, RANKS, P.PATTERN, with_ids=True)
    want = sorted((str(i), digest(whole(t))) for i, t, *_ in rows_of_edge())
    assert sorted((str(r.doc_id), r.ids_sha256) for r in rows.collect()) == want
    back = sorted(bytes(r.data) for r in bpe.decode_ids(rows, RANKS, P.PATTERN).collect())
    assert back == sorted((t or "").encode() for _, t, *_ in rows_of_edge())
    assert bpe.bpe_digests(none, RANKS, P.PATTERN).count() == 0
