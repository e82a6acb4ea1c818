import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyforge.llm import tokenfiles
from tallyforge.llm.queries import QUERIES

from .conftest import rows_of_edge

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def brute(docs, encode):
    """Rows of (id, text) in order of id, null first."""
    out, at = [], 0
    for i, text in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*encode(text), 2], "<u4")
        out.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return sorted(out, key=repr)


TRICKY = ["a", "Ab", " ", "  ", "\n", "\t", "\r\n", "'s", "'", "'re", "12", "½", ".", ",", "!?", "é", "É", "\x1c", "\x85", "\xa0", " ", "​", "᠎",
          "　", "́", "中文", "\U0001F600", "<|endoftext|>", "_", ")", "wordword"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(TRICKY) | st.characters(exclude_categories=["Cs"]), max_size=30).map("".join))
def test_cut_texts_have_the_ids_of_whole_texts(whole, text):
    encode = tokenfiles.encoder(PATH)
    got = np.frombuffer(next(encode.encode([text])), encode.dtype).tolist()
    assert got == whole(text)
    first, rest = tokenfiles.pieces_of(text)
    assert " ".join([first, *rest]) == text


def test_few_pieces_kept(whole, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokenfiles, "KEPT_PIECES", 5)
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    encode = tokenfiles.Encoder(tokenizer, "<u4")
    texts = [f"some words {i}, and others.\nnext {'y' * 100}" for i in range(9)] * 2
    for text, data in zip(texts * 2, [*encode.encode(texts), *encode.encode(texts)]):
        assert np.frombuffer(data, "<u4").tolist() == whole(text)


def test_query(spark, folder, documents, rows, whole):
    got = rows(QUERIES["op13_token_files"](spark, folder))
    assert sorted(got, key=repr) == brute([(r.doc_id, r.text) for r in documents.collect()], whole)


def test_edges(spark, edge, none, rows, whole):
    plain = [(r[0], r[1]) for r in rows_of_edge()]
    got = rows(tokenfiles.token_index(edge, PATH))
    # Rows without id, and rows with equal id, are alike here, so their order shows in nothing.
    assert sorted(got, key=repr) == brute(plain, whole)
    assert rows(tokenfiles.token_index(none, PATH)) == []


@pytest.mark.parametrize("length", [4, 7, 2048])
def test_sequences_are_views_of_the_file(spark, frame, rows, whole, length):
    texts = ["one two three, four" * (i % 5) for i in range(40)] + ["x y " * 3000]
    folder = tokenfiles.default_folder(spark)
    shards = tokenfiles.write_tokens(frame(texts).repartition(3), PATH, folder, length=length)
    found, checked = [], 0
    for row in shards.orderBy("shard").collect():
        shard = tokenfiles.TokenShard(row.path)
        here = []
        for i in range(len(shard)):
            ids, mask = shard[i]
            assert len(ids) == len(mask) == length
            assert mask.all() or i == len(shard) - 1
            here += ids[mask].tolist()
            before = pa.total_allocated_bytes()
            again, _ = shard[i]
            checked += pa.total_allocated_bytes() == before and not again.flags.owndata
        with pytest.raises(IndexError):
            shard[len(shard)]
        assert len(here) == row.tokens and row.before == len(found)
        found += here
        shard.close()
    want = [t for text in texts for t in [*whole(text), 2]]
    assert found == want and checked
    assert sorted(rows(tokenfiles.read_tokens(shards, folder)), key=repr) == brute(list(enumerate(texts)), whole)


def test_a_shard_with_other_ids_than_documents_fails(spark, frame):
    folder = tokenfiles.default_folder(spark)
    shards = tokenfiles.write_tokens(frame(["a b c", "d"]).coalesce(1), PATH, folder)
    path = shards.collect()[0].path
    docs = pa.ipc.open_file(f"{path}.docs.arrow").read_all()
    with pa.OSFile(f"{path}.docs.arrow", "wb") as out, pa.ipc.new_file(out, docs.schema) as writer:
        writer.write_table(docs.slice(0, 0))
    with pytest.raises(Exception, match="belong to no document"):
        tokenfiles.read_tokens(shards, folder).collect()
