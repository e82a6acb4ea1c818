import hashlib
import tarfile
import zlib

from tallyforge.llm import media
from tallyforge.llm.queries import QUERIES

from .conftest import rows_of_edge


def expected(text):
    data = (text or "").encode()
    payload = data + b"\xff" * (max(1, -(-len(data) // 576)) * 576 - len(data))
    return len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:])


def test_png_round_trip():
    for data in (b"", b"a" * 576, bytes(range(256)) * 9, b"z" * 577):
        payload = media.padded(data)
        image = media.to_png(payload)
        assert media.from_png(image) == payload
        width, height, depth = media.png_header(image[:media.HEADER_BYTES])
        assert width * height == len(payload) and depth == 8
        assert len(media.feature_of(payload)) == 16


def test_documents(spark, folder, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    seen = {}
    for r in QUERIES["op10_media"](spark, folder).collect():
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == expected(texts[r.doc_id])
        values = (r.media_bytes, r.media_sha256, r.feature)
        assert seen.setdefault(texts[r.doc_id], values) == values


def test_shards_are_tar_files(spark, frame, tmp_path):
    docs = frame(["one", "two", "one", None]).coalesce(1)
    index = media.store_payloads(docs, f"file://{tmp_path}/shards").collect()
    assert len({r.shard for r in index}) == 1
    with tarfile.open(index[0].shard) as tar:
        members = {m.name: m for m in tar.getmembers()}
        assert len(members) == 3  # equal payloads once
        for r in index:
            m = members[f"{r.digest}.png"]
            assert (m.offset_data, m.size) == (r.offset, r.length)


def test_edges_and_empty(edge, none):
    rows = media.media_columns(edge).collect()
    assert sorted((str(r.doc_id), r.payload_sha256, r.tail_crc32) for r in rows) == sorted(
        (str(i), expected(t)[2], expected(t)[3]) for i, t, *_ in rows_of_edge())
    assert media.media_columns(none).count() == 0
