"""Byte-level BPE with the tiktoken library and a local rank file.

Long texts are encoded piece by piece.  A piece may end only where no match of
the split pattern can cross: before white space that follows another
character, and before the last character of a run of white space that is
followed by text (the pattern itself splits a run there).  So the ids equal
those of the whole text, and memory follows the piece length, not the text.
White-space runs beyond the library's stack are merged as the one piece they
are.  Decoding joins the bytes of the ids; a piece is decoded as soon as it is
encoded, and bytes need not be valid UTF-8 until they are joined.

Defined cases: null text is the empty text, with no ids and the hash of no
bytes; repeated rows give repeated rows; other columns are not read; an empty
table gives an empty result; one run without white space is encoded as one
piece.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bounded_batches, columns_of, record_batch, texts

#: Characters of a piece; texts up to this length are encoded whole.
PIECE_CHARS = 1 << 16
#: White-space runs from here on are merged without the pattern (its engine would run out of stack).
LONG_SPACE = 1 << 15


@lru_cache(maxsize=2)
def encoding(rank_file: str, pattern: str):
    """The encoding, read once in each Python worker."""
    import tiktoken

    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


# White space of the split pattern's engine (Unicode White_Space; narrower than Python's \s).
_WS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CUT = re.compile(f"(?<=[^{_WS}])(?=[{_WS}])|(?<=[{_WS}])(?=[{_WS}][^{_WS}])")
_SPACE = re.compile(f"[{_WS}]{{{LONG_SPACE},}}")


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """The text in order, cut at safe boundaries at least ``size`` apart."""
    start = 0
    while len(text) - start > size:
        cut = _CUT.search(text, start + size)
        if cut is None or cut.start() >= len(text):
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def encode_piece(enc, text: str) -> list[int]:
    """Ids of a piece; a very long run of white space is one match of the pattern by itself."""
    if len(text) < LONG_SPACE or not _SPACE.search(text):
        return enc.encode_ordinary(text)
    ids: list[int] = []
    at = 0
    for run in _SPACE.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1  # the last one belongs to what follows
        ids += enc.encode_ordinary(text[at:run.start()])
        ids += enc._encode_single_piece(text[run.start():end])
        at = end
    return ids + enc.encode_ordinary(text[at:])


def _digests(rank_file: str, pattern: str, with_ids: bool):
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    schema = pa.schema(fields + [("ids", pa.list_(pa.int32()))] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(rank_file, pattern)
        number = [str(i) for i in range(enc.n_vocab)]
        for rows in columns_of(batches):
            out: dict[str, list] = {f.name: [] for f in schema}
            for doc_id, text in zip(rows["doc_id"], rows["text"]):
                ids_hash, bytes_hash, n, kept = hashlib.sha256(), hashlib.sha256(), 0, []
                for piece in pieces(text):
                    ids = encode_piece(enc, piece)
                    if not ids:
                        continue
                    ids_hash.update((("," if n else "") + ",".join([number[i] for i in ids])).encode())
                    bytes_hash.update(enc.decode_bytes(ids))
                    n += len(ids)
                    if with_ids:
                        kept += ids
                out["doc_id"].append(doc_id)
                out["n_tokens"].append(n)
                out["ids_sha256"].append(ids_hash.hexdigest())
                out["decoded_sha256"].append(bytes_hash.hexdigest())
                if with_ids:
                    out["ids"].append(kept)
            yield record_batch(schema, out)

    return run


def bpe_digests(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                with_ids: bool = False) -> DataFrame:
    """Encode and decode each text; doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids.

    ``rank_file`` must be readable by every worker.
    """
    bounded_batches(docs.sparkSession)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return texts(docs, id_col, text_col).mapInArrow(_digests(rank_file, pattern, with_ids), schema)


def decode_ids(tokens: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """From doc_id and ids: doc_id and the raw bytes (``data`` binary)."""
    schema = pa.schema([("doc_id", pa.int64()), ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(rank_file, pattern)
        for rows in columns_of(batches):
            yield record_batch(schema, {"doc_id": rows["doc_id"], "data": [enc.decode_bytes(i or []) for i in rows["ids"]]})

    bounded_batches(tokens.sparkSession)
    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, data binary")
