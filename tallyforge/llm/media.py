"""Media columns: content-addressed payloads in tar shards.

A text's bytes, padded to whole rows of 576 samples, become a lossless 8-bit
grey image (PNG, 576 pixels wide).  A map task appends its images to tar
shards in the shared folder and returns, per row, the digest that names the
payload, the shard, and offset and length of the image in it.  Equal payloads
of one shard are stored once and share their address.  Shard names are fresh
for each task attempt, so a task that runs again leaves at most an unused file
behind; the index is checkpointed before anyone reads it.

The reader goes through the index in shard order.  It fills the metadata
columns from a range read of the image header alone (33 bytes), and the
payload columns from a range read of the image itself.

The folder is reached with pyarrow's file systems, so it may be any store
whose address they know (file, hdfs, s3, gs).

Defined cases: null text is the empty text, whose payload is one row of
padding; a very long text is one payload, held by its task alone; repeated rows
share their values, so there are no ties; other columns are not read; an
empty table writes no shard and gives an empty result.
"""

from __future__ import annotations

import hashlib
import struct
import tarfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpointed, ensure_checkpoint_dir
from .common import bounded_batches, columns_of, record_batch, texts

#: Samples of an image row; payloads are whole rows.
ROW = 576
PAD = b"\xff"
#: A shard is closed beyond this size.
SHARD_BYTES = 64 << 20
PNG_SIGNATURE = b"\x89PNG\r\n\x1a\n"
HEADER_BYTES = 33

_INDEX = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("digest", pa.string()), ("shard", pa.string()),
                    ("offset", pa.int64()), ("length", pa.int64())])
_READ = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("digest", pa.string()), ("shard", pa.string()),
                   ("offset", pa.int64()), ("length", pa.int64()), ("width", pa.int64()), ("height", pa.int64()),
                   ("bit_depth", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()),
                   ("tail_crc32", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())])


def padded(data: bytes) -> bytes:
    """Filled up to a positive multiple of ROW."""
    return data + PAD * (ROW - len(data) if len(data) < ROW else -len(data) % ROW)


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def to_png(payload: bytes) -> bytes:
    """An 8-bit grey image, one filter byte before each row."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, ROW)
    lines = np.zeros((len(rows), ROW + 1), np.uint8)
    lines[:, 1:] = rows
    header = struct.pack(">IIBBBBB", ROW, len(rows), 8, 0, 0, 0, 0)
    return PNG_SIGNATURE + _chunk(b"IHDR", header) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), 6)) + _chunk(b"IEND", b"")


def png_header(head: bytes) -> tuple[int, int, int]:
    """Width, height and bit depth from the first HEADER_BYTES bytes."""
    if head[:8] != PNG_SIGNATURE or head[12:16] != b"IHDR":
        raise ValueError("not a PNG image")
    return struct.unpack(">IIB", head[16:25])


def from_png(image: bytes) -> bytes:
    """The samples of an image that ``to_png`` made."""
    width, height, _ = png_header(image)
    at, data = 8, []
    while at < len(image):
        size, kind = struct.unpack(">I4s", image[at:at + 8])
        if kind == b"IDAT":
            data.append(image[at + 8:at + 8 + size])
        at += 12 + size
    lines = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(height, width + 1)
    return lines[:, 1:].tobytes()


def feature_of(payload: bytes) -> str:
    """Average hash: 64 equal stretches of the samples, each above or below the mean, as 16 hex digits."""
    samples = np.frombuffer(payload, np.uint8)
    edges = np.linspace(0, len(samples), 65).astype(np.int64)
    means = np.add.reduceat(samples.astype(np.int64), edges[:-1]) / np.diff(edges)
    bits = (means > samples.mean()).astype(np.uint8)
    return np.packbits(bits).tobytes().hex()


class _Shards:
    """Tar files that one task writes, each payload once per file."""

    def __init__(self, folder: str):
        from pyarrow import fs

        self.fs, self.folder = fs.FileSystem.from_uri(folder)
        self.out, self.path, self.at, self.known = None, "", 0, {}

    def close(self) -> None:
        if self.out is not None:
            self.out.write(b"\0" * 1024)  # the end of a tar file
            self.out.close()
            self.out = None

    def add(self, digest: str, make) -> tuple[str, int, int]:
        if digest in self.known:
            return self.known[digest]
        if self.out is None or self.at > SHARD_BYTES:
            self.close()
            self.path = f"{self.folder}/shard-{uuid.uuid4().hex}.tar"
            self.out, self.at, self.known = self.fs.open_output_stream(self.path), 0, {}
        image = make()
        info = tarfile.TarInfo(f"{digest}.png")
        info.size = len(image)
        head = info.tobuf(tarfile.PAX_FORMAT)
        self.out.write(head + image + b"\0" * (-len(image) % 512))
        address = (self.path, self.at + len(head), len(image))
        self.at += len(head) + len(image) + -len(image) % 512
        self.known[digest] = address
        return address


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = _Shards(folder)
        try:
            for rows in columns_of(batches):
                out: dict[str, list] = {f.name: [] for f in _INDEX}
                for doc_id, text in zip(rows["doc_id"], rows["text"]):
                    data = text.encode()
                    payload = padded(data)
                    # UTF-8 never holds the padding byte, so a payload belongs to one text only.
                    digest = hashlib.sha256(payload).hexdigest()
                    shard, offset, length = shards.add(digest, lambda p=payload: to_png(p))
                    for name, value in zip(_INDEX.names, (doc_id, len(data), digest, shard, offset, length)):
                        out[name].append(value)
                yield record_batch(_INDEX, out)
        finally:
            shards.close()

    return run


def store_uri(spark: SparkSession, folder: str) -> str:
    """The folder, made if need be, as an address that both Spark and pyarrow read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    found = files.makeQualified(path).toUri().toString()
    return found.replace("file:/", "file:///", 1) if found.startswith("file:/") and not found.startswith("file://") else found


def store_payloads(docs: DataFrame, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the shards; the checkpointed index: doc_id, n_bytes, digest, shard, offset, length.

    ``folder`` is a URI of the shared store; the default is a new folder below
    spark.checkpoint.dir.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    if folder is None:
        folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/media-{uuid.uuid4().hex}"
    return checkpointed(texts(docs, id_col, text_col).mapInArrow(
        _write(store_uri(spark, folder)), "doc_id long, n_bytes long, digest string, shard string, offset long, length long"))


def _read(scheme_folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(scheme_folder)
        path, shard, done = None, None, {}
        for rows in columns_of(batches):
            out: dict[str, list] = {f.name: [] for f in _READ}
            for doc_id, n_bytes, digest, at, offset, length in zip(*[rows[n] for n in _INDEX.names]):
                if at != path:
                    if shard is not None:
                        shard.close()
                    path, shard, done = at, store.open_input_file(at), {}
                if digest not in done:
                    shard.seek(offset)
                    width, height, depth = png_header(shard.read(min(HEADER_BYTES, length)))
                    shard.seek(offset)
                    image = shard.read(length)
                    payload = from_png(image)
                    if hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"payload at {at}:{offset} is not what its address says")
                    done[digest] = (width, height, depth, width * height, digest, zlib.crc32(payload[-32:]),
                                    hashlib.sha256(image).hexdigest(), feature_of(payload))
                for name, value in zip(_READ.names, (doc_id, n_bytes, digest, at, offset, length, *done[digest])):
                    out[name].append(value)
            yield record_batch(_READ, out)
        if shard is not None:
            shard.close()

    return run


def read_media(index: DataFrame, folder: str) -> DataFrame:
    """The index with header metadata and payload columns, read back from the shards.

    Rows are read in the order of the index, which is the order of each shard.
    """
    schema = ("doc_id long, n_bytes long, digest string, shard string, offset long, length long, width long, height long, "
              "bit_depth long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_sha256 string, feature string")
    return index.select(*_INDEX.names).mapInArrow(_read(folder), schema)


def media_columns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store every text and read it back; one row per document."""
    index = store_payloads(docs, None, id_col, text_col)
    return read_media(index, store_uri(docs.sparkSession, ensure_checkpoint_dir(docs.sparkSession))).select(
        "*", F.col("length").alias("media_bytes"))
