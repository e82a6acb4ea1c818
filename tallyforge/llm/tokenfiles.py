"""Token ids in Arrow files of fixed-size-list batches.

Texts are encoded, an end id follows each document, and the ids of all
documents, in ascending order of their doc_id, are cut into sequences of equal
length.  A shard is an Arrow file whose record batches hold two columns:
``ids``, a fixed-size list of the smallest unsigned integers that hold the
vocabulary, and ``mask``, a fixed-size list of booleans (false where a shard's
last sequence is filled up).  Nothing is compressed, so sequence i of a shard
is batch i // BATCH_SEQUENCES, row i % BATCH_SEQUENCES, and is read from a
memory map as a view, without a copy and without reading what stands before
it (``TokenShard``).  Beside each shard stands a second Arrow file with
doc_id, start and number of tokens of its documents.

Documents are dealt by ranges of doc_id, so a shard is a stretch of the corpus
and shards follow each other; a repeated doc_id is told apart by text and place
in the input, so repeated rows spread over ranges too.  Tasks stream: texts of a
batch are encoded and full batches of sequences written at once.  File names
are fresh for each task attempt and only those of attempts that came through
stand in the checkpointed list of shards, so a lost executor leaves at most an
unused file behind.  The number of ids before a shard is a prefix sum over
that list.

The tokenizer splits a text at its own pattern, and no match goes on from a
character that is no white space into a blank.  A text is therefore cut before
such blanks, and the ids of a cut piece are kept by the worker (a bounded
number of pieces), so that a common word is encoded once.  Very long texts are
cut in the same way; a batch of texts is in memory at a time.

Defined cases: null and empty text have the end id only; a null doc_id comes
first; the strings of special tokens are ordinary text; equal ids are written
in the order of their texts' hashes; other columns are not read; an empty table
has no shard and gives an empty result.
"""

from __future__ import annotations

import gc
import os
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import filterfalse, pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpointed, ensure_checkpoint_dir
from .common import bounded_batches, record_batch, texts
from .media import store_uri

#: Ids of a sequence, and sequences of a record batch.
SEQUENCE, BATCH_SEQUENCES = 2048, 128
END_ID = 2
#: Pieces whose ids a worker keeps, twice (the older half goes).
KEPT_PIECES = 350_000

_BLANK = re.compile(r"(?<=[^\s᠎])(?= )")
#: A blank behind white space: there the text is cut with care.  The pattern begins with the blank, which is found fast.
_SPACED = re.compile(r" (?<=[\s\u180e] )")
#: The pattern always ends a match between a letter or digit and a mark behind it, and between a single line end and what follows.
_MARK = re.compile(r"(?<=[0-9A-Za-zÀ-ÖØ-öø-ÿ])(?=[.,;:!?\n])|(?<=\S\n)(?=\S)")
#: Words encoded as one text.
WORDS_TOGETHER = 5_000


def _bare(word: str) -> bool:
    """Is there no white space (by any reading) at either end?"""
    return bool(word) and not (word[0].isspace() or word[-1].isspace() or word[0] == "\u180e" or word[-1] == "\u180e")


class Encoder:
    """A tokenizer and the ids, as bytes, of a bounded number of pieces that a worker has met.

    ``known`` holds pieces that follow a blank (which is left out of the key), ``starts`` parts that follow none.
    """

    def __init__(self, tokenizer, kind: str):
        self.tokenizer, self.dtype = tokenizer, np.dtype(kind)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.starts: dict[str, bytes] = {}
        vocabulary = tokenizer.get_vocab()
        self.token_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.token_bytes[i] = len(token)  # a character of the byte-level alphabet is a byte

    def _one_by_one(self, pieces: list[str]) -> list[bytes]:
        return [np.array(x.ids, self.dtype).tobytes() for x in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _together(self, words: list[str], blank: bool) -> list[bytes]:
        """Ids of bare words, each behind a blank or at the beginning of a line, from one text.

        The tokens of the text end where the words end; the lengths of tokens and words in bytes tell which they are.
        """
        text = " " + " ".join(words) if blank else "\n".join(words) + "\n"
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)
        ends = np.cumsum(self.token_bytes[ids])
        wanted = np.cumsum(np.fromiter(map(len, map(str.encode, words)), np.int64, len(words)) + 1)
        at = np.r_[0, np.searchsorted(ends, wanted) + 1]
        if at[-1] != len(ids) or not np.array_equal(ends[at[1:] - 1], wanted):
            return self._one_by_one([" " + word for word in words] if blank else words)  # it has joined words
        size = self.dtype.itemsize
        data, line_end = ids.tobytes(), 0 if blank else size
        return [data[i:j - line_end] for i, j in pairwise((at * size).tolist())]

    def _encoded(self, pieces: Iterable[str], blank: bool) -> dict[str, bytes]:
        bare = list(filter(str.isalnum, pieces))
        bare += filter(_bare, filterfalse(str.isalnum, pieces))
        out: dict[str, bytes] = {}
        for i in range(0, len(bare), WORDS_TOGETHER):
            out.update(zip(bare[i:i + WORDS_TOGETHER], self._together(bare[i:i + WORDS_TOGETHER], blank)))
        rest = list(filterfalse(out.__contains__, pieces))
        return out | dict(zip(rest, self._one_by_one([" " * blank + piece for piece in rest])))

    def _learn(self, pieces: set[str]) -> None:
        """Make the pieces known; parts at marks are encoded apart, so a word is encoded once whatever mark follows."""
        known, older, starts = self.known, self.older, self.starts
        kept = older.keys() & pieces
        known.update(zip(kept, map(older.__getitem__, kept)))
        pieces = pieces - kept
        words = set(filter(str.isalnum, pieces))
        tails: set[str] = set()
        split: list[tuple[str, list[str]]] = []
        for piece in pieces - words:
            parts = _MARK.split(piece)
            if len(parts) == 2 and parts[0] in known and parts[1] in starts:
                known[piece] = known[parts[0]] + starts[parts[1]]
                continue
            words.add(parts[0])
            if len(parts) > 1:
                split.append((piece, parts))
                tails.update(parts[1:])
        known.update(self._encoded(list(filterfalse(known.__contains__, words)), True))
        starts.update(self._encoded(list(filterfalse(starts.__contains__, tails)), False))
        for piece, parts in split:
            known[piece] = known[parts[0]] + b"".join([starts[part] for part in parts[1:]])

    def encode(self, texts_: list[str]) -> Iterator[bytes]:
        split = [pieces_of(text) for text in texts_]
        unknown: set[str] = set()
        for _, rest in split:
            unknown.update(filterfalse(self.known.__contains__, rest))
        gc.disable()  # nothing here is cyclic, and the dictionaries are large
        try:
            self._learn(unknown)
        finally:
            gc.enable()
        firsts = self._encoded({first for first, _ in split}, False)
        for first, rest in split:
            yield firsts[first] + b"".join(map(self.known.__getitem__, rest))
        if len(self.known) > KEPT_PIECES:
            self.older, self.known = self.known, {}
        if len(self.starts) > KEPT_PIECES:
            self.starts = {}


def pieces_of(text: str) -> tuple[str, list[str]]:
    """What stands before the first cut, and the pieces behind the blank at each cut.

    Cuts are made before blanks at which no match of the tokenizer's pattern goes on.
    """
    if _SPACED.search(text):
        first, *rest = _BLANK.split(text)
        return first, [piece[1:] for piece in rest]
    pieces = text.split(" ")
    return pieces.pop(0), pieces


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of a tokenizer file, made once in each Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
    return Encoder(tokenizer, "<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4")


class _ShardWriter:
    """One task's shard: the sequences and, beside them, the documents."""

    def __init__(self, folder: str, dtype: np.dtype, length: int):
        from pyarrow import fs

        store, at = fs.FileSystem.from_uri(folder)
        self.path, self.length, self.dtype = f"{at}/shard-{uuid.uuid4().hex}", length, dtype
        ids = pa.from_numpy_dtype(dtype)
        self.schema = pa.schema([("ids", pa.list_(ids, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.streams = [store.open_output_stream(f"{self.path}{end}") for end in (".arrow", ".docs.arrow")]
        self.sequences, self.docs = (pa.ipc.new_file(s, x) for s, x in zip(self.streams, (self.schema, _DOCS)))
        self.held: list[bytes] = []
        self.held_bytes = self.tokens = self.rows = 0

    def add(self, doc_ids: list[int | None], encoded: list[bytes]) -> None:
        sizes = [len(data) // self.dtype.itemsize for data in encoded]
        starts = self.tokens + np.r_[0, np.cumsum(sizes)]
        self.docs.write_batch(pa.RecordBatch.from_arrays(
            [pa.array(doc_ids, pa.int64()), pa.array(starts[:-1]), pa.array(sizes, pa.int64())], schema=_DOCS))
        self.tokens, self.rows = int(starts[-1]), self.rows + len(sizes)
        self.held += encoded
        self.held_bytes += sum(map(len, encoded))
        if self.held_bytes >= self.length * BATCH_SEQUENCES * self.dtype.itemsize:
            self._write(False)

    def _write(self, last: bool) -> None:
        """Full batches; at the end also what is left, filled up."""
        flat = np.frombuffer(b"".join(self.held), self.dtype)
        at, batch = 0, self.length * BATCH_SEQUENCES
        while len(flat) - at >= batch or last and at < len(flat):
            ids = flat[at:at + batch]
            fill = -len(ids) % self.length
            mask = np.r_[np.ones(len(ids), bool), np.zeros(fill, bool)]
            ids = np.r_[ids, np.zeros(fill, self.dtype)]
            self.sequences.write_batch(pa.RecordBatch.from_arrays(
                [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (ids, mask)], schema=self.schema))
            at += batch
        self.held = [flat[at:].tobytes()]
        self.held_bytes = len(self.held[0])

    def close(self) -> None:
        self._write(True)
        for x in (self.sequences, self.docs, *self.streams):
            x.close()


_DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
_SHARDS = pa.schema([("shard", pa.int32()), ("path", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64())])


def _write(folder: str, tokenizer: str, length: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        end = np.array([end_id], encode.dtype).tobytes()
        writer = None
        for batch in batches:
            if batch.num_rows:
                writer = writer or _ShardWriter(folder, encode.dtype, length)
                writer.add(batch.column("doc_id").to_pylist(), [x + end for x in encode.encode(batch.column("text").to_pylist())])
        if writer is not None:
            writer.close()
            yield record_batch(_SHARDS, {"shard": [TaskContext.get().partitionId()], "path": [writer.path], "docs": [writer.rows], "tokens": [writer.tokens]})

    return run


def default_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, as a URI."""
    return store_uri(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}")


def write_tokens(docs: DataFrame, tokenizer: str, folder: str | None = None, length: int = SEQUENCE, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the shards; their checkpointed list: shard, path, docs, tokens and before (ids in earlier shards).

    ``tokenizer`` is a file of the tokenizers library that every worker can read, ``folder`` a URI of the shared store.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = texts(docs, id_col, text_col).withColumns({"tie": F.xxhash64("text"), "nth": F.monotonically_increasing_id()})
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie").asc(), F.col("nth").asc()]
    ranged = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")
    written = checkpointed(ranged.mapInArrow(
        _write(folder or default_folder(spark), tokenizer, length, end_id), "shard int, path string, docs long, tokens long"))
    earlier = Window.partitionBy(F.lit(1)).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row for each shard
    return written.withColumn("before", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)))


class TokenShard:
    """Random access to a shard of the store; from a memory map (a local or mounted path) its arrays are views of the file."""

    def __init__(self, path: str, store=None):
        if store is None:
            self.files = [pa.memory_map(f"{path}{end}") for end in (".arrow", ".docs.arrow")]
        else:
            self.files = [store.open_input_file(f"{path}{end}") for end in (".arrow", ".docs.arrow")]
        self.sequences, self.docs = (pa.ipc.open_file(f) for f in self.files)
        self.length = self.sequences.schema.field("ids").type.list_size

    def __len__(self) -> int:
        n = self.sequences.num_record_batches
        return 0 if n == 0 else (n - 1) * BATCH_SEQUENCES + self.sequences.get_batch(n - 1).num_rows

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of sequence i."""
        if not 0 <= i < len(self):
            raise IndexError(i)
        batch, row = divmod(i, BATCH_SEQUENCES)
        ids, mask = self.sequences.get_batch(batch).columns
        return ids[row].values.to_numpy(), mask[row].values.to_numpy(zero_copy_only=False)

    def batches(self) -> Iterator[np.ndarray]:
        """The real ids of each record batch, as little-endian unsigned 32-bit integers."""
        for b in range(self.sequences.num_record_batches):
            ids, mask = self.sequences.get_batch(b).columns
            real = mask.flatten().to_numpy(zero_copy_only=False)
            yield ids.flatten().to_numpy()[real].astype("<u4")

    def close(self) -> None:
        for f in self.files:
            f.close()


_READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def _read(folder: str):
    def documents(shard: TokenShard, before: int) -> Iterator[pa.RecordBatch]:
        stream, data, first, last = shard.batches(), memoryview(b""), 0, 0  # data holds ids first to last
        for b in range(shard.docs.num_record_batches):
            rows = shard.docs.get_batch(b).to_pydict()
            sums = []
            for at, n in zip(rows["start"], rows["n_tokens"]):
                crc, end = 0, at + n
                while at < end:
                    if at >= last:
                        ids = next(stream)
                        first, last, data = last, last + len(ids), memoryview(ids.tobytes())
                    upto = min(end, last)
                    crc = zlib.crc32(data[4 * (at - first):4 * (upto - first)], crc)
                    at = upto
                sums.append(crc)
            yield record_batch(_READ, rows | {"start": [before + s for s in rows["start"]], "ids_crc32": sums})
        if next(stream, None) is not None:
            raise ValueError("a shard holds ids that belong to no document")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                shard = TokenShard(row["path"], store)
                yield from documents(shard, row["before"])
                shard.close()

    return run


def read_tokens(shards: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens and the checksum of its ids. ``folder`` names the store."""
    parts = max(1, int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = shards.repartitionById(parts, F.col("shard")).select("path", "before")
    return dealt.mapInArrow(_read(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_index(docs: DataFrame, tokenizer: str, length: int = SEQUENCE, end_id: int = END_ID, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Write all documents and read them back."""
    folder = default_folder(docs.sparkSession)
    return read_tokens(write_tokens(docs, tokenizer, folder, length, end_id, id_col, text_col), folder)
