"""Target-distribution importance resampling over hashed word n-grams.

A document's features are all runs of one to three consecutive words, hashed
to 10,000 buckets.  A bucket's gain says how much likelier it is in the target
texts than in all documents; a document's weight is the sum of the gains of
its features.  Adding Gumbel noise that depends on the id alone and drawing
the highest scores draws without replacement in proportion to the weights'
exponentials.

Weights are scored in arrays: the checksum of a run of words follows from the
checksums of its words (CRC-32 is linear: the one in front is carried over the
length of the one behind by table look-ups), so a batch of texts is hashed at
once, word by word only for single words.  A first pass counts the buckets in
each map task; 10,000 sums come back, whatever the size of the corpus.

The draw is a parallel sort by regular sampling.  Every partition sorts its
rows into a run and offers rows at regular places of the run; the offered rows,
each standing for as many rows as lie between them, give splitters.  Runs are
cut at the splitters, segments with the same number meet in one partition,
which merges them as they are sorted, and the sizes of the partitions before
turn a place into an exact rank.  Rows with equal score and id are told apart
by run and place, so repeated rows are split like any others.  The scored
rows, which are narrow, are checkpointed first, so a retried task sees the
same runs.

Defined cases: null text has no words, weight 0 and no rank; a null id is
hashed as an empty one and sorts first among equal scores; very long texts are
hashed whole, in slices; repeated rows get a rank each; other columns are not
read; without target texts only the smoothing is left; an empty table gives an
empty result.
"""

from __future__ import annotations

import bisect
import heapq
import itertools
import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed, maybe_broadcast
from .common import bounded_batches, record_batch, texts

BUCKETS = 10_000
#: Words of a run.
RUN_WORDS = 3
MIN_WORDS = 20
PERCENT = 5
SEED = 42
#: Rows that the runs offer for each range, together.
OFFERS = 32
#: Words hashed at once, and the size of the pieces a long text is cut into.
SLICE_WORDS, PIECE_BYTES = 200_000, 1 << 20
#: Lengths below this one have look-up tables of their own.
TABLE_BYTES = 64

#: A-Z lower-cased, every byte outside words made a space.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_WORDS).split()


Tables = np.ndarray  # [byte of the checksum, value of that byte]; the four bytes' entries are combined by xor


def _apply(tables: Tables, crc: np.ndarray) -> np.ndarray:
    return tables[0, crc & 0xFF] ^ tables[1, crc >> 8 & 0xFF] ^ tables[2, crc >> 16 & 0xFF] ^ tables[3, crc >> 24]


@lru_cache(maxsize=1)
def _carry_tables() -> tuple[np.ndarray, list[Tables]]:
    """What a checksum becomes when zero bytes follow: tables for 0 to TABLE_BYTES - 1 bytes, and for
    TABLE_BYTES times 1, 2, 4, ... bytes (up to 2 GB, more than a text can hold)."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1)
    few = np.zeros((TABLE_BYTES + 1, 4, 256), np.uint32)
    for k in range(4):
        few[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(1, TABLE_BYTES + 1):
        few[n] = step[few[n - 1] & 0xFF] ^ (few[n - 1] >> np.uint32(8))
    many = [few[TABLE_BYTES]]
    while TABLE_BYTES << len(many) < 1 << 31:
        many.append(_apply(many[-1], many[-1]))
    return few, many


def _carried(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Checksums carried over ``length`` bytes each."""
    few, many = _carry_tables()
    n = length % TABLE_BYTES
    out = few[n, 0, crc & 0xFF] ^ few[n, 1, crc >> 8 & 0xFF] ^ few[n, 2, crc >> 16 & 0xFF] ^ few[n, 3, crc >> 24]
    if length.max(initial=0) >= TABLE_BYTES:
        for j, tables in enumerate(many):
            at = np.flatnonzero(length // TABLE_BYTES >> j & 1)
            out[at] = _apply(tables, out[at])
    return out


def run_buckets(words: list[bytes], owner: np.ndarray, known: int = 0, buckets: int = BUCKETS,
                width: int = RUN_WORDS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of 1, 2, ... words that stay in one text: the text's number and the bucket.

    ``owner`` holds each word's text; runs that end among the first ``known`` words are left out.
    crc(a + b) = carried(crc(a), len(b)) ^ crc(b).
    """
    n = len(words)
    crc = np.fromiter(map(zlib.crc32, words), np.uint32, n)
    size = np.fromiter(map(len, words), np.int64, n)
    yield owner[known:], crc[known:] % np.uint32(buckets)
    spaced = _carried(crc, np.ones(n, np.int64)) ^ np.uint32(zlib.crc32(b" "))  # of each word with a space behind
    run, run_size = crc, size
    for k in range(1, min(width, n)):
        # A run of k + 1 words is a word, a space and the run of k words behind.
        run, run_size = _carried(spaced[:n - k], run_size[1:]) ^ run[1:], size[:n - k] + 1 + run_size[1:]
        wanted = owner[:n - k] == owner[k:]
        wanted[:max(known - k, 0)] = False
        yield owner[:n - k][wanted], run[wanted] % np.uint32(buckets)


def _pieces(data: bytes) -> Iterator[bytes]:
    """The words' bytes, cut at spaces into pieces of about PIECE_BYTES."""
    start = 0
    while len(data) - start > PIECE_BYTES:
        cut = data.find(b" ", start + PIECE_BYTES)
        if cut < 0:
            break
        yield data[start:cut]
        start = cut
    yield data[start:]


def _slices(texts_: list[str], width: int = RUN_WORDS) -> Iterator[tuple[list[bytes], np.ndarray, int]]:
    """Words, the number of the text of each, and how many of them the slice before has shown already."""
    words: list[bytes] = []
    owner: list[np.ndarray] = []
    known = 0
    for i, text in enumerate(texts_):
        for nth, piece in enumerate(_pieces(text.encode().translate(_WORDS))):
            if len(words) > SLICE_WORDS:
                yield words, np.concatenate(owner), known
                # A text that goes on shows its last words again, for the runs across the cut.
                rest = words[-(width - 1):] if nth else []
                own = np.concatenate(owner)[len(words) - len(rest):]
                words, owner, known = rest, [own], len(rest)
            found = piece.split()
            words += found
            owner.append(np.full(len(found), i))
    if len(words) > known:
        yield words, np.concatenate(owner), known


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for words, owner, known in _slices(batch.column("text").to_pylist()):
            for _, bucket in run_buckets(words, owner, known):
                total += np.bincount(bucket, minlength=BUCKETS)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])


def bucket_counts(docs: DataFrame, text_col: str = "text") -> list[int]:
    """Features in each bucket, over all texts; at most BUCKETS sums leave a task."""
    bounded_batches(docs.sparkSession)
    plain = docs.select(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    sums = plain.mapInArrow(_count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = [0] * BUCKETS
    for row in sums.collect():  # BUCKETS rows at most
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(source: list[int], target: list[int]) -> list[int]:
    all_source, all_target = float(sum(source) + BUCKETS), float(sum(target) + BUCKETS)
    return [math.floor(1000 * math.log((t + 1.0) * all_source / ((s + 1.0) * all_target))) for s, t in zip(source, target)]


_WEIGHED = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64())])


def _weigh(gains: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = np.array(gains, np.int64)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            words_, features, weight = (np.zeros(n, np.int64) for _ in range(3))
            for words, owner, known in _slices(batch.column("text").to_pylist()):
                words_ += np.bincount(owner[known:], minlength=n)
                for of, bucket in run_buckets(words, owner, known):
                    features += np.bincount(of, minlength=n)
                    # Sums of integers, exact in doubles below 2 ** 53.
                    weight += np.bincount(of, weights=gain[bucket], minlength=n).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, (words_, features, weight))], schema=_WEIGHED)

    return run


def scored(docs: DataFrame, gains: list[int], seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_features, weight and score, the weight with Gumbel noise made of seed and id."""
    bounded_batches(docs.sparkSession)
    weighed = texts(docs, id_col, text_col).mapInArrow(_weigh(gains), "doc_id long, n_words long, n_features long, weight long")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))
    return weighed.withColumn("score", F.col("weight") + noise)


def _cut(splitters: list[tuple]):
    """Number the segments of sorted runs; a row equal to a splitter stays in front of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch.to_pydict()
            keys = list(zip(rows["down"], rows["tie"], rows["place"]))
            low, high = (bisect.bisect_left(splitters, keys[i]) for i in (0, -1))
            at = [0, *(bisect.bisect_right(keys, s) for s in splitters[low:high]), len(keys)]
            segment = np.repeat(np.arange(low, high + 1), np.diff(at))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(segment.astype(np.int32))], names=[*batch.schema.names, "segment"])

    return run


_MERGED = pa.schema([("segment", pa.int32()), ("nth", pa.int64()), ("doc_id", pa.int64()), ("n_features", pa.int64()),
                     ("weight", pa.int64()), ("score", pa.int64())])
_RUN_ROW = ["down", "tie", "place", "segment", "doc_id", "n_features", "weight", "score"]


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Multiway merge of the sorted segments of a range; ``nth`` is the place in it."""
    runs: dict[int, list[tuple]] = {}
    for batch in batches:
        rows = batch.to_pydict()
        for run, row in zip(rows["run"], zip(*[rows[n] for n in _RUN_ROW])):
            runs.setdefault(run, []).append(row)
    for run in runs.values():
        run.sort(key=lambda row: row[2])  # a segment arrives as it was sorted unless blocks of it were fetched out of order
    merged = heapq.merge(*runs.values())
    nth = 0
    while part := list(itertools.islice(merged, 8192)):
        columns = dict(zip(_RUN_ROW, map(list, zip(*part))))
        yield record_batch(_MERGED, columns | {"nth": list(range(nth, nth + len(part)))})
        nth += len(part)


def drawn(rows: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, n_features, weight, score and the rank of the drawn ones, for the rows of ``scored``."""
    spark = rows.sparkSession
    large = F.col("n_words") >= min_words
    order = [F.desc("score"), F.col("doc_id").asc_nulls_first()]
    # The local runs: rows to rank come first in a partition; ``place`` names partition and position.
    laid = checkpointed(rows.withColumn("large", large).sortWithinPartitions(F.desc("large"), *order).withColumns(
        {"place": F.monotonically_increasing_id(), "run": F.spark_partition_id()}))
    runs = laid.where("large").select((-F.col("score")).alias("down"), F.coalesce("doc_id", F.lit(-(1 << 63))).alias("tie"),
                                      "place", "run", "doc_id", "n_features", "weight", "score")
    n = runs.count()
    ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # Every step-th row of a run, beginning at another row in each run, so that runs shorter than a step count as well.
    step = max(1, n // (OFFERS * ranges))
    at = F.col("place").bitwiseAND((1 << 33) - 1) + F.col("run").cast("long") * 2654435761
    offers = sorted(tuple(r) for r in runs.where(F.pmod(at, F.lit(step)) == 0).select("down", "tie", "place").collect())
    splitters = [offers[len(offers) * i // ranges] for i in range(1, ranges)] if offers else []
    cut = runs.mapInArrow(_cut(splitters), ", ".join(f"{c} {t}" for c, t in runs.dtypes) + ", segment int")
    merged = checkpointed(cut.repartitionById(ranges, F.col("segment")).mapInArrow(
        _merge, "segment int, nth long, doc_id long, n_features long, weight long, score long"))
    before = Window.partitionBy(F.lit(1)).orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    sizes = merged.groupBy("segment").agg(F.count("*").alias("rows")).select(
        "segment", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    rank = F.col("before") + F.col("nth") + 1
    ranked = merged.join(maybe_broadcast(sizes), "segment").select(
        "doc_id", "n_features", "weight", "score", F.when(rank <= n * percent // 100, rank).alias("rank"))
    return ranked.unionByName(laid.where(~F.col("large")).select(
        "doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank")))


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED,
              id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text") -> DataFrame:
    """Every document with its weight and score; of those with ``min_words`` words, ``percent`` of 100 have a rank."""
    gains = bucket_gains(bucket_counts(docs, text_col), bucket_counts(target, target_text_col))
    return drawn(scored(docs, gains, seed, id_col, text_col), percent, min_words)
