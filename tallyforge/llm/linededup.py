"""Line deduplication by pairwise alignment with the first holder of a line.

Lines of at least ``MIN_LINE_WORDS`` words are hashed (128 bits).  A rare line
that two documents share proposes them as a pair; of all earlier documents it
names the first one that holds it.  A document is thus paired with few others,
and a common line needs no cap: its thousand holders make a thousand pairs
with one document, not half a million among themselves, and no shared line is
left out.  Each pair's shared lines are aligned by patience diff: lines that
stand once on both sides are anchors, their longest increasing sequence is
kept, and the stretches between are aligned in the same way.

Aligned lines of a document that follow one another form a block, whichever
documents they were aligned with.  Blocks of ``MIN_BLOCK_WORDS`` words or more
are deleted.  The first holder of a line always keeps it, so no content is
lost.

With ``passages=True`` (the query) what first holders cannot show is deleted
too: every passage of two or more neighbouring lines and ``MIN_BLOCK_WORDS``
words that stands in any earlier document, wherever and however often.  Such
passages are the unions of their shortest windows, from each line on and back
from each line; a window names its first holder by one hash, so no partner is
left out and no pairs are made.  Lines of one or two words count in a passage
like all others, and the blank lines between its lines belong to it, if the
earlier document has the same ones; blank lines around it stay.

Order of documents: by id (null last), then by a hash of the text.

Defined cases: null text is the empty text, of one empty line; rows with equal
id and text are one document and get equal results; a very long text is one
document, whose lines are compared by hash; of holders of a line the smallest id
is the first; other columns pass
through ``without_shared_lines`` untouched; an empty table gives an empty
result; a document may lose all its lines and then has the empty text.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..session import checkpointed
from .common import bounded_batches, columns_of, record_batch, whole_text

MIN_LINE_WORDS = 3
MIN_BLOCK_WORDS = 8


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, given by rising first parts, whose second parts rise as well (patience sort)."""
    tops: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for i, (_, b) in enumerate(pairs):
        pile = bisect_left(tops, b)
        back.append(at[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(b)
            at.append(i)
        else:
            tops[pile], at[pile] = b, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def patience(a: list[tuple[int, bytes]], b: list[tuple[int, bytes]]) -> list[tuple[int, int]]:
    """Aligned (position in a, position in b) of two line lists (position, hash) in order of position."""
    found: list[tuple[int, int]] = []
    work = [(a, b)]
    while work:
        left, right = work.pop()
        n, start, end = min(len(left), len(right)), 0, 0
        while start < n and left[start][1] == right[start][1]:
            found.append((left[start][0], right[start][0]))
            start += 1
        while end < n - start and left[-1 - end][1] == right[-1 - end][1]:
            found.append((left[-1 - end][0], right[-1 - end][0]))
            end += 1
        left, right = left[start:len(left) - end], right[start:len(right) - end]
        if not left or not right:
            continue
        in_left, in_right = Counter(h for _, h in left), Counter(h for _, h in right)
        place = {h: i for i, (_, h) in enumerate(right) if in_right[h] == 1}
        anchors = _increasing([(i, place[h]) for i, (_, h) in enumerate(left) if in_left[h] == 1 and h in place])
        if not anchors:  # only repeated lines are left: align them in order
            where: dict[bytes, list[int]] = {}
            for j, (_, h) in enumerate(right):
                where.setdefault(h, []).append(j)
            i = 0
            for p, h in left:
                at = where.get(h, [])
                k = bisect_left(at, i)
                if k < len(at):
                    found.append((p, right[at[k]][0]))
                    i = at[k] + 1
            continue
        i = j = 0
        for x, y in [*anchors, (len(left), len(right))]:
            work.append((left[i:x], right[j:y]))
            if x < len(left):
                found.append((left[x][0], right[y][0]))
            i, j = x + 1, y + 1
    return sorted(found)


def _align(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in frames:
        out = []
        for shared in rows["shared"]:
            later = sorted((r["pos"], bytes(r["line"]), r["words"]) for r in shared)
            first = sorted({(int(p), bytes(r["line"])) for r in shared for p in r["held_at"]})
            words = {p: w for p, _, w in later}
            pairs = patience([(p, h) for p, h, _ in later], first)
            out.append([{"pos": p, "words": words[p]} for p, _ in pairs])
        rows["aligned"] = out
        yield rows[["doc_id", "key", "aligned"]]


def _blocks(min_words: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in frames:
            cut = []
            for aligned, held in zip(rows["aligned"], rows["held"]):
                words = {r["pos"]: r["words"] for r in aligned}
                gone: list[int] = []
                block: list[int] = []
                for p in sorted(words):
                    if block and p != block[-1] + 1:
                        gone += block if sum(words[q] for q in block) >= min_words else []
                        block = []
                    block.append(p)
                gone += block if block and sum(words[q] for q in block) >= min_words else []
                cut.append(sorted({*gone, *(p for r in held for p in range(r["start"], r["end"]))}) if len(held) else gone)
            rows["gone"] = cut
            yield rows.loc[[bool(c) for c in cut], ["doc_id", "key", "gone"]]

    return run


def windows(words: list[int], least: int) -> set[tuple[int, int]]:
    """First and last line of the shortest windows of two or more lines and ``least`` words, from and up to each line.

    words: of each line.  Lines without words neither begin nor end a window, but one may reach across them.
    """
    at = [i for i, n in enumerate(words) if n]
    upto = [0]
    for i in at:
        upto.append(upto[-1] + words[i])
    out: set[tuple[int, int]] = set()
    end = back = 0
    for k in range(len(at) - 1):
        end = max(end, k + 1)
        while end < len(at) and upto[end + 1] - upto[k] < least:
            end += 1
        if end < len(at):
            out.add((at[k], at[end]))
        while back < k and upto[k + 2] - upto[back + 1] >= least:
            back += 1
        if upto[k + 2] - upto[back] >= least:
            out.add((at[back], at[k + 1]))
    return out


_WINDOW = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("window", pa.binary())])


def _cut_windows(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in columns_of(batches):
            out: dict[str, list] = {f.name: [] for f in _WINDOW}
            for doc_id, key, text in zip(rows["doc_id"], rows["key"], rows["text"]):
                lines = text.split(b"\n")
                found = windows([len(x.split()) for x in lines], min_words) if len(lines) > 1 else ()
                digests = [hashlib.md5(x).digest() for x in lines] if found else []
                for a, b in found:
                    out["doc_id"].append(doc_id)
                    out["key"].append(key)
                    out["start"].append(a)
                    out["end"].append(b + 1)
                    out["window"].append(hashlib.md5(b"".join(digests[a:b + 1])).digest())
            yield record_batch(_WINDOW, out)

    return run


def _held_passages(docs: DataFrame, id_col: str, text_col: str, min_block_words: int) -> DataFrame:
    """doc_id, key and held (array of start, end): windows of lines that an earlier document holds."""
    bounded_batches(docs.sparkSession)
    text = whole_text(text_col)
    # Cut twice rather than stored: texts hold about as many windows as lines.
    cut = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), text.cast("binary").alias("text")).mapInArrow(
        _cut_windows(min_block_words), "doc_id long, key long, start long, end long, window binary")
    owner = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")
    firsts = checkpointed(cut.groupBy("window").agg(F.min(owner).alias("first"), F.max(owner).alias("last")).where("first != last").select("window", "first"))
    return cut.join(firsts, "window").where(owner != F.col("first")).groupBy("doc_id", "key").agg(
        F.collect_set(F.struct("start", "end")).alias("held"))


def shared_line_positions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_line_words: int = MIN_LINE_WORDS,
                          min_block_words: int = MIN_BLOCK_WORDS, passages: bool = False) -> DataFrame:
    """Of documents that lose lines: doc_id, key (hash of the text), gone (array of line numbers from 0)."""
    text = whole_text(text_col)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(text).alias("key"),
                       F.posexplode(F.split(text, "\n")).alias("pos", "content"))
    words = F.regexp_count("content", F.lit("[^\\x20\\x09-\\x0D]+"))
    lines = rows.select("doc_id", "key", F.col("pos").cast("long").alias("pos"), words.cast("long").alias("words"),
                        F.unhex(F.md5("content")).alias("line")).where(F.col("words") >= min_line_words)
    lines = checkpointed(lines.dropDuplicates(["doc_id", "key", "pos"]))
    owner = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")
    # One entry per line and map task reaches the shuffle, however common the line is.
    firsts = lines.groupBy("line").agg(F.min(owner).alias("first"), F.max(owner).alias("last")).where("first != last").select("line", "first")
    firsts = checkpointed(firsts)  # so that the joins on lines have two plain exchanges and a hot line can be split
    shared = checkpointed(lines.join(firsts, "line").withColumn("own", owner == F.col("first")))
    held = checkpointed(shared.where("own").groupBy("line").agg(F.collect_list("pos").alias("held_at")))
    pairs = shared.where("NOT own").join(held, "line").groupBy("doc_id", "key", "first").agg(
        F.collect_list(F.struct("pos", "words", "line", "held_at")).alias("shared"))
    aligned = pairs.select("doc_id", "key", "shared").mapInPandas(
        _align, "doc_id long, key long, aligned array<struct<pos:long,words:long>>")
    aligned = aligned.withColumn("held", F.expr("cast(array() as array<struct<start:long,end:long>>)"))
    if passages:
        held = _held_passages(docs, id_col, text_col, min_block_words)
        aligned = aligned.unionByName(held.withColumn("aligned", F.expr("cast(array() as array<struct<pos:long,words:long>>)")))
    merged = aligned.groupBy("doc_id", "key").agg(
        F.flatten(F.collect_list("aligned")).alias("aligned"), F.flatten(F.collect_list("held")).alias("held"))
    return merged.mapInPandas(_blocks(min_block_words), "doc_id long, key long, gone array<long>")


def _with_positions(docs: DataFrame, id_col: str, text_col: str, min_line_words: int, min_block_words: int,
                    passages: bool) -> tuple[DataFrame, dict[str, str]]:
    gone = checkpointed(shared_line_positions(docs, id_col, text_col, min_line_words, min_block_words, passages))
    gone = gone.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), F.col("gone").alias("_gone"))
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    plain = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    own = F.xxhash64(whole_text(names[text_col]))
    return plain.join(gone, (own == F.col("_key")) & F.col(names[id_col]).cast("long").eqNullSafe(F.col("_id")), "left"), names


@F.pandas_udf(StringType())
def _cut(text: pd.Series, gone: pd.Series) -> pd.Series:
    out = []
    for t, g in zip(text, gone):
        away = set(g)
        out.append("\n".join(x for i, x in enumerate(t.split("\n")) if i not in away))
    return pd.Series(out, dtype=object)


def _kept_text(text_col: str) -> Column:
    """The text without its lines at _gone; a Python call sees only texts that lose lines."""
    loses = F.col("_gone").isNotNull()
    cut = _cut(F.when(loses, whole_text(text_col)).otherwise(F.lit("")), F.coalesce("_gone", F.expr("cast(array() as array<long>)")))
    return F.when(loses, cut).otherwise(whole_text(text_col))


def without_shared_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_line_words: int = MIN_LINE_WORDS,
                         min_block_words: int = MIN_BLOCK_WORDS, passages: bool = False) -> DataFrame:
    """The documents with their deleted blocks gone from the text; all other columns as they are."""
    rows, names = _with_positions(docs, id_col, text_col, min_line_words, min_block_words, passages)
    return rows.select(*[(_kept_text(n) if c == text_col else F.col(n)).alias(c) for c, n in names.items()])


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_line_words: int = MIN_LINE_WORDS,
                min_block_words: int = MIN_BLOCK_WORDS, passages: bool = False) -> DataFrame:
    """One row per document: doc_id, n_lines, n_deleted, deleted (line numbers, comma-joined), kept_sha256."""
    rows, names = _with_positions(docs, id_col, text_col, min_line_words, min_block_words, passages)
    text = names[text_col]
    return rows.select(
        F.col(names[id_col]).cast("long").alias("doc_id"), F.size(F.split(whole_text(text), "\n")).cast("long").alias("n_lines"),
        F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone")).cast("long").alias("n_deleted"),
        F.coalesce(F.array_join(F.col("_gone").cast("array<string>"), ","), F.lit("")).alias("deleted"),
        F.sha2(_kept_text(text), 256).alias("kept_sha256"))
