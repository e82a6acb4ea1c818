"""Source divergence audit by a frequent-pattern tree of term rows.

Which sources of a language use its words differently, and which words set a
source apart?  Every (lang, source) group gives each kept term the share
``p = 1 + floor(10^9 (count + 1) / (N + V))``; the divergence of a group from
another one is the sum of ``floor((p - q)^2 / q)`` over the kept terms.

A term is a row of the sources that use it, in order, with their counts.  Most
sources lack most terms, so a sum over all terms starts from the value of two
absent terms, times V, and is corrected where counts are not zero: once for
each source of a row (the other one absent) and once for each pair of sources
of a row.  Rows are inserted into a prefix tree with their multiplicity; a node
is a source with a share, and rows with the same beginning share their path.  A
pair correction is computed once for each node and ancestor and counts as often
as rows pass through the node.

Equal rows are counted first, then rows are dealt by ranges of their path, so
neighbours share paths and a hot first source is split.  A tree covers a chunk
of sorted rows and is laid out in arrays, one level at a time; a node cut by
the end of a chunk only splits its multiplicity, which changes no sum.  Words
are counted in each map task (flushed at a bound), so a hot word crosses the
network as one row per task and source.

All arithmetic is exact: shares are divided as decimals, and the rest fits 64
bits, since the shares of a group add up to about 10^9 (for less than 10^9 kept
terms per language).

Defined cases: null text, lang and source are ''; very long texts are cut into
words whole; repeated rows count as documents; a group without terms has count 0
everywhere; a language without kept terms has pair values 0; equal values rank
by the bytes of the item; other columns are not read; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed, maybe_broadcast
from .common import bounded_batches, whole_text

SCALE = 1_000_000_000
#: Counters that a map task holds before it passes them on.
COUNTERS = 400_000
#: Rows of a tree, entries of its rows and corrections held at once.
TREE_ROWS, TREE_ENTRIES, HELD = 8192, 400_000, 1_000_000

#: A-Z lower-cased, every byte that is no letter made a space; bytes from 128 on belong to letters.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(_LETTERS).split()


def _count_terms(limit: int):
    def rows(counts: dict, docs: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), own in counts.items():
            held = docs[lang, source]
            yield pa.RecordBatch.from_arrays([
                pa.repeat(lang, len(own)).cast(pa.string()), pa.repeat(source, len(own)).cast(pa.string()),
                pa.array(list(own), pa.binary()).cast(pa.string()), pa.array(list(own.values()), pa.int64()),
                pa.array([held[t] for t in own], pa.int64())], schema=_COUNTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, Counter] = {}
        docs: dict[tuple, Counter] = {}
        size = 0
        for batch in batches:
            for lang, source, text in zip(*[c.to_pylist() for c in batch.columns]):
                words = terms_of(text)
                if not words:
                    continue
                own = counts.setdefault((lang, source), Counter())
                size -= len(own)
                own.update(words)
                size += len(own)
                docs.setdefault((lang, source), Counter()).update(set(words))
                if size > limit:
                    yield from rows(counts, docs)
                    counts, docs, size = {}, {}, 0
        yield from rows(counts, docs)

    return run


def kept_counts(docs: DataFrame, min_docs: int = 3, lang_col: str = "lang", source_col: str = "source",
                text_col: str = "text") -> DataFrame:
    """lang, source, term, n and the language's total, for terms in at least ``min_docs`` documents of the language."""
    bounded_batches(docs.sparkSession)
    plain = docs.select(whole_text(lang_col).alias("lang"), whole_text(source_col).alias("source"), whole_text(text_col).alias("text"))
    partial = plain.mapInArrow(_count_terms(COUNTERS), "lang string, source string, term string, n long, docs long")
    # Dealt by language and term, which serves the sums by source and the window by term alike.
    counted = partial.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    whole = Window.partitionBy("lang", "term")  # a row for each source
    return counted.withColumns({"total": F.sum("n").over(whole), "docs": F.sum("docs").over(whole)}).where(
        F.col("docs") >= min_docs).drop("docs")


def _share(count: Column, mass: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / mass), exactly; mass is N + V."""
    scaled = F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    return F.call_function("div", scaled, F.greatest(mass, F.lit(1)).cast("decimal(20,0)")) + 1


def _apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def source_groups(docs: DataFrame, kept: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Each (lang, source) with its place among the language's sources, N + V of the group (``mass``) and of the
    language (``lang_mass``), the share of an absent term (``absent``) and V (``terms``)."""
    known = docs.select(whole_text(lang_col).alias("lang"), whole_text(source_col).alias("source")).distinct()
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    # Every kept term has a first row, so V is a sum on the map side and not a count of distinct terms.
    words = kept.groupBy("lang", "term").agg(F.first("total").alias("total")).groupBy("lang").agg(
        F.count("*").alias("terms"), F.sum("total").alias("lang_n"))
    none = F.lit(0).cast("long")
    groups = known.join(sizes, ["lang", "source"], "left").join(words, "lang", "left").select(
        "lang", "source", F.coalesce("n", none).alias("n"), F.coalesce("terms", none).alias("terms"),
        F.coalesce("lang_n", none).alias("lang_n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source"))  # a catalogue: a row for each source
    return groups.select("lang", "source", place.cast("long").alias("place"), "terms", (F.col("n") + F.col("terms")).alias("mass"),
                         (F.col("lang_n") + F.col("terms")).alias("lang_mass"),
                         _share(none, F.col("n") + F.col("terms")).alias("absent"))


def _sums(code: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of equal codes."""
    if not len(code):
        return code, value
    order = np.argsort(code, kind="stable")
    code = code[order]
    at = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    return code[at], np.add.reduceat(value[order], at)


def _parts(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


class _Tree:
    """A prefix tree over sorted rows: entry (row, level) of the arrays is the row's node on that level."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        path = table["path"].combine_chunks()
        size = path.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        entries = path.flatten()
        self.within = np.arange(size.max())[None, :] < size[:, None]
        self.place, self.share, self.absent = (self._laid(entries.field(n)) for n in ("place", "share", "absent"))
        coded = table["lang"].combine_chunks().dictionary_encode()
        self.langs, self.lang = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.passed = np.r_[0, np.cumsum(table["m"].to_numpy())]
        same = self.within[1:] & self.within[:-1] & (self.place[1:] == self.place[:-1]) & (self.share[1:] == self.share[:-1])
        same[:, 0] &= self.lang[1:] == self.lang[:-1]
        self.shared = np.zeros_like(self.within)  # does the row go through the same node as the row before?
        self.shared[1:] = np.logical_and.accumulate(same, axis=1)

    def _laid(self, values: pa.Array) -> np.ndarray:
        out = np.zeros(self.within.shape, np.int64)
        out[self.within] = values.to_numpy(zero_copy_only=False)
        return out

    def nodes(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Level, first rows of its nodes and the rows that pass through them."""
        for level in range(self.within.shape[1]):
            starts = np.flatnonzero(~self.shared[:, level])
            many = self.passed[np.r_[starts[1:], len(self.within)]] - self.passed[starts]
            real = self.within[starts, level]
            yield level, starts[real], many[real]


_CORRECTIONS = pa.schema([("lang", pa.string()), ("place", pa.int64()), ("other", pa.int64()), ("share", pa.int64()), ("value", pa.int64())])


def _corrections(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Of one tree: pair corrections by (place, other), and rows by (place, share) with other null."""
    tree = _Tree(table)
    wide = int(tree.place.max()) + 1
    single: list[tuple[np.ndarray, ...]] = []
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def pairs() -> pa.RecordBatch:
        code, value = _sums(*(np.concatenate(x) for x in zip(*held)))
        return pa.RecordBatch.from_arrays([
            tree.langs.take(pa.array(code // wide // wide)), pa.array(code // wide % wide), pa.array(code % wide),
            pa.nulls(len(code), pa.int64()), pa.array(value)], schema=_CORRECTIONS)

    for level, row, many in tree.nodes():
        lang, a, p, p0 = tree.lang[row], tree.place[row, level], tree.share[row, level], tree.absent[row, level]
        single.append((lang * wide + a, p, many))
        for above in range(level):
            b, q, q0 = tree.place[row, above], tree.share[row, above], tree.absent[row, above]
            held.append(((lang * wide + a) * wide + b, many * (_parts(p, q) - _parts(p, q0) - _parts(p0, q) + _parts(p0, q0))))
            held.append(((lang * wide + b) * wide + a, many * (_parts(q, p) - _parts(q, p0) - _parts(q0, p) + _parts(q0, p0))))
            size += 2 * len(row)
            if size > HELD:
                yield pairs()
                held, size = [], 0
    if held:
        yield pairs()
    code, p, many = (np.concatenate(x) for x in zip(*single))
    # Sorted by both, equal (source, share) stand together.
    order = np.lexsort((p, code))
    code, p = code[order], p[order]
    at = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (p[1:] != p[:-1])])
    many = np.add.reduceat(many[order], at)
    yield pa.RecordBatch.from_arrays([
        tree.langs.take(pa.array(code[at] // wide)), pa.array(code[at] % wide), pa.nulls(len(at), pa.int64()),
        pa.array(p[at]), pa.array(many)], schema=_CORRECTIONS)


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, rows, entries = [], 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        entries += len(batch["path"].flatten())
        if rows >= TREE_ROWS or entries >= TREE_ENTRIES:
            yield from _corrections(pa.Table.from_batches(held))
            held, rows, entries = [], 0, 0
    if held:
        yield from _corrections(pa.Table.from_batches(held))


def pair_values(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value: the divergence of each source from each other one of its language."""
    node = F.struct("place", "share", "absent")
    rows = entries.groupBy("lang", "term").agg(F.array_sort(F.collect_list(node)).alias("path")).groupBy("lang", "path").agg(
        F.count("*").alias("m"))
    parts = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = rows.repartitionByRange(parts, "lang", "path").sortWithinPartitions("lang", "path")
    found = laid.mapInArrow(_trees, "lang string, place long, other long, share long, value long")
    # One row for each pair, and one for each source and share: what the map tasks found is small and used twice.
    found = checkpointed(found.groupBy("lang", "place", "other", "share").agg(F.sum("value").alias("value")))
    narrow = groups.select("lang", "place", "absent", "terms")
    other = maybe_broadcast(narrow.select("lang", F.col("place").alias("other"), F.col("absent").alias("other_absent")))
    p0, q0 = F.col("absent"), F.col("other_absent")
    apart = F.col("place") != F.col("other")
    base = narrow.join(other, "lang").where(apart).select("lang", "place", "other", (F.col("terms") * _apart(p0, q0)).alias("value"))
    single = found.where("other IS NULL").select("lang", "place", "share", F.col("value").alias("m")).join(
        maybe_broadcast(narrow.drop("terms")), ["lang", "place"]).join(other, "lang").where(apart)
    p, m = F.col("share"), F.col("m")
    mine = single.select("lang", "place", "other", (m * (_apart(p, q0) - _apart(p0, q0))).alias("value"))
    theirs = single.select("lang", F.col("other").alias("place"), F.col("place").alias("other"), (m * (_apart(q0, p) - _apart(q0, p0))).alias("value"))
    total = base.unionByName(mine).unionByName(theirs).unionByName(
        found.where("other IS NOT NULL").select("lang", "place", "other", "value")).groupBy("lang", "place", "other").agg(F.sum("value").alias("value"))
    names = groups.select("lang", "place", "source")
    return total.join(maybe_broadcast(names), ["lang", "place"]).join(
        maybe_broadcast(names.select("lang", F.col("place").alias("other"), F.col("source").alias("item"))), ["lang", "other"]).select(
        "lang", "source", "item", "value")


def divergence(docs: DataFrame, min_docs: int = 3, top_terms: int = 200, lang_col: str = "lang", source_col: str = "source",
               text_col: str = "text") -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank.

    Part ``pair`` has every other source of the language; part ``term`` the ``top_terms`` terms whose share in the
    group lies furthest above their share in the language.
    """
    kept = checkpointed(kept_counts(docs, min_docs, lang_col, source_col, text_col))
    groups = checkpointed(source_groups(docs, kept, lang_col, source_col))
    entries = kept.join(maybe_broadcast(groups), ["lang", "source"]).withColumn("share", _share(F.col("n"), F.col("mass")))
    common = _share(F.col("total"), F.col("lang_mass"))
    terms = entries.withColumn("q", common).where("share > q").select(
        "lang", "source", F.col("term").alias("item"), _apart(F.col("share"), F.col("q")).alias("value"))
    order = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = pair_values(entries, groups).select("lang", "source", F.lit("pair").alias("part"), "item", "value", order.alias("rank"))
    terms = terms.select("lang", "source", F.lit("term").alias("part"), "item", "value", order.alias("rank")).where(F.col("rank") <= top_terms)
    return pairs.unionByName(terms)
