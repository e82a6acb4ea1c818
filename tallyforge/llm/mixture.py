"""Mixing sources to target weights under a time-varying curriculum.

Training time runs from 0 to 1.  Each source has a weight schedule, linear in
time: ``weight * (1 + tilt * (1 - 2t))``; a positive tilt puts a source early,
a negative one late.  Its integral over [0, 1] is ``weight``, so the mean mix
has the wanted weights, and the words a source has supplied until time t are
``target * (t + tilt * t * (1 - t))``.  Inverting this cumulative demand gives
every word of a source's stream its time: a document's training position is
the time at which the middle of its words is asked for.  Documents are sorted
by position over ranges.

A source's stream is its documents in a fixed pseudo-random order, passed
again until the target is reached; the last document taken in the last pass is
cut at the target, so the words taken equal the rounded target.

Targets share the words of all sources by weight.  A target stops at
``max_repeat`` times its source's size, and the excess goes to the others by
weight until none is above.  The level is found in closed form: sources in
order of cap / weight, running sums, first source that stays below its cap.

Everything is DataFrame work.  Per row only one shuffle by (source, bucket)
happens; buckets cut a large source by ranges of the order hash, so no source
meets in one task.  Running sums go over bucket totals, and buckets grow in
number with spark.sql.shuffle.partitions.  Sources are a catalogue: one row
for each goes through one task, never their documents.

Defined cases: null text has size 0; a document without words is taken 0
times; null is a source of its own, last in order; repeated rows are separate
documents of equal order whose tie is broken by text; a source without words
has target 0; a very long text is counted whole and cut only in the count of the
last pass; equal hashes are ordered by id, size and text; other columns pass through ``mixed_documents`` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed
from .common import whole_text

#: A word of the size rule.
WORD = "[^\\x20\\x09-\\x0D]+"
#: Weights and curriculum tilts of the sources in order, repeating.
WEIGHTS = (1.0, 2.0, 3.0)
TILTS = (0.5, 0.0, -0.5)


def _pick(values: tuple[float, ...], position: Column) -> Column:
    table = F.array(*[F.lit(float(v)) for v in values])
    return F.element_at(table, (F.pmod(position, F.lit(len(values))) + 1).cast("int"))


def size_of(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def source_targets(totals: DataFrame, weights: tuple[float, ...] = WEIGHTS, tilts: tuple[float, ...] = TILTS,
                   max_repeat: float = 3.0) -> DataFrame:
    """From source and source_size: also weight, tilt and target.

    With caps c and weights w, the level L solves sum(min(c, L * w)) = total.
    """
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("source").asc_nulls_last())  # binary order of UTF-8 is code point order
    rows = totals.withColumn("_nth", F.row_number().over(order) - 1)
    rows = rows.withColumns({
        "weight": _pick(weights, F.col("_nth")), "tilt": _pick(tilts, F.col("_nth")),
        "_cap": F.col("source_size") * F.lit(float(max_repeat)), "_total": F.sum("source_size").over(everything)})
    by_ratio = Window.orderBy(F.col("_cap") / F.col("weight"), "_nth").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({
        "_ratio": F.col("_cap") / F.col("weight"),
        "_capped": F.coalesce(F.sum("_cap").over(by_ratio), F.lit(0.0)),
        "_open": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_ratio), F.lit(0.0))})
    # The level if all sources before this one are at their caps and this one is not.
    rows = rows.withColumn("_level", (F.col("_total") - F.col("_capped")) / F.col("_open"))
    rows = rows.withColumn("_at", F.min(F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "_nth", "_level"))).over(everything))
    level = F.col("_at._level")
    return rows.select("source", "source_size", "weight", "tilt",
                       F.when(level.isNull(), F.col("_cap")).otherwise(F.least("_cap", level * F.col("weight"))).alias("target"))


def time_of(share: Column, tilt: Column) -> Column:
    """The time t with t + tilt * t * (1 - t) = share: the schedule's integral inverted."""
    b = tilt + 1
    root = F.sqrt(F.greatest(b * b - tilt * share * 4, F.lit(0.0)))
    return F.when(F.abs(tilt) < 1e-9, share).otherwise((b - root) / (tilt * 2))


def _assigned(docs: DataFrame, size: Column, source: Column, order_by: list[Column], weights, tilts, max_repeat) -> DataFrame:
    """``docs`` with _size, _source_size, _target, _taken, _before, _tilt and _position."""
    buckets = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # 60 bits of a hash of the id; buckets are equal ranges of it.
    order = F.conv(F.substring(F.md5(F.coalesce(order_by[0].cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")
    bucket = F.floor(order * F.lit(buckets / (1 << 60))).cast("int")
    key = F.coalesce(F.concat(F.lit("="), source), F.lit(""))  # never null, so join and window share one shuffle
    rows = docs.withColumns({"_size": size, "_source": key, "_bucket": bucket, "_order": order})
    # Few rows: sources times buckets.
    parts = checkpointed(rows.groupBy("_source", "_bucket").agg(F.sum("_size").alias("_words")))
    before = F.sum("_words").over(Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    named = F.when(F.col("_source") != "", F.expr("substring(_source, 2)"))
    totals = parts.groupBy("_source").agg(F.sum("_words").alias("source_size")).select(named.alias("source"), "source_size")
    targets = source_targets(totals, weights, tilts, max_repeat).select(
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("_source"), F.col("source_size").alias("_source_size"),
        F.col("target").alias("_target"), F.col("tilt").alias("_tilt"))
    parts = parts.select("_source", "_bucket", F.coalesce(before, F.lit(0)).alias("_start")).join(targets, "_source")
    rows = rows.join(parts, ["_source", "_bucket"])
    within = Window.partitionBy("_source", "_bucket").orderBy("_order", *order_by).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_before", F.col("_start") + F.sum("_size").over(within) - F.col("_size"))
    budget = F.round("_target").cast("long")
    whole = F.when(F.col("_source_size") > 0, F.floor(budget / F.col("_source_size"))).otherwise(0)
    rest = budget - whole * F.col("_source_size")
    cut = F.least(F.greatest(rest - F.col("_before"), F.lit(0)), F.col("_size"))
    rows = rows.withColumn("_taken", (F.col("_size") * whole + cut).cast("long"))
    first = F.least(F.col("_taken"), F.col("_size"))
    share = (F.col("_before") + first / 2) / F.col("_target")
    return rows.withColumn("_position", F.when(F.col("_taken") > 0, time_of(F.least(share, F.lit(1.0)), F.col("_tilt"))))


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights: tuple[float, ...] = WEIGHTS, tilts: tuple[float, ...] = TILTS, max_repeat: float = 3.0) -> DataFrame:
    """One row per document, in order of training position (untaken ones first).

    doc_id, size, source_size, target, taken, position: ``taken`` counts the
    words of all passes, ``position`` is the document's first training time.
    """
    narrow = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), size_of(whole_text(text_col)).alias("_words_of"),
        F.xxhash64(whole_text(text_col)).alias("_tie"), F.col(f"`{source_col}`").cast("string").alias("_of"))
    rows = _assigned(checkpointed(narrow), F.col("_words_of"), F.col("_of"), [F.col("doc_id"), F.col("_words_of"), F.col("_tie")],
                     weights, tilts, max_repeat)
    return rows.orderBy("_position", "_order", "doc_id").select(
        "doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"),
        F.col("_taken").alias("taken"), F.col("_position").alias("position"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    weights: tuple[float, ...] = WEIGHTS, tilts: tuple[float, ...] = TILTS, max_repeat: float = 3.0) -> DataFrame:
    """The mix itself: the columns of ``docs``, one row per pass, in training order.

    A document that the target cuts in its last pass is passed on whole.
    """
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    plain = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    text, source = whole_text(names[text_col]), F.col(names[source_col]).cast("string")
    doc_id = F.col(names[id_col]).cast("long")
    rows = _assigned(plain, size_of(text), source, [doc_id, size_of(text), F.xxhash64(text)], weights, tilts, max_repeat)
    passes = F.ceil(F.col("_taken") / F.col("_size")).cast("int")
    copies = rows.where("_taken > 0").withColumn("_pass", F.explode(F.sequence(F.lit(0), passes - 1)))
    start = F.col("_pass") * F.col("_source_size") + F.col("_before")
    length = F.least(F.col("_size"), F.col("_taken") - F.col("_pass") * F.col("_size"))
    position = time_of(F.least((start + length / 2) / F.col("_target"), F.lit(1.0)), F.col("_tilt"))
    return copies.orderBy(position, "_order", "_pass").select(*[F.col(n).alias(c) for c, n in names.items()])
