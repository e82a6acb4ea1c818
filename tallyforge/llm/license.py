"""License scans: an exact set-similarity join of text blocks with templates.

A block is a line, cut at sentence ends.  A block matches a template when it
holds at least ``THRESHOLD`` of the template's distinct words.  Only template
words can overlap, so a block is reduced to those it has, in order of global
frequency (documents that hold the word, over the whole corpus), rarest first.

* Prefix filter: with an overlap of ``need`` words, the first shared word in
  that order is among the first ``size - need + 1`` of either side.  Documents
  without any template prefix word are not cut into blocks at all.
* Length filter: a block needs at least ``need`` template words.
* Positional filter: from the shared word on, both sides must have enough
  words left.

What remains is verified by the size of the intersection, so no block that
reaches the threshold is missed.  Base phrases are found beside it, by the
places where their words stand consecutively.

Only DataFrame functions run.  The broadcast index has one row per template
prefix word; it, like the frequency list, is bounded by the templates.

Defined cases: null text is the empty text, with no words, labels or score;
repeated rows give repeated results; other columns are not read; null ids are
kept; a very long text is scanned whole; labels of equal score are all listed;
an empty table gives an empty result.  Lower case is Spark's, which changes no
word's place: letters outside A-Z are word characters either way, and the one
that would become an ASCII letter (the Kelvin sign) is kept apart.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed
from .common import whole_text

THRESHOLD = 0.8
WORD = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"

#: Base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: License statements and their labels.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "mit": "Released under the MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc0": "Dedicated to the public domain under CC0 1.0 Universal",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "proprietary": "All rights reserved",
}


def template_words(text: str) -> list[str]:
    return sorted(set(re.findall(r"[0-9a-z]+|[^\x00-\x7F]+", text.lower())))


def _text_array(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.expr("cast(array() as array<string>)")


def _places(words: Column, phrase: str) -> Column:
    """Starts of the phrase among the words; only texts with all its words are searched."""
    parts = phrase.split()

    def fits(i: Column) -> Column:
        return _all([F.get(words, i + F.lit(k)) == F.lit(p) for k, p in enumerate(parts)])

    starts = F.sequence(F.lit(0), F.size(words) - F.lit(len(parts)))
    possible = _all([F.size(words) >= len(parts)] + [F.array_contains(words, p) for p in dict.fromkeys(parts)])
    return F.when(possible, F.filter(starts, fits)).otherwise(F.expr("cast(array() as array<int>)"))


def _all(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return out


def blocks_of(text: Column) -> Column:
    """Lines, cut after . ! or ? with white space behind."""
    return F.split(F.regexp_replace(text, "([.!?])[ \\t\\r]+", "$1\n"), "\n")


def _lowered(text: Column) -> Column:
    """A-Z lower-cased as far as ASCII words can show: of all other letters only the Kelvin sign becomes one."""
    return F.lower(F.replace(text, F.lit("\u212a"), F.lit("\u0138")))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] = TEMPLATES,
                  phrases: dict[str, str] = PHRASES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, n_words, places (array of label, start), matches (array of label, score)."""
    sets = {label: template_words(t) for label, t in templates.items()}
    need = {label: max(1, math.ceil(threshold * len(words) - 1e-9)) for label, words in sets.items()}
    vocabulary = sorted({w for words in sets.values() for w in words})
    text = whole_text(text_col)
    words = F.regexp_extract_all(_lowered(text), F.lit(WORD), F.lit(0))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), words.alias("words"))
    named = [F.transform(_places(F.col("words"), phrase), _named(label)) for phrase, label in phrases.items()]
    looked = checkpointed(rows.select(
        "doc_id", "key", F.size("words").cast("long").alias("n_words"), F.concat(*named).alias("places"),
        F.array_intersect(_text_array(vocabulary), F.col("words")).alias("known")))

    frequency = {r["word"]: r["n"] for r in looked.select(F.explode("known").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = sorted(vocabulary, key=lambda w: (frequency.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    index = []
    for label, members in sets.items():
        ranked = sorted(members, key=rank.__getitem__)
        for position, word in enumerate(ranked[:len(ranked) - need[label] + 1]):
            index.append((word, label, position, len(ranked), need[label], ranked))
    index_rows = docs.sparkSession.createDataFrame(
        index, "word string, label string, t_pos int, t_size int, need int, template array<string>")

    lower = _lowered(text)
    prefix_words = sorted({row[0] for row in index})
    any_prefix = F.lit(False)
    for w in prefix_words:
        any_prefix = any_prefix | F.contains(lower, F.lit(w))
    least = min(need.values())
    # array_intersect keeps the order of its first argument: rarest words first.
    block = F.array_intersect(_text_array(order), F.regexp_extract_all(_lowered(F.col("block")), F.lit(WORD), F.lit(0)))
    cut = docs.where(any_prefix).select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), F.explode(blocks_of(text)).alias("block"))
    cut = cut.where(F.length("block") > 0).select("doc_id", "key", block.alias("toks")).withColumn("b_size", F.size("toks")).where(
        F.col("b_size") >= least)
    each = cut.select("doc_id", "key", "toks", "b_size", F.posexplode("toks").alias("b_pos", "word"))
    fits = (F.col("b_size") >= F.col("need")) & (F.col("b_pos") <= F.col("b_size") - F.col("need")) & (
        F.least(F.col("t_size") - F.col("t_pos"), F.col("b_size") - F.col("b_pos")) >= F.col("need"))
    joined = each.join(F.broadcast(index_rows), "word").where(fits)
    shared = F.size(F.array_intersect("toks", "template"))
    matches = joined.withColumn("shared", shared).where(F.col("shared") >= F.col("need")).groupBy("doc_id", "key", "label").agg(
        F.max(F.col("shared") / F.col("t_size")).alias("score"))
    by_doc = matches.groupBy(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).agg(
        F.array_sort(F.collect_list(F.struct("label", "score"))).alias("matches"))
    return looked.join(by_doc, (F.col("key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left").select(
        "doc_id", "n_words", "places",
        F.coalesce("matches", F.expr("cast(array() as array<struct<label:string,score:double>>)")).alias("matches"))


def _named(label: str):
    return lambda i: F.struct(F.lit(label).alias("label"), i.cast("long").alias("start"))
