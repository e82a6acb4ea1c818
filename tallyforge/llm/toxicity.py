"""Toxicity scores: boosted trees over dense features, calibrated.

Features of a text: densities of a fixed seed lexicon and of a lexicon learned
from the labels, how near its hits are to second-person words, capitals,
punctuation, drawn-out letters, and words with signs or digits inside, both as
a rate and after undoing the signs.  The learned lexicon holds words and word
beginnings whose share among toxic rows is far above their share among
others; it is counted on at most ``lexicon_rows`` labelled rows.

Gradient-boosted trees (Spark ML) learn from the labelled training rows, and
isotonic regression, fitted on labelled rows the trees have not seen, turns
their output into a probability.  Rows whose crc32(id as text) mod 5 is 0 are
held out and never looked at with their label; remainder 4 calibrates, the
rest fits lexicon and trees.

Defined cases: null text is the empty text, scored by its (zero) features; an
id labelled more than once counts as toxic if one label says so; a null label
or null id trains nothing; without both classes in training every score is the
share of toxic training rows (0 without any); a very long text is read whole;
equal features, so repeated rows too, get equal scores;
other columns are never read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed
from .common import bounded_batches, columns_of, record_batch, whole_text

#: Labelled rows whose words are counted for the lexicon, at most.
LEXICON_ROWS = 20_000
#: Terms of the learned lexicon, and what a term needs: toxic rows, and the ratio of its shares.
LEXICON_SIZE, SUPPORT, RATIO = 500, 4, 6.0
#: Letters of word beginnings that may become terms.
BEGINNINGS = (4, 5, 6)
TREES, DEPTH, STEP = 25, 4, 0.3
PROXIMITY = 4

#: Insults of any topic, and second-person words.
SEEDS = frozenset(
    "idiot idiots moron morons stupid dumb fool loser losers pathetic worthless scum trash garbage clown disgusting filthy "
    "vermin hate hateful kill die ugly shut liar coward pig rat freak creep jerk bastard bitch crap damn hell shit fuck "
    "fucking asshole whore slut imbecile cretin dimwit nitwit halfwit parasite subhuman "
    "dumm idioten arschloch abschaum trottel connard imbécile salaud ordure crétin idiota imbécil basura estúpido".split())
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta vous votre tú ti usted tus vosotros".split())
_SIGNS = str.maketrans("013457@$!|*+", "oieastasiiat")

_WORD = re.compile(r"[^\W\d_]+")
_SIGN = re.compile(r"(?<=[^\W\d_])[@$*0-9!|+]+(?=[^\W\d_])")
_MASKED = re.compile(r"[^\W_@$*!|+]*[^\W_][\w@$*!|+]*")
_PUNCTUATION = b"\"#%&'()*,-./:;<=>@[]^_`{|}~"
_CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"

FEATURES = ("lexicon_density", "lexicon_hits", "lexicon_distinct", "lexicon_strongest", "seed_density", "seed_hits", "near_second_person",
            "second_person", "capitals", "exclamations", "questions", "punctuation", "masked", "masked_seeds", "drawn_out", "length")


def terms_of(word: str) -> Iterator[str]:
    """The word and its beginnings, marked."""
    yield word
    for n in BEGINNINGS:
        if len(word) > n:
            yield word[:n] + "-"


class Reader:
    """Computes features with one lexicon; remembers what words it has met."""

    #: Words remembered before the memory is emptied.
    MEMORY = 300_000

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon, self.met = lexicon, {}

    def weight(self, word: str) -> tuple[float, bool] | None:
        """Lexicon weight and whether the word is a seed; None if neither."""
        seed = word in SEEDS
        weight = max(self.lexicon.get(t, 0.0) for t in terms_of(word)) if len(word) > 2 else 0.0
        return (weight, seed) if weight or seed else None

    def features(self, text: str) -> list[float]:
        lower = text.lower()
        words = _WORD.findall(lower)
        n = max(1, len(words))
        data = text.encode()
        met = self.met
        if len(met) > self.MEMORY:
            met.clear()
        marked = {}
        for word in set(words):
            if word not in met:
                met[word] = self.weight(word)
            if met[word]:
                marked[word] = met[word]
        total, strongest, seeds, near, hits = 0.0, 0.0, 0, 0, 0
        persons = sum(map(words.count, SECOND_PERSON.intersection(words)))
        if marked:
            at = [i for i, w in enumerate(words) if w in SECOND_PERSON]
            p = 0
            for i, word in enumerate(words):
                if word in marked:
                    weight, seed = marked[word]
                    hits, total, strongest, seeds = hits + 1, total + weight, max(strongest, weight), seeds + seed
                    while p < len(at) and at[p] < i - PROXIMITY:
                        p += 1
                    near += p < len(at) and at[p] <= i + PROXIMITY
        masked = masked_seeds = 0
        for m in _SIGN.finditer(lower):
            masked += 1
            window = max(0, m.start() - 40)
            start = lower.rfind(" ", window, m.start())
            token = _MASKED.search(lower, start + 1 if start >= 0 else window, m.end() + 40)
            masked_seeds += token is not None and token[0].rstrip("!|+*").translate(_SIGNS) in SEEDS
        letters = np.frombuffer(data, np.uint8)
        same = letters[1:] == letters[:-1]
        drawn = int((same[1:] & same[:-1] & (letters[2:] > 64)).sum()) if len(letters) > 2 else 0
        return [total / n, math.log1p(hits), math.log1p(len(marked)), strongest, seeds / n, math.log1p(seeds),
                near / n, persons / n, (len(data) - len(data.translate(None, _CAPITALS))) / max(1, len(data)),
                data.count(b"!") / n, data.count(b"?") / n, (len(data) - len(data.translate(None, _PUNCTUATION))) / n,
                masked / n, masked_seeds / n, drawn / n, math.log1p(len(words))]


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def learn_lexicon(rows: DataFrame, known: DataFrame, sample_rows: int = LEXICON_ROWS, size: int = LEXICON_SIZE) -> dict[str, float]:
    """Terms (word, or beginning with '-') and weights, at most ``size``, from doc_id, text and doc_id, toxic, order."""
    # The sample is bounded by sample_rows, so its narrow rows are broadcast and no text is shuffled.
    chosen = known.orderBy("order", "doc_id").limit(sample_rows).select("doc_id", "toxic")
    sample = rows.join(F.broadcast(chosen), "doc_id")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("term", pa.string()), ("toxic", pa.int64())])
        for cols in columns_of(batches):
            for text, toxic in zip(cols["text"], cols["toxic"]):
                found = {t for w in set(_WORD.findall(text.lower())) if len(w) > 2 for t in terms_of(w)}
                if found:
                    yield record_batch(schema, {"term": list(found), "toxic": [toxic] * len(found)})

    counts = sample.select("text", "toxic").mapInArrow(split, "term string, toxic long").groupBy("term").agg(
        F.sum("toxic").alias("pos"), F.count(F.lit(1)).alias("all"))
    totals = chosen.agg(F.sum("toxic").alias("pos"), F.count(F.lit(1)).alias("all")).first()
    pos, neg = totals["pos"] or 0, totals["all"] - (totals["pos"] or 0)
    if not pos or not neg:
        return {}
    ratio = (F.col("pos") / F.lit(pos)) / ((F.col("all") - F.col("pos") + 0.5) / F.lit(neg + 0.5))
    best = counts.where(F.col("pos") >= SUPPORT).withColumn("weight", F.log(ratio)).where(F.col("weight") >= math.log(RATIO))
    return {r["term"]: r["weight"] for r in best.orderBy(F.desc(F.col("weight") * F.log1p("pos")), "term").limit(size).collect()}


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
             lexicon_rows: int = LEXICON_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted; labels has the id and the label (0/1)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    truth = labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{label_col}`").cast("long").alias("toxic"))
    truth = truth.where((remainder(F.col("doc_id")) != 0) & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = checkpointed(truth.select("doc_id", "toxic", F.xxhash64("doc_id").alias("order"), remainder(F.col("doc_id")).alias("part")))
    lexicon = learn_lexicon(rows, known.where("part != 4"), lexicon_rows)

    schema = pa.schema([("doc_id", pa.int64()), ("x", pa.list_(pa.float64()))])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(lexicon)
        for cols in columns_of(batches):
            yield record_batch(schema, {"doc_id": cols["doc_id"], "x": [reader.features(t) for t in cols["text"]]})

    seen = checkpointed(rows.mapInArrow(look, "doc_id long, x array<double>"))
    train = seen.join(known, "doc_id").select(
        "order", "x", "part", F.col("toxic").cast("double").alias("label"), array_to_vector("x").alias("features"))
    counts = {r["label"]: r["n"] for r in train.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    held_out = F.coalesce(remainder(F.col("doc_id")) == 0, F.lit(False)).alias("held_out")
    if len(counts) < 2:
        share = counts.get(1.0, 0) / max(1, sum(counts.values()))
        return seen.select("doc_id", held_out, F.lit(float(share)).alias("score"), F.lit(int(share >= 0.5)).alias("predicted"))

    # Rows in a fixed order and place, so that reruns grow the same trees.
    parts = 1 + sum(counts.values()) // 10_000
    placed = train.repartitionById(parts, F.pmod("order", F.lit(parts)).cast("int"))
    train = checkpointed(placed.sortWithinPartitions("order", "x").drop("order", "x"))
    fit_on = train.where("part != 4")
    if fit_on.select("label").distinct().count() < 2:
        fit_on = train
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=11, minInstancesPerNode=5).fit(fit_on)

    def raw(frame: DataFrame) -> DataFrame:
        return trees.transform(frame).withColumn("raw", vector_to_array("probability")[1])

    # Rounded outputs, so the calibration gets at most 1,001 weighted points.
    points = raw(train.where("part = 4")).groupBy(F.round("raw", 3).alias("raw"), "label").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    points = checkpointed(points)
    scored = raw(seen.select("doc_id", array_to_vector("x").alias("features")))
    if points.select("label").distinct().count() == 2:
        steps = IsotonicRegression(featuresCol="raw", labelCol="label", weightCol="weight", predictionCol="calibrated").fit(points)
        scored = steps.transform(scored)
    else:
        scored = scored.withColumn("calibrated", F.col("raw"))
    # Isotonic steps tie; a thousandth of the trees' output keeps their order.
    score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("calibrated") * 0.999 + F.col("raw") * 0.001))
    return scored.select("doc_id", held_out, score.alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
