"""Quality classifier from weak labels.

Heuristic labellers look at simple statistics of a text and vote good, bad, or
abstain.  The votes of all documents are counted by pattern (at most three to
the number of labellers, so the counts are bounded whatever the corpus), and
expectation-maximisation estimates from them the share of good documents and
what each labeller says about good and bad ones; no human label is used.  The
posterior of a document's pattern is its weak label.

A linear scorer learns the weak labels from hashed features: byte trigrams of
the text by frequency, and the statistics in steps.  It is fitted on a bounded
sample (``train_rows``, the documents with the smallest hashes of id and text);
everything else covers all documents.  The scorer sees wording that no
heuristic names, and decides alone: ``keep`` is score >= threshold.

Defined cases: null text is the empty text; a text without words gets posterior
and score 0 and is rejected; a very long text is read whole; repeated rows and
other ties of votes and words get equal scores; if all documents
have one vote pattern, or the sample has one class, the score is the
posterior; ids may repeat; other columns pass through ``good_documents``
untouched; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed
from .common import bounded_batches, columns_of, free_name, record_batch, whole_text

#: Rows the linear scorer is fitted on, at most.
TRAIN_ROWS = 3000
HASH_BITS = 12
THRESHOLD = 0.5

#: Frequent function words of the corpus languages.
FUNCTION_WORDS = frozenset(
    "a an and are as at be but by for from has have he in is it of on or that the this to was were will with not "
    "der die das und ist von den zu mit für auf nicht ein eine auch des im dem sich als "
    "le la les de des et un une que est pour dans qui pas sur par du au avec ne "
    "el los las y del se por con para una su lo como en".split())

STATISTICS = ("upper", "bang", "pipe", "symbol", "repeat", "variety", "function", "digit", "long_word", "sentence")
#: Bad at or beyond the first value, good at or before the second; a labeller with bad < good turns round.
LABELLERS = {
    "upper": (0.4, 0.15), "bang": (0.3, 0.05), "pipe": (0.15, 0.02), "symbol": (0.06, 0.02), "repeat": (0.15, 0.03),
    "variety": (0.3, 0.5), "function": (0.03, 0.1), "digit": (0.25, 0.08), "long_word": (0.15, 0.05),
}
_SYMBOLS = b"#$%&*<>{}[]\\^~_=+@|"
_BANG, _PIPE = b"!?", b"|"
_DIGITS = b"0123456789"
_UPPER, _LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"


def _share(data: bytes, among: bytes, total: int) -> float:
    return (len(data) - len(data.translate(None, among))) / total if total else 0.0


def statistics(text: str) -> tuple[float, ...] | None:
    """The STATISTICS of a text, or None without words."""
    words = text.split()
    if not words:
        return None
    data, n = text.encode(), len(words)
    lower = [w.lower() for w in words]
    bare = [w.strip(".,;:!?|\"'()") for w in lower]
    letters = len(data) - len(data.translate(None, _UPPER + _LOWER))
    lines = [x for x in text.split("\n") if x.strip()]
    return (
        _share(data, _UPPER, letters), _share(data, _BANG, n), _share(data, _PIPE, n), _share(data, _SYMBOLS, len(data)),
        sum(map(str.__eq__, lower, lower[1:])) / n, len(set(lower)) / min(n, 400), sum(w in FUNCTION_WORDS for w in bare) / n,
        _share(data, _DIGITS, len(data)), sum(len(w) > 25 for w in words) / n,
        sum(x.rstrip()[-1] in ".!?\"'" for x in lines) / max(1, len(lines)))


def votes(stats: tuple[float, ...] | None) -> str:
    """One letter per labeller: g(ood), b(ad), or - if it abstains."""
    if stats is None:
        return "b" * len(LABELLERS)
    out = []
    for name, (bad, good) in LABELLERS.items():
        x = stats[STATISTICS.index(name)]
        sign = 1 if bad > good else -1
        out.append("b" if sign * x >= sign * bad else "g" if sign * x <= sign * good else "-")
    return "".join(out)


def hashed(text: str, stats: tuple[float, ...], bits: int = HASH_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values: trigram frequencies, then the statistics in steps."""
    data = np.frombuffer(text.encode(), np.uint8).astype(np.uint32)
    size = 1 << bits
    if len(data) >= 3:
        at = (data[:-2] * np.uint32(0x9E3779B1) + data[1:-1] * np.uint32(0x85EBCA77) + data[2:] * np.uint32(0xC2B2AE3D)) >> np.uint32(32 - bits)
        counts = np.bincount(at, minlength=size)
        index = np.flatnonzero(counts)
        value = np.sqrt(counts[index] / len(at))
    else:
        index, value = np.empty(0, np.int64), np.empty(0)
    steps = [size + 16 * i + min(15, int(16 * x ** 0.5)) for i, x in enumerate(min(1.0, max(0.0, s)) for s in stats)]
    return np.concatenate([index, steps]), np.concatenate([value, np.ones(len(steps))])


# ----------------------------------------------------- expectation-maximisation

@dataclass(frozen=True)
class LabelModel:
    """Share of good documents and each labeller's answers: ``answers[c, l, v]`` for class, labeller, vote."""

    good: float
    answers: np.ndarray

    def posterior(self, patterns: list[str]) -> np.ndarray:
        codes = _codes(patterns)
        score = np.log(np.array([1 - self.good, self.good]))[:, None] + sum(
            np.log(self.answers[:, j, codes[:, j]]) for j in range(codes.shape[1]))
        return 1 / (1 + np.exp(np.clip(score[0] - score[1], -500, 500)))

    def accuracy(self) -> dict[str, float]:
        """Of each labeller's votes, the estimated share that is right."""
        prior = np.array([1 - self.good, self.good])
        right = prior[0] * self.answers[0, :, 0] + prior[1] * self.answers[1, :, 2]
        said = (prior[:, None] * (self.answers[:, :, 0] + self.answers[:, :, 2])).sum(axis=0)
        return {name: float(r / s) for name, r, s in zip(LABELLERS, right, said)}


def _codes(patterns: list[str]) -> np.ndarray:
    return np.array([["b-g".index(v) for v in p] for p in patterns], np.int64).reshape(len(patterns), -1)


def fit_labels(counts: dict[str, int], rounds: int = 200) -> LabelModel:
    """EM over pattern counts, started from the majority of votes."""
    patterns = sorted(counts)
    weight = np.array([counts[p] for p in patterns], float)
    codes = _codes(patterns)
    good = 1 / (1 + np.exp(-np.clip((codes - 1).sum(axis=1) - 1, -20, 20)))  # one dissent against all others is bad only if strong
    bad_votes = (codes == 0).sum(axis=1)
    good = np.where(bad_votes >= 2, 0.05, np.where(bad_votes == 1, 0.4, np.maximum(good, 0.9)))
    model = None
    for _ in range(rounds):
        share = float(np.clip((good * weight).sum() / weight.sum(), 0.01, 0.99))
        answers = np.empty((2, codes.shape[1], 3))
        for c, belief in enumerate((1 - good, good)):
            for j in range(codes.shape[1]):
                answers[c, j] = np.bincount(codes[:, j], weights=belief * weight, minlength=3) + 0.5
            answers[c] /= answers[c].sum(axis=1, keepdims=True)
        model = LabelModel(share, answers)
        after = model.posterior(patterns)
        if np.abs(after - good).max() < 1e-6:
            break
        good = after
    return model


# ----------------------------------------------------------------- the scorer

def fit_linear(rows: list[tuple[np.ndarray, np.ndarray, float]], bits: int = HASH_BITS, rounds: int = 300) -> np.ndarray:
    """Weights (bias last) of a logistic regression on soft labels, classes balanced, by Nesterov steps."""
    width = (1 << bits) + 16 * len(STATISTICS) + 1
    x = np.zeros((len(rows), width), np.float32)
    y = np.array([r[2] for r in rows], np.float32)
    for i, (index, value, _) in enumerate(rows):
        x[i, index] = value
    x[:, -1] = 1
    good, bad = max(float(y.sum()), 1.0), max(float((1 - y).sum()), 1.0)
    weight = y * (0.5 / good) + (1 - y) * (0.5 / bad)
    w = np.zeros(width, np.float32)
    ahead, step, penalty = w.copy(), np.float32(0.5), np.float32(1e-4)
    for k in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ ahead, -30, 30)))
        gradient = x.T @ ((p - y) * weight) + penalty * ahead
        after = ahead - step * gradient
        ahead = after + np.float32(k / (k + 3)) * (after - w)
        w = after
    return w


_SEEN = pa.schema([("votes", pa.string()), ("order", pa.int64())])


def _look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in columns_of(batches):
        yield record_batch(_SEEN, {"votes": [votes(statistics(t)) for t in rows["text"]], "order": rows["order"]})


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("votes", pa.string()), ("index", pa.list_(pa.int64())), ("value", pa.list_(pa.float64()))])
    for rows in columns_of(batches):
        out: dict[str, list] = {f.name: [] for f in schema}
        for text in rows["text"]:
            stats = statistics(text)
            if stats is not None:
                index, value = hashed(text, stats)
                for name, x in (("votes", votes(stats)), ("index", index), ("value", value)):
                    out[name].append(x)
        yield record_batch(schema, out)


@dataclass(frozen=True)
class QualityModel:
    labels: LabelModel | None
    weights: np.ndarray | None  # None: the posterior is the score

    def score(self, text: str) -> tuple[str, float, float]:
        """Votes, posterior and score of one text."""
        stats = statistics(text)
        said = votes(stats)
        if stats is None or self.labels is None:
            return said, 0.0, 0.0
        posterior = float(self.labels.posterior([said])[0])
        if self.weights is None:
            return said, posterior, posterior
        index, value = hashed(text, stats)
        z = float(self.weights[index] @ value + self.weights[-1])
        return said, posterior, float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS) -> QualityModel:
    """Count the votes of all documents, run EM, fit the scorer on at most ``train_rows`` of them."""
    bounded_batches(docs.sparkSession)
    text = whole_text(text_col)
    rows = docs.select(text.alias("text"), F.xxhash64(F.col(f"`{id_col}`"), text).alias("order"))
    seen = checkpointed(rows.mapInArrow(_look, "votes string, order long"))
    counts = {r["votes"]: r["n"] for r in seen.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return QualityModel(None, None)
    labels = fit_labels(counts)
    # The bound of the sample as a threshold on the hash, so that only its rows carry texts along.
    last = seen.orderBy("order").limit(train_rows).agg(F.max("order")).first()[0]
    sample = rows.where(F.col("order") <= F.lit(last)).select("text").mapInArrow(
        _features, "votes string, index array<long>, value array<double>").limit(train_rows).toPandas()
    if sample.empty:
        return QualityModel(labels, None)
    belief = labels.posterior(sample["votes"].tolist())
    if belief.min() > 0.5 or belief.max() < 0.5:
        return QualityModel(labels, None)
    order = sample["votes"].argsort(kind="stable")
    return QualityModel(labels, fit_linear([(sample["index"][i], sample["value"][i], float(belief[i])) for i in order]))


def quality_scores(docs: DataFrame, model: QualityModel | None = None, id_col: str = "doc_id", text_col: str = "text",
                   threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, votes, posterior, score, keep."""
    model = model or fit_quality(docs, id_col, text_col)
    schema = pa.schema([("doc_id", pa.int64()), ("votes", pa.string()), ("posterior", pa.float64()), ("score", pa.float64()), ("keep", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in columns_of(batches):
            said, posterior, score = zip(*[model.score(t) for t in rows["text"]])
            yield record_batch(schema, {"doc_id": rows["doc_id"], "votes": said, "posterior": posterior, "score": score,
                                        "keep": [s >= threshold for s in score]})

    bounded_batches(docs.sparkSession)
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), whole_text(text_col).alias("text")).mapInArrow(
        run, "doc_id long, votes string, posterior double, score double, keep boolean")


def good_documents(docs: DataFrame, model: QualityModel | None = None, id_col: str = "doc_id", text_col: str = "text",
                   threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the scorer keeps, with all their columns."""
    model = model or fit_quality(docs, id_col, text_col)

    @F.pandas_udf("boolean")
    def good(column: pd.Series) -> pd.Series:
        return column.map(lambda t: model.score(t)[2] >= threshold).astype(bool)

    bounded_batches(docs.sparkSession)
    flag = free_name(docs.columns, "_good")
    return docs.withColumn(flag, good(whole_text(text_col))).where(F.col(flag)).drop(flag)
