"""Quality classifier (operator 9) from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on each text. Votes are
counted by pattern over all documents (at most 3 to the power of the labellers
rows), and expectation-maximisation on these counts estimates each labeller's
accuracy and the share of good texts. The posterior of a text's votes is a soft
label; a logistic scorer on hashed character trigrams is trained on them and scores
every document, also those on which no labeller votes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices, text_of, utf8

BAD, NONE, GOOD = -1, 0, 1
BUCKETS = 4096
LABELLERS = ("signs", "sign_words", "word_length", "line_ends", "capitals", "repeats", "short", "sentences", "bars")
_SIGNS = np.zeros(256, bool)
_SIGNS[list(b"#$%&*+<=>@\\^_`{|}~")] = True


def votes(text: bytes) -> list[int]:
    """One vote per labeller of LABELLERS; the empty text is bad to ``short`` alone."""
    words = text.split()
    n = len(words)
    if not n:
        return [NONE] * 6 + [BAD, NONE, NONE]
    seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    size = max(1, len(text))
    signs = seen[_SIGNS].sum() / size
    ends = text.count(b". ") + text.count(b".\n") + text.count(b"! ") + text.count(b"? ") + (text.rstrip()[-1:] in b".!?")
    lines = [x for x in text.split(b"\n") if x.strip()]
    closed = sum(x.rstrip()[-1:] in b".!?:;\"" for x in lines) / len(lines)
    upper, lower = seen[65:91].sum(), seen[97:123].sum()
    mean = (size - n) / n
    odd = sum(not w.translate(None, b",.").isalnum() and w.isascii() for w in words) / n
    fresh = len(set(words)) / n
    again = 1 - len(set(lines)) / len(lines)

    def pick(bad: bool, good: bool) -> int:
        return BAD if bad else GOOD if good else NONE

    return [
        pick(signs > 0.08, signs < 0.01),
        pick(odd > 0.5, odd < 0.1),
        pick(mean > 14 or mean < 2.5, 3.5 <= mean <= 9),
        pick(closed < 0.3, closed > 0.8),
        pick(upper > lower, upper < 0.2 * lower),
        pick(again > 0.3 or n >= 50 and fresh < 0.15, again == 0 and fresh > 0.4),
        pick(n < 5, NONE == GOOD),
        pick(n > 30 and ends == 0, ends >= n / 40),
        pick(seen[124] > 0.05 * n, NONE == GOOD),
    ]


def vote_table(docs: DataFrame) -> DataFrame:
    """(all columns of ``docs``, votes: array of byte)."""

    @F.pandas_udf("array<byte>")
    def voted(texts: pd.Series) -> pd.Series:
        return pd.Series([np.array(votes((t or "").encode()), np.int8) for t in texts], dtype=object)

    return docs.withColumn("votes", voted(text_of("text")))


@dataclass
class LabelModel:
    """prior: share of good texts; rates[labeller, class, vote]: probability of each vote (bad, none, good) on bad and on good texts."""

    prior: float
    rates: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability of good for each row of votes."""
        log = np.log(np.array([1 - self.prior, self.prior]))[None, :] + sum(np.log(self.rates[j][:, patterns[:, j] + 1]).T for j in range(patterns.shape[1]))
        log -= log.max(axis=1, keepdims=True)
        p = np.exp(log)
        return p[:, 1] / p.sum(axis=1)

    def accuracy(self) -> np.ndarray:
        """Per labeller, the share of right votes among those cast."""
        weight = np.array([1 - self.prior, self.prior])[None, :, None] * self.rates
        return (weight[:, 0, 0] + weight[:, 1, 2]) / np.maximum(weight[:, :, [0, 2]].sum(axis=(1, 2)), 1e-12)


def label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> LabelModel:
    """Expectation-maximisation on vote patterns (rows x labellers) and their
    counts. It starts from the majority vote, so good keeps its meaning."""
    counts = counts.astype(float)
    score = patterns.sum(axis=1)
    good = np.where(score > 0, 0.9, np.where(score < 0, 0.1, 0.5))
    model = LabelModel(0.5, np.full((patterns.shape[1], 2, 3), 1 / 3))
    for _ in range(rounds):
        w = np.stack([counts * (1 - good), counts * good])
        prior = float(np.clip((w[1].sum() + 1) / (counts.sum() + 2), 1e-4, 1 - 1e-4))
        rates = np.stack([np.stack([[(w[c][patterns[:, j] == v].sum() + 1) for v in (BAD, NONE, GOOD)] for c in (0, 1)]) for j in range(patterns.shape[1])])
        model = LabelModel(prior, rates / rates.sum(axis=2, keepdims=True))
        fresh = model.posterior(patterns)
        if np.abs(fresh - good).max() < 1e-9:
            break
        good = fresh
    return model


def trigrams(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, value) of a text's hashed trigram features: square roots of shares."""
    buf = np.frombuffer(text, np.uint8).astype(np.uint32)
    if len(buf) < 3:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    code = buf[:-2] | buf[1:-1] << 8 | buf[2:] << 16
    bucket = (code * np.uint32(2654435761)) >> np.uint32(20)
    count = np.bincount(bucket, minlength=BUCKETS)
    at = np.flatnonzero(count)
    return at.astype(np.int32), np.sqrt(count[at] / len(code)).astype(np.float32)


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float
    labels: LabelModel


def _descend(x: np.ndarray, y: np.ndarray, rounds: int = 300, rate: float = 4.0, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by gradient descent with momentum."""
    w, b, vw, vb = np.zeros(x.shape[1], np.float32), 0.0, 0.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30)))
        e = (p - y).astype(np.float32) / len(y)
        vw, vb = 0.9 * vw - rate * (x.T @ e + ridge * w), 0.9 * vb - rate * float(e.sum())
        w, b = (w + vw).astype(np.float32), b + vb
    return w, float(b)


def training_texts(docs: DataFrame, most_rows: int) -> DataFrame:
    """(text): the ``most_rows`` different texts of ``docs`` with the least hashes,
    or all if there are fewer; copies count once, null counts as empty."""
    texts = docs.select(text_of("text").alias("text"))

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.zeros(0, np.int64)
        for b in batches:
            kept = np.unique(np.concatenate([kept, b.column(0).to_numpy()]))[:most_rows]
        yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int64())], names=["hash"])

    # only hashes meet, the least of each partition; no task sorts texts
    hashes = texts.select(F.xxhash64("text").alias("hash")).mapInArrow(least, "hash long")
    last = hashes.distinct().orderBy("hash").limit(most_rows).agg(F.max("hash")).first()[0]
    return texts.filter(F.xxhash64("text") <= F.lit(last)).distinct()


def fit(docs: DataFrame, most_rows: int = 6000) -> Scorer:
    """The label model from the votes on all of ``docs`` (text), and the scorer
    from ``most_rows`` different texts (see training_texts) with their posteriors.
    An empty table gives a scorer that scores all texts 0.5."""
    counted = vote_table(docs.select("text")).groupBy("votes").count().collect()
    if not counted:
        return Scorer(np.zeros(BUCKETS, np.float32), 0.0, LabelModel(0.5, np.full((len(LABELLERS), 2, 3), 1 / 3)))
    patterns = np.array([r.votes for r in counted], np.int64)
    labels = label_model(patterns, np.array([r["count"] for r in counted]))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(*trigrams(t), votes(t)) for t in utf8(b.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.list_(pa.int32())), pa.array([r[1] for r in rows], pa.list_(pa.float32())), pa.array([r[2] for r in rows], pa.list_(pa.int8()))], names=["at", "value", "votes"])

    rows = training_texts(docs, most_rows).mapInArrow(made, "at array<int>, value array<float>, votes array<byte>").toPandas()
    x = np.zeros((len(rows), BUCKETS), np.float32)
    for i, (at, value) in enumerate(zip(rows["at"], rows["value"])):
        x[i, np.asarray(at, np.int64)] = value
    w, b = _descend(x, labels.posterior(np.array([list(v) for v in rows["votes"]], np.int64)))
    return Scorer(w, b, labels)


def score(scorer: Scorer, text: str | Column = "text") -> Column:
    """Probability of good (0 to 1) of a text column; null counts as empty and gets the scorer's bias alone."""
    weights, bias = scorer.weights, scorer.bias

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            at, value = trigrams((t or "").encode())
            out.append(1 / (1 + float(np.exp(-np.clip(weights[at] @ value + bias, -30, 30)))))
        return pd.Series(out, dtype=float)

    return scored(text)


def classify(docs: DataFrame, threshold: float = 0.5, most_rows: int = 6000) -> DataFrame:
    """All rows and columns of ``docs`` (text, any others) plus ``quality``
    (0 to 1) and ``keep`` (quality >= threshold), which replace columns of those
    names. Null and empty texts are scored as empty."""
    scorer = fit(docs, most_rows)
    return docs.withColumn("quality", score(scorer, "text")).withColumn("keep", F.col("quality") >= threshold)
