"""Toxicity (operator 10).

A weighted lexicon of words and word beginnings, learned from labelled texts, is
matched by an Aho-Corasick automaton in folded text: homoglyphs and digit substitutions become
the letters they stand for, so ``1d10t`` or a Cyrillic ``о`` match. A match that
is part of an exception phrase does not count. The sum of weights, as it is and
normalised by length, gives the score through a logistic curve.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import released, text_of, written

# Characters read as the ASCII letter they look like or replace.
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "l"}
CYRILLIC = dict(zip("авекмнорстухіјѕԁһԛԝ", "abekmhopctyxijsdhqw"))
GREEK = dict(zip("αβεικνορτυχγ", "abeiknoptuxy"))
WIDE = {chr(0xFF41 + i): chr(97 + i) for i in range(26)}
FOLD = {ord(k): v for k, v in {**CYRILLIC, **GREEK, **WIDE}.items()}
INVISIBLE = {c: None for c in (0x00AD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)}
LETTERS = str.maketrans({**FOLD, **INVISIBLE})
STRANGE = re.compile("[" + "".join(map(chr, [*FOLD, *INVISIBLE])) + "]")
SWAPS = str.maketrans(DIGITS)
WORD = re.compile(r"[^\W_]+", re.UNICODE)
EDGES = ".,;:!?|*&%#'\"()[]{}<>-_=+/~`"


def fold(text: str) -> str:
    """Lower case, homoglyphs as ASCII letters, invisible characters removed,
    and digits and signs inside words as letters. Words end up separated by one
    space, with one at either end; other signs are dropped. Numbers stay."""
    text = text.lower()
    if not text.isascii() and STRANGE.search(text):
        text = text.translate(LETTERS)
    out = []
    for w in text.split():
        if not w.isalpha():
            w = w.strip(EDGES)
            if not w.isalpha():
                if any(map(str.isalpha, w)):
                    w = w.translate(SWAPS)
                if not w.isalpha():
                    out += WORD.findall(w)
                    continue
        out.append(w)
    return " " + " ".join(out) + " "


#: Letters of the word beginnings that a lexicon may hold, for languages that compound and inflect.
STEMS = range(4, 9)


def terms(word: str) -> list[str]:
    """What a lexicon can hold of a word: the word between spaces, its beginnings after one."""
    return [f" {word} ", *(f" {word[:n]}" for n in STEMS if len(word) > n)]


@dataclass
class Model:
    """weights: term -> weight; exceptions: folded two-word phrases that cancel
    the words in them; curve: intercept and factors of the features."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: set[str] = field(default_factory=set)
    curve: list[float] = field(default_factory=lambda: [-3.0, 0.0, 0.0])

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            found.add_word(term, (term, weight))
        found.make_automaton()
        return found


def lexicon_weight(folded: str, automaton: ahocorasick.Automaton, exceptions: set[str]) -> float:
    """Sum of the weights of the terms that match outside exception phrases."""
    total = 0.0
    for end, (term, weight) in automaton.iter(folded):
        if exceptions:
            start = end - len(term) + 2  # of the word; its term begins with a space
            stop = end if term[-1] == " " else folded.find(" ", end + 1)
            before = folded.rfind(" ", 0, start - 1)
            after = folded.find(" ", stop + 1)
            if folded[before + 1 : stop] in exceptions or after > 0 and folded[start:after] in exceptions:
                continue
        total += weight
    return total


def features(total: float, folded: str) -> tuple[float, float]:
    """The weight found, dampened, and the weight for each 100 words."""
    return float(np.log1p(total)), float(np.log1p(100 * total / max(20, folded.count(" ") - 1)))


def fit(labelled: DataFrame, most_terms: int = 1000, least_docs: int = 5) -> Model:
    """A model from ``labelled`` (text, label 0/1), a bounded table (see training_rows).

    Candidates are the ``most_terms`` words and word beginnings with the highest
    z-score (over 6) between the shares of texts of either label that hold them, in
    ``least_docs`` texts of label 1 at least. The lexicon is picked from them one by
    one, each time the term that explains most texts of label 1 not yet explained,
    less the texts of label 0 that hold it, as long as two are gained; then those
    follow that 2 % of the texts of label 1 hold and a hundredth of that share of the
    texts of label 0 at most. Copies of one text count once, with the label that
    most of them have (0 if as many have either). Weight: log odds.
    Exceptions: two-word phrases with a lexicon word, in two clean texts or more and
    three times as often there as in texts of label 1 (the 5,000 most frequent). Candidates
    have 3 to 30 letters, so a longer run without spaces is in no lexicon. Null labels are left out, null
    texts are empty; without both labels the model scores all texts alike.
    """
    rows = labelled.filter("label is not null").select(text_of("text").alias("text"), F.col("label").cast("int").alias("label"))
    rows = written(distinct_texts(rows), "labelled")
    sizes = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    n1, n0 = sizes.get(1, 0), sum(n for k, n in sizes.items() if k != 1)
    if not n1 or not n0:
        return Model(curve=[3.0 if n1 else -3.0, 0.0, 0.0])

    def shares(terms: DataFrame) -> DataFrame:
        side = lambda is1: F.coalesce(F.sum(F.when((F.col("label") == 1) == is1, F.col("n"))), F.lit(0))
        counts = terms.groupBy("term").agg(side(True).alias("toxic"), side(False).alias("clean"))
        return counts.withColumns({"p": (F.col("toxic") + 0.5) / (n1 + 1), "q": (F.col("clean") + 0.5) / (n0 + 1)})

    both = (F.col("toxic") + F.col("clean") + 1) / (n1 + n0 + 2)
    words = shares(rows.mapInArrow(released(_count_words(None)), "label int, term string, n long"))
    words = words.withColumns({"z": (F.col("p") - F.col("q")) / F.sqrt(both * (1 - both) * (1.0 / n1 + 1.0 / n0)), "weight": F.log(F.col("p") / F.col("q"))})
    near = words.filter((F.col("toxic") >= least_docs) & (F.col("z") > 6) & (F.col("p") >= 3 * F.col("q"))).orderBy(F.desc("z"), "term").limit(most_terms).collect()
    weights = {r.term: float(r.weight) for r in near}
    pure = {r.term for r in near if r.toxic >= max(8, 0.02 * n1) and r.clean * n1 <= 0.01 * r.toxic * n0}
    model = Model(weights={w: weights[w] for w in sorted(pure.union(_picked(rows, list(weights))))})
    phrases = shares(rows.mapInArrow(released(_count_words(frozenset(model.weights))), "label int, term string, n long"))
    usual = phrases.filter((F.col("clean") >= 2) & (F.col("q") >= 3 * F.col("p")))
    model.exceptions = {r.term for r in usual.orderBy(F.desc("clean"), "term").limit(5000).collect()}
    x = rows.select("label", lexicon_features(model)("text").alias("x")).select("label", "x.*").toPandas()
    model.curve = _logistic(x[["weight", "density"]].to_numpy(float), (x["label"] == 1).to_numpy(float))
    return model


def distinct_texts(rows: DataFrame) -> DataFrame:
    """(text, label) of the different whole texts of ``rows``: label 1 where more copies have it than not, else 0."""
    toxic = F.sum(F.when(F.col("label") == 1, 1).otherwise(-1))
    return rows.groupBy("text").agg(F.when(toxic > 0, 1).otherwise(0).alias("label"))


def _picked(rows: DataFrame, words: list[str]) -> list[str]:
    """The candidates that explain texts of label 1 which the ones picked before do not."""
    place = {w: i for i, w in enumerate(words)}

    @F.pandas_udf("array<int>")
    def held(texts: pd.Series) -> pd.Series:
        return pd.Series([list({place[x] for w in set(fold(t).split()) for x in terms(w) if x in place}) for t in texts], dtype=object)

    found = rows.select("label", held("text").alias("words")).filter(F.size("words") > 0).collect()
    has = np.zeros((len(found), len(words)), bool)
    for i, r in enumerate(found):
        has[i, list(r.words)] = True
    toxic = np.array([r.label == 1 for r in found], bool)
    clean, left, out = has[~toxic].sum(axis=0), has[toxic], []
    while len(left):
        gain = left.sum(axis=0) - clean
        best = int(np.argmax(gain))
        if gain[best] < 2:
            break
        out.append(words[best])
        left = left[~left[:, best]]
    return out


def _count_words(lexicon: frozenset[str] | None):
    """Per batch, how many texts of a label hold each term, or each two-word phrase with a word that the lexicon matches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts: Counter = Counter()
            for text, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = fold(text).split()
                if lexicon is None:
                    held = {x for w in set(words) if 3 <= len(w) <= 30 for x in terms(w)}
                else:
                    hits = {w for w in set(words) if any(x in lexicon for x in terms(w))}
                    held = {f"{x} {y}" for x, y in zip(words, words[1:]) if x in hits or y in hits}
                counts.update((label, t) for t in held)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in counts], pa.int32()), pa.array([k[1] for k in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], names=["label", "term", "n"])

    return run


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> list[float]:
    """Logistic regression by Newton steps, with a small ridge on the factors."""
    x = np.column_stack([np.ones(len(x)), x])
    w, penalty = np.zeros(x.shape[1]), np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist()


def lexicon_features(model: Model):
    """A function of a text column: struct (weight, density)."""

    @F.pandas_udf("weight double, density double")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = model.automaton()
        for texts in batches:
            out = []
            for t in texts:
                folded = fold(t or "")
                out.append(features(lexicon_weight(folded, automaton, model.exceptions) if model.weights else 0.0, folded))
            yield pd.DataFrame(out, columns=["weight", "density"])

    return found


def score(model: Model, text: str | Column = "text") -> Column:
    """Score from 0 to 1 of a text column; higher means label 1 is likelier. Null and empty texts get the score of a text without matches."""
    x = lexicon_features(model)(text)
    a, b, c = model.curve
    return 1 / (1 + F.exp(-(F.lit(a) + F.lit(b) * x["weight"] + F.lit(c) * x["density"])))


def train_part(id_column: str | Column = "doc_id") -> Column:
    """Whether a row may be learned from: crc32 of its id as text is no multiple of 5."""
    column = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.crc32(column.cast("string").cast("binary")) % 5 != 0


def training_rows(docs: DataFrame, labels: DataFrame, label: str = "toxic", most_rows: int = 20_000) -> DataFrame:
    """(text, label) of labelled documents that may be learned from: at most
    ``most_rows``, chosen by a hash of the id, so the ids can be broadcast. An id with
    several labels has the one that more of its rows have, 0 if as many have either."""
    marked = labels.select(F.col("doc_id").alias("_id"), F.col(label).alias("label")).filter("label is not null").filter(train_part("_id"))
    votes = F.sum(F.when(F.col("label") == 1, 1).otherwise(-1))
    marked = marked.groupBy("_id").agg(F.when(votes > 0, 1).otherwise(0).alias("label"))
    some = marked.orderBy(F.xxhash64("_id"), "_id").limit(most_rows)
    return docs.select("doc_id", "text").join(F.broadcast(some), F.col("doc_id") == F.col("_id")).select("text", "label")
