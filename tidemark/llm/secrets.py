"""Secret scans (operator 4).

Candidates are long tokens that hold a digit. A random forest removes the false
positives; it sees a candidate's length, its character transitions, how much of it
words of the corpus cover, the document's path and the neighbouring words. It is
trained on labelled findings.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_of, written

CANDIDATE = re.compile(rb"[A-Za-z0-9_+/=.@:-]{12,}")
# Words that name a credential, and path parts that tell code, data and tests apart.
CREDENTIAL = ("token", "secret", "key", "passwd", "password", "pwd", "auth", "credential", "bearer", "apikey")
EXAMPLE = ("test", "example", "sample", "mock", "fixture", "doc")
CONFIG = ("config", "env", "conf", "settings", "deploy", "yml", "yaml", "json", "ini")
FEATURES = ("length", "upper", "lower", "digits", "signs", "hex", "entropy", "transitions", "upper_lower", "letter_digit", "sign_changes", "repeats", "covered", "longest_word", "path_depth", "path_example", "path_config", "named", "assigned", "quoted", "word_before", "word_after")
_SCHEMA = "doc_id long, start int, end int, candidate string, before string, after string, " + ", ".join(f"{f} double" for f in FEATURES)
WORDS, WORD_CHARS = 20_000, 12


def dictionary(docs: DataFrame, most: int = WORDS) -> list[str]:
    """The ``most`` words of 4 to 12 lower-case letters that most texts of ``docs`` hold, counted over all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(c: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([k.decode(errors="replace") for k in c], pa.string()), pa.array(list(c.values()), pa.int64())], names=["word", "n"])

        counts: Counter = Counter()
        for b in batches:
            for t in b.column(0).cast(pa.binary()).to_pylist():
                counts.update({w for w in t.split() if 4 <= len(w) <= WORD_CHARS and w.isalpha() and w.islower()})
                if len(counts) > 300_000:
                    yield out(counts)
                    counts = Counter()
        if counts:
            yield out(counts)

    words = docs.select(text_of("text").alias("text")).mapInArrow(run, "word string, n long")
    top = words.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(most)
    return [r.word for r in top.collect()]


def _kind(c: int) -> int:
    return 0 if 97 <= c <= 122 else 1 if 65 <= c <= 90 else 2 if 48 <= c <= 57 else 3


def features(token: bytes, before: str, after: str, raw_before: bytes, raw_after: bytes, path: str, words: set[bytes]) -> list[float]:
    """The features of FEATURES of one candidate."""
    n = len(token)
    kinds = np.array([_kind(c) for c in token])
    share = np.bincount(kinds, minlength=4) / n
    change = kinds[1:] != kinds[:-1]
    pairs = Counter(zip(kinds[:-1].tolist(), kinds[1:].tolist()))
    counts = Counter(token).values()
    low = token.lower()
    covered, longest, i = 0, 0, 0
    while i < n:  # longest dictionary word at each place
        for size in range(min(WORD_CHARS, n - i), 3, -1):
            if low[i : i + size] in words:
                covered, longest, i = covered + size, max(longest, size), i + size
                break
        else:
            i += 1
    near = f"{before} {token.decode(errors='replace')}".lower()
    path = path.lower()
    return [
        float(n), share[1], share[0], share[2], share[3],
        float(all(c in b"0123456789abcdef" for c in low)),
        -sum(x / n * log2(x / n) for x in counts),
        change.mean() if n > 1 else 0.0,
        (pairs[0, 1] + pairs[1, 0]) / n,
        sum(v for (a, b), v in pairs.items() if {a, b} & {0, 1} and 2 in (a, b)) / n,
        sum(v for (a, b), v in pairs.items() if (a == 3) != (b == 3)) / n,
        float((np.frombuffer(token, np.uint8)[1:] == np.frombuffer(token, np.uint8)[:-1]).sum()) / n,
        covered / n, float(longest), float(path.count("/")),
        float(any(x in path for x in EXAMPLE)), float(any(x in path for x in CONFIG)),
        float(any(x in near for x in CREDENTIAL)),
        float(raw_before.rstrip(b" \"'`")[-1:] in (b"=", b":")),
        float(raw_before[-1:] in (b'"', b"'", b"`") and raw_after[:1] in (b'"', b"'", b"`")),
        float(before.encode() in words), float(after.encode() in words),
    ]


def candidates(docs: DataFrame, words: list[str]) -> DataFrame:
    """One row per candidate of ``docs`` (doc_id, text, path): place (UTF-8 offsets),
    the token, the words around it and its features."""
    known = {w.encode() for w in words}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, text, path in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), b.column(2).to_pylist()):
                for m in CANDIDATE.finditer(text):
                    token = m.group().rstrip(b".:")
                    if len(token) < 12 or token.isalpha() or not any(48 <= c <= 57 for c in token):
                        continue
                    a, z = m.start(), m.start() + len(token)
                    left, right = text[max(0, a - 64) : a], text[z : z + 64]
                    before = (re.findall(rb"[^\W\d_]+", left) or [b""])[-1].decode(errors="replace").lower()
                    after = (re.findall(rb"[^\W\d_]+", right) or [b""])[0].decode(errors="replace").lower()
                    rows.append((doc, a, z, token.decode(), before, after, *map(float, features(token, before, after, left, right, path or "", known))))
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string(), *[pa.float64()] * len(FEATURES)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["doc_id", "start", "end", "candidate", "before", "after", *FEATURES])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"), F.col("path").cast("string").alias("path"))
    return rows.mapInArrow(run, _SCHEMA)


def train(findings: DataFrame, most_rows: int = 20_000, trees: int = 40, depth: int = 8, seed: int = 7) -> PipelineModel | None:
    """The forest, from at most ``most_rows`` labelled findings (FEATURES, label
    0/1, null: unlabelled). Findings with equal features and label are one, weighted by their number; of each label
    half of the rows are chosen by a hash of the features, more if the other label has fewer. None without findings of both labels."""
    rows = findings.filter("label is not null").select(*FEATURES, F.col("label").cast("double").alias("label"), F.xxhash64(*FEATURES).alias("_hash"))
    groups = written(rows.groupBy("label", "_hash").agg(F.count("*").cast("double").alias("_n")), "groups")
    sizes = {r.label: r["count"] for r in groups.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return None
    half = most_rows // 2
    most = {1.0: max(half, most_rows - sizes[0.0]), 0.0: max(most_rows - half, most_rows - sizes[1.0])}
    chosen = [groups.filter(F.col("label") == k).orderBy("_hash").limit(n) for k, n in most.items()]
    some = rows.join(F.broadcast(chosen[0].unionByName(chosen[1])), ["label", "_hash"]).dropDuplicates(["label", "_hash"])
    some = written(some.drop("_hash"), "findings")
    total = {r.label: r.n for r in some.groupBy("label").agg(F.sum("_n").alias("n")).collect()}
    weight = F.col("_n") * F.when(F.col("label") == 1, sum(total.values()) / (2.0 * total[1.0])).otherwise(sum(total.values()) / (2.0 * total[0.0]))
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="_features")
    forest = RandomForestClassifier(featuresCol="_features", labelCol="label", weightCol="_weight", numTrees=trees, maxDepth=depth, seed=seed, probabilityCol="_probability", predictionCol="_prediction", rawPredictionCol="_raw")
    fitted = forest.fit(assembler.transform(some.withColumn("_weight", weight)))
    return PipelineModel([assembler, fitted])


def judged(findings: DataFrame, model: PipelineModel | None) -> DataFrame:
    """``findings`` without the features, plus ``probability`` (of a true secret)
    and ``secret``. Without a model every candidate is reported, probability null."""
    if model is None:
        return findings.drop(*FEATURES).withColumns({"probability": F.lit(None).cast("double"), "secret": F.lit(True)})
    from pyspark.ml.functions import vector_to_array

    out = model.transform(findings).withColumn("probability", vector_to_array("_probability")[1])
    return out.drop(*FEATURES, "_features", "_raw", "_probability", "_prediction").withColumn("secret", F.col("probability") >= 0.5)


def labelled_findings(found: DataFrame) -> DataFrame:
    """``found`` plus ``label`` from checks that need no model, as a reviewer's
    marks would be: 1 for 32 or more hexadecimal or mixed characters assigned to a
    credential's name, 0 for numbers, addresses, hosts and tokens mostly of
    dictionary words, else null."""
    mixed = F.col("candidate").rlike("^[A-Za-z0-9_+/-]{32,}=*$") & (F.col("digits") > 0.1) & (F.col("lower") + F.col("upper") > 0.1)
    plain = F.col("candidate").rlike(r"^[0-9.:+-]+$|@|^[a-z0-9-]+(\.[a-z0-9-]+)+$") | (F.col("covered") > 0.6)
    return found.withColumn("label", F.when(mixed & (F.col("named") == 1) & (F.col("assigned") == 1), 1).when(plain | (F.col("named") == 0), 0))


def scan(docs: DataFrame, findings: DataFrame | None = None, most_rows: int = 20_000) -> DataFrame:
    """One row per candidate in ``docs`` (doc_id, text, path): doc_id, start, end
    (UTF-8 offsets), candidate, before, after, probability, secret. ``findings``:
    labelled findings to train on (default: those of ``labelled_findings`` in docs
    that may be learned from). Null and empty texts have no candidates; a null path
    is an empty one; a null doc_id stays null; repeated rows are reported each.
    """
    found = written(candidates(docs, dictionary(docs)), "candidates")
    if findings is None:
        findings = labelled_findings(found.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0))
    return judged(found, train(findings, most_rows))
