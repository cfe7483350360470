"""Document fingerprints (operator 2).

A fingerprint is a bottom-k sketch: the k smallest distinct hashes of a text's
word shingles. Sketches merge (the k smallest of the union), so parts of a text or
a corpus can be sketched apart, and estimate the resemblance and the containment
of two texts and a text's number of distinct shingles. Texts with k shingles or
fewer are represented exactly.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from tidemark.llm.common import bounded_batches, shuffle_partitions

K = 256
WORDS = 5
_SPAN = float(2**64)


def sketch(text: bytes, k: int = K, words: int = WORDS) -> np.ndarray:
    """The sketch of a UTF-8 text: A-Z lower-cased, words cut at ASCII white
    space. Fewer words than a shingle: the whole sequence is one; none: empty."""
    found = text.lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    joined = b" ".join(found)
    if len(found) <= words:
        return np.array([xxhash.xxh64_intdigest(joined)], np.uint64)
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = [0, *(spaces[: len(found) - words] + 1).tolist()]
    ends = [*spaces[words - 1 :].tolist(), len(joined)]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[a:b]) for a, b in zip(starts, ends)), np.uint64, len(starts)))[:k]


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of the union of what two sketches stand for."""
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of common shingles among all of both; two empty sketches: 1."""
    union = merge(a, b, k)
    if not len(union):
        return 1.0
    common = np.intersect1d(a, b, assume_unique=True)
    return float(np.searchsorted(common, union[-1], side="right")) / len(union)


def distinct_count(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles."""
    return float(len(a)) if len(a) < k else (k - 1) / ((float(a[-1]) + 1) / _SPAN)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has; 1 for an empty a."""
    if not len(a):
        return 1.0
    common = resemblance(a, b, k) * distinct_count(merge(a, b, k), k)
    return min(1.0, common / distinct_count(a, k))


def encode(a: np.ndarray) -> str:
    return base64.b64encode(a.astype("<u8").tobytes()).decode()


def decode(text: str | None) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text or ""), "<u8")


def fingerprint(k: int = K, words: int = WORDS):
    """A function of a text column: its fingerprint as a string (null: that of the empty text)."""

    @F.pandas_udf("string")
    def made(texts: pd.Series) -> pd.Series:
        return pd.Series([encode(sketch((t or "").encode(), k, words)) for t in texts], dtype=object)

    return made


def merge_parts(parts: DataFrame, by: list[str], column: str = "fingerprint", k: int = K) -> DataFrame:
    """(by, column): the fingerprints of a group's parts merged. Groups of any
    size: parts are merged by batch before the shuffle, and per task after it, so
    no group is gathered whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept: dict[tuple, np.ndarray] = {}
            for *key, value in zip(*(c.to_pylist() for c in b.columns)):
                part = decode(value)
                kept[tuple(key)] = merge(kept[tuple(key)], part, k) if tuple(key) in kept else part
            cols = [pa.array([key[i] for key in kept], b.schema.field(i).type) for i in range(len(by))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array([encode(x) for x in kept.values()], pa.string())], names=[*by, column])

    some = parts.select(*by, F.col(column).cast("string").alias(column))
    # each stage leaves a row per group and batch; a group's rows are dealt to a few tasks first
    once = some.mapInArrow(run, some.schema)
    dealt = once.withColumn("_salt", F.pmod(F.xxhash64(column), F.lit(64))).repartition(*by, "_salt").sortWithinPartitions(*by).drop("_salt")
    twice = dealt.mapInArrow(run, some.schema)
    # what is left is 64 tasks' worth of sketches a group: the k smallest hashes of them all
    hashes = twice.select(*by, F.explode(_hashes(column)).alias("h")).distinct()
    return hashes.groupBy(*by).agg(_smallest(k)("h").alias(column))


@F.pandas_udf(ArrayType(LongType()))
def _hashes(texts: pd.Series) -> pd.Series:
    return pd.Series([decode(t).view(np.int64) for t in texts], dtype=object)


def _smallest(k: int):
    @F.pandas_udf("string")
    def made(hashes: pd.Series) -> str:
        return encode(np.unique(hashes.to_numpy(np.int64).view(np.uint64))[:k])

    return made


def edited(text: str, following: str) -> str:
    """The text with its last floor(n/2) code points replaced by the first as many (or all) of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _pairs(k: int, words: int):
    """One pass over rows sorted by bucket; the row after a row of the bucket is its next document."""

    def row(doc_id, text, own, following, other):
        changed = edited(text, following)
        print_ = sketch(changed.encode(), k, words)
        return doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), encode(own), encode(print_), resemblance(own, print_, k), None if other is None else resemblance(own, other, k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # bucket, guest, doc_id, text, sketch
        for b in batches:
            out = []
            for bucket, guest, doc_id, text in zip(*(c.to_pylist() for c in b.columns)):
                own = sketch(text.encode(), k, words)
                if held is not None and not held[1] and held[0] == bucket:
                    out.append(row(*held[2:], text, own))
                if bucket < 0:  # without a place in the order
                    out.append(row(doc_id, text, own, "", None))
                    held = None
                else:
                    held = bucket, guest, doc_id, text, own
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(_names, r)) for r in out], schema=_arrow)

    return run


_names = [x.split()[0] for x in _SCHEMA.split(", ")]
_arrow = pa.schema([(n, {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}[x.split()[1]]) for n, x in zip(_names, _SCHEMA.split(", "))])


def neighbour_fingerprints(docs: DataFrame, k: int = K, words: int = WORDS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the next row by (doc_id, text); after the last comes
    the first. Null text: empty. A null doc_id has no place in that order: its
    edited text is cut to its first half and near_next is null. Empty table: empty
    result. Documents are dealt to buckets of doc_id ranges in one shuffle; a
    bucket's first document is sent to the bucket before as well, so every row
    meets its next one.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = shuffle_partitions(spark)
    cuts = rows.select(F.min("doc_id").alias("low"), F.percentile_approx("doc_id", [i / n for i in range(1, n)] or [0.5], 10_000).alias("cuts")).first()
    starts = np.array(sorted({x for x in (cuts.low, *(cuts.cuts or [])) if x is not None}), np.int64)

    @F.pandas_udf("array<long>")
    def places(ids: pd.Series) -> pd.Series:
        """The row's bucket, and for a bucket's first document, negated and less 1, the bucket before."""
        out = []
        for x in ids:
            if pd.isna(x):
                out.append([])
                continue
            b = int(np.searchsorted(starts, x, side="right")) - 1
            out.append([b, -((b - 1) % len(starts)) - 1] if starts[b] == x else [b])
        return pd.Series(out, dtype=object)

    lost = rows.filter("doc_id is null").select(F.lit(-1).cast("long").alias("bucket"), F.lit(False).alias("guest"), "doc_id", "text")
    dealt = rows.filter("doc_id is not null").withColumn("place", F.explode(places(F.col("doc_id"))))
    dealt = dealt.select(F.when(F.col("place") < 0, -F.col("place") - 1).otherwise(F.col("place")).alias("bucket"), (F.col("place") < 0).alias("guest"), "doc_id", "text")
    dealt = dealt.repartition("bucket").sortWithinPartitions("bucket", "guest", "doc_id", "text")
    return dealt.mapInArrow(_pairs(k, words), _SCHEMA).unionByName(lost.mapInArrow(_pairs(k, words), _SCHEMA))
