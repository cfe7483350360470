"""Target-distribution importance resampling (operator 13).

Documents are weighed by how much likelier their hashed word 1- to 3-grams are in
a target corpus than in the corpus itself, and a share of them is drawn without
replacement by perturbed weights (Gumbel top-k).

N-grams are counted by concatenating a batch's texts with a sentinel between
them: one regex pass finds all words of the batch, ``searchsorted`` on the
documents' offsets tells which document a word lies in, n-grams that cross a
document are masked out, and one ``bincount`` adds up the rest. The CRC of a word
is taken once, that of an n-gram is put together from its words' CRCs with table
lookups (a CRC is linear), so no n-gram is ever spelled out.

Spark partitions the work: one pass counts the corpus's buckets (10,000 partial
sums a task at most), one pass weighs every document with the gains of all
buckets (10,000 numbers, whatever the input), and one range-partitioned sort by
(score, doc_id) numbers the rows; a row's rank is its place in its partition plus
the sizes of the partitions before, so no task ever holds the ranking.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, UPPER, bounded_batches, slices, utf8, without, written

BUCKETS = 10_000
#: Words: letters, digits and everything beyond ASCII, as UTF-8 bytes.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_LOWERED = bytes.maketrans(UPPER.encode(), LOWER.encode())
#: The sentinel between two texts; it is in no word.
_SENTINEL = b"\x00"


def _advance_one() -> np.ndarray:
    """What one further zero byte makes of each of the 32 bits of a CRC register."""
    table = np.zeros(256, np.uint32)
    for byte in range(256):
        c = byte
        for _ in range(8):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        table[byte] = c
    bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
    return (bits >> np.uint32(8)) ^ table[bits & np.uint32(255)]


def _apply(columns: np.ndarray, x: np.ndarray) -> np.ndarray:
    out = np.zeros(x.shape, np.uint32)
    for bit in range(32):
        out ^= np.where((x >> np.uint32(bit)) & np.uint32(1), columns[bit], np.uint32(0))
    return out


@lru_cache(maxsize=256)
def _advance(length: int) -> np.ndarray:
    """Lookup tables (4 x 256, by byte of the register) for ``length`` further bytes, by squaring."""
    columns, step = np.uint32(1) << np.arange(32, dtype=np.uint32), _advance_one()
    while length:
        if length & 1:
            columns = _apply(step, columns)
        step, length = _apply(step, step), length >> 1
    every = np.arange(256, dtype=np.uint32)
    return np.stack([_apply(columns, every << np.uint32(8 * k)) for k in range(4)])


def joined_crc(first: np.ndarray, second: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of a + b from those of a and of b, b of the given length in bytes."""
    distinct, which = np.unique(lengths, return_inverse=True)
    out = np.empty(len(first), np.uint32)
    if len(distinct) <= 64:
        tables = np.stack([_advance(int(n)) for n in distinct]) if len(distinct) else np.zeros((0, 4, 256), np.uint32)
        out = tables[which, 0, first & np.uint32(255)]
        for k in range(1, 4):
            out ^= tables[which, k, (first >> np.uint32(8 * k)) & np.uint32(255)]
    else:  # lengths far apart: one table at a time
        order = np.argsort(which, kind="stable")
        for n, rows in zip(distinct, np.split(order, np.flatnonzero(np.diff(which[order])) + 1)):
            t, x = _advance(int(n)), first[rows]
            y = t[0, x & np.uint32(255)]
            for k in range(1, 4):
                y = y ^ t[k, (x >> np.uint32(8 * k)) & np.uint32(255)]
            out[rows] = y
    return out ^ second


def batch_features(texts: list[bytes], longest: int = 3, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, bucket) of every run of 1 to ``longest`` words in a batch of
    texts, and the number of words per document."""
    joined = _SENTINEL.join(texts).translate(_LOWERED)
    starts, words = [], []
    for m in _WORD.finditer(joined):
        starts.append(m.start())
        words.append(m.group())
    ends_of = np.cumsum([len(t) + 1 for t in texts])
    starts = np.array(starts, np.int64)
    doc = np.searchsorted(ends_of, starts, side="right")
    crc = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
    size = np.fromiter(map(len, words), np.int64, len(words))
    # a space in front of a word: the CRC of " " + word
    spaced = joined_crc(np.full(len(words), zlib.crc32(b" "), np.uint32), crc, size) if longest > 1 else crc
    docs, found, run = [doc], [crc % np.uint32(buckets)], crc
    for n in range(2, longest + 1):
        if len(words) < n:
            break
        run = joined_crc(run[:-1], spaced[n - 1 :], size[n - 1 :] + 1)
        whole = doc[: len(run)] == doc[n - 1 :]  # not across a sentinel
        docs.append(doc[: len(run)][whole])
        found.append(run[whole] % np.uint32(buckets))
    return np.concatenate(docs), np.concatenate(found).astype(np.int64), np.bincount(doc, minlength=len(texts))


def bucket_counts(texts: DataFrame, longest: int = 3, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all ``texts`` (column text) fall into each bucket. A
    null text has none; an empty table gives zeros."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            every = utf8(b.column(0))
            for i, j in slices(every):
                total += np.bincount(batch_features(every[i:j], longest, buckets)[1], minlength=buckets)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])], names=["bucket", "n"])

    bounded_batches(texts.sparkSession)
    rows = texts.select(F.col("text").cast("string")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in rows.collect():  # one row a bucket
        out[r.bucket] = r.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket floor(1000 ln of the smoothed likelihood ratio target : corpus)."""
    s, t, k = int(corpus.sum()), int(target.sum()), len(corpus)
    return np.array([math.floor(1000 * math.log(float(b + 1) * (s + k) / (float(a + 1) * (t + k)))) for a, b in zip(corpus.tolist(), target.tolist())], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, longest: int = 3) -> DataFrame:
    """(doc_id, n_words, n_features, weight) for every row of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            every = utf8(b.column(1))
            for i, j in slices(every):
                doc, bucket, words = batch_features(every[i:j], longest, len(gain))
                # gains are added as integers: bincount's weights are doubles, exact below 2^53
                weight = np.bincount(doc, weights=gain[bucket], minlength=j - i).astype(np.int64)
                n = np.bincount(doc, minlength=j - i).astype(np.int64)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(words.astype(np.int64)), pa.array(n), pa.array(weight)], names=["doc_id", "n_words", "n_features", "weight"])

    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def perturbed(weight, doc_id, seed: int = 42):
    """weight plus Gumbel noise in thousandths, fixed by (seed, doc_id)."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("long")
    share = (h + F.lit(0.5)) / F.lit(4294967296.0)
    return weight + F.floor(F.lit(-1000.0) * F.log(-F.log(share)))


def _numbered(rows: DataFrame, *order) -> DataFrame:
    """``rows`` sorted over range partitions, with part (partition) and place (from 0 in it)."""
    fields = rows.schema.simpleString()[len("struct<") : -1] + ",part:int,place:bigint"
    names = [*rows.columns, "part", "place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            n = b.num_rows
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(n, part, np.int32)), pa.array(np.arange(at, at + n))], names=names)
            at += n

    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, fields)


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, longest: int = 3, buckets: int = BUCKETS, seed: int = 42) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) for every row of ``docs`` (doc_id,
    text), drawn towards ``target`` (text): rank is 1, 2, ... for the
    floor(percent * N / 100) highest scores among the N rows of at least
    ``least_words`` words, else null.

    Null or empty texts have no features and weight 0. Equal scores go by doc_id,
    smallest first; rows that are equal in all columns get neighbouring ranks in
    any order. Repeated rows count and rank each on their own. A null doc_id is
    perturbed as the empty one and ranks after all others of its score. An empty
    target gives every feature the gain of an unseen one; an empty ``docs`` an
    empty result. Texts of any length are taken whole. Other columns are ignored.
    """
    gain = gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets))
    rows = weights(docs, gain, longest).withColumn("score", perturbed(F.col("weight"), F.col("doc_id"), seed).cast("long"))
    # written first: cutting the ranges samples its input, which must not weigh every text once more
    rows = written(rows.withColumn("open", F.col("n_words") >= least_words), "weights")
    order = [F.desc("open"), F.desc("score"), F.asc_nulls_last("doc_id"), F.desc("n_features")]
    numbered = written(_numbered(rows, *order), "numbered")
    sizes = {r.part: (r.n, r.opened) for r in numbered.groupBy("part").agg(F.count("*").alias("n"), F.sum(F.col("open").cast("long")).alias("opened")).collect()}  # one row a partition
    drawn = percent * sum(opened for _, opened in sizes.values()) // 100
    before, offsets = 0, []
    for part in sorted(sizes):
        if before < drawn:
            offsets.append((part, before))
        before += sizes[part][0]
    offset = F.lit(None).cast("long")
    if offsets:
        at = F.create_map(*[F.lit(x) for pair in offsets for x in pair])
        offset = at[F.col("part")].cast("long")
    place = offset + F.col("place") + 1
    return without(numbered, "rank").select("doc_id", "n_features", "weight", "score", F.when(place <= drawn, place).alias("rank"))
