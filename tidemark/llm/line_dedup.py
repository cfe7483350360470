"""Line dedup (operator 1).

Lines become 128-bit hashes of their key. The hashes are range-partitioned by
(hash, document) and sorted by (hash, document, position); one pass streams each
sorted partition and keeps a key's first document. Because the document is part
of the range key, a line that stands in a third of all documents is spread over
many partitions; the at most two keys that a partition shares with its neighbours
are settled afterwards from one summary row each. What goes on are positions to
drop and, per document, a compressed bitmap of kept lines; texts are never moved
with the lines.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from tidemark.llm.common import LOWER, SPACE, UPPER, bounded_batches, text_of, without, written

# Rows of the streaming pass: a line to drop, a line at a partition's edge, an edge key's summary.
DROP, EDGE, SUMMARY = 0, 1, 2
_SCHEMA = "kind byte, h1 long, h2 long, doc long, tag long, pos int, n int"


def line_keys(docs: DataFrame, min_chars: int = 20) -> DataFrame:
    """(h1, h2, doc, tag, pos): one row per line whose key (white space
    stripped, A-Z lower-cased) has ``min_chars`` code points or more. ``tag``
    tells rows apart that share a doc_id but not a text."""
    text = text_of("text")
    lines = docs.filter(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc"), F.xxhash64(text).alias("tag"), F.posexplode(F.split(text, "\n")).alias("pos", "line")
    )
    keyed = lines.select("doc", "tag", "pos", F.translate(F.btrim("line", F.lit(SPACE)), UPPER, LOWER).alias("key"))
    keyed = keyed.filter(F.char_length("key") >= min_chars)
    return keyed.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), F.col("key")).alias("h2"), "doc", "tag", "pos")


def _stream(min_docs: int):
    """The pass over one sorted partition. A key's rows come by descending
    document; a document's rank is its place among them. Rank 1 stays. From rank
    ``min_docs`` on lines go at once; lower ranks wait until that rank is seen."""

    def out(kind, h1, h2, doc, tag, pos, n=None):
        size = len(doc)
        n = np.zeros(size, np.int32) if n is None else np.asarray(n, np.int32)
        cols = [np.full(size, kind, np.int8), *(np.asarray(x, np.int64) for x in (h1, h2, doc, tag)), np.asarray(pos, np.int32), n]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in cols], names=["kind", "h1", "h2", "doc", "tag", "pos", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = last_doc = None  # of the row before
        rank, top, first = 0, None, True  # of the current key; first: no other key was met
        waiting: list[np.ndarray] = []
        for b in batches:
            if not b.num_rows:
                continue
            h1, h2, doc, tag, pos = (b.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            n = len(h1)
            new_key = np.ones(n, bool)
            new_key[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            new_key[0] = key != (h1[0], h2[0])
            new_doc = np.ones(n, bool)
            new_doc[1:] = doc[1:] != doc[:-1]
            new_doc[0] = doc[0] != last_doc
            new_doc |= new_key
            index, seen = np.arange(n), np.cumsum(new_doc)
            start = np.maximum.accumulate(np.where(new_key, index, -1))
            ranks = np.where(start >= 0, seen - seen[start] + 1, rank + seen)
            ends = np.append(np.flatnonzero(new_key[1:]), n - 1)  # last row of each key here
            if new_key[0] and key is not None:  # the key before ended with the batch before
                if first:
                    yield out(SUMMARY, [key[0]], [key[1]], [top], [0], [0], [rank])
                waiting, first = [], False
            elif waiting and ranks[ends[0]] >= min_docs:
                w = np.concatenate(waiting, axis=1)
                yield out(DROP, w[0], w[1], w[2], w[3], w[4])
                waiting = []
            elif len(ends) > 1:
                waiting = []
            total = ranks[ends][np.searchsorted(ends, index)]
            goes = ranks >= min_docs
            between = (ranks >= 2) & ~goes
            if first:  # a key that may have begun in a partition before
                head = index <= ends[0]
                unsure = head & ~goes
                yield out(EDGE, h1[unsure], h2[unsure], doc[unsure], tag[unsure], pos[unsure])
                between &= ~head
                if len(ends) > 1:
                    yield out(SUMMARY, [h1[0]], [h2[0]], [doc[0] if top is None else top], [0], [0], [ranks[ends[0]]])
            goes |= between & (total >= min_docs)
            yield out(DROP, h1[goes], h2[goes], doc[goes], tag[goes], pos[goes])
            still = between & ~goes & (index > (ends[-2] if len(ends) > 1 else -1))
            if still.any():
                waiting.append(np.array([h1[still], h2[still], doc[still], tag[still], pos[still]], np.int64))
            if start[-1] >= 0:
                top = doc[start[-1]]
            first = first and len(ends) == 1
            key, last_doc, rank = (h1[-1], h2[-1]), doc[-1], ranks[-1]
        if key is not None:
            yield out(SUMMARY, [key[0]], [key[1]], [top], [0], [0], [rank])
            if waiting:
                w = np.concatenate(waiting, axis=1)
                yield out(EDGE, w[0], w[1], w[2], w[3], w[4])

    return run


def dropped_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(doc, tag, pos) of every line that goes."""
    order = ["h1", "h2", F.desc("doc")]
    lines = line_keys(docs, min_chars).repartitionByRange(*order).sortWithinPartitions(*order, "tag", "pos")
    seen = written(lines.mapInArrow(_stream(min_docs), _SCHEMA), "lines")
    # at most two keys a partition, so small enough to broadcast at any size of the input
    ends = seen.filter(F.col("kind") == SUMMARY).groupBy("h1", "h2").agg(F.sum("n").alias("total"), F.max("doc").alias("top"))
    edge = seen.filter(F.col("kind") == EDGE).join(F.broadcast(ends.filter(F.col("total") >= min_docs)), ["h1", "h2"])
    edge = edge.filter(F.col("doc") != F.col("top")).select("doc", "tag", "pos")
    return seen.filter(F.col("kind") == DROP).select("doc", "tag", "pos").unionByName(edge)


def line_dedup(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """All rows and columns of ``docs`` (doc_id, text, any others) plus
    ``n_lines``, ``n_dropped`` and ``keep_bitmap`` (zlib of one bit per line,
    first line first, 1 = stays). Columns of these names are replaced.

    A key found in ``min_docs`` documents or more keeps its lines only in the
    largest doc_id. Null or empty text: one empty line, which stays. A null
    doc_id counts as no document and keeps all its lines. Rows that share a
    doc_id are one document; each keeps its own bitmap. Empty table: empty result.
    """
    if min_docs < 2:
        raise ValueError("min_docs must be 2 or more")
    bounded_batches(docs.sparkSession)
    docs = without(docs, "n_lines", "n_dropped", "keep_bitmap", "_ld_doc", "_ld_tag", "_ld_pos")
    drops = dropped_lines(docs, min_chars, min_docs).groupBy(F.col("doc").alias("_ld_doc"), F.col("tag").alias("_ld_tag")).agg(F.collect_set("pos").alias("_ld_pos"))
    text = text_of("text")
    on = (F.col("doc_id").cast("long") == F.col("_ld_doc")) & (F.xxhash64(text) == F.col("_ld_tag"))
    n_lines = (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long")
    both = docs.join(drops, on, "left").withColumn("n_lines", n_lines)
    both = both.withColumn("n_dropped", F.when(F.col("_ld_pos").isNull(), 0).otherwise(F.size("_ld_pos")).cast("long"))
    return both.withColumn("keep_bitmap", keep_bitmap(F.col("n_lines"), F.col("_ld_pos"))).drop("_ld_doc", "_ld_tag", "_ld_pos")


@F.pandas_udf(BinaryType())
def keep_bitmap(n_lines: pd.Series, dropped: pd.Series) -> pd.Series:
    out = []
    for n, gone in zip(n_lines, dropped):
        keep = np.ones(int(n), np.uint8)
        if gone is not None:
            keep[np.asarray(gone, np.int64)] = 0
        out.append(zlib.compress(np.packbits(keep).tobytes()))
    return pd.Series(out, dtype=object)


@F.pandas_udf(StringType())
def _kept(text: pd.Series, bitmap: pd.Series) -> pd.Series:
    out = []
    for t, packed in zip(text, bitmap):
        lines = t.split("\n")
        keep = np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8), count=len(lines))
        out.append(t if keep.all() else "\n".join(x for x, k in zip(lines, keep) if k))
    return pd.Series(out, dtype=object)


def kept_text(text: str | Column = "text", bitmap: str | Column = "keep_bitmap") -> Column:
    """The text's lines that its bitmap keeps, joined by a line feed."""
    text = F.col(text) if isinstance(text, str) else text
    return _kept(F.coalesce(text, F.lit("")), F.col(bitmap) if isinstance(bitmap, str) else bitmap)
