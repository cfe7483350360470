"""Benchmark decontamination (operator 3).

Every window of PASSAGE bytes of a benchmark item, at any start, is looked for. By
the q-gram lemma a region of a document within k edits of a window of m bytes shares
at least m + 1 - q (k + 1) of its q-grams, on diagonals at most k apart. Shared
q-grams of whole items are counted in overlapping diagonal bands; windows that reach
the bound in a band are verified by a banded alignment around them, unless they are
there unchanged. The benchmark is the stated query set: it is taken in blocks
of bounded size, each of which goes once over all documents, without a shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, released, slices, text_of, utf8, without

Q = 12
PASSAGE = 80
EDITS = 0.06
#: UTF-8 bytes of benchmark text in one block.
BLOCK = 1 << 20
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_BITS = 22
_GAP = 255  # a byte that UTF-8 never has
_SCHEMA = "doc_id long, item_id long, passages int, start int, end int, edits int"


def normalised(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A-Z lower-cased, runs of ASCII white space as one space; and the offset
    of each byte in the text."""
    raw = np.frombuffer(text.lower(), np.uint8)
    white = (raw == 32) | ((raw >= 9) & (raw <= 13))
    keep = ~white
    keep[1:] |= white[1:] & ~white[:-1]
    at = np.flatnonzero(keep)
    return np.where(white, np.uint8(32), raw)[at], at


def codes(buf: np.ndarray) -> np.ndarray:
    """A hash of the Q bytes at every offset but the last Q - 1."""
    if len(buf) < Q:
        return np.zeros(0, np.uint64)
    data = np.ascontiguousarray(buf)
    eight = np.ndarray((len(data) - 7,), "<u8", data.data, strides=(1,))
    n = len(data) - Q + 1
    return eight[:n] * _A + (eight[4 : 4 + n] ^ (eight[4 : 4 + n] >> np.uint64(29))) * _B


def budget(m: int, edits: float = EDITS) -> int:
    """Edits allowed in m bytes: the share, as far as the lemma's bound stays positive."""
    return min(int(edits * m), m // Q - 1)


@dataclass
class Index:
    """A block's items and where their q-grams occur, sorted by code."""

    items: np.ndarray  # item id of each text
    texts: list[np.ndarray]
    passage: int  # bytes of the windows looked for; shorter texts are one window
    keys: np.ndarray  # distinct codes
    first: np.ndarray  # per code, its range in the two below
    owner: np.ndarray
    offset: np.ndarray

    def table(self) -> np.ndarray:
        out = np.zeros(1 << _BITS, bool)
        out[(self.keys * _B) >> np.uint64(64 - _BITS)] = True
        return out


def build(items: list[tuple[int, str]], passage: int = PASSAGE) -> Index:
    """The index of (item_id, text). An item of fewer than Q bytes after
    normalisation is no evidence and matches nothing."""
    owners, texts = [], []
    for item, text in items:
        buf, _ = normalised((text or "").strip().encode())
        if item is not None and len(buf) >= Q:
            owners.append(item)
            texts.append(buf)
    each = [codes(t) for t in texts]
    code = np.concatenate(each) if each else np.zeros(0, np.uint64)
    who = np.repeat(np.arange(len(each)), [len(x) for x in each])
    at = np.concatenate([np.arange(len(x)) for x in each]) if each else np.zeros(0, np.int64)
    order = np.argsort(code, kind="stable")
    keys, first = np.unique(code[order], return_index=True)
    return Index(np.array(owners, np.int64), texts, passage, keys, np.append(first, len(code)), who[order].astype(np.int32), at[order].astype(np.int32))


def aligned(passages: np.ndarray, buf: np.ndarray, base: np.ndarray, k: int) -> np.ndarray:
    """Least edits of each passage (rows of equal length) to a part of ``buf``,
    over alignments whose diagonals lie from base - k to base + 3 k."""
    n, m = passages.shape
    width = 4 * k + 1
    shift = np.arange(width)
    cost = np.zeros((n, width), np.int32)
    for i in range(1, m + 1):
        at = base[:, None] - k + shift[None, :] + i - 1
        inside = (at >= 0) & (at < len(buf))
        same = inside & (buf[np.clip(at, 0, len(buf) - 1)] == passages[:, i - 1 : i])
        step = cost + ~same
        step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)
        cost = np.minimum.accumulate(step - shift, axis=1) + shift
    return cost.min(axis=1)


def _windows(text: np.ndarray, m: int, need: int, offset: np.ndarray) -> np.ndarray:
    """Starts of the windows of m bytes of ``text`` that hold ``need`` different q-grams of those at ``offset``."""
    low, high = max(0, int(offset.min()) - m + Q), min(len(text) - m, int(offset.max()))
    hit = np.zeros(high + m - Q + 2 - low, np.int32)
    hit[offset[(offset >= low) & (offset <= high + m - Q)] - low + 1] = 1
    total = np.cumsum(hit)
    return low + np.flatnonzero(total[m - Q + 1 :] - total[: high + 1 - low] >= need)


#: Places of q-grams in the benchmark that are listed at once.
PLACES = 2_000_000


def regions(buf: np.ndarray, index: Index, table: np.ndarray, edits: float) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, first byte, end, edits, window) of the regions of ``buf`` within
    budget of a window of a text, which starts at byte ``window`` of it."""
    code = codes(buf)
    at = np.flatnonzero(table[(code * _B) >> np.uint64(64 - _BITS)])
    place = np.minimum(np.searchsorted(index.keys, code[at]), len(index.keys) - 1)
    true = index.keys[place] == code[at]
    at, place = at[true], place[true]
    sizes = index.first[place + 1] - index.first[place]
    if not len(at):
        return
    total = np.cumsum(sizes)
    lengths = np.array([min(len(t), index.passage) for t in index.texts])
    limits = np.array([budget(int(m), edits) for m in lengths])
    # a frame of dashes shares each q-gram with each place of another: such texts go in
    # halves, which overlap by more than a region, so the places listed at once stay few
    reach = 2 * int(lengths.max() + limits.max()) + Q
    if total[-1] > PLACES and len(buf) > 4 * reach:
        middle = len(buf) // 2
        yield from regions(buf[: middle + reach], index, table, edits)
        for who, low, high, cost, window in regions(buf[middle:], index, table, edits):
            yield who, low + middle, high + middle, cost, window
        return
    needs = lengths + 1 - Q * (limits + 1)
    base = max(len(t) for t in index.texts)
    rows = np.repeat(np.arange(len(at)), sizes)
    which = np.arange(total[-1]) - np.repeat(total - sizes, sizes) + np.repeat(index.first[place], sizes)
    owner, offset, where = index.owner[which].astype(np.int64), index.offset[which].astype(np.int64), at[rows]
    diagonal = where - offset + base  # not negative
    k = limits[owner]
    band = diagonal // (k + 1)
    again = (diagonal % (k + 1) <= k - 1) & (band > 0)  # also in the band before
    key = np.concatenate([owner << 34 | band, owner[again] << 34 | (band[again] - 1)])
    spot, offset = np.concatenate([where, where[again]]), np.concatenate([offset, offset[again]])
    order = np.argsort(key, kind="stable")
    key, spot, offset = key[order], spot[order], offset[order]
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    counts = np.diff(np.append(starts, len(key)))
    enough = counts >= needs[key[starts] >> 34]
    open_: dict[int, list[tuple]] = {}
    for begin, n in zip(starts[enough].tolist(), counts[enough].tolist()):
        who, band = int(key[begin]) >> 34, int(key[begin]) & ((1 << 34) - 1)
        text, m = index.texts[who], int(lengths[who])
        mine, spots = offset[begin : begin + n], spot[begin : begin + n]
        left = _windows(text, m, int(needs[who]), mine)
        for d in np.unique(spots - mine).tolist():  # windows that are there unchanged need no alignment
            inside = left[(left + d >= 0) & (left + d + m <= len(buf))]
            if not len(inside):
                continue
            low, high = int(inside[0]), int(inside[-1]) + m
            same = np.concatenate([[0], np.cumsum(buf[low + d : high + d] == text[low:high])])
            whole = inside[same[inside - low + m] - same[inside - low] == m]
            for s in whole.tolist():
                yield who, s + d, s + d + m, 0, s
            left = np.setdiff1d(left, whole, assume_unique=True)
        order = np.argsort(mine, kind="stable")
        mine, spots = mine[order], spots[order]
        for s, i, j in zip(left.tolist(), np.searchsorted(mine, left).tolist(), np.searchsorted(mine, left + m - Q, side="right").tolist()):
            open_.setdefault(m, []).append((who, s, band * (int(limits[who]) + 1) - base + s, int(spots[i:j].min()), int(spots[i:j].max()) + Q))
        if len(open_.get(m, ())) >= 4096:
            yield from _verified(open_.pop(m), m, index, buf, edits)
    for m, some in open_.items():
        yield from _verified(some, m, index, buf, edits)


def _verified(some: list[tuple], m: int, index: Index, buf: np.ndarray, edits: float) -> Iterator[tuple[int, int, int, int, int]]:
    """The windows (text, start, place of its first byte, first hit, end of the last) that align within budget."""
    k = budget(m, edits)
    for i in range(0, len(some), 4096):
        part = some[i : i + 4096]
        cost = aligned(np.stack([index.texts[who][s : s + m] for who, s, *_ in part]), buf, np.array([x[2] for x in part]), k)
        for j in np.flatnonzero(cost <= k).tolist():
            yield part[j][0], part[j][3], part[j][4], int(cost[j]), part[j][1]


def _scan(index: Index, edits: float):
    def found(ids, texts) -> Iterator[tuple]:
        table = index.table()
        for a, b in slices(texts, 1 << 19):
            made = [normalised(t) for t in texts[a:b]]
            gap = np.full(Q, _GAP, np.uint8)
            buf = np.concatenate([x for m, _ in made for x in (m, gap)])
            begins = np.cumsum([0] + [len(m) + Q for m, _ in made])
            hits: dict[tuple[int, int], list] = {}
            for p, low, high, cost, window in regions(buf, index, table, edits):
                d = int(np.searchsorted(begins, low, side="right")) - 1
                raw = made[d][1]
                start, end = int(raw[low - begins[d]]), int(raw[min(high - begins[d], len(raw)) - 1]) + 1
                held = hits.setdefault((d, int(index.items[p])), [set(), start, end, cost])
                held[0].add((p, window))
                held[1:] = min(held[1], start), max(held[2], end), min(held[3], cost)
            for (d, item), (windows, start, end, cost) in hits.items():
                yield ids[a + d], item, len(windows), start, end, cost

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = list(found(b.column(0).to_pylist(), utf8(b.column(1))))
            kinds = (pa.int64(), pa.int64(), *[pa.int32()] * 4)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["doc_id", "item_id", "passages", "start", "end", "edits"])

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text) and item of ``benchmark``
    (item_id, text) found in it: doc_id, item_id, passages (of the item that were
    found, each start counted), start and end (UTF-8 offsets of what they span), edits (the least).

    A passage (any PASSAGE bytes in a row after lower-casing A-Z and joining white
    space; shorter items are one passage) is found where a region is within its budget of
    edits. Null or empty texts and items, null item ids and items of under Q bytes
    match nothing; a null doc_id stays null in the result. Repeated rows are found
    each; repeated items once. Empty tables: empty result.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_of("text").alias("text")).filter("item_id is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / block))
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = []
    for i in range(n):
        mine = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i).collect()
        index = build([(r.item_id, r.text) for r in mine])
        if len(index.items):
            parts.append(rows.mapInArrow(released(_scan(index, edits)), _SCHEMA))
    return reduce(DataFrame.unionByName, parts) if parts else rows.limit(0).mapInArrow(_empty, _SCHEMA)


def _empty(batches):
    yield from ()


def decontaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` in which no item is found. Rows without a doc_id are
    judged by their text like any other."""
    docs = without(docs, "_row", "_leak")
    keyed = docs.withColumn("_row", F.xxhash64(F.col("doc_id"), text_of("text")))
    bad = leaks(keyed.select(F.col("_row").alias("doc_id"), "text"), benchmark, **how).select(F.col("doc_id").alias("_leak")).distinct()
    return keyed.join(bad, F.col("_row") == F.col("_leak"), "left_anti").drop("_row")
