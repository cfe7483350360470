"""Suffix-array dedup (operator 7): repeated byte strings across documents.

Strings of ``match`` bytes that two documents share have the same anchor, the
smallest hash among the k-byte strings inside. Consecutive strings with one anchor
form a segment of up to ``match`` + w - 1 bytes. Per document the anchors and
hashes of its segments go, packed by batch and reduced to one row per segment,
to shards of anchor ranges. There

* a segment equal to one of a smaller document goes as a whole;
* segments that share an anchor but differ, mostly at the edges of edits and of
  passages, are fetched, and each shard of them is sorted by a suffix array
  (induced sorting). Runs of permuted common prefixes of ``match`` bytes or more
  are equal strings; all but those of the smallest document go.

An anchor that a large share of documents have would gather one row for each
different segment of it. Such anchors are found in a sample and their segments
sent as single strings by their own hash instead, which is exact as well.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, mix64, released, shuffle_partitions, slices, text_of, utf8, without, written
from tidemark.llm.suffix_array import permuted_prefixes, suffix_array

MATCH = 50
#: Bytes of text whose segments are packed together.
PACK = 8 << 20
#: Bytes of segments in one suffix array.
SHARD = 1 << 20
#: Documents sampled for frequent anchors, and the share of them that makes an anchor frequent.
SAMPLE, FREQUENT = 2000, 0.02
_POS = np.uint64(28)
_48 = np.uint64((1 << 48) - 1)


def _grams(buf: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of the k bytes at every offset up to len - k."""
    n = len(buf) - k + 1
    padded = np.append(buf, np.zeros(8, np.uint8))
    words = np.ndarray((len(padded) - 7,), "<u8", padded.data, strides=(1,))
    if k < 8:
        return mix64(words[:n] & np.uint64((1 << 8 * k) - 1))
    out = np.zeros(n, np.uint64)
    for i, at in enumerate(sorted({*range(0, k - 7, 8), k - 8})):
        out += words[at : at + n] * np.uint64(0x9E3779B97F4A7C15 + 2 * (i * i + 7 * i))
        out ^= out >> np.uint64(31)
    return mix64(out)


def _window_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive elements."""
    size = 1
    while 2 * size <= w:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (w - size)], x[w - size :]) if w > size else x


def segments(texts: list[bytes], match: int, frequent: np.ndarray) -> tuple[np.ndarray, ...]:
    """(anchor, content, text, start, length) of the segments of some texts, as
    arrays; anchor and content are 48-bit hashes. ``frequent``: sorted anchors
    whose segments are given as single strings."""
    k = max(1, match // 2 - 1)
    w = match - k + 1
    empty = tuple(np.zeros(0, d) for d in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    sizes = np.array([len(t) for t in texts], np.int64)
    buf = np.frombuffer(b"".join(texts), np.uint8)
    if len(buf) < match:
        return empty
    ends = np.cumsum(sizes)
    gram = _grams(buf, k)
    key = (gram >> _POS << _POS) | np.arange(len(gram), dtype=np.uint64)
    anchor = (_window_min(key, w) & np.uint64((1 << 28) - 1)).astype(np.int64)
    # the string at p lies inside a text
    owner = np.repeat(np.arange(len(texts)), sizes)[: len(anchor)]
    inside = np.arange(len(anchor)) + match <= ends[owner]
    new = inside.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~inside[:-1] | (owner[1:] != owner[:-1])
    start = np.flatnonzero(new)
    if not len(start):
        return empty
    stop = np.flatnonzero(inside & np.append(new[1:] | ~inside[1:], True))  # last string of each segment
    a = gram[anchor[start]] & _48
    end = stop + match
    rounds = math.ceil((match + w - 1) / k)
    often = np.isin(a, frequent)
    if often.any():
        counts = (stop - start + 1)[often]
        single = np.repeat(start[often], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        start, end = np.concatenate([start[~often], single]), np.concatenate([end[~often], single + match])
        content = _content(gram, start, end, k, rounds)
        a = np.concatenate([a[~often], mix64(content[len(content) - len(single) :]) & _48])
    else:
        content = _content(gram, start, end, k, rounds)
    who = owner[start]
    return a, content & _48, who, start - (ends - sizes)[who], end - start


def _content(gram: np.ndarray, start: np.ndarray, end: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """A hash of the bytes from start to end, from those of ``rounds`` pieces of k bytes that cover them."""
    out = (end - start).astype(np.uint64)
    for j in range(rounds):
        out = mix64(out * np.uint64(0xD6E8FEB86659FD93) + gram[np.minimum(start + j * k, end - k)])
    return out


def _first_of(*sorted_keys: np.ndarray) -> np.ndarray:
    """Where a new combination of the keys begins."""
    out = np.zeros(len(sorted_keys[0]), bool)
    out[:1] = True
    for x in sorted_keys:
        out[1:] |= x[1:] != x[:-1]
    return out


def _least(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per element the smallest of its group; groups begin at ``first``."""
    if not len(x):
        return x
    return np.repeat(np.minimum.reduceat(x, first), np.diff(np.append(first, len(x))))


def _grouped(a: np.ndarray, c: np.ndarray) -> np.ndarray:
    """An order by ``a`` in which equal (a, c) are neighbours; both are of 48 bits."""
    key = (a << np.uint64(16)) | (c >> np.uint64(32))
    order = np.argsort(key)
    key, rest = key[order], c[order]
    same = key[1:] == key[:-1]
    mixed = np.flatnonzero(same & (rest[1:] != rest[:-1]))
    if len(mixed):  # few: keys that the 16 bits do not tell apart
        run = np.append(0, np.cumsum(~same))
        touched = np.zeros(run[-1] + 1, bool)
        touched[run[mixed]] = True
        at = np.flatnonzero(touched[run])
        order[at] = order[at][np.lexsort((rest[at], key[at]))]
    return order


_PACKED = "shard int, docs binary, tags binary, anchor binary, content binary, row binary, start binary, length binary"


def _planes(x: np.ndarray, n: int) -> bytes:
    """The n low bytes of each number, all lowest bytes first: sorted numbers compress well so."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n].T).tobytes()


def _unplanes(data: bytes, n: int) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(n, -1)
    out = np.zeros((raw.shape[1], 8), np.uint8)
    out[:, :n] = raw.T
    return out.view("<u8").ravel()


def _pack(match: int, shards: int, frequent: np.ndarray):
    """Per batch and shard one row with the batch's segments in it. Of equal
    segments only those of the smallest document go to be compared; the others
    are sent as settled, in rows of shard -1."""

    def rows(docs, tags, shard, a, c, who, start, length):
        return {"shard": shard, "docs": docs, "tags": tags, "anchor": _planes(a, 6), "content": _planes(c, 6), "row": _planes(who, 3), "start": _planes(start, 4), "length": length.astype("<u4").tobytes()}

    def gathered(batches: Iterator[pa.RecordBatch]):
        """The rows of some batches together, some MB of text at a time."""
        ids, marks, texts, size = [], [], [], 0
        for b in batches:
            every = utf8(b.column(2))
            for lo, hi in slices(every, PACK):
                ids.append(b.column(0).slice(lo, hi - lo).to_numpy(zero_copy_only=False))
                marks.append(b.column(1).slice(lo, hi - lo).to_numpy(zero_copy_only=False))
                texts += every[lo:hi]
                size += sum(map(len, every[lo:hi]))
                if size >= PACK:
                    yield np.concatenate(ids), np.concatenate(marks), texts
                    ids, marks, texts, size = [], [], [], 0
        if texts:
            yield np.concatenate(ids), np.concatenate(marks), texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for docs, tags, every in gathered(batches):
            found = []
            for i, j in slices(every):
                a, c, who, start, length = segments(every[i:j], match, frequent)
                found.append((a, c, who + i, start, length))
            a, c, who, start, length = (np.concatenate(x) for x in zip(*found))
            order = _grouped(a, c)
            a, c, who, start, length = a[order], c[order], who[order], start[order], length[order]
            later = docs[who] > _least(docs[who], np.flatnonzero(_first_of(a, c)))
            out = []
            d, g = docs.astype("<i8").tobytes(), tags.astype("<i8").tobytes()
            if later.any():
                out.append(rows(d, g, -1, a[later][:0], c[later][:0], who[later], start[later], length[later]))
            a, c, who, start, length = (x[~later] for x in (a, c, who, start, length))
            cut = np.searchsorted(a, np.arange(shards + 1, dtype=np.float64) * (2.0**48 / shards))
            for s in range(shards):
                x = slice(cut[s], cut[s + 1])
                if cut[s] < cut[s + 1]:
                    used, place = np.unique(who[x], return_inverse=True)
                    out.append(rows(docs[used].astype("<i8").tobytes(), tags[used].astype("<i8").tobytes(), s, a[x], c[x], place, start[x], length[x]))
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=_packed)

    return run


_packed = pa.schema([("shard", pa.int32()), *[(n, pa.binary()) for n in ("docs", "tags", "anchor", "content", "row", "start", "length")]])
_SETTLED = "kind byte, anchor long, doc long, tag long, start int, length int"


def _settled(kind, anchor, doc, tag, start, length):
    n = len(doc)
    cols = [np.full(n, kind, np.int8), np.asarray(anchor).astype(np.int64), doc, tag, np.asarray(start).astype(np.int32), np.asarray(length).astype(np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in cols], names=["kind", "anchor", "doc", "tag", "start", "length"])


GONE, VARIANT = 0, 1


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard: which segments go, and which are to be compared by their bytes."""

    def unpack(r):
        docs, tags = np.frombuffer(r["docs"], "<i8"), np.frombuffer(r["tags"], "<i8")
        who = _unplanes(r["row"], 3).astype(np.int64)
        a, c = (_unplanes(r[x], 6) if r[x] else np.zeros(len(who), np.uint64) for x in ("anchor", "content"))
        return a, c, docs[who], tags[who], _unplanes(r["start"], 4).astype(np.int64), np.frombuffer(r["length"], "<u4").astype(np.int64)

    def settle(held) -> Iterator[pa.RecordBatch]:
        a, c, doc, tag, start, length = (np.concatenate(x) for x in zip(*held))
        order = _grouped(a, c)
        a, c, doc, tag, start, length = (x[order] for x in (a, c, doc, tag, start, length))
        gone = doc > _least(doc, np.flatnonzero(_first_of(a, c)))
        yield _settled(GONE, a[gone] * 0, doc[gone], tag[gone], start[gone], length[gone])
        heads = np.flatnonzero(_first_of(a))
        size = np.diff(np.append(heads, len(a)))
        kinds = np.add.reduceat(_first_of(a, c).astype(np.int64), heads)
        docs_differ = np.minimum.reduceat(doc, heads) != np.maximum.reduceat(doc, heads)
        open_ = np.repeat((kinds > 1) & docs_differ, size) & ~gone
        yield _settled(VARIANT, a[open_], doc[open_], tag[open_], start[open_], length[open_])

    held, shard = [], None
    for b in batches:
        for r in b.to_pylist():
            if r["shard"] < 0:
                a, _, doc, tag, start, length = unpack(r)
                yield _settled(GONE, a, doc, tag, start, length)
                continue
            if held and r["shard"] != shard:
                yield from settle(held)
                held = []
            shard = r["shard"]
            held.append(unpack(r))
    if held:
        yield from settle(held)


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each document's variants."""
    for b in batches:
        for lo in range(0, b.num_rows, 500):
            part = b.slice(lo, 500)
            out: list[tuple] = []
            for doc, tag, text, wanted in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), utf8(part.column(2)), part.column(3).to_pylist()):
                out += [(w["anchor"], doc, tag, w["start"], text[w["start"] : w["start"] + w["length"]]) for w in wanted]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(kinds)], names=["anchor", "doc", "tag", "start", "bytes"])


def repeated(texts: list[bytes], owner: np.ndarray, match: int) -> Iterator[tuple[int, int, int]]:
    """(text, start, length) of the maximal runs of strings of ``match`` bytes
    that a text of a smaller owner has too, from one suffix array of all texts."""
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes + 1)
    raw = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    coded = np.append(raw.astype(np.int16) + 2, 0).astype(np.int16)
    coded[ends - 1] = 1  # between texts, smaller than any byte
    sa = suffix_array(coded)[1:]  # without the final 0
    which = np.repeat(np.arange(len(texts)), sizes + 1)
    left = ends[which] - 1 - np.arange(len(raw))
    plcp = permuted_prefixes(raw, left, sa, match)
    group = np.flatnonzero(np.append(True, plcp[sa[1:]] < match))
    own = owner[which[sa]]
    least = np.repeat(np.minimum.reduceat(own, group), np.diff(np.append(group, len(sa))))
    gone = np.zeros(len(raw), bool)
    gone[sa] = (own > least) & (left[sa] >= match)
    at = np.flatnonzero(gone)
    begins = np.flatnonzero(np.append(True, (at[1:] != at[:-1] + 1) | (which[at[1:]] != which[at[:-1]]))) if len(at) else at
    for i, j in zip(begins, np.append(begins[1:], len(at))):
        t = int(which[at[i]])
        yield t, int(at[i] - (ends[t] - 1 - sizes[t])), int(j - i) + match - 1


def _sorted_shards(match: int):
    def settle(held) -> pa.RecordBatch:
        docs, tags, starts, texts = zip(*held)
        found = list(repeated(list(texts), np.array(docs, np.int64), match))
        doc, tag = (np.array([x[t] for t, _, _ in found], np.int64) for x in (docs, tags))
        return _settled(GONE, np.zeros(len(found)), doc, tag, [starts[t] + s for t, s, _ in found], [n for *_, n in found])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, shard = [], None
        for b in batches:
            for s, *row in zip(*(c.to_pylist() for c in b.columns)):
                if held and s != shard:
                    yield settle(held)
                    held = []
                shard = s
                held.append(row)
        if held:
            yield settle(held)

    return run


def repeated_spans(docs: DataFrame, match: int = MATCH) -> DataFrame:
    """(doc, tag, start, length): byte spans that go, which may overlap."""
    spark = docs.sparkSession
    bounded_batches(spark)
    text = text_of("text")
    rows = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64(text).alias("tag"), text.alias("text"))
    # the sample only decides how an anchor's segments travel
    sampled = rows.filter(F.pmod(F.xxhash64("doc"), F.lit(max(1, rows.count() // SAMPLE))) == 0).mapInArrow(_anchors(match), "anchor long, n int")
    often = sampled.groupBy("anchor").agg(F.sum("n").alias("n")).filter(F.col("n") >= max(8, FREQUENT * SAMPLE)).orderBy(F.desc("n")).limit(100_000)
    frequent = np.array(sorted(r.anchor for r in often.collect()), np.uint64)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(shuffle_partitions(spark), math.ceil(size / (8 << 20)))
    packed = rows.mapInArrow(released(_pack(match, shards, frequent)), _PACKED)
    key = F.when(F.col("shard") < 0, F.pmod(F.xxhash64("start"), F.lit(shards))).otherwise(F.col("shard"))
    packed = packed.repartition(shards, key).sortWithinPartitions("shard")
    first = written(packed.mapInArrow(released(_compare), _SETTLED), "segments")
    variants = first.filter(F.col("kind") == VARIANT)
    total = variants.agg(F.sum("length")).first()[0] or 0
    n = max(1, math.ceil(total / SHARD))
    wanted = variants.groupBy(F.col("doc").alias("_doc"), F.col("tag").alias("_tag")).agg(F.collect_list(F.struct("anchor", "start", "length")).alias("wanted"))
    fetched = rows.join(wanted, (F.col("doc") == F.col("_doc")) & (F.col("tag") == F.col("_tag"))).select("doc", "tag", "text", "wanted")
    fetched = fetched.mapInArrow(_fetch, "anchor long, doc long, tag long, start int, bytes binary")
    dealt = fetched.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(n)).cast("int")).repartition(n, "shard").sortWithinPartitions("shard")
    second = dealt.select("shard", "doc", "tag", "start", "bytes").mapInArrow(released(_sorted_shards(match)), _SETTLED)
    return first.filter(F.col("kind") == GONE).unionByName(second).select("doc", "tag", "start", "length")


def _anchors(match: int):
    """How many texts of a batch have each anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.uint64)
        for b in batches:
            texts = utf8(b.column(2))
            found = []
            for i, j in slices(texts):
                a, _, who, _, _ = segments(texts[i:j], match, none)
                order = np.lexsort((who, a))
                a, who = a[order], who[order]
                found.append(a[_first_of(a, who)])
            anchors, n = np.unique(np.concatenate(found) if found else none, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(anchors.astype(np.int64)), pa.array(n.astype(np.int32))], names=["anchor", "n"])

    return run


_KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def removed_runs(sizes: np.ndarray, row: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, begin, end) of the maximal runs that spans cover in texts of these sizes, in order."""
    base = np.cumsum(sizes + 1) - sizes - 1  # a place between texts, so that no run crosses it
    at = base[row] + start
    order = np.argsort(at)
    at, reach = at[order], np.maximum.accumulate((at + length)[order])
    new = np.flatnonzero(np.append(True, at[1:] > reach[:-1])) if len(at) else at
    row = row[order][new]
    return row, at[new] - base[row], reach[np.append(new[1:], len(at)) - 1] - base[row] if len(at) else at


def _apply(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = utf8(b.column(1))
            sizes = np.array([len(t) for t in texts], np.int64)
            spans = b.column(2).flatten()
            start, length = (spans.field(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in ("start", "length"))
            row, begin, end = removed_runs(sizes, pc.list_parent_indices(b.column(2)).to_numpy(zero_copy_only=False), start, length)
            first = np.searchsorted(row, np.arange(len(texts) + 1))
            removed = np.diff(np.append(0, np.cumsum(end - begin))[first])
            cuts, begin, end = first.tolist(), begin.tolist(), end.tolist()
            kept = []
            for text, i, j in zip(texts, cuts, cuts[1:]):
                kept.append(b"".join([text[p:q] for p, q in zip([0, *end[i:j]], [*begin[i:j], len(text)])]) if i < j else text)
            digests = [hashlib.sha256(x).hexdigest() for x in kept]
            cols = [b.column(0), sizes, removed, np.diff(first), digests, pa.array(kept if with_text else [None] * len(kept), pa.binary())]
            yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in cols], names=[x.split()[0] for x in _KEPT.split(", ")])

    return run


def substring_dedup(docs: DataFrame, match: int = MATCH, with_text: bool = True) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans
    (maximal removed runs), kept_sha256 and, if asked for, the kept bytes.

    A byte goes if a string of ``match`` bytes that covers it also starts in a
    document with a smaller doc_id. Strings do not cross documents and are judged
    on the input. Null text: empty. A null doc_id is compared with nothing and
    keeps all its bytes. Rows that share a doc_id are one document and take
    nothing from each other. Empty table: empty result.
    """
    if match < 2:
        raise ValueError("match must be 2 bytes or more")
    docs = without(docs, "_doc", "_tag", "_spans")
    spans = repeated_spans(docs, match)
    spans = spans.groupBy(F.col("doc").alias("_doc"), F.col("tag").alias("_tag")).agg(F.collect_list(F.struct("start", "length")).alias("_spans"))
    text = text_of("text")
    both = docs.join(spans, (F.col("doc_id").cast("long") == F.col("_doc")) & (F.xxhash64(text) == F.col("_tag")), "left")
    out = both.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), "_spans").mapInArrow(_apply(with_text), _KEPT)
    return out if with_text else out.drop("kept")
