"""N-gram Jaccard join by parity sketches (operator 11).

A document is the set of its distinct word shingles. Two documents link if the
Jaccard similarity of their sets reaches ``percent`` / 100. For sets of n and m
elements this means a symmetric difference of at most (n + m) (100 - percent) /
(100 + percent) elements.

Sizes are cut into bands so wide that linked sets lie in one band or in two
neighbouring ones; a set belongs to its own band and, if large enough to link
with sets of the next, also to that. In a band every element flips one bit of a
parity sketch, so the Hamming distance of two sketches is a lower bound of the
symmetric difference. The sketch has one 64-bit part more than the largest
difference allowed in the band: of two linked sets at least one part is equal
(pigeonhole). Parts are joined by equality, and candidates are checked on whole sketches first
and then exactly on their sets.

Equal sets collapse before anything is joined, so copies cost one row each. Sets
that share a part form a group; groups with the same members are settled once.
Pairs are not listed: a first round takes a spanning forest of each group's
close sketches, verifies it and forms components; a second round looks, in groups
whose members still lie in different components, for close sketches across them,
and verifies all of those. Every link thus joins two sets that are one component
in the end. Groups of over ``CELL`` members are dealt to blocks (first round, with the group's smallest member in each) and
to pairs of blocks (second round).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, mix64, utf8, written
from tidemark.llm.components import components

#: Members of a group that meet in one task.
CELL = 1024
#: 64-bit words of a sketch that are compared; longer sketches are folded, which keeps the bound.
FOLDED = 32
#: Up to so many node ids (8 bytes each) are broadcast to where their texts are read; beyond, texts are shuffled.
BROADCAST_ROWS = 2_000_000
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: bytes, shingle_words: int = 3) -> np.ndarray:
    """The distinct shingles' 64-bit hashes, sorted. Fewer words than a shingle: one for all."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width = min(shingle_words, len(words))
    count = len(words) - width + 1
    h = np.full(count, np.uint64(width))
    for k in range(width):
        h = h * _STEP + each[k : k + count]
    return np.unique(mix64(h))


class Bands:
    """Size bands and the number of sketch parts in each."""

    def __init__(self, percent: int, largest: int = 1 << 40):
        self.percent = percent
        low = [1]
        while low[-1] <= largest:
            low.append(max(low[-1] * 4 // 3, low[-1] * 100 // percent) + 1)
        self.low = np.array(low, np.int64)

    def of(self, n: int) -> int:
        return int(np.searchsorted(self.low, n, side="right")) - 1

    def parts(self, band: int) -> int:
        """One part more than the largest difference; 0 where only equal sets link."""
        most = 2 * int(self.low[band + 1] - 1) * (100 - self.percent) // (100 + self.percent)
        return most + 1 if most else 0

    def reaches_next(self, n: int) -> bool:
        return 100 * n >= self.percent * int(self.low[self.of(n) + 1])


def parity_sketch(hashes: np.ndarray, parts: int) -> np.ndarray:
    words = np.zeros(parts, np.uint64)
    np.bitwise_xor.at(words, ((hashes >> np.uint64(6)) % np.uint64(parts)).astype(np.int64), np.uint64(1) << (hashes & np.uint64(63)))
    return words


def folded(words: np.ndarray) -> np.ndarray:
    if len(words) <= FOLDED:
        return words
    padded = np.zeros(-(-len(words) // FOLDED) * FOLDED, np.uint64)
    padded[: len(words)] = words
    return np.bitwise_xor.reduce(padded.reshape(-1, FOLDED), axis=0)


def sketches(docs: DataFrame, percent: int = 90, shingle_words: int = 3) -> DataFrame:
    """Per row of ``docs``: doc_id, key (128 bits of its set), n_shingles, band, and
    the sketches of its own and of the next band (null where it has none), whole and, if long, folded."""
    bands = Bands(percent)
    names = ["doc_id", "key", "n_shingles", "band", "own", "next", "own_fold", "next_fold"]
    longs = pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns: list[list] = [[] for _ in names[1:]]
            size, start = 0, 0

            def out(end):
                arrays = [pa.array(c, t) for c, t in zip(columns, [pa.binary(), pa.int64(), pa.int32(), longs, longs, longs, longs])]
                return pa.RecordBatch.from_arrays([b.column(0).slice(start, end - start), *arrays], names=names)

            for i, text in enumerate(utf8(b.column(1))):
                hashes = shingle_set(text, shingle_words)
                n = len(hashes)
                row = [hashlib.blake2b(hashes.tobytes(), digest_size=16).digest(), n, None, None, None, None, None]
                if n:
                    row[2] = band = bands.of(n)
                    for k, of in enumerate((band, band + 1)):
                        parts = bands.parts(of) if k == 0 or bands.reaches_next(n) else 0
                        if parts:
                            words = parity_sketch(hashes, parts)
                            row[3 + k] = words.view(np.int64)
                            if parts > FOLDED:
                                row[5 + k] = folded(words).view(np.int64)
                            size += 8 * parts
                for c, x in zip(columns, row):
                    c.append(x)
                if size > 1 << 20:
                    yield out(i + 1)
                    columns, size, start = [[] for _ in names[1:]], 0, i + 1
            yield out(b.num_rows)

    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, key binary, n_shingles long, band int, own array<long>, next array<long>, own_fold array<long>, next_fold array<long>")


def shared_parts(nodes: DataFrame) -> DataFrame:
    """(sig, band, node): one group (sig) for every set of two or more nodes that
    share a sketch part, at least one of them in its own band. Of groups with the same members one stays."""
    roles = F.array(F.struct("band", F.col("own").alias("words"), F.lit(1).alias("mine")), F.struct((F.col("band") + 1).alias("band"), F.col("next").alias("words"), F.lit(0).alias("mine")))
    rows = nodes.select("node", F.explode(roles).alias("r")).select("node", "r.band", "r.mine", F.posexplode("r.words").alias("part", "word"))
    rows = rows.select(F.xxhash64("band", "part", "word").alias("sig"), "node", "band", "mine")
    several = rows.groupBy("sig").agg(F.count("*").alias("n"), F.max("mine").alias("mine")).filter("n > 1 and mine = 1").select("sig")
    shared = written(rows.join(several, "sig"), "shared")
    # members as a set: their number, and the sum and exclusive or of their hashes
    groups = shared.groupBy("sig").agg(F.count("*").alias("c"), F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("s"), F.bit_xor(F.xxhash64("node", F.lit(7))).alias("x"))
    groups = written(groups.groupBy("c", "s", "x").agg(F.min("sig").alias("sig")).select("sig", "c"), "groups")
    return shared.join(groups, "sig").select("sig", "c", "node", "band")


def _close(percent: int, across: bool):
    """Pairs of close sketches inside each cell, the rows sorted by cell: a spanning
    forest, or all pairs across components and blocks."""
    num, den = 100 - percent, 100 + percent

    def distances(x: np.ndarray, nx: int, words: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.bitwise_count(words ^ x).sum(axis=1, dtype=np.int64) <= (n + nx) * num // den

    def forest(node, n, words, comp, block):
        left = np.argsort(node)
        queue, u, v = [], [], []
        while len(left):
            if not queue:
                queue, left = [left[0]], left[1:]
            x = queue.pop(0)
            near = distances(words[x], n[x], words[left], n[left])
            found = left[near]
            u += [node[x]] * len(found)
            v += node[found].tolist()
            queue += found.tolist()
            left = left[~near]
        return u, v

    def crossing(node, n, words, comp, block):
        u, v = [], []
        two = block.min() != block.max()
        for x in range(len(node)):
            other = np.flatnonzero((comp != comp[x]) & (node > node[x]) & ((block != block[x]) | (not two)))
            near = other[distances(words[x], n[x], words[other], n[other])] if len(other) else other
            u += [node[x]] * len(near)
            v += node[near].tolist()
        return u, v

    settle = crossing if across else forest

    def out(u, v):
        u, v = np.array(u, np.int64), np.array(v, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # columns: sig, ci, cj, node, n, comp, block, sketch
        held: list[list] = []
        last = None
        u: list[int] = []
        v: list[int] = []

        def flush():
            if len(held) > 1:
                node, n, comp, block = (np.array([r[k] for r in held], np.int64) for k in range(4))
                found = settle(node, n, np.stack([r[4] for r in held]), comp, block)
                u.extend(found[0])
                v.extend(found[1])

        for b in batches:
            if not b.num_rows:
                continue
            plain = [b.column(k).to_numpy(zero_copy_only=False) for k in range(7)]
            offsets = b.column(7).offsets.to_numpy()
            flat = b.column(7).values.to_numpy(zero_copy_only=False).view(np.uint64)
            for i in range(b.num_rows):
                cell = (plain[0][i], plain[1][i], plain[2][i])
                if cell != last:
                    flush()
                    held, last = [], cell
                held.append((plain[3][i], plain[4][i], plain[5][i], plain[6][i], flat[offsets[i] : offsets[i + 1]].copy()))
            if len(u) > 50_000:
                yield out(u, v)
                u, v = [], []
        flush()
        yield out(u, v)

    return run


def _candidates(members: DataFrame, nodes: DataFrame, percent: int, across: bool) -> DataFrame:
    """(u, v), u < v: distinct pairs of nodes with close sketches, by ``_close``.
    ``members`` has sig, c (its members), node, band, comp."""
    sketch = F.when(F.col("m.band") == F.col("s.band"), F.coalesce("s.own_fold", "s.own")).otherwise(F.coalesce("s.next_fold", "s.next"))
    rows = members.alias("m").join(nodes.alias("s"), "node").select("m.sig", "m.c", "node", F.col("s.n_shingles").alias("n"), "m.comp", sketch.alias("sketch"))
    blocks = F.ceil(F.col("c") / F.lit(CELL)).cast("int")
    rows = rows.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    if across:  # each pair of blocks is a cell
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        cells = rows.withColumn("other", other).withColumns({"ci": F.least("block", "other"), "cj": F.greatest("block", "other")})
    else:  # each block with the group's smallest member
        least = members.filter(F.col("c") > CELL).groupBy("sig").agg(F.min("node").alias("first")).withColumnRenamed("sig", "_sig")
        hot = rows.filter("blocks > 1").join(least, F.col("sig") == F.col("_sig")).drop("_sig")
        first = hot.filter("node = first").withColumn("ci", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        hot = hot.filter("node != first").withColumn("ci", F.col("block"))
        cells = rows.filter("blocks = 1").withColumn("ci", F.lit(0)).unionByName(hot.unionByName(first).drop("first"))
        cells = cells.withColumn("cj", F.lit(0))
    key = ["sig", "ci", "cj"]
    cells = cells.select(*key, "node", "n", "comp", F.col("block").cast("long").alias("block"), "sketch").repartition(*key).sortWithinPartitions(*key)
    return cells.mapInArrow(_close(percent, across), "u long, v long").distinct()


def _sets(docs: DataFrame, nodes: DataFrame, shingle_words: int) -> DataFrame:
    """(node, hashes): the sets of ``nodes`` (node, key) from the texts of their documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            node, hashes, size = [], [], 0
            for i, key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), utf8(b.column(2))):
                found = shingle_set(text, shingle_words)
                if hashlib.blake2b(found.tobytes(), digest_size=16).digest() == key:  # not another text of the same doc_id
                    node.append(i)
                    hashes.append(found.view(np.int64))
                    size += len(found)
                if size > 1 << 17:
                    yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(hashes, pa.list_(pa.int64()))], names=["node", "hashes"])
                    node, hashes, size = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(hashes, pa.list_(pa.int64()))], names=["node", "hashes"])

    wanted = nodes.select("node", "key")
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("string").alias("text")).join(wanted, "node").select("node", "key", "text")
    return texts.mapInArrow(run, "node long, hashes array<long>")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose sets reach the similarity."""
    both = pairs.join(sets.select(F.col("node").alias("u"), F.col("hashes").alias("hu")), "u").join(sets.select(F.col("node").alias("v"), F.col("hashes").alias("hv")), "v")
    shared = F.size(F.array_intersect("hu", "hv")).cast("long")
    both = both.select("u", "v", shared.alias("i"), (F.size("hu") + F.size("hv")).cast("long").alias("n"))
    return both.filter(100 * F.col("i") >= percent * (F.col("n") - F.col("i"))).select("u", "v").distinct()


def jaccard_groups(docs: DataFrame, percent: int = 90, shingle_words: int = 3) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text).

    Texts are lower-cased (A-Z) and cut at ASCII white space into the set of their
    distinct shingles of ``shingle_words`` words; fewer words are one shingle. Rows
    link if the Jaccard similarity of their sets is ``percent`` / 100 (50 to 99 %) or more.
    component_id is the smallest doc_id reachable over links, the own one included.
    Null, empty or blank text: no shingles, no links. A null doc_id links nothing
    and has a null component_id. Rows that share a doc_id are one document: what
    either links to is in its component. Repeated rows are equal sets. Texts of any
    length are taken whole. Other columns are ignored; an empty table gives an empty result.
    """
    if not 50 <= percent <= 99:
        raise ValueError("percent must be 50 to 99")
    docs = docs.select("doc_id", "text")
    rows = written(sketches(docs, percent, shingle_words), "sketches")
    there = rows.filter("doc_id is not null and n_shingles > 0")
    classes = written(there.groupBy("key").agg(F.min("doc_id").alias("node"), F.count("*").alias("members")), "classes")
    least = classes.select("key", F.col("node").alias("doc_id"))
    nodes = there.filter("own is not null or next is not null").join(least, ["key", "doc_id"]).dropDuplicates(["key", "doc_id"]).withColumnRenamed("doc_id", "node")
    nodes = written(nodes, "nodes")

    members = written(shared_parts(nodes), "members")
    tree = written(_candidates(members.withColumn("comp", F.lit(0).cast("long")), nodes, percent, across=False), "tree")
    ends = tree.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    sets = written(_sets(docs, nodes.select("node", "key").join(ends, "node"), shingle_words), "sets")
    edges = written(verified(tree, sets, percent), "links")

    # second round: groups that still hold several components
    found = components(edges)
    placed = members.join(found.withColumnRenamed("root", "comp"), "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    split = placed.groupBy("sig").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).filter("a != b").select("sig")
    rest = written(_candidates(placed.join(split, "sig"), nodes, percent, across=True), "rest")
    rest = rest.join(tree, ["u", "v"], "left_anti")
    new = rest.select(F.explode(F.array("u", "v")).alias("node")).distinct().join(sets.select("node").distinct(), "node", "left_anti")
    more = written(_sets(docs, nodes.select("node", "key").join(new, "node"), shingle_words), "sets")
    edges = edges.unionByName(verified(rest, sets.unionByName(more), percent))

    # the texts of one doc_id
    place = rows.filter("doc_id is not null").join(classes.filter("members > 1").select("key", "node"), "key", "left")
    place = place.select("doc_id", F.coalesce("node", "doc_id").alias("node"))
    several = place.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a != b").select("doc_id")
    edges = edges.unionByName(place.join(several, "doc_id").select(F.col("doc_id").alias("u"), F.col("node").alias("v")))

    roots = components(edges)
    # a set of one row without links is its own component and needs no join
    named = classes.join(roots, "node", "left").filter("members > 1 or root is not null").select("key", F.coalesce("root", "node").alias("_root"))
    out = rows.select("doc_id", "key", "n_shingles").join(named, "key", "left")
    # a row without shingles hangs on its doc_id's other rows only
    lone = roots.join(several, F.col("node") == F.col("doc_id")).select(F.col("doc_id").alias("_id"), F.col("root").alias("_own"))
    out = out.join(lone, F.col("doc_id") == F.col("_id"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_own", "_root", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"))
