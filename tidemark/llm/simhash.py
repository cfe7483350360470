"""SimHash near-duplicates (operator 6) by the generalised pigeonhole principle.

Equal fingerprints collapse first, so a group of copies of any size is one row.
The 64 bits are grouped into ``parts`` partitions of correlated bits. For a
fingerprint q, thresholds T_i >= -1 with sum T_i = max_bits - parts + 1 make sure
that any fingerprint within ``max_bits`` of q agrees with q within T_i bits on
some partition i. A dynamic program picks each q's thresholds so that the
estimated number of probes and candidates is least; q then probes every value in
the ball of radius T_i around its own, and candidates are verified on all bits.
Pairs are never emitted wholesale: a bucket gives the edges of a spanning forest.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, released, text_of, utf8, without, written
from tidemark.llm.components import components

SEED = 42
#: Rows of one side of a bucket that meet in one task; larger buckets are dealt to a grid of cells.
CELL = 20_000
#: Fingerprints that the bit groups and the candidate counts are estimated from. They steer speed only.
SAMPLE = 2048


def text_fingerprint(text: bytes, shingle_words: int = 3) -> int:
    """64 bits, a bit 1 if set in over half the shingles' hashes."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle_words:
        return xxhash.xxh64_intdigest(joined, SEED)
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = [0, *(spaces[: len(words) - shingle_words] + 1).tolist()]
    ends = [*spaces[shingle_words - 1 :].tolist(), len(joined)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends)), np.uint64, len(starts))
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 8192):
        ones += np.unpackbits(hashes[i : i + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle_words: int = 3, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp): one row per row of ``docs``; fp is the fingerprint as a signed
    long. The columns of longs that ``carry`` names stay with their rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([text_fingerprint(t, shingle_words) for t in utf8(b.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64)), *b.columns[2:]], names=["doc_id", "fp", *carry])

    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *carry)
    return rows.mapInArrow(released(run), ", ".join(f"{c} long" for c in ("doc_id", "fp", *carry)))


def _bit_groups(sample: np.ndarray, parts: int) -> list[list[int]]:
    """Bits 0 to 63 in ``parts`` groups of like size, correlated bits together."""
    bits = ((sample[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(float)
    bits -= bits.mean(axis=0) if len(sample) else 0
    norm = np.sqrt((bits**2).sum(axis=0))
    alike = np.abs(bits.T @ bits) / np.maximum(np.outer(norm, norm), 1e-9)
    left, groups = list(range(64)), []
    for k in range(parts):
        size = len(left) // (parts - k)
        group = [left.pop(int(np.argmax(alike[np.ix_(left, left)].sum(axis=1))))]
        while len(group) < size:
            group.append(left.pop(int(np.argmax(alike[np.ix_(left, group)].sum(axis=1)))))
        groups.append(sorted(group))
    return groups


def _value(fps: np.ndarray, group: list[int]) -> np.ndarray:
    out = np.zeros(len(fps), np.uint64)
    for to, bit in enumerate(group):
        out |= ((fps >> np.uint64(bit)) & np.uint64(1)) << np.uint64(to)
    return out


def _balls(width: int, most: int) -> list[np.ndarray]:
    """By distance d = 0 to ``most``: the masks of d bits among ``width``."""
    return [np.array([sum(1 << b for b in c) for c in combinations(range(width), d)], np.uint64) for d in range(min(most, width) + 1)]


def _thresholds(values: list[np.ndarray], sample: list[np.ndarray], widths: list[int], total: int, max_bits: int) -> np.ndarray:
    """Thresholds (rows x parts) that add up to max_bits - parts + 1, by dynamic
    programming over the parts on the estimated cost: the probes of a ball plus
    the candidates they meet (sample share, with the share of uniform bits added)."""
    rows, parts = len(values[0]), len(values)
    goal = max_bits - parts + 1
    # states: sum so far + parts (each threshold is -1 at least)
    best = np.full((rows, goal + parts + max_bits + 2), np.inf)
    best[:, 0] = 0
    choice = []
    for v, s, width in zip(values, sample, widths):
        near = np.bitwise_count(v[:, None] ^ s[None, :]) if len(s) else np.zeros((rows, 0), np.uint8)
        cost, ball = [np.zeros(rows)], 0
        for e in range(max_bits + 1):
            ball += int(np.prod([width - k for k in range(e)])) // int(np.prod(range(1, e + 1))) if e <= width else 0
            cost.append(ball + total * ((near <= e).sum(axis=1) / max(1, len(s)) + ball / 2.0**width))
        fresh, picked = np.full_like(best, np.inf), np.zeros(best.shape, np.int8)
        for state in range(best.shape[1]):
            for step, c in enumerate(cost):  # step = threshold + 1
                if step <= state:
                    x = best[:, state - step] + c
                    better = x < fresh[:, state]
                    fresh[better, state], picked[better, state] = x[better], step
        best = fresh
        choice.append(picked)
    out, state = np.zeros((rows, parts), np.int64), np.full(rows, goal + parts)
    for i in range(parts - 1, -1, -1):
        step = choice[i][np.arange(rows), state]
        out[:, i] = step.astype(np.int64) - 1
        state = state - step
    return out


def _signatures(groups: list[list[int]], sample: np.ndarray, total: int, max_bits: int):
    """Rows (bucket, fp, index, probe): the fingerprint's own values, and the values it probes."""
    widths = [len(g) for g in groups]
    balls = [_balls(w, max_bits) for w in widths]
    seen = [_value(sample, g) for g in groups]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            every = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(every), 2000):
                fps = every[at : at + 2000]
                values = [_value(fps, g) for g in groups]
                limits = _thresholds(values, seen, widths, total, max_bits)
                for i, v in enumerate(values):
                    own = limits[:, i] >= 0
                    out = [(v, fps, np.ones(len(v), bool), own)]
                    for d in range(1, int(limits[:, i].max(initial=-1)) + 1):
                        who = limits[:, i] >= d
                        mask = balls[i][d] if d < len(balls[i]) else np.zeros(0, np.uint64)
                        n = int(who.sum()) * len(mask)
                        out.append(((v[who][:, None] ^ mask[None, :]).ravel(), np.repeat(fps[who], len(mask)), np.zeros(n, bool), np.ones(n, bool)))
                    bucket, fp, index, probe = (np.concatenate(x) for x in zip(*out))
                    bucket |= np.uint64(i) << np.uint64(58)
                    yield pa.RecordBatch.from_arrays([pa.array(bucket.view(np.int64)), pa.array(fp.view(np.int64)), pa.array(index), pa.array(probe)], names=["bucket", "fp", "index", "probe"])

    return run


def _spread(nodes: np.ndarray, max_bits: int) -> tuple[list, list]:
    """Edges of a spanning forest of the links among distinct fingerprints,
    breadth first; a node once reached is not compared again."""
    left, u, v = nodes, [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(left ^ x) <= max_bits
            if near.any():
                found = left[near]
                u += [x] * len(found)
                v += list(found)
                queue += list(found)
                left = left[~near]
    return u, v


def _verify(max_bits: int):
    """Links inside each cell of a bucket; the rows come sorted by cell."""
    small = 32

    def out(u, v):
        return pa.RecordBatch.from_arrays([pa.array(np.asarray(x, np.uint64).view(np.int64)) for x in (u, v)], names=["u", "v"])

    def settle(cell, fp, index, probe) -> Iterator[pa.RecordBatch]:
        """Whole cells: small ones all at once, by rows at a distance of 1, 2, ... within a cell."""
        new = np.append(True, (cell[1:] != cell[:-1]).any(axis=1))
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(fp)))
        size = np.repeat(sizes, sizes)
        which = np.repeat(starts, sizes)
        for d in range(1, small):
            rows = np.flatnonzero((size > d) & (size <= small))
            rows = rows[rows + d < len(fp)]
            rows = rows[which[rows] == which[rows + d]]
            if not len(rows):
                break
            x, y = rows, rows + d
            hit = (np.bitwise_count(fp[x] ^ fp[y]) <= max_bits) & (fp[x] != fp[y]) & ((index[x] & probe[y]) | (probe[x] & index[y]))
            if hit.any():
                yield out(fp[x][hit], fp[y][hit])
        for s, n in zip(starts[sizes > small], sizes[sizes > small]):
            part = slice(s, s + n)
            if index[part].any() and probe[part].any():
                u, v = _spread(np.unique(fp[part]), max_bits)
                if u:
                    yield out(u, v)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for b in batches:
            if not b.num_rows:
                continue
            cell = np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(3)], axis=1)
            rest = [b.column(3).to_numpy(zero_copy_only=False).view(np.uint64), *(b.column(i).to_numpy(zero_copy_only=False) for i in (4, 5))]
            cut = len(cell) - int(np.argmin(np.append((cell == cell[-1]).all(axis=1)[::-1], False)))
            if cut == 0 and (not held or (held[-1][0][-1] == cell[0]).all()):
                held.append([cell, *rest])  # one cell so far
                continue
            held.append([x[:cut] for x in (cell, *rest)])
            yield from settle(*(np.concatenate(x) for x in zip(*held)))
            held = [[x[cut:] for x in (cell, *rest)]]
        if held:
            yield from settle(*(np.concatenate(x) for x in zip(*held)))

    return run


def links(distinct: DataFrame, max_bits: int = 3, parts: int = 3) -> DataFrame:
    """(u, v): edges between the distinct fingerprints ``fp`` that connect all
    those within ``max_bits`` bits of each other (a spanning forest per bucket)."""
    parts = max(1, min(parts, max_bits + 1))
    total = distinct.count()
    sample = [r.fp for r in distinct.orderBy(F.xxhash64("fp")).limit(SAMPLE).collect()]
    sample = np.array(sample, np.int64).view(np.uint64)
    rows = distinct.select("fp").mapInArrow(released(_signatures(_bit_groups(sample, parts), sample, total, max_bits)), "bucket long, fp long, index boolean, probe boolean")
    rows = written(rows, "signatures")
    # buckets too large for one task become a grid of cells: a row of the index meets every block of probes
    hot = rows.groupBy("bucket").agg(F.sum(F.col("index").cast("long")).alias("ni"), F.sum(F.col("probe").cast("long")).alias("np"))
    hot = hot.filter(f"ni > {CELL} or np > {CELL}").select("bucket", F.ceil(F.col("ni") / CELL).cast("int").alias("gi"), F.ceil(F.col("np") / CELL).cast("int").alias("gp"))
    both = rows.join(hot, "bucket", "left").withColumns({"gi": F.coalesce("gi", F.lit(1)), "gp": F.coalesce("gp", F.lit(1))})
    plain = both.filter("gi = 1 and gp = 1").select("bucket", F.lit(0).alias("ci"), F.lit(0).alias("cp"), "fp", "index", "probe")
    grid = both.filter("gi > 1 or gp > 1")
    mine = F.pmod(F.xxhash64("fp"), F.lit(1 << 30))
    as_index = grid.filter("index").select("bucket", (mine % F.col("gi")).cast("int").alias("ci"), F.explode(F.sequence(F.lit(0), F.col("gp") - 1)).alias("cp"), "fp", F.lit(True).alias("index"), F.lit(False).alias("probe"))
    as_probe = grid.filter("probe").select("bucket", F.explode(F.sequence(F.lit(0), F.col("gi") - 1)).alias("ci"), (mine % F.col("gp")).cast("int").alias("cp"), "fp", F.lit(False).alias("index"), F.lit(True).alias("probe"))
    cells = plain.unionByName(as_index).unionByName(as_probe)
    key = ["bucket", "ci", "cp"]
    return cells.repartition(*key).sortWithinPartitions(*key).mapInArrow(released(_verify(max_bits)), "u long, v long")


def simhash_groups(docs: DataFrame, shingle_words: int = 3, max_bits: int = 3, parts: int = 3, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp, component_id, and ``carry``) for every row of ``docs`` (doc_id, text).

    Texts are lower-cased (A-Z) and cut at ASCII white space into shingles of
    ``shingle_words`` words. Null, empty or blank text: fingerprint 0, linked like
    any other; fewer words than a shingle: the whole sequence is one. component_id
    is the smallest doc_id reachable over links of ``max_bits`` bits or fewer. A
    null doc_id links nothing and has a null component_id. Rows that share a
    doc_id link their fingerprints' groups only by the fingerprints themselves.
    Empty table: empty result.
    """
    hashes = written(fingerprints(docs, shingle_words, carry), "fingerprints")
    distinct = written(hashes.filter("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "distinct")
    roots = components(links(distinct, max_bits, parts))
    linked = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("n").alias("members"))
    # a document alone in its group is its own component and needs no join
    named = linked.join(least.filter("members > 1"), "root").select(F.col("fp").alias("_fp"), "component_id")
    out = hashes.join(named, F.col("fp") == F.col("_fp"), "left").drop("_fp")
    return out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")))


def near_dedup(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that stay: of each group the document with the
    smallest doc_id (of several texts under that doc_id the one with the least
    hash). Rows that share a doc_id are told apart by their texts: each text belongs
    to its own group. Of repeated rows (doc_id and text) one stays, that with the least
    hash of its other columns. A null text reads as the empty one, and all empty
    texts are one group. Rows without a doc_id stay.
    """
    names = docs.columns
    docs = without(docs, "_h1", "_h2", "_id", "_act")
    text = text_of("text")
    docs = docs.withColumns({"_h1": F.xxhash64(text), "_h2": F.xxhash64(text, F.lit(2))})
    key = ["doc_id", "_h1", "_h2"]
    groups = simhash_groups(docs, carry=("_h1", "_h2"), **how).filter("doc_id is not null").groupBy(*key).agg(F.min("component_id").alias("component_id"), F.count("*").alias("n"))
    groups = written(groups, "groups")
    best = groups.groupBy("component_id").agg(F.min(F.struct(*key)).alias("best"), F.count("*").alias("texts"))
    # only texts that go, or that stand in several rows, need a look
    marked = groups.join(best.filter("texts > 1"), "component_id", "left")
    stays = F.col("best").isNull() | (F.struct(*key) == F.col("best"))
    acts = marked.select(F.col("doc_id").alias("_id"), F.col("_h1").alias("_a"), F.col("_h2").alias("_b"), F.when(~stays, "drop").when(F.col("n") > 1, "thin").alias("_act"))
    rows = docs.join(acts.filter("_act is not null"), (F.col("doc_id").cast("long") == F.col("_id")) & (F.col("_h1") == F.col("_a")) & (F.col("_h2") == F.col("_b")), "left")
    plain = [f.name for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    first = Window.partitionBy("_id", "_h1", "_h2").orderBy(F.xxhash64(*plain))
    thin = rows.filter("_act = 'thin'").withColumn("_act", F.row_number().over(first).cast("string")).filter("_act = '1'")
    return rows.filter("_act is null").unionByName(thin).select(*[n for n in names if n in docs.columns])
