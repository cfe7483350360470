import random
import re

import numpy as np
import xxhash

from llm_support import docs_of  # noqa: F401
from tidemark.llm import simhash as op
from tidemark.llm.components import components


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(fps, ids, most=3):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= most and ids[i] is not None and ids[j] is not None:
                parent[find(i)] = find(j)
    least = {}
    for i, x in enumerate(ids):
        if x is not None:
            least[find(i)] = min(x, least.get(find(i), x))
    return [least.get(find(i)) if x is not None else None for i, x in enumerate(ids)]


def check(docs_of, rows, **how):
    fps = [fingerprint(t) for _, t in rows]
    expected = sorted((repr(i), f, r) for (i, _), f, r in zip(rows, fps, roots(fps, [i for i, _ in rows])))
    got = sorted((repr(r.doc_id), r.fp % 2**64, r.component_id) for r in op.simhash_groups(docs_of(rows), **how).collect())
    assert got == expected
    return got


def test_equals_brute_force(docs_of):
    rnd = random.Random(5)
    words = [f"w{k}" for k in range(400)]
    rows = []
    for i in range(120):
        if rows and rnd.random() < 0.6:
            text = rnd.choice(rows)[1].split()
            text[rnd.randrange(len(text))] = rnd.choice(words)
        else:
            text = rnd.choices(words, k=rnd.choice([2, 9, 60, 300]))
        rows.append((1000 - i, " ".join(text)))
    got = check(docs_of, rows)
    assert len({r for *_, r in got}) < len(rows)


def test_odd_rows(docs_of):
    rows = [(None, "a b c d"), (3, None), (2, ""), (9, " \n\t"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "x " * 200_000), (8, "a b c d"), (8, "a b c d"), (1, "Ä b c"), (0, "ä b c")]
    check(docs_of, rows)


def test_empty_table(docs_of):
    assert op.simhash_groups(docs_of([])).count() == 0


def test_near_dedup_keeps_one_of_each(docs_of):
    text = " ".join(f"word{k}" for k in range(300))
    rows = [(i, text) for i in range(5, 40)] + [(1, "something else altogether here"), (None, text)]
    kept = op.near_dedup(docs_of(rows))
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect()) == [(False, 1), (False, 5), (True, None)]
    assert kept.columns == docs_of(rows).columns


def test_large_buckets_are_dealt_to_a_grid(spark, monkeypatch):
    monkeypatch.setattr(op, "CELL", 20)
    rnd = np.random.default_rng(3)
    centre = int(rnd.integers(2**62))
    fps = sorted({centre ^ (1 << a) ^ (1 << b) for a, b in rnd.integers(0, 62, (300, 2)).tolist()})
    far = [int(x) for x in rnd.integers(2**62, size=100)]
    frame = spark.createDataFrame([(x,) for x in fps + far], "fp long")
    found = {r.node: r.root for r in components(op.links(frame)).collect()}
    want = roots(fps + far, list(range(len(fps + far))))
    groups = {}
    for x, w in zip(fps + far, want):
        groups.setdefault(w, set()).add(found.get(x, x))
    assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_thresholds_obey_the_pigeonhole():
    rnd = np.random.default_rng(1)
    sample = rnd.integers(0, 2**63, 300, dtype=np.uint64)
    groups = op._bit_groups(sample, 3)
    assert sorted(b for g in groups for b in g) == list(range(64))
    values = [op._value(sample, g) for g in groups]
    limits = op._thresholds(values, values, [len(g) for g in groups], 10_000, 3)
    assert (limits.sum(axis=1) == 3 - 3 + 1).all() and (limits >= -1).all()


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 200 + i) for i in range(30)] + [(7, 7), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, 100: 100, **{200 + i: 100 for i in range(30)}}


def test_near_dedup_tells_texts_of_one_doc_id_apart(docs_of):
    rnd = random.Random(12)
    t, v, w = (" ".join(f"w{rnd.randrange(10**6)}" for _ in range(80)) for _ in range(3))
    rows = [(3, t), (8, t), (8, v), (3, t), (3, t), (9, w), (None, t), (None, t), (1, None), (2, ""), (1, "")]
    got = sorted(repr((r.doc_id, r.text)) for r in op.near_dedup(docs_of(rows)).select("doc_id", "text").collect())
    kept = [(3, t), (8, v), (9, w), (None, t), (None, t)]
    empty = [g for g in got if g in (repr((1, None)), repr((1, "")))]
    assert len(empty) == 1 and sorted(g for g in got if g not in empty) == sorted(map(repr, kept))
    assert op.near_dedup(docs_of(rows)).columns == docs_of(rows).columns
