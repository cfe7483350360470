import hashlib
import random

import numpy as np
import pytest

from llm_support import docs_of  # noqa: F401
from tidemark.llm import fingerprints as op


def shingles(text, n=5):
    w = text.encode().lower().split()
    return {b" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def rows_of(n=80, seed=2):
    rnd = random.Random(seed)
    words = [f"w{k}é" for k in range(50)]
    return [(3 * i, " ".join(rnd.choices(words, k=rnd.choice([0, 1, 4, 30, 120])))) for i in range(n)]


def check(docs_of, rows, parts=4):
    got = op.neighbour_fingerprints(docs_of(rows, parts)).collect()
    placed = sorted(((i, t or "") for i, t in rows if i is not None), key=lambda x: (x[0], x[1].encode()))
    want = []
    for (i, t), (_, n) in zip(placed, placed[1:] + placed[:1]):
        half = len(t) // 2
        changed = t[: len(t) - half] + n[:half]
        want.append((i, len(t), hashlib.sha256(changed.encode()).hexdigest(), round(jaccard(t, changed), 9), round(jaccard(t, n), 9)))
    have = [(r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got if r.doc_id is not None]
    assert sorted(have) == sorted(want)
    return got


@pytest.mark.parametrize("parts", ["1", "7"])
def test_equals_brute_force(spark, docs_of, parts):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = check(docs_of, rows_of())  # texts have fewer shingles than K, so the sketches are exact
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    texts = dict(rows_of())
    by_text = {}
    for r in got:
        by_text.setdefault(texts[r.doc_id], set()).add(r.fingerprint)
    assert all(len(x) == 1 for x in by_text.values())


def test_odd_rows(docs_of):
    rows = [(None, "without a place in the order"), (1, None), (2, ""), (5, "one"), (5, "one"), (5, "two words"), (9, "a " * 100_000)]
    got = check(docs_of, rows)
    lost = next(r for r in got if r.doc_id is None)
    assert lost.near_next is None and lost.n_chars == 28


def test_one_row_and_none(docs_of):
    check(docs_of, [(4, "the only document of them all here")])
    assert op.neighbour_fingerprints(docs_of([])).count() == 0


def test_estimates_and_merging():
    rnd = random.Random(4)
    a = [f"a{rnd.random()}" for _ in range(6000)]
    b = a[:4000] + [f"b{rnd.random()}" for _ in range(2000)]
    ta, tb = " ".join(a), " ".join(b)
    sa, sb = op.sketch(ta.encode()), op.sketch(tb.encode())
    assert abs(op.resemblance(sa, sb) - jaccard(ta, tb)) < 0.12
    assert abs(op.distinct_count(sa) / len(shingles(ta)) - 1) < 0.25
    assert abs(op.containment(sa, sb) - len(shingles(ta) & shingles(tb)) / len(shingles(ta))) < 0.2
    whole = sorted({int(x) for x in np.concatenate([sa, sb])})[: op.K]
    assert op.merge(sa, sb).tolist() == whole
    assert (op.decode(op.encode(sa)) == sa).all() and op.resemblance(op.decode(""), op.decode(None)) == 1.0


def test_parts_merge_by_group(spark):
    rnd = random.Random(6)
    parts = [(k % 3, " ".join(f"x{rnd.randrange(3000)}" for _ in range(400))) for k in range(30)]
    frame = spark.createDataFrame([(g, op.encode(op.sketch(t.encode()))) for g, t in parts], "g int, fingerprint string")
    got = {r.g: op.decode(r.fingerprint).tolist() for r in op.merge_parts(frame, ["g"]).collect()}
    for g in range(3):
        every = np.unique(np.concatenate([op.sketch(t.encode()) for k, t in parts if k == g]))
        assert got[g] == every[: op.K].tolist()
