import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from llm_support import docs_of  # noqa: F401
from tidemark.llm import importance_resampling as op

FIELDS = ("doc_id", "n_features", "weight", "score", "rank")


def words_of(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)


def features(text):
    w = words_of(text)
    return [zlib.crc32(" ".join(w[i : i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute(rows, target, percent=5, least=20):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(features(text))
    for text in target:
        t.update(features(text))
    all_s, all_t = sum(s.values()), sum(t.values())
    out = []
    for i, text in rows:
        f = features(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in f)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(f), weight, score, None, len(words_of(text)) >= least])
    opened = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[1]))
    for rank, r in enumerate(opened[: percent * len(opened) // 100], 1):
        r[4] = rank
    return sorted(map(repr, (tuple(r[:5]) for r in out)))


def run(spark, docs_of, rows, target, parts=3, **how):
    frame = spark.createDataFrame([(t, "k") for t in target], "text string, weight string")
    out = op.resample(docs_of(rows, parts), frame, **how)
    assert tuple(out.columns) == FIELDS
    return sorted(repr(tuple(r)) for r in out.collect())


def test_joined_crc_equals_crc_of_the_whole():
    rnd = random.Random(1)
    pairs = [(rnd.randbytes(rnd.randrange(40)), rnd.randbytes(rnd.choice([0, 1, 5, 300, rnd.randrange(9000)]))) for _ in range(400)]
    for part in (pairs[:30], pairs):  # few lengths at once, many one by one
        a, b = (np.array([zlib.crc32(p[k]) for p in part], np.uint32) for k in (0, 1))
        got = op.joined_crc(a, b, np.array([len(p[1]) for p in part]))
        assert got.tolist() == [zlib.crc32(x + y) for x, y in part]


def test_equals_brute_force(spark, docs_of):
    rnd = random.Random(3)
    words = [rnd.choice(["foo", "Bar", "ÄÖ", "x1", "日本", "a", "é"]) + str(k % 9) for k in range(60)]
    rows = [(i, rnd.choice([" ", ", ", "\n"]).join(rnd.choices(words, k=rnd.choice([0, 1, 2, 5, 19, 20, 21, 90])))) for i in range(300)]
    target = [" ".join(rnd.choices(words[:20], k=40)) for _ in range(9)]
    for how in ({}, {"percent": 50}, {"percent": 100}):
        assert run(spark, docs_of, rows, target, 5, **how) == brute(rows, target, **how)


def test_odd_rows(spark, docs_of):
    long = " ".join(f"w{k % 977}" for k in range(400_000))
    many = " ".join("same words again and again for all of the twenty or more words that a drawn text must have at least".split())
    rows = [(1, None), (2, ""), (3, "\x00 ,;\x00"), (4, long), (None, many), (None, many), (7, many), (7, many), (8, "A\x00b"), (9, "a b"), (10, "ab" * 5000)]
    target = [None, "", many, "a b"]
    assert run(spark, docs_of, rows, target, percent=100) == brute(rows, target, percent=100)
    assert run(spark, docs_of, rows, [], percent=60) == brute(rows, [], percent=60)
    assert run(spark, docs_of, [], target) == []


def test_words_do_not_cross_documents(spark, docs_of):
    rows = [(1, "end"), (2, "start"), (3, "end start")]
    got = {r[0]: r[1] for r in map(eval, run(spark, docs_of, rows, ["end start"], 1))}
    assert got == {1: 1, 2: 1, 3: 3}
