import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_support import docs_of  # noqa: F401
from tidemark.llm import line_dedup as op


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})


def brute(rows, min_chars=20, min_docs=3):
    holders = {}
    for i, t in rows:
        if i is not None:
            for line in (t or "").split("\n"):
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = [i is None or len(key(x)) < min_chars or len(holders[key(x)]) < min_docs or max(holders[key(x)]) == i for x in lines]
        out.append((i, len(lines), len(lines) - sum(keep), "\n".join(x for x, k in zip(lines, keep) if k)))
    return out


def result(df):
    got = op.line_dedup(df, 20, 3).withColumn("kept", op.kept_text()).collect()
    return [(r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in got], got


def make(seed, n=60):
    rnd = random.Random(seed)
    pool = [f"line number {k} of the pool {'x' * k}" for k in range(8)] + ["  LINE number 3 of the POOL xxx\t", "short", ""]
    return [(i, "\n".join(rnd.choice(pool) if rnd.random() < 0.6 else f"own line {i} {j} {rnd.random()}" for j in range(rnd.randint(1, 12)))) for i in range(n)]


@pytest.mark.parametrize("seed,parts", [(1, "2"), (2, "8"), (3, "40")])
def test_equals_brute_force(spark, docs_of, seed, parts):
    old = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so that keys cross partitions
    try:
        rows = make(seed)
        assert sorted(result(docs_of(rows))[0]) == sorted(brute(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old[1])


def test_odd_rows(docs_of):
    line = "a line that stands in many documents"
    rows = [(None, line), (1, None), (2, ""), (3, line), (3, line), (4, f"{line}\n{line}\n"), (5, line + "\n" + "y" * 300_000), (6, "\n"), (7, "ÄÄÄÄÄÄÄÄÄÄÄÄÄÄÄÄÄÄÄÄ"), (8, "ääääääääääääääääääää")]
    got, full = result(docs_of(rows))
    assert sorted(got, key=repr) == sorted(brute(rows), key=repr)
    assert {r.component_id for r in full} == {"y"}  # further columns stay
    two = next(r for r in full if r.doc_id == 4)
    assert np.unpackbits(np.frombuffer(zlib.decompress(two.keep_bitmap), np.uint8), count=3).tolist() == [0, 0, 1]


def test_empty_table(docs_of):
    assert result(docs_of([]))[0] == []


def test_one_key_in_all_documents(docs_of):
    rows = [(i, "the very same line in all of them\nown") for i in range(500)]
    got, _ = result(docs_of(rows, 10))
    assert sum(r[2] for r in got) == 499 and next(r for r in got if r[0] == 499)[2] == 0
