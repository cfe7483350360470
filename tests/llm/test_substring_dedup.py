import hashlib
import random

import numpy as np
import pytest

from llm_support import docs_of  # noqa: F401
from tidemark.llm import substring_dedup as op
from tidemark.llm.suffix_array import permuted_prefixes, suffix_array


def brute(rows, match):
    least = {}
    for i, t in rows:
        b = (t or "").encode()
        if i is not None:
            for p in range(len(b) - match + 1):
                s = b[p : p + match]
                least[s] = min(i, least.get(s, i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        if i is not None:
            for p in range(len(b) - match + 1):
                if least[b[p : p + match]] < i:
                    gone[p : p + match] = [True] * match
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((repr(i), len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def run(df, match):
    return sorted((repr(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op.substring_dedup(df, match).collect())


def make(seed, alphabet="ab cdé\n", n=40):
    rnd = random.Random(seed)
    passages = ["".join(rnd.choices(alphabet, k=rnd.randint(20, 160))) for _ in range(6)]
    return [(i, "".join(rnd.choice(passages)[rnd.randint(0, 15) :] if rnd.random() < 0.4 else "".join(rnd.choices(alphabet, k=rnd.randint(0, 60))) for _ in range(rnd.randint(0, 8)))) for i in range(n)]


@pytest.mark.parametrize("seed,match,alphabet", [(1, 50, "ab cdé\n"), (2, 10, "ab"), (3, 25, "abcdefghij "), (4, 2, "abc"), (5, 17, "a")])
def test_equals_brute_force(docs_of, seed, match, alphabet):
    rows = make(seed, alphabet)
    assert run(docs_of(rows), match) == brute(rows, match)


def test_frequent_anchors_travel_as_single_strings(docs_of, monkeypatch):
    monkeypatch.setattr(op, "FREQUENT", 0.0)
    rows = make(9, n=60)
    assert run(docs_of(rows), 20) == brute(rows, 20)


def test_odd_rows(docs_of):
    long = "".join(random.Random(1).choices("abcdefgh ", k=200_000))
    same = "the same passage in several documents, longer than fifty bytes by far"
    rows = [(None, same), (1, None), (2, ""), (3, same), (3, same), (4, same + same), (5, "x" + same[:-1]), (6, long), (7, long[100:]), (8, "\0" * 80), (9, "\0" * 70 + "\x01")]
    assert run(docs_of(rows), 50) == brute(rows, 50)


def test_empty_table(docs_of):
    assert run(docs_of([]), 50) == []


@pytest.mark.parametrize("alphabet,n", [(2, 300), (5, 1000), (1, 50), (250, 400), (3, 1), (3, 2)])
def test_suffix_array(alphabet, n):
    t = np.append(np.random.default_rng(n).integers(1, alphabet + 1, n), 0)
    b = t.tolist()
    assert suffix_array(t).tolist() == sorted(range(len(b)), key=lambda i: b[i:])


def test_permuted_prefixes():
    raw = np.frombuffer(b"abracadabra abracadabra arba", np.uint8)
    sa = suffix_array(np.append(raw.astype(int) + 1, 0))[1:]
    left = len(raw) - np.arange(len(raw))
    got = permuted_prefixes(raw, left, sa, 30)
    b = raw.tobytes()
    for r in range(1, len(sa)):
        x, y = b[sa[r - 1] :], b[sa[r] :]
        assert got[sa[r]] == next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))


def test_names_that_tie_for_long():
    """Only the suffixes that still tie are sorted further; periods tie longest."""
    t = np.array([3, 1, 2] * 60 + [2, 1] * 40 + [1] * 30 + [3, 1, 2] * 60 + [0])
    b = t.tolist()
    assert suffix_array(t).tolist() == sorted(range(len(b)), key=lambda i: b[i:])
    with pytest.raises(ValueError):
        suffix_array(np.array([70_000, 1, 0]))


def test_runs_of_a_batch_at_once():
    rnd = random.Random(4)
    sizes = [rnd.randint(0, 30) for _ in range(40)]
    spans = [(i, p, rnd.randint(1, n - p)) for i, n in enumerate(sizes) for p in (rnd.randrange(n) for _ in range(rnd.randint(0, 4) if n else 0))]
    spans += [(i, 0, n) for i, n in enumerate(sizes[:5]) if n]  # whole texts side by side stay apart
    rnd.shuffle(spans)
    want = []
    for i, n in enumerate(sizes):
        gone = [any(p <= k < p + m for j, p, m in spans if j == i) for k in range(n)]
        begins = [k for k in range(n) if gone[k] and not (k and gone[k - 1])]
        want += [(i, k, next((e for e in range(k, n) if not gone[e]), n)) for k in begins]
    row, start, length = (np.array(x, np.int64) for x in zip(*spans))
    assert [tuple(map(int, x)) for x in zip(*op.removed_runs(np.array(sizes), row, start, length))] == want


def test_equal_pairs_are_neighbours():
    """Also where the first 16 bits of their contents are alike."""
    rng = np.random.default_rng(3)
    a, c = rng.integers(0, 9, 500).astype(np.uint64) << np.uint64(44), rng.integers(0, 5, 500).astype(np.uint64)
    order = op._grouped(a, c)
    pairs = list(zip(a[order].tolist(), c[order].tolist()))
    assert a[order].tolist() == sorted(a.tolist())
    assert sum(x != y for x, y in zip(pairs, pairs[1:])) + 1 == len(set(pairs))
