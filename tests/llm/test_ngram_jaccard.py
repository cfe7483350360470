import random
import re

import numpy as np
import pytest

from llm_support import docs_of  # noqa: F401
from tidemark.llm import ngram_jaccard as op


def shingles(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return frozenset()
    return frozenset(" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def brute(rows, percent=90, k=3):
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None:
                continue
            both = len(sets[i] & sets[j])
            if rows[i][0] == rows[j][0] or (both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both)):
                parent[find(i)] = find(j)
    least = {}
    for i, (x, _) in enumerate(rows):
        if x is not None:
            least[find(i)] = min(x, least.get(find(i), x))
    return sorted(repr((x, len(s), least[find(i)] if x is not None else None)) for i, ((x, _), s) in enumerate(zip(rows, sets)))


def run(frame, **how):
    out = op.jaccard_groups(frame, **how)
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted(repr(tuple(r)) for r in out.collect())


def near_copies(rnd, base, n, edits):
    out = []
    for _ in range(n):
        words = base.split()
        for _ in range(rnd.choice(edits)):
            at = rnd.randrange(len(words) + 1)
            words[at : at + rnd.randrange(3)] = [f"x{rnd.randrange(10**6)}"] * rnd.randrange(2)
        out.append(" ".join(words))
    return out


def some_rows(rnd):
    texts = []
    for size in (1, 2, 3, 8, 11, 12, 14, 20, 31, 45, 60, 150, 400, 1500):
        base = " ".join(f"w{rnd.randrange(3000)}" for _ in range(size))
        texts += [base, *near_copies(rnd, base, 12, [0, 1, 1, 2, 3, max(1, size // 60), max(1, size // 40)])]
    rnd.shuffle(texts)
    ids = rnd.sample(range(1000), len(texts))
    return list(zip(ids, texts))


def test_bands_hold_every_link():
    for percent in (50, 80, 90, 95):
        bands = op.Bands(percent, 1 << 20)
        for n in [*range(1, 300), 1000, 5000, 12345]:
            for m in {n, n + 1, n * 100 // percent, (n * 100 // percent + n) // 2}:
                if m < n or 100 * n < percent * m:
                    continue
                band = bands.of(m)
                most = (n + m) * (100 - percent) // (100 + percent)
                assert bands.parts(band) > most or (most == 0 and bands.parts(band) == 0)
                assert bands.of(n) == band or (bands.of(n) == band - 1 and bands.reaches_next(n))


def test_distance_of_sketches_is_a_lower_bound():
    rnd = np.random.default_rng(1)
    for size in (5, 40, 400, 9000):
        a = rnd.integers(0, 2**64, size, np.uint64)
        b = np.concatenate([a[size // 5 :], rnd.integers(0, 2**64, size // 7 + 1, np.uint64)])
        for parts in (1, 2, 33, 200):
            x, y = op.parity_sketch(a, parts), op.parity_sketch(b, parts)
            differ = len(np.setxor1d(a, b))
            assert np.bitwise_count(op.folded(x) ^ op.folded(y)).sum() <= np.bitwise_count(x ^ y).sum() <= differ


@pytest.mark.parametrize("how", [{}, {"percent": 80}, {"percent": 60, "shingle_words": 2}])
def test_equals_brute_force(docs_of, how):
    rnd = random.Random(6)
    rows = some_rows(rnd)
    expected = brute(rows, how.get("percent", 90), how.get("shingle_words", 3))
    assert run(docs_of(rows, 5), **how) == expected
    assert len({eval(r)[2] for r in expected}) < len(rows)


def test_large_groups_in_small_cells(docs_of, monkeypatch):
    """Groups of near copies far over a cell's size, some of them only linked through others."""
    monkeypatch.setattr(op, "CELL", 16)
    rnd = random.Random(7)
    base = " ".join(f"w{rnd.randrange(3000)}" for _ in range(130))
    texts = near_copies(rnd, base, 150, range(9))
    rows = list(zip(rnd.sample(range(1000), len(texts)), texts))
    assert run(docs_of(rows, 4)) == brute(rows)


def test_texts_read_by_shuffle(docs_of, monkeypatch):
    monkeypatch.setattr(op, "BROADCAST_ROWS", 0)
    rows = some_rows(random.Random(8))
    assert run(docs_of(rows)) == brute(rows)


def test_odd_rows(docs_of):
    rnd = random.Random(9)
    long = " ".join(f"w{rnd.randrange(10**7)}" for _ in range(120_000))
    near = long + " and more"
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(1, None), (2, ""), (3, " \n"), (4, None), (None, text), (None, text + " x"), (50, text), (9, text), (9, text), (9, "other words than these"), (8, text + " x"), (9, ""), (7, "OTHER words than these")]
    rows += [(20, long), (21, near), (22, "x" * 300_000), (23, "x" * 300_000), (24, "a b"), (25, "A b"), (26, "b a"), (27, "same " * 500), (28, "same " * 900), (29, "same same")]
    assert run(docs_of(rows)) == brute(rows)
    assert run(docs_of([])) == []
    assert run(docs_of([(1, None)])) == brute([(1, None)])
    with pytest.raises(ValueError):
        op.jaccard_groups(docs_of([]), percent=100)
