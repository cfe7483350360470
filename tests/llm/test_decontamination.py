import random

import numpy as np

from llm_support import docs_of  # noqa: F401
from tidemark.llm import decontamination as op

ITEM = "Which of the following rivers, taken from source to mouth, crosses the largest number of present-day national borders in Europe?"


def filler(rnd, n):
    return " ".join("".join(rnd.choices("abcdefghijklmnop", k=rnd.randint(2, 9))) for _ in range(n))


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def found(df, items):
    return {(r.doc_id, r.item_id) for r in op.leaks(df, items).collect()}


def edit(rnd, text, n):
    chars = list(text)
    for _ in range(n):
        i = rnd.randrange(len(chars))
        kind = rnd.randrange(3)
        if kind == 0:
            chars[i] = "#"
        elif kind == 1:
            del chars[i]
        else:
            chars.insert(i, "#")
    return "".join(chars)


def test_whole_edited_and_clean(spark, docs_of):
    rnd = random.Random(1)
    items = [(k, filler(rnd, 40)) for k in range(30)] + [(99, ITEM)]
    rows = [(i, filler(rnd, 300)) for i in range(40)]
    rows += [(100, f"{filler(rnd, 50)} {ITEM.upper()} {filler(rnd, 50)}"), (101, ITEM.replace(" ", " \n\t")), (102, filler(rnd, 9) + edit(rnd, ITEM, 2) + filler(rnd, 9)), (103, "x" * 150_000 + ITEM), (104, edit(rnd, ITEM, 70))]
    assert found(docs_of(rows), bench(spark, items)) == {(100, 99), (101, 99), (102, 99), (103, 99)}


def test_spans_point_at_the_passage(spark, docs_of):
    before = "äöü some words before "
    r = op.leaks(docs_of([(1, before + ITEM + " and after")]), bench(spark, [(5, ITEM)])).first()
    n = len(before.encode())
    assert abs(r.start - n) <= 2 and abs(r.end - (n + len(ITEM))) <= 2 and r.edits == 0


def test_odd_rows(spark, docs_of):
    rows = [(None, ITEM), (1, None), (2, ""), (3, ITEM), (3, ITEM), (4, "tiny"), (5, "a short item of words")]
    items = [(1, ITEM), (1, ITEM), (2, None), (3, ""), (4, "tiny"), (None, ITEM), (6, "A short  item of words")]
    got = sorted((repr(r.doc_id), r.item_id) for r in op.leaks(docs_of(rows), bench(spark, items)).collect())
    assert got == [("3", 1), ("3", 1), ("5", 6), ("None", 1)]
    assert sorted(repr(r.doc_id) for r in op.decontaminated(docs_of(rows), bench(spark, items)).collect()) == ["1", "2", "4"]


def test_empty_tables(spark, docs_of):
    assert op.leaks(docs_of([]), bench(spark, [(1, ITEM)])).count() == 0
    assert op.leaks(docs_of([(1, ITEM)]), bench(spark, [])).count() == 0


def test_blocks_give_the_same(spark, docs_of):
    rnd = random.Random(3)
    items = [(k, filler(rnd, 30)) for k in range(40)]
    rows = [(k, filler(rnd, 20) + " " + items[k][1] + " " + filler(rnd, 20)) for k in range(0, 40, 3)]
    one = found(docs_of(rows), bench(spark, items))
    assert one == {(k, k) for k in range(0, 40, 3)}
    assert {(r.doc_id, r.item_id) for r in op.leaks(docs_of(rows), bench(spark, items), block=500).collect()} == one


def test_alignment_and_lemma_against_full_edit_distance():
    rnd = random.Random(8)

    def least(p, t):  # edits of p to any part of t
        row = [0] * (len(t) + 1)
        for i, c in enumerate(p, 1):
            diagonal, row[0] = row[0], i
            for j, d in enumerate(t, 1):
                diagonal, row[j] = row[j], min(diagonal + (c != d), row[j] + 1, row[j - 1] + 1)
        return min(row)

    for _ in range(60):
        text = filler(rnd, 12)[:80].ljust(80, "z")
        index = op.build([(1, text)])
        doc = filler(rnd, 5) + edit(rnd, text, rnd.randint(0, 7)) + filler(rnd, 5)
        buf, _ = op.normalised(doc.encode())
        got = list(op.regions(buf, index, index.table(), op.EDITS))
        true = least(text, doc)
        assert bool(got) == (true <= op.budget(80))
        if got:
            assert min(g[3] for g in got) == true


def test_excerpts_at_every_offset():
    rnd = random.Random(11)
    item = filler(rnd, 60)[:233].strip()
    index = op.build([(1, item)])
    table = index.table()

    def hits(part):
        buf, _ = op.normalised(f"{filler(rnd, 6)}#{part}#{filler(rnd, 6)}".encode())
        return list(op.regions(buf, index, table, op.EDITS))

    for n in (80, 81, 97, 114, 120):
        for i in range(len(item) - n + 1):
            got = hits(item[i : i + n])
            assert min(g[3] for g in got) == 0 and {g[4] for g in got} >= set(range(i, i + n - 79))
    assert all(hits(edit(rnd, item[i : i + 80], 4)) for i in range(0, len(item) - 79, 7))
    assert not hits(item[20:90])
    words = item.split()  # one word in three windows' reach replaced by a longer one
    assert hits(" ".join(w if i not in (18, 36) else "REPLACEDWORDS" for i, w in enumerate(words)))


def test_normalised_offsets():
    buf, at = op.normalised("Ab \n\t C".encode())
    assert buf.tobytes() == b"ab c" and at.tolist() == [0, 1, 2, 6] and isinstance(at, np.ndarray)


def test_repeated_characters_need_little_memory(monkeypatch):
    """A rule of dashes in a text and one in an item share every q-gram with every
    place; in halves the result is the same."""
    import tracemalloc

    import pyarrow as pa

    index = op.build([(1, "=" * 200), (2, "an ordinary item with words in it, and with more words than one passage would need to hold")])
    batch = pa.RecordBatch.from_arrays([pa.array([5, 6]), pa.array(["x " + "=" * 12_000 + " y", "nothing here"])], names=["doc_id", "text"])
    results = []
    for places in (10**9, 20_000):
        monkeypatch.setattr(op, "PLACES", places)
        tracemalloc.start()
        results.append([r for out in op._scan(index, 0.06)(iter([batch])) for r in out.to_pylist()])
        results.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    whole, much, halves, little = results
    assert halves == whole and len(whole) == 1 and (whole[0]["start"], whole[0]["end"]) == (2, 12_002)
    assert little < much / 4
