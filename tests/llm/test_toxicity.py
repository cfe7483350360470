import random
import zlib

import numpy as np

from llm_support import SF_SMALL, docs_of
from tidemark.llm import queries
from tidemark.llm import toxicity as op


def test_fold():
    assert op.fold("You 1D10T, stоpid sc​um!") == " you idiot stopid scum "
    assert op.fold("") == "  " and op.fold("in 2019 | x|y ### 12") == " in 2019 xly 12 "
    assert op.fold("ÉTÉ naïve") == " été naïve "


def test_exceptions_and_neighbours():
    model = op.Model({" clown ": 1.0, " idiot ": 2.0, " nastyw": 4.0}, {"clown fish", "nastyweed plant"})
    weight = lambda t: op.lexicon_weight(op.fold(t), model.automaton(), model.exceptions)
    assert weight("a clown fish swims") == 0 and weight("a clown swims") == 1
    assert weight("the nastyweed plant") == 0 and weight("nastywort plant") == 4
    assert weight("idiot idiot clown") == 5 and weight("idiotic clownish") == 0 and weight("") == 0


def corpus(n=600, seed=3):
    rnd = random.Random(seed)
    words = [f"word{k}" for k in range(300)]
    rows = []
    for i in range(n):
        text = rnd.choices(words, k=rnd.randint(20, 200))
        toxic = rnd.random() < 0.15
        if toxic:
            for _ in range(rnd.randint(1, 5)):
                text.insert(rnd.randrange(len(text)), rnd.choice(["badword", "nastyword", "b4dword"]))
        elif rnd.random() < 0.04:
            text.insert(5, "badword fish")
        rows.append((i, " ".join(text), int(toxic)))
    return rows


def test_learns_words_and_exceptions(spark):
    rows = corpus()
    train, held = rows[:400], rows[400:]
    model = op.fit(spark.createDataFrame([(t, y) for _, t, y in train], "text string, label int"))
    assert {t.strip()[:4] for t in model.weights} == {"badw", "nast"} and model.exceptions == {"badword fish"}
    got = spark.createDataFrame([(t, y) for _, t, y in held], "text string, y int").select("y", op.score(model, "text").alias("s")).collect()
    assert all((r.s >= 0.5) == (r.y == 1) for r in got)


def test_texts_with_one_opening_all_count(spark):
    head = "A page header of more than forty-eight characters, the same on all pages. "
    train = [(head + t, y) for _, t, y in corpus()[:400]]
    model = op.fit(spark.createDataFrame(train, "text string, label int"))
    assert {t.strip()[:4] for t in model.weights} == {"badw", "nast"} and model.exceptions == {"badword fish"}


def test_copies_count_once_with_the_usual_label(spark):
    rows = [("a text", 0)] + [("a text", 1)] * 3 + [("b text", 0), ("b text", 1), ("c text", 2), ("", 1)]
    got = op.distinct_texts(spark.createDataFrame(rows, "text string, label int")).collect()
    assert sorted((r.text, r.label) for r in got) == [("", 1), ("a text", 1), ("b text", 0), ("c text", 0)]


def test_odd_rows(spark, docs_of):
    model = op.Model({" idiot ": 2.0}, set(), [-2.0, 3.0, 0.1])
    rows = [(None, "idiot"), (1, None), (2, ""), (3, "idiot"), (3, "idiot"), (4, "idiot " * 100_000)]
    got = [(r.text, r.s) for r in docs_of(rows).select("text", op.score(model, "text").alias("s")).collect()]
    by = dict(got)
    assert by[None] == by[""] < 0.5 < by["idiot"] and len(got) == 6 and all(0 <= s <= 1 for _, s in got)
    assert docs_of([]).select(op.score(model, "text")).count() == 0
    one = op.fit(spark.createDataFrame([("a", 1), (None, None)], "text string, label int"))
    none = op.fit(spark.createDataFrame([], "text string, label int"))
    assert one.curve[0] > 0 > none.curve[0] and not none.weights


def test_learns_only_from_its_part(spark):
    rows = corpus(200)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(0, 1), (None, 1), (7, None), (10**9, 1)], "doc_id long, toxic int")
    part = {t for i, t, _ in rows if zlib.crc32(str(i).encode()) % 5 != 0}
    assert {r.text for r in op.training_rows(docs, labels).collect()} <= part
    assert op.training_rows(docs, labels, most_rows=10).count() <= 10


def test_query_separates_the_held_out_labels(spark):
    out = queries.op10_toxicity(spark, SF_SMALL).collect()
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) for r in out)
    assert np.mean([r.predicted == truth[r.doc_id] for r in out if r.doc_id in truth and r.held_out]) > 0.9


def brute_score(text, model):
    """Every word against every term, without an automaton."""
    words, total = op.fold(text or "").split(), 0.0
    for i, w in enumerate(words):
        around = [" ".join(words[i - 1 : i + 1])] * (i > 0) + [" ".join(words[i : i + 2])] * (i + 1 < len(words))
        if not model.exceptions.intersection(around):
            total += sum(v for t, v in model.weights.items() if (w == t.strip() if t[-1] == " " else w.startswith(t[1:])))
    a, b, c = model.curve
    x, y = np.log1p(total), np.log1p(100 * total / max(20, len(words)))
    return 1 / (1 + np.exp(-(a + b * x + c * y)))


def test_scores_equal_brute_force(docs_of):
    rnd = random.Random(11)
    model = op.Model({" clown ": 1.0, " idiot ": 2.0, " nasty": 4.0, " idiots": 0.5, " été ": 0.25}, {"clown fish", "a clown", "nasty weed", "idiot idiot"}, [-2.0, 1.5, 0.5])
    words = ["clown", "Clown", "cl0wn", "fish", "a", "idiot", "idiots", "idiotss", "nasty", "n4stywort", "weed", "ÉTÉ", "стоp", "word", "x|y", "...", "12"]
    rows = [(i, rnd.choice([" ", "\n", ", "]).join(rnd.choices(words, k=rnd.choice([0, 1, 2, 9, 60])))) for i in range(300)] + [(900, None), (901, "clown " * 50_000)]
    got = {r.doc_id: r.s for r in docs_of(rows).select("doc_id", op.score(model, "text").alias("s")).collect()}
    assert set(got) == {i for i, _ in rows}
    assert all(abs(got[i] - brute_score(t, model)) < 1e-12 for i, t in rows)


def test_several_labels_of_one_id(spark):
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5][:4]
    docs = spark.createDataFrame([(i, f"text {i}") for i in ids], "doc_id long, text string")
    labels = spark.createDataFrame([(ids[0], 1), (ids[0], 1), (ids[0], 0), (ids[1], 1), (ids[1], 0), (ids[2], None), (ids[2], 1), (ids[3], 0)], "doc_id long, toxic int")
    got = {r.text: r.label for r in op.training_rows(docs, labels).collect()}
    assert got == {f"text {ids[0]}": 1, f"text {ids[1]}": 0, f"text {ids[2]}": 1, f"text {ids[3]}": 0}
