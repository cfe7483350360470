import random

from tidemark.llm import secrets as op


def scanned(spark, rows, **how):
    return op.scan(spark.createDataFrame(rows, "doc_id long, text string, path string, length string"), **how)


def corpus(n=300, seed=5):
    rnd = random.Random(seed)
    words = ["".join(rnd.choices("abcdefghij", k=rnd.randint(4, 8))) for _ in range(200)]
    rows = []
    for i in range(n):
        text = rnd.choices(words, k=60)
        if i % 3 == 0:
            text.insert(20, f'token = "{"".join(rnd.choices("0123456789abcdef", k=40))}"')
        if i % 3 == 1:
            text.insert(30, "".join(rnd.choices("0123456789", k=16)))
            text.insert(10, f"{rnd.choice(words)}.{rnd.randint(10, 99)}@mail.example.com")
        rows.append((i, " ".join(text), f"src{i % 4}", "x"))
    return rows


def test_finds_tokens_and_removes_the_rest(spark):
    rows = corpus()
    got = scanned(spark, rows).collect()
    texts = {i: t.encode() for i, t, *_ in rows}
    assert all(texts[r.doc_id][r.start : r.end].decode() == r.candidate for r in got)
    assert {r.doc_id for r in got if r.secret} == {i for i in texts if i % 3 == 0}
    assert {r.doc_id for r in got if not r.secret} == {i for i in texts if i % 3 == 1}


def test_odd_rows(spark):
    rows = corpus(60) + [(None, "token 0123456789abcdef01", "p", "x"), (900, None, None, None), (901, "", None, None), (902, "a1" * 100_000, None, None), (903, "key9876543210zz", "p", "x"), (903, "key9876543210zz", "p", "x")]
    got = scanned(spark, rows).collect()
    ids = [r.doc_id for r in got]
    assert ids.count(None) == 1 and ids.count(903) == 2 and ids.count(902) == 1 and 900 not in ids and 901 not in ids


def test_without_labels_or_rows(spark):
    got = scanned(spark, [(1, "just 0123456789abcdef", "p", "x")]).collect()
    assert len(got) == 1 and got[0].secret and got[0].probability is None
    assert scanned(spark, []).count() == 0


def test_own_labelled_findings(spark):
    docs = spark.createDataFrame([(i, t, p) for i, t, p, _ in corpus()], "doc_id long, text string, path string")
    found = op.candidates(docs, op.dictionary(docs)).withColumn("label", op.F.col("candidate").contains("@").cast("int"))
    got = op.scan(docs, found).collect()
    assert all(r.secret == ("@" in r.candidate) for r in got)


def test_features_cover_the_whole_token():
    at = op.FEATURES.index
    got = op.features(b"a1" * 4000 + b"Z" * 8000, "", "", b"", b"", "", set())
    assert got[at("length")] == 16_000 and got[at("upper")] == 0.5


def test_equal_findings_leave_room_for_others(spark):
    rows = [(float(i), 0) for i in range(40)] + [(50.0, 0)] * 500 + [(100.0 + i, 1) for i in range(5)]
    made = spark.createDataFrame([(*[x] * len(op.FEATURES), y) for x, y in rows], ", ".join(f"{f} double" for f in op.FEATURES) + ", label int")
    model = op.train(made, most_rows=10)
    assert model is not None
    got = model.transform(made).select("label", "_prediction").collect()
    assert all(r._prediction == 1 for r in got if r.label == 1)
