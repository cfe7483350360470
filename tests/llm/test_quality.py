import random

import numpy as np
from pyspark.sql import functions as F

from llm_support import SF_SMALL, docs_of
from tidemark.llm import quality as op


def test_label_model_recovers_accuracies():
    rnd = np.random.default_rng(4)
    true = rnd.random(20_000) < 0.7
    accuracy, cast = [0.95, 0.8, 0.65, 0.9], [0.9, 0.6, 0.8, 0.3]
    votes = np.stack([np.where(rnd.random(len(true)) < c, np.where(rnd.random(len(true)) < a, 1, -1) * np.where(true, 1, -1), 0) for a, c in zip(accuracy, cast)], axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = op.label_model(patterns, counts)
    assert np.abs(model.accuracy() - accuracy).max() < 0.03 and abs(model.prior - 0.7) < 0.03


def test_good_and_bad_texts(docs_of):
    rnd = random.Random(1)
    words = [f"{a}{b}" for a in ("mor", "tel", "san", "ker", "vin") for b in ("a", "o", "ing", "est", "ul")]
    good = [(i, " ".join(" ".join(rnd.choices(words, k=9)).capitalize() + "." for _ in range(12))) for i in range(60)]
    bad = [(100 + i, " ".join(rnd.choice(words) + rnd.choice(["%%%", "###", "$$$"]) for _ in range(100))) for i in range(30)]
    got = {r.doc_id: r for r in op.classify(docs_of(good + bad)).collect()}
    assert all(got[i].keep for i, _ in good) and not any(got[i].keep for i, _ in bad)
    assert got[0].component_id == "y"


def test_signs_in_words_are_counted_over_all_words():
    at = op.LABELLERS.index("sign_words")
    table = b"a# bc bc bc bc " * 200  # 1000 words: every fifth has a sign
    assert op.votes(table)[at] == op.NONE
    assert op.votes(b"plain words here " * 200 + b"$a$ " * 700)[at] == op.BAD
    assert op.votes(b"$aword " * 20)[at] == op.BAD and op.votes(b"words, of. all kinds " * 20)[at] == op.GOOD


def test_sample_holds_different_texts_whatever_the_copies(spark, docs_of):
    some = docs_of([(i, f"text {i % 10} of ten.") for i in range(2000)] + [(1, None), (2, "")])
    assert [op.training_texts(some, n).count() for n in (1, 5, 11, 6000)] == [1, 5, 11, 11]
    copies = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("one and the same text.").alias("text"))
    assert op.training_texts(copies, 6000).count() == 1
    assert 0 <= op.classify(copies).select("quality").distinct().collect()[0].quality <= 1


def test_odd_rows(docs_of):
    rows = [(None, "a text."), (1, None), (2, ""), (3, "same text."), (3, "same text."), (4, "word " * 100_000), (5, "ab")]
    got = op.classify(docs_of(rows)).collect()
    assert len(got) == len(rows) and all(0 <= r.quality <= 1 for r in got)
    by = {r.text: r.quality for r in got}
    assert by[None] == by[""]
    assert op.classify(docs_of([])).count() == 0


def test_agrees_with_the_labels(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    both = op.classify(docs).join(labels.withColumnRenamed("quality", "truth"), "doc_id").select("truth", F.col("keep").cast("int").alias("keep")).collect()
    assert np.mean([r.truth == r.keep for r in both]) > 0.85
