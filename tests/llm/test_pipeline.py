import random

import corpus_pipeline as P
from tidemark.llm import simhash
from tidemark.llm import line_dedup as lines

from llm_support import SF_SMALL
from test_line_dedup import brute as brute_lines
from test_simhash import fingerprint, roots

WORDS = [a + b for a in ("mor", "tel", "san", "ker", "vin", "dol", "pra") for b in ("a", "o", "ing", "est", "ul", "em", "is")]
ITEM = "Which of the following rivers, taken from source to mouth, crosses the largest number of present-day national borders?"


def prose(rnd, n):
    return " ".join(rnd.choices(WORDS, k=n))


def write(spark, path, rows, labels):
    spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")


def test_stages(spark, tmp_path):
    rnd = random.Random(1)
    toxic = {i for i in range(200) if i % 7 == 0}
    rows = [(i, prose(rnd, 120) + (" nastyword " + prose(rnd, 5) if i in toxic else "")) for i in range(200)]
    line = "a line that stands in each of a few documents"
    rows += [(200 + i, f"{prose(rnd, 80)}\n{line}\n{prose(rnd, 80)}") for i in range(5)]
    copy = prose(rnd, 200)
    rows += [(300 + i, copy) for i in range(6)] + [(400, prose(rnd, 60) + " " + ITEM), (500, None), (501, ""), (502, "two words")]
    write(spark, str(tmp_path), rows, [(i, 1, int(i in toxic)) for i in range(200)])
    docs, texts = spark.read.parquet(f"{tmp_path}/documents.parquet"), dict(rows)
    seen = {}
    for name, stage in P.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        if name != "sentencepiece":
            assert docs.columns == list(P.COLUMNS)
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = {r.doc_id: r for r in docs.collect()}
    assert set(seen["toxicity"]) == set(texts) - toxic
    after = {i: t for i, _, _, t in brute_lines([(i, r.text) for i, r in seen["toxicity"].items()])}
    assert {i: r.text or "" for i, r in seen["line_dedup"].items()} == after
    assert all(r.text is None and r.n_chars is None or r.n_chars == len(r.text) for r in seen["line_dedup"].values())
    ids = list(seen["line_dedup"])
    group = dict(zip(ids, roots([fingerprint(seen["line_dedup"][i].text) for i in ids], ids)))
    assert set(seen["simhash_near_dedup"]) == {i for i in ids if group[i] == i}
    assert set(seen["decontamination"]) == set(seen["simhash_near_dedup"]) - {400}
    assert all(r.round_trip for r in seen["sentencepiece"].values()) and set(seen["sentencepiece"]) == set(seen["decontamination"])
    assert sorted(r.doc_id for r in P.run(spark, str(tmp_path)).collect()) == sorted(seen["sentencepiece"])


def test_empty_documents(spark, tmp_path):
    write(spark, str(tmp_path), [], [])
    assert P.run(spark, str(tmp_path)).count() == 0


def test_runs_on_the_given_tables(spark):
    out = P.run(spark, SF_SMALL)
    assert out.count() > 50 and out.filter("not round_trip").count() == 0
    assert simhash and lines
