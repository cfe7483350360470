"""The corpus pipeline: five stages over ``documents``, each one operator of
``tidemark.llm``, each on all rows that the stage before kept.

toxicity -> line dedup -> SimHash near-duplicates -> benchmark decontamination ->
SentencePiece. A stage's result is written as Parquet and read again, so a lost
executor never costs more than one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, line_dedup, sentencepiece_fst, simhash, toxicity
from tidemark.llm.common import load, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon scores under 0.5. The model learns from the
    labelled documents of the table, never from the part held out."""
    model = toxicity.fit(toxicity.training_rows(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")))
    return docs.filter(toxicity.score(model, "text") < 0.5).select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without its lines that repeat in other documents; n_chars anew.
    A null text stays null."""
    kept = line_dedup.line_dedup(docs.select(*COLUMNS))
    kept = kept.withColumn("text", F.when(F.col("text").isNotNull(), line_dedup.kept_text()))
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id."""
    return simhash.near_dedup(docs).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark passage is found."""
    return decontamination.decontaminated(docs, load(spark, sf_dir, "benchmark")).select(*COLUMNS)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, piece ids, their number, and whether they decode to the text."""
    out = sentencepiece_fst.encode(docs.select("doc_id", "lang", "source", "text"))
    return out.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_pieces"), "ids", "round_trip")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("sentencepiece", to_pieces),
]

# SQL can express neither the learned lexicon nor the fingerprints; tests/llm checks each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
