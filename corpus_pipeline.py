"""The corpus pipeline: quality, toxicity, near duplicates, benchmark leaks, pieces.

Each stage takes the rows its predecessor kept, decides over all of them, and returns those that
stay with the columns of ``documents``; the last returns the pieces of each document. Between
stages the rows are Parquet in the shared folder, so a lost executor costs no earlier stage.

Stages handle what their operators handle (see their docstrings): null and empty texts are scored
like texts without features and stay unless scored as junk, repeated rows are one document each
until the near-duplicate stage keeps one, null ids are kept as null, other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from snapstar.llm import decontaminate, jaccard, pieces, quality, toxicity
from snapstar.llm.text import table
from snapstar.session import new_folder


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold."""
    score = quality.scorer(quality.train(docs, table(spark, sf_dir, "labels")))
    return docs.where(score(F.col("text")) >= quality.THRESHOLD)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold."""
    score = toxicity.scorer(toxicity.train(docs, table(spark, sf_dir, "labels")))
    return docs.where(score(F.col("text")) < toxicity.THRESHOLD)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id."""
    return jaccard.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a stretch that is near a benchmark item."""
    leak = decontaminate.leak_test(table(spark, sf_dir, "benchmark"))
    return docs.where(~leak(F.col("text")))


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_pieces, ids, round_trip) of each document."""
    return pieces.encoded(docs, pieces.load())


STAGES = [
    ("quality_classifier", keep_quality),
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_leaks),
    ("sentencepiece", to_pieces),
]

#: Trained models and exact edit distances have no SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
