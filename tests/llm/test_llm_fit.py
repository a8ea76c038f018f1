"""Classifiers are fitted on every labelled row, not on a sample."""

import numpy as np
from pyspark.sql import functions as F

from snapstar.llm import quality
from snapstar.llm.text import table


def test_weights_are_the_minimum_over_all_pairs():
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(400, 5)) * (1, 2, 0.5, 1, 3) + 1
    labels = (rows[:, 0] + rows[:, 1] + rng.normal(size=400) > 2).astype(int)
    model = quality.fit(rows, labels, float((labels == 0).mean()))
    x = (rows - model.mean) / model.scale
    away = (x[labels == 1][:, None] - x[labels == 0]).reshape(-1, 5)
    lost = 1 / (1 + np.exp(away @ model.weights))
    slope = -(away.T @ lost) / len(away) + quality.RIDGE * model.weights
    assert np.abs(slope).max() < 1e-6


def _texts(spark, n):
    """More rows of each class than a bounded sample would take, the classes overlapping."""
    k = F.xxhash64("id")
    bad = F.col("id") % 2 == 0
    junk = F.expr("array_join(transform(sequence(0, pmod(xxhash64(id, 1), 5)), i -> concat('#', i)), ' ')")
    text = F.concat_ws(" ", F.lit("some plain words of"), k, F.when(bad | (F.pmod(k, F.lit(4)) == 0), junk))
    return spark.range(n).select(
        F.col("id").alias("doc_id"), text.alias("text"), (~bad).cast("int").alias("quality"))


def test_quality_is_fitted_on_every_labelled_row(spark):
    rows = _texts(spark, 10_000)
    model = quality.train(rows.drop("quality"), rows.drop("text"))
    held = [r for r in rows.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0).collect()]
    labels = np.array([r["quality"] for r in held])
    assert min((labels == 0).sum(), (labels == 1).sum()) > 3500
    whole = quality.fit(
        np.array([quality.features(r["text"]) for r in held]), labels, float((labels == 0).mean()))
    assert np.allclose(model.mean, whole.mean) and np.allclose(model.scale, whole.scale)
    assert np.allclose(model.weights, whole.weights, atol=1e-5)
    assert abs(model.cut - whole.cut) < 1e-5


def test_a_rank_is_found_among_equal_and_many_values(spark):
    raw = spark.range(30_000).select(
        F.when(F.col("id") < 12_000, F.lit(0.5)).otherwise(F.col("id") / 7.0).alias("raw"))
    held = sorted(r[0] for r in raw.collect())
    for rank in (0, 11_999, 12_000, 20_000, 29_999):
        assert quality.ranked(raw, rank) == held[rank]


def test_ranking_of_given_documents_is_that_of_its_model(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.train(docs, labels)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for row in quality.rank(docs, labels).collect():
        score = model.score(quality.features(texts[row["doc_id"]])[None])[0]
        assert abs(row["score"] - score) < 1e-6
