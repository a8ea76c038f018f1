"""Labelled rows for classifiers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from snapstar.llm.text import fold

HELD_OUT_FOLDS = 5


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int,
    features: Callable[[str | None], np.ndarray], key: str = "doc_id", text: str = "text",
) -> tuple[list[np.ndarray], np.ndarray]:
    """Feature arrays and labels of at most ``per_class`` training rows of each class.

    Training rows are those whose fold is not 0. They are taken in order of the hash of their key,
    so the sample does not depend on file order; labels other than 0 and 1 and null keys do not
    count, and of repeated labels of a key the larger holds. Features are computed where the texts
    are; only the sample reaches the driver.
    """
    training = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).where(
        fold(F.col(key), HELD_OUT_FOLDS) != 0
    ).groupBy(F.col(key).alias("_key")).agg(F.max(label).alias("_label"))
    order = [F.xxhash64("_key"), F.col("_key")]
    chosen = training.where("_label = 1").orderBy(*order).limit(per_class).unionByName(
        training.where("_label = 0").orderBy(*order).limit(per_class))
    texts = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(
        F.broadcast(chosen), "_key")  # at most 2 * per_class rows

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({
                "_key": batch["_key"], "_label": batch["_label"].astype("int32"),
                "_features": [features(t).tobytes() for t in batch["_text"]],
            })

    kind = training.schema["_key"].dataType.simpleString()
    rows = texts.mapInPandas(measured, f"_key {kind}, _label int, _features binary").groupBy(
        "_key"
    ).agg(F.max("_label").alias("_label"), F.max("_features").alias("_features"))
    held = sorted(rows.collect(), key=lambda row: row["_key"])
    kind_of = features("").dtype
    return (
        [np.frombuffer(row["_features"], kind_of) for row in held],
        np.array([row["_label"] for row in held], int),
    )


def labelled(rows: DataFrame, labels: DataFrame, label: str, key: str = "doc_id") -> DataFrame:
    """All training rows of ``rows`` (by ``_key``), with their ``_label``.

    Training rows are those whose fold is not 0; labels other than 0 and 1 and null keys do not
    count, and of repeated labels of a key the larger holds.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).where(
        fold(F.col(key), HELD_OUT_FOLDS) != 0
    ).groupBy(F.col(key).alias("_key")).agg(F.max(label).cast("int").alias("_label"))
    return rows.join(known, "_key")


def summed(parts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Cells and total values of the partial sums (cell, value) that tasks made."""
    total = parts.groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
    return total["cell"].to_numpy(), total["value"].to_numpy()


def scored(docs: DataFrame, score, threshold: float, key: str = "doc_id", text: str = "text"):
    """(key, held_out, score, predicted) for every row of ``docs``."""
    return docs.select(
        F.col(key).alias(key), (fold(F.col(key), HELD_OUT_FOLDS) == 0).alias("held_out"),
        score(F.col(text)).alias("score"),
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
