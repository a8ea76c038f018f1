"""Quality by pairwise ranking (Bradley-Terry).

Each pair of a good and a bad labelled document is a comparison that the good one wins; the
probability is the logistic of the difference of their scores, and scores are linear in features
of the text. Fitting minimises the logistic loss of feature differences by Newton steps, over all
pairs of all labelled training rows. Pairs are never listed: a smooth function of a difference of
two scores is interpolated from scores on a grid (measured error of a pair's loss and slope below
1e-7, of its curvature, which only sets the steps, 3e-7), so the sums over pairs follow from sums per
grid point, one for each class. The decision is a quantile of the scores of all
training rows: the share of bad rows among the training labels is rejected. The published score
is the logistic of the distance to that quantile, moved so that the quantile itself falls on
``THRESHOLD``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from snapstar.llm.labels import HELD_OUT_FOLDS, labelled, scored, summed
from snapstar.llm.text import fold, mixed, table, word_hashes
from snapstar.session import new_folder

THRESHOLD = 0.3
RIDGE, STEPS = 1e-3, 30
#: Distance of grid points, and how many of them a score is interpolated from.
GRID, POINTS = 0.25, 8
#: Cells of a count of scores, and scores that the driver may sort.
CELLS, SORTED = 4096, 10_000


def _flags(characters: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters.encode())] = True
    return out


_SYMBOLS, _STOPS = _flags("#*$%&|<>@^~_=+\\/{}[]"), _flags(".!?")
_CAPITALS, _DIGITS = _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _flags("0123456789")
_LETTERS = _CAPITALS | _flags("abcdefghijklmnopqrstuvwxyz")
_LETTERS[128:] = True
N_FEATURES = 16


def features(text: str | None) -> np.ndarray:
    """Shares and log counts that tell prose from junk; all zero for a text without words."""
    out = np.zeros(N_FEATURES)
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    words, start, end = word_hashes(text)
    n = len(words)
    if n == 0:
        return out
    size = (end - start).astype(float)
    solid = size.sum()
    lines = [line for line in (text or "").split("\n") if line.strip()]
    share = lambda x: float(np.count_nonzero(x)) / n
    bare = np.add.reduceat(_LETTERS[raw].astype(np.int64), start) == 0
    capital = np.count_nonzero(_CAPITALS[raw])

    def repeated(width: int) -> float:
        if n < width + 1:
            return 0.0
        grams = words[:n - width + 1].copy()
        for k in range(1, width):
            grams = mixed(grams + words[k:n - width + 1 + k])
        return 1.0 - len(np.unique(grams)) / len(grams)

    out[:] = (
        1.0, np.log(n), np.count_nonzero(_SYMBOLS[raw]) / solid, capital / solid,
        np.count_nonzero(_DIGITS[raw]) / solid, share(words[1:] == words[:-1]),
        repeated(1), repeated(3), repeated(6), share(bare),
        1.0 - len(set(lines)) / len(lines), min(size.mean(), 30.0) / 10,
        min(size.std(), 30.0) / 10, share(_STOPS[raw[end - 1]]),
        share(_SYMBOLS[raw[end - 1]]), np.log(len(lines)) / np.log(n + 1),
    )
    return out


@dataclass(frozen=True)
class Ranking:
    """Linear scores of standardised features, and the quantile that decides."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return ((rows - self.mean) / self.scale) @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        away = self.raw(rows) - self.cut + np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(away, -700, 700)))


def spread(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first of each score's ``POINTS`` grid points, and its shares at them (Lagrange)."""
    at = np.floor(scores / GRID)
    place = scores / GRID - at + (POINTS // 2 - 1)
    shares = np.ones((POINTS, len(scores)))
    for k in range(POINTS):
        for m in range(POINTS):
            if m != k:
                shares[k] *= (place - m) / (k - m)
    return at.astype(np.int64) - (POINTS // 2 - 1), shares


@dataclass
class Sums:
    """Of the rows of one class: the grid points near their scores, rows and features at each."""

    points: np.ndarray
    rows: np.ndarray
    features: np.ndarray

    @staticmethod
    def of(x: np.ndarray, weights: np.ndarray) -> Sums:
        first, shares = spread(x @ weights)
        points, at = np.unique(
            (first + np.arange(POINTS)[:, None]).ravel(), return_inverse=True)
        add = lambda value: np.bincount(
            at, (shares * value).ravel(), minlength=len(points))
        return Sums(points, add(1.0), np.stack([add(column) for column in x.T], axis=1))


def _bends(points: np.ndarray, other: Sums) -> np.ndarray:
    """Second derivatives of the loss at ``points``, summed over the rows of the other class."""
    away = np.clip((points[:, None] - other.points) * GRID, -700, 700)
    return 1 / (2 + np.exp(away) + np.exp(-away)) @ other.rows


def curvature(x: np.ndarray, weights: np.ndarray, points: np.ndarray, bends: np.ndarray) -> np.ndarray:
    """Sum of x x^T, each row weighted by what ``bends`` (at ``points``) is at its score."""
    first, shares = spread(x @ weights)
    at = np.searchsorted(points, first)
    weight = sum(shares[k] * bends[at + k] for k in range(POINTS))
    return (x * weight[:, None]).T @ x


def minimised(
    width: int, sums: Callable[[np.ndarray], tuple[Sums, Sums]],
    curve: Callable[[np.ndarray, list[np.ndarray], list[np.ndarray]], np.ndarray],
) -> np.ndarray:
    """Weights of the least loss over all pairs.

    ``sums`` gives the sums of good and bad rows under weights, ``curve`` the curvatures of both
    classes added up.
    """
    weights, move, least = np.zeros(width), np.zeros(width), np.inf
    for _ in range(STEPS):
        good, bad = sums(weights)
        pairs = good.rows.sum() * bad.rows.sum()
        away = (good.points[:, None] - bad.points) * GRID
        loss = good.rows @ np.logaddexp(0, -away) @ bad.rows / pairs + RIDGE / 2 * weights @ weights
        if loss > least * (1 + 1e-6) + 1e-9:  # too far: back by half
            move /= 2
            weights = weights + move
            continue
        least = loss
        lost = 1 / (1 + np.exp(np.clip(away, -700, 700)))
        slope = (bad.features.T @ (lost.T @ good.rows) - good.features.T @ (lost @ bad.rows)
                 ) / pairs + RIDGE * weights
        # Another reading of the rows may round a score to the next point.
        near = [np.unique(np.concatenate([own.points - 1, own.points, own.points + 1]))
                for own in (good, bad)]
        bends = [_bends(near[0], bad), _bends(near[1], good)]
        clipped = np.clip(away, -700, 700)
        cross = good.features.T @ (1 / (2 + np.exp(clipped) + np.exp(-clipped))) @ bad.features
        inner = curve(weights, near, bends)
        move = np.linalg.solve((inner - cross - cross.T) / pairs + RIDGE * np.eye(width), slope)
        weights = weights - move
        if np.abs(move).max() < 1e-6:
            break
    return weights


def fit(rows: np.ndarray, labels: np.ndarray, bad_share: float) -> Ranking:
    """Bradley-Terry weights from all pairs of good and bad ``rows``, those of one machine.

    Without a row of each class there is no pair: all weights are 0, and every text gets
    ``THRESHOLD``.
    """
    width = rows.shape[1]
    if len(set(labels.tolist())) < 2:
        return _undecided(width)
    mean, scale = rows.mean(0), rows.std(0)
    scale[scale < 1e-9] = 1.0
    x = (rows - mean) / scale
    classes = [x[labels == 1], x[labels == 0]]
    weights = minimised(
        width, lambda w: tuple(Sums.of(own, w) for own in classes),
        lambda w, near, bends: sum(curvature(*part) for part in zip(classes, [w, w], near, bends)))
    # Classes are weighted to their shares before the quantile.
    raw = x @ weights
    weight = np.where(
        labels == 1, (1 - bad_share) / len(classes[0]), bad_share / len(classes[1]))
    order = np.argsort(raw)
    below = np.cumsum(weight[order])
    at = min(int(np.searchsorted(below, bad_share * (1 + 1e-9))), len(order) - 1)
    cut = (raw[order[at]] + raw[order[max(at - 1, 0)]]) / 2
    return Ranking(mean, scale, weights, float(cut))


def _undecided(width: int) -> Ranking:
    return Ranking(np.zeros(width), np.ones(width), np.zeros(width), 0.0)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES)


def _cells(total: dict[int, np.ndarray]) -> pa.RecordBatch:
    """(cell, value) of vectors by number: cell is the number of the vector times its length + k."""
    cells = [np.arange(len(v)) + number * len(v) for number, v in total.items()]
    return pa.RecordBatch.from_arrays([
        pa.array(np.concatenate(cells or [[]]), pa.int64()),
        pa.array(np.concatenate([*total.values()] or [[]]), pa.float64())], names=["cell", "value"])


def fit_rows(rows: DataFrame) -> Ranking:
    """``fit`` over all rows (_label, features) of a table; sums alone reach the driver."""
    counts = {r["_label"]: r["n"] for r in rows.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    if not (counts.get(0) and counts.get(1)):
        return _undecided(N_FEATURES)
    one = lambda k: F.get("features", F.lit(k))
    spans = rows.agg(*[F.avg(one(k)) for k in range(N_FEATURES)],
                     *[F.stddev_pop(one(k)) for k in range(N_FEATURES)]).first()
    mean, scale = np.array(spans[:N_FEATURES]), np.array(spans[N_FEATURES:])
    scale[scale < 1e-9] = 1.0
    table_ = rows.select("_label", "features")

    def classes(batch: pa.RecordBatch) -> list[np.ndarray]:
        label = batch.column(0).to_numpy(zero_copy_only=False)
        x = (_matrix(batch.column(1)) - mean) / scale
        return [x[label == 1], x[label == 0]]

    def sums(weights: np.ndarray) -> tuple[Sums, Sums]:
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, np.ndarray] = {}
            for batch in batches:
                for kind, x in enumerate(classes(batch)):
                    own = Sums.of(x, weights)
                    for point, n, held in zip(own.points.tolist(), own.rows, own.features):
                        at = point * 2 + kind
                        value = np.append(held, n)
                        total[at] = total[at] + value if at in total else value
            yield _cells(total)

        cells, values = summed(table_.mapInArrow(add, "cell long, value double"))
        order = np.argsort(cells)
        held = values[order].reshape(-1, N_FEATURES + 1)
        at = cells[order][::N_FEATURES + 1] // (N_FEATURES + 1)
        return tuple(  # type: ignore[return-value]
            Sums(at[at % 2 == kind] // 2, held[at % 2 == kind, -1], held[at % 2 == kind, :-1])
            for kind in (0, 1))

    def curve(weights, near, bends) -> np.ndarray:
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((N_FEATURES, N_FEATURES))
            for batch in batches:
                for part in zip(classes(batch), [weights] * 2, near, bends):
                    total += curvature(*part)
            yield _cells({0: total.ravel()})

        cells, values = summed(table_.mapInArrow(add, "cell long, value double"))
        return values[np.argsort(cells)].reshape(N_FEATURES, N_FEATURES)

    model = Ranking(mean, scale, minimised(N_FEATURES, sums, curve), 0.0)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array(model.raw(_matrix(batch.column(0))))], names=["raw"])

    raw = _stored(rows.select("features").mapInArrow(score, "raw double"), "scores")
    # As many rows as there are bad ones lie below the cut.
    cut = (ranked(raw, counts[0] - 1) + ranked(raw, counts[0])) / 2
    return Ranking(mean, scale, model.weights, cut)


def ranked(raw: DataFrame, rank: int) -> float:
    """The value of a rank (from 0) in a table of one column of numbers; cells are counted, and
    counted again inside the cell of that rank, until few rows or equal rows are left."""
    value = F.col(raw.columns[0])
    low, high, n = raw.agg(F.min(value), F.max(value), F.count(value)).first()
    while low < high and n > SORTED:
        inside = raw.where(value.between(low, high))
        cell = F.least(F.floor((value - low) / (high - low) * CELLS), F.lit(CELLS - 1))
        for found in sorted(inside.groupBy(cell.alias("cell")).agg(
            F.min(value).alias("low"), F.max(value).alias("high"), F.count(value).alias("n")
        ).collect()):
            if rank < found["n"]:
                break
            rank -= found["n"]
        low, high, n = found["low"], found["high"], found["n"]
    if low == high:
        return low
    return sorted(r[0] for r in raw.where(value.between(low, high)).collect())[rank]


def _stored(rows: DataFrame, purpose: str) -> DataFrame:
    folder = new_folder(rows.sparkSession, purpose)
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(_key, features) of each document, stored: measured once, read in every step of the fit."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(value.as_py()) for value in batch.column(1)]
            ends = np.arange(len(rows) + 1, dtype=np.int32) * N_FEATURES
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(
                pa.array(ends), pa.array(np.concatenate(rows or [[]]), pa.float64()))],
                names=["_key", "features"])

    kind = docs.schema[key].dataType.simpleString()
    return _stored(docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).mapInArrow(
        measure, f"_key {kind}, features array<double>"), "measured")


def train(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Ranking:
    """Fit on all labelled rows outside the held-out fold."""
    return _train(measured(docs.where(fold(F.col("doc_id"), HELD_OUT_FOLDS) != 0)), labels, label)


def _train(rows: DataFrame, labels: DataFrame, label: str = "quality") -> Ranking:
    return fit_rows(_stored(labelled(rows, labels, label).groupBy("_key").agg(
        F.max("_label").alias("_label"), F.max("features").alias("features")), "labelled"))


def scorer(model: Ranking):
    """A column function: the score of a text (null counts as empty)."""
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        if len(texts) == 0:
            return pd.Series([], dtype=float)
        return pd.Series(model.score(np.array([features(t) for t in texts])))

    def column(text: Column) -> Column:
        return score(text)
    return column


def rank(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Repeated rows and ties get equal scores; a null or empty text gets the score of the all-zero
    features; a null id is in fold 0. Other columns are left out. An empty table gives no rows, and
    without labels of both classes every score is ``THRESHOLD``.
    """
    rows = measured(docs)
    model = _train(rows, labels)

    @F.pandas_udf("double")
    def score(held: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack(held)) if len(held) else [], dtype=float)

    return scored(rows, score, THRESHOLD, "_key", "features").withColumnRenamed("_key", "doc_id")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document."""
    return rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
