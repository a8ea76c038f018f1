"""Toxicity by a counterfactually regularised classifier.

A logistic model over hashed presence features (words, and word beginnings of four to six bytes)
is fitted to labelled documents. Sentences of the sample that mention a group are copied with the
term swapped for the others of its kind, and the squared change of the score under the swap is
penalised, so that naming a group alone does not move a score: the weight of an offence stays on
what is said, not on whom it is said about.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from snapstar.llm.labels import labelled_sample, scored
from snapstar.llm.text import MULTIPLIER, mixed, table, word_hashes

THRESHOLD = 0.5
#: Bound of the fit: labelled rows of each class.
PER_CLASS = 3000
BITS = 18
RIDGE, PENALTY, STEPS, RATE = 2e-4, 1.0, 150, 0.05
#: Features must be commoner in toxic documents by so many standard errors of the log ratio.
EVIDENCE = 2.5
#: Terms of one kind are swapped for each other; words are compared in lower case.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("mothers", "fathers"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("ausländer", "einheimische"),
    ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"), ("étrangers", "immigrés"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"), ("extranjeros", "inmigrantes"),
)
_SWAPS = {term: [x for x in group if x != term] for group in IDENTITY_TERMS for term in group}
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
_WORD = re.compile(r"\w+")


def features(text: str | None) -> np.ndarray:
    """Sorted distinct feature numbers of a text: its words without punctuation, and beginnings."""
    words, start, end = word_hashes(text, bare=True)
    if len(words) == 0:
        return np.empty(0, np.int32)
    raw = (text or "").encode("utf-8", "surrogatepass")
    found = [words]
    lowered = np.frombuffer(raw.lower() + bytes(8), np.uint8).astype(np.uint64)
    size = end - start
    begun = np.zeros(len(start), np.uint64)
    for k in range(6):
        begun = begun * MULTIPLIER + lowered[start + k] + np.uint64(1)
        if k >= 3:
            found.append(mixed(begun[size > k] + np.uint64(k)))
    return np.unique((np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int32))


def swapped(sentence: str, terms: dict[str, list[str]] = _SWAPS) -> list[str]:
    """The sentence with its identity terms swapped, one copy for each alternative of the first."""
    first = next((w[0].lower() for w in _WORD.finditer(sentence) if w[0].lower() in terms), None)
    if first is None:
        return []

    def swap(way: int):
        return _WORD.sub(
            lambda w: (others := terms.get(w[0].lower())) and others[way % len(others)] or w[0],
            sentence,
        )
    return [swap(way) for way in range(len(terms[first]))]


def swaps(text: str | None, terms: dict[str, list[str]] = _SWAPS) -> list[tuple[np.ndarray, np.ndarray]]:
    """(features lost, features won) by each swap in the sentences of a text."""
    out = []
    for sentence in _SENTENCE.split(text or ""):
        for other in swapped(sentence, terms):
            before, after = features(sentence), features(other)
            out.append((np.setdiff1d(before, after), np.setdiff1d(after, before)))
    return out


def packed(text: str | None) -> np.ndarray:
    """Features of a text, then its swaps, as one integer array: each part behind its length."""
    own = features(text)
    parts = [np.array([len(own)], np.int32), own]
    for lost, won in swaps(text):
        parts += [np.array([len(lost)], np.int32), lost, np.array([len(won)], np.int32), won]
    return np.concatenate(parts).astype(np.int32)


def unpacked(row: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    parts, at = [], 0
    while at < len(row):
        parts.append(row[at + 1:at + 1 + row[at]])
        at += 1 + int(row[at])
    return parts[0], list(zip(parts[1::2], parts[2::2]))


def evidence(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Smoothed log ratio of a feature's rates in toxic and other rows; 0 where it is not clear."""
    def rates(kind: int) -> tuple[np.ndarray, int]:
        own = [row for row, label in zip(rows, labels) if label == kind]
        return np.bincount(np.concatenate(own), minlength=1 << BITS) + 0.5, len(own) + 1

    (toxic, n_toxic), (other, n_other) = rates(1), rates(0)
    ratio = np.log(toxic / n_toxic) - np.log(other / n_other)
    clear = (toxic > 2) & (ratio > EVIDENCE * np.sqrt(1 / toxic + 1 / other))
    return np.where(clear, ratio, 0.0)


class _Sparse:
    """Rows of feature numbers, valued by ``ratio`` and a sign, for products with dense vectors."""

    def __init__(
        self, rows: list[np.ndarray], ratio: np.ndarray, signs: list[np.ndarray] | None = None,
    ):
        self.n = len(rows)
        self.row = np.repeat(np.arange(self.n), [len(r) for r in rows])
        self.at = np.concatenate(rows) if rows else np.empty(0, np.int32)
        self.value = ratio[self.at] * (np.concatenate(signs) if signs else 1.0)
        used = self.value != 0
        self.row, self.at, self.value = self.row[used], self.at[used], self.value[used]

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.at] * self.value, minlength=self.n)

    def back(self, errors: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, errors[self.row] * self.value, minlength=1 << BITS)


def fit(
    rows: list[np.ndarray], labels: np.ndarray,
    changes: list[tuple[np.ndarray, np.ndarray]] = (), penalty: float = PENALTY,
) -> np.ndarray:
    """Weights (the last is the intercept): logistic loss + ridge + penalty * mean(change ** 2).

    Only evidence for toxicity counts: features clearly commoner in toxic documents, each valued by
    its log ratio (the published weights hold the product). So a long text does not outweigh an
    insult by its other words. Classes weigh the same. Without rows of both classes the weights
    are 0, with an intercept that says "not toxic".
    """
    weights = np.zeros((1 << BITS) + 1)
    if len(set(labels.tolist())) < 2:
        weights[-1] = -1.0
        return weights
    ratio = evidence(rows, labels)
    x = _Sparse(rows, ratio)
    d = _Sparse(
        [np.concatenate(c) for c in changes], ratio,
        [np.concatenate([-np.ones(len(a)), np.ones(len(b))]) for a, b in changes],
    ) if len(changes) else None
    share = np.where(labels == 1, 0.5 / (labels == 1).sum(), 0.5 / (labels == 0).sum())
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, STEPS + 1):
        away = np.clip(x.times(weights[:-1]) + weights[-1], -50, 50)
        error = (1 / (1 + np.exp(-away)) - labels) * share
        slope = np.append(x.back(error) + RIDGE * weights[:-1], error.sum())
        if d is not None:
            slope[:-1] += d.back(2 * penalty * d.times(weights[:-1]) / d.n)
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        weights -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    weights[:-1] *= ratio
    return weights


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> np.ndarray:
    """Fit on at most ``PER_CLASS`` labelled documents of each class and their swaps."""
    held, known = labelled_sample(docs, labels, label, PER_CLASS, packed)
    parts = [unpacked(row) for row in held]
    return fit([own for own, _ in parts], known, [c for _, changed in parts for c in changed])


def scorer(weights: np.ndarray):
    """A column function: the probability that a text is toxic (null counts as empty)."""
    light = weights.astype(np.float32)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        away = np.array([float(light[features(t)].sum()) + float(light[-1]) for t in texts], float)
        return pd.Series(1 / (1 + np.exp(-np.clip(away, -700, 700))))

    def column(text: Column) -> Column:
        return score(text)
    return column


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Repeated rows and ties get equal scores; a null or empty text gets the score of the intercept;
    a null id is in fold 0. Other columns are left out. An empty table gives no rows; without
    labels of both classes every score says "not toxic".
    """
    return scored(docs, scorer(train(docs, labels)), THRESHOLD)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document."""
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
