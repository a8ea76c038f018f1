"""Language-model scores by a class-based bigram model.

The ``HEAD`` most frequent words are units of their own, the others are units by their ending
(last three bytes, hashed); exchange clustering moves units between ``CLASSES`` classes as long as
the likelihood of class bigrams grows, so every word has a class. A text's probability is the
product of class transitions and word emissions, P(class | class before) * P(word | class), both
smoothed; each class holds one unknown word that gets the discount of its known ones.

All counts cover all training documents. Word counts and unit bigrams are summed by Spark; the
driver sees only tables bounded by parameters: the ``UNITS`` ** 2 bigram cells and the ``NEAR``
most frequent words (of at most ``NEAR_BYTES``), which are broadcast with their counts. Words
beyond those meet their counts in a join: a task adds up what it knows and sends on the rest.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from snapstar.llm.text import byte_words, fold, table
from snapstar.session import new_folder

HELD_OUT_FOLDS, HELD_OUT = 7, 2
HEAD, ENDINGS, CLASSES = 1536, 511, 64
#: Units: head words, endings, and the end of a text.
END = HEAD + ENDINGS
UNITS = END + 1
NEAR, NEAR_BYTES = 200_000, 64
DISCOUNT, PRIOR, SWEEPS = 0.5, 10.0, 6


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter[bytes] = Counter()
        for text in batch.column(0):
            counts.update(byte_words(text.as_py()))
        counts[b""] += batch.num_rows  # the end of a text; no word is empty
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
            names=["word", "n"])


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over a one-column frame of texts; the empty word counts the ends."""
    return texts.mapInArrow(_count_words, "word binary, n long").groupBy("word").agg(
        F.sum("n").alias("n"))


class _Units(dict):
    """Word -> unit; words outside the head by their ending."""

    def __missing__(self, word: bytes) -> int:
        return HEAD + zlib.crc32(word[-3:]) % ENDINGS


def unit_bigrams(texts: DataFrame, head: list[bytes]) -> DataFrame:
    """(cell, n): counts of neighbouring units, cell = first * UNITS + second."""
    held = {word: unit for unit, word in enumerate(head)} | {b"": END}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit_of, total = _Units(held).__getitem__, np.zeros(UNITS**2, np.int64)
        for batch in batches:
            line, size = [np.array([END])], 0
            for text in batch.column(0):
                line.append(np.fromiter(map(unit_of, byte_words(text.as_py())), np.int64))
                line.append(line[0])
                size += len(line[-2])
                if size > 1_000_000:
                    _add(total, line)
                    line, size = [line[0]], 0
            _add(total, line)
        cells = np.flatnonzero(total)
        for part in np.array_split(cells, len(cells) // 200_000 + 1):
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), pa.array(total[part])], names=["cell", "n"])

    return texts.mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))


def _add(total: np.ndarray, line: list[np.ndarray]) -> None:
    units = np.concatenate(line)
    cells, n = np.unique(units[:-1] * UNITS + units[1:], return_counts=True)
    total[cells] += n


def _g(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def exchange(counts: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each unit; the last unit, the end of a text, is a class of its own.

    Units are visited by frequency; each moves to the class where the likelihood of the class
    bigrams is greatest (the lowest of equals), until a sweep moves none.
    """
    units = len(counts)
    own = counts.sum(0)
    order = np.argsort(-own[:-1], kind="stable")
    order = order[own[order] > 0]
    of = np.zeros(units, np.int64)
    of[order] = np.arange(len(order)) % classes
    of[-1] = classes
    wide = classes + 1
    member = np.zeros((units, wide))
    member[np.arange(units), of] = 1
    table_ = member.T @ counts @ member
    for _ in range(sweeps):
        moved = 0
        for u in order:
            a = of[u]
            right = np.bincount(of, counts[u], wide)
            left = np.bincount(of, counts[:, u], wide)
            self_ = counts[u, u]
            right[a] -= self_
            left[a] -= self_
            table_[a] -= right
            table_[:, a] -= left
            table_[a, a] -= self_
            rows, columns = table_.sum(1), table_.sum(0)
            gain = (_g(table_ + right) - _g(table_)).sum(1)
            gain += (_g(table_ + left[:, None]) - _g(table_)).sum(0)
            corner = np.diag(table_)
            gain += _g(corner + right + left + self_) + _g(corner)
            gain -= _g(corner + right) + _g(corner + left)
            gain -= _g(rows + right.sum() + self_) - _g(rows)
            gain -= _g(columns + left.sum() + self_) - _g(columns)
            gain[-1] = -np.inf
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + 1e-6:
                b = a
            table_[b] += right
            table_[:, b] += left
            table_[b, b] += self_
            of[u] = b
            moved += a != b
        if not moved:
            break
    return of


@dataclass(frozen=True)
class ClassModel:
    """What a task needs: head units, classes, log10 transitions, class sizes, near counts."""

    head: list[bytes]
    of: np.ndarray
    step: np.ndarray
    #: log10 of a class's tokens, and of what its unknown word gets before division by them.
    tokens: np.ndarray
    unknown: np.ndarray
    near: dict[bytes, int]
    total: int
    distinct: int

    @property
    def base(self) -> float:
        return float(np.log10(self.total + self.distinct + 1))


def train(texts: DataFrame) -> tuple[ClassModel, DataFrame]:
    """The model of a one-column frame of training texts, and its (word, n) table."""
    spark = texts.sparkSession
    folder = new_folder(spark, "word-counts")
    word_counts(texts).write.parquet(folder)
    counts = spark.read.schema("word binary, n long").parquet(folder)
    near = counts.where((F.length("word") <= NEAR_BYTES) & (F.length("word") > 0)).orderBy(
        F.desc("n"), "word").limit(NEAR).toArrow()
    near = list(zip(near["word"].to_pylist(), near["n"].to_pylist()))
    head = [word for word, _ in near[:HEAD]]
    heads = spark.createDataFrame(
        [(word, unit) for unit, word in enumerate(head)] + [(b"", END)], "word binary, unit int")
    ending = (F.crc32(F.substring("word", -3, 3)) % ENDINGS + HEAD).cast("int")
    sizes = counts.join(F.broadcast(heads), "word", "left").groupBy(
        F.coalesce("unit", ending).alias("unit")
    ).agg(F.sum("n").alias("n"), F.count("*").alias("types")).collect()
    cells = unit_bigrams(texts, head).toArrow()
    bigrams = np.zeros(UNITS**2)
    bigrams[cells["cell"].to_numpy()] = cells["n"].to_numpy()
    bigrams = bigrams.reshape(UNITS, UNITS)
    of = exchange(bigrams)
    n, types = np.zeros(CLASSES + 1), np.zeros(CLASSES + 1)
    for row in sizes:
        n[of[row["unit"]]] += row["n"]
        types[of[row["unit"]]] += row["types"]
    member = np.zeros((UNITS, CLASSES + 1))
    member[np.arange(UNITS), of] = 1
    pairs = member.T @ bigrams @ member
    # Each class is expected a little, so that no transition is impossible.
    expected = (n + 1) / (n.sum() + len(n))
    step = np.log10((pairs + PRIOR * expected) / (pairs.sum(1, keepdims=True) + PRIOR))
    return ClassModel(
        head, of, step, np.log10(np.maximum(n, 1)), np.log10(DISCOUNT * np.maximum(types, 1)),
        dict(near) | {b"": int(n[CLASSES])}, int(n.sum()), int(types.sum()),
    ), counts


FLOW = ("_row long, _key {key}, _held_out boolean, n_tokens long, n_known long, base double, "
        "score double, word binary, times long, unknown double")


def _scorer(shared):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: ClassModel = shared.value
        unit_of = _Units({w: u for u, w in enumerate(model.head)} | {b"": END}).__getitem__
        near = model.near
        for batch in batches:
            rows, far = [], []
            for at, text in enumerate(batch.column("_text")):
                words = byte_words(text.as_py())
                words.append(b"")
                of = model.of[np.fromiter(map(unit_of, words), np.int64, len(words))]
                n = np.fromiter((near.get(word, -1) for word in words), np.int64, len(words))
                if model.total == 0:
                    n[:] = 0
                score = model.step[np.concatenate([[CLASSES], of[:-1]]), of].sum()
                score -= model.tokens[of].sum()
                known, none = n > 0, n == 0
                score += np.log10(n[known] - DISCOUNT).sum() + model.unknown[of[none]].sum()
                base = np.log10(n[known] + 1).sum() - len(words) * model.base
                rows.append((len(words), int(known.sum()), base, score))
                strange = np.flatnonzero(n < 0)
                if len(strange):
                    times = Counter(words[k] for k in strange)
                    class_of = {words[k]: int(of[k]) for k in strange}
                    far += [(at, word, m, float(model.unknown[class_of[word]]))
                            for word, m in times.items()]
                if len(far) > 100_000 or at == batch.num_rows - 1:
                    yield from _flow(batch, at + 1 - len(rows), rows, far)
                    rows, far = [], []
    return score


def _flow(batch: pa.RecordBatch, first: int, rows: list, far: list) -> Iterator[pa.RecordBatch]:
    """Document rows, each under a word of its own that no text can hold, then unresolved words."""
    own = batch.slice(first, len(rows))
    ids = own.column("_row").to_pylist()
    n = len(rows)
    yield pa.RecordBatch.from_arrays([
        own.column("_row"), own.column("_key"), own.column("_held_out"),
        *(pa.array(x, kind) for x, kind in zip(
            zip(*rows), (pa.int64(), pa.int64(), pa.float64(), pa.float64()))),
        pa.array([b" %d" % k for k in ids], pa.binary()), pa.array([0] * n, pa.int64()),
        pa.array([0.0] * n),
    ], names=_NAMES)
    if far:
        at, word, times, unknown = zip(*far)
        n = len(far)
        yield pa.RecordBatch.from_arrays([
            batch.column("_row").take(pa.array(at)), pa.nulls(n, batch.column("_key").type),
            pa.nulls(n, pa.bool_()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()),
            pa.nulls(n, pa.float64()), pa.nulls(n, pa.float64()), pa.array(word, pa.binary()),
            pa.array(times, pa.int64()), pa.array(unknown),
        ], names=_NAMES)


_NAMES = [field.split()[0] for field in FLOW.split(", ")]


def scores(
    docs: DataFrame, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score), a row per row.

    Training rows are those whose fold is not ``HELD_OUT``. Null texts count as empty (one token,
    the end); repeated rows train and score each on its own; a null key is in fold 0; other
    columns are left out. Without training tokens every score is that of the base, 0. An empty
    table gives no rows.
    """
    spark = docs.sparkSession
    model, counts = train(docs.where(
        fold(F.col(key), HELD_OUT_FOLDS) != HELD_OUT).select(F.col(text).alias("_text")))
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(key).alias("_key"),
        (fold(F.col(key), HELD_OUT_FOLDS) == HELD_OUT).alias("_held_out"),
        F.col(text).alias("_text"),
    )
    kind = docs.schema[key].dataType.simpleString()
    flow = rows.mapInArrow(_scorer(shared), FLOW.format(key=kind)).join(counts, "word", "left")
    found = F.col("n").isNotNull()
    seen = F.coalesce("n", F.lit(0))
    return flow.groupBy("_row").agg(
        F.max("_key").alias(key), F.max("_held_out").alias("held_out"),
        F.max("n_tokens").alias("n_tokens"),
        (F.sum("n_known") + F.sum(F.when(found, F.col("times")).otherwise(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.sum("base") + F.sum(F.col("times") * F.log10(seen + 1))).alias("base_score"),
        (F.sum("score") + F.sum(F.col("times") * F.when(found, F.log10(seen - DISCOUNT))
                                .otherwise(F.col("unknown")))).alias("_score"),
    ).select(
        key, "held_out", "n_tokens", "n_known", "train_tokens", "base_score",
        (F.col("base_score") if model.total == 0 else F.col("_score")).alias("score"),
    )


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class-model and base scores of every document."""
    return scores(table(spark, sf_dir, "documents"))
