"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased; what is no letter or mark counts as a blank, runs of blanks as one, and each
text begins and ends with one. All grams of ``SIZES`` characters (but a lone blank) are hashed into
``BUCKETS``. Training counts grams and documents per language over all training rows: each task adds
up one vector per language, vectors are added again by hash of their task, and the driver gets one
vector per language and adding task. The matrix of log probabilities is broadcast. Scoring is a
product of the sparse gram rows of a batch with that matrix, in numpy.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from snapstar.llm.pieces import slices
from snapstar.llm.text import fold, table

SIZES = (1, 2, 3)
#: Hashes are of 32 bits, of which the upper 16 are the bucket.
BUCKETS = 1 << 16
_FACTOR = np.uint32(0x9E3779B1)
#: What every gram counts more than seen.
SMOOTHING = 0.5
#: More distinct languages than this are an error: the matrix is broadcast.
MOST_LANGUAGES = 512
#: Tasks that add up the vectors of all others; each sends a vector per language to the driver.
ADDERS = 16
UNDETERMINED = "und"
FOLDS, HELD_OUT = 4, 2


@cache
def kinds() -> np.ndarray:
    """0 for code points that separate words, 1 for letters, 2 for marks."""
    named = (unicodedata.category(chr(k))[0] for k in range(0x110000))
    return np.fromiter(((c == "L") + 2 * (c == "M") for c in named), np.uint8, 0x110000)


def grams(texts: list[str | None]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(for each size the buckets of the grams by place, where each text starts, has it a letter).

    A place whose gram would reach into the next text, or is a lone blank, has the bucket
    ``BUCKETS``, which counts nothing.
    """
    padded = [f" {(text or '').lower()} " for text in texts]
    raw = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter(map(len, padded), np.int64, len(padded))
    starts = np.cumsum(sizes) - sizes
    kind = kinds()[raw]
    letters = np.add.reduceat(kind == 1, starts) > 0 if len(starts) else np.zeros(0, bool)
    blank = kind == 0
    stays = np.ones(len(raw), bool)
    stays[1:] = ~(blank[1:] & blank[:-1])
    stays[starts] = True
    starts = (np.cumsum(stays) - 1)[starts]
    letter = np.where(blank, np.uint32(0x20), raw)[stays]
    total = len(letter)
    following = np.concatenate([starts[1:], [total]])
    value, out = np.zeros(total, np.uint32), []
    for size in range(1, max(SIZES) + 1):
        value *= _FACTOR
        value[:max(total - size + 1, 0)] += letter[size - 1:]
        if size in SIZES:
            bucket = value + np.uint32(size)
            bucket ^= bucket >> np.uint32(15)
            bucket *= _FACTOR
            bucket = (bucket >> np.uint32(16)).astype(np.int32)
            if size == 1:
                bucket[letter == 0x20] = BUCKETS
            for back in range(1, size):
                bucket[np.maximum(following - back, starts)] = BUCKETS
            out.append(bucket)
    return out, starts, letters


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per language of this task: counts by bucket, the number of documents last."""
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        texts, names = batch.column(1).to_pylist(), batch.column(0).to_pylist()
        for part in slices(texts):
            by_name: dict[str, list[str | None]] = {}
            for name, text in zip(names[part], texts[part]):
                by_name.setdefault(name, []).append(text)
            for name, held in by_name.items():
                if name not in totals:
                    _checked(len(totals) + 1)
                    totals[name] = np.zeros(BUCKETS + 1, np.int64)
                for bucket in grams(held)[0]:
                    totals[name][:BUCKETS] += np.bincount(bucket, minlength=BUCKETS + 1)[:BUCKETS]
                totals[name][BUCKETS] += len(held)
    yield from _vectors(totals)


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for name, counts in zip(batch.column("lang").to_pylist(), batch.column("counts")):
            vector = np.frombuffer(counts.as_buffer(), np.int64)
            if name in totals:
                totals[name] += vector
            else:
                _checked(len(totals) + 1)
                totals[name] = vector.copy()
    yield from _vectors(totals)


def _vectors(totals: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get().partitionId()
    for name, vector in sorted(totals.items()):
        yield pa.RecordBatch.from_arrays([
            pa.array([task], pa.int64()), pa.array([name]), pa.array([vector.tobytes()], pa.binary()),
        ], names=["task", "lang", "counts"])


def _checked(languages: int) -> None:
    if languages > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")


class Model:
    """Names in order, and for each its prior and its log probabilities by bucket (the last: none)."""

    def __init__(self, totals: dict[str, np.ndarray]):
        self.names = sorted(totals)
        counts = np.array([totals[name] for name in self.names], float).reshape(-1, BUCKETS + 1)
        seen = counts[:, :BUCKETS] + SMOOTHING
        self.logs = np.hstack([
            np.log(seen / seen.sum(1, keepdims=True)), np.zeros((len(self.names), 1))])
        self.priors = np.log(counts[:, BUCKETS] / max(counts[:, BUCKETS].sum(), 1))

    def sums(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(log probability of each text and language, whether the text has a letter)."""
        buckets, starts, letters = grams(texts)
        out = np.repeat(self.priors[None], len(texts), 0)
        for k, row in enumerate(self.logs if len(texts) else ()):
            for bucket in buckets:
                out[:, k] += np.add.reduceat(row[bucket], starts)
        return out, letters

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The likeliest language of each text and its posterior probability."""
        sums, letters = self.sums(texts)
        if not self.names:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        best = sums.argmax(1)
        score = 1 / np.exp(sums - sums.max(1, keepdims=True)).sum(1)
        names = [self.names[k] if held else UNDETERMINED for k, held in zip(best, letters)]
        return names, np.where(letters, score, 0.0)


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Counts over all rows with a language. Null and empty texts count as documents of theirs."""
    vectors = docs.where(F.col(lang).isNotNull()).select(
        F.col(lang).cast("string").alias("_lang"), F.col(text).alias("_text")
    ).mapInArrow(_counted, "task long, lang string, counts binary")
    rows = vectors.repartition(ADDERS, "task").mapInArrow(_added, vectors.schema)
    totals: dict[str, np.ndarray] = {}
    for row in rows.toLocalIterator():
        vector = np.frombuffer(row["counts"], np.int64)
        totals[row["lang"]] = totals.get(row["lang"], 0) + vector
        _checked(len(totals))
    return Model(totals)


def identify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score) for every row of ``docs``.

    Texts that are null or without a letter are ``und`` with score 0, and so is every text if
    nothing was learned. Of equally likely languages the first by name is taken. Very long texts are
    scored whole, in slices of their own. Repeated and null keys stay rows of their own, other columns
    are left out, an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for part in slices(texts):
                names, score = shared.value.predict(texts[part])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(part.start, part.stop - part.start),
                    pa.array(names, pa.string()), pa.array(score, pa.float64()),
                ], names=["_key", "lang_pred", "score"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).mapInArrow(
        scored, f"_key {kind}, lang_pred string, score double"
    ).withColumnRenamed("_key", key)


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document; a quarter of the documents is never learned from."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(fold(F.col("doc_id"), FOLDS) != HELD_OUT))
    return identify(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score")
