"""Words, folds and word hashes shared by the operators.

Words are runs of bytes other than ASCII white space (``[^\\x20\\x09-\\x0D]+``); only A-Z are
lower-cased. Both hold for the SQL expressions and for the byte-wise numpy form below.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BLANK = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text as an array; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANK), lambda word: word != "")


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key written as text, modulo ``folds``; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds


def byte_words(text: str | None) -> list[bytes]:
    """Lower-cased words as bytes; bytes.split and bytes.lower know ASCII only."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


# Odd multiplier and its inverse modulo 2**64, for hashes of words by differences of prefix sums.
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_BLANK_BYTES = np.zeros(256, bool)
_BLANK_BYTES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_STRIPPED = np.zeros(256, bool)
_STRIPPED[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_VALUES[ord("A"):ord("Z") + 1] = _VALUES[ord("a"):ord("z") + 1]


_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(way: str, count: int) -> np.ndarray:
    """The first powers of the multiplier or of its inverse; kept, as long as the longest text."""
    if len(_POWERS[way]) < count:
        out = np.full(max(count, 4096), MULTIPLIER if way == "up" else _INVERSE, np.uint64)
        out[0] = 1
        _POWERS[way] = np.multiply.accumulate(out)
    return _POWERS[way][:count]


def word_hashes(text: str | None, bare: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, start, end in bytes) of the words of one text, without a loop over words.

    With ``bare``, ASCII punctuation separates nothing and is left out of the hash; words of
    punctuation alone disappear.
    """
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    inside = ~_BLANK_BYTES[raw]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    start, end = edges[::2], edges[1::2]
    values = _VALUES[raw]
    if bare:
        skip = _STRIPPED[raw]
        values = np.where(skip, np.uint64(0), values)
        # Letters are numbered without the punctuation between them.
        place = np.concatenate(([0], np.cumsum(~skip)))
        powers = _powers("up", len(raw) + 1)
        sums = np.concatenate(([np.uint64(0)], np.cumsum(values * powers[place[:-1]], dtype=np.uint64)))
        size = place[end] - place[start]
        hashes = (sums[end] - sums[start]) * _powers("down", len(raw) + 1)[place[start]]
        some = size > 0
        start, end, hashes, size = start[some], end[some], hashes[some], size[some]
    else:
        sums = np.concatenate((
            [np.uint64(0)], np.cumsum(values * _powers("up", len(raw)), dtype=np.uint64)
        ))
        hashes = (sums[end] - sums[start]) * _powers("down", len(raw) + 1)[start]
        size = end - start
    return mixed(hashes + size.astype(np.uint64)), start, end


def shingles(hashes: np.ndarray, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of ``size`` consecutive words; a shorter text is one shingle."""
    if len(hashes) == 0:
        return np.empty(0, np.uint64)
    width = min(size, len(hashes))
    out = np.full(len(hashes) - width + 1, np.uint64(width))
    for k in range(width):
        out = mixed(out * MULTIPLIER + hashes[k:len(hashes) - width + 1 + k])
    return np.unique(out)
