"""Periodic runs of words, found by block convolution.

A run is a longest stretch of words with smallest period q (words q apart are equal) of at least
``LEAST_WORDS`` words and ``LEAST_PERIODS`` periods. At scale B = 8, 16, 32, ... the words are cut
into aligned blocks of B. A run of a period in [B, 2B) holds a whole block whose next occurrence
lies that period further on. For all blocks of a scale at once, a number-theoretic transform gives
the sums of squared differences between a block and every place of the window behind it; a sum of
zero is an occurrence, its distance a seed. Seeds are joined to chains, extended to both sides by
bisection over prefix hashes, and the stretches found are compared word by word. (Sums are taken
modulo a prime and prefix hashes modulo 2**64, so both can only find too much: what the word by
word comparison refuses is searched anew, directly.)

A document is worked on where it is read; nothing is shuffled. Texts are taken together in slices of
about ``LETTERS`` letters and blocks in groups of ``CELLS`` numbers, so what a task holds grows only
with its longest text.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from snapstar.llm.pieces import slices
from snapstar.llm.text import MULTIPLIER, mixed, table, words

LEAST_WORDS, LEAST_PERIODS = 24, 3
#: The smallest block. With runs of 24 words or more it serves all periods up to 15.
BLOCK = 8
#: Numbers in one group of transforms.
CELLS = 1 << 17
#: A prime that is 1 modulo 2**27, below 2**31, and a generator of its units.
PRIME, GENERATOR = 15 * 2**27 + 1, 31
_P = np.uint64(PRIME)
RUNS = "array<struct<start: long, length: long, period: long>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def rest(values: np.ndarray) -> np.ndarray:
    """Values modulo the prime (a division by a scalar and a product are faster than ``%``)."""
    return values - values // _P * _P


@cache
def roots(size: int, inverse: bool = False) -> list[np.ndarray]:
    """Powers of the roots of unity of each butterfly level, the longest level first."""
    root = pow(GENERATOR, (PRIME - 1) // size, PRIME)
    root = pow(root, -1, PRIME) if inverse else root
    powers = np.ones(1, np.uint64)
    while len(powers) < size // 2:
        step = np.uint64(pow(root, len(powers), PRIME))
        powers = np.concatenate([powers, rest(powers * step)])
    return [powers[::1 << k].reshape(1, -1, 1) for k in range(size.bit_length() - 1)]


def transform(columns: np.ndarray) -> None:
    """Number-theoretic transform of each column in place; the rows come out bit-reversed."""
    for powers in roots(len(columns)):
        view = columns.reshape(-1, 2, powers.shape[1], columns.shape[1])
        low, high = view[:, 0], view[:, 1]
        total, difference = low + high, low + (_P - high)
        view[:, 0] = np.minimum(total, total - _P)
        view[:, 1] = rest(difference * powers)


def restored(columns: np.ndarray) -> None:
    """The inverse of ``transform`` in place, without the division by the length."""
    for powers in reversed(roots(len(columns), True)):
        view = columns.reshape(-1, 2, powers.shape[1], columns.shape[1])
        low, high = view[:, 0], rest(view[:, 1] * powers)
        total, difference = low + high, low + (_P - high)
        view[:, 0] = np.minimum(total, total - _P)
        view[:, 1] = np.minimum(difference, difference - _P)


@cache
def places(size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each bit-reversed row: the row of the negated frequency, and whether it is odd."""
    bits = size.bit_length() - 1
    frequency = np.zeros(size, np.int64)
    for k in range(bits):
        frequency |= ((np.arange(size) >> k) & 1) << (bits - 1 - k)
    row_of = np.empty(size, np.int64)
    row_of[frequency] = np.arange(size)
    return row_of[-frequency % size], (frequency % 2 == 1)[:, None]


class Words:
    """The words of several texts as numbers, each text followed by a number of its own."""

    def __init__(self, texts: list[np.ndarray], first_free: int):
        sizes = np.array([len(t) for t in texts], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        self.ends = self.starts + sizes
        longest = int(sizes.max())
        self.top = BLOCK
        while LEAST_PERIODS * 2 * self.top <= longest:
            self.top *= 2
        total = int(self.ends[-1]) + 1
        self.values = np.zeros(total + 4 * self.top, np.uint64)
        for start, end, numbers in zip(self.starts, self.ends, texts):
            self.values[start:end] = numbers
        self.values[self.ends] = first_free + np.arange(len(texts), dtype=np.uint64)
        self.text_of = np.repeat(np.arange(len(texts)), sizes + 1)
        self.squares = np.concatenate([
            np.zeros(1, np.uint64), np.cumsum(rest(self.values * self.values), dtype=np.uint64)])
        powers = np.full(len(self.values), MULTIPLIER, np.uint64)
        powers[0] = 1
        self.powers = np.multiply.accumulate(powers)
        self.sums = np.concatenate([
            np.zeros(1, np.uint64),
            np.cumsum(mixed(self.values) * self.powers, dtype=np.uint64)])

    def same(self, at: np.ndarray, length: np.ndarray, distance: np.ndarray) -> np.ndarray:
        """Whether ``length`` words from ``at`` hash like those ``distance`` further on."""
        here = (self.sums[at + length] - self.sums[at]) * self.powers[distance]
        return here == self.sums[at + distance + length] - self.sums[at + distance]

    def blocks(self, size: int) -> np.ndarray:
        """Starts of the aligned blocks that can begin a seed of this scale."""
        start = np.arange(0, len(self.text_of) - size, size)
        text = self.text_of[start]
        least = max(LEAST_WORDS, LEAST_PERIODS * size if size > BLOCK else 0)
        nearest = 1 if size == BLOCK else size
        return start[(start + size + nearest <= self.ends[text])
                     & (self.ends[text] - self.starts[text] >= least)]

    def seeds(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(block start, distance) of the occurrences of blocks in the windows behind them."""
        found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        start, step = self.blocks(size), max(1, CELLS // (2 * size))
        for first in range(0, len(start), step):
            found += self._occurrences(start[first:first + step] // size, size)
        return tuple(np.concatenate(part) for part in zip(*found))

    def _occurrences(self, block: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        needed = np.unique(np.concatenate([block, block + 1, block + 2]))
        columns = np.zeros((2 * size, len(needed)), np.uint64)
        columns[:size] = self.values[:len(self.values) // size * size].reshape(-1, size)[needed].T
        transform(columns)
        at = np.searchsorted(needed, block)
        negated, odd = places(2 * size)
        pattern = columns[negated][:, at]
        start = block * size
        # Distances below the block only at the first scale; then the window begins with the block.
        for ahead in (0, 1) if size == BLOCK else (1,):
            near = columns[:, at if ahead == 0 else np.searchsorted(needed, block + 1)]
            far = columns[:, np.searchsorted(needed, block + 1 + ahead)]
            # A shift by half the length changes the sign of the odd frequencies.
            window = near + np.where(odd, _P - far, far)
            product = rest(pattern * rest(window))
            restored(product)
            distance = np.arange(size) + ahead * size
            places_ = start + distance[:, None]
            squares = (
                self.squares[start + size] - self.squares[start]
                + self.squares[places_ + size] - self.squares[places_])
            # Twice the correlation, times the length that ``restored`` leaves in.
            equal = rest(rest(squares) * np.uint64(size)) == product[:size]
            if ahead == 0:
                equal[0] = False
            row, column = np.nonzero(equal)
            yield start[column], distance[row]

    def chains(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first block start, end of the last block, distance) of seeds joined over blocks."""
        start, distance = self.seeds(size)
        order = np.lexsort((start, distance))
        start, distance = start[order], distance[order]
        new = np.ones(len(start), bool)
        new[1:] = (np.diff(distance) != 0) | (np.diff(start) != size)
        last = np.ones(len(start), bool)
        last[:-1] = new[1:]
        return start[new], start[last] + size, distance[new]

    def longest(self, at: np.ndarray, most: np.ndarray, distance: np.ndarray, back: bool):
        """How many words from (or before) ``at`` equal those ``distance`` further on."""
        low, high = np.zeros(len(at), np.int64), np.maximum(most, 0)
        while (low < high).any():
            middle = (low + high + 1) // 2
            equal = self.same(at - middle if back else at, middle, distance)
            low = np.where(equal, middle, low)
            high = np.where(equal, high, middle - 1)
        return low

    def direct(self, text: int, distance: int) -> list[tuple[int, int, int]]:
        """All stretches of a text with a period, by comparing all its words."""
        start, end = int(self.starts[text]), int(self.ends[text])
        equal = self.values[start:end - distance] == self.values[start + distance:end]
        edges = np.flatnonzero(np.diff(np.concatenate(([False], equal, [False])).view(np.int8)))
        return [
            (start + int(a), start + int(b) + distance, distance)
            for a, b in zip(edges[::2], edges[1::2])
            if b - a + distance >= max(LEAST_WORDS, LEAST_PERIODS * distance)
        ]

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, end, period) of all runs, by start, then period."""
        period: dict[tuple[int, int], int] = {}
        size = BLOCK
        while size <= self.top:
            first, last, distance = self.chains(size)
            if period and len(first):
                # What lies in a run of a smaller period has multiples of that period only.
                known = np.array(sorted(period))
                reach = np.maximum.accumulate(known[:, 1])
                before = np.searchsorted(known[:, 0], first, "right")
                open_ = (before == 0) | (reach[before - 1] < last + distance)
                first, last, distance = first[open_], last[open_], distance[open_]
            text = self.text_of[first]
            start = first - self.longest(first, first - self.starts[text], distance, True)
            end = last + distance + self.longest(
                last, self.ends[text] - distance - last, distance, False)
            long = end - start >= np.maximum(LEAST_WORDS, LEAST_PERIODS * distance)
            found = set(zip(*(x[long].tolist() for x in (start, end, distance, text))))
            for a, b, d, t in sorted(found):
                exact = np.array_equal(self.values[a:b - d], self.values[a + d:b])
                for a, b, d in [(a, b, d)] if exact else self.direct(t, d):
                    period[a, b] = min(d, period.get((a, b), d))
            size *= 2
        return sorted((a, b, d) for (a, b), d in period.items())


def found_runs(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each text, by start, then period."""
    number = defaultdict(count(1).__next__)
    chosen = [k for k, held in enumerate(texts) if len(held) >= LEAST_WORDS]
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if chosen:
        numbers = [
            np.fromiter(map(number.__getitem__, texts[k]), np.uint64, len(texts[k])) for k in chosen
        ]
        held = Words(numbers, len(number) + 1)
        for start, end, period in held.runs():
            text = held.text_of[start]
            out[chosen[text]].append((start - int(held.starts[text]), end - start, period))
    return out


def collapsed(held: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by blanks."""
    if runs:
        stays = np.ones(len(held), bool)
        for start, length, period in runs:
            stays[start + period:start + length] = False
        held = [held[k] for k in np.flatnonzero(stays)]
    return b" ".join(held)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).to_pylist()
        for part in slices(texts):
            split = [(text or "").encode("utf-8", "surrogatepass").split() for text in texts[part]]
            runs = found_runs(split)
            flat = np.array([run for held in runs for run in held], np.int64).reshape(-1, 3)
            ends = np.concatenate([[0], np.cumsum([len(held) for held in runs])])
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(part.start, part.stop - part.start),
                pa.array([len(held) for held in split], pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.StructArray.from_arrays(
                    [pa.array(flat[:, k]) for k in range(3)], fields=list(_RUN))),
                pa.array([collapsed(*pair) for pair in zip(split, runs)], pa.binary()).cast(
                    pa.string()),
            ], names=["_key", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, runs, collapsed) for every row of ``docs``.

    ``runs`` are structs of start (word number), length and period, by start, then period;
    ``collapsed`` is the text with one blank between words, of which each run keeps its first period.
    Null, empty and blank texts have no words, no runs and an empty collapsed text. A very long text
    is worked on alone and whole, in memory in proportion to its words (up to 2**27 of a period).
    Rows with equal or null keys stay rows of their own; other columns are left out, so their names
    cannot clash; an empty table gives no rows.
    """
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).mapInArrow(
        _runs, f"_key {kind}, n_words long, runs {RUNS}, collapsed string"
    ).withColumnRenamed("_key", key)


def planted(key: Column, text: Column) -> Column:
    """The text; of a tenth of the keys with a repetition from some word on, by the key's crc32."""
    h = F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)
    held = words(text)
    n = F.size(held)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    repeated = F.flatten(F.array_repeat(F.slice(held, a + 1, p), F.ceil((n - a) / p).cast("int")))
    return F.when((h % 10 == 0) & (n > 0), F.array_join(
        F.concat(F.slice(held, F.lit(1), a), F.slice(repeated, F.lit(1), n - a)), " "
    )).otherwise(text)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the runs and of the collapsed text of every document, and its strongest run."""
    docs = table(spark, sf_dir, "documents")
    found = periodic_runs(docs.select(
        "doc_id", planted(F.col("doc_id"), F.col("text")).alias("text")))
    # The greatest length / period: fractions are compared without rounding.
    stronger = (
        "(l, r) -> CASE WHEN l.length * r.period <> r.length * l.period"
        " THEN IF(l.length * r.period > r.length * l.period, -1, 1)"
        " WHEN l.start <> r.start THEN IF(l.start < r.start, -1, 1)"
        " ELSE CAST(signum(l.period - r.period) AS INT) END")
    best = F.try_element_at(F.expr(f"array_sort(runs, {stronger})"), F.lit(1))
    line = lambda run: F.concat_ws(",", run.start, run.length, run.period)
    listed = F.concat(F.array_join(F.transform("runs", line), "\n"), F.lit("\n"))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") == 0, "").otherwise(listed), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
