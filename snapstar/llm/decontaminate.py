"""Benchmark decontamination by an embedding of edit distance into Hamming distance.

Texts are words (A-Z in lower case, ASCII punctuation left out). A random walk copies a text's
words one per step and stays or moves on by a random bit of (step, word); two texts of small edit
distance soon walk in step again, so their copies differ in few places. Sampling a few steps of
the copy gives a key; texts that share a key in one of several repetitions are candidates, and
their edit distance is then computed exactly.

Every word of a document starts a window of each item's size. The walks of all windows are
numpy columns; a window is walked on only while its sampled words can still be those of an item,
which is the same as comparing whole keys. Half of the repetitions walk backwards from the end
of the window, so edits gathered at one end of an item do not hide it.

Items of more than ``PART`` words are hashed as overlapping parts of that size, for a long walk
loses step; the edit distance is always that of the whole item.

The number of repetitions follows from the items: copies with random edits at the limit are walked
too, inside a text and at its borders, and each size class of items gets repetitions until
``RECALL`` of its copies are found at each place (exact copies always are). An index that misses
this with ``MOST_REPETITIONS`` is an error.

Items are the broadcast side, in blocks of at most ``BLOCK_WORDS`` words; a larger benchmark takes
one pass over the documents for each block. Documents are never shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from snapstar.llm.text import mixed, table, word_hashes

#: Greatest edit distance, as a share of an item's words; share of edited copies to be found.
MAX_EDITS, RECALL = 0.2, 0.95
BLOCK_WORDS = 2_000_000
MOST_REPETITIONS, TRIALS = 200, 300
PART = 64
#: The first two sampled steps lie within so many, the others anywhere in the item's size class.
HEAD, OTHERS = 8, 2
SLICE_WORDS = 1_000_000
FOUND = "item_id {item}, start long, end long, n_words long, edits long"


def item_class(n: int) -> int:
    """Lower bound of the size class: the largest power of two up to the number of words."""
    return 1 << (n.bit_length() - 1)


class Repetition:
    """One random walk with its sampled steps, and the keys of the items."""

    def __init__(self, seed: int, backwards: bool, items: list[np.ndarray], head: int):
        random = np.random.default_rng(seed)
        self.backwards, self.head = backwards, head
        classes = sorted({item_class(len(item)) for item in items})
        steps = 2 * max(classes)
        self.bits = (random.integers(0, 2**31, steps, np.int64) * 2 + 1).astype(np.uint32)
        # Short classes sample what steps they have.
        first = sorted(random.choice(max(head - 1, 1), min(2, max(head - 1, 1)), replace=False))
        self.first, self.second = int(first[0]), int(first[-1])
        self.others = {}
        for size in classes:
            left = np.arange(self.second + 1, 2 * size)
            self.others[size] = sorted(
                random.choice(left, min(OTHERS, len(left)), replace=False).tolist())
        self.seen_first = np.zeros(1 << 16, bool)
        self.seen_second = np.zeros(1 << 20, bool)
        keys = defaultdict(list)
        for number, item in enumerate(items):
            line = item[::-1] if backwards else item
            padded = np.concatenate([line, np.zeros(steps, np.uint32)]).astype(np.uint32)
            at = np.zeros(1, np.int64)
            at = self.walk(padded, at, 0, self.first)
            one = padded[at]
            at = self.walk(padded, at, self.first, self.second)
            two = padded[at]
            size = item_class(len(item))
            self.seen_first[one & 0xFFFF] = True
            self.seen_second[self.pair(one, two) >> np.uint64(44)] = True
            keys[size].append((int(self.key(
                padded, np.zeros(1, np.int64), at, self.pair(one, two), size)[0]), number))
        self.keys = {
            size: (np.array([k for k, _ in sorted(held)], np.uint64),
                   np.array([number for _, number in sorted(held)]))
            for size, held in keys.items()
        }

    def walk(self, line: np.ndarray, at: np.ndarray, start: int, end: int) -> np.ndarray:
        """Positions after the moves of steps ``start`` to ``end`` - 1."""
        for step in range(start, end):
            at = at + ((line[at] * self.bits[step]) >> np.uint32(31))
        return at

    @staticmethod
    def pair(one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return mixed((one.astype(np.uint64) << np.uint64(32)) | two)

    def key(
        self, line: np.ndarray, start: np.ndarray, at: np.ndarray, pair: np.ndarray, size: int,
    ) -> np.ndarray:
        """The whole key, from where the walk stands at the second sampled step.

        What a walk copies behind ``size`` words, which every item of the class has, is 0.
        """
        done = self.second
        for step in self.others[size]:
            at = self.walk(line, at, done, step)
            at = np.minimum(at, start + size)
            pair, done = mixed(pair + np.where(at < start + size, line[at], np.uint32(0))), step
        return pair

    def candidates(self, line: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(window starts, item numbers) that share a key; ``line`` is padded behind its n words."""
        at = self.walk(line, np.arange(n), 0, self.first)
        one = line[at]
        start = np.flatnonzero(self.seen_first[one & 0xFFFF])
        one, at = one[start], self.walk(line, at[start], self.first, self.second)
        two = line[at]
        pair = self.pair(one, two)
        keep = self.seen_second[pair >> np.uint64(44)]
        start, pair, at = start[keep], pair[keep], at[keep]
        for size, (keys, numbers) in self.keys.items():
            mine = self.key(line, start, at, pair, size)
            low, high = np.searchsorted(keys, mine, "left"), np.searchsorted(keys, mine, "right")
            count = high - low
            hit = np.flatnonzero(count)
            if len(hit):
                rows = np.repeat(hit, count[hit])
                inner = np.arange(len(rows)) - np.repeat(
                    np.cumsum(count[hit]) - count[hit], count[hit])
                yield start[rows], numbers[low[rows] + inner]


class Index:
    """Items with the repetitions that find their edited copies."""

    def __init__(self, ids: list, hashes: list[np.ndarray], max_edits: float, recall: float):
        self.ids, self.hashes, self.max_edits = ids, hashes, max_edits
        self.size = np.array([len(item) for item in hashes], np.int64)
        cuts = [(k, at) for k, n in enumerate(self.size) for at in cut(int(n))]
        self.item_of, self.offset = np.array(cuts, np.int64).T
        self.parts = [hashes[k][at:at + PART].astype(np.uint32) for k, at in cuts]
        self.part_size = np.array([len(part) for part in self.parts], np.int64)
        self.masks: dict[int, tuple[dict, dict]] = {}
        self.repetitions: list[Repetition] = []
        # Items below the head's span sample from fewer steps and need walks of their own.
        spans: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for number, n in enumerate(self.size.tolist()):
            spans[min(HEAD, item_class(n))][item_class(n)].append(number)
        for span, classes in sorted(spans.items()):
            self._add(span, classes, recall)

    def _add(self, span: int, classes: dict[int, list[int]], recall: float) -> None:
        """Repetitions for the items of a span; a class leaves when its copies are found."""
        random = np.random.default_rng(11)
        left = {size: self.trial(numbers, random) for size, numbers in sorted(classes.items())}
        for at in range(MOST_REPETITIONS):
            whose = np.zeros(len(self.size), bool)
            for size in left:
                whose[classes[size]] = True
            own = np.flatnonzero(whose[self.item_of])
            made = Repetition(
                1000 * span + at, bool(at % 2), [self.parts[k] for k in own], span)
            for size, (keys, within) in made.keys.items():
                made.keys[size] = keys, own[within]
            self.repetitions.append(made)
            for size, (copies, numbers, missing) in left.items():
                open_ = np.flatnonzero(missing)
                missing[open_] = ~self.finds(made, [copies[k] for k in open_], numbers[open_])
            if at % 2:
                left = {
                    size: trial for size, trial in left.items()
                    if any(trial[2][place::3].sum() > (1 - recall) * len(trial[2][place::3]) + 1e-9
                           for place in range(3))
                }
            if not left:
                return
        raise ValueError(
            f"{MOST_REPETITIONS} repetitions do not find {recall:.0%} of the edited copies of items of "
            + ", ".join(f"{size} to {2 * size - 1} words" for size in left))

    def trial(self, numbers: list[int], random: np.random.Generator) -> tuple:
        """Copies with the most edits of items that allow any, their items, and which are missing.

        They lie inside a text, at its beginning and at its end in turn.
        """
        tried = random.permutation([k for k in numbers if self.allowed(int(self.size[k]))])
        tried = np.resize(tried, TRIALS * bool(len(tried))).astype(np.int64)
        copies = [
            edited(self.hashes[k], self.allowed(int(self.size[k])), random,
                   before=4 * (at % 3 != 1), behind=4 * (at % 3 != 2))
            for at, k in enumerate(tried)
        ]
        return copies, tried, np.ones(len(copies), bool)

    def finds(
        self, repetition: Repetition, copies: list[np.ndarray], numbers: np.ndarray,
    ) -> np.ndarray:
        """Whether each text, a copy of the item of its number, is found and verified."""
        out = np.zeros(len(copies), bool)
        if not copies:
            return out
        padded, turned, first = self.lined(np.concatenate(copies), copies)
        for text, start, number in self.placed(repetition, padded, turned, first):
            for k in np.flatnonzero(numbers[text] == number):
                t = int(text[k])
                out[t] = out[t] or self.verified(
                    copies[t], int(start[k]), int(number[k])) is not None
        return out

    def lined(
        self, words: np.ndarray, lines: list[np.ndarray],
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words of the lines forwards and backwards, padded, and where each line begins."""
        none = np.zeros(2 * int(self.size.max()) + 2, np.uint32)
        return (np.concatenate([words.astype(np.uint32), none]),
                np.concatenate([words[::-1].astype(np.uint32), none]),
                np.cumsum([0, *map(len, lines)]))

    def allowed(self, n: int) -> int:
        return int(self.max_edits * n)

    def both_masks(self, number: int) -> tuple[dict, dict]:
        """Bit masks of an item's words, forwards and backwards."""
        if number not in self.masks:
            both = ({}, {})
            for masks, line in zip(both, (self.hashes[number], self.hashes[number][::-1])):
                for k, word in enumerate(line.tolist()):
                    masks[word] = masks.get(word, 0) | 1 << k
            self.masks[number] = both
        return self.masks[number]

    def verified(self, words: np.ndarray, start: int, number: int) -> tuple[int, int, int] | None:
        """(start, end, edits) of the nearest stretch to an item around a window, if near enough."""
        n = int(self.size[number])
        most = self.allowed(n)
        low, high = max(0, start - most), min(len(words), start + n + 2 * most)
        forwards, backwards = self.both_masks(number)
        line = words[low:high].tolist()
        edits, end = nearest(forwards, n, line, anchored=False)
        if edits > most:
            return None
        same, length = nearest(backwards, n, line[:end][::-1], anchored=True)
        return low + end - length, low + end, same

    def placed(
        self, repetition: Repetition, padded: np.ndarray, turned: np.ndarray, first: np.ndarray,
    ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(text numbers, window starts in the text, item numbers) that share a key.

        A window belongs to the text of the word where its walk starts. Where the copy has lost
        words, the window of the item may so begin before its text; it is moved to the first word.
        """
        line = turned if repetition.backwards else padded
        for start, part in repetition.candidates(line, int(first[-1])):
            if repetition.backwards:
                start = first[-1] - 1 - start
            text = np.searchsorted(first, start, "right") - 1
            if repetition.backwards:
                start = start + 1 - self.part_size[part]
            start = np.maximum(start - self.offset[part] - first[text], 0)
            yield text, start, self.item_of[part]

    def search(self, lines: list[np.ndarray]) -> Iterator[tuple[int, int, int, int, int]]:
        """(text number, item number, first word, end word, edits) of the stretches found."""
        words = np.concatenate([*lines, np.empty(0, np.uint64)])
        padded, turned, first = self.lined(words, lines)
        hits = [
            np.stack(hit) for repetition in self.repetitions
            for hit in self.placed(repetition, padded, turned, first)
        ]
        if not hits:
            return
        text, start, number = np.unique(np.concatenate(hits, axis=1), axis=1)
        found = set()
        for k in range(len(number)):
            t, item = int(text[k]), int(number[k])
            # A stretch already found around here is not looked for again.
            here = int(start[k])
            if (t, item, here) in found:
                continue
            got = self.verified(words[first[t]:first[t + 1]], here, item)
            if got and (t, item, got[0]) not in found:
                found.update((t, item, at) for at in range(
                    got[0] - self.allowed(int(self.size[item])),
                    got[0] + self.allowed(int(self.size[item])) + 1))
                yield t, item, *got


def cut(n: int) -> list[int]:
    """Where the parts of an item of n words begin; they overlap by half or more."""
    return [(n - PART) * k // max(1, -(-2 * n // PART) - 2) for k in range(
        -(-2 * n // PART) - 1)] if n > PART else [0]


def nearest(masks: dict[int, int], n: int, line: list[int], anchored: bool) -> tuple[int, int]:
    """Least edit distance of a pattern to a stretch of ``line``, and the first end that has it.

    Bit-parallel over the pattern. ``anchored``: the stretch begins where the line does.
    """
    full, top = (1 << n) - 1, 1 << (n - 1)
    up, down, edits = full, 0, n
    best, end = n, 0
    for at, word in enumerate(line, 1):
        equal = masks.get(word, 0)
        level = equal | down
        across = (((equal & up) + up) ^ up) | equal
        rise, fall = down | ~(across | up), up & across
        edits += bool(rise & top) - bool(fall & top)
        rise, fall = (rise << 1 | anchored) & full, fall << 1 & full
        up, down = (fall | ~(level | rise)) & full, rise & level
        if edits < best:
            best, end = edits, at
    return best, end


def edited(
    item: np.ndarray, edits: int, random: np.random.Generator, before: int = 4, behind: int = 4,
) -> np.ndarray:
    """A copy of an item with random words replaced, left out or put in, between strange words."""
    line = item.tolist()
    for _ in range(edits):
        at = int(random.integers(0, len(line) + 1))
        strange = int(random.integers(1, 2**32))
        kind = int(random.integers(0, 3))
        if kind == 0 or not line:
            line.insert(at, strange)
        elif kind == 1:
            line[min(at, len(line) - 1)] = strange
        else:
            del line[min(at, len(line) - 1)]
    around = random.integers(1, 2**32, before + behind).tolist()
    return np.array(around[:before] + line + around[before:], np.uint64)


def _searcher(index: Index):
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, texts = batch["_key"], list(batch["_text"])
            begin, lines, spans, held = 0, [], [], 0
            for k in range(len(texts) + 1):
                if k == len(texts) or held >= SLICE_WORDS:
                    rows = [
                        (begin + t, index.ids[item], *_characters(
                            texts[begin + t], spans[t], first, end), int(index.size[item]), edits)
                        for t, item, first, end, edits in index.search(lines)
                    ]
                    out = pd.DataFrame(
                        rows, columns=["_row", "item_id", "start", "end", "n_words", "edits"])
                    out.insert(0, "_key", keys.iloc[out["_row"].astype(int)].to_numpy())
                    yield out.drop(columns="_row")
                    begin, lines, spans, held = k, [], [], 0
                if k < len(texts):
                    words, first, end = word_hashes(texts[k], bare=True)
                    lines.append(words)
                    spans.append((first, end))
                    held += len(words)
    return search


def _characters(text: str, spans: tuple[np.ndarray, np.ndarray], first: int, end: int):
    raw = text.encode("utf-8", "surrogatepass")
    before = raw[:int(spans[0][first])].decode("utf-8", "surrogatepass")
    inside = raw[int(spans[0][first]):int(spans[1][end - 1])].decode("utf-8", "surrogatepass")
    return len(before), len(before) + len(inside)


def leaks(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text", max_edits: float = MAX_EDITS,
    recall: float = RECALL,
) -> DataFrame:
    """(key, item_id, start, end, n_words, edits): stretches of documents near a benchmark item.

    start and end are code points of the text. Rows of ``docs`` that repeat give their rows again;
    null and empty texts give none; items without words match nothing; items that repeat are
    reported under each id. A null id is kept as null. Overlapping stretches of one item are
    reported once. Other columns are left out, and an empty table gives no rows.
    """
    kind = docs.schema[key].dataType.simpleString()
    item_kind = benchmark.schema[item].dataType.simpleString()
    named = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    out = [
        named.mapInPandas(_searcher(index), f"_key {kind}, " + FOUND.format(item=item_kind))
        for index in indexes(benchmark, item, item_text, max_edits, recall)
    ]
    if not out:
        return named.where(F.lit(False)).select(F.col("_key").alias(key), *[
            F.lit(None).cast(field.split()[1]).alias(field.split()[0])
            for field in FOUND.format(item=item_kind).split(", ")])
    return reduce(DataFrame.unionByName, out).withColumnRenamed("_key", key)


def indexes(
    benchmark: DataFrame, item: str = "item_id", item_text: str = "text",
    max_edits: float = MAX_EDITS, recall: float = RECALL,
) -> Iterator[Index]:
    """An index for each block of about ``BLOCK_WORDS`` words of the benchmark."""
    items = benchmark.select(F.col(item).alias("_item"), F.col(item_text).alias("_text")).where(
        F.col("_text").isNotNull())
    total = items.agg(F.sum(F.size(F.split("_text", r"\s+")))).first()[0] or 0
    blocks = -(-total // BLOCK_WORDS) or 1
    for block in range(blocks):
        held = [
            (row["_item"], word_hashes(row["_text"], bare=True)[0])
            for row in items.where(
                F.pmod(F.xxhash64("_item", "_text"), F.lit(blocks)) == block).collect()
        ]
        held = sorted((x for x in held if len(x[1])), key=lambda x: (x[0] is None, x[0] or 0))
        if held:
            yield Index([x[0] for x in held], [x[1] for x in held], max_edits, recall)


def leak_test(benchmark: DataFrame, max_edits: float = MAX_EDITS, recall: float = RECALL):
    """A column function: whether a text has a stretch near an item (null has none)."""
    def of(index: Index):
        def test(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in texts:
                out = np.zeros(len(batch), bool)
                begin, lines, held = 0, [], 0
                for k, text in enumerate(batch):
                    lines.append(word_hashes(text, bare=True)[0])
                    held += len(lines[-1])
                    if held >= SLICE_WORDS or k == len(batch) - 1:
                        out[[begin + found[0] for found in index.search(lines)]] = True
                        begin, lines, held = k + 1, [], 0
                yield pd.Series(out)
        return F.pandas_udf(test, "boolean")

    tests = [of(index) for index in indexes(benchmark, max_edits=max_edits, recall=recall)]

    def column(text: Column) -> Column:
        return reduce(Column.__or__, (test(text) for test in tests), F.lit(False))
    return column


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stretch of a document that is near a benchmark item."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
