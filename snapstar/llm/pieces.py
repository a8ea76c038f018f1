"""SentencePiece encoding and decoding by a forward pass over shared prefixes.

The distinct marked words of a batch of texts are sorted, which is a depth-first walk of their
trie: a word keeps the forward states of the prefix it shares with the word before, and only its
own letters are scored. The state of a prefix is the last piece of its best path. For a model of
merges the transition from piece a to piece b scores 0 if merging the text of a and b gives just
these two back and minus infinity if not; exactly one path of each prefix is finite, and it is the
model's own segmentation (a prefix of a merge segmentation is the segmentation of that prefix).
So the walk gives the ids of the published model, whose scores are merge ranks and no
probabilities; a plain sum of them would not.

Many words are walked together, a letter of all of them at a time and each shared prefix once, in
numpy arrays (``sweep``); few words, and words longer than ``WIDE`` letters, singly (``walk``).

Vocabulary files are read on the driver and shipped to the tasks; only identity-normalised models
with byte fallback and a leading blank are taken. No word leaves its task: nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from snapstar.llm.text import table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Bounds of what a task keeps: letters of texts walked together, words and pairs remembered. A process
#: that has been through other operators holds their memory too, so these are a small part of a worker's.
LETTERS, KEPT = 1_000_000, 250_000
#: Words that are swept together, the longest of them, and how many make a sweep worth while.
SWEPT, WIDE, FEW = 50_000, 48, 2_000
# Blanks belong to the word behind them; line ends are words of their own in most models.
_WORD = re.compile(rf"{MARK}*[^{MARK}]+|{MARK}+")


#: The model that this process has used last.
_LIVING: list[Model] = []


class Table:
    """An exact map of non-negative 64-bit keys to 32-bit numbers, looked up in arrays."""

    def __init__(self, bits: int):
        self.bits, self.used = bits, 0
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.zeros(1 << bits, np.int32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The numbers of ``keys``; -1 where there is none."""
        slots = self._slots(keys)
        held = self.keys[slots]
        out = np.where(held == keys, self.values[slots], np.int32(-1))
        rest = np.flatnonzero((held != keys) & (held != -1))
        slots = slots[rest]
        while len(rest):
            slots = slots + 1 & (1 << self.bits) - 1
            held = self.keys[slots]
            hit = held == keys[rest]
            out[rest[hit]] = self.values[slots[hit]]
            on = ~hit & (held != -1)
            rest, slots = rest[on], slots[on]
        return out

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Enter distinct ``keys`` that are not there; the table must stay half empty."""
        self.used += len(keys)
        slots = self._slots(keys)
        while len(keys):
            free = self.keys[slots] == -1
            self.keys[slots[free]] = keys[free]  # of keys that meet at a slot, one stays
            on = self.keys[slots] != keys
            self.values[slots[~on]] = values[~on]
            keys, values, slots = keys[on], values[on], slots[on] + 1 & (1 << self.bits) - 1


@dataclass
class Model:
    """Pieces by id, their scores, and what special ids mean."""

    pieces: list[str]
    scores: list[float]
    normal: list[bool]
    byte_of: dict[int, int]
    unknown: int
    #: What has been found out so far, for the life of a task's process.
    pairs: dict[int, bool] = field(default_factory=dict, compare=False)
    known: dict[str, int] = field(default_factory=dict, compare=False)

    def __post_init__(self):
        # Ids of the known words behind one another, and where each word's ids end.
        self.forget()

    def __getstate__(self):
        return {k: self.__dict__[k] for k in ("pieces", "scores", "normal", "byte_of", "unknown")}

    def __setstate__(self, state):
        self.__init__(**state)

    @property
    def living(self) -> Model:
        """An equal model with what this process has found out in earlier tasks."""
        if not _LIVING or _LIVING[0] != self:
            _LIVING[:] = [self]
        return _LIVING[0]

    @cached_property
    def ids(self) -> dict[str, int]:
        return {piece: k for k, piece in enumerate(self.pieces) if self.normal[k]}

    @cached_property
    def lengths(self) -> dict[str, list[int]]:
        """Lengths of the pieces that end in two letters (or are one letter), the longest first."""
        found: dict[str, set[int]] = {}
        for piece in self.ids:
            found.setdefault(piece[-2:], set()).add(len(piece))
        return {end: sorted(sizes, reverse=True) for end, sizes in found.items()}

    @cached_property
    def endings(self) -> tuple[Table, np.ndarray, int]:
        """The tree of the pieces read backwards: edges (node << 21 | letter), pieces of nodes, depth."""
        edges: dict[int, int] = {}
        at_node = [-1]
        for piece, k in self.ids.items():
            node = 0
            for letter in reversed(piece):
                edge = node << 21 | ord(letter)
                node = edges.setdefault(edge, len(at_node))
                if node == len(at_node):
                    at_node.append(-1)
            at_node[node] = k
        out = Table(max(4, (8 * len(edges)).bit_length()))
        out.add(np.array([*edges], np.int64), np.array([*edges.values()], np.int32))
        return out, np.array(at_node, np.int32), max(map(len, self.ids), default=0)

    @cached_property
    def tested(self) -> Table:
        """Answers of ``follows`` by before + 1 << 32 | piece."""
        return Table(KEPT.bit_length() + 2)

    @cached_property
    def id_of_byte(self) -> dict[int, int]:
        return {byte: k for k, byte in self.byte_of.items()}

    def merged(self, text: str) -> list[str]:
        """Segmentation of a short text by merging the best neighbours, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                found = self.ids.get(parts[k] + parts[k + 1])
                if found is not None and (best is None or self.scores[found] > best):
                    best, at = self.scores[found], k
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def follows(self, before: int, piece: int) -> bool:
        """Whether the transition to a piece is finite; -1 before it is a loose letter or the start."""
        parts = [self.pieces[before]] * (before >= 0) + [self.pieces[piece]]
        return self.merged("".join(parts)) == parts

    def followed(self, before: int, piece: int) -> bool:
        """``follows``, remembered in ``pairs``; arrays of transitions are remembered in ``tested``."""
        if len(self.pairs) >= KEPT:
            self.pairs.clear()
        found = self.pairs[before << 32 | piece] = self.follows(before, piece)
        return found

    def walk(self, words: Iterable[str]) -> Iterator[tuple[str, tuple[int, ...]]]:
        """Ids of each of the sorted distinct words."""
        ids, lengths, pairs = self.ids, self.lengths, self.pairs
        last, size, previous = [-1], [0], ""
        for word in words:
            shared, most = 0, min(len(previous), len(word))
            while shared < most and previous[shared] == word[shared]:
                shared += 1
            del last[shared + 1:], size[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                for length in lengths.get(word[end - 2:end], ()) if end > 1 else ():
                    piece = ids.get(word[end - length:end]) if length <= end else None
                    if piece is not None:
                        before = last[end - length]
                        finite = pairs.get(before << 32 | piece)
                        if self.followed(before, piece) if finite is None else finite:
                            last.append(piece)
                            size.append(length)
                            break
                else:  # one letter: a piece, or bytes
                    last.append(ids.get(word[end - 1], -1))
                    size.append(1)
            out, at = [], len(word)
            while at:
                if last[at] >= 0:
                    out.append(last[at])
                else:
                    raw = word[at - 1:at].encode("utf-8", "surrogatepass")
                    out += [self.id_of_byte.get(b, self.unknown) for b in reversed(raw)]
                at -= size[at]
            previous = word
            yield word, tuple(reversed(out))

    def finite(self, keys: np.ndarray) -> np.ndarray:
        """Whether transitions (before + 1 << 32 | piece) are finite."""
        found = self.tested.find(keys)
        if (found < 0).any():
            new = np.unique(keys[found < 0])
            values = np.array(
                [self.follows((key >> 32) - 1, key & 0xFFFFFFFF) for key in new.tolist()], np.int32)
            found[found < 0] = values[np.searchsorted(new, keys[found < 0])]
            if self.tested.used + len(new) > 2 * KEPT:
                del self.tested
            self.tested.add(new[:2 * KEPT], values[:2 * KEPT])
        return found > 0

    def sweep(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids behind one another, how many of each word) of many sorted distinct words."""
        edges, at_node, deepest = self.endings
        letters = np.frombuffer(
            "".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        begins = np.cumsum(sizes) - sizes
        # State of the prefix that ends at a letter: its last piece, and that piece's length.
        last, size = np.empty(len(letters), np.int32), np.ones(len(letters), np.int8)
        row = np.arange(len(words))
        same = row > 0  # as far as the word before, up to this letter
        for end in range(1, int(sizes.max(initial=0)) + 1):
            row = row[sizes[row] >= end]
            same[row] &= sizes[row - 1] >= end
            like = row[same[row]]
            same[like] = letters[begins[like] + end - 1] == letters[begins[like - 1] + end - 1]
            fresh = ~same[row]
            at = begins[row[fresh]] + end - 1
            node, on, ending = np.zeros(len(at), np.int64), np.arange(len(at)), []
            for length in range(1, min(end, deepest) + 1):
                node = edges.find(node << 21 | letters[at[on] - length + 1]).astype(np.int64)
                on, node = on[node > 0], node[node > 0]
                piece = at_node[node]
                ending.append((on[piece >= 0], piece[piece >= 0]))
                if not len(on):
                    break
            piece, long = np.full(len(at), -1, np.int32), np.ones(len(at), np.int8)
            open_ = np.ones(len(at), bool)
            for length in range(len(ending), 1, -1):
                of, k = ending[length - 1]
                of, k = of[open_[of]], k[open_[of]]
                if not len(of):
                    continue
                before = last[at[of] - length] if length < end else np.full(len(of), -1)
                right = self.finite(before.astype(np.int64) + 1 << 32 | k)
                of = of[right]
                piece[of], long[of], open_[of] = k[right], length, False
            if ending:
                of, k = ending[0]
                piece[of[open_[of]]] = k[open_[of]]
            shared = np.cumsum(fresh) - 1
            last[begins[row] + end - 1], size[begins[row] + end - 1] = piece[shared], long[shared]
        # From the ends of the words back over the pieces of their best paths.
        taken, row, at = np.zeros(len(letters), bool), np.arange(len(words)), sizes.copy()
        while len(row):
            here = begins[row] + at - 1
            taken[here] = True
            at = at - size[here]
            row, at = row[at > 0], at[at > 0]
        here = np.flatnonzero(taken)
        ids, n = last[here], np.ones(len(here), np.int64)
        raw = [chr(k).encode("utf-8", "surrogatepass") for k in letters[here[ids < 0]].tolist()]
        n[ids < 0] = [len(some) for some in raw]
        ids = np.repeat(ids, n)
        ids[ids < 0] = [self.id_of_byte.get(byte, self.unknown) for byte in b"".join(raw)]
        of_letter = np.zeros(len(letters), np.int64)
        of_letter[here] = n
        return ids, np.add.reduceat(of_letter, begins)

    def forget(self) -> None:
        self.known.clear()
        self.ids_known, self.ends_known = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def learn(self, words: list[str]) -> None:
        """Find and remember the ids of sorted distinct words that are not known."""
        short = [word for word in words if len(word) <= WIDE]
        short = short if len(short) >= FEW else []
        order = short + (words if not short else [word for word in words if len(word) > WIDE])
        found = [self.sweep(short[k:k + SWEPT]) for k in range(0, len(short), SWEPT)]
        rest = [ids for _, ids in self.walk(order[len(short):])]
        found.append((np.fromiter(chain.from_iterable(rest), np.int32),
                      np.fromiter(map(len, rest), np.int64, len(rest))))
        first = len(self.known)
        self.known.update(zip(order, range(first, first + len(order))))
        self.ids_known = np.concatenate([self.ids_known, *(ids for ids, _ in found)])
        n = np.concatenate([n for _, n in found])
        self.ends_known = np.concatenate([self.ends_known, self.ends_known[-1] + np.cumsum(n)])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts behind one another, where each text's ids end)."""
        batch = [_WORD.findall(MARK + text.replace(" ", MARK)) if text else [] for text in texts]
        if len(self.known) > KEPT:
            self.forget()
        self.learn(sorted(set().union(*batch).difference(self.known)))
        sizes = np.cumsum([0, *map(len, batch)])
        words = np.fromiter(
            map(self.known.__getitem__, chain.from_iterable(batch)), np.int64, sizes[-1])
        begins = self.ends_known[words]
        n = self.ends_known[words + 1] - begins
        ends = np.concatenate([[0], np.cumsum(n)])
        at = np.repeat(begins - ends[:-1], n) + np.arange(ends[-1])
        return self.ids_known[at], ends[sizes[1:]]

    @cached_property
    def shown(self) -> tuple[np.ndarray, list[str]]:
        """Which ids are bytes of longer characters, and the text of all others."""
        joint = np.array([self.byte_of.get(k, 0) > 127 for k in range(len(self.pieces))])
        return joint, [
            chr(self.byte_of[k]) if k in self.byte_of and not joint[k]
            else piece if self.normal[k] else "" for k, piece in enumerate(self.pieces)
        ]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        joint, text = self.shown
        if joint[ids].any():
            parts, raw = [], bytearray()
            for k in ids.tolist():
                if joint[k]:
                    raw.append(self.byte_of[k])
                    continue
                parts.append(raw.decode("utf-8", "replace"))
                raw.clear()
                parts.append(text[k])
            parts.append(raw.decode("utf-8", "replace"))
        else:
            parts = [text[k] for k in ids.tolist()]
        return "".join(parts).replace(MARK, " ").removeprefix(" ")


def load(path: str = MODEL) -> Model:
    """Read the pieces of a model file of merges."""
    import sentencepiece

    held = sentencepiece.SentencePieceProcessor(model_file=path)
    n = held.get_piece_size()
    pieces = [held.id_to_piece(k) for k in range(n)]
    model = Model(
        pieces, [held.get_score(k) for k in range(n)],
        [not (held.is_byte(k) or held.is_control(k) or held.is_unknown(k) or held.is_unused(k))
         for k in range(n)],
        {k: int(pieces[k][3:5], 16) for k in range(n) if held.is_byte(k)}, held.unk_id(),
    )
    probe = "A  b ①\n c "
    if len(model.byte_of) != 256 or held.decode(held.encode(probe)) != probe or held.encode(
        probe
    ) != model.encode([probe])[0].tolist():
        raise ValueError(f"{path}: not an identity-normalised model of merges with byte fallback")
    return model


def slices(texts: list[str | None]) -> Iterator[slice]:
    """Consecutive stretches of about ``LETTERS`` letters."""
    start, letters = 0, 0
    for at, text in enumerate(texts, 1):
        letters += len(text or "")
        if letters >= LETTERS or at == len(texts):
            yield slice(start, at)
            start, letters = at, 0


def _encoder(model: Model):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        living = model.living
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for part in slices(texts):
                ids, ends = living.encode(texts[part])
                starts = np.concatenate([[0], ends])
                back = [
                    living.decode(ids[a:b]) == (text or "")
                    for text, a, b in zip(texts[part], starts, ends)
                ]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(part.start, part.stop - part.start),
                    pa.array(np.diff(starts)), pa.ListArray.from_arrays(
                        pa.array(starts.astype(np.int32)), pa.array(ids)),
                    pa.array(back, pa.bool_()),
                ], names=["_key", "n_pieces", "ids", "round_trip"])
    return encode


def decoder(model: Model):
    """A column function: the text of an array of ids (null counts as empty)."""
    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for rows in batches:
            yield pd.Series(
                ["" if row is None else model.decode(row) for row in rows], dtype=object)

    def column(ids: Column) -> Column:
        return text(ids)
    return column


def encoded(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_pieces, ids, round_trip) for every row of ``docs``.

    round_trip: decoding gives the text back (a null text counts as empty; a text that holds the
    blank mark itself does not come back, as in the published decoder). Repeated rows stay, other
    columns are left out, an empty table gives no rows.
    """
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).mapInArrow(
        _encoder(model), f"_key {kind}, n_pieces long, ids array<int>, round_trip boolean"
    ).withColumnRenamed("_key", key)


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece counts, a digest of the ids, and the round trip of every document."""
    return encoded(table(spark, sf_dir, "documents"), load()).select(
        "doc_id", "n_pieces",
        F.md5(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary")).alias("ids_md5"),
        "round_trip",
    )
