"""Alignment of two tokenizers' tokens over the same bytes, and how often ids meet.

Everything after encoding is Arrow: token lists are flattened with their parent indices, byte lengths
of tokens are added up per document, and the two sides are joined by hash on (document, end). Ends
that both sides have close a group; every end of either side closes one link, that between the A
token and the B token that hold the byte before it. ``Table.group_by`` counts the links of id pairs
per document and slice; Spark adds the counts up over the corpus, finds the highest of each B id, and
brings the totals back to each slice of documents, which are met by cogroup.

A slice is at most about ``LETTERS`` letters of consecutive documents (or one long document), so that is what
a task holds. Id pairs of the corpus are never gathered in one place: they are counted, compared and
joined by hash.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from snapstar.llm.text import table
from snapstar.session import new_folder

A_FILE, B_FILE = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
#: How this kind of byte-level vocabulary cuts texts before merging (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Letters of texts that are encoded and joined together.
LETTERS = 1_000_000
#: From so many white characters in a row, the slower encoder is taken: the other's stack ends.
LONG_BLANK = 10_000
COUNTS = ("n_a", "n_b", "n_groups", "n_links")
_LISTS = pa.list_(pa.int32())


class ByteLevel:
    """A byte-level vocabulary of merges. Its merges stand in id order, so ids serve as ranks.

    Two libraries encode by it; they agree on texts of any code points, and the faster is taken.
    """

    def __init__(self, path: str = A_FILE):
        with open(path, encoding="utf-8") as file:
            self.file = file.read()
        held = json.loads(self.file)
        special = {token["id"] for token in held["added_tokens"]}
        shown = {}
        # Bytes that are printable stand for themselves, the others for letters from 256 on.
        for byte in range(256):
            plain = 0x21 <= byte <= 0x7E or 0xA1 <= byte <= 0xAC or 0xAE <= byte
            shown[chr(byte) if plain else chr(256 + len([b for b in shown.values() if not (
                0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b)]))] = byte
        vocabulary = sorted((k, token) for token, k in held["model"]["vocab"].items())
        self.bytes = [bytes(shown[c] for c in token) for _, token in vocabulary]
        joined = [m if isinstance(m, list) else m.split(" ") for m in held["model"]["merges"]]
        plain = [k for k, _ in vocabulary if k not in special]
        if [k for k, _ in vocabulary] != list(range(len(vocabulary))) or [
            "".join(m) for m in joined
        ] != [token for _, token in vocabulary][256:256 + len(joined)] or len(
            plain
        ) != 256 + len(joined) or held["normalizer"] or held["pre_tokenizer"] != {
            "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True
        }:
            raise ValueError(f"{path}: not a plain byte-level vocabulary with merges in id order")
        self.ranks = {self.bytes[k]: k for k in plain}

    def __getstate__(self):
        return {"file": self.file, "bytes": self.bytes, "ranks": self.ranks}

    @cached_property
    def encoder(self):
        import tiktoken

        return tiktoken.Encoding(
            "byte-level", pat_str=PATTERN, mergeable_ranks=self.ranks, special_tokens={})

    @cached_property
    def steady(self):
        from tokenizers import Tokenizer

        made = Tokenizer.from_str(self.file)
        made.encode_special_tokens = True
        return made

    def ids(self, texts: list[str]) -> pa.ListArray:
        blank = re.compile(rf"\s{{{LONG_BLANK}}}")
        return pa.array([
            self.steady.encode(" " + text, add_special_tokens=False).ids
            if len(text) > LONG_BLANK and blank.search(text)
            else self.encoder.encode_ordinary(" " + text) for text in texts
        ], _LISTS)


class Pieces:
    """A vocabulary of pieces; the encoder puts a blank before a text itself."""

    def __init__(self, path: str = B_FILE):
        with open(path, "rb") as file:
            self.model = file.read()
        held = self.encoder
        self.bytes = [
            bytes([int(piece[3:5], 16)]) if held.is_byte(k) else piece.replace("▁", " ").encode()
            for k, piece in enumerate(map(held.id_to_piece, range(held.get_piece_size())))
        ]

    def __getstate__(self):
        return {"model": self.model, "bytes": self.bytes}

    @cached_property
    def encoder(self):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_proto=self.model)

    def ids(self, texts: list[str]) -> pa.ListArray:
        return pa.array(self.encoder.encode(texts, num_threads=1), _LISTS)


class Side:
    """A vocabulary with the tables that Arrow takes from: token bytes, lengths, decimal ids."""

    def __init__(self, vocabulary, closings: tuple[str, ...]):
        self.vocabulary, self.closings = vocabulary, closings

    def __getstate__(self):
        return {"vocabulary": self.vocabulary, "closings": self.closings}

    @cached_property
    def bytes(self) -> pa.Array:
        return pa.array(self.vocabulary.bytes, pa.large_binary())

    @cached_property
    def lengths(self) -> pa.Array:
        return pc.binary_length(self.bytes)

    @cached_property
    def written(self) -> list[str]:
        """Each id with each of the closings behind it."""
        return [f"{k}{end}" for k in range(len(self.vocabulary.bytes)) for end in self.closings]

    def joined(self, ids: pa.ListArray) -> pa.Array:
        taken = self.bytes.take(ids.flatten())
        return pc.binary_join(
            pa.ListArray.from_arrays(_starts(ids), taken), pa.scalar(b"", pa.large_binary()))

    def tokens(self, ids: pa.ListArray, name: str) -> pa.Table:
        """(key: document and end in one number, id) of each token."""
        flat, parent = pc.list_flatten(ids), pc.list_parent_indices(ids).cast(pa.int64())
        running = pc.cumulative_sum(self.lengths.take(flat))
        # Each list holds a token, so the sum before a list is the one at its predecessor's last.
        before = pa.concat_arrays([
            pa.array([0], pa.int64()), running.take(_starts(ids)[1:-1].cast(pa.int64()).to_numpy() - 1)
        ]) if len(ids) else pa.array([], pa.int64())
        ends = pc.subtract(running, before.take(parent))
        return pa.table({"key": pc.add(pc.shift_left(parent, 32), ends), name: flat})


def _starts(ids: pa.ListArray) -> pa.Array:
    """Offsets from 0, also for lists that are a slice."""
    return pa.array(np.concatenate([[0], np.cumsum(
        pc.list_value_length(ids).to_numpy(zero_copy_only=False))]).astype(np.int32))


def _links(a: Side, b: Side, a_ids: pa.ListArray, b_ids: pa.ListArray) -> dict[str, np.ndarray]:
    """The links of documents, document by document: ids and which ends are whose."""
    joined = a.tokens(a_ids, "a").join(
        b.tokens(b_ids, "b"), "key", join_type="full outer", use_threads=False)
    key = joined["key"].to_numpy()
    joined = joined.take(pa.array(np.argsort(key, kind="stable"))).combine_chunks()
    has = {name: pc.is_valid(joined[name]).to_numpy() for name in "ab"}
    # A token's other links come before the one at its own end.
    ids = {name: pc.fill_null_backward(joined[name]).to_numpy() for name in "ab"}
    return {"document": joined["key"].to_numpy() >> 32, "has_a": has["a"], "has_b": has["b"], **ids}


def _written(a: Side, b: Side, links: dict[str, np.ndarray], n: int, dictionary: pa.Array) -> pa.Array:
    """The groups of each document as text: ``a1,a2|b1;a3|b2,b3``."""
    both = links["has_a"] & links["has_b"]
    document = links["document"]
    sums = {name: np.cumsum(links[f"has_{name}"]) for name in "ab"}
    closing = np.flatnonzero(both)
    group = np.cumsum(both) - both
    last = np.zeros(len(both), bool)
    last[:-1] = document[1:] != document[:-1]
    last[-1:] = True
    code = np.empty(int(links["has_a"].sum() + links["has_b"].sum()), np.int64)
    at = links["has_a"]
    earlier = np.concatenate([[0], sums["b"][closing]])[group[at]]
    code[sums["a"][at] - 1 + earlier] = links["a"][at].astype(np.int64) * 2 + both[at]
    at = links["has_b"]
    own = sums["a"][closing][group[at]]
    code[sums["b"][at] - 1 + own] = (
        2 * len(a.vocabulary.bytes) + links["b"][at].astype(np.int64) * 3 + both[at] + last[at])
    sizes = np.bincount(document, links["has_a"].astype(int) + links["has_b"], n)
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(
        pa.array(starts), dictionary.take(pa.array(code))), pa.scalar("", pa.large_string()))


def slices(texts: list[str | None]) -> Iterator[slice]:
    """Consecutive stretches of about ``LETTERS`` letters, one text at least."""
    start, letters = 0, 0
    for at, text in enumerate(texts):
        if letters and letters + len(text or "") > LETTERS:
            yield slice(start, at)
            start, letters = at, 0
        letters += len(text or "")
    if texts:
        yield slice(start, len(texts))


def _aligned(a: Side, b: Side):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        dictionary = pa.array(a.written + b.written, pa.large_string())
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for part in slices(texts):
                held = aligned_slice(texts[part], a, b, dictionary)
                rows = part.stop - part.start
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(rows, (task << 32) + number)),
                    batch.column(0).slice(part.start, rows), *held.values(),
                ], names=["part", "_key", *held])
                number += 1
    return align


def aligned_slice(
    texts: list[str | None], a: Side, b: Side, dictionary: pa.Array
) -> dict[str, pa.Array]:
    """Counts, written groups, and distinct id pairs with their links, for each text."""
    some = [k for k, text in enumerate(texts) if text]
    shown = [texts[k] for k in some]
    a_ids, b_ids = a.vocabulary.ids(shown), b.vocabulary.ids(shown)
    expected = pa.array([" " + text for text in shown], pa.large_string()).cast(pa.large_binary())
    same = pc.and_(pc.equal(a.joined(a_ids), expected), pc.equal(b.joined(b_ids), expected))
    chosen = np.array(some, np.int64)[same.to_numpy(zero_copy_only=False)]
    a_ids, b_ids = a_ids.filter(same), b_ids.filter(same)
    links = _links(a, b, a_ids, b_ids)
    document = links["document"]
    pairs = pa.table({
        "document": document, "pair": links["a"].astype(np.int64) << 32 | links["b"],
    }).group_by(["document", "pair"], use_threads=False).aggregate([([], "count_all")])
    order = np.argsort(pairs["document"].to_numpy(), kind="stable")
    n = len(chosen)
    counts = {
        "n_a": np.bincount(document, links["has_a"], n), "n_b": np.bincount(document, links["has_b"], n),
        "n_groups": np.bincount(document, links["has_a"] & links["has_b"], n),
        "n_links": np.bincount(document, minlength=n),
    }
    out = {}
    for name in COUNTS:
        whole = np.zeros(len(texts), np.int64)
        whole[chosen] = counts[name].astype(np.int64)
        out[name] = pa.array(whole)
    back = np.full(len(texts), -1)
    back[chosen] = np.arange(n)
    out["groups"] = pc.fill_null(_written(a, b, links, n, dictionary).take(
        pa.array(back, mask=back < 0)), "").cast(pa.string())
    sizes = np.zeros(len(texts), np.int64)
    sizes[chosen] = np.bincount(pairs["document"].to_numpy(), minlength=n)
    starts = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    for name, column, kind in (("pairs", "pair", pa.int64()), ("links", "count_all", pa.int32())):
        out[name] = pa.ListArray.from_arrays(
            starts, pa.array(pairs[column].to_numpy()[order]).cast(kind))
    return out


def align(
    docs: DataFrame, first=None, second=None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(part, key, n_a, n_b, n_groups, n_links, groups, pairs, links) for every row of ``docs``.

    ``groups`` is the alignment as text, A ids before B ids, groups by semicolon; ``pairs`` are the
    distinct linked ids (A times 2**32 plus B) and ``links`` how many links each has here. Null and
    empty texts, and texts whose tokens do not give back the blank and the text, have no tokens: zeros,
    an empty text, empty arrays. A very long text is a slice of its own and aligned whole. Repeated and
    null keys stay rows of their own; other columns are left out; an empty table gives no rows.
    """
    a, b = Side(first or ByteLevel(), (",", "|")), Side(second or Pieces(), (",", ";", ""))
    kind = docs.schema[key].dataType.simpleString()
    counts = ", ".join(f"{name} long" for name in COUNTS)
    return docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).mapInArrow(
        _aligned(a, b),
        f"part long, _key {kind}, {counts}, groups string, pairs array<long>, links array<int>",
    ).withColumnRenamed("_key", key)


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, pair, links) with the links of a batch's documents added up."""
    for batch in batches:
        parts, pairs, links = (batch.column(name) for name in ("part", "pairs", "links"))
        added = pa.table({
            "part": parts.take(pc.list_parent_indices(pairs)), "pair": pc.list_flatten(pairs),
            "links": pc.list_flatten(links).cast(pa.int64()),
        }).group_by(["part", "pair"], use_threads=False).aggregate([("links", "sum")])
        yield from added.rename_columns(["part", "pair", "links"]).to_batches()


def pair_totals(rows: DataFrame) -> DataFrame:
    """(part, pair, total, best): the corpus-wide links of each pair that a part holds, and whether no
    pair of the same B id has more. ``rows`` are those of ``align``, kept as a table."""
    partial = rows.select("part", "pairs", "links").mapInArrow(
        _partial, "part long, pair long, links long")
    folder = new_folder(rows.sparkSession, "pair-counts")
    partial.write.parquet(folder)
    partial = rows.sparkSession.read.parquet(folder)
    totals = partial.groupBy("pair").agg(F.sum("links").alias("total")).withColumn(
        "b", F.col("pair").bitwiseAND(0xFFFFFFFF))
    highest = totals.groupBy("b").agg(F.max("total").alias("highest"))
    flagged = totals.join(highest, "b").select(
        "pair", "total", (F.col("total") == F.col("highest")).alias("best"))
    return partial.select("part", "pair").distinct().join(flagged, "pair")


def _measured(documents: pa.Table, totals: pa.Table) -> pa.Table:
    """The documents of a part with n_best and count_sum in place of their pairs."""
    order = np.argsort(totals["pair"].to_numpy())
    known = totals["pair"].to_numpy()[order]
    pairs, links = documents["pairs"].combine_chunks(), documents["links"].combine_chunks()
    parent = pc.list_parent_indices(pairs).to_numpy()
    at = order[np.searchsorted(known, pc.list_flatten(pairs).to_numpy())]
    n = pc.list_flatten(links).to_numpy().astype(np.int64)
    best = np.zeros(len(documents), np.int64)
    sums = np.zeros(len(documents), np.int64)
    np.add.at(best, parent, n * totals["best"].to_numpy()[at])
    np.add.at(sums, parent, n * totals["total"].to_numpy()[at])
    return documents.drop_columns(["part", "pairs", "links"]).append_column(
        "n_best", pa.array(best)).append_column("count_sum", pa.array(sums))


def measure(rows: DataFrame) -> DataFrame:
    """``rows`` of ``align``, kept as a table, with n_best and count_sum in place of part and pairs.

    n_best: links whose id pair has the most links of all pairs of its B id, ties included; count_sum:
    over links, the links of their pair in all of ``rows``. Without tokens both are 0.
    """
    kept = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema
            if f.name not in ("part", "pairs", "links")]
    return rows.groupBy("part").cogroup(pair_totals(rows).groupBy("part")).applyInArrow(
        _measured, ", ".join([*kept, "n_best long", "count_sum long"]))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and a digest of the alignment of every document, and how common its links are."""
    folder = new_folder(spark, "alignment")
    align(table(spark, sf_dir, "documents")).withColumn(
        "groups_sha256", F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    ).drop("groups").write.parquet(folder)
    return measure(spark.read.parquet(folder)).select(
        "doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256")
