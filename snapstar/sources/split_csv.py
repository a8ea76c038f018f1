"""CSV files with quoted line breaks, each read by many tasks.

Spark's text reader cuts a file into blocks at line breaks, quoted or not. The quotes of each block are
counted first, one number per block; added up in order, they say whether a block begins inside quotes,
and with that every task finds the record borders of its own block. A record that lies within a block is
put together there; what a block begins with and the record it ends in meet in a small grouping, one
piece or two per block. Records are then parsed by Spark's CSV parser, one by one. Up to
``BROADCAST_BLOCKS`` blocks, the answers are broadcast and the text itself is never shuffled; beyond, it
is dealt by block and put in order again.

Quotes must stand as RFC 4180 asks: fields that hold one are quoted, and it is doubled. A file whose
quotes do not close is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from snapstar.session import settled


#: Blocks whose answers are broadcast: some 20 MB, for 12 TB in blocks of 128 MB.
BROADCAST_BLOCKS = 100_000
_PIECE = "_file string, _block long, _record string, _head boolean, _tail boolean, _first boolean"


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"), F.col("value").alias("_line"),
        F.monotonically_increasing_id().alias("_at"))


def block_starts(lines: DataFrame) -> DataFrame:
    """(_file, _block, _inside): whether each block begins inside quotes."""
    quotes = F.length("_line") - F.length(F.replace("_line", F.lit('"'), F.lit("")))
    counted = lines.groupBy("_file", "_block").agg(F.sum(quotes).alias("_quotes"))
    in_order = Window.partitionBy("_file").orderBy("_block")  # a row per block
    before = F.sum("_quotes").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    whole = F.sum("_quotes").over(Window.partitionBy("_file"))
    message = F.concat(F.lit("quotes do not close in "), F.col("_file"))
    return counted.select(
        "_file", "_block",
        F.when(whole % 2 == 0, F.coalesce(before, F.lit(0)) % 2 == 1)
        .otherwise(F.raise_error(message)).alias("_inside"))


def _joined(lines: pa.Array, starts: np.ndarray) -> pa.Array:
    """Lines from each start to the next as one text."""
    offsets = np.append(starts, len(lines)).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), lines), "\n")


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of each block in order; the first and the last of a block are marked as pieces.

    ``_head``: lines before a block's first border; ``_tail``: the record a block ends in; ``_first``:
    the first record of a file. What is carried over from batch to batch is one open record.
    """
    block, inside, count, open_ = None, False, 0, None  # open_: (text, is head)

    def closing() -> pa.RecordBatch | None:
        if open_ is None:
            return None
        text, head = open_
        return _pieces(block, [text], [head], [not head], [count == 1 and block[1] == 0 and not head])

    for batch in batches:
        files, starts = batch.column(0), batch.column(1).to_numpy()
        lines, insides = batch.column(2), batch.column(3).to_numpy(zero_copy_only=False)
        named = files.dictionary_encode()
        number = named.indices.to_numpy()
        edges = np.flatnonzero((np.diff(starts) != 0) | (np.diff(number) != 0)) + 1
        bounds = [0, *edges.tolist(), len(starts)] if len(starts) else []
        for low, high in zip(bounds, bounds[1:]):
            here = (files[low].as_py(), int(starts[low]))
            if here != block:
                done = closing()
                if done is not None:
                    yield done
                block, inside, count, open_ = here, bool(insides[low]), 0, None
            part = lines.slice(low, high - low)
            odd = pc.count_substring(part, '"').to_numpy() % 2
            within = (np.cumsum(odd) - odd + inside) % 2 == 1
            inside = bool((odd.sum() + inside) % 2)
            borders = np.flatnonzero(~within)
            if len(borders) == 0 or borders[0] > 0:  # lines that go on with what is open
                upto = borders[0] if len(borders) else len(part)
                more = _joined(part.slice(0, upto), np.array([0]))[0].as_py()
                open_ = (more, True) if open_ is None else (f"{open_[0]}\n{more}", open_[1])
            if len(borders):
                made = _joined(part, borders).to_pylist()
                texts = made[:-1] if open_ is None else [open_[0], *made[:-1]]
                heads = [False] * len(texts)
                if open_ is not None:
                    heads[0] = open_[1]
                firsts = [False] * len(texts)
                if block[1] == 0 and count <= 1 and texts and not heads[0]:
                    firsts[0] = count + (open_ is None) == 1
                if texts:
                    yield _pieces(block, texts, heads, [False] * len(texts), firsts)
                count += len(made)
                open_ = (made[-1], False)
    done = closing()
    if done is not None:
        yield done


def _pieces(block, texts, heads, tails, firsts) -> pa.RecordBatch:
    n = len(texts)
    return pa.RecordBatch.from_arrays([
        pa.array([block[0]] * n, pa.string()), pa.array([block[1]] * n, pa.int64()),
        pa.array(texts, pa.string()), pa.array(heads, pa.bool_()), pa.array(tails, pa.bool_()),
        pa.array(firsts, pa.bool_()),
    ], names=["_file", "_block", "_record", "_head", "_tail", "_first"])


def records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(_file, _record, _first): every record of the files as text, line breaks in it included.

    Headers come as records, marked as the first of their file; blank lines are records too.
    """
    lines = _lines(spark, paths)
    starts = settled(block_starts(lines))
    if starts.count() <= BROADCAST_BLOCKS:
        placed = lines.join(F.broadcast(starts), ["_file", "_block"])
    else:
        placed = lines.join(starts.hint("merge"), ["_file", "_block"]).sortWithinPartitions(
            "_file", "_block", "_at")
    placed = placed.select("_file", "_block", "_line", "_inside")
    pieces = placed.mapInArrow(_records, _PIECE)
    whole = pieces.where(~F.col("_head") & ~F.col("_tail")).select("_file", "_record", "_first")
    ends = pieces.where(F.col("_head") | F.col("_tail"))
    # A head belongs to the last record that an earlier block of its file ended in.
    in_order = Window.partitionBy("_file").orderBy("_block", "_tail")
    begun = F.last(F.when(F.col("_tail"), F.col("_block")), ignorenulls=True).over(in_order)
    met = ends.withColumn("_of", begun).groupBy("_file", "_of").agg(
        F.array_sort(F.collect_list(F.struct("_block", "_tail", "_record"))).alias("_parts"),
        F.max("_first").alias("_first"))
    stitched = F.array_join(F.transform("_parts", lambda part: part["_record"]), "\n")
    return whole.unionByName(met.select("_file", stitched.alias("_record"), "_first"))


def read_split(spark: SparkSession, paths: list[str], columns: list[str]) -> DataFrame:
    """All columns as text, and ``_file``; only an empty field is null. Headers must be as given."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    options = {"quote": '"', "escape": '"', "nullValue": "", "multiLine": "true"}
    bare = F.when(
        F.endswith("_record", F.lit("\r")), F.expr("left(_record, length(_record) - 1)")
    ).otherwise(F.col("_record"))
    found = records(spark, paths).select("_file", "_first", bare.alias("_record")).where(F.col("_record") != "")
    parsed = found.select("_file", "_first", F.from_csv("_record", schema, options).alias("_row"))
    header = F.array(*[F.col("_row").getField(c) for c in columns]) == F.array(*map(F.lit, columns))
    refused = F.raise_error(F.concat(F.lit("header is not as expected in "), F.col("_file")))
    return parsed.where(
        ~F.when(F.col("_first"), F.when(header, True).otherwise(refused.cast("boolean")))
        .otherwise(False)
    ).select("_row.*", "_file")
