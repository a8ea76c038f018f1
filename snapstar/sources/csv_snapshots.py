"""Snapshot files: which there are, and their rows as text with the snapshot date.

A snapshot is ``<feed>/<subfolder>/YYYY-MM-DD_<kind>.csv``, either one file or a folder of part
files under that name. Quoted texts may hold line breaks, so one file is read by one task, unless it is
read ``split``: then records are found across the cuts (``sources.split_csv``).
"""

from __future__ import annotations

import re
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession, functions as F

from snapstar import contracts as C
from snapstar.operators.tallies import stacked
from snapstar.plans.history import snapshot_date_of
from snapstar.sources.split_csv import read_split

_SNAPSHOT = r"^(.*/\d{4}-\d{2}-\d{2}_([a-z]+)\.csv)(?:/|$)"


def discover(
    spark: SparkSession, feed: str, subfolders: list[str] | None = None
) -> DataFrame:
    """One row per snapshot under ``feed``: snapshot, kind, subfolder, action.

    Only file names are looked at. ``subfolders`` keeps the named top folders (all, if none are
    named); kinds the warehouse does not know are marked ``skip``.
    """
    base = re.sub(r"^[a-z0-9]+:/*", "/", feed).rstrip("/")
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv").load(feed).select("path")
    )
    snapshot = F.regexp_extract("path", _SNAPSHOT, 1)
    found = files.select(
        F.when(snapshot != "", snapshot).otherwise(F.col("path")).alias("snapshot"),
        F.regexp_extract("path", _SNAPSHOT, 2).alias("kind"),
        F.regexp_extract("path", re.escape(base) + r"/([^/]+)/", 1).alias("subfolder"),
    ).distinct()
    if subfolders:
        found = found.where(F.col("subfolder").isin(subfolders))
    known = F.col("kind").isin(*C.ARCHIVE)
    return found.withColumn("action", F.when(known, "load").otherwise("skip"))


def read_text(
    spark: SparkSession, paths: list[str], columns: list[str], multi_line: bool = True
) -> DataFrame:
    """All columns as text; only an empty field is null. Headers must be as given."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    return (
        spark.read.schema(schema).option("header", True).option("enforceSchema", False)
        .option("multiLine", multi_line).option("quote", '"').option("escape", '"')
        .option("nullValue", "").csv(paths)
    )


def read_snapshots(
    spark: SparkSession, feed: str, kind: str, subfolders: list[str] | None = None,
    multi_line: bool = True, split: bool = False,
) -> DataFrame:
    """Every snapshot of ``kind`` as text rows with ``snapshot_date`` from the file name.

    Files are grouped by header, so layouts with more columns load beside older ones; columns a
    layout lacks are null.
    """
    listed = discover(spark, feed, subfolders).where(F.col("kind") == kind)
    paths = sorted(r.snapshot for r in listed.select("snapshot").collect())  # one per snapshot
    if not paths:
        scope = f"in {subfolders}" if subfolders else "in any subfolder"
        raise FileNotFoundError(f"no {kind} snapshot under {feed} {scope}")
    layouts = defaultdict(list)
    for path in paths:
        header = spark.read.option("header", True).option("multiLine", multi_line).csv(path)
        layouts[tuple(header.columns)].append(path)
    frames = [
        read_split(spark, group, list(columns))
        .withColumn("snapshot_date", snapshot_date_of(F.col("_file"))).drop("_file")
        if split else read_text(spark, group, list(columns), multi_line)
        .withColumn("snapshot_date", snapshot_date_of(F.col("_metadata.file_path")))
        for columns, group in layouts.items()
    ]
    if len(frames) == 1:
        return frames[0]
    everything = {c for frame in frames for c in frame.columns}
    return stacked([
        frame.withColumns({
            c: F.lit(None).cast("string") for c in sorted(everything - set(frame.columns))
        })
        for frame in frames
    ])


def check_columns(raw: DataFrame, kind: str) -> None:
    """Stop unless the columns, after the drop list, are those the archive expects."""
    dropped = set(C.LISTING_DROPPED) if kind == "listings" else set()
    have = set(raw.columns) - dropped - {"snapshot_date"}
    expected = set(C.expected_file_columns(kind))
    optional = set(C.LISTING_QUOTE_COLUMNS) if kind == "listings" else set()
    unknown, missing = sorted(have - expected), sorted(expected - optional - have)
    if unknown or missing:
        raise C.ContractError(f"{kind}: unknown columns {unknown}, missing columns {missing}")
