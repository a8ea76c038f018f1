"""Newest row per key as stored state, merged with each snapshot instead of found anew.

For hosts, listings and reviews the warehouse keeps one row per key: the newest row, the snapshot it
comes from, and the first snapshot that held the key. The rows lie in hash buckets of the key. A load
merges them with the new snapshot alone: both sides are dealt by the same hash, so only the new rows
are shuffled, and past snapshots are not read. Rows compare by (snapshot, tie), so late snapshots may
come in any order. Taking a snapshot out changes only keys that it was the newest or the first to hold;
those are found in the state and recomputed from the snapshots that stay.

Of room and property types, the distinct names of each snapshot are kept.

State belongs to the edition (``plans.editions``): it is written beside the archives and switches with
them.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from snapstar.plans import buckets, dimensions as dims, editions, history
from snapstar.plans.editions import Change, Edition

#: Hash buckets of each state table. Chosen for the keys expected in all, as it stays.
BUCKETS = 64


@dataclass(frozen=True)
class Kind:
    """What is kept of an archive: per ``key`` the newest ``columns`` (lowest ``tie``)."""

    archive: str
    key: str
    tie: str
    columns: tuple[str, ...]

    def types(self, held: Edition) -> dict[str, str]:
        return history.types_in_force(self.archive, held)

    def schema(self, held: Edition) -> str:
        types = self.types(held)
        row = ", ".join(f"`{name}`: {types[name]}" for name in self.columns)
        return (f"`{self.key}` {types[self.key]}, newest struct<snapshot_date: date, "
                f"tie: {types[self.tie]}, row: struct<{row}>>, first date")


KINDS = {
    "hosts": Kind("listings", "host_id", "id", tuple(dims.HOST_ATTRIBUTES)),
    "listings": Kind("listings", "id", "id", tuple(dims.LISTING_ATTRIBUTES)),
    "reviews": Kind("reviews", "id", "listing_id", ("listing_id", "date", "reviewer_id")),
}


#: Columns whose distinct names are kept.
NAMED = ("room_type", "property_type")


def found(rows: DataFrame, kind: Kind) -> DataFrame:
    """The state of ``rows`` alone: newest row and first snapshot of each key.

    An aggregation, so a task keeps one row per key of its input before the shuffle. Null keys are
    left out, as no dimension has them.
    """
    tie = (-F.col(kind.tie)).alias("tie")
    newest = F.struct("snapshot_date", tie, F.struct(*kind.columns).alias("row"))
    return rows.where(F.col(kind.key).isNotNull()).groupBy(kind.key).agg(
        F.max(newest).alias("newest"), F.min("snapshot_date").alias("first"))


def _table(name: str) -> str:
    return f"state/{name}"


def read_state(spark: SparkSession, root: str, name: str, held: Edition | None = None) -> DataFrame:
    """The state of a kind, bucketed by its key; no rows if the edition has none."""
    held = editions.edition(spark, root) if held is None else held
    kind, part = KINDS[name], held.parts(_table(name)).get("")
    schema = kind.schema(held)
    if part is None:
        return spark.createDataFrame([], schema)
    return buckets.read(spark, root, part, schema, kind.key)


def _store(made: Change, name: str, rows: DataFrame, dealt: int) -> None:
    buckets.write(made, _table(name), rows, KINDS[name].key, dealt)


def _buckets(made: Change, name: str, first: int | None = None) -> int:
    part = made.parts(_table(name)).get("")
    return int(part.types["buckets"]) if part else first or BUCKETS


def merged(state: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """Two states as one: the newer row of each key, the earlier first snapshot."""
    other = fresh.select(F.col(key).alias("_key"), F.col("newest").alias("_newest"),
                         F.col("first").alias("_first"))
    return state.join(other, F.col(key) == F.col("_key"), "full_outer").select(
        F.coalesce(key, "_key").alias(key), _newer("newest", "_newest").alias("newest"),
        F.least("first", "_first").alias("first"))


def _newer(left: str, right: str):
    order = lambda side: F.struct(f"{side}.snapshot_date", f"{side}.tie")
    stays = F.col(right).isNull() | (F.col(left).isNotNull() & (order(left) >= order(right)))
    return F.when(stays, F.col(left)).otherwise(F.col(right))


def add(
    made: Change, dates: list[dt.date] | None = None, names: tuple[str, ...] = (*KINDS, "names"),
    first: int | None = None,
) -> None:
    """Merge the snapshots of ``dates`` of the change into its state (all, if none are named).

    The dates must be new to the state; a snapshot that is loaded again is taken out first. ``names``
    are the kinds of state to keep, all by default; ``first`` is the number of buckets to begin with.
    """
    for name, kind in KINDS.items():
        if name not in names:
            continue
        rows = history.read_archive(made.spark, made.root, kind.archive, made)
        if dates is not None:
            rows = rows.where(F.col("snapshot_date").isin(dates))
        dealt = _buckets(made, name, first)
        fresh = found(rows, kind).repartition(dealt, F.col(kind.key))
        if made.parts(_table(name)):
            state = read_state(made.spark, made.root, name, made)
            fresh = merged(state, fresh, kind.key)
        _store(made, name, fresh, dealt)
    if "names" in names:
        _add_names(made, dates)


def _add_names(made: Change, dates: list[dt.date] | None) -> None:
    listings = history.read_archive(made.spark, made.root, "listings", made)
    rows = listings if dates is None else listings.where(F.col("snapshot_date").isin(dates))
    folder, seen = made.folder("state/names"), Observation()
    rows.select("snapshot_date", *NAMED).unpivot(
        "snapshot_date", list(NAMED), "_of", "_name"
    ).distinct().observe(seen, F.collect_set("snapshot_date").alias("dates")).coalesce(1).write \
        .partitionBy("snapshot_date").parquet(f"{made.root}/{folder}")
    for date in seen.get["dates"]:
        made.put("state/names", f"{folder}/snapshot_date={date}", str(date))


def observed_names(spark: SparkSession, root: str, held: Edition) -> dict[str, DataFrame]:
    """The distinct room and property types of all snapshots, from state."""
    paths = [f"{root}/{part.path}" for part in held.parts("state/names").values()]
    schema = "_of string, _name string"
    found_ = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    return {
        name: found_.where(F.col("_of") == name).select(F.col("_name").alias(name)).distinct()
        for name in NAMED}


def take_out(made: Change, date: dt.date) -> None:
    """Make the state that of the snapshots the change still has, after ``date`` was removed."""
    made.drop("state/names", str(date))
    touched = (F.col("newest.snapshot_date") == F.lit(date)) | (F.col("first") == F.lit(date))
    for name, kind in KINDS.items():
        if not made.parts(_table(name)):
            continue
        state, dealt = read_state(made.spark, made.root, name, made), _buckets(made, name)
        rest = history.read_archive(made.spark, made.root, kind.archive, made)
        keys = state.where(touched).select(kind.key)
        fresh = found(rest.join(keys, kind.key, "left_semi"), kind).repartition(
            dealt, F.col(kind.key))
        other = fresh.select(F.col(kind.key).alias("_key"), F.col("newest").alias("_newest"),
                             F.col("first").alias("_first"))
        joined = state.join(other, F.col(kind.key) == F.col("_key"), "left")
        stays = ~touched | F.col("_key").isNotNull()
        _store(made, name, joined.where(stays).select(
            kind.key, F.when(touched, F.col("_newest")).otherwise(F.col("newest")).alias("newest"),
            F.when(touched, F.col("_first")).otherwise(F.col("first")).alias("first"),
        ), dealt)


def start(
    spark: SparkSession, root: str, change: Change | None = None, first: int | None = None
) -> None:
    """Begin to keep state, from whatever the archives hold; also makes it anew."""
    dealt = first or BUCKETS
    with editions.change(spark, root, change) as made:
        for name, kind in KINDS.items():
            rows = history.read_archive(spark, root, kind.archive, made)
            _store(made, name, found(rows, kind).repartition(dealt, F.col(kind.key)), dealt)
        made.tables.pop("state/names", None)
        _add_names(made, None)


def kept(held: Edition) -> bool:
    """Whether an edition keeps state of every kind."""
    return all(held.parts(_table(name)) for name in KINDS)


def newest(state: DataFrame, kind: Kind) -> DataFrame:
    """(key, columns) of the newest rows, as the dimensions take them."""
    return state.select(kind.key, *[
        F.col(f"newest.row.{name}").alias(name) for name in kind.columns if name != kind.key])


def newest_snapshot(held: Edition, kind: str) -> dt.date | None:
    """The newest snapshot of an archive, from the manifest alone."""
    return max(map(dt.date.fromisoformat, held.parts(f"history/{kind}")), default=None)


def dim_host(spark: SparkSession, root: str, held: Edition | None = None) -> DataFrame:
    """The host dimension from state."""
    return dims.host_members(newest(read_state(spark, root, "hosts", held), KINDS["hosts"]))


def dim_listings(spark: SparkSession, root: str, held: Edition | None = None) -> DataFrame:
    """The listing dimension from state."""
    return dims.listing_members(newest(read_state(spark, root, "listings", held), KINDS["listings"]))


def fact_reviews(spark: SparkSession, root: str, held: Edition | None = None) -> DataFrame:
    """The review fact from state; which snapshot is the newest is read off the manifest."""
    held = editions.edition(spark, root) if held is None else held
    last = newest_snapshot(held, "reviews")
    return read_state(spark, root, "reviews", held).select(
        F.col("id").alias("review_id"), "newest.row.listing_id", "newest.row.date",
        "newest.row.reviewer_id", F.col("first").alias("first_snapshot_date"),
        (F.col("newest.snapshot_date") == F.lit(last)).cast("int").alias("is_active"))
