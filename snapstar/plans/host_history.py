"""Versions of hosts as stored intervals, merged with one snapshot instead of found anew.

The warehouse keeps one row per host: its intervals in order, each with the values that hold in it
and the snapshots that show them. A snapshot, whenever it comes, changes only the hosts it holds. In
an interval of other values it closes and splits it, between equal neighbours it joins them, behind
the last it opens a new one. Taking a snapshot out needs the intervals alone: its date goes, an
interval without dates goes with it, and neighbours that became equal join. No past snapshot is read
for either, and rows of other hosts pass through as they are.

A host's row grows with the number of snapshots only. The rows lie in hash buckets of the host, so a
merge moves the new snapshot's hosts and nothing else.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from snapstar.plans import buckets, editions, history, latest_state
from snapstar.plans.editions import Change, Edition
from snapstar.plans.investor import host_fields, host_snapshots

TABLE = "state/host_versions"


def sightings(listings: DataFrame) -> DataFrame:
    """(host_id, seen): a host's snapshots in order, each with its values. Null hosts are left out."""
    fields = host_fields()
    rows = host_snapshots(listings.where(F.col("host_id").isNotNull()), **fields)
    return rows.groupBy("host_id").agg(F.array_sort(F.collect_list(
        F.struct("snapshot_date", F.struct(*fields).alias("value")))).alias("seen"))


def _dated(versions: Column) -> Column:
    """The intervals as one list of (snapshot_date, value)."""
    return F.flatten(F.transform(versions, lambda v: F.transform(
        v["dates"], lambda day: F.struct(day.alias("snapshot_date"), v["value"].alias("value")))))


def _joined(rows: DataFrame) -> DataFrame:
    """(host_id, versions): the intervals that ``seen`` makes; ``versions`` where it is null."""
    seen, starts = F.col("seen"), F.col("_starts")
    value = lambda i: F.get(seen, i)["value"]
    begins = F.filter(
        F.sequence(F.lit(0), F.size(seen) - 1),
        lambda i: (i == 0) | ~value(i).eqNullSafe(value(i - 1)))
    found = F.transform(starts, lambda at, k: F.struct(
        value(at).alias("value"),
        F.transform(
            F.slice(seen, at + 1, F.coalesce(F.get(starts, k + 1), F.size(seen)) - at),
            lambda one: one["snapshot_date"]).alias("dates")))
    some = rows.where(seen.isNull() | (F.size(seen) > 0))
    return some.withColumn("_starts", F.when(seen.isNotNull(), begins)).select(
        "host_id", F.coalesce(F.when(seen.isNotNull(), found), "versions").alias("versions"))


def begun(fresh: DataFrame) -> DataFrame:
    """The state of sightings alone."""
    return _joined(fresh.withColumn("versions", F.lit(None).cast(_kind(fresh))))


def _kind(fresh: DataFrame) -> str:
    value = fresh.schema["seen"].dataType.elementType["value"].dataType.simpleString()
    return f"array<struct<value:{value},dates:array<date>>>"


def merged(state: DataFrame, fresh: DataFrame) -> DataFrame:
    """The state with ``fresh`` sightings in it; their dates must be new to it."""
    other = fresh.select(F.col("host_id").alias("_host"), F.col("seen").alias("_seen"))
    both = state.join(other, F.col("host_id") == F.col("_host"), "full_outer")
    known = F.coalesce(_dated(F.col("versions")), F.filter("_seen", lambda _: F.lit(False)))
    return _joined(both.select(
        F.coalesce("host_id", "_host").alias("host_id"), "versions",
        F.when(F.col("_seen").isNotNull(), F.array_sort(F.concat(known, "_seen"))).alias("seen")))


def without(state: DataFrame, date: dt.date) -> DataFrame:
    """The state as it is without one snapshot."""
    day = F.lit(date)
    holds = F.exists("versions", lambda v: F.array_contains(v["dates"], day))
    return _joined(state.withColumn("seen", F.when(
        holds, F.filter(_dated(F.col("versions")), lambda one: one["snapshot_date"] != day))))


def kept(held: Edition) -> bool:
    return bool(held.parts(TABLE))


def read_state(spark: SparkSession, root: str, held: Edition) -> DataFrame:
    fresh = sightings(history.read_archive(spark, root, "listings", held))
    part = held.parts(TABLE).get("")
    schema = f"host_id {fresh.schema['host_id'].dataType.simpleString()}, versions {_kind(fresh)}"
    if part is None:
        return spark.createDataFrame([], schema)
    return buckets.read(spark, root, part, schema, "host_id")


def add(made: Change, dates: list[dt.date] | None = None, dealt: int | None = None) -> None:
    """Merge the snapshots of ``dates``, which must be new to the state; all without dates."""
    rows = history.read_archive(made.spark, made.root, "listings", made)
    if dates is not None:
        rows = rows.where(F.col("snapshot_date").isin(dates))
    part = made.parts(TABLE).get("")
    dealt = int(part.types["buckets"]) if part else dealt or latest_state.BUCKETS
    fresh = sightings(rows).repartition(dealt, "host_id")
    state = merged(read_state(made.spark, made.root, made), fresh) if part else begun(fresh)
    buckets.write(made, TABLE, state, "host_id", dealt)


def take_out(made: Change, date: dt.date) -> None:
    """Make the state that of all snapshots but one."""
    state, dealt = read_state(made.spark, made.root, made), made.parts(TABLE)[""].types["buckets"]
    buckets.write(made, TABLE, without(state, date), "host_id", int(dealt))


def start(made: Change) -> None:
    """Begin the state anew from all snapshots of the change."""
    made.drop(TABLE)
    add(made)


def host_versions(spark: SparkSession, root: str, held: Edition | None = None) -> DataFrame:
    """The table of ``investor.host_versions``, from state."""
    held = editions.edition(spark, root) if held is None else held
    first = lambda version: F.get(version["dates"], F.lit(0))
    rows = read_state(spark, root, held).select(
        "host_id", "versions", F.posexplode("versions").alias("_at", "_version"))
    until = first(F.get("versions", F.col("_at") + 1))
    return rows.select(
        "host_id", "_version.value.*", first(F.col("_version")).alias("valid_from"),
        until.alias("valid_to"), until.isNull().cast("int").alias("is_current"))
