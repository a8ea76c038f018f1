"""The archives: every snapshot ever loaded, one partition per snapshot date.

They are read under a fixed schema, so a column that a later layout added reads null for older
snapshots and no file footer has to be opened to plan a query. Which folder holds a snapshot is said
by the edition (``plans.editions``); functions that write take part in an open change, or make one of
their own and publish it.

A whole-number column whose values outgrow its type can be widened by approval. Each snapshot keeps
the types it was written under; it is read under those and cast to the types in force.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from snapstar import contracts as C
from snapstar.functions import cleaning as clean
from snapstar.functions.comparison import like
from snapstar.operators.tallies import stacked
from snapstar.plans import dimensions as dims, editions
from snapstar.plans.editions import Change, Edition
from snapstar.session import settled
from snapstar.sources.fit import WHOLE_TYPES, strict, whole


LOCATION_KEYS = "location_id int, neighbourhood_cleansed string"
#: Each type and the wider ones that hold all its values.
WIDER = {"smallint": ("int", "bigint", "double"), "int": ("bigint", "double"), "bigint": ()}


class SnapshotExists(C.ContractError):
    """The snapshot is in the archive already; loading it again would double it."""


def snapshot_date_of(path: Column) -> Column:
    """The date in ``.../YYYY-MM-DD_<kind>.csv``."""
    return F.try_to_date(F.regexp_extract(path, r"(\d{4}-\d{2}-\d{2})_[a-z]+\.csv", 1))


def with_category(listings: DataFrame, matched=lambda rows: rows) -> DataFrame:
    """Fill ``property_category`` where it is null; tags from earlier loads stay.

    ``matched`` says how the property type compares with the rules.
    """
    kind = like(F.col("property_type"), matched(listings), "property_type")
    return listings.withColumn("property_category", F.coalesce(
        F.col("property_category"), clean.property_category(kind)
    ))


def retag_categories(listings: DataFrame) -> DataFrame:
    """Every row under today's category rules, for use after the rules changed."""
    return listings.withColumn(
        "property_category", clean.property_category(F.col("property_type"))
    )


def types_in_force(kind: str, held: Edition) -> dict[str, str]:
    """Column -> type of an archive, approved widenings included."""
    return dict(C.ARCHIVE[kind]) | held.types.get(kind, {})


def widen(held: Change, kind: str, approved: dict[str, str]) -> None:
    """Put approved wider types in force; a type that could lose values is refused."""
    current = types_in_force(kind, held)
    for column, target in approved.items():
        if target == current.get(column):
            continue
        if target not in WIDER.get(current.get(column), ()):
            raise C.ContractError(f"{kind}.{column}: {current.get(column)} cannot become {target}")
        held.types.setdefault(kind, {})[column] = target


def conform(rows: DataFrame, kind: str, types: dict[str, str] | None = None) -> DataFrame:
    """``rows`` in the archive's columns and types, by name; columns it lacks are null.

    A value that its archive type cannot hold unchanged stops the job.
    """
    have = dict(rows.dtypes)
    columns = []
    for name, target in (types or dict(C.ARCHIVE[kind])).items():
        if name not in have:
            value = f"cast(null as {target})"
        elif have[name] == target:
            value = f"`{name}`"
        elif have[name] == "string":
            value = strict(name, target)
        elif target in WHOLE_TYPES and have[name] in ("double", "float"):
            value = whole(name, target)
        else:
            value = f"cast(`{name}` as {target})"
        columns.append(f"{value} as `{name}`")
    return rows.selectExpr(*columns)


def _table(kind: str) -> str:
    return f"history/{kind}"


def create(spark: SparkSession, root: str) -> None:
    """A first edition with empty archives if there is none yet."""
    if not editions.numbers(spark, root):
        with editions.change(spark, root) as first:
            first.tables.update({_table(kind): {} for kind in C.ARCHIVE})


def location_keys(spark: SparkSession, root: str, held: Edition) -> DataFrame:
    """The stored location keys of an edition; none before names were listed."""
    part = held.parts("keys/location").get("")
    if part is None:
        return spark.createDataFrame([], LOCATION_KEYS)
    return spark.read.schema(LOCATION_KEYS).parquet(f"{root}/{part.path}")


def keep_location_keys(
    spark: SparkSession, root: str, names: DataFrame, change: Change | None = None
) -> DataFrame:
    """The location dimension of the archived names; a name keeps the key it once got.

    Keys are stored apart and only ever added to, so no later load, in whatever order of dates,
    renumbers a name that facts refer to.
    """
    with editions.change(spark, root, change) as made:
        known = location_keys(spark, root, made)
        fresh = settled(dims.next_location_keys(known, names))
        if not fresh.isEmpty():
            known = made.store("keys/location", known.unionByName(fresh).coalesce(1))
    return dims.location_members(known)


def retag_archive(spark: SparkSession, root: str) -> int:
    """Give every archived listing today's category; rows of partitions that changed.

    Snapshots are rewritten whole, and only those in which a category differs.
    """
    rows = read_archive(spark, root, "listings")
    today = clean.property_category(F.col("property_type"))
    stale = [
        r.snapshot_date for r in rows.where(~F.col("property_category").eqNullSafe(today))
        .select("snapshot_date").distinct().collect()
    ]
    if not stale:
        return 0
    # New rows go to a folder of their own, so the old ones can be read while they are written.
    return append(
        retag_categories(rows.where(F.col("snapshot_date").isin(stale))), root, "listings")


def _schema(types: dict[str, str]) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in types.items())


def forget_state(made: Change) -> None:
    """Leave out tables derived from the archives that would no longer agree with them."""
    for table in [name for name in made.tables if name.startswith("state/")]:
        del made.tables[table]


def read_archive(
    spark: SparkSession, root: str, kind: str, held: Edition | None = None
) -> DataFrame:
    """All snapshots of an archive, of the newest edition or of the one given.

    Snapshots written under the same types are one scan; older types are cast to those in force.
    """
    held = editions.edition(spark, root) if held is None else held
    force = types_in_force(kind, held)
    by_types: dict[str, list[str]] = {}
    for part in held.parts(_table(kind)).values():
        by_types.setdefault(_schema(dict(C.ARCHIVE[kind]) | part.types), []).append(part.path)
    if not by_types:
        return spark.createDataFrame([], _schema(force))
    casts = [f"cast(`{name}` as {target}) as `{name}`" for name, target in force.items()]
    return stacked([
        spark.read.schema(schema).option("basePath", f"{root}/{_table(kind)}")
        .parquet(*[f"{root}/{path}" for path in sorted(paths)])
        .selectExpr(*(force if schema == _schema(force) else casts))
        for schema, paths in sorted(by_types.items())
    ])


def loaded_among(candidates: DataFrame, listings: DataFrame) -> DataFrame:
    """Candidate snapshot dates, each with whether the listings archive holds it.

    Listings are written last, so a date found there was loaded completely.
    """
    held = listings.select("snapshot_date").distinct().withColumn("_held", F.lit(True))
    return (
        candidates.select("snapshot_date").distinct().join(held, "snapshot_date", "left")
        .select("snapshot_date", F.coalesce("_held", F.lit(False)).alias("already_loaded"))
    )


def guard(spark: SparkSession, root: str, dates: list[dt.date]) -> None:
    """Stop if any of ``dates`` is loaded. Reads the named partitions only."""
    held = read_archive(spark, root, "listings").where(F.col("snapshot_date").isin(dates))
    for row in held.select("snapshot_date").limit(1).collect():
        raise SnapshotExists(f"snapshot {row.snapshot_date} is already loaded")


def append(rows: DataFrame, root: str, kind: str, change: Change | None = None) -> int:
    """Write the snapshots in ``rows`` as their partitions and check the count; rows written.

    Snapshots of the same dates are replaced by them. A change of its own is published only if the
    count found agrees with the count written.
    """
    spark = rows.sparkSession
    with editions.change(spark, root, change) as made:
        if change is None:
            forget_state(made)
        types = types_in_force(kind, made)
        differing = {name: t for name, t in types.items() if dict(C.ARCHIVE[kind])[name] != t}
        seen = Observation()
        observed = conform(rows, kind, types).observe(
            seen, F.count("*").alias("rows"), F.collect_set("snapshot_date").alias("dates"),
            F.count_if(F.col("snapshot_date").isNull()).alias("undated"),
        )
        folder = made.folder(_table(kind))
        observed.write.partitionBy("snapshot_date").parquet(f"{root}/{folder}")
        written = seen.get
        for date in written["dates"]:
            made.put(_table(kind), f"{folder}/snapshot_date={date}", str(date), differing)
        stored = (
            read_archive(spark, root, kind, made)
            .where(F.col("snapshot_date").isin(list(written["dates"]))).count()
            if written["dates"] else 0
        )
        if written["undated"] or stored != written["rows"]:
            raise C.ContractError(
                f"{kind}: {written['rows']} rows written, {stored} found, "
                f"{written['undated']} without a date"
            )
    return stored


def remove(spark: SparkSession, root: str, date: dt.date, change: Change | None = None) -> None:
    """Take one snapshot out of listings and reviews; rebuild the star schema afterwards."""
    with editions.change(spark, root, change) as made:
        if change is None:
            forget_state(made)
        for kind in ("listings", "reviews"):
            made.drop(_table(kind), str(date))
