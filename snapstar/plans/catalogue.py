"""The warehouse's tables in the session catalogue, and how they compare with the contract.

Tables are external: the catalogue holds names, columns and folders of the newest edition, the files
stay where they are. A table of snapshots is partitioned by date, each partition at the folder that the
manifest names, so a filter on the date prunes without a listing. ``spark.catalog`` then answers what
tables there are and what columns they have.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from snapstar import contracts as C
from snapstar.plans import editions, history
from snapstar.plans.editions import Edition

DATABASE = "snapstar"
#: Columns that a star table must have, with their types: what the other tables refer to.
STAR_KEYS = {
    "DimLocation": {"location_id": "int", "neighbourhood_cleansed": "string"},
    "DimRoomType": {"room_id": "int", "room_type": "string"},
    "DimPropertyType": {
        "property_id": "int", "property_type": "string", "property_category": "string"},
    "DimHost": {"host_id": "bigint", "host_name": "string", "host_response_rate": "decimal(5,2)"},
    "DimListings": {"listing_id": "bigint", "name": "string"},
    "DimDate": {"date_id": "int", "date": "date"},
    "FactListings": {
        "listing_id": "bigint", "snapshot_date": "date", "host_id": "bigint", "property_id": "int",
        "room_id": "int", "location_id": "int", "price": "decimal(10,2)"},
    "FactReviews": {"review_id": "bigint", "listing_id": "bigint", "date": "date",
                    "is_active": "int"},
}
_DIFFERENCES = "table_name string, column_name string, problem string"


def _create(spark: SparkSession, root: str, held: Edition, table: str, name: str, schema) -> None:
    parts = held.parts(table)
    by_date = "" not in parts
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if not by_date:
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet "
                  f"LOCATION '{root}/{parts[''].path}'")
        return
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (snapshot_date) "
              f"LOCATION '{root}/{table}'")
    for first in range(0, len(parts), 100):
        clauses = " ".join(
            f"PARTITION (snapshot_date = '{date}') LOCATION '{root}/{part.path}'"
            for date, part in sorted(parts.items())[first:first + 100])
        spark.sql(f"ALTER TABLE {name} ADD {clauses}")


def register(spark: SparkSession, root: str, database: str = DATABASE) -> list[str]:
    """Make the catalogue's tables those of the newest edition; their names.

    Archives are listed under ``listings_history`` and so on, star tables under their own names;
    tables that the edition no longer has are taken from the catalogue.
    """
    held = editions.edition(spark, root)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    wanted = {}
    for kind in C.ARCHIVE:
        if held.parts(f"history/{kind}"):
            wanted[f"{kind}_history"] = (
                f"history/{kind}", history.read_archive(spark, root, kind, held).schema)
    for table, parts in held.tables.items():
        if table.startswith("star/") and parts:
            rows = spark.read.option("basePath", f"{root}/{table}").parquet(
                f"{root}/{max(parts.items())[1].path}")
            wanted[table.removeprefix("star/")] = (table, rows.drop("load").schema)
    for name, (table, schema) in wanted.items():
        _create(spark, root, held, table, f"{database}.{name}", schema)
    lowered = {name.lower() for name in wanted}
    for found in spark.catalog.listTables(database):
        if not found.isTemporary and found.name.lower() not in lowered:
            spark.sql(f"DROP TABLE {database}.{found.name}")
    return sorted(wanted)


def table_list(spark: SparkSession, database: str = DATABASE) -> list[str]:
    """The tables the catalogue lists, in lower case as it keeps them."""
    return sorted(t.name.lower() for t in spark.catalog.listTables(database) if not t.isTemporary)


def column_scan(spark: SparkSession, database: str = DATABASE) -> DataFrame:
    """(table_name, position, column_name, data_type, partitions_by) of all catalogue tables."""
    rows = [
        (table, position, column.name, column.dataType, bool(column.isPartition))
        for table in table_list(spark, database)
        for position, column in enumerate(spark.catalog.listColumns(f"{database}.{table}"), 1)
    ]
    return spark.createDataFrame(
        rows, "table_name string, position int, column_name string, data_type string, "
              "partitions_by boolean")


def differences(spark: SparkSession, root: str, database: str = DATABASE) -> DataFrame:
    """(table_name, column_name, problem): where catalogue and contract disagree; none when all is well.

    Archives must have exactly their contract's columns (types in force included); star tables at
    least their keys. A table without a counterpart in the other is a problem of its own.
    """
    held = editions.edition(spark, root)
    expected = {f"{kind}_history": history.types_in_force(kind, held) for kind in C.ARCHIVE}
    expected |= STAR_KEYS
    names = {name.lower(): name for name in expected}
    found: dict[str, dict[str, str]] = {}
    for row in column_scan(spark, database).collect():  # a row per column
        found.setdefault(row.table_name, {})[row.column_name] = row.data_type
    problems = [(names[t], None, "table is missing") for t in sorted(names.keys() - found.keys())]
    problems += [(t, None, "table is unknown") for t in sorted(found.keys() - names.keys())]
    for table in sorted(names.keys() & found.keys()):
        want, have = expected[names[table]], found[table]
        problems += [(names[table], c, "column is missing") for c in want if c not in have]
        if table.endswith("_history"):
            problems += [(names[table], c, "column is unknown") for c in have if c not in want]
        problems += [
            (names[table], c, f"is {have[c]}, not {kind}") for c, kind in want.items()
            if c in have and have[c] != kind]
    return spark.createDataFrame(problems, _DIFFERENCES)


def partitions(spark: SparkSession, table: str, database: str = DATABASE) -> list[str]:
    """The snapshot dates of a table, from the catalogue alone."""
    shown = spark.sql(f"SHOW PARTITIONS {database}.{table}").select(
        F.regexp_extract("partition", "snapshot_date=(.*)", 1).alias("date"))
    return sorted(row.date for row in shown.collect())
