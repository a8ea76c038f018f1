"""Tables of an edition in hash buckets of a key, so that joins on it do not move them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from snapstar.plans.editions import Change, Part


def read(spark: SparkSession, root: str, part: Part, schema: str, key: str) -> DataFrame:
    """The rows of a stored part under ``schema``, known to lie in buckets of ``key``."""
    # Buckets are a property of a catalogue table; the name is needed for this one reading.
    table = f"state_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {table} ({schema}) USING parquet CLUSTERED BY (`{key}`) "
        f"SORTED BY (`{key}`) INTO {part.types['buckets']} BUCKETS LOCATION '{root}/{part.path}'")
    rows = spark.table(table)
    rows.schema  # resolved: the files are known, the name is no longer needed
    spark.sql(f"DROP TABLE {table}")
    return rows


def write(made: Change, name: str, rows: DataFrame, key: str, buckets: int) -> None:
    """Store ``rows`` as the table ``name`` of the change."""
    path, table = made.folder(name), f"state_{uuid.uuid4().hex}"
    rows.write.bucketBy(buckets, key).sortBy(key).option(
        "path", f"{made.root}/{path}").saveAsTable(table)
    made.spark.sql(f"DROP TABLE {table}")  # external: the files stay
    made.put(name, path, types={"buckets": str(buckets)})
