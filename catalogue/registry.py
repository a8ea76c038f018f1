"""Key -> (Spark query, SQL). A query returns only plain types: decimals leave as doubles."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType, ShortType

from catalogue.sql_views import with_views


@dataclass(frozen=True)
class Entry:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def plain(rows: DataFrame) -> DataFrame:
    """Decimals as doubles and short integers as integers, so both engines agree on types."""
    return rows.select(*[
        F.col(f.name).cast("double") if isinstance(f.dataType, DecimalType)
        else F.col(f.name).cast("int") if isinstance(f.dataType, ShortType)
        else F.col(f.name)
        for f in rows.schema.fields
    ])


def query(views: str | None = None, sql: str | None = None, key: str | None = None):
    """Register the decorated function under its name; ``views`` are those ``sql`` reads."""
    def register(run: Callable[[SparkSession, str], DataFrame]):
        name = key or run.__name__
        text = with_views(views or "", sql) if sql else None
        ENTRIES[name] = Entry(lambda spark, sf_dir: plain(run(spark, sf_dir)), text)
        return run
    return register
