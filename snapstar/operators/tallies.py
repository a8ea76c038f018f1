"""Counts that several checks share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def stacked(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def row_counts(tables: dict[str, DataFrame], by: str | None = None) -> DataFrame:
    """Rows per table, and per ``by`` where given, one tagged row each."""
    def counted(name: str, table: DataFrame) -> DataFrame:
        if by is None:
            counts = table.agg(F.count("*").alias("row_count"))
            return counts.select(F.lit(name).alias("table_name"), "row_count")
        counts = table.groupBy(by).agg(F.count("*").alias("row_count"))
        return counts.select(F.lit(name).alias("table_name"), by, "row_count")

    return stacked([counted(name, table) for name, table in tables.items()])


def repeated_keys(rows: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, with the number of occurrences."""
    return (
        rows.groupBy(*key).agg(F.count("*").alias("duplicates")).where(F.col("duplicates") > 1)
    )


def value_counts(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct values of several text columns in one pass: column_name, value, row_count."""
    long = rows.select(*columns).unpivot([], columns, "column_name", "value")
    return long.groupBy("column_name", "value").agg(F.count("*").alias("row_count"))


def null_rows(column: str) -> Column:
    return F.count_if(F.col(column).isNull())
