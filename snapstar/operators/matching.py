"""Joins against reference members: lookups with a default key, and unmatched rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from snapstar.functions.comparison import like, one_spelling
from snapstar.session import settled


def look_up(
    rows: DataFrame, members: DataFrame, natural: dict[str, str], key: str, default: int = 0,
) -> DataFrame:
    """Replace a natural key in ``rows`` by the members' ``key``; unmatched rows get ``default``.

    ``natural`` maps the column of ``rows`` to the column of ``members``. Members must be unique
    on it, also where ``rows`` compare it without case. Null never matches. No row is lost and none is doubled. The join is not hinted: the size
    of stored members tells Spark whether to broadcast them.
    """
    (here, there), = natural.items()
    wanted = members.where(F.col(key) != default).select(
        like(F.col(there), rows, here).alias("_natural"), F.col(key).alias("_key")
    )
    return (
        rows.join(wanted, rows[here] == F.col("_natural"), "left")
        .withColumn(key, F.coalesce(F.col("_key"), F.lit(default)))
        .drop("_natural", "_key")
    )


def keep_known_keys(
    rows: DataFrame, members: DataFrame, key: str, default: int = 0
) -> DataFrame:
    """``key`` where ``members`` has it, ``default`` elsewhere, without moving ``rows``.

    A left join on a large dimension would shuffle every wide row to learn something that is
    nearly always "yes". Instead the distinct keys of ``rows`` (combined before the shuffle, so
    hot keys weigh nothing) are checked, and only the absent ones, normally none, are joined.
    """
    absent = settled(
        rows.select(key).where(F.col(key).isNotNull()).distinct()
        .join(members.select(key), key, "left_anti")
        .select(F.col(key).alias("_absent"))
    )
    if absent.isEmpty():
        return rows.withColumn(key, F.coalesce(F.col(key), F.lit(default)))
    known = F.when(F.col("_absent").isNull(), F.col(key))
    return (
        rows.join(absent, F.col(key) == F.col("_absent"), "left")
        .withColumn(key, F.coalesce(known, F.lit(default)))
        .drop("_absent")
    )


def unmatched_rows(rows: DataFrame, key: str, members: DataFrame, member_key: str) -> DataFrame:
    """One row: how many ``rows`` have a ``key`` no member has (null counts as unmatched).

    Rows are counted per key first, so the anti-join sees each key once.
    """
    per_key = rows.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_rows"))
    known = members.select(F.col(member_key).alias("_key"))
    missing = per_key.join(known, "_key", "left_anti")
    return missing.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("orphan_rows"))


def not_listed(rows: DataFrame, column: str, members: DataFrame, member_column: str) -> DataFrame:
    """Distinct non-null values of ``column`` that ``members`` lacks.

    Null is taken out first: an anti-join would keep it, and it is no value.
    """
    values = one_spelling(rows.where(F.col(column).isNotNull()), column)
    rule = rows.select(column)
    known = members.select(like(F.col(member_column), rule, column).alias("_known"))
    return values.join(known, like(F.col(column), rule, column) == F.col("_known"), "left_anti")
