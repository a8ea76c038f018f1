"""One row, or a few rows, per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def latest_per_key(
    rows: DataFrame, key: str, version: str, tie: str, columns: list[str]
) -> DataFrame:
    """``key`` and ``columns`` of the row with the highest ``version``, lowest ``tie``.

    An aggregation, not a ranking: every task first keeps one row per key of its own input,
    so a key that holds a large share of the rows costs no more than any other. Rows that agree
    even on the tie are told apart by their columns, so a repeated task gives the same answer.
    """
    newest = F.max(F.struct(F.col(version), (-F.col(tie)).alias("_tie"), F.struct(*columns)
                            .alias("_row")))
    return rows.groupBy(key).agg(newest.alias("_newest")).select(key, "_newest._row.*")


def first_per_group(
    rows: DataFrame, group: str, order: list[str], size: int, rank: str = "rn"
) -> DataFrame:
    """The first ``size`` rows of each group in ``order``, numbered by ``rank``.

    The rank filter reaches below the shuffle (WindowGroupLimit), so at most ``size`` rows of
    a group leave each task however large the group is.
    """
    numbered = rows.withColumn(
        rank, F.row_number().over(Window.partitionBy(group).orderBy(*order))
    )
    return numbered.where(F.col(rank) <= size)
