"""Exact medians per group that never gather a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def grouped_median(
    counted: DataFrame, groups: list[str], value: str, rows: str, band_width: int = 1000
) -> DataFrame:
    """``groups`` and the exact ``median`` of the decimal(10,2) column ``value``.

    ``counted`` has one row per group and value, and ``rows`` says how often it occurs. It is read
    twice, so it should be a settled result. A first, coarse cumulative count over bands of
    ``band_width`` finds the band each middle row lies in; only that band is then ranked finely.
    With two decimals a group has at most 1e8 / band_width bands, and a band at most
    100 * band_width values, so every window has a fixed size bound whatever the group holds.
    """
    counted = counted.where(F.col(value).isNotNull()).select(
        *groups, value, F.col(rows).alias("_n"), F.floor(F.col(value) / band_width).alias("_band")
    )
    in_group = Window.partitionBy(*groups)
    upward = in_group.orderBy("_band").rowsBetween(Window.unboundedPreceding, 0)
    bands = counted.groupBy(*groups, "_band").agg(F.sum("_n").alias("_in_band"))
    bands = bands.select(
        *groups, "_band", F.sum("_in_band").over(in_group).alias("_all"),
        (F.sum("_in_band").over(upward) - F.col("_in_band")).alias("_below"), "_in_band",
    )
    # The middle row, or the two middle rows, as positions from 1.
    low, high = F.floor((F.col("_all") + 1) / 2), F.floor((F.col("_all") + 2) / 2)
    holds = lambda spot, below, size: (below < spot) & (spot <= below + size)
    middle = bands.where(
        holds(low, F.col("_below"), F.col("_in_band"))
        | holds(high, F.col("_below"), F.col("_in_band"))
    ).drop("_in_band")
    in_band = (
        Window.partitionBy(*groups, "_band").orderBy(value)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    ranked = counted.join(middle, [*groups, "_band"]).withColumn(
        "_before", F.col("_below") + F.sum("_n").over(in_band) - F.col("_n")
    )
    spots = ranked.withColumn(
        "_spots",
        holds(low, F.col("_before"), F.col("_n")).cast("int")
        + holds(high, F.col("_before"), F.col("_n")).cast("int"),
    ).where(F.col("_spots") > 0)
    # Either one value stands on both spots, or two values on one each.
    return spots.groupBy(*groups).agg(
        (F.sum(F.col(value) * F.col("_spots")) / 2).cast("decimal(12,3)").alias("median")
    )
