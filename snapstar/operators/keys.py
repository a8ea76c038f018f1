"""Surrogate keys 1..n in the order of the natural key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from snapstar.session import settled


def numbered(keys: DataFrame, order: list[str], number: str) -> DataFrame:
    """Distinct ``keys`` with ``number`` = position of the key in ``order``, from 1.

    Rank inside a key range plus the number of keys in all lower ranges. The range of each key is
    written down before it is counted, so a recomputed task cannot draw other bounds. The only
    one-task step runs over one row per range.
    """
    spark = keys.sparkSession
    ranges = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = settled(
        keys.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id())
    )
    below = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_range").agg(F.count("*").alias("_keys")).select(
        "_range", F.coalesce(F.sum("_keys").over(below), F.lit(0)).alias("_start")
    )
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return (
        placed.withColumn("_inside", inside)
        .join(F.broadcast(starts), "_range")  # at most `ranges` rows
        .withColumn(number, (F.col("_start") + F.col("_inside")).cast("int"))
        .drop("_range", "_start", "_inside")
    )


def numbered_names(names: DataFrame, name: str, number: str) -> DataFrame:
    """Distinct texts with ``number`` = position of the text in byte order, from 1.

    As ``numbered``, but ranges are the first two bytes of the text, so they are the same in every run:
    nothing is sampled or written down first. A range is sorted in one task, which may spill; it holds
    one row per distinct text.
    """
    placed = names.select(
        F.col(name), F.substring(F.col(name).cast("binary"), 1, 2).alias("_range"))
    below = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_range").agg(F.count("*").alias("_names")).select(
        F.col("_range").alias("_of"), F.coalesce(F.sum("_names").over(below), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(name))
    return placed.withColumn("_inside", inside).join(
        F.broadcast(starts), F.col("_range") == F.col("_of")  # at most 65,793 ranges
    ).select(name, (F.col("_start") + F.col("_inside")).cast("int").alias(number))
