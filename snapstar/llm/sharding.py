"""Sharding by a permutation-filled lookup table.

Every shard prefers the slots of a table of prime size in an order of its own: a start and a step,
both hashed from its name. Shards take turns; on its turn a shard claims the first slot of its
order that is still free, until the table is full. A key is hashed to a slot and the slot names
the shard, so placement is one lookup in a broadcast table, needs no shuffle, spreads keys evenly
and moves few of them when a shard joins or leaves.

The table is configuration: its size is a parameter (``SLOTS``, at most ``MOST_SLOTS``) and
nothing in it depends on the data. It is filled once on the driver and joined as a broadcast of
proven size (8 bytes a slot); rows see DataFrame functions only.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from snapstar.llm.text import table

SLOTS, MOST_SLOTS = 4099, 1_000_003
SHARDS = tuple(f"shard-{number:02d}" for number in range(24))


def _hashed(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def is_prime(number: int) -> bool:
    return number > 1 and all(number % k for k in range(2, int(number**0.5) + 1))


def filled_table(shards: tuple[str, ...], slots: int = SLOTS) -> list[int]:
    """Slot -> position of the shard that claimed it."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be distinct, one at least")
    if not is_prime(slots) or not len(shards) <= slots <= MOST_SLOTS:
        raise ValueError(f"slots must be a prime from the number of shards to {MOST_SLOTS}")
    at = [_hashed("start:" + name) % slots for name in shards]
    step = [_hashed("step:" + name) % (slots - 1) + 1 for name in shards]
    owner: list[int] = [-1] * slots
    for turn in range(slots):
        shard = turn % len(shards)
        while owner[at[shard]] >= 0:
            at[shard] = (at[shard] + step[shard]) % slots
        owner[at[shard]] = shard
    return owner


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key: the first 8 hex digits of the md5 of its text; null counts as empty."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % slots).cast("int")


def lookup(spark: SparkSession, shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """The table as rows (slot, shard); the claims are one literal that SQL takes apart."""
    owners = F.split(F.lit(",".join(map(str, filled_table(shards, slots)))), ",")
    names = F.split(F.lit("\n".join(shards)), "\n")
    one = spark.range(1).select(F.posexplode(owners).alias("slot", "owner"))
    return one.select("slot", F.element_at(names, F.col("owner").cast("int") + 1).alias("shard"))


def place(
    rows: DataFrame, key: str, shards: tuple[str, ...] = SHARDS, slots: int = SLOTS
) -> DataFrame:
    """(key, slot, shard) for every row, rows and repeats kept, other columns left out.

    A null key is placed like the empty text; empty input gives no rows; ties cannot occur, as a
    slot has one owner. One hot key is one shard by definition, but no task, as nothing moves.
    """
    keyed = rows.select(F.col(key).alias("_key"), slot_of(F.col(key), slots).alias("slot"))
    return keyed.join(F.broadcast(lookup(rows.sparkSession, shards, slots)), "slot").select(
        F.col("_key").alias(key), "slot", "shard"
    )


def write_sharded(
    rows: DataFrame, key: str, folder: str, shards: tuple[str, ...] = SHARDS, slots: int = SLOTS,
    files: int = 8,
) -> None:
    """Write whole rows as one Parquet folder per shard; ``files`` tasks share each shard.

    Rows of a shard are dealt by the hash of the whole row, so a hot key does not make a hot task.
    The folder column is named ``shard``; a column of that name in the input must be renamed first.
    """
    if "shard" in rows.columns:
        raise ValueError("the input has a column named shard")
    placed = rows.withColumn("_slot", slot_of(F.col(key), slots)).join(
        F.broadcast(lookup(rows.sparkSession, shards, slots).withColumnRenamed("slot", "_slot")),
        "_slot",
    ).drop("_slot")
    salt = F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in rows.columns]), F.lit(files))
    placed.repartition(len(shards) * files, "shard", salt).write.partitionBy("shard").parquet(folder)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document, and the one it would move to were the last shard removed."""
    placed = place(table(spark, sf_dir, "documents"), "doc_id")
    fewer = lookup(spark, SHARDS[:-1]).withColumnRenamed("shard", "shard_without_last")
    return placed.join(F.broadcast(fewer), "slot")


def _shard_sql(shards: tuple[str, ...]) -> str:
    names = ",".join(shards[owner] for owner in filled_table(shards))
    return f"string_split('{names}', ',')[slot + 1]"


#: The filled table is a literal here (tests compare it with its definition); the SQL checks slots.
OP8_SQL = f"""
SELECT doc_id, slot, {_shard_sql(SHARDS)} AS shard, {_shard_sql(SHARDS[:-1])} AS shard_without_last
FROM (
    SELECT doc_id, (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT
                    % {SLOTS})::INTEGER AS slot
    FROM documents)
"""
