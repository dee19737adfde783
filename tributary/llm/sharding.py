"""Placement by a lookup table that shards fill in turn.

Each shard has its own order of preference over the slots of a table of prime size: a start and a step, both
hashes of its name. Shards take turns, by weight, each claiming its next free slot, until the table is full.
A key's slot is its hash modulo the size, so placement is one step, shards get equal parts of the table, and
when a shard comes or goes few keys move between the others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm.common import free_name, named

#: A prime of over a hundred times the usual number of shards.
SIZE = 65_537


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _hash(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{salt}:{name}".encode(), digest_size=8).digest(), "little")


def fill(shards: Sequence[str], size: int = SIZE, weights: Sequence[int] | None = None) -> np.ndarray:
    """The place in `shards` of the shard that holds each slot.

    In each turn a shard claims as many slots as its weight. `shards` must be distinct and at most `size`;
    their order only decides who claims first, so it should be kept.
    """
    if not shards or len(set(shards)) != len(shards) or len(shards) > size or not _is_prime(size):
        raise ValueError("shards must be given, distinct, and no more than the prime size of the table")
    weights = list(weights or [1] * len(shards))
    if len(weights) != len(shards) or min(weights) < 1:
        raise ValueError("each shard needs a weight of at least 1")
    at = [_hash(s, "start") % size for s in shards]
    step = [_hash(s, "step") % (size - 1) + 1 for s in shards]
    table = [-1] * size
    free = size
    while free:
        for shard, turns in enumerate(weights):
            for _ in range(min(turns, free)):
                slot = at[shard]
                while table[slot] >= 0:
                    slot = (slot + step[shard]) % size
                table[slot] = shard
                at[shard] = (slot + step[shard]) % size
                free -= 1
    return np.array(table, np.int32)


def slot_of(*keys: Column, size: int = SIZE) -> Column:
    """The slot of a key. Equal keys share it; a null key has one too."""
    return F.pmod(F.xxhash64(*keys), F.lit(size)).cast("int")


def table_frame(spark: SparkSession, shards: Sequence[str], size: int = SIZE, weights: Sequence[int] | None = None) -> DataFrame:
    """(slot, shard): as many rows as the table has slots."""
    filled = fill(shards, size, weights)
    return spark.createDataFrame([(i, shards[s]) for i, s in enumerate(filled.tolist())], "slot int, shard string")


def place(
    df: DataFrame, key_cols: Sequence[str], shards: Sequence[str], size: int = SIZE,
    weights: Sequence[int] | None = None, shard_col: str = "shard",
) -> DataFrame:
    """The rows of `df` with the shard of their key in `shard_col`, which replaces a column of that name.

    The table has `size` rows whatever the data, so it is broadcast. Rows with equal keys, null ones too, go to
    one shard; repeated rows stay. Every row comes back once.
    """
    slot, found = free_name(df, "slot"), free_name(df, "found_shard")
    table = table_frame(df.sparkSession, shards, size, weights).toDF(slot, found)
    placed = df.withColumn(slot, slot_of(*map(named, key_cols), size=size)).join(F.broadcast(table), slot)
    return placed.select(*(named(c) for c in df.columns if c.lower() != shard_col.lower()), named(found).alias(shard_col))


def write_shards(df: DataFrame, path: str, key_cols: Sequence[str], shards: Sequence[str], files: int = 4, **table) -> None:
    """Write the rows as Parquet, a folder for each shard and up to `files` files in it.

    Rows are dealt to files by a hash of the whole row, so a hot key does not fill one task, beyond copies of
    one row, and a task that is run again deals them alike.
    """
    placed = place(df, key_cols, shards, **table)
    file_no = free_name(placed, "file_no")
    dealt = placed.withColumn(file_no, F.pmod(F.xxhash64(*map(named, df.columns)), F.lit(files)))
    dealt.repartition(len(shards) * files, "shard", named(file_no)).drop(file_no).write.mode("overwrite").partitionBy("shard").parquet(path)
