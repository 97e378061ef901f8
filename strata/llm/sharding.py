"""Sharding by a permutation-filled lookup table."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.shared import without


def is_prime(n: int) -> bool:
    return n > 1 and all(n % i for i in range(2, int(n**0.5) + 1))


def fill_table(shards: list[str], size: int) -> list[int]:
    """The shard (its place in ``shards``) of each slot.

    Each shard prefers the slots offset, offset + skip, offset + 2 skip, ... modulo the prime ``size``, both from a hash of its name;
    shards take turns, each claiming the first free slot of its order, until the table is full. Adding or removing a
    shard moves few slots. The table is bounded by ``size``, so filling it is a small driver loop.
    """
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be given and differ")
    if not is_prime(size) or size < len(shards):
        raise ValueError("the table's size must be a prime not below the number of shards")
    words = [hashlib.md5(s.encode()).digest() for s in shards]
    at = [int.from_bytes(d[:8], "big") % size for d in words]
    skip = [int.from_bytes(d[8:], "big") % (size - 1) + 1 for d in words]
    table, free, turn = [-1] * size, size, 0
    while free:
        k = turn % len(shards)
        while table[at[k]] >= 0:
            at[k] = (at[k] + skip[k]) % size
        table[at[k]] = k
        free, turn = free - 1, turn + 1
    return table


def lookup_table(spark: SparkSession, shards: list[str], size: int = 65537) -> DataFrame:
    """(slot, shard): ``size`` rows of at most 32 bytes, the proven bound for broadcasting it."""
    packed = b"".join(k.to_bytes(4, "big") for k in fill_table(shards, size))
    names = F.split(F.lit("\n".join(shards)), "\n")
    index = F.conv(F.hex(F.substring(F.lit(packed), F.col("id").cast("int") * 4 + 1, F.lit(4))), 16, 10).cast("int")
    return spark.range(size).select(F.col("id").alias("slot"), F.element_at(names, index + 1).alias("shard"))


def assign_shards(docs: DataFrame, shards: list[str], *, key_col: str = "doc_id", size: int = 65537) -> DataFrame:
    """``docs`` with slot (long) and shard (string), by a hash of the key's text: a hot source spreads like any other.

    Defined results: a null key is placed as the empty text; equal keys share a shard; input columns named slot or shard are
    replaced; an empty table gives an empty table. Placement reads the key only, so text may be null or of any length.
    """
    docs = without(docs, "slot", "shard")
    slot = F.pmod(F.conv(F.substring(F.md5(F.coalesce(F.col(key_col).cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long"), F.lit(size))
    return docs.withColumn("slot", slot).join(F.broadcast(lookup_table(docs.sparkSession, shards, size)), "slot").select(*[F.col(f"`{c}`") for c in docs.columns], "slot", "shard")
