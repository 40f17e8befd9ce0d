"""Operator 8: sharding by a permutation-filled lookup table.

Every shard has a preference order of the slots of a prime-sized table: the walk
offset, offset + skip, offset + 2 skip, ... modulo the prime, with offset and skip
hashed from its name.  The shards take turns claiming their next free slot until
the table is full, so each owns the same number of slots (give or take one) and a
change of the shard list moves few slots.  A document's slot is a hash of its id
modulo the prime, and the broadcast table gives its shard in constant time: no
shuffle, and no dependence on how the documents are distributed.

Defined cases: a null id hashes like any value (one slot); rows with equal ids
share a shard; the table's size is a parameter and bounds what is broadcast.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.llm.common import documents

SHARDS = tuple(f"shard-{i:03d}" for i in range(64))
#: Prime number of slots (12 bytes each when broadcast); about 1,000 per shard keeps shards even to 0.1%.
SLOTS = 65537


def _hash(name: str, what: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{what}:{name}".encode()).digest()[:8], "big")


def lookup_table(shards, slots: int = SLOTS) -> list[int]:
    """For every slot the index of its shard."""
    shards = list(shards)
    if len(set(shards)) != len(shards) or not shards:
        raise ValueError("shards must be distinct and not empty")
    if slots < max(2, len(shards)) or any(slots % p == 0 for p in range(2, int(slots**0.5) + 1)):
        raise ValueError("slots must be a prime of at least the number of shards")
    at = [_hash(s, "offset") % slots for s in shards]
    skip = [_hash(s, "skip") % (slots - 1) + 1 for s in shards]
    table, free = [-1] * slots, slots
    while free:
        for i in range(len(shards)):
            if not free:
                break
            while table[at[i]] >= 0:
                at[i] = (at[i] + skip[i]) % slots
            table[at[i]] = i
            free -= 1
    return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(slots)).cast("int")


def assign_shards(docs: DataFrame, id_col: str = "doc_id", shards=SHARDS, slots: int = SLOTS, slot_name: str = "slot", shard_name: str = "shard") -> DataFrame:
    """``docs`` plus its slot and shard; columns of these names, in whatever case, are
    replaced, and any other name may occur."""
    names = list(shards)
    table = docs.sparkSession.createDataFrame([(i, names[s]) for i, s in enumerate(lookup_table(names, slots))], "at int, name string")
    gone = {slot_name.lower(), shard_name.lower()}
    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c.lower() not in gone)).alias("row")
    placed = docs.select(own, slot_of(F.col(f"`{id_col}`"), slots).alias("at")).join(F.broadcast(table), "at")
    return placed.select("row.*", F.col("at").alias(slot_name), F.col("name").alias(shard_name))


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", shards=SHARDS, slots: int = SLOTS) -> None:
    """Write one Parquet folder per shard; every task writes straight to the
    shards of its rows, with at most one open file at a time."""
    placed = assign_shards(docs, id_col, shards, slots, "_at", "shard").drop("_at")
    placed.sortWithinPartitions("shard").write.partitionBy("shard").parquet(path)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 8 over all ``documents``: every row with its slot and shard."""
    return assign_shards(documents(spark, sf_dir))
