"""Sharding by a permutation-filled lookup table.

Every shard has its own preference order over the slots of a prime-sized table: start `a`, step `b`, both taken
from the shard's name.  Shards take turns; each claims the next slot on its list that is still free, until no slot is
free.  The filled table has a fixed, small size, so it is broadcast, and a key is placed in constant time: hash to a
slot, read the slot.  A shard's share differs from the others' by one slot at most, and removing one shard moves
few keys of the others.

Nulls: a null key hashes as the word `null` and is placed.  Repeated keys get equal shards.  An empty table gives an
empty result.  Extra columns pass through; `slot` and `shard` of the input, if any, are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

SLOTS = 65_537
SHARDS = tuple(f"shard-{i:03d}" for i in range(100))


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """The table: for each slot the index of the shard that claimed it."""
    if not is_prime(slots) or not 0 < len(set(shards)) == len(shards) <= slots:
        raise ValueError("slots must be a prime and shard names distinct, no more than slots")
    at, step = [], []
    for s in shards:
        d = hashlib.md5(s.encode()).digest()
        at.append(int.from_bytes(d[:8], "big") % slots)
        step.append(int.from_bytes(d[8:], "big") % (slots - 1) + 1)
    owner, left = [-1] * slots, slots
    while left:
        for i in range(len(shards)):
            while owner[at[i]] >= 0:
                at[i] = (at[i] + step[i]) % slots
            owner[at[i]] = i
            left -= 1
            if not left:
                break
    return owner


def shard(df: DataFrame, key: str, shards: Sequence[str] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """Adds `slot` and `shard`.  The broadcast table has `slots` rows, whatever the input's size."""
    spark = df.sparkSession
    lookup = spark.createDataFrame([(i, shards[o]) for i, o in enumerate(fill(shards, slots))], "slot int, shard string")
    h = F.conv(F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit("null"))), 1, 8), 16, 10).cast("long")
    keyed = df.drop("slot", "shard").withColumn("slot", F.pmod(h, F.lit(slots)).cast("int"))
    return keyed.join(F.broadcast(lookup), "slot", "left")


def oracle() -> str:
    """The placement in SQL, over the filled table as a list."""
    names, owner = ", ".join(f"'{s}'" for s in SHARDS), ", ".join(str(o + 1) for o in fill(SHARDS))
    slot = f"(('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % {SLOTS})::INT"
    return f"WITH t AS (SELECT [{names}] AS names, [{owner}] AS owner), d AS (SELECT doc_id, {slot} AS slot FROM documents) SELECT doc_id, slot, names[owner[slot + 1]] AS shard FROM d, t"


def op3_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, slot, shard of every document."""
    return shard(table(spark, sf_dir, "documents").select("doc_id"), "doc_id").select("doc_id", "slot", "shard")
