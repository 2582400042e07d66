"""Sharding by a permutation-filled lookup table.

Every shard has its own permutation of a prime number of slots (offset + i x skip).  Shards take turns
claiming the next free slot of their permutation until the table is full, so each holds nearly the
same number of slots, and adding or removing a shard moves few slots.  The table has a fixed number of
rows, so it is broadcast, and placing a row is one hash and one lookup: no shuffle at all.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Slots of the table: a prime, far above the number of shards.
SLOTS = 65_537
SHARDS = 64


def _hash(text: str, salt: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{salt}:{text}".encode(), digest_size=8).digest(), "big")


def lookup_table(shards: list[str], slots: int = SLOTS, weights: list[int] | None = None) -> list[int]:
    """Shard number of every slot.  A shard of weight w claims w slots in each turn (1 if not given).

    Raises ValueError without shards, for repeated names, weights that aren't positive, a table that
    isn't prime or has fewer slots than shards.
    """
    weights = weights or [1] * len(shards)
    if not shards or len(set(shards)) != len(shards) or len(weights) != len(shards) or min(weights) < 1:
        raise ValueError("shards must be named once each and weigh at least 1")
    if slots < len(shards) or slots < 2 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("slots must be a prime, and no fewer than the shards")
    at = [_hash(s, "offset") % slots for s in shards]
    skip = [_hash(s, "skip") % (slots - 1) + 1 for s in shards]
    owner, free = [-1] * slots, slots
    while True:
        for k, turns in enumerate(weights):
            for _ in range(turns):
                slot = at[k]
                while owner[slot] >= 0:
                    slot = (slot + skip[k]) % slots
                owner[slot], at[k], free = k, (slot + skip[k]) % slots, free - 1
                if not free:
                    return owner


def shard(
    df: DataFrame, keys: list[str], shards: list[str], slots: int = SLOTS, weights: list[int] | None = None, prefix: str = ""
) -> DataFrame:
    """``df`` with ``slot`` and ``shard`` (a position in ``shards``), both named with ``prefix``.

    Equal keys always share a shard; a null key counts as a value of its own.  Repeated rows stay.
    Columns of the same names must be renamed by ``prefix``, else ValueError.
    """
    clash = {f"{prefix}slot", f"{prefix}shard"} & set(df.columns)
    if clash:
        raise ValueError(f"columns exist already: {sorted(clash)}")
    owners = df.sparkSession.createDataFrame(list(enumerate(lookup_table(shards, slots, weights))), f"{prefix}slot int, {prefix}shard int")
    slot = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(slots)).cast("int")
    # `slots` rows, whatever the input: safe to broadcast.
    return df.withColumn(f"{prefix}slot", slot).join(F.broadcast(owners), f"{prefix}slot", "left").select(*df.columns, f"{prefix}slot", f"{prefix}shard")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot and shard of every document among 64 shards: ``doc_id, slot, shard``."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return shard(docs, ["doc_id"], [f"shard-{k:05d}" for k in range(SHARDS)])
