"""Constant-time placement by a lookup table that shards fill by their preferences.

The table has a prime number of slots. Every shard's preference is a permutation of
them, an offset and a step from hashes of its name. Shards take turns, each claiming
the next slot of its order that is free, until the table is full: loads differ by a
slot at most, and a shard that comes or goes moves few other slots. A row's slot is a
hash of its key; table and slots are joined by a broadcast of ``SLOTS`` rows.

A null key has a slot like any other value. Input columns called like those added are
replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLOTS = 65_537
SHARDS = tuple(f"shard-{k:04d}" for k in range(64))


def preference(name: str, slots: int) -> tuple[int, int]:
    digest = hashlib.sha256(name.encode()).digest()
    return int.from_bytes(digest[:8], "big") % slots, int.from_bytes(digest[8:16], "big") % (slots - 1) + 1


def fill(shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> np.ndarray:
    """The number of the shard of each slot. slots must be prime."""
    if slots < 2 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"{slots} is not prime")
    if not 0 < len(shards) <= slots:
        raise ValueError(f"{len(shards)} shards for {slots} slots")
    if len(set(shards)) < len(shards):
        raise ValueError("shards need different names")
    table = np.full(slots, -1, np.int32)
    next_, step = map(list, zip(*(preference(name, slots) for name in shards)))
    left = slots
    while True:
        for k in range(len(shards)):
            at = next_[k]
            while table[at] >= 0:
                at = (at + step[k]) % slots
            table[at] = k
            next_[k] = (at + step[k]) % slots
            left -= 1
            if not left:
                return table


def place(rows: DataFrame, key: str, shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """The rows with ``slot`` and ``shard``."""
    rows = rows.drop("slot", "shard")
    table = rows.sparkSession.createDataFrame(
        [(k, shards[s]) for k, s in enumerate(fill(shards, slots).tolist())], "table_slot int, shard string"
    )
    slot = F.pmod(F.xxhash64(F.col(key)), F.lit(slots)).cast("int")
    whole = rows.select(F.struct("*").alias("row"), slot.alias("slot"))
    return whole.join(F.broadcast(table), whole["slot"] == table["table_slot"]).select("row.*", "slot", "shard")
