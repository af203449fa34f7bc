"""Connected components of a graph given as a table of edges, and hash bitmaps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.words import column, mix
from palimpsest.workspace import new_location

BLOCK = 1 << 16
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 30


def staged(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame, written to the shared folder and read back: cuts the lineage."""
    where = new_location(frame.sparkSession, purpose)
    frame.write.parquet(where)
    return frame.sparkSession.read.schema(frame.schema).parquet(where)


def connected(edges: DataFrame) -> DataFrame:
    """``node``, ``component``: the smallest node reachable. Nodes without edges are not listed.

    edges: ``a`` and ``b``, 64-bit. Alternates large and small stars: in each round
    every node's larger neighbours, then its smaller ones, are tied to the smallest.
    Minima are aggregated before the shuffle. The edges of one node meet in one task of
    a join, unless Spark splits it (adaptive skew joins do), so a hub makes an uneven task;
    they stream through it and are not held.
    """
    pairs = staged(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    before = None
    while True:
        both = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b").distinct()
        )
        large = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        large = staged(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b")))
            .where("a <> b").distinct()
        )
        pairs = staged(small, "small-star")
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    least = pairs.groupBy("a").agg(F.min("b").alias("component"))
    return least.select(F.col("a").alias("node"), "component").union(
        pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _bits(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = np.unique(places(batch.column(0).to_numpy(zero_copy_only=False), size))
        blocks, cuts = np.unique(at // BLOCK, return_index=True)
        parts = np.split((at % BLOCK).astype(np.uint16), cuts[1:]) if len(at) else []
        yield pa.RecordBatch.from_arrays(
            [pa.array(blocks, pa.int32()), pa.array([x.tobytes() for x in parts], pa.binary())],
            names=["block", "at"],
        )


def _merge_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, at in zip(column(batch, "block").to_pylist(), column(batch, "at").to_pylist()):
            held.setdefault(block, np.zeros(BLOCK, bool))[np.frombuffer(at, np.uint16)] = True
    for block, bits in held.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int32()), pa.array([np.packbits(bits).tobytes()], pa.binary())],
            names=["block", "bits"],
        )


def places(ids: np.ndarray, size: int) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(np.uint64), 11) % np.uint64(size)).astype(np.int64)


def bitmap(ids: DataFrame, count: int) -> tuple[np.ndarray, int]:
    """Bits, packed, of which each id's place is set; others' places seldom are.

    ids: one 64-bit column without nulls. The size follows the count up to 128 MB.
    """
    size = min(MOST_BITS, max(LEAST_BITS, 1 << int(16 * count).bit_length()))
    where = new_location(ids.sparkSession, "bitmap")
    (
        ids.mapInArrow(lambda it: _bits(it, size), "block int, at binary")
        .repartition(max(1, size // BLOCK // 256), "block")
        .mapInArrow(_merge_bits, "block int, bits binary")
        .write.parquet(where)
    )
    bits = np.zeros((size // BLOCK, BLOCK // 8), np.uint8)
    for row in ids.sparkSession.read.parquet(where).toLocalIterator():
        bits[row.block] = np.frombuffer(row.bits, np.uint8)
    return bits.reshape(-1), size


def is_set(ids: np.ndarray, bits: np.ndarray, size: int) -> np.ndarray:
    at = places(ids, size)
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
