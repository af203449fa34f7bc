"""Exact top-k by integer inner product: tiles of queries and shards, and a merge tree.

Rows are packed into matrices of the narrowest numbers that hold them: shards of rows
and groups of queries, each of up to ``BLOCK_BYTES``. Every group meets every shard in one
tile, a product of two matrices (taken in strips of ``CELLS`` scores), of which each query
keeps its k best (partial selection, no sort of all scores). The lists of a query are
merged ``FAN`` at a time, level by level. Only matrices and lists of k are shuffled, and
no pair is a row. A shard is shuffled once for each group and a group once for each shard:
the larger the blocks, the fewer copies. Small tables are cut finer, so that there are
tiles for many tasks.

A component x counts as floor(64 x). Vectors that are null or hold null or non-finite
components take no part; vectors of different lengths, empty ones included, are not
compared with each other. Products of whole numbers are exact: in doubles where they
fit, else in Python's integers; scores beyond 64 bits are held at their limits. Rows
of one vec_id are candidates each; as queries they are one, with the
least of their vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.components import staged

K = 20
SCALE = 64
BLOCK_BYTES = 1 << 24
#: Rows of a block that small tables are cut down to, until there are so many blocks.
SHARD_ROWS, SHARDS = 4096, 32
GROUP_QUERIES, GROUPS = 512, 4
FAN = 16
#: Scores that are made at a time.
CELLS = 1 << 21
KINDS = ("<i1", "<i2", "<i4")
PACKED = "dims int, ids binary, kind string, matrix binary"


def usable(vectors: DataFrame) -> DataFrame:
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad)


def _pack(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Matrices of at most ``limit`` rows, one length each, in the order of the ids."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

    def packed(dims: int, parts: list) -> pa.RecordBatch:
        ids, matrix = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(ids, kind="stable")
        kind = _narrowest(matrix)
        return pa.RecordBatch.from_arrays(
            [pa.array([dims], pa.int32()), pa.array([ids[order].tobytes()], pa.binary()), pa.array([kind]),
             pa.array([matrix[order].astype(kind).tobytes()], pa.binary())],
            names=["dims", "ids", "kind", "matrix"],
        )

    for batch in batches:
        ids, vectors = batch.column(0).to_numpy(), batch.column(1)
        lengths = vectors.value_lengths().to_numpy()
        flat = vectors.flatten().to_numpy()
        starts = np.cumsum(lengths) - lengths
        for dims in np.unique(lengths):
            rows = np.flatnonzero(lengths == dims)
            matrix = np.floor(SCALE * flat[(starts[rows][:, None] + np.arange(dims))].astype(np.float64))
            parts = held.setdefault(int(dims), [])
            for at in range(0, len(rows), limit):
                parts.append((ids[rows[at : at + limit]], matrix[at : at + limit]))
                if sum(len(x) for x, _ in parts) >= limit:
                    yield packed(int(dims), parts)
                    parts.clear()
    for dims, parts in held.items():
        if parts:
            yield packed(dims, parts)


def _narrowest(matrix: np.ndarray) -> str:
    """Of whole numbers in doubles, the narrowest kind that holds them all."""
    low, high = matrix.min(initial=0), matrix.max(initial=0)
    return next((k for k in KINDS if np.iinfo(k).min <= low and high <= np.iinfo(k).max), "<f8")


def _scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products as 64-bit integers."""
    bound = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * max(1, rows.shape[1])
    if bound < 2**53:
        return (queries @ rows.T).astype(np.int64)
    exact = np.vectorize(int, otypes=[object])
    product = exact(queries) @ exact(rows).T
    return np.clip(product, -(2**63), 2**63 - 1).astype(np.int64)


def best_of_tile(
    query_ids: np.ndarray, queries: np.ndarray, row_ids: np.ndarray, rows: np.ndarray, k: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of each query the ids and scores of its k best rows, and all that tie with the last."""
    strip = max(1, CELLS // max(1, len(rows)))
    for low in range(0, len(query_ids), strip):
        scores = _scores(queries[low : low + strip], rows)
        for j, query in enumerate(query_ids[low : low + strip]):
            own, ids = scores[j], row_ids
            mine = ids == query
            if mine.any():
                own, ids = own[~mine], ids[~mine]
            if len(own) > k:
                least = np.partition(own, len(own) - k)[len(own) - k]
                above = np.flatnonzero(own > least)
                ties = np.flatnonzero(own == least)[: k - len(above)]  # ids ascend in a shard
                chosen = np.concatenate([above, ties])
                own, ids = own[chosen], ids[chosen]
            yield int(query), ids, own


def _tiles(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            dims = row["dims"]
            q_ids, r_ids = (np.frombuffer(row[x], np.int64) for x in ("group_ids", "shard_ids"))
            q, r = (np.frombuffer(row[f"{x}_matrix"], row[f"{x}_kind"]).astype(np.float64).reshape(len(n), dims)
                    for x, n in (("group", q_ids), ("shard", r_ids)))
            found = [x for x in best_of_tile(q_ids, q, r_ids, r, k) if len(x[1])]
            if not found:
                continue
            sizes = [len(ids) for _, ids, _ in found]
            best = pa.StructArray.from_arrays(
                [pa.array(~np.concatenate([x[2] for x in found])), pa.array(np.concatenate([x[1] for x in found]))],
                names=["down", "vec_id"],  # ~score, which ascends as scores fall
            )
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in found]), pa.array([row["shard"]] * len(found), pa.int32()),
                 pa.ListArray.from_arrays(offsets, best)],
                names=["query_id", "shard", "best"],
            )


def _packed(rows: DataFrame, name: str, least_rows: int, least_blocks: int) -> tuple[DataFrame, int]:
    """Staged matrices with numbers from 0, and how many numbers there are."""
    count, entries = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("embedding").cast("long")), F.lit(0))).first()
    narrow = 2 * entries  # most tables' numbers take two bytes
    parts = max(1, -(-narrow // BLOCK_BYTES), min(least_blocks, -(-count // least_rows)))
    limit = max(1, -(-count // parts))
    table = staged(rows.repartition(parts).mapInArrow(lambda it: _pack(it, limit), PACKED), name)
    number = F.pmod(F.xxhash64("ids"), F.lit(parts)).cast("int")
    own = [F.col(c).alias(f"{name}_{c}") for c in ("ids", "kind", "matrix")]
    return table.select("dims", number.alias(name), *own), parts


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of ``vectors`` for each query row."""
    columns = [F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")]
    rows, asked = (usable(x.select(*columns)) for x in (vectors, queries))
    asked = asked.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    shards, n_shards = _packed(rows, "shard", SHARD_ROWS, SHARDS)
    groups, n_groups = _packed(asked, "group", GROUP_QUERIES, GROUPS)
    # every group meets every shard in the task of their two numbers
    right = shards.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))))
    left = groups.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))))
    lists = left.join(right, ["dims", "group", "shard"]).mapInArrow(
        lambda it: _tiles(it, k), "query_id long, shard int, best array<struct<down:long,vec_id:long>>"
    )
    parts = n_shards
    while True:
        parts = -(-parts // FAN)
        merged = F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, k)
        lists = lists.groupBy("query_id", (F.col("shard") % parts).alias("shard")).agg(merged.alias("best"))
        if parts == 1:
            break
    return lists.select("query_id", F.posexplode("best").alias("place", "item")).select(
        "query_id", (F.col("place") + 1).cast("int").alias("rank"), "item.vec_id",
        (F.lit(-1).cast("long") - F.col("item.down")).alias("score"),
    )
