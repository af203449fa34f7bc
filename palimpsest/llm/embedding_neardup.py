"""Near-duplicate vectors by spherical-cap filters from a structured product code.

A filter is a direction; a vector is in it when their inner product exceeds a bound.
Directions are concatenations of one code word for each of ``BLOCKS`` parts of the
(randomly rotated) space, so a vector's filters are found by list decoding: part by
part, keeping the prefixes that can still lead to it. The bound is each vector's own:
``FILTERS`` directions of each of ``CODES`` codes exceed it, also for vectors that
lie badly in the code. Vectors of one label that share a filter are compared in
double precision, by matrix products inside the filter. At a cosine of 0.98 most of
one vector's filters hold the other too. Directions grow with the table, and with one
code 0.6 % of such pairs shared no filter at 120 million vectors; the second code, turned
by itself, is for those (the measured recall is in the README). A pair counts in the least filter it shares.

Equal vectors of a label are one node with a multiplicity. Filters with more than
``CHUNK`` nodes are cut into chunks, and each pair of chunks is a task's work of its
own: results are a count and a root for each node, never pairs.

Vectors link only with vectors of the same length and the same label that is not
null; null, empty, zero or non-finite ones, and ones with null components, link with
nothing. Each input row gives a row. Repeated rows link with each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.components import connected, staged
from palimpsest.llm.words import column

COSINE = 0.98
BLOCKS = 4
FILTERS = 16
CODES = 2
#: Nodes of one filter on average, over all labels.
FILTER_NODES = 256
CHUNK = 512


class ProductCode:
    """``words`` directions in each block of a rotated space of ``dims``, and the bound."""

    def __init__(self, dims: int, words: int, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.rotation = np.linalg.qr(rng.normal(size=(dims, dims)))[0]
        blocks = min(BLOCKS, dims)
        self.parts = np.array_split(np.arange(dims), blocks)
        self.words = words
        self.code = []
        for part in self.parts:
            directions = rng.normal(size=(words, len(part)))
            self.code.append(directions / np.linalg.norm(directions, axis=1, keepdims=True) / np.sqrt(blocks))

    def decode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of unit vectors and their filters.

        A direction among the best of the whole space has a prefix among as many best
        prefixes: any better prefix would make a better direction with the same rest.
        So the prefixes kept at each part are enough, and the list is exact.
        """
        turned = unit @ self.rotation
        prefix, value = np.zeros((len(unit), 1), np.int64), np.zeros((len(unit), 1))
        for part, code in zip(self.parts, self.code):
            product = turned[:, part] @ code.T
            value = (value[:, :, None] + product[:, None, :]).reshape(len(unit), -1)
            prefix = (prefix[:, :, None] * self.words + np.arange(self.words)).reshape(len(unit), -1)
            if value.shape[1] > FILTERS:
                best = np.argpartition(-value, FILTERS - 1, axis=1)[:, :FILTERS]
                value, prefix = np.take_along_axis(value, best, 1), np.take_along_axis(prefix, best, 1)
        return np.repeat(np.arange(len(unit)), prefix.shape[1]), prefix.reshape(-1)


def _decoded(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    codes: dict[int, list[ProductCode]] = {}
    for batch in batches:
        vectors = column(batch, "embedding")
        lengths = vectors.value_lengths().to_numpy()
        flat = vectors.flatten().to_numpy()
        starts = np.cumsum(lengths) - lengths
        for dims in np.unique(lengths):
            rows = np.flatnonzero(lengths == dims)
            if int(dims) not in codes:
                codes[int(dims)] = [ProductCode(int(dims), words, seed) for seed in range(CODES)]
            vector = flat[starts[rows][:, None] + np.arange(dims)]
            unit = vector / np.abs(vector).max(axis=1, keepdims=True)
            unit /= np.linalg.norm(unit, axis=1, keepdims=True)
            exact = vector.astype(np.float32)
            width = np.where((exact == vector).all(axis=1), 4, 8)  # what holds the components exactly
            for low in range(0, len(rows), 1024):
                part = unit[low : low + 1024]
                found = [code.decode(part) for code in codes[int(dims)]]
                row = np.concatenate([x for x, _ in found])
                filters = np.concatenate([f * CODES + k for k, (_, f) in enumerate(found)])
                order = np.lexsort((filters, row))
                row, filters = row[order], filters[order].astype(np.int32)
                ends = np.searchsorted(row, np.arange(len(part) + 1))
                raw = [
                    (exact if w == 4 else vector)[k].tobytes()
                    for k, w in enumerate(width[low : low + 1024].tolist(), low)
                ]
                kept = batch.take(pa.array(rows[low : low + 1024]))
                yield pa.RecordBatch.from_arrays(
                    [*(column(kept, x) for x in ("node", "label", "copies")),
                     pa.array(np.full(len(part), dims, np.int32)),
                     pa.array(raw, pa.binary()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(filters))],
                    names=["node", "label", "copies", "dims", "vector", "filters"],
                )


def _roots(linked: np.ndarray) -> np.ndarray:
    """The least index reachable by links, for each."""
    label = np.arange(len(linked))
    while True:
        least = np.where(linked, label[None, :], len(linked)).min(axis=1)
        new = np.minimum(label, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _inside(node, copies, side, unit, filters, own: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Nodes with links in one filter, the links that count here, and a root of each."""
    linked = unit @ unit.T >= COSINE
    np.fill_diagonal(linked, False)
    if side.any() and not side.all():
        linked &= side[:, None] != side[None, :]
    some = np.flatnonzero(linked.any(axis=1))
    if not len(some):
        return None
    linked = linked[np.ix_(some, some)]
    earlier = [f[f < own] for f in (filters[k] for k in some)]
    seen, place = np.unique(np.concatenate(earlier), return_inverse=True)
    holds = np.zeros((len(some), len(seen)), np.float32)
    holds[np.repeat(np.arange(len(some)), [len(f) for f in earlier]), place] = 1
    counts = linked & ~(holds @ holds.T > 0)
    return node[some], counts @ copies[some], node[some][_roots(linked)]


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by task; a task's rows are compared with each other."""
    keys = ["label", "dims", "filter", "first", "second"]
    held: list[pa.RecordBatch] = []

    def found(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = rows.combine_chunks().to_batches()
        for part in rows:
            dims = column(part, "dims")[0].as_py()
            raw = column(part, "vector").to_pylist()
            unit = np.stack([np.frombuffer(x, np.float32 if len(x) == 4 * dims else np.float64) for x in raw])
            unit = unit.astype(np.float64)
            unit /= np.abs(unit).max(axis=1, keepdims=True)
            unit /= np.linalg.norm(unit, axis=1, keepdims=True)
            lists = column(part, "filters")
            ends = np.cumsum(lists.value_lengths().to_numpy())
            filters = np.split(lists.flatten().to_numpy(), ends[:-1])
            first, second, chunk = (column(part, x).to_numpy() for x in ("first", "second", "chunk"))
            side = (chunk == second) & (first != second)
            got = _inside(column(part, "node").to_numpy(), column(part, "copies").to_numpy(), side, unit,
                          filters, column(part, "filter")[0].as_py())
            if got:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in got], names=["node", "links", "root"])

    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([column(batch, x).to_numpy() for x in keys], axis=1)
        cuts = np.concatenate([[0], np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1, [len(values)]])
        for low, high in zip(cuts[:-1], cuts[1:]):
            key = tuple(values[low])
            if held and key != last:
                if sum(x.num_rows for x in held) > 1:
                    yield from found(pa.Table.from_batches(held))
                held = []
            held.append(batch.slice(low, high - low))
            last = key
    if held and sum(x.num_rows for x in held) > 1:
        yield from found(pa.Table.from_batches(held))


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of vec_id, embedding, label."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        F.col("label").cast("long").alias("label"),
    )
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = F.forall("embedding", lambda x: x == 0)
    links = F.coalesce(F.col("label").isNotNull() & ~bad & ~zero & (F.size("embedding") > 0), F.lit(False))
    keyed = rows.withColumn("node", F.when(links, F.xxhash64("label", "embedding")))
    nodes = (
        keyed.where("node IS NOT NULL").groupBy("node", "label")
        .agg(F.first("embedding").alias("embedding"), F.count("*").alias("copies"))
    )
    words = max(3, round((max(1, nodes.count()) * FILTERS / FILTER_NODES) ** (1 / BLOCKS)))
    decoded = staged(
        nodes.mapInArrow(
            lambda it: _decoded(it, words),
            "node long, label long, copies long, dims int, vector binary, filters array<int>",
        ),
        "filters",
    )
    in_filters = decoded.select("*", F.explode("filters").alias("filter"))
    sizes = in_filters.groupBy("label", "dims", "filter").count().where(F.col("count") > 1)
    chunks = F.ceil(F.col("count") / CHUNK).cast("int")
    tasks = in_filters.join(sizes.select("label", "dims", "filter", chunks.alias("chunks")), ["label", "dims", "filter"])
    tasks = tasks.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    tasks = tasks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    tasks = tasks.select(
        "label", "dims", "filter", F.least("chunk", "other").alias("first"), F.greatest("chunk", "other").alias("second"),
        "chunk", "node", "copies", "vector", "filters",
    )
    keys = ["label", "dims", "filter", "first", "second"]
    compared = staged(
        tasks.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_compared, "node long, links long, root long"),
        "compared",
    )
    counts = compared.groupBy("node").agg(F.sum("links").alias("links"))
    groups = connected(compared.select(F.col("node").alias("a"), F.col("root").alias("b")))
    members = keyed.select("vec_id", "node")
    copies = nodes.select("node", "copies")
    named = (
        members.join(copies, "node", "left").join(counts, "node", "left").join(groups, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    named = staged(named, "named")
    least = named.where("component IS NOT NULL").groupBy("component").agg(F.min("vec_id").alias("least"))
    out = named.join(least, "component", "left")
    component = F.coalesce("least", "vec_id")
    return out.select(
        "vec_id",
        (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
