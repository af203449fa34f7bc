"""Whitened principal components by Golub-Kahan-Lanczos bidiagonalisation.

Vectors go onto a grid of integers first: ``x = floor(SCALE * entry)``. X has a row for
each distinct x vector, centred; copies of a vector count once. From a seeded start each
step makes, by one pass over the rows, ``u = Xv`` less its shares of all earlier u, and
``X'u`` less its shares of all earlier v. What u and v turn X into is bidiagonal; its
small singular value decomposition gives the components and their deviations.

Rows stay where they are. A left vector has as many entries as X has rows, so it is
never stored: it is ``X w`` for a w as short as v, and the tasks make its entries again
when they need them. A pass brings one sum a dimension to the driver.

A component is converged when what couples it to the next step is below rounding. Equal
deviations would hide behind each other, so once the wanted ones have converged, a start
orthogonal to all before shows whether anything as large is left. After as many steps as
there are dimensions nothing can be.

Vectors that are null or hold a null, NaN or infinite entry are left out. Shorter vectors
count as 0 in the dimensions they lack; entries beyond 64 bits are the largest or smallest
there. A null id is kept. Components without deviation are left out: there are none of an
empty table, a single vector or copies of one. Input columns besides id and vector are not
read. ``deviation`` is null where the exact number does not fit in 64 bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.llm.words import column
from palimpsest.workspace import new_location, remove_location

SCALE = 256.0
COMPONENTS = 4
#: Bytes of one block of rows.
BLOCK_BYTES = 1 << 22
#: Shares of the largest deviation: what couples a converged component, what is none.
CONVERGED, NOTHING = 1e-14, 1e-10
#: A start that is a proof only needs its largest deviation to this share of it.
PROVED = 1e-3


def on_grid(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id`` and ``x``, of vectors whose entries are all finite."""
    entry = F.col(vector)
    bad = F.exists(entry, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    x = F.transform(entry, lambda c: F.floor(c.cast("double") * SCALE).cast("long"))
    return vectors.where(entry.isNotNull() & ~bad).select(F.col(vec_id).alias("vec_id"), x.alias("x"))


def _matrix(rows: pa.Array, width: int) -> np.ndarray:
    """A list column as rows of ``width`` numbers, filled up with 0."""
    rows = rows.cast(pa.large_list(pa.int64()))
    offsets = rows.offsets.to_numpy()
    values = rows.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    sizes = np.diff(offsets)
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def _packed(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Blocks of rows, with the sums of their entries' upper and lower halves."""
    step = max(1, BLOCK_BYTES // (8 * max(1, width)))
    for batch in batches:
        for low in range(0, batch.num_rows, step):
            x = _matrix(batch.column(0)[low : low + step], width)
            halves = [(x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(x)]), *[pa.array([h], pa.list_(pa.int64())) for h in halves],
                 pa.array([np.ascontiguousarray(x).tobytes()], pa.binary())],
                names=["n", "upper", "lower", "x"],
            )


@dataclass
class Fit:
    """What ``fit`` found; ``sums`` are exact, axes are rows."""

    n: int
    sums: list[int]
    axes: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    identity_error: float
    #: Passes over the rows.
    passes: int

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def _summed(blocks: DataFrame, width: int, mean: np.ndarray, of_block: Callable, size: int) -> np.ndarray:
    """The sum over all blocks of ``size`` numbers that a block's centred rows give."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(size)
        for batch in batches:
            for block in batch.column(0):
                x = np.frombuffer(block.as_buffer(), np.int64).reshape(-1, width) - mean
                out += of_block(x)
        yield pa.RecordBatch.from_arrays([pa.array([out], pa.list_(pa.float64()))], names=["part"])

    parts = blocks.select("x").mapInArrow(each, "part array<double>")
    sums = [F.sum(F.col("part")[k]).alias(f"s{k}") for k in range(size)]
    return np.array([v or 0.0 for v in parts.agg(*sums).first()])


def bidiagonalise(
    product: Callable[[np.ndarray], tuple[np.ndarray, float]], width: int, wanted: int, scale: float, seed: int = 0
) -> tuple[np.ndarray, np.ndarray, int]:
    """The largest ``wanted`` singular values of X, its right vectors, and the passes made.

    ``product(w)`` gives ``X'Xw`` and the square of ``Xw``; ``scale`` is X's Frobenius norm.
    """
    rng = np.random.default_rng(seed)
    right, left, images = (np.zeros((width, width)) for _ in range(3))  # v, w of u = Xw, X'u
    small = np.zeros((width, width))  # the bidiagonal
    tiny = scale * 1e-14

    def orthogonal(r: np.ndarray, k: int) -> np.ndarray:
        for _ in range(2):
            r = r - right[:k].T @ (right[:k] @ r)
        return r

    v = rng.normal(size=width)
    v /= np.linalg.norm(v)
    beta, passes, begun = 0.0, 0, 0
    found: np.ndarray | None = None  # the wanted values when the last proof began
    for k in range(width):
        right[k] = v
        w = v - beta * left[k - 1] if k else v.copy()
        for _ in range(2):
            image, square = product(w)
            passes += 1
            shares = left[:k] @ image
            w = w - shares @ left[:k]
            image = image - shares @ images[:k]
            rest = square - shares @ shares
            if rest > 0.5 * square:
                break  # else the difference lost digits: once more
        alpha = np.sqrt(max(0.0, rest))
        if alpha > tiny:
            left[k], images[k], small[k, k] = w / alpha, image / alpha, alpha
        r = orthogonal(images[k] - small[k, k] * v, k + 1)
        beta = np.linalg.norm(r)
        if beta <= tiny:
            beta = 0.0
        if k + 1 == width:
            break
        begins, values, _ = np.linalg.svd(small[: k + 1, : k + 1])
        coupled = beta * np.abs(begins[k])
        if begun == 0 and found is None:
            done = k + 1 >= wanted and (coupled[:wanted] <= CONVERGED * values[0]).all()
            proved = False
        else:
            own_begins, own, _ = np.linalg.svd(small[begun : k + 1, begun : k + 1])
            open_ = beta * abs(own_begins[k - begun, 0])
            below = own[0] < (1 - 2 * PROVED) * found[-1] and open_ <= PROVED * max(own[0], tiny)
            done = bool((coupled[:wanted] <= CONVERGED * values[0]).all() and open_ <= CONVERGED * values[0])
            proved = below or (done and np.allclose(values[:wanted], found, rtol=PROVED * 1e-6, atol=0))
        if proved:
            break
        if done or beta == 0.0:
            if done:
                found, begun = values[:wanted].copy(), k + 1
            beta = 0.0
            r = orthogonal(rng.normal(size=width), k + 1)
        small[k, k + 1] = beta
        v = r / np.linalg.norm(r)
    size = k + 1
    _, values, turned = np.linalg.svd(small[:size, :size])
    axes = turned[:wanted] @ right[:size]
    return values[:wanted], axes / np.linalg.norm(axes, axis=1, keepdims=True), passes


def fit(grid: DataFrame, components: int = COMPONENTS, seed: int = 0) -> Fit:
    """Components of the distinct vectors of ``on_grid``; the blocks it stages are deleted again."""
    spark = grid.sparkSession
    where = new_location(spark, "whitening")
    try:
        return _fit(grid, where, components, seed)
    finally:
        remove_location(spark, where)


def _fit(grid: DataFrame, where: str, components: int, seed: int) -> Fit:
    width = grid.agg(F.max(F.size("x"))).first()[0] or 0
    padding = F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x"))
    distinct = grid.select(F.concat("x", padding).alias("x")).distinct()
    schema = "n long, upper array<long>, lower array<long>, x binary"
    distinct.mapInArrow(lambda it: _packed(it, width), schema).write.parquet(where)
    blocks = grid.sparkSession.read.schema(schema).parquet(where)
    totals = (
        blocks.select("n", F.posexplode(F.arrays_zip("upper", "lower")).alias("at", "half"))
        .groupBy("at").agg(F.sum("half.upper").alias("upper"), F.sum("half.lower").alias("lower"))
        .orderBy("at").collect()
    )  # fmt: skip  # a row a dimension
    n = blocks.agg(F.sum("n")).first()[0] or 0
    sums = [(r.upper << 32) + r.lower for r in totals]
    nothing = Fit(n, sums, np.zeros((0, width)), np.zeros(0), np.zeros(0), 0.0, 0)
    if n < 2 or not width:
        return nothing
    mean = nothing.mean
    squares = _summed(blocks, width, mean, lambda x: np.array([np.einsum("ij,ij->", x, x)]), 1)[0]
    if squares == 0:
        return nothing

    def product(w: np.ndarray) -> tuple[np.ndarray, float]:
        def of_block(x: np.ndarray) -> np.ndarray:
            u = x @ w
            return np.append(u @ x, u @ u)

        out = _summed(blocks, width, mean, of_block, width + 1)
        return out[:-1], float(out[-1])

    values, axes, passes = bidiagonalise(product, width, min(components, width), float(np.sqrt(squares)), seed)
    real = values > NOTHING * values[0]
    values, axes = values[real], axes[real]
    axes = axes * np.sign(axes[np.arange(len(axes)), np.abs(axes).argmax(axis=1)])[:, None]
    eigenvalues = values**2 / n
    count = len(values)

    def of_whitened(x: np.ndarray) -> np.ndarray:
        z = x @ (axes.T / np.sqrt(eigenvalues))
        return np.concatenate([(z.T @ z).ravel(), z.sum(axis=0)])

    out = _summed(blocks, width, mean, of_whitened, count * count + count)
    centre = out[count * count :] / n  # rounding: the rows are centred already
    covariance = out[: count * count].reshape(count, count) / n - np.outer(centre, centre)
    error = float(np.abs(covariance - np.eye(count)).max())
    return Fit(n, sums, axes, eigenvalues, values**2 / squares, error, passes + 2)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The exact sum over dimensions of ``(n * x - sum) ** 2``."""
    largest = n * max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) + max(map(abs, sums), default=0)
    exact = x if len(sums) * largest**2 < 2**63 else x.astype(object)
    found = ((n * exact - np.array(sums, exact.dtype)) ** 2).sum(axis=1).tolist()
    return [v if v < 2**63 else None for v in found]


def whiten(grid: DataFrame, fitted: Fit) -> DataFrame:
    """For each row of ``on_grid`` and each component: its whitened coordinate."""
    count, width = len(fitted.axes), len(fitted.sums)
    schema = T.StructType(
        [T.StructField("vec_id", grid.schema["vec_id"].dataType), T.StructField("component", T.IntegerType())]
        + [T.StructField(c, T.LongType()) for c in ("n", "deviation")]
        + [T.StructField(c, T.DoubleType()) for c in ("whitened", "explained", "identity_error")]
    )
    shared = grid.sparkSession.sparkContext.broadcast(fitted)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        turn = own.axes.T / np.sqrt(own.eigenvalues)
        for batch in batches:
            size = batch.num_rows
            if not size or not count:
                continue
            x = _matrix(column(batch, "x"), width)
            each = np.repeat(np.arange(size), count)
            yield pa.RecordBatch.from_arrays(
                [
                    column(batch, "vec_id").take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), size)),
                    pa.array(np.full(size * count, own.n)),
                    pa.array(_deviations(x, own.n, own.sums), pa.int64()).take(pa.array(each)),
                    pa.array(((x - own.mean) @ turn).ravel()),
                    pa.array(np.tile(own.explained, size)),
                    pa.array(np.full(size * count, own.identity_error)),
                ],
                names=[f.name for f in schema],
            )

    return grid.mapInArrow(rows, schema)


def components(vectors: DataFrame) -> DataFrame:
    """Fits on all vectors and whitens each of them."""
    grid = on_grid(vectors)
    return whiten(grid, fit(grid))
