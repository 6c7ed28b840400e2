"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

Vectors are packed once into blocks of whole numbers of the narrowest kind that holds them. A Lanczos
step is one pass over the blocks: each forms ``p = Xv`` on centred rows and returns its share of ``X'p``
and of ``|p|^2``; Spark adds the shares up. Left vectors are as long as the table and are never stored:
each is ``Xc`` for a short ``c``, so that its inner products follow from ``X'p``. Both sides are fully
reorthogonalised. The small singular value decomposition is done where the plan is built.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrass.llm.arrays import list_array
from tallgrass.llm.graph import drop, keep

SHIFT, SCALE = 1_000_000, 64
ROWS = 1 << 13  # vectors of a block, so that a block of doubles stays small
KINDS = (np.int8, np.int16, np.int32, np.int64)
SAFE = 1 << 62
TINY = 1e-13  # of the largest singular value: what counts as nothing left, or as converged

_BLOCKS = "width int, rows long, vec_id array<long>, kind int, data binary, sums array<long>"


def quantise(values: np.ndarray) -> np.ndarray:
    """``floor(64 c)``, that is x without its shift; what a long cannot hold becomes the nearest long of 62 bits."""
    scaled = np.floor(SCALE * values.astype(np.float64))
    return np.clip(scaled, -SAFE, SAFE).astype(np.int64)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of usable vectors, one width each."""
    schema = pa.schema([
        ("width", pa.int32()), ("rows", pa.int64()), ("vec_id", pa.list_(pa.int64())), ("kind", pa.int32()), ("data", pa.binary()), ("sums", pa.list_(pa.int64())),
    ])

    def block(ids: pa.Array, x: np.ndarray) -> pa.RecordBatch:
        widest = int(np.abs(x).max())
        kind = next(k for k, t in enumerate(KINDS) if widest <= np.iinfo(t).max)
        sums = x.sum(axis=0)
        columns = [
            pa.array([x.shape[1]], pa.int32()), pa.array([len(x)]), list_array(ids.to_numpy(zero_copy_only=False), [len(x)], pa.int64()) if ids.null_count == 0 else pa.array([ids.to_pylist()], pa.list_(pa.int64())),
            pa.array([kind], pa.int32()), pa.array([x.astype(KINDS[kind]).tobytes()], pa.binary()), list_array(sums, [len(sums)], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    held: dict[int, list] = {}
    for batch in batches:
        ids, vectors = batch.column(0), batch.column(1)
        flat = vectors.flatten()
        bad = ~np.isfinite(flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False))
        sizes = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.r_[0, np.cumsum(sizes)]
        spoilt = np.diff(np.r_[0, np.cumsum(bad)][ends])
        values = flat.cast(pa.float64()).fill_null(0).to_numpy(zero_copy_only=False)
        for width in np.unique(sizes[(sizes > 0) & (spoilt == 0)]).tolist():
            rows = np.flatnonzero((sizes == width) & (spoilt == 0))
            x = quantise(values[ends[rows][:, None] + np.arange(width)])
            own = held.setdefault(width, [[], [], 0])
            own[0].append(ids.take(pa.array(rows)))
            own[1].append(x)
            own[2] += len(rows)
            if own[2] >= ROWS:
                yield block(pa.concat_arrays(own[0]), np.concatenate(own[1]))
                del held[width]
    for own in held.values():
        yield block(pa.concat_arrays(own[0]), np.concatenate(own[1]))


def _matrices(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The blocks of ``(width, kind, data)`` as matrices of whole numbers."""
    for width, kind, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
        yield np.frombuffer(data.as_buffer(), dtype=KINDS[kind]).reshape(-1, width)


class Rows:
    """The centred matrix X as blocks in a table, with the products that Lanczos steps need."""

    def __init__(self, blocks: DataFrame, mean: np.ndarray) -> None:
        self.blocks, self.mean = blocks.select("width", "kind", "data"), mean

    def _summed(self, share, size: int) -> np.ndarray:
        """Add up vectors of ``size`` numbers, one a task."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for batch in batches:
                for x in _matrices(batch):
                    total += share(x)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], names=["place", "value"])

        rows = self.blocks.mapInArrow(run, "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()
        found = np.zeros(size)
        for r in rows:
            found[r.place] = r.value
        return found

    def product(self, v: np.ndarray) -> tuple[np.ndarray, float]:
        """``X'Xv`` and ``|Xv|^2``."""
        mean = self.mean

        def share(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            p = centred @ v
            return np.r_[p @ centred, p @ p]

        found = self._summed(share, len(v) + 1)
        return found[:-1], float(found[-1])

    def covariance(self, basis: np.ndarray) -> np.ndarray:
        """Sum of products of the centred rows projected on the columns of ``basis``; as many sums as columns squared."""
        mean, k = self.mean, basis.shape[1]

        def share(x: np.ndarray) -> np.ndarray:
            w = (x - mean) @ basis
            return (w.T @ w).ravel()

        return self._summed(share, k * k).reshape(k, k)


def bidiagonalise(product, width: int, want: int, seed: int = 13) -> tuple[np.ndarray, np.ndarray]:
    """Singular values, falling, and right singular vectors (columns) of X, ``want`` at most; zero ones are left out.

    ``product(v)`` gives ``X'Xv`` and ``|Xv|^2``. Goes on until the wanted triplets have converged, then
    starts a second chain in what is left of the space, as long as the first, in which values that occur
    more than once show up again; ends when the space is exhausted in any case.
    """
    random = np.random.default_rng(seed)
    right = np.zeros((width, 0))  # v, orthonormal
    codes = np.zeros((width, 0))  # c, the left vectors are Xc
    images = np.zeros((width, 0))  # X'u
    image, top, chain, goal = None, 0.0, 0, width
    while right.shape[1] < min(width, goal):
        v = None
        if image is not None:
            v = image - right @ (right.T @ image)
            v -= right @ (right.T @ v)
            if np.linalg.norm(v) <= TINY * top:
                v = None
        if v is None:
            v = random.standard_normal(width)
            for _ in range(3):
                v -= right @ (right.T @ v)
        v /= np.linalg.norm(v)
        z, square = product(v)
        c = v.copy()
        for _ in range(2):  # orthogonal to all left vectors; their products with Xc are codes' z
            h = codes.T @ z
            c, z, square = c - codes @ h, z - images @ h, square - h @ h
        alpha = np.sqrt(max(square, 0.0))
        top = max(top, alpha, np.linalg.norm(z) / alpha if alpha > 0 else 0.0)
        right = np.c_[right, v]
        if alpha > TINY * top:
            codes, images = np.c_[codes, c / alpha], np.c_[images, z / alpha]
            image = images[:, -1]
        else:
            image = None
        if images.shape[1] >= want and goal == width:
            left, values, _ = np.linalg.svd(images.T @ right, full_matrices=False)
            rest = images - right @ (right.T @ images)
            if (np.linalg.norm(rest @ left[:, :want], axis=0) <= TINY * values[0]).all():
                chain = right.shape[1]
                goal, image = 2 * chain, None
    if images.shape[1] == 0:
        return np.zeros(0), np.zeros((width, 0))
    _, values, turned = np.linalg.svd(images.T @ right, full_matrices=False)  # upper bidiagonal but for the start of the second chain
    good = values > 1e3 * TINY * values[0]
    return values[good][:want], (right @ turned.T)[:, good][:, :want]


def _whitened(mean: np.ndarray, sums: list[int], n: int, basis: np.ndarray, explained: np.ndarray, error: float):
    """Rows of the result for every block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = basis.shape[1]
        for batch in batches:
            for ids, x in zip(batch.column(3), _matrices(batch), strict=True):
                w = (x - mean) @ basis
                bound = n * int(np.abs(x).max()) + max(map(abs, sums))
                if bound * bound * x.shape[1] < 1 << 62:
                    deviation = ((n * x.astype(np.int64) - np.array(sums)) ** 2).sum(axis=1).tolist()
                else:
                    deviation = (((n * x.astype(object) - np.array(sums, dtype=object)) ** 2).sum(axis=1)).tolist()
                told = pa.array([d if d < 1 << 63 else None for d in deviation], pa.int64())
                at = pa.array(np.repeat(np.arange(len(x)), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.values.take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(x) * k, n)),
                        told.take(at), pa.array(w.ravel()), pa.array(np.tile(explained, len(x))), pa.array(np.full(len(x) * k, error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return run


def whiten(spark: SparkSession, embeddings: DataFrame, components: int = 32) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` for every usable vector and component.

    ``embeddings(vec_id, embedding, ...)``; an entry ``c`` counts as ``x = floor(64 c) + 1000000``. ``n``
    vectors are used, all with the same weight; ``deviation`` is the exact squared length of ``n x - S``
    with ``S`` the sums per dimension, ``explained`` the component's share of the variance, and
    ``identity_error`` the largest absolute entry of the whitened covariance minus the identity.

    Vectors that are null, empty or hold null or non-finite entries give no rows. Of vectors of several
    widths the commonest width counts (the larger of equals), the others give no rows. Directions
    without variance are no components: equal vectors, a single vector and an empty table give no rows.
    A null ``vec_id`` and repeated rows are kept as they are and count each time; other columns are
    ignored. A ``deviation`` beyond a long is null; entries beyond 2^62 / 64 count as that. Very long
    vectors need a matrix of their width squared where the plan is built.
    """
    vectors = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    blocks = keep(spark, vectors.mapInArrow(_pack, _BLOCKS), "blocks")
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    common = blocks.groupBy("width").agg(F.sum("rows").alias("n")).orderBy(F.desc("n"), F.desc("width")).first()
    if common is None:
        return spark.createDataFrame([], schema)
    width, n = common.width, common.n
    blocks = blocks.where(F.col("width") == width)
    total = blocks.select(F.posexplode("sums").alias("place", "value")).groupBy("place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    sums = [int(r.value) for r in sorted(total.collect())]
    mean = np.array([s / n for s in sums])
    x = Rows(blocks, mean)
    values, basis = bidiagonalise(x.product, width, components)
    if len(values) == 0:
        return spark.createDataFrame([], schema)
    trace = float(x._summed(lambda rows: np.array([((rows - mean) ** 2).sum()]), 1)[0])
    basis = basis * (np.sqrt(n) / values)
    error = float(np.abs(x.covariance(basis) / n - np.eye(len(values))).max())
    out = blocks.select("width", "kind", "data", "vec_id").mapInArrow(_whitened(mean, sums, n, basis, values**2 / trace, error), schema)
    found = keep(spark, out, "whitened")
    drop(spark, blocks)
    return found
