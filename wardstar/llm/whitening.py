"""Principal components of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

The matrix Z holds the distinct vectors, centred, a row each; it stays distributed. Starting
from a random direction v, the method alternates u = Z v and v = Z' u, each made orthogonal to
all earlier ones, which turns Z into a small upper bidiagonal matrix with the same singular
values. Its decomposition gives components and deviations.

A left vector has an entry per row. None is stored: every u is Z w for a w that has an entry
per dimension, so tasks compute the entries of all left vectors for their rows anew, and only
sums over rows leave them: inner products of left vectors and products Z' u. These sums are
added up by Spark, an entry each, before the driver sees them; it holds no more than a few
vectors of one entry per dimension for every step.

The iteration stops when the wanted singular triplets have no measurable residual and the
variance outside the searched space is below that of the last one wanted, which proves that
none was missed; at the latest after as many steps as there are dimensions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstar.session import plan_bytes, stage

# Fixed values.
SCALE = 256
COMPONENTS = 4

EXACT = 1 << 62  # sums below this are exact in 64-bit integers
RESIDUAL = 1e-15  # of the largest singular value
RANK = 1e-12  # smaller singular values, relative to the largest, count as none
SLICE_VALUES = 1 << 20
TASK_BYTES = 64 << 20  # of the stored fit list, that one task of a scan reads


@dataclass
class Whitening:
    """Mean and components of the fit list (``n`` distinct vectors with sums ``total``)."""

    n: int
    total: list[int]
    values: np.ndarray  # variances, falling
    vectors: np.ndarray  # a column per component
    trace: float
    identity_error: float
    steps: int

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.total])


def _matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(-1, dims)


def quantised(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Columns k (id), x (vector of floor(256 * entry), packed as 64-bit integers).

    Rows whose vector is null, has no entries, or holds a null or an entry that is not finite
    are left out. Numbers beyond 64 bits are cut to their limits.
    """
    c = F.col(f"`{vector}`")
    whole = c.isNotNull() & (F.size(c) > 0) & F.forall(c, lambda e: e.isNotNull() & (F.abs(e) < float("inf")))
    kept = rows.filter(whole).select(F.col(f"`{vec_id}`").alias("k"), F.col(f"`{vector}`").cast("array<double>").alias("c"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            flat = np.clip(np.floor(lists.flatten().to_numpy(zero_copy_only=False) * SCALE), -(2.0**63), 2.0**63 - 1024)
            data = flat.astype("<i8").tobytes()
            x = pa.array([data[8 * a : 8 * b] for a, b in zip(bounds[:-1], bounds[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), x], ["k", "x"])

    schema = kept.select("k").schema.add("x", "binary")
    return kept.mapInArrow(packed, schema)


def _sums(fit: DataFrame, dims: int, of: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> list:
    """Sums of ``of(vectors)`` over all rows of the fit list, an entry each."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = None
        for batch in batches:
            for at in range(0, batch.num_rows, step := max(1, SLICE_VALUES // dims)):
                part = of(_matrix(batch.column(0).slice(at, step), dims))
                done = part if done is None else done + part
        if done is not None:
            places = np.arange(len(done), dtype=np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(done)], ["i", "v"])

    parts = fit.mapInArrow(partial, f"i int, v {kind}")
    added = F.sum("v") if kind == "double" else F.sum(F.col("v").cast("decimal(20,0)"))
    return [r["v"] for r in parts.groupBy("i").agg(added.alias("v")).orderBy("i").collect()]


def _halves(x: np.ndarray) -> np.ndarray:
    """Number of rows, then sums of the upper and of the lower 32 bits of each dimension."""
    return np.concatenate([[len(x)], (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)]).astype(np.int64)


def _orthogonal(vector: np.ndarray, known: list[np.ndarray]) -> np.ndarray:
    if known:
        columns = np.stack(known, axis=1)
        for _ in range(2):
            vector = vector - columns @ (columns.T @ vector)
    return vector


def _direction(known: list[np.ndarray], dims: int, draw: np.random.Generator) -> np.ndarray:
    fresh = _orthogonal(draw.standard_normal(dims), known)
    return fresh / np.linalg.norm(fresh)


def bidiagonalise(
    fit: DataFrame, dims: int, mean: np.ndarray, energy: float, wanted: int = COMPONENTS, seed: int = 0
) -> tuple[np.ndarray, np.ndarray, int]:
    """Singular values (falling) and right vectors (columns) of the centred fit list, and the number of steps.

    ``energy`` is the sum of squares of all entries of Z. Each step scans the rows twice: the
    first scan removes the earlier left vectors from Z v, the second measures what is left of
    them (removed as well) and adds up Z' u.
    """
    draw = np.random.default_rng(seed)
    rights: list[np.ndarray] = [_direction([], dims, draw)]  # v
    lefts: list[np.ndarray] = []  # w with u = Z w
    images: list[np.ndarray] = []  # Z' u
    alphas: list[float] = []
    betas: list[float] = []  # above the diagonal, before each v but the first
    scale = np.sqrt(energy)
    while True:
        k = len(lefts)
        known = np.stack(lefts, axis=1) if k else np.zeros((dims, 0))
        w = rights[k] - (betas[k - 1] * lefts[k - 1] if k else 0.0)

        def overlap(x: np.ndarray, w: np.ndarray = w) -> np.ndarray:
            z = x - mean
            return (z @ known).T @ (z @ w)

        if k:
            w = w - known @ np.array(_sums(fit, dims, overlap))

        def product(x: np.ndarray, w: np.ndarray = w) -> np.ndarray:
            z = x - mean
            u = z @ w
            return np.concatenate([(z @ known).T @ u, [u @ u], z.T @ u])

        held = np.array(_sums(fit, dims, product))
        left_over, square, image = held[:k], held[k], held[k + 1 :]
        if k:
            w, image = w - known @ left_over, image - np.stack(images, axis=1) @ left_over
        alpha = float(np.sqrt(max(square - left_over @ left_over, 0.0)))
        if alpha <= RANK * scale:  # v lies where Z is zero: an empty left vector
            alpha, w, image = 0.0, np.zeros(dims), np.zeros(dims)
        else:
            w, image = w / alpha, image / alpha
        alphas.append(alpha)
        lefts.append(w)
        images.append(image)
        following = _orthogonal(image - alpha * rights[k], rights)
        beta = float(np.linalg.norm(following))
        small = np.diag(alphas) + np.diag(betas, 1)
        p, sigma, q = np.linalg.svd(small)
        residuals = beta * np.abs(p[-1])
        outside = energy - float(sigma @ sigma)
        first = min(wanted, k + 1)
        settled = (residuals[:first] <= RESIDUAL * scale).all() and outside <= max(sigma[first - 1] ** 2, 1e-12 * energy)
        if k + 1 == dims or (settled and (k + 1 >= wanted or outside <= 1e-12 * energy)):
            return sigma, np.stack(rights, axis=1) @ q.T, k + 1
        if beta <= RANK * scale:  # the space is closed: go on with a fresh direction outside it
            rights.append(_direction(rights, dims, draw))
            betas.append(0.0)
        else:
            rights.append(following / beta)
            betas.append(beta)


def fit_list(vectors: DataFrame) -> tuple[DataFrame, int]:
    """Each distinct vector once (column x, stored), and the number of dimensions.

    Copies are combined before the shuffle, so a vector with any number of copies is a row a
    task. Where lengths differ, the commonest counts (of equally common ones the longest).
    """
    lengths = vectors.groupBy(F.length("x").alias("bytes")).count()
    top = lengths.orderBy(F.desc("count"), F.desc("bytes")).first()
    dims = top["bytes"] // 8 if top else 0
    listed = stage(vectors.filter(F.length("x") == 8 * dims).select("x").distinct(), "whiten-fit")
    # the list is scanned many times: no more tasks than its size or the cores ask for
    tasks = max(listed.sparkSession.sparkContext.defaultParallelism, -(-plan_bytes(listed) // TASK_BYTES))
    return listed.coalesce(tasks), dims


def fit(vectors: DataFrame, wanted: int = COMPONENTS, seed: int = 0) -> Whitening | None:
    """The whitening of a table of packed vectors (``quantised``); None without rows.

    Components without variance are left out: equal vectors, or one alone, have none.
    """
    listed, dims = fit_list(vectors)
    if not dims:
        return None
    held = [int(v) for v in _sums(listed, dims, _halves, "bigint")]
    n, total = held[0], [(a << 32) + b for a, b in zip(held[1 : dims + 1], held[dims + 1 :], strict=True)]
    mean = np.array([s / n for s in total])
    energy = _sums(listed, dims, lambda x: np.array([np.square(x - mean).sum()]))[0]
    if energy <= 0:
        return Whitening(n, total, np.zeros(0), np.zeros((dims, 0)), 0.0, 0.0, 0)
    sigma, vectors_, steps = bidiagonalise(listed, dims, mean, energy, wanted, seed)
    chosen = [i for i in range(min(wanted, len(sigma))) if sigma[i] > RANK * np.sqrt(energy)]
    values = sigma[chosen] ** 2 / n
    axes = vectors_[:, chosen]
    weights = axes / np.sqrt(values)

    def moments(x: np.ndarray) -> np.ndarray:
        y = (x - mean) @ weights
        return np.concatenate([y.sum(axis=0), (y.T @ y).ravel()])

    m = len(chosen)
    held = np.array(_sums(listed, dims, moments)) / n
    covariance = held[m:].reshape(m, m) - np.outer(held[:m], held[:m])
    error = float(np.abs(covariance - np.eye(m)).max())
    return Whitening(n, total, values, axes, energy / n, error, steps)


def _deviations(x: np.ndarray, n: int, total: list[int]) -> list[int | None]:
    """Sums of (n * x - total) squared, exact; None beyond 64 bits."""
    largest = n * int(max(np.abs(x.astype(float)).max(), 1)) + max(map(abs, total))
    if len(total) * largest**2 < EXACT:
        y = n * x - np.array(total, np.int64)
        return (y * y).sum(axis=1).tolist()
    exact = [sum((n * a - s) ** 2 for a, s in zip(row, total)) for row in x.tolist()]
    return [v if v < 1 << 63 else None for v in exact]


def whitened(vectors: DataFrame, fitted: Whitening | None) -> DataFrame:
    """A row per vector and component: columns k, component (from 1), n, deviation, whitened, explained, identity_error.

    Equal vectors give equal rows, a null id is a value like any other. Vectors of another
    length than the fit list has are left out, as they have no place in its space. ``deviation``
    is null where the exact sum does not fit 64 bits.
    """
    schema = vectors.select("k").schema
    for name, kind in [
        ("component", "integer"), ("n", "long"), ("deviation", "long"),
        ("whitened", "double"), ("explained", "double"), ("identity_error", "double"),
    ]:
        schema = schema.add(name, kind)
    if fitted is None or not len(fitted.values):
        return vectors.sparkSession.createDataFrame([], schema)
    dims, m = len(fitted.total), len(fitted.values)
    mean, weights = fitted.mean, fitted.vectors / np.sqrt(fitted.values)
    explained = fitted.values / fitted.trace

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, step := max(1, SLICE_VALUES // dims)):
                part = batch.slice(at, step)
                rows = part.num_rows
                x = _matrix(part.column(1), dims)
                each = np.repeat(np.arange(rows), m)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(each)),
                        pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), rows)),
                        pa.array(np.full(rows * m, fitted.n)),
                        pa.array(_deviations(x, fitted.n, fitted.total), pa.int64()).take(pa.array(each)),
                        pa.array(((x - mean) @ weights).ravel()),
                        pa.array(np.tile(explained, rows)),
                        pa.array(np.full(rows * m, fitted.identity_error)),
                    ],
                    schema.names,
                )

    return vectors.filter(F.length("x") == 8 * dims).mapInArrow(project, schema)


def whiten(
    rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", wanted: int = COMPONENTS, seed: int = 0
) -> DataFrame:
    """``whitened`` rows of a table of embeddings, fitted on its own distinct vectors."""
    vectors = quantised(rows, vec_id, vector)
    return whitened(vectors, fit(vectors, wanted, seed))
