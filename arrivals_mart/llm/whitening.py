"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Entries become whole numbers ``x = floor(1024 c) + 100000``. The covariance V of
the x-vectors is never formed: the only thing done with the data is the
distributed pass ``Q -> V Q = (1/n) sum of xc (xc . Q)`` for a block Q of few
columns, with ``xc = x - S/n`` centred from the exact sums S before anything
is multiplied. A task returns one d x k block, Spark adds the blocks.

1. A few Lanczos steps bound the spectrum from below and above.
2. A block of ``components + GUARD`` columns is filtered: a Chebyshev polynomial of V,
   by its three-term recurrence with a pass a degree, is small on the unwanted
   interval (from the lower bound to the block's smallest Ritz value) and grows
   fast above it.
3. QR makes the block orthonormal; Rayleigh-Ritz (from one more pass, which is
   also the first of the next filter) gives eigenvalues and vectors.
4. The wanted pairs are certified by their residuals |V q - e q|: at most
   ``TOLERANCE`` of the largest eigenvalue, or no longer halving and at most
   ``FLOOR`` of it (rounding in the sums over the rows is all that is left then).
   Without a certificate after ``ROUNDS`` filters the fit fails.

The driver holds d x k blocks only. The x-vectors are written once; a pass reads
them and shuffles d k sums a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivals_mart.llm.common import materialize

COMPONENTS = 8
#: Columns of the block beyond the wanted ones.
GUARD = 24
DEGREE = 12
#: How much more a filter may favour the largest eigenvalue than the smallest Ritz
#: value: past it rounding would turn the block's last columns into the first one.
#: Less for the random block, whose columns are not yet told apart.
SPREAD, RANDOM_SPREAD = 1e12, 1e6
LANCZOS = 10
ROUNDS = 40
TOLERANCE = 4e-15
FLOOR = 1e-9
#: Residual at which a pair is projected out of the filter.
LOCKED = 1e-13
#: An eigenvalue below this share of the largest one is zero.
RANK = 1e-11
SCALE, OFFSET = 1024, 100_000
#: Entries of x are below this; 2^31 rows of them have sums that fit.
_LARGEST = float(1 << 61)
_SEED = 12


@dataclass(frozen=True)
class Whitening:
    """``sums`` are exact; ``vectors`` has a column for each of ``values``, the
    eigenvalues in falling order; ``trace`` is that of V. ``passes`` over the
    data were made, ``residual`` is the largest of the certificate."""

    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    passes: int
    residual: float

    @property
    def dim(self) -> int:
        return len(self.sums)


def _whole_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, lists = batch.columns
        size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        flat = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # null: not a number
        with np.errstate(over="ignore", invalid="ignore"):
            x = np.floor(flat * SCALE)
            good = np.abs(x) < _LARGEST
        ends = np.concatenate([[0], np.cumsum(size)])
        bad = np.concatenate([[0], np.cumsum(~good)])
        keep = (size > 0) & (bad[ends[1:]] == bad[ends[:-1]])
        x = x[np.repeat(keep, size)].astype(np.int64) + OFFSET
        offsets = np.concatenate([[0], np.cumsum(size[keep])]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [ids.filter(pa.array(keep)), pa.array(size[keep].astype(np.int32)), pa.ListArray.from_arrays(offsets, pa.array(x))],
            ["vec_id", "dim", "x"],
        )


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """``(vec_id, x)`` of the usable rows of ``embeddings (vec_id, embedding)``.

    Left out: vectors that are null, empty, hold null or non-finite entries or
    such that 1024 times them does not fit a long, and vectors of another length than most (of equally frequent
    lengths the longest counts). Written to the shared scratch folder."""
    rows = embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding"))
    whole = materialize(rows.mapInArrow(_whole_batches, "vec_id long, dim int, x array<long>"), "whole_vectors")
    most = whole.groupBy("dim").count().orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()
    return whole.where(F.col("dim") == (most[0]["dim"] if most else 0)).select("vec_id", "x")


def _matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, dim)


def _cells(values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.arange(values.size, dtype=np.int32)), pa.array(values.ravel())], ["cell", "value"]
    )


def _sums(vectors: DataFrame, dim: int) -> tuple[int, tuple[int, ...]]:
    """Rows and exact sums of each dimension, of numbers of any size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(0), dim)
            low = (x & 0xFFFFFFFF).sum(axis=0)
            yield _cells(np.concatenate([low, (x >> 32).sum(axis=0), [len(x)]]).astype(np.int64))

    cells = vectors.select("x").mapInArrow(run, "cell int, value long")
    got = {r.cell: int(r.value) for r in cells.groupBy("cell").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()}
    return got[2 * dim], tuple(got[j] + (got[dim + j] << 32) for j in range(dim))


class _Centred:
    """x - S/n with no digit lost to the size of x: whole parts first."""

    def __init__(self, n: int, sums: tuple[int, ...]):
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([(s % n) / n for s in sums])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest


class _Covariance:
    """V as something that can be multiplied by a block: a pass over the data."""

    def __init__(self, vectors: DataFrame, n: int, sums: tuple[int, ...]):
        self.x, self.n, self.dim = vectors.select("x"), n, len(sums)
        self.centre = _Centred(n, sums)
        self.passes, self.trace = 0, 0.0

    def __call__(self, block: np.ndarray) -> np.ndarray:
        centre, dim = self.centre, self.dim

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, squares = np.zeros(block.shape), 0.0
            for batch in batches:
                xc = centre(_matrix(batch.column(0), dim))
                total += xc.T @ (xc @ block)
                squares += float(np.einsum("ij,ij->", xc, xc))
            yield _cells(np.append(total.ravel(), squares))

        got = self.x.mapInArrow(run, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value"))
        out = np.zeros(block.size + 1)
        for r in got.collect():  # d k cells
            out[r.cell] = r.value
        self.passes += 1
        self.trace = out[-1] / self.n
        return out[:-1].reshape(block.shape) / self.n


def _bounds(v: _Covariance, rng: np.random.Generator) -> tuple[float, float]:
    """Below and above the spectrum, from Lanczos steps with full reorthogonalisation."""
    q = rng.standard_normal(v.dim)
    basis = [q / np.linalg.norm(q)]
    alphas, betas = [], []
    for _ in range(min(LANCZOS, v.dim)):
        w = v(basis[-1][:, None])[:, 0]
        alphas.append(float(basis[-1] @ w))
        for _ in range(2):
            for b in basis:
                w -= (b @ w) * b
        betas.append(float(np.linalg.norm(w)))
        if betas[-1] <= RANK * max(map(abs, alphas)):
            break
        basis.append(w / betas[-1])
    values, vectors = np.linalg.eigh(np.diag(alphas) + np.diag(betas[:-1], 1) + np.diag(betas[:-1], -1))
    # Each Ritz value has an eigenvalue within its residual.
    left = betas[-1] * np.abs(vectors[-1])
    return max(0.0, float(values[0] - left[0])), float(values[-1] + left[-1])


def _degree(low: float, cut: float, top: float, spread: float) -> int:
    """The degree at which the polynomial grows by ``spread`` from ``cut`` to ``top``."""
    growth = float(np.arccosh((2 * top - cut - low) / (cut - low)))
    return int(np.clip(np.log(spread) / growth, 2, DEGREE))


def _filtered(
    v: _Covariance, block: np.ndarray, product: np.ndarray, degree: int, low: float, cut: float, top: float, locked: np.ndarray
) -> np.ndarray:
    """A Chebyshev polynomial of V, small on [low, cut], times the block, whose
    first product is given; scaled to be 1 at ``top``. Directions of ``locked``
    are taken out of every product."""
    half, mid = (cut - low) / 2, (cut + low) / 2
    sigma = half / (top - mid)
    tau = 2 / sigma
    before, now = block, (product - mid * block) * (sigma / half)
    for _ in range(degree - 1):
        now = now - locked @ (locked.T @ now)
        new = 1 / (tau - sigma)
        before, now = now, (v(now) - mid * now) * (2 * new / half) - (sigma * new) * before
        sigma = new
    return now - locked @ (locked.T @ now)


def fit_whitening(vectors: DataFrame, components: int = COMPONENTS, guard: int = GUARD) -> Whitening | None:
    """The leading eigenpairs of the covariance of ``vectors`` (of
    :func:`whole_vectors`); None without a row. Eigenvalues that are zero to
    rounding are left out, so equal vectors have no component."""
    first = vectors.select(F.size("x").alias("dim")).first()
    if first is None:
        return None
    n, sums = _sums(vectors, first["dim"])
    v = _Covariance(vectors, n, sums)
    rng = np.random.default_rng(_SEED)
    low, top = _bounds(v, rng)
    size = min(v.dim, components + guard)
    block = np.linalg.qr(rng.standard_normal((v.dim, size)))[0]
    best, stalled = np.inf, 0
    for turn in range(ROUNDS + 1):
        product = v(block)
        ritz = block.T @ product
        values, turned = np.linalg.eigh((ritz + ritz.T) / 2)
        values, turned = values[::-1], turned[:, ::-1]
        block, product = block @ turned, product @ turned
        wanted = int((values[:components] > RANK * max(values[0], 0)).sum())
        left = np.linalg.norm(product - block * values, axis=0) / max(values[0], 1e-300)
        worst = float(left[:wanted].max(initial=0))
        stalled = stalled + 1 if worst > 0.5 * best else 0
        best = min(best, worst)
        if worst <= TOLERANCE or (worst <= FLOOR and stalled):
            return Whitening(n, sums, block[:, :wanted], values[:wanted], v.trace, v.passes, worst)
        # Leading pairs that are done are projected out, so that the filter's
        # reach is that of the pairs still wanted.
        done = int(np.argmax(left > LOCKED)) if turn else 0
        locked, rest = block[:, :done], block[:, done:]
        cut = max(float(values[-1]), low + 1e-15 * float(values[0]))
        reach = max(float(values[done]) if turn else top, 1.001 * cut)
        degree = _degree(low, cut, reach, SPREAD if turn else RANDOM_SPREAD)
        rest = _filtered(v, rest, product[:, done:], degree, low, cut, reach, locked)
        block = np.linalg.qr(np.hstack([locked, rest]))[0]
    raise RuntimeError(f"not certified after {ROUNDS} filters: residual {best:.3g} of the largest eigenvalue")


def _deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> pa.Array:
    """Exact sums over the dimensions of (n x - S)^2."""
    most = max(n * int(np.abs(x).max()) + max(map(abs, sums)), 1) if len(x) else 1
    if most * most * len(sums) < 1 << 63:
        d = n * x - np.array(sums, np.int64)
        return pa.array(np.einsum("ij,ij->i", d, d)).cast(pa.decimal128(38, 0))
    # n x - S is n (x - S // n) - S % n, small numbers if x is near its mean.
    whole, rest = np.array([s // n for s in sums], np.int64), np.array([s % n for s in sums], np.int64)
    near = x - whole
    most = n * (int(np.abs(near).max()) + 1) if len(x) else 1
    if most * most * len(sums) < 1 << 63:
        d = n * near - rest
        return pa.array(np.einsum("ij,ij->i", d, d)).cast(pa.decimal128(38, 0))
    d = n * near.astype(object) - rest.astype(object)
    found = [int(y) for y in (d * d).sum(axis=1)]
    return pa.array([y if y < 10**38 else None for y in found], pa.decimal128(38, 0))


def _projected(model: Whitening):
    centre, onto = _Centred(model.n, model.sums), model.vectors / np.sqrt(model.values)
    return lambda x: centre(x) @ onto


def whiten(vectors: DataFrame, model: Whitening | None) -> DataFrame:
    """``(vec_id, deviation, whitened)`` of every row of ``vectors``:
    ``whitened`` holds the centred vector projected on each component, over the
    root of its eigenvalue; ``deviation`` is the exact squared distance of n x
    from the sums, a ``decimal(38,0)`` (null where that has more digits).

    Null ids stay null, repeated rows keep a row each; no model, no rows.
    """
    schema = "vec_id long, deviation decimal(38,0), whitened array<double>"
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    n, sums, dim = model.n, model.sums, model.dim
    project = _projected(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), dim)
            w = project(x)
            ends = np.arange(len(x) + 1, dtype=np.int32) * w.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _deviations(x, n, sums), lists], ["vec_id", "deviation", "whitened"]
            )

    return vectors.select("vec_id", "x").mapInArrow(run, schema)


def identity_error(vectors: DataFrame, model: Whitening | None) -> float | None:
    """Largest absolute entry of (covariance of the whitened rows) - identity,
    from a pass over the rows."""
    if model is None or not len(model.values):
        return None
    project, dim, k = _projected(model), model.dim, len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = project(_matrix(batch.column(0), dim))
            yield _cells(np.concatenate([(w.T @ w).ravel(), w.sum(axis=0)]))

    sums = vectors.select("x").mapInArrow(run, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    got = np.zeros(k * k + k)
    for r in sums.collect():  # k k + k cells
        got[r.cell] = r.value / model.n
    mean = got[k * k :]
    return float(np.abs(got[: k * k].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())
