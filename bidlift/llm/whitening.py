"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Vectors are put on a grid (x = floor(64 c) + 1000000), the fit list is each
distinct grid vector once, stored as blocks of integers. One pass over the
blocks centres each vector by the exact sums, multiplies by a narrow matrix Q
and sums Xc'(Xc Q) / n = V Q; V itself is never built. A polynomial in V, grown
by the three-term Chebyshev recurrence with one pass a degree, damps all
directions whose eigenvalue lies below a cut and raises those above it; then
QR, one more pass, and a Rayleigh-Ritz step in the small space. Rounds go on
until the residuals |V q - e q| of all wanted components are at the level of
rounding, and the whitened covariance, recounted over the fit list by a pass of
its own, certifies the result.

Only matrices of (dimension x columns) and sums per dimension reach the driver;
Spark adds up the tasks' parts cell by cell.

Defined results: a row whose vector is NULL, empty, or holds a NULL, a
non-finite entry or one whose grid value does not fit 62 bits is dropped, and
so is a row whose vector is not of the commonest length (the longer one at a
tie); repeated vectors count once in the fit and all of their rows are
returned; components without variance are left out, so a fit list of fewer
than two vectors, or an empty table, gives no rows; a NULL ``vec_id`` is kept;
further columns are ignored. A ``deviation`` beyond 64 bits raises an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, materialize

GRID, SHIFT = 64, 1_000_000
COMPONENTS = 16
WIDER = 3  # columns of the subspace, per component
BLOCK = 2048  # vectors of a block
DEGREE = 12  # of the filter, at most
ROUNDS = 400  # the fit fails beyond these
FLOOR = 4e-16  # residual, relative to the largest eigenvalue and the root of the dimension, at which a fit is certified
ZERO = 1e-12  # eigenvalues below this share of the largest have no variance
VECTORS_PER_BATCH = 2048
LARGEST = float(1 << 61)


def gridded(rows: DataFrame, vector: str = "embedding", id: str = "vec_id") -> DataFrame:
    """(vec_id, x) of the rows that remain, x an array of bigint."""
    c = F.col(f"`{vector}`")
    cell = lambda v: F.floor(v.cast("double") * GRID)
    good = F.size(c) > 0
    fits = F.forall(c, lambda v: F.coalesce(F.abs(v.cast("double") * GRID) < LARGEST, F.lit(False)) & ~F.isnan(v))
    kept = rows.where(c.isNotNull() & good & fits)
    lengths = kept.groupBy(F.size(c).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.agg(F.max(F.struct("n", "d")).alias("m")).select("m.d")
    return kept.join(F.broadcast(common), F.size(c) == F.col("d"), "left_semi").select(
        F.col(f"`{id}`").alias("vec_id"), F.transform(c, lambda v: cell(v).cast("bigint") + SHIFT).alias("x")
    )


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(0, batch.num_rows, BLOCK):
            x = _matrix(batch.column("x").slice(row, BLOCK))
            base = x.min(axis=0)
            narrow = (x - base).max() < 1 << 31
            cells = (x - base).astype(np.int32 if narrow else np.int64)
            arrays = [[len(x)], [base.tobytes()], [bool(narrow)], [cells.tobytes()]]
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["n", "base", "narrow", "cells"])


def fit_blocks(grid: DataFrame) -> DataFrame:
    """Each distinct vector once, in blocks of integers, written."""
    arrow_rows(grid.sparkSession, VECTORS_PER_BATCH)
    blocks = grid.select("x").distinct().mapInArrow(_to_blocks, "n bigint, base binary, narrow boolean, cells binary")
    return materialize(blocks, "vectors")


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for n, base, narrow, cells in zip(*(batch.column(i).to_pylist() for i in range(4))):
            x = np.frombuffer(cells, np.int32 if narrow else np.int64).reshape(n, -1).astype(np.int64)
            yield x + np.frombuffer(base, np.int64)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = None, 0
    for x in _vectors(batches):
        part = x.sum(axis=0, dtype=np.int64)
        total, n = part if total is None else total + part, n + len(x)
    if total is not None:
        cells = np.concatenate([[n], total])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), pa.array(cells)], ["cell", "v"])


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S/n: the integer part of the mean is taken off exactly."""
    whole = sums // n
    return (x - whole) - (sums - whole * n) / n


def _summed(blocks: DataFrame, part: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """Sum over the fit list of a small matrix made of each block, as one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for x in _vectors(batches):
            total = part(x) if total is None else total + part(x)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["cell", "v"])

    cells = blocks.mapInArrow(run, "cell bigint, v double").groupBy("cell").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(shape[0] * shape[1])
    out[cells.column("cell").to_numpy()] = cells.column("v").to_numpy()
    return out.reshape(shape)


@dataclass
class Whitening:
    """What whitens a vector: size and sums of the fit list, components (dimension x k) and their eigenvalues."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float
    passes: int


def filtered(apply: Callable[[np.ndarray], np.ndarray], q: np.ndarray, cut: float, top: float, degree: int) -> np.ndarray:
    """A Chebyshev polynomial in V times ``q``: at most 1 in size on [0, cut], 1 at ``top``, growing above the cut."""
    half = cut / 2
    first = half / (top - half)
    scale, before, now = first, q, (apply(q) - half * q) * (first / half)
    for _ in range(degree - 1):
        next_scale = 1 / (2 / first - scale)
        before, now = now, 2 * (next_scale / half) * (apply(now) - half * now) - scale * next_scale * before
        scale = next_scale
    return now


def fit(blocks: DataFrame, components: int = COMPONENTS, seed: int = 7) -> Whitening | None:
    """Components of the fit list, or None where it holds no variance."""
    totals = blocks.mapInArrow(_sums, "cell bigint, v bigint").groupBy("cell").agg(F.sum("v").alias("v")).toArrow()
    order = np.argsort(totals.column("cell").to_numpy())
    cells = totals.column("v").to_numpy()[order]
    if len(cells) < 2 or cells[0] < 2:
        return None
    n, sums = int(cells[0]), cells[1:]
    d = len(sums)
    passes = 0

    def apply(q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1

        def part(x):
            c = centred(x, n, sums)
            return c.T @ (c @ q)

        return _summed(blocks, part, q.shape) / n

    trace = float(_summed(blocks, lambda x: (centred(x, n, sums) ** 2).sum(axis=0)[:, None], (d, 1)).sum()) / n
    if not trace > 0:
        return None
    width = min(d, WIDER * components)
    k = min(d, components)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, width)))[0]
    best = None
    for _ in range(ROUNDS):
        image = apply(q)
        small = q.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, image = q @ turn, image @ turn
        residual = np.linalg.norm(image - q * values, axis=0)[:k].max() / values[0]
        if best is None or residual < best[0]:
            best, stalled = (residual, q, values), 0
        else:
            stalled += 1
        # Certified at rounding level; at twice that level a fit that stalls cannot get better.
        if residual <= FLOOR * np.sqrt(d) or (stalled >= 2 and best[0] <= 64 * FLOOR * np.sqrt(d)) or width == d and stalled:
            break
        cut = max(values[-1], values[0] * 1e-9)
        # Beyond this growth, columns would lose their smaller parts to rounding.
        room = np.arccosh(max(2 * values[0] / cut - 1, 1 + 1e-9))
        q = np.linalg.qr(filtered(apply, q, cut, values[0], int(np.clip(23 / room, 2, DEGREE))))[0]
    else:
        raise RuntimeError(f"components not certified after {ROUNDS} rounds: residual {best[0]:.3g}")
    residual, q, values = best
    kept = int((values[:k] > ZERO * values[0]).sum())
    q, values = q[:, :kept], values[:kept]
    scaled = q / np.sqrt(values)

    def part(x):
        z = centred(x, n, sums) @ scaled
        return z.T @ z

    error = float(np.abs(_summed(blocks, part, (kept, kept)) / n - np.eye(kept)).max())
    return Whitening(n, sums, q, values, trace, error, passes)


OUT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def transform(grid: DataFrame, w: Whitening) -> DataFrame:
    """One row per row of ``grid`` and component."""
    arrow_rows(grid.sparkSession, VECTORS_PER_BATCH)
    n, sums, scaled = w.n, w.sums, w.components / np.sqrt(w.values)
    k, shares, error = len(w.values), w.values / w.trace, w.identity_error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in OUT.split(", ")]
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("x"))
            whole = sums // n
            near, rest = x - whole, sums - whole * n  # n x - S = n near - rest, with 0 <= rest < n
            largest = (int(np.abs(near).max()) + 1) * n
            if largest * largest * x.shape[1] < 1 << 63:
                deviation = ((n * near - rest) ** 2).sum(axis=1)
            else:
                deviation = ((n * near.astype(object) - rest.astype(object)) ** 2).sum(axis=1)
            z = (near - rest / n) @ scaled
            each = lambda a: pa.array(np.repeat(np.asarray(a), k))
            ids = batch.column("vec_id").take(pa.array(np.repeat(np.arange(len(x)), k)))
            tiled = np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))
            deviations = pa.array([int(v) for v in deviation], pa.int64()).take(pa.array(np.repeat(np.arange(len(x)), k)))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(tiled), each(np.full(len(x), n)), deviations, pa.array(z.ravel()), pa.array(np.tile(shares, len(x))), each(np.full(len(x), error))],
                names,
            )

    return grid.select(F.col("vec_id").cast("bigint").alias("vec_id"), "x").mapInArrow(run, OUT)


def whitened(rows: DataFrame, vector: str = "embedding", id: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every row that remains."""
    grid = gridded(rows, vector, id)
    fitted = fit(fit_blocks(grid), components)
    if fitted is None:
        return rows.sparkSession.createDataFrame([], OUT)
    return transform(grid, fitted)
