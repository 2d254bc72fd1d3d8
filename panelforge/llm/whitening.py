"""Whitening of vectors by Chebyshev-filtered subspace iteration.

The covariance is never formed. A pass over the distinct vectors gives V Q for a thin block Q: each partition
adds up c (c' Q) over its centred vectors c. A Chebyshev polynomial of V, applied by its three-term recurrence
(one pass a degree), damps the unwanted part of the spectrum; QR and Rayleigh-Ritz follow. This repeats until the
wanted pairs are certified: their residuals are at rounding level and fresh random vectors, filtered outside the
block, show no larger eigenvalue.

Vectors become whole numbers first, so sums are exact and centring, (n x - S) / n, loses nothing.
"""
from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from panelforge.llm.common import scratch_table, ship_code
from panelforge.llm.topk import whole_vector

#: Vectors of a packed block and of a task; columns beyond the wanted ones, as a multiple of them; matrices that may
#: reach the driver unmerged.
BLOCK, TASK, GUARD, DIRECT = 4096, 65_536, 2, 64
#: Residual, relative to the largest eigenvalue, at which a pair counts as converged, and the one it must reach.
TIGHT, CERTIFIED = 1e-14, 1e-12
MAX_ROUNDS = 60
_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass(frozen=True)
class Whitening:
    """``n`` distinct vectors with sums ``sums``; unit ``components`` (columns) with ``eigenvalues`` of their
    covariance, largest first; ``trace`` of the covariance; ``identity_error`` of the whitened fit list."""
    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float
    residual: float
    passes: int


def whole_numbers(vector: Column, scale: int = 64, shift: int = 1_000_000) -> Column:
    return F.transform(vector, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")) + F.lit(shift).cast("long"))


def _rows(vectors: DataFrame, scale: int, shift: int, id_col: str, vector_col: str) -> DataFrame:
    usable = whole_vector(F.col(vector_col)) & (F.size(vector_col) > 0)
    return vectors.filter(usable).select(F.col(id_col).cast("long").alias("vec_id"),
                                         whole_numbers(F.col(vector_col), scale, shift).alias("x"))


def _pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for lo in range(0, len(batch), BLOCK):
            x = np.stack(batch["x"].iloc[lo:lo + BLOCK].tolist()).astype(np.int64)
            yield pd.DataFrame({"rows": [len(x)], "x": [x.tobytes()]})


def _blocks(batches: Iterator[pd.DataFrame], dim: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for data in batch["x"]:
            yield np.frombuffer(data, np.int64).reshape(-1, dim)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - sums / n, rounded once."""
    if n * (int(np.abs(x).max(initial=0)) + 1) + int(np.abs(sums).max()) < 1 << 63:
        return (n * x - sums) / float(n)
    return ((n * x.astype(object) - sums.astype(object)) / n).astype(np.float64)


def _pass(packed: DataFrame, dim: int, partial: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of ``partial(block)`` over all blocks: added up in each partition, then in groups of
    partitions when there are many, so that the driver adds at most ``DIRECT`` matrices or the root of their number."""
    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for x in _blocks(batches, dim):
            own = partial(x)
            total = own if total is None else total + own
        if total is not None:
            yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "kind": [total.dtype.str],
                                "total": [np.ascontiguousarray(total).tobytes()]})

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        kind = group["kind"].iloc[0]
        total = sum(np.frombuffer(t, kind) for t in group["total"])
        return pd.DataFrame({"part": [0], "kind": [kind], "total": [total.tobytes()]})

    sums = packed.mapInPandas(add, "part int, kind string, total binary")
    parts = packed.rdd.getNumPartitions()
    if parts > DIRECT:
        sums = (sums.groupBy(F.col("part") % max(1, math.isqrt(parts))).applyInPandas(
            merge, "part int, kind string, total binary"))
    found = [np.frombuffer(r["total"], r["kind"]) for r in sums.collect()]
    return sum(found[1:], found[0]) if found else np.zeros(0)


def _ritz(q: np.ndarray, vq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rayleigh-Ritz in the span of the orthonormal ``q``: values from the largest, vectors, V times vectors."""
    h = q.T @ vq
    values, turn = np.linalg.eigh((h + h.T) / 2)
    turn = turn[:, ::-1]
    return values[::-1], q @ turn, vq @ turn


def _filtered(apply: Callable[[np.ndarray], np.ndarray], outside: Callable[[np.ndarray], np.ndarray], q: np.ndarray,
              vq: np.ndarray, top: float, cut: float, degree: int) -> np.ndarray:
    """The Chebyshev polynomial that is small on [0, cut], scaled to 1 at ``top``, of V times ``q``; ``vq`` = V q.

    ``outside`` takes the converged vectors out of every term, so that their rounding noise can't grow.
    """
    half = cut / 2
    first = sigma = half / (top - half)
    before, now = q, outside((vq - half * q) * (sigma / half))
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        before, now = now, outside(2 * (apply(now) - half * now) * (after / half) - sigma * after * before)
        sigma = after
    return now


def _degree(top: float, last: float, cut: float) -> int:
    """Passes of one filter: enough to damp by 1e6 at the last wanted value, at most 24, and few enough that
    the largest value outgrows the last one by no more than 1e10."""
    gain, most = (math.acosh(max(2 * v / cut - 1, 1 + 1e-6)) for v in (last, top))
    spread = math.log(1e10) / (most - gain) if most > gain else math.inf
    return max(2, int(min(24, math.ceil(math.log(1e6) / gain), spread)))


def leading_pairs(apply: Callable[[np.ndarray], np.ndarray], dim: int, wanted: int,
                  seed: int = 7) -> tuple[np.ndarray, np.ndarray, float]:
    """Leading eigenvalues and vectors of the positive semidefinite operator ``apply``, and the largest residual
    relative to the first eigenvalue. Raises if they cannot be certified."""
    random = np.random.default_rng(seed)
    wanted = min(dim, wanted)
    width = min(dim, wanted * (1 + GUARD))
    q = np.linalg.qr(random.standard_normal((dim, width)))[0]
    best = np.inf
    for _ in range(MAX_ROUNDS):
        values, q, vq = _ritz(q, apply(q))
        top = values[0]
        if top <= 0:
            return values[:wanted], q[:, :wanted], 0.0
        errors = np.linalg.norm(vq - q * values, axis=0) / top
        error = errors[:wanted][values[:wanted] > 1e-13 * top].max()
        stalled, best = error > best / 2, min(best, error)
        if width == dim or error < TIGHT or (stalled and error < CERTIFIED):
            fresh = _missed(apply, q, values, wanted, random)
            if fresh is None:
                return values[:wanted], q[:, :wanted], float(error)
            q, best = np.linalg.qr(np.hstack([q[:, :width - fresh.shape[1]], fresh]))[0], np.inf
            continue
        # leading pairs that have converged leave the filter
        done = int(np.argmax(np.append(errors >= TIGHT, True)))
        done = min(done, wanted - 1)
        held = q[:, :done]
        outside = lambda y: y - held @ (held.T @ y)
        cut = max(values[-1], 1e-14 * top)
        if cut >= values[done]:
            q = np.linalg.qr(vq)[0]
            continue
        degree = _degree(values[done], max(values[wanted - 1], cut), cut)
        q = np.linalg.qr(np.hstack([held, _filtered(apply, outside, q[:, done:], vq[:, done:], values[done], cut, degree)]))[0]
    raise ArithmeticError(f"eigenvectors not certified: residual {best:.1e} after {MAX_ROUNDS} rounds")


def _missed(apply, q: np.ndarray, values: np.ndarray, wanted: int, random) -> np.ndarray | None:
    """Vectors outside the block whose Rayleigh quotient exceeds the last wanted value, or None: fresh random
    vectors under the same filter, kept outside the block."""
    dim, width = q.shape
    count = min(dim - width, 8)
    if not count:
        return None
    outside = lambda y: y - q @ (q.T @ y)
    probe = np.linalg.qr(outside(random.standard_normal((dim, count))))[0]
    top, cut = values[0], max(values[-1], 1e-14 * values[0])
    if top > cut:
        probe = np.linalg.qr(outside(_filtered(apply, outside, probe, apply(probe), top, cut, 6)))[0]
    found, probe, _ = _ritz(probe, apply(probe))
    return probe if found[0] > values[wanted - 1] * (1 + 1e-9) else None


def fit_whitening(vectors: DataFrame, components: int = 16, scale: int = 64, shift: int = 1_000_000,
                  id_col: str = "vec_id", vector_col: str = "embedding") -> Whitening | None:
    """Leading components of the covariance of the distinct whole-number vectors; None without vectors.

    Each entry c becomes floor(``scale`` * c) + ``shift``. Vectors that are null, empty or hold null or non-finite
    entries are left out, as are those of another length than the most frequent one (ties: the longer). Repeated
    vectors count once. Components without variance (eigenvalue below 1e-13 of the largest) are left out.
    """
    ship_code(vectors.sparkSession)
    rows = _rows(vectors, scale, shift, id_col, vector_col)
    lengths = rows.groupBy(F.size("x").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("n"), F.desc("dim")).first()
    if common is None:
        return None
    dim = common["dim"]
    fit = rows.filter(F.size("x") == dim).select("x").distinct()
    packed = scratch_table(fit.mapInPandas(_pack, "rows long, x binary"), "whitening")
    n = packed.agg(F.sum("rows")).first()[0]
    # every pass reads all of it: tasks of a fair size, however many files there are
    packed = packed.coalesce(max(-(-n // TASK), min(8, -(-n // BLOCK))))
    sums = _pass(packed, dim, lambda x: x.sum(axis=0))
    passes = 1

    def apply(q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1

        def partial(x: np.ndarray) -> np.ndarray:
            c = centred(x, n, sums)
            return c.T @ (c @ q)
        return _pass(packed, dim, partial).reshape(q.shape) / n

    trace = float(_pass(packed, dim, lambda x: (centred(x, n, sums) ** 2).sum(axis=0)).sum()) / n
    values, axes, residual = leading_pairs(apply, dim, components)
    kept = values > 1e-13 * max(values[0], 0.0)
    if trace <= 0:
        kept[:] = False
    values, axes = values[kept], axes[:, kept]
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(len(values))] if len(values) else 1)
    turn = axes / np.sqrt(values)

    def spread(x: np.ndarray) -> np.ndarray:
        w = centred(x, n, sums) @ turn
        return np.vstack([w.T @ w, w.sum(axis=0)])
    found = _pass(packed, dim, spread).reshape(len(values) + 1, len(values)) / n
    covariance = found[:-1] - np.outer(found[-1], found[-1])
    error = float(np.abs(covariance - np.eye(len(values))).max()) if len(values) else 0.0
    return Whitening(n, sums, axes, values, trace, error, residual, passes + 2)


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """Sum over dimensions of (n x - sums)^2, exact; raises where it exceeds 64 bits."""
    largest = n * (int(np.abs(x).max(initial=0)) + 1) + int(np.abs(sums).max())
    if largest < 1 << 62:
        apart = n * x - sums
        if int(np.abs(apart).max(initial=0)) ** 2 * x.shape[1] < 1 << 63:
            return (apart * apart).sum(axis=1)
    exact = ((n * x.astype(object) - sums.astype(object)) ** 2).sum(axis=1)
    if max(exact, default=0) >= 1 << 63:
        raise OverflowError("a deviation exceeds 64 bits")
    return exact.astype(np.int64)


def whiten(vectors: DataFrame, model: Whitening | None, scale: int = 64, shift: int = 1_000_000,
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: a row per usable vector and component.

    Components are numbered from 1, largest eigenvalue first, each with the sign that makes its largest entry
    positive. Vectors that :func:`fit_whitening` leaves out have no rows; repeated rows and null ids are kept;
    other columns are not read; without a model the result is empty.
    """
    rows = _rows(vectors, scale, shift, id_col, vector_col)
    if model is None or not len(model.eigenvalues):
        return vectors.sparkSession.createDataFrame([], _OUT)
    ship_code(vectors.sparkSession)
    n, sums, count = model.n, model.sums, len(model.eigenvalues)
    turn = model.components / np.sqrt(model.eigenvalues)
    explained = model.eigenvalues / model.trace
    identity_error = model.identity_error

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            x = np.stack(batch["x"].tolist()).astype(np.int64)
            yield pd.DataFrame({
                "vec_id": batch["vec_id"].astype("Int64").repeat(count).to_numpy(),
                "component": np.tile(np.arange(1, count + 1, dtype=np.int32), len(x)), "n": n,
                "deviation": np.repeat(deviations(x, n, sums), count),
                "whitened": (centred(x, n, sums) @ turn).ravel(), "explained": np.tile(explained, len(x)),
                "identity_error": identity_error})

    return rows.filter(F.size("x") == len(sums)).mapInPandas(project, _OUT)


def whitened_vectors(vectors: DataFrame, components: int = 16, **options) -> DataFrame:
    """:func:`whiten` with the model fitted on the same vectors."""
    return whiten(vectors, fit_whitening(vectors, components, **options), **options)
