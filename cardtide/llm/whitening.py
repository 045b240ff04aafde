"""Whitening of vectors on their leading components, found by Jacobi-Davidson.

The covariance is never formed. Each product ``V w`` is one Spark job over the distinct vectors: every
slab is centred, multiplied by the vectors sought (a few at a time) and multiplied back; partial sums
are added up in Spark, and only components x vectors numbers reach the driver. There a subspace is
kept: Rayleigh-Ritz gives the best approximations in it, their residuals are measured, and each
approximation that has not converged yields one more direction, the solution of the correction
equation ``(I - Q Q') (V - theta I) (I - Q Q') t = -r`` by a few MINRES steps, taken in step for all
approximations so that each costs one job. Components whose residual reaches double precision are
locked and leave the subspace. If they do not within MAX_TURNS, an error tells so.

Vectors are whole numbers ``floor(scale * c)``. The fit list holds each distinct vector once. Rows that
are null or hold null or non-finite entries are left out; repeated rows and null ids are rows like any
other; shorter vectors go on with zeros. Components without variance (eigenvalue at most
``dims * 2^-52`` of the largest) cannot be scaled and are left out, so an empty table, a single
distinct vector or vectors without entries give no rows. Equal eigenvalues leave a choice of
components; all rows get the same one. A deviation beyond 64 bits is null. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import stage
from .vectors import Slab, longest, matrix, packed, whole_vectors

#: Steps of the inner solver, and how far it reduces a residual before it stops.
INNER_STEPS, INNER_FALL = 12, 1e-3
#: Largest subspace, its size after a restart, and directions sought beyond those wanted.
SPACE, RESTART, GUARD = 32, 12, 2
MAX_TURNS = 100

Product = Callable[[np.ndarray], np.ndarray]


class Spectrum(NamedTuple):
    """``n`` distinct vectors with sums ``S`` (whole numbers), ``trace`` of the covariance, its leading
    ``values`` and unit ``vectors`` (one per column), and the whitened covariance's largest error."""
    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    identity_error: float


def _added(slabs: DataFrame, function: Callable[[Slab], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """Sum over all slabs of ``function``'s matrix: added up per task, a row of it a row of the table,
    then in Spark."""
    names = [f"v{i}" for i in range(shape[1])]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            for row in batch.itertuples():
                part = function(Slab(row, by_column=False)).reshape(shape)
                total = part if total is None else total + part
        if total is not None:
            yield pd.DataFrame(total, columns=names).assign(slot=np.arange(shape[0], dtype=np.int32))[["slot", *names]]
    parts = slabs.mapInPandas(run, "slot int, " + ", ".join(f"{n} double" for n in names))
    rows = parts.groupBy("slot").agg(*[F.sum(n).alias(n) for n in names]).toPandas()
    out = np.zeros(shape)
    out[rows["slot"]] = rows[names]
    return out


def exact_sums(slabs: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Number of vectors and the sum of every component, as whole numbers of any length."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                x = Slab(row, by_column=False).x
                largest = max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0))))
                sums = x.sum(0, dtype=np.int64) if largest * len(x) < 1 << 62 else x.astype(object).sum(0)
                yield pd.DataFrame({"slot": np.arange(dims + 1, dtype=np.int32), "value": [*map(str, sums.tolist()), str(len(x))]})
    rows = slabs.mapInPandas(run, "slot int, value string").groupBy("slot").agg(
        F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    found = {r.slot: int(r.value) for r in rows}
    return found.get(dims, 0), [found.get(i, 0) for i in range(dims)]


def _orthonormal(new: np.ndarray, *spaces: np.ndarray) -> np.ndarray:
    """``new`` made orthogonal to the spaces and to itself; directions that vanish are left out."""
    kept: list[np.ndarray] = []
    for t in new.T:
        length = np.linalg.norm(t)
        if not length > 0 or not np.isfinite(length):
            continue
        t = t / length
        for _ in range(3):
            for space in (*spaces, np.array(kept).T if kept else np.zeros((len(t), 0))):
                t = t - space @ (space.T @ t)
            length = np.linalg.norm(t)
            if length < 1e-10:
                break
            t = t / length
        else:
            kept.append(t)
    return np.array(kept).T if kept else np.zeros((new.shape[0], 0))


def corrections(product: Product, theta: np.ndarray, residuals: np.ndarray, fixed: np.ndarray) -> np.ndarray:
    """Approximate solutions of the correction equations, one per column, by MINRES.

    All columns take their steps together; ``fixed`` spans what the solutions stay orthogonal to.
    """
    inside = lambda t: t - fixed @ (fixed.T @ t)
    r = -inside(residuals)
    beta = np.linalg.norm(r, axis=0)
    first = np.where(beta > 0, beta, 1.0)
    x = np.zeros_like(r)
    v, before = r / first, np.zeros_like(r)
    w, w_before = np.zeros_like(r), np.zeros_like(r)
    c, c_before, s, s_before = np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    eta, last, running = beta.copy(), np.zeros_like(beta), beta > 0
    for _ in range(INNER_STEPS):
        image = inside(product(v) - theta * v)
        alpha = (v * image).sum(0)
        following = inside(image - alpha * v - last * before)
        after = np.linalg.norm(following, axis=0)
        # Givens rotations of the last two steps, then the one that removes ``after``.
        diagonal = c * alpha - c_before * s * last
        length = np.hypot(diagonal, after)
        one, two = s * alpha + c_before * c * last, s_before * last
        safe = np.where(length > 0, length, 1.0)
        c_next, s_next = diagonal / safe, after / safe
        w_next = (v - two * w_before - one * w) / safe
        x = np.where(running & (length > 0), x + c_next * eta * w_next, x)
        eta = -s_next * eta
        running &= (after > 1e-14 * first) & (np.abs(eta) > INNER_FALL * beta)
        if not running.any():
            break
        before, v, last = v, following / np.where(after > 0, after, 1.0), after
        w_before, w, c_before, c, s_before, s = w, w_next, c, c_next, s, s_next
    return x


def leading(product: Product, dims: int, wanted: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues and unit eigenvectors of a symmetric operator given by its
    product with columns; ``scale`` is a bound of its size, such as the trace."""
    wanted = min(wanted, dims)
    locked, values = np.zeros((dims, 0)), []
    space = _orthonormal(np.random.default_rng(0).standard_normal((dims, min(dims, wanted + GUARD))))
    image = product(space)
    best, stuck = np.inf, 0
    for _ in range(MAX_TURNS):
        t = space.T @ image
        theta, y = np.linalg.eigh((t + t.T) / 2)
        y = y[:, ::-1]
        theta, space, image = theta[::-1], space @ y, image @ y
        if space.shape[1] > SPACE:  # a fresh image drops what rounding has gathered
            theta, space = theta[:RESTART], _orthonormal(space[:, :RESTART], locked)
            image = product(space)
            t = space.T @ image
            theta, y = np.linalg.eigh((t + t.T) / 2)
            theta, space, image = theta[::-1], space @ y[:, ::-1], image @ y[:, ::-1]
        left = min(wanted - len(values), space.shape[1])
        r = image[:, :left] - theta[:left] * space[:, :left]
        r -= locked @ (locked.T @ r)
        sizes = np.linalg.norm(r, axis=0)
        limit = 2.0 ** -52 * dims * max([*values, theta[0], scale / dims])
        # What stays within a few units of rounding and no longer falls is as exact as products are.
        stuck = stuck + 1 if sizes[0] <= 16 * limit and sizes[0] > best / 2 else 0
        best = min(best, sizes[0])
        done = 0
        while done < left and (sizes[done] <= limit or done == 0 and stuck >= 3):
            done += 1
        if done:
            locked, values = np.hstack([locked, space[:, :done]]), [*values, *theta[:done].tolist()]
            space, image, best, stuck = space[:, done:], image[:, done:], np.inf, 0
            if len(values) == wanted:
                break
            if not space.shape[1]:
                space = _orthonormal(np.random.default_rng(len(values)).standard_normal((dims, 1)), locked)
                image = product(space)
            continue
        fixed = np.hstack([locked, space[:, :left]])
        fresh = _orthonormal(corrections(product, theta[:left], r, fixed), locked, space)
        if not fresh.shape[1]:  # residuals lie in the subspace to rounding
            fresh = _orthonormal(np.random.default_rng(7).standard_normal((dims, 1)), locked, space)
        if fresh.shape[1]:
            space, image = np.hstack([space, fresh]), np.hstack([image, product(fresh)])
    else:
        raise ArithmeticError(f"{len(values)} of {wanted} components converged within {MAX_TURNS} turns")
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], locked[:, order]


def fit(vectors: DataFrame, wanted: int = 4) -> Spectrum:
    """Leading components of ``vec_id, x`` as given by ``whole_vectors``."""
    dims = longest(vectors)
    distinct = vectors.select("x").dropDuplicates(["x"]).select(F.lit(None).cast("long").alias("vec_id"), "x")
    slabs = stage(packed(distinct, dims, by_column=False), "fit-list")
    n, sums = exact_sums(slabs, dims)
    if not n or not dims:
        return Spectrum(n, sums, 0.0, np.zeros(0), np.zeros((dims, 0)), 0.0)
    mean = np.array([s / n for s in sums])
    centred = lambda slab: slab.x.astype(np.float64) - mean
    trace = float(_added(slabs, lambda slab: np.square(centred(slab)).sum(), (1, 1))[0, 0]) / n

    def product(w: np.ndarray) -> np.ndarray:
        def of_slab(slab: Slab) -> np.ndarray:
            x = centred(slab)
            return x.T @ (x @ w)
        return _added(slabs, of_slab, w.shape) / n
    values, found = leading(product, dims, wanted, trace) if trace > 0 else (np.zeros(0), np.zeros((dims, 0)))
    some = values > 2.0 ** -52 * dims * values.max(initial=0.0)
    values, found = values[some], found[:, some]
    p = len(values)
    if not p:
        return Spectrum(n, sums, trace, values, found, 0.0)

    def moments(slab: Slab) -> np.ndarray:
        z = centred(slab) @ found / np.sqrt(values)
        return np.vstack([z.sum(0), z.T @ z])
    added = _added(slabs, moments, (1 + p, p)) / n
    covariance = added[1:] - np.outer(added[0], added[0])
    return Spectrum(n, sums, trace, values, found, float(np.abs(covariance - np.eye(p)).max(initial=0.0)))


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """``sum (n * x - S)^2`` over the components of each row; None beyond 64 bits."""
    largest = n * max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))) + max(map(abs, sums), default=0)
    if largest ** 2 * max(len(sums), 1) < 1 << 63:
        return np.square(n * x - np.array(sums, dtype=np.int64)).sum(1).tolist()
    exact = ((x.astype(object) * n - np.array(sums, dtype=object)) ** 2).sum(1)
    return [int(e) if e < 1 << 63 else None for e in exact]


def project(vectors: DataFrame, spectrum: Spectrum) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every row and
    component."""
    shared = vectors.sparkSession.sparkContext.broadcast(spectrum)
    schema = "id long, no_id boolean, component int, deviation long, whitened double"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        s = shared.value
        p, scaled = len(s.values), s.vectors / np.sqrt(s.values)
        mean = np.array([total / s.n for total in s.sums]) if s.n else np.zeros(0)
        for batch in batches:
            if not p or not len(batch):
                continue
            x = matrix(batch["x"], len(s.sums))
            whitened = (x.astype(np.float64) - mean) @ scaled
            yield pd.DataFrame({
                "id": np.repeat(batch["id"].to_numpy(), p), "no_id": np.repeat(batch["no_id"].to_numpy(), p),
                "component": np.tile(np.arange(1, p + 1, dtype=np.int32), len(x)),
                "deviation": pd.array(np.repeat(np.array(deviations(x, s.n, s.sums), dtype=object), p), dtype="Int64"),
                "whitened": whitened.ravel()})
    rows = vectors.select(F.coalesce("vec_id", F.lit(0)).alias("id"), F.col("vec_id").isNull().alias("no_id"), "x").mapInPandas(run, schema)
    shares = [float(v / spectrum.trace) for v in spectrum.values]
    explained = F.element_at(F.array(*map(F.lit, shares)), F.col("component")) if shares else F.lit(None).cast("double")
    return rows.select(
        F.when(~F.col("no_id"), F.col("id")).alias("vec_id"), "component", F.lit(spectrum.n).cast("long").alias("n"), "deviation",
        "whitened", explained.alias("explained"), F.lit(spectrum.identity_error).alias("identity_error"))


def whiten(df: DataFrame, wanted: int = 4, scale: int = 256) -> DataFrame:
    """Whitened components of every row of ``vec_id, embedding``."""
    vectors = whole_vectors(df, scale)
    return project(vectors, fit(vectors, wanted))
