"""Embedding whitening by QDWH spectral divide-and-conquer.

Vectors are quantised to whole numbers, so that equal vectors are equal exactly
and sums are exact.  Spark makes the list of distinct vectors, its sums and its
centred second moments (one partial matrix per task, added up by matrix entry);
the driver holds one matrix of the dimension squared and splits it: the polar
factor of the covariance shifted by ``s`` (QR-based, dynamically weighted Halley
iteration) gives the projector on the eigenvectors above ``s``; the covariance is
restricted to both invariant subspaces and these are split again, until every
block is diagonal.  The components, scaled by their deviations, are then sent to
all tasks (dimension x components numbers) and applied to every row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stored

SCALE = 64              # steps per unit of a quantised entry
OFFSET = 1_000_000
COMPONENTS = 16
LEAST_SHARE = 1e-11     # components below this share of the largest have no direction of their own


# --- the spectral method, on one matrix of the dimension squared -----------------

def polar(a: np.ndarray, most: int = 40) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by QDWH.

    The lower bound of the singular values starts at the rounding unit, which is
    safe for every matrix that is not singular to double precision; the weights
    bring it to one within some six steps.  Steps with large weights use QR,
    later ones a Cholesky factor.
    """
    n = len(a)
    norm = np.linalg.norm(a)
    if norm == 0:
        return np.eye(n)
    x, low, eye = a / norm, np.finfo(float).eps, np.eye(n)
    for _ in range(most):
        square = min(1.0, low * low)
        root = np.cbrt(4 * (1 - square) / square ** 2)
        q = np.sqrt(1 + root)
        wa = q + 0.5 * np.sqrt(max(0.0, 8 - 4 * root + 8 * (2 - square) / (square * q)))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        before = x
        if wc > 100:
            upper_lower = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))[0]
            x = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * upper_lower[:n] @ upper_lower[n:].T
        else:
            factor = np.linalg.cholesky(eye + wc * x.T @ x)
            half = np.linalg.solve(factor, x.T)
            x = wb / wc * x + (wa - wb / wc) * np.linalg.solve(factor.T, half).T
        x = (x + x.T) / 2
        low = min(1.0, low * (wa + wb * square) / (1 + wc * square))
        if abs(1 - low) < 1e-15 and np.linalg.norm(x - before) < 1e-13 * np.sqrt(n):
            break
    return x


def _split(a: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below a shift, or
    None if no shift tells two parts of the spectrum apart."""
    n = len(a)
    mean, spread = np.trace(a) / n, np.linalg.norm(a - np.trace(a) / n * np.eye(n)) / np.sqrt(n)
    for shift in (np.median(np.diag(a)), mean, mean + spread / 7, mean - spread / 7, mean + spread / 2, mean - spread / 2):
        projector = (np.eye(n) + polar(a - shift * np.eye(n))) / 2
        rank = int(round(np.trace(projector)))
        if not 0 < rank < n or np.linalg.norm(projector @ projector - projector) > 1e-8:
            continue
        basis = np.linalg.qr(projector @ rng.normal(size=(n, rank)))[0]
        whole = np.linalg.qr(projector @ basis, mode="complete")[0]
        above, below = whole[:, :rank], whole[:, rank:]
        if np.linalg.norm(below.T @ a @ above) <= 1e-9 * max(np.linalg.norm(a), 1e-300):
            return above, below
    return None


def spectrum(matrix: np.ndarray, seed: int = 13) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a symmetric matrix.

    A block is done when its off-diagonal part is at the rounding of the whole
    matrix: equal eigenvalues end there with any basis of their space.  The
    entry of largest size in each vector is positive.
    """
    whole = (matrix + matrix.T) / 2
    rng, tolerance = np.random.default_rng(seed), 4 * np.finfo(float).eps * np.linalg.norm(whole)
    waiting, done = [np.eye(len(whole))], []
    while waiting:
        basis = waiting.pop()
        block = basis.T @ whole @ basis
        block = (block + block.T) / 2
        off = np.linalg.norm(block - np.diag(np.diag(block)))
        halves = None if len(block) == 1 or off <= tolerance else _split(block, rng)
        if halves is None:
            done.append(basis)
        else:
            waiting += [basis @ half for half in halves]
    vectors = np.hstack(done) if done else np.zeros((0, 0))
    # one first-order step against what the splits left between the blocks
    rest = vectors.T @ whole @ vectors
    values = np.diag(rest).copy()
    gap = values[None, :] - values[:, None]
    small = np.abs(gap) <= 1e3 * max(tolerance, 1e-300)
    vectors = np.linalg.qr(vectors + vectors @ np.where(small, 0.0, rest / np.where(small, 1.0, gap)))[0]
    values = np.einsum("ij,ij->j", vectors, whole @ vectors)
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], vectors[:, order]
    if len(values):
        largest = vectors[np.argmax(np.abs(vectors), axis=0), np.arange(len(values))]
        vectors = vectors * np.where(largest < 0, -1.0, 1.0)
    return values, vectors


# --- the tables --------------------------------------------------------------------

def quantised(vector: Column) -> Column:
    """``floor(64 c) + 1000000`` of every entry; NULL for a vector that is NULL or
    holds a NULL, an infinite or a not-a-number entry."""
    entries = F.transform(vector, lambda c: c.cast("double"))
    sound = ~F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.when(vector.isNotNull() & sound,
                  F.transform(entries, lambda c: F.floor(c * F.lit(SCALE)).cast("long") + F.lit(OFFSET)))


def _matrix(batch: pa.RecordBatch, column: str = "x") -> np.ndarray:
    col = batch.column(column)
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)


def _sums(fit_list: DataFrame) -> tuple[int, np.ndarray]:
    """Number of vectors and exact sums per dimension; one partial row per task."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            if len(batch):
                part = _matrix(batch)
                n, total = n + len(part), part.sum(axis=0) + (0 if total is None else total)
        if n:
            yield pa.record_batch({"n": [n], "s": [total.tolist()]}, pa.schema(
                [("n", pa.int64()), ("s", pa.list_(pa.int64()))]))

    parts = fit_list.select("x").mapInArrow(partial, "n long, s array<long>")
    rows = (parts.select("n", F.posexplode("s").alias("i", "s")).groupBy("i")
            .agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("i").collect())
    return (int(rows[0].n) if rows else 0), np.array([int(r.s) for r in rows], dtype=np.int64)


def _moments(fit_list: DataFrame, n: int, size: int, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Mean of ``y y'`` over the vectors' images ``y = of(x)``: one partial matrix
    per task, its upper half added up by entry.  The driver gets size^2 / 2 sums."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            if len(batch):
                y = of(_matrix(batch))
                total += y.T @ y
        i, j = np.triu_indices(size)
        yield pa.record_batch({"i": i.astype(np.int32), "j": j.astype(np.int32), "v": total[i, j]})

    got = (fit_list.select("x").mapInArrow(partial, "i int, j int, v double")
           .groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow())
    i, j, v = (got[c].to_numpy() for c in ("i", "j", "v"))
    out = np.zeros((size, size))
    out[i, j] = out[j, i] = v / max(1, n)
    return out


@dataclass
class Whitening:
    """Components (rows) and eigenvalues of the distinct vectors of one dimension."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - sums / n``; the numerator is exact."""
        return (self.n * x - self.sums) / self.n

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components.T / np.sqrt(self.eigenvalues)


def fit(fit_list: DataFrame, components: int = COMPONENTS) -> Whitening:
    """``fit_list(x)``, distinct vectors of one length -> :class:`Whitening`.

    Components whose eigenvalue is at most ``LEAST_SHARE`` of the largest (fewer
    distinct vectors than dimensions, constant entries) are left out: their
    deviation is nought, nothing can be divided by it.
    """
    n, sums = _sums(fit_list)
    shape = Whitening(n, sums, np.zeros((0, len(sums))), np.zeros(0), 0.0)
    if n < 2:
        return shape
    covariance = _moments(fit_list, n, len(sums), shape.centred)
    values, vectors = spectrum(covariance)
    keep = min(components, int((values > LEAST_SHARE * values[0]).sum())) if values[0] > 0 else 0
    out = Whitening(n, sums, vectors[:, :keep].T.copy(), values[:keep], float(np.trace(covariance)))
    if keep:
        seen = _moments(fit_list, n, keep, out.whiten)
        out.identity_error = float(np.abs(seen - np.eye(keep)).max())
    return out


def apply(rows: DataFrame, model: Whitening) -> DataFrame:
    """``rows(..., x)`` with ``deviation`` (sum of (n x - sums)^2, exact; NULL if
    it passes the range of a long) and ``whitened`` (one entry per component)."""
    kept = [c for c in rows.columns if c != "x"]
    schema = ", ".join([*[f"`{c}` {t}" for c, t in rows.dtypes if c != "x"], "deviation long", "whitened array<double>"])

    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x = _matrix(batch)
            apart = model.n * x - model.sums
            fits = np.square(apart.astype(float)).sum(axis=1) < 9.2e18
            deviation = np.square(np.where(fits[:, None], apart, 0)).sum(axis=1)
            y = model.whiten(x)
            cuts = np.arange(len(x) + 1, dtype=np.int32) * y.shape[1]
            yield pa.record_batch({**{c: batch.column(c) for c in kept},
                                   "deviation": pa.array(deviation, mask=~fits),
                                   "whitened": pa.ListArray.from_arrays(cuts, y.ravel())})

    return rows.mapInArrow(whiten, schema)


def whitened_components(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding",
                        components: int = COMPONENTS) -> DataFrame:
    """``vectors`` -> a row per remaining vector and component: the id,
    ``component`` (from 1, by falling eigenvalue), ``n``, ``deviation``,
    ``whitened``, ``explained``, ``identity_error``.

    Vectors that are NULL or hold NULL or non-finite entries go; other columns
    are not read.  Repeated rows come back as often as they come, while the fit
    counts each distinct vector once.  Vectors of another length are another
    space: each length is fitted on its own distinct vectors (one fit per
    length).  Empty vectors, a single distinct vector and an empty table have no
    components, so no rows; NULL ids are ids like any other.
    """
    rows = stored(vectors.select(F.col(id_column), quantised(F.col(column)).alias("x")).where("size(x) > 0"), "quantised")
    # equal vectors meet in the map tasks first, so a hot one is shuffled once per task
    distinct = stored(rows.select("x").distinct(), "fit-list")
    lengths = sorted(r.k for r in distinct.select(F.size("x").alias("k")).distinct().collect())
    out = None
    for k in lengths:
        model = fit(distinct.where(F.size("x") == k) if len(lengths) > 1 else distinct, components)
        if not len(model.eigenvalues):
            continue
        explained = F.array(*[F.lit(float(e / model.trace)) for e in model.eigenvalues])
        each = (apply(rows.where(F.size("x") == k) if len(lengths) > 1 else rows, model)
                .select(F.col(id_column), "deviation", F.posexplode("whitened").alias("at", "whitened")))
        part = each.select(
            id_column, (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
            "whitened", F.get(explained, F.col("at")).alias("explained"),
            F.lit(model.identity_error).alias("identity_error"))
        out = part if out is None else out.unionByName(part)
    if out is None:
        return rows.select(id_column, F.lit(0).alias("component"), F.lit(0).cast("long").alias("n"),
                           F.lit(0).cast("long").alias("deviation"), F.lit(0.0).alias("whitened"),
                           F.lit(0.0).alias("explained"), F.lit(0.0).alias("identity_error")).where(F.lit(False))
    return out
