"""Whitening of embeddings on the leading components of their covariance.

Entries become whole numbers, so that counts, sums and deviations are exact. Two passes over
the rows give the sums and the covariance, added up per partition; the covariance, whose size
depends on the dimension only, is split on the driver by spectral divide and conquer: the
polar factor of the shifted covariance (QDWH, Nakatsukasa, Bai and Gygi 2010) is the sign of
its eigenvalues, so it gives the projector on those above the shift. Both invariant subspaces
are split again until a component is left. The projection goes to all tasks, which whiten
the rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from slotwise.llm.common import partition_number, summed, written

COMPONENTS = 8
# Scale and offset of the whole numbers that entries become.
SCALE, OFFSET = 1024.0, 100_000
# Entries are held within this, far beyond which a double has no neighbouring whole numbers.
WIDEST = 1 << 62
EPS = np.finfo(np.float64).eps
SEED = 7


# ---- spectral divide and conquer


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by dynamically weighted Halley steps.

    For a matrix without eigenvalue zero it is the matrix of the signs of the eigenvalues.
    """
    n = len(a)
    eye = np.eye(n)
    x = a / np.linalg.norm(a)
    try:
        least = 1 / (np.linalg.norm(np.linalg.inv(x), 1) * np.sqrt(n))
    except np.linalg.LinAlgError:
        least = 0.0
    least = min(1.0, max(least if np.isfinite(least) else 0.0, EPS))
    for _ in range(60):
        l2 = least * least
        d = np.cbrt(4 * (1 - l2) / (l2 * l2))
        root = np.sqrt(1 + d)
        wa = root + np.sqrt(8 - 4 * d + 8 * (2 - l2) / (l2 * root)) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        before = x
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
            x = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        else:
            x = wb / wc * x + (wa - wb / wc) * np.linalg.solve(eye + wc * (x.T @ x), x.T).T
        x = (x + x.T) / 2
        least = min(1.0, least * (wa + wb * l2) / (1 + wc * l2))
        if least > 1 - 1e-8 and np.linalg.norm(x - before) <= 1e-10 * np.sqrt(n):
            break
    return x


def _split(a: np.ndarray, size: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of two invariant subspaces of ``a``, the larger eigenvalues first.

    The mean of the eigenvalues lies strictly between the least and the largest one. Should
    it meet an eigenvalue, its sign is unknown, and the shift moves a little.
    """
    n = len(a)
    diagonal = np.diag(a)
    mean, spread = diagonal.mean(), np.linalg.norm(a - diagonal.mean() * np.eye(n)) / np.sqrt(n)
    draw = np.random.Generator(np.random.PCG64(SEED))
    best = None
    for shift in [mean, *(mean + f * spread for f in (0.03, -0.03, 0.11, -0.11, 0.23, -0.23, 0.41, -0.41))]:
        sign = polar(a - shift * np.eye(n))
        projector = (sign + np.eye(n)) / 2
        k = int(round(np.trace(projector)))
        if not 0 < k < n:
            continue
        basis, _ = np.linalg.qr(projector @ draw.standard_normal((n, k)))
        basis, _ = np.linalg.qr(projector @ basis)
        whole, _ = np.linalg.qr(basis, mode="complete")
        upper, lower = whole[:, :k], whole[:, k:]
        off = np.linalg.norm(lower.T @ a @ upper)
        if best is None or off < best[0]:
            best = off, upper, lower
        if off <= 16 * n * EPS * size:
            break
    return None if best is None else best[1:]


def leading(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors as columns) of the ``k`` largest eigenvalues of the symmetric
    matrix ``a``, falling. Parts that hold none of them are not split any further."""

    def divide(part: np.ndarray, k: int) -> list[np.ndarray]:
        n = len(part)
        rest = part - np.diag(np.diag(part))
        if n == 1 or np.linalg.norm(rest) <= 4 * EPS * size:
            order = np.argsort(-np.diag(part), kind="stable")[:k]
            return list(np.eye(n)[:, order].T)
        bases = _split(part, size)
        if bases is None:  # equal eigenvalues but for rounding
            order = np.argsort(-np.diag(part), kind="stable")[:k]
            return list(np.eye(n)[:, order].T)
        found = []
        for basis in bases:
            if len(found) < k:
                inner = basis.T @ part @ basis
                found += [basis @ v for v in divide((inner + inner.T) / 2, k - len(found))]
        return found

    size = np.linalg.norm(a)
    vectors = np.column_stack(divide((a + a.T) / 2, min(k, len(a))))
    values = np.einsum("ij,ik,kj->j", vectors, a, vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


# ---- the rows


@dataclass
class Whitening:
    """n and per-dimension sums of the whole-number vectors, and the leading components of
    their covariance with eigenvalues; ``trace`` is the sum of all eigenvalues."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def alive(self) -> np.ndarray:
        """Which components have any variance, beyond rounding."""
        return self.values > len(self.sums) * EPS * self.trace

    def projection(self) -> np.ndarray:
        return self.vectors / np.sqrt(np.where(self.alive, self.values, np.inf))


def _usable(embedding: Column) -> Column:
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & (F.size(embedding) > 0), F.lit(False))


def _kept(vectors: DataFrame) -> DataFrame:
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.filter(_usable(F.col("embedding")))


def _whole(batch: pa.RecordBatch) -> np.ndarray:
    """The vectors of a batch as whole numbers."""
    flat = batch.column("embedding").flatten().to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore"):
        cells = np.floor(flat.astype(np.float64) * SCALE)
    return np.clip(cells, -float(WIDEST), float(WIDEST - 2 * OFFSET)).astype(np.int64).reshape(batch.num_rows, -1) + OFFSET


def _bound(x: np.ndarray) -> int:
    return max(abs(int(x.min())), abs(int(x.max())))


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exact: in 64 bits where they surely suffice."""
    if n * _bound(x) < WIDEST and max(map(abs, sums)) < WIDEST:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening fitted to all usable vectors of the commonest length (of equally common ones
    the longest); None without any. To the driver go one row a dimension and the covariance."""
    rows = _kept(vectors)
    lengths = rows.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if lengths is None:
        return None
    size, n = int(lengths["size"]), int(lengths["count"])
    rows = rows.filter(F.size("embedding") == size)

    def partial_sums(batches):
        total = [0] * size
        for batch in batches:
            if batch.num_rows:
                x = _whole(batch)
                x = x if _bound(x) * len(x) < WIDEST else x.astype(object)
                total = [a + int(b) for a, b in zip(total, x.sum(axis=0))]
        columns = [pa.array(range(size), pa.int32()), pa.array([str(t) for t in total])]
        yield pa.RecordBatch.from_arrays(columns, names=["dim", "part"])

    parts = rows.select("embedding").mapInArrow(partial_sums, "dim int, part string")
    found = parts.groupBy("dim").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect()
    sums = [int(r.total) for r in sorted(found, key=lambda r: r.dim)]

    def partial_products(batches):
        total = np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                z = _deviations(_whole(batch), n, sums).astype(np.float64) / n
                total += z.T @ z
        yield pa.RecordBatch.from_pydict({"part": pa.array([partition_number()], pa.int64()), "value": pa.array([total.tobytes()], pa.binary())})

    products = rows.select("embedding").mapInArrow(partial_products, "part long, value binary")
    covariance = summed(products).reshape(size, size) / n
    values, vectors_ = leading(covariance, components)
    return Whitening(n, sums, values, vectors_, float(np.trace(covariance)))


def whitened(vectors: DataFrame, model: Whitening) -> DataFrame:
    """Rows (vec_id, deviation, whitened) of the vectors that ``model`` is fitted to: the exact sum
    of (n x - S)^2 (null beyond 38 digits) and the components of x - S/n over their deviation;
    a component without variance is null."""
    n, sums, projection, alive = model.n, model.sums, model.projection(), model.alive

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            far = _deviations(_whole(batch), n, sums)
            z = far.astype(np.float64) / n
            if far.dtype != object and _bound(far) ** 2 * len(sums) < 1 << 63:
                exact = pa.array((far * far).sum(axis=1)).cast(pa.decimal128(38, 0))
            else:
                totals = [int(t) for t in (far.astype(object) ** 2).sum(axis=1)]
                exact = pa.array([t if t < 10**38 else None for t in totals], pa.decimal128(38, 0))
            out = z @ projection
            off = np.tile(~alive, len(out))
            flat = pa.array(out.ravel(), mask=off) if off.any() else pa.array(out.ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1, dtype=np.int32) * out.shape[1]), flat)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), exact, lists], names=["vec_id", "deviation", "whitened"])

    rows = _kept(vectors).filter(F.size("embedding") == len(sums))
    return rows.mapInArrow(run, "vec_id long, deviation decimal(38,0), whitened array<double>")


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened ``rows`` minus the identity, over
    the components with variance; 0 without any."""
    alive = [k for k in range(len(model.values)) if model.alive[k]]
    if not alive:
        return 0.0
    column = [F.col("whitened")[k] for k in alive]
    means = rows.agg(*[F.avg(c) for c in column]).first()
    centred = [c - F.lit(m) for c, m in zip(column, means)]
    entries = [(i, j) for i in range(len(alive)) for j in range(i, len(alive))]
    got = rows.agg(*[F.avg(centred[i] * centred[j]).alias(f"c{i}_{j}") for i, j in entries]).first()
    return max(abs(v - (i == j)) for (i, j), v in zip(entries, got))


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: vec_id, component (from 1, by falling eigenvalue),
    n, deviation (decimal), whitened, explained, identity_error.

    Dropped are vectors that are null or empty, hold null or non-finite entries, or are not of
    the commonest length. Repeated rows count and are returned as often as they occur, a null
    vec_id stays null. There are no more components than dimensions. Where a component has no
    variance, as for a single vector or equal ones, whitened is null, and it is left out of
    identity_error; explained is 0 if there is no variance at all. Entries beyond 2^62 / 1024
    are held there. No usable vector gives no rows. Other columns are ignored.
    """
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    model = fit(vectors, components)
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    rows = written(whitened(vectors, model), "whitened")
    error = identity_error(rows, model)
    shares = [float(v / model.trace) if model.trace else 0.0 for v in model.values]
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.array(*map(F.lit, shares))[F.col("at")].alias("explained"), F.lit(error).alias("identity_error"),
    )
