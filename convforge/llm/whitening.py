"""Principal-component whitening by QDWH spectral divide and conquer.

The covariance comes from one distributed pass over the distinct vectors; it is
a matrix of the vectors' dimension, whatever the number of rows.  Its components
are found by splitting: the polar factor U of the shifted matrix, by dynamically
weighted Halley iterations, gives the projector (I + U) / 2 onto the invariant
subspace above the shift.  Bases of both subspaces split the matrix in two, and
each part is split again until it is one component.  The components are broadcast
and every vector is projected where it lies.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convforge.llm.common import bounded_batches, written
from convforge.llm.vectors import matrix, per_dimension, scaled, usable

EPS = np.finfo(np.float64).eps


# --- the solver -----------------------------------------------------------
def polar(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix by QDWH iterations.

    ``low`` bounds the least singular value of the iterate from below; the weights
    that it sets take any condition number to convergence in a few steps.
    """
    n = len(a)
    eye = np.eye(n)
    x = a / (np.sqrt(np.linalg.norm(a, 1) * np.linalg.norm(a, np.inf)) or 1.0)
    try:
        low = 1.0 / (np.sqrt(n) * np.linalg.norm(np.linalg.inv(x), 1))
    except np.linalg.LinAlgError:
        low = 0.0
    low = min(1.0, max(low, EPS / 4))
    for _ in range(30):
        square = low * low
        d = (4 * (1 - square) / square ** 2) ** (1 / 3)
        root = np.sqrt(1 + d)
        wa = root + 0.5 * np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - square) / (square * root)))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        before = x
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
            x = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        else:
            x = wb / wc * x + (wa - wb / wc) * np.linalg.solve(eye + wc * (x.T @ x), x.T).T
        x = (x + x.T) / 2
        low = min(1.0, low * (wa + wb * square) / (1 + wc * square))
        if 1 - low < 10 * EPS and np.linalg.norm(x - before) <= (5 * EPS) ** (1 / 3):
            return x
    raise ArithmeticError("the polar iteration has not converged")


def _basis(p: np.ndarray, k: int, against: np.ndarray | None = None) -> np.ndarray:
    """Orthonormal basis of the k-dimensional range of the projector p."""
    q = np.random.default_rng(len(p)).standard_normal((len(p), k))
    for _ in range(3):
        q = p @ q
        if against is not None:
            q = q - against @ (against.T @ q)
        q, _ = np.linalg.qr(q)
    return q


def _split(a: np.ndarray, size: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the invariant subspaces above and below a shift; None if all
    eigenvalues are equal to working precision of a matrix of norm ``size``."""
    n = len(a)
    middle = np.trace(a) / n
    spread = np.linalg.norm(a - middle * np.eye(n)) / np.sqrt(n)
    if spread <= 4 * EPS * size:
        return None
    # The mean lies between the extreme eigenvalues; should one be too close to
    # it, a shift beside it is as good.
    for step in (0, 0.31, -0.31, 0.13, -0.13, 0.53, -0.53, 0.05, -0.05, 0.01, -0.01):
        try:
            u = polar(a - (middle + step * spread) * np.eye(n))
        except ArithmeticError:
            continue
        p = (np.eye(n) + u) / 2
        k = int(round(np.trace(p)))
        if not 0 < k < n or np.linalg.norm(p @ p - p) > 1e-10 * n:
            continue
        above = _basis(p, k)
        below = _basis(np.eye(n) - p, n - k, above)
        if np.linalg.norm(above.T @ a @ below) <= 1e-13 * n * size:
            return above, below
    if spread <= 1e-13 * n * size:
        return None
    raise ArithmeticError("no shift splits the matrix")


def components(a: np.ndarray, want: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of a symmetric matrix, at
    least the ``want`` largest; the subspaces of smaller ones are not split."""
    n = len(a)
    want = n if want is None else min(want, n)
    size = np.linalg.norm(a)
    values, vectors = [], []
    todo = [np.eye(n)]  # bases, the one of the largest eigenvalues last
    while todo and len(values) < want:
        basis = todo.pop()
        part = basis.T @ a @ basis
        part = (part + part.T) / 2
        split = _split(part, size) if len(part) > 1 else None
        if split is None:
            for k in range(basis.shape[1]):
                values.append(float(basis[:, k] @ a @ basis[:, k]))
                vectors.append(basis[:, k])
        else:
            above, below = (np.linalg.qr(basis @ s)[0] for s in split)
            todo += [below, above]
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], np.array(vectors).reshape(len(values), n)[order].T


# --- the model ------------------------------------------------------------
@dataclass
class Whitening:
    """``sums`` and ``n`` of the distinct vectors; eigenvalues ``values`` and
    ``vectors`` (columns) of the components, and the covariance's ``trace``."""
    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None = None

    @property
    def scaled(self) -> np.ndarray:
        """Columns that whiten; NaN for a component without variance."""
        none = self.values <= len(self.sums) * EPS * self.trace
        return self.vectors / np.sqrt(np.where(none, np.nan, self.values))

    def project(self, x: np.ndarray) -> np.ndarray:
        return (x - self.sums / max(self.n, 1)) @ self.scaled


def _covariance(distinct: DataFrame, n: int, sums: np.ndarray) -> np.ndarray:
    """Covariance (divisor n).  Vectors are centred at the mean's nearest integers, so
    that the sums of products are integers, exact in any order; what the rounding
    moved the centre by is at most a half per dimension and its product is taken off."""
    dims = len(sums)
    centre = np.array([int((2 * s + n) // (2 * n)) for s in sums.tolist()], dtype=np.int64)

    def products(batches):
        total = np.zeros((dims, dims), dtype=np.int64)
        for b in batches:
            x = matrix(b.column(0), dims) - centre
            most = int(np.abs(x).max(initial=0))
            if len(x) * most * most < 1 << 53:
                f = x.astype(np.float64)
                total += (f.T @ f).astype(np.int64)
            else:
                total += x.T @ x
        i, j = np.divmod(np.arange(dims * dims), dims)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.ravel())],
                                         names=["i", "j", "v"])

    out = np.zeros((dims, dims))
    rows = (bounded_batches(distinct).mapInArrow(products, "i int, j int, v bigint").groupBy("i", "j")
            .agg(F.sum("v").alias("v")).collect())  # the square of the dimension
    for r in rows:
        out[r["i"], r["j"]] = r["v"] / n
    rest = np.array([(s - n * c) / n for s, c in zip(sums.tolist(), centre.tolist())])
    return out - np.outer(rest, rest)


def fit(vectors: DataFrame, want: int = 4) -> Whitening:
    """The model of the distinct vectors ``x`` (arrays of integers; shorter ones end in zeros)."""
    # Equal vectors are combined before the shuffle, however many there are.
    distinct = written(vectors.select("x").distinct(), "whitening-distinct")
    n = distinct.count()
    stats = per_dimension(distinct, "x", F.sum("c").alias("s"))
    sums = np.array([r["s"] for r in stats], dtype=np.int64)
    if not len(sums):
        return Whitening(n, sums, np.zeros(0), np.zeros((0, 0)), 0.0)
    a = _covariance(distinct, n, sums)
    a = (a + a.T) / 2
    values, columns = components(a, want)
    model = Whitening(n, sums, values[:want], columns[:, :want], float(np.trace(a)))
    real = [k for k in range(len(model.values)) if np.isfinite(model.scaled[:, k]).all()]
    pairs = [(i, j) for i in real for j in real if i <= j]
    if pairs:
        w = whiten(distinct, model, x_col="x", keep=())
        row = w.agg(*[F.covar_pop(F.col("whitened")[i], F.col("whitened")[j]).alias(f"c{i}_{j}") for i, j in pairs]).head()
        model.identity_error = max(abs(v - (i == j)) for v, (i, j) in zip(row, pairs))
    return model


def whiten(vectors: DataFrame, model: Whitening, x_col: str = "x", keep: tuple[str, ...] = ("vec_id",)) -> DataFrame:
    """``keep``, ``whitened`` (array of one number per component, null where it has no
    variance) and ``deviation``: the sum over dimensions of (n * x - sum) ** 2, exact
    (null beyond 64 bits)."""
    kept = [f"_keep_{i}" for i in range(len(keep))]
    src = bounded_batches(vectors).select(F.col(x_col).alias("_x"), *[F.col(c).alias(k) for c, k in zip(keep, kept)])
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        dims = len(m.sums)
        for b in batches:
            x = matrix(b.column(0), dims)
            w = m.project(x)
            most = max(int(np.abs(x).max(initial=0)) * m.n, int(np.abs(m.sums).max(initial=0)))
            if dims * (2 * most) ** 2 < 1 << 63:
                far = ((m.n * x - m.sums) ** 2).sum(axis=1).tolist()
            else:
                sums = m.sums.tolist()
                far = [sum((m.n * c - s) ** 2 for c, s in zip(row, sums)) for row in x.tolist()]
                far = [v if v < 1 << 63 else None for v in far]
            flat = pa.array(w.ravel(), pa.float64(), mask=np.isnan(w.ravel()))
            ends = pa.array(np.arange(len(x) + 1) * w.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.ListArray.from_arrays(ends, flat), pa.array(far, pa.int64())],
                                             names=[*b.schema.names[1:], "whitened", "deviation"])

    fields = [f"{k} {src.schema[k].dataType.simpleString()}" for k in kept]
    return (src.mapInArrow(run, ", ".join([*fields, "whitened array<double>", "deviation bigint"]))
               .select(*[F.col(k).alias(c) for c, k in zip(keep, kept)], "whitened", "deviation"))


def whiten_embeddings(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                      scale: int = 256, want: int = 4) -> DataFrame:
    """Whitened components of every row, fitted on the distinct integer vectors
    floor(scale * component).

    Returns per row and component (from 1, by falling eigenvalue): the id,
    ``component``, ``n``, ``deviation``, ``whitened``, ``explained`` (eigenvalue over
    trace) and ``identity_error`` (largest absolute entry of the whitened distinct
    vectors' covariance minus the identity).  Rows without a vector of finite
    components are dropped; repeated rows count once in the fit and are all
    returned.  A component without variance has null ``whitened``; where none has
    any, ``explained`` and ``identity_error`` are null.  No rows give no rows.
    """
    src = embeddings.where(usable(vector_col)).select(F.col(id_col).alias("_id"), scaled(vector_col, scale).alias("x"))
    src = written(src, "whitening-vectors")
    model = fit(src, want)
    rows = whiten(src, model, keep=("_id",))
    share = [float(v / model.trace) if model.trace > 0 else None for v in model.values]
    parts = F.posexplode("whitened").alias("_k", "whitened")
    explained = F.array(*[F.lit(s).cast("double") for s in share]) if share else F.array().cast("array<double>")
    return rows.select("_id", "deviation", parts).select(
        F.col("_id").alias(id_col), (F.col("_k") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("_k")).alias("explained"),
        F.lit(model.identity_error).cast("double").alias("identity_error"))
