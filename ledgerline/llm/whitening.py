"""Whitening embeddings by the leading eigenvectors of their covariance (Jacobi-Davidson).

The covariance V of the fixed-point vectors is never formed. Every product V U, U a block
of a few columns of the dimension d, is one distributed pass over the centred rows: each
task adds X_p' (X_p U) over its rows and a group-by over the d x k cells sums the parts.
The driver holds only d x m matrices (m the search space), never rows.

Jacobi-Davidson: Rayleigh-Ritz on the search space gives Ritz pairs (theta, u) and residuals
r = V u - theta u; pairs whose residual is at double precision are locked. For each wanted
pair the correction equation (I - QQ')(V - theta I)(I - QQ') t = -r, Q the locked vectors and
u, is solved by a few MINRES steps, all pairs in lock-step so that each step is one pass. The
corrections, orthogonalised, widen the search space; a full space restarts from the Ritz
vectors.

Fixed-point vectors: x = floor(1024 * c) + 100000 per entry c (as double). Rows whose vector is
null or holds null, NaN or infinite entries take no part. Exact statistics (n, per-dimension sums
S, the deviation sum (n x - S)^2, the trace of V) are integer sums in the JVM.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
TOLERANCE = 1e-13  # residual norm relative to the largest eigenvalue
INNER = 3  # MINRES steps per correction at most
INNER_TOLERANCE = 1e-4
RANK_FLOOR = 1e-10  # eigenvalues at or below this share of the trace are no components
MAX_PASSES = 2_000
LARGEST = 1e12  # entries of this size or more (infinite ones too) cannot give exact long sums; such rows are left out
EXTRA = 8  # corrections for so many Ritz pairs beyond the wanted ones share each pass
BASIS = 4  # the search space restarts above BASIS * k + 4 columns

OUT = "{id} {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"


def fixed_point(embeddings: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, x): the clean rows with their fixed-point vectors; other columns are dropped."""
    bad = F.exists(vec_col, lambda c: c.isNull() | F.isnan(c) | ~(F.abs(c.cast("double")) < F.lit(LARGEST)))
    # The guard inside keeps the expression safe wherever the optimiser evaluates it before the filter.
    x = F.transform(vec_col, lambda c: F.when(F.abs(c.cast("double")) < F.lit(LARGEST), F.floor(F.lit(SCALE) * c.cast("double")) + F.lit(SHIFT)))
    return embeddings.where(F.col(vec_col).isNotNull() & ~bad).select(F.col(id_col).alias("__id"), x.alias("__x"))


def _summed(rows: DataFrame, part, cells: int) -> np.ndarray:
    """Sum of ``part(X)`` (a flat array of ``cells`` numbers) over the centred rows of every task."""

    def partials(batches):
        acc = np.zeros(cells)
        for pdf in batches:
            if len(pdf):
                acc += part(np.stack(pdf["__xc"].to_numpy()))
        yield pd.DataFrame({"cell": np.arange(cells, dtype=np.int32), "v": acc})

    got = rows.select("__xc").mapInPandas(partials, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(cells)
    for r in got:
        out[r.cell] = r.v
    return out


class Product:
    """V U by one pass over the rows; counts the passes."""

    def __init__(self, rows: DataFrame, n: int, d: int):
        self.rows, self.n, self.d, self.passes = rows, n, d, 0

    def __call__(self, U: np.ndarray) -> np.ndarray:
        self.passes += 1
        if self.passes > MAX_PASSES:
            raise RuntimeError(f"Jacobi-Davidson did not converge in {MAX_PASSES} passes")
        k = U.shape[1]
        if k == 0:
            return np.zeros((self.d, 0))
        u = np.ascontiguousarray(U)
        return _summed(self.rows, lambda X: (X.T @ (X @ u)).ravel(), self.d * k).reshape(self.d, k) / self.n


def _orthonormal(T: np.ndarray, *against: np.ndarray, floor: float = 1e-10) -> np.ndarray:
    """Columns of T made orthogonal to the given bases and to each other; tiny ones dropped."""
    kept = []
    for j in range(T.shape[1]):
        t = T[:, j].copy()
        size = np.linalg.norm(t)
        if size == 0:
            continue
        for _ in range(2):
            for B in (*against, *([np.column_stack(kept)] if kept else [])):
                if B.shape[1]:
                    t -= B @ (B.T @ t)
        if np.linalg.norm(t) > floor * size:
            kept.append(t / np.linalg.norm(t))
    return np.column_stack(kept) if kept else np.zeros((T.shape[0], 0))


def minres(apply, B: np.ndarray, steps: int, tolerance: float) -> np.ndarray:
    """Solve A_j x_j = b_j for all columns j at once by MINRES; ``apply`` maps a block to A_j applied per column."""
    d, b = B.shape
    x = np.zeros((d, b))
    beta1 = np.linalg.norm(B, axis=0)
    live = beta1 > 0
    safe = np.where(live, beta1, 1.0)
    v_old, v = np.zeros((d, b)), B / safe
    w_old, w_older = np.zeros((d, b)), np.zeros((d, b))
    beta = np.zeros(b)
    eta = beta1.copy()
    g_old, g, s_old, s = np.ones(b), np.ones(b), np.zeros(b), np.zeros(b)
    for _ in range(steps):
        if not live.any():
            break
        p = apply(v)
        alpha = np.einsum("ij,ij->j", v, p)
        p = p - alpha * v - beta * v_old
        beta_next = np.linalg.norm(p, axis=0)
        delta = g * alpha - g_old * s * beta
        rho1 = np.sqrt(delta**2 + beta_next**2)
        rho2 = s * alpha + g_old * g * beta
        rho3 = s_old * beta
        ok = live & (rho1 > 0)
        r1 = np.where(ok, rho1, 1.0)
        g_next, s_next = np.where(ok, delta / r1, g), np.where(ok, beta_next / r1, 0.0)
        w = np.where(ok, (v - rho3 * w_older - rho2 * w_old) / r1, 0.0)
        x = x + np.where(ok, g_next * eta, 0.0) * w
        eta = np.where(ok, -s_next * eta, eta)
        v_old, v = v, np.where(beta_next > 0, p / np.where(beta_next > 0, beta_next, 1.0), 0.0)
        w_older, w_old = w_old, w
        beta, g_old, g, s_old, s = beta_next, g, g_next, s, s_next
        live = ok & (beta_next > 0) & (np.abs(eta) > tolerance * safe)
    return x


def leading(product, d: int, k: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenpairs of the symmetric operator behind ``product`` (d x d), falling."""
    rng = np.random.default_rng(seed)
    locked, values = np.zeros((d, 0)), []
    most = min(d, BASIS * k + 4)
    V = _orthonormal(rng.standard_normal((d, min(d, k + 2))))
    AV = product(V)
    while True:
        H = V.T @ AV
        theta, S = np.linalg.eigh((H + H.T) / 2)
        order = np.argsort(-theta, kind="stable")
        theta, S = theta[order], S[:, order]
        U, AU = V @ S, AV @ S
        R = AU - U * theta
        norms = np.linalg.norm(R, axis=0)
        top = max([abs(t) for t in theta[:1]] + [abs(e) for e in values] + [0.0])
        tol = TOLERANCE * top
        j = 0
        while j < len(theta) and len(values) < k and (norms[j] <= tol or top == 0):
            locked = np.column_stack([locked, U[:, j]])
            values.append(theta[j])
            j += 1
        if len(values) >= k or locked.shape[1] >= d:
            break
        V, AV, theta, R = U[:, j:], AU[:, j:], theta[j:], R[:, j:]
        want = min(k - len(values) + EXTRA, V.shape[1])
        if V.shape[1] == 0:
            T = rng.standard_normal((d, k - len(values)))
        else:
            if V.shape[1] + want > most:
                keep = max(want + 2, most // 2)
                V, AV, theta, R = V[:, :keep], AV[:, :keep], theta[:keep], R[:, :keep]
            T = _corrections(product, locked, V[:, :want], theta[:want], R[:, :want])
        T = _orthonormal(T, locked, V)
        if T.shape[1] == 0:
            T = _orthonormal(rng.standard_normal((d, max(1, want))), locked, V)
        if T.shape[1] == 0:
            break
        V, AV = np.column_stack([V, T]), np.column_stack([AV, product(T)])
    return np.array(values), locked


def _corrections(product, locked: np.ndarray, U: np.ndarray, theta: np.ndarray, R: np.ndarray) -> np.ndarray:
    """Approximate solutions t_j of (I - Q_j Q_j')(V - theta_j)(I - Q_j Q_j') t = -r_j, Q_j = [locked, u_j]."""

    def project(T):
        T = T - locked @ (locked.T @ T)
        return T - U * np.einsum("ij,ij->j", U, T)

    def apply(T):
        P = project(T)
        return project(product(P) - theta * P)

    return project(minres(apply, -project(R), INNER, INNER_TOLERANCE))


def whiten(embeddings: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Project each clean row on the leading eigenvectors of the covariance, scaled to unit variance.

    Returns ``id_col``, component (1 = largest eigenvalue), n (rows in the fit), deviation
    (sum over dimensions of (n x - S)^2, exact), whitened, explained (eigenvalue / trace) and
    identity_error (largest absolute entry of the whitened values' covariance minus the identity,
    the same in every row). Defined cases: rows with null, NaN or infinite entries (or entries of LARGEST or more) or a null vector
    are left out; a null id is kept as null; repeated rows count as often as they occur; an empty
    fit, zero-length vectors or a zero covariance give no rows; components whose eigenvalue is at or
    below RANK_FLOOR of the trace are not returned (rank below ``components``). Vectors of unlike
    lengths raise ValueError. Other columns of the input, whatever their names, are not carried.
    Signs: each component's largest entry (first on ties) is positive.
    """
    spark = embeddings.sparkSession
    id_type = embeddings.schema[id_col].dataType.simpleString()
    schema = OUT.format(id=id_col, id_type=id_type)
    clean = fixed_point(embeddings, id_col, vec_col)
    shape = clean.agg(F.count(F.lit(1)).alias("n"), F.min(F.size("__x")).alias("lo"), F.max(F.size("__x")).alias("hi")).first()
    n = shape.n
    if n == 0 or shape.hi == 0:
        return spark.createDataFrame([], schema)
    if shape.lo != shape.hi:
        raise ValueError(f"vectors of lengths {shape.lo} to {shape.hi}; whitening needs one dimension")
    d = shape.hi
    sums = (clean.select(F.posexplode("__x").alias("pos", "v"))
            .groupBy("pos").agg(F.sum("v").alias("s"), F.sum(F.col("v").cast("decimal(38,0)") * F.col("v")).alias("q"))
            .collect())
    S, Q = [0] * d, [0] * d
    for r in sums:
        S[r.pos], Q[r.pos] = int(r.s), int(r.q)
    trace = sum(Fraction(n * q - s * s, n * n) for s, q in zip(S, Q))
    if trace == 0:
        return spark.createDataFrame([], schema)
    mean = F.array(*[F.lit(float(Fraction(s, n))) for s in S])
    S_col = F.array(*[F.lit(s).cast("long") for s in S])
    rows = clean.select(
        "__id", "__x", F.zip_with("__x", mean, lambda a, m: a.cast("double") - m).alias("__xc")
    ).persist()
    try:
        k = min(components, d)
        values, vectors = leading(Product(rows, n, d), d, k)
        keep = values > RANK_FLOOR * float(trace)
        values, vectors = values[keep], vectors[:, keep]
        if len(values) == 0:
            return spark.createDataFrame([], schema)
        big = np.argmax(np.abs(vectors), axis=0)
        vectors = vectors * np.sign(vectors[big, np.arange(vectors.shape[1])])
        W = vectors / np.sqrt(values)
        k = W.shape[1]
        moments = _summed(rows, lambda X: np.concatenate([((X @ W).T @ (X @ W)).ravel(), (X @ W).sum(axis=0)]), k * k + k)
        G, s = moments[: k * k].reshape(k, k) / n, moments[k * k:] / n
        identity_error = float(np.max(np.abs(G - np.outer(s, s) - np.eye(k))))
        explained = [float(v / float(trace)) for v in values]

        def project(batches):
            for pdf in batches:
                X = np.stack(pdf["__xc"].to_numpy()) if len(pdf) else np.zeros((0, d))
                m = len(pdf)
                yield pd.DataFrame({
                    id_col: np.repeat(pdf["__id"].to_numpy(), k),
                    "component": np.tile(np.arange(1, k + 1, dtype=np.int32), m),
                    "n": np.full(m * k, n, dtype=np.int64),
                    "deviation": np.repeat(pdf["__dev"].to_numpy(), k),
                    "whitened": (X @ W).ravel(),
                    "explained": np.tile(np.array(explained), m),
                    "identity_error": np.full(m * k, identity_error),
                })

        zero = F.lit(0).cast("decimal(38,0)")
        deviation = F.aggregate(
            F.zip_with("__x", S_col, lambda a, s: (F.lit(n) * a - s).cast("decimal(38,0)")),
            zero, lambda acc, v: (acc + v * v).cast("decimal(38,0)")).cast("long")
        # The result reads the persisted rows when the caller asks for it; a lost block is recomputed from the scan.
        return rows.select("__id", "__xc", deviation.alias("__dev")).mapInPandas(project, schema)
    except BaseException:
        rows.unpersist()
        raise
