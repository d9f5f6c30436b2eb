"""Embedding whitening by a bidiagonal qd solver.

* Every vector becomes whole numbers, ``x = floor(64 c) + 1000000``; counts and
  sums are exact, and rows are centred as ``(n x - S) / n`` before any product.
* Blockwise QR: each task reduces its centred rows to one upper triangle R
  (d x d); triangles are stacked and reduced again in a tree of groups of
  ``TREE`` until one is left. Its size depends on the dimension only.
* Householder reflections from both sides make R upper bidiagonal, R = U B W'.
* dqds (differential quotient-difference with shifts) finds the singular
  values of B, each to high relative accuracy.
* For each of them the twisted factorisation of B'B - s^2 I gives the vector:
  stationary and progressive transforms meet at the index with the least
  pivot. Vectors of close values are made orthogonal against each other.
* Directions are the vectors taken back through W. The whitened rows'
  covariance is then measured on the rows themselves (block means and centred
  products, merged in the same tree).

Dropped are rows whose vector is null, empty, holds null or non-finite
entries, or whose length is not the most frequent one (of equally frequent
ones, the longest). Entries beyond 2^40/64 in size count as that. Components
whose singular value is below ``LEAST`` of the largest are left out: equal
vectors, a lone vector and constant dimensions give no direction, and an empty
table gives an empty result. ``deviation`` is null where it exceeds a long.
Repeated rows are rows of their own, a null id stays null, other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.operators.sinks import checkpoint

COMPONENTS = 32
TREE = 8
LEAST = 1e-10
SCALE, SHIFT, LIMIT = 64, 1_000_000, 2.0 ** 40
EPS = float(np.finfo(float).eps)


# --- rows
def _valid(vectors: DataFrame) -> DataFrame:
    c = F.col("embedding").cast("array<double>")
    fine = F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return vectors.select(F.col("vec_id"), c.alias("c")).where(c.isNotNull() & (F.size("c") > 0) & fine)


def _whole(batch: pa.RecordBatch, d: int) -> np.ndarray:
    """The batch's vectors as whole numbers, rows x d."""
    c = batch.column(batch.schema.get_field_index("c")).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
    return np.floor(np.clip(SCALE * c, -LIMIT, LIMIT)).astype(np.int64) + SHIFT


def _tree(parts: DataFrame, schema: str, merge: Callable[[pd.DataFrame], pd.DataFrame], name: str):
    """Merges rows (part, ...) in groups of TREE until one is left: that row, or None."""
    parts = checkpoint(parts, name)
    n = parts.agg(F.max("part")).first()[0]
    if n is None:
        return None
    while n > 0:
        parts = parts.groupBy(F.expr(f"cast(part div {TREE} as int)").alias("part")).applyInPandas(merge, schema)
        n //= TREE
    return parts.first()


# --- the bidiagonal problem, d x d
def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal a, superdiagonal b and W with R = U B W'."""
    m = np.array(r, float)
    d = len(m)
    w = np.eye(d)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        size = np.linalg.norm(x)
        if size == 0 or not np.any(x[1:]):
            return None
        v = x.copy()
        v[0] += np.copysign(size, x[0])
        return v / np.linalg.norm(v)

    for k in range(d):
        if (v := reflector(m[k:, k])) is not None:
            m[k:, k:] -= 2 * np.outer(v, v @ m[k:, k:])
        if k < d - 2 and (v := reflector(m[k, k + 1:])) is not None:
            m[k:, k + 1:] -= 2 * np.outer(m[k:, k + 1:] @ v, v)
            w[:, k + 1:] -= 2 * np.outer(w[:, k + 1:] @ v, v)
    return np.diag(m).copy(), np.diag(m, 1).copy(), w


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The squared singular values of the bidiagonal (a, b), falling."""
    scale = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    if scale == 0:
        return np.zeros(len(a))
    tiny = 1e-290
    found: list[float] = []
    blocks = [([max((x / scale) ** 2, tiny) for x in a.tolist()], [(x / scale) ** 2 for x in b.tolist()], 0.0)]

    def transform(q: list[float], e: list[float], s: float) -> tuple[list[float], list[float]] | None:
        d, q2, e2 = q[0] - s, [], []
        for i in range(len(e)):
            if d < 0:
                return None
            top = max(d + e[i], tiny)
            t = q[i + 1] / top
            q2.append(top)
            e2.append(e[i] * t)
            d = d * t - s
        if d < 0:
            return None
        return [*q2, d], e2

    while blocks:
        q, e, s = blocks.pop()
        while q:
            n = len(q)
            if n == 1 or e[-1] <= EPS * EPS * (s + q[-1]) or e[-1] <= tiny:
                found.append(s + q.pop())
                if e:
                    e.pop()
                continue
            cut = next((i for i in range(n - 2, -1, -1) if e[i] <= EPS * EPS * (s + min(q[i], q[i + 1]))), None)
            if cut is not None:  # the block falls in two
                blocks.append((q[:cut + 1], e[:cut], s))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            # the smaller eigenvalue of the last 2 x 2, an upper bound of the least one
            low, high = q[-2] + (e[-2] if n > 2 else 0.0), q[-1] + e[-1]
            off = q[-2] * e[-1]
            half = (low + high) / 2
            guess = max((low * high - off) / (half + ((half - high) ** 2 + off) ** 0.5), 0.0)
            for share in (1 - 1e-12, 1 - 1e-6, 0.99, 0.75, 0.3, 0.05, 0.0):
                if (step := transform(q, e, guess * share)) is not None:
                    q, e, s = *step, s + guess * share
                    break
    return np.array(sorted(found, reverse=True)) * scale * scale


def _twisted(dd: np.ndarray, ll: np.ndarray, lam: float) -> tuple[np.ndarray, float]:
    """The vector of LDL' - lam I at its least pivot, and that pivot over the vector's square."""
    n, tiny = len(dd), 1e-290
    lp, dp, s = np.zeros(n), np.zeros(n), np.zeros(n)
    um, p = np.zeros(n), np.zeros(n)
    s[0] = -lam
    for i in range(n):
        dp[i] = s[i] + dd[i]
        if i + 1 < n:
            dp[i] = dp[i] if abs(dp[i]) > tiny else tiny
            lp[i] = dd[i] * ll[i] / dp[i]
            s[i + 1] = lp[i] * ll[i] * s[i] - lam
    p[-1] = dd[-1] - lam
    for i in range(n - 2, -1, -1):
        r = dd[i] * ll[i] * ll[i] + p[i + 1]
        r = r if abs(r) > tiny else tiny
        t = dd[i] / r
        um[i] = ll[i] * t
        p[i] = p[i + 1] * t - lam
    gamma = s + p + lam
    k = int(np.argmin(np.abs(gamma)))
    z = np.zeros(n)
    z[k] = 1
    for i in range(k - 1, -1, -1):
        z[i] = -lp[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -um[i] * z[i]
    size = float(z @ z)
    return z / size ** 0.5, float(gamma[k]) / size


def _solved(dd: np.ndarray, ll: np.ndarray, lam: float, y: np.ndarray, floor: float) -> np.ndarray:
    """One step of inverse iteration with the stationary factors L+ D+ L+'."""
    y, n, s = y.copy(), len(dd), -lam
    lp, dp = np.zeros(n), np.zeros(n)
    for i in range(n):
        dp[i] = s + dd[i]
        dp[i] = dp[i] if abs(dp[i]) > floor else floor
        lp[i] = dd[i] * ll[i] / dp[i]
        s = lp[i] * ll[i] * s - lam
    for i in range(1, n):
        y[i] -= lp[i - 1] * y[i - 1]
    y /= dp
    for i in range(n - 2, -1, -1):
        y[i] -= lp[i] * y[i + 1]
    return y


def _apart(z: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, float]:
    """z made orthogonal to the columns of ``others`` and of length 1, and its length before that."""
    for _ in range(2):
        z = z - others @ (others.T @ z)
    size = float(np.linalg.norm(z))
    return z / max(size, 1e-300), size


def _vectors(a: np.ndarray, b: np.ndarray, lam: np.ndarray) -> np.ndarray:
    """The right vectors of an unreduced bidiagonal for its squared singular values ``lam`` (falling)."""
    rng, out = np.random.default_rng(0), np.zeros((len(a), len(lam)))
    floor = EPS * 1e-3 * max(lam[0] ** 0.5, np.abs(a).max())
    a = np.where(np.abs(a) < floor, np.copysign(floor, a), a)
    dd, ll = a * a, np.append(b / a[:-1], 0.0)
    for i, x in enumerate(lam):
        with np.errstate(all="ignore"):
            z, left = _twisted(dd, ll, x)
            better, left2 = _twisted(dd, ll, x + left)
        if abs(left2) < abs(left):
            z = better
        close = out[:, :i][:, np.abs(lam[:i] - x) < 1e-3 * lam[0]]
        z, size = _apart(z, close) if np.isfinite(z).all() else (z, 0.0)
        if not size >= 0.5:  # nearly equal values: inverse iteration from outside the found ones
            z, _ = _apart(rng.standard_normal(len(a)), close)
            for _ in range(3):
                with np.errstate(all="ignore"):
                    y = _solved(dd, ll, x, z, EPS * lam[0])
                    y = y / np.abs(y).max()
                if not np.isfinite(y).all():
                    break
                z, _ = _apart(y, close)
        out[:, i] = z
    return out


def directions(r: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values (falling, ``most`` at most) of the triangle ``r`` and their right vectors (columns)."""
    a, b, w = bidiagonalise(r)
    least = EPS * max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    ends = [*(np.flatnonzero(np.abs(b) <= least) + 1).tolist(), len(a)]  # the matrix falls into blocks at nothing beside the diagonal
    found = []
    for at, end in zip([0, *ends], ends):
        found += [(x, at, end, i) for i, x in enumerate(dqds(a[at:end], b[at:end - 1]))]
    found = sorted(found, key=lambda f: (-f[0], f[1], f[3]))[:most]
    found = [f for f in found if f[0] > LEAST ** 2 * found[0][0]]
    lam, z = np.array([f[0] for f in found]), np.zeros((len(a), len(found)))
    for at, end in {f[1:3] for f in found}:
        own = [j for j, f in enumerate(found) if f[1] == at]
        z[at:end, own] = _vectors(a[at:end], b[at:end - 1], lam[own])
    return lam, w @ z


# --- the operator
@dataclass
class Model:
    n: int
    sums: np.ndarray  # d longs
    variances: np.ndarray  # of the components, falling
    vectors: np.ndarray  # d x components
    trace: float
    identity_error: float | None = None


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return (n * x - sums) / float(n)


def _stack(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf, d = pdf.sort_values("part"), int(pdf["d"].iloc[0])
    r = np.linalg.qr(np.vstack([np.asarray(v, float).reshape(-1, d) for v in pdf["r"]]), mode="r")
    return pd.DataFrame({"part": [int(pdf["part"].iloc[0]) // TREE], "d": [d], "r": [r.ravel()]})


def _pool(pdf: pd.DataFrame) -> pd.DataFrame:
    """Merges counts, means and centred products."""
    n, mean, prod = 0, 0.0, 0.0
    for r in pdf.sort_values("part").itertuples():
        m, k = np.asarray(r.mean, float), len(r.mean)
        delta, both = m - mean, n + r.n
        prod = prod + np.asarray(r.prod, float).reshape(k, k) + np.outer(delta, delta) * (n * r.n / both)
        mean, n = mean + delta * (r.n / both), both
    return pd.DataFrame({"part": [int(pdf["part"].iloc[0]) // TREE], "n": [n], "mean": [mean], "prod": [prod.ravel()]})


def fit(vectors: DataFrame, most: int = COMPONENTS) -> tuple[DataFrame, Model | None]:
    """The rows that remain (vec_id, c) and the model fitted on all of them."""
    rows = _valid(vectors)
    common = rows.groupBy(F.size("c").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if common is None:
        return rows, None
    d, n = int(common["d"]), int(common["count"])
    rows = rows.where(F.size("c") == d)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = np.zeros(d, np.int64)
        for b in batches:
            s += _whole(b, d).sum(axis=0)
        yield pa.RecordBatch.from_pydict({"s": pa.array([s.tolist()], pa.list_(pa.int64()))})
    sums = rows.mapInArrow(total, "s array<bigint>").select(F.posexplode("s")).groupBy("pos").agg(F.sum("col").alias("s")).orderBy("pos").collect()
    sums = np.array([r["s"] for r in sums], np.int64)

    def triangle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        r = np.zeros((0, d))
        for b in batches:
            if b.num_rows:
                r = np.linalg.qr(np.vstack([r, _centred(_whole(b, d), n, sums)]), mode="r")
        if len(r):
            yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId()], pa.int32()), "d": pa.array([d], pa.int32()),
                                              "r": pa.array([r.ravel().tolist()], pa.list_(pa.float64()))})
    schema = "part int, d int, r array<double>"
    r = np.array(_tree(rows.mapInArrow(triangle, schema), schema, _stack, "whitening-r")["r"], float).reshape(-1, d)
    r = np.vstack([r, np.zeros((d - len(r), d))]) if len(r) < d else r
    squares, found = directions(r, most)
    model = Model(n, sums, squares / n, found, float((r * r).sum()) / n)
    if not len(squares):
        return rows, model

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, done = TaskContext.get().partitionId(), []
        for b in batches:
            if b.num_rows:
                w = whiten(_whole(b, d), model)
                mean = w.mean(axis=0)
                done.append({"part": 0, "n": len(w), "mean": mean, "prod": ((w - mean).T @ (w - mean)).ravel()})
                done = _pool(pd.DataFrame(done)).to_dict("records")
        for x in done:
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "n": pa.array([x["n"]], pa.int64()),
                                              "mean": pa.array([list(x["mean"])], pa.list_(pa.float64())), "prod": pa.array([list(x["prod"])], pa.list_(pa.float64()))})
    schema = "part int, n bigint, mean array<double>, prod array<double>"
    k = len(squares)
    prod = np.array(_tree(rows.mapInArrow(moments, schema), schema, _pool, "whitening-moments")["prod"], float).reshape(k, k)
    model.identity_error = float(np.abs(prod / n - np.eye(k)).max())
    return rows, model


def whiten(x: np.ndarray, model: Model) -> np.ndarray:
    return _centred(x, model.n, model.sums) @ model.vectors / np.sqrt(model.variances)


SCHEMA = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def transform(rows: DataFrame, model: Model | None) -> DataFrame:
    """One row for each row and component, the columns of ``SCHEMA``."""
    if model is None or not len(model.variances):
        return rows.sparkSession.createDataFrame([], SCHEMA)
    d, k = model.vectors.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                b = batch.slice(at, 2048)
                x = _whole(b, d)
                apart = model.n * x - model.sums
                over = (apart.astype(float) ** 2).sum(axis=1) >= 2.0 ** 63 * (1 - 1e-9)
                exact = np.where(over[:, None], 0, apart)
                deviation = (exact * exact).sum(axis=1)
                for i in np.flatnonzero(over):  # near the limit the sum of whole numbers decides
                    own = sum(int(v) ** 2 for v in apart[i])
                    deviation[i], over[i] = (own, False) if own < 1 << 63 else (0, True)
                yield pa.RecordBatch.from_pydict({
                    "vec_id": b.column(0).take(pa.array(np.repeat(np.arange(len(x)), k))),
                    "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    "n": pa.array(np.full(len(x) * k, model.n, np.int64)),
                    "deviation": pa.array(np.repeat(deviation, k), mask=np.repeat(over, k)),
                    "whitened": pa.array(whiten(x, model).ravel()),
                    "explained": pa.array(np.tile(model.variances / model.trace, len(x))),
                    "identity_error": pa.array(np.full(len(x) * k, model.identity_error))})
    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), "c").mapInArrow(run, SCHEMA)
