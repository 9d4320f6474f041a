"""Operator 13: embedding whitening by the Jacobi-Davidson method.

The leading eigenvectors of the covariance of all vectors are found without the covariance itself: all that is asked
of the data is its product with a few columns, ``V T = 1/n sum c (c' T)`` with c the centred vector, which
one Spark pass adds up from partial sums a partition. The driver holds a basis of at most MAX_BASIS columns. In every round

* Rayleigh-Ritz in the subspace gives Ritz pairs and residuals; pairs whose residual has reached double precision are locked;
* for each open pair, the correction equation ``(I - U U')(V - theta I)(I - U U') t = -r`` (U: locked and current Ritz
  vectors) is solved by a few steps of MINRES; the open pairs share each pass over the data;
* the corrections, made orthogonal, widen the subspace (a full one is first cut back to its best Ritz vectors).

It ends when the wanted largest values are all locked. A few guard pairs are carried along, so that a
wanted pair is not missed and close eigenvalues converge.

An entry c becomes the long x = floor(1024 c) + 100000. Sums are exact; x - S/n is taken as (x - q) - r/n with S = q n + r,
so centring loses nothing. Drivers and tasks hold MAX_BASIS columns at most of the vectors' length.

Defined results: vectors that are null, empty or hold null, non-finite or unfit entries (|c| >= 2^40) are dropped, and so are vectors
whose length is not the most frequent one (of two, the longer). Repeated ids and rows count each time, null ids too.
Components of eigenvalue zero (below 2^-40 of the largest) can't be whitened and are left out, so equal vectors, one
vector or none give no rows. A deviation beyond the long range is null. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.llm.text import take_columns

COMPONENTS = 8
GUARDS = 4
MAX_BASIS = 160
INNER_STEPS = 4
MAX_ROUNDS = 200
SCALE, OFFSET = 1024, 100_000
ROWS = 1024  # vectors of one matrix product
UNFIT = 2.0**40
LONG = np.iinfo(np.int64).max


def _rows(embeddings: DataFrame) -> DataFrame:
    kind = dict(embeddings.dtypes).get("embedding", "")
    kind = kind if kind in ("array<float>", "array<double>") else "array<double>"
    return take_columns(embeddings, {"vec_id": "bigint", "embedding": kind})


def quantise(column: pa.ListArray, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(which rows take part, their x-vectors as longs)."""
    fits = pc.fill_null(pc.equal(pc.list_value_length(column), dim), False).to_numpy(zero_copy_only=False).copy()
    values = column.filter(pa.array(fits)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dim)
    good = (np.abs(values) < UNFIT).all(1)  # false for null (NaN) and infinite entries
    fits[np.flatnonzero(fits)[~good]] = False
    return fits, np.floor(values[good] * SCALE).astype(np.int64) + OFFSET


@dataclass(frozen=True)
class Centre:
    """Count and sums of the x-vectors, and from them exact deviations."""

    n: int
    sums: np.ndarray

    def apart(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        q, r = self.sums // self.n, self.sums % self.n
        return x - q, r

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n."""
        whole, r = self.apart(x)
        return whole - r / self.n

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2, exactly."""
        whole, r = self.apart(x)
        most = (int(np.abs(whole).max(initial=0)) + 1) * self.n
        if most * most * max(1, x.shape[1]) <= LONG:
            d = whole * self.n - r
            return (d * d).sum(1).tolist()
        r = r.tolist()
        exact = (sum((w * self.n - s) ** 2 for w, s in zip(row, r)) for row in whole.tolist())
        return [d if d <= LONG else None for d in exact]


def fit_list(embeddings: DataFrame) -> tuple[int, Centre]:
    """(length, count and sums) of the vectors that take part; (0, none) if there are none."""
    rows = _rows(embeddings).select("embedding")
    unfit = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= UNFIT))
    dims = rows.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & ~unfit).groupBy(F.size("embedding").alias("dim"))
    first = dims.agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    if first is None:
        return 0, Centre(0, np.zeros(0, np.int64))
    dim = first["dim"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = 0, np.zeros(dim, np.int64)
        for batch in batches:
            _, x = quantise(batch.column(0), dim)
            n, s = n + len(x), s + x.sum(0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(dim)), pa.array(s), pa.array(np.full(dim, n))], names=["i", "s", "n"]
        )

    got = rows.mapInArrow(run, "i long, s long, n long").groupBy("i").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    got = got.orderBy("i").toPandas()  # one row a dimension
    return dim, Centre(int(got["n"].iloc[0]), got["s"].to_numpy(np.int64))


def summed(embeddings: DataFrame, dim: int, work: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """The sum of the matrices that ``work`` makes of blocks of x-vectors: partial sums a partition, then sums a row."""
    names = [f"y{j}" for j in range(shape[1])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            _, x = quantise(batch.column(0), dim)
            for a in range(0, len(x), ROWS):
                total += work(x[a : a + ROWS])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(shape[0])), *map(pa.array, total.T)], names=["i", *names])

    parts = _rows(embeddings).select("embedding").mapInArrow(run, ", ".join(["i long", *(f"{y} double" for y in names)]))
    got = parts.groupBy("i").agg(*(F.sum(y).alias(y) for y in names)).toPandas()  # ``shape`` numbers
    return got.sort_values("i")[names].to_numpy()


def _orthonormal(t: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Orthonormal columns for what ``t`` adds to ``basis``; columns that add nothing are left out."""
    out = basis
    for column in t.T:
        size = np.linalg.norm(column)
        if not size > 0:
            continue
        column = column / size
        for _ in range(3):
            column = column - out @ (out.T @ column)
            left = np.linalg.norm(column)
            if left < 1e-10:
                break
            column = column / left
        else:
            out = np.column_stack([out, column])
    return out[:, basis.shape[1] :]


def minres(product, shifts: np.ndarray, u: np.ndarray, residuals: np.ndarray, steps: int, rtol: float) -> np.ndarray:
    """Columns t, orthogonal to ``u``, that lessen ``|(I - uu')(V - shift)(I - uu') t + residual|`` by MINRES; one
    product a step serves all columns."""
    project = lambda m: m - u @ (u.T @ m)
    b = -project(residuals)
    beta = np.linalg.norm(b, axis=0)
    start, safe = beta.copy(), np.where(beta > 0, beta, 1.0)
    x, old, now = np.zeros_like(b), np.zeros_like(b), b / safe
    w_old, w_now = np.zeros_like(b), np.zeros_like(b)
    eta, c_old, c, s_old, s = beta.copy(), np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    last = np.zeros_like(beta)
    open_ = beta > 0
    for _ in range(steps):
        if not open_.any():
            break
        z = project(product(project(now)) - shifts * now)
        alpha = (now * z).sum(0)
        z = z - alpha * now - last * old
        beta = np.linalg.norm(z, axis=0)
        delta, low = c * alpha - c_old * s * last, s * alpha + c_old * c * last
        far, size = s_old * last, np.hypot(delta, beta)
        turn = np.where(size > 0, size, 1.0)
        c_next, s_next = delta / turn, beta / turn
        w = (now - far * w_old - low * w_now) / turn
        x = np.where(open_ & (size > 0), x + c_next * eta * w, x)
        eta = -s_next * eta
        open_ &= (size > 0) & (beta > 1e-14 * np.abs(shifts)) & (np.abs(eta) > rtol * start)
        old, now = now, z / np.where(beta > 0, beta, 1.0)
        w_old, w_now, c_old, c, s_old, s, last = w_now, w, c, c_next, s, s_next, beta
    return project(x)


def jacobi_davidson(
    product: Callable[[np.ndarray], np.ndarray], dim: int, k: int, guards: int = GUARDS, max_basis: int = MAX_BASIS,
    inner: int = INNER_STEPS, seed: int = 5,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, their vectors and residuals, of the symmetric operator behind ``product``."""
    k, block = min(k, dim), min(dim, k + guards)
    max_basis = max(max_basis, 3 * block)
    eps = np.finfo(float).eps
    locked, values = np.zeros((dim, 0)), np.zeros(0)
    norms_of = np.zeros(0)
    basis = _orthonormal(np.random.default_rng(seed).standard_normal((dim, block)), locked)
    image, best, stale = product(basis), np.inf, 0
    for _ in range(MAX_ROUNDS):
        h = basis.T @ image
        theta, s = np.linalg.eigh((h + h.T) / 2)
        theta, s = theta[::-1], s[:, ::-1]
        ritz, ritz_image = basis @ s, image @ s
        m = min(block, len(theta))
        top = max([*values, *np.abs(theta)], default=0.0)
        r = ritz_image[:, :m] - ritz[:, :m] * theta[:m]
        r -= locked @ (locked.T @ r)
        norms = np.linalg.norm(r, axis=0)
        goal = 8 * eps * np.sqrt(dim) * top
        # Rounding sets a floor under residuals: a subspace that no longer improves is as exact as doubles allow.
        wanted = norms[: max(0, k - len(values))].max(initial=0.0)
        stale = 0 if wanted < best / 2 else stale + 1
        best = min(best, wanted)
        whole = len(values) + basis.shape[1] == dim
        done = (norms <= goal) | ((norms <= 1e3 * goal) & (whole or stale >= 3))
        locked, values = np.column_stack([locked, ritz[:, :m][:, done]]), np.r_[values, theta[:m][done]]
        norms_of = np.r_[norms_of, norms[done]]
        stay = np.ones(len(theta), bool)
        stay[:m] = ~done
        basis, image, theta = ritz[:, stay], ritz_image[:, stay], theta[stay]
        order = np.argsort(-values, kind="stable")[:k]
        if len(order) == k and (not len(theta) or values[order[-1]] >= theta[0] - goal):
            return values[order], locked[:, order], norms_of[order]
        if done.any():
            best, stale = np.inf, 0
        r, m = r[:, ~done], int((~done).sum())
        if basis.shape[1] + block > max_basis:
            basis, image = basis[:, : 2 * block], image[:, : 2 * block]
        u = np.column_stack([locked, basis[:, :m]])
        t = minres(product, theta[:m], u, r, inner, 0.1) if m else np.zeros((dim, 0))
        held = np.column_stack([locked, basis])
        new = _orthonormal(np.column_stack([t, r]) if m else t, held)[:, :block]
        if not new.shape[1]:  # nothing to add: try other directions
            new = _orthonormal(np.random.default_rng(seed + len(values) + 1).standard_normal((dim, block)), held)
        if new.shape[1]:
            basis, image = np.column_stack([basis, new]), np.column_stack([image, product(new)])
    raise RuntimeError("the eigenpairs did not reach double precision")


@dataclass(frozen=True)
class Whitening:
    """A fitted map: centre, trace and eigenpairs, with the residuals and the deviation from whiteness as measured."""

    dim: int
    centre: Centre
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    identity_error: float


def fit(embeddings: DataFrame, k: int = COMPONENTS) -> Whitening:
    """The whitening of all vectors that take part."""
    dim, centre = fit_list(embeddings)
    none = Whitening(dim, centre, 0.0, np.zeros(0), np.zeros((dim, 0)), np.zeros(0), 0.0)
    if not centre.n:
        return none
    trace = float(summed(embeddings, dim, lambda x: np.square(centre.centred(x)).sum(keepdims=True), (1, 1))[0, 0]) / centre.n
    if not trace > 0:
        return none

    def product(t: np.ndarray) -> np.ndarray:
        def work(x: np.ndarray) -> np.ndarray:
            c = centre.centred(x)
            return c.T @ (c @ t)

        return summed(embeddings, dim, work, t.shape) / centre.n

    values, vectors, residuals = jacobi_davidson(product, dim, k)
    some = values > 2.0**-40 * values[0]
    values, vectors, residuals = values[some], vectors[:, some], residuals[some]

    def moments(x: np.ndarray) -> np.ndarray:
        w = centre.centred(x) @ vectors / np.sqrt(values)
        return np.vstack([w.T @ w, w.sum(0)])

    got = summed(embeddings, dim, moments, (len(values) + 1, len(values))) / centre.n
    error = float(np.abs(got[:-1] - np.outer(got[-1], got[-1]) - np.eye(len(values))).max())
    return Whitening(dim, centre, trace, values, vectors, residuals, error)


def whiten(embeddings: DataFrame, fitted: Whitening) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row a vector and component."""
    k, explained = len(fitted.values), fitted.values / fitted.trace if len(fitted.values) else np.zeros(0)
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    turn = fitted.vectors / np.sqrt(fitted.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits, x = quantise(batch.column(1), fitted.dim)
            ids = batch.column(0).filter(pa.array(fits))
            for a in range(0, len(x), ROWS):
                part = x[a : a + ROWS]
                m = len(part)
                of = np.repeat(np.arange(m), k)
                white = fitted.centre.centred(part) @ turn
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(a, m).take(pa.array(of)),
                        pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                        pa.array(np.full(m * k, fitted.centre.n)),
                        pa.array(fitted.centre.deviation(part), pa.int64()).take(pa.array(of)),
                        pa.array(white.ravel()),
                        pa.array(np.tile(explained, m)),
                        pa.array(np.full(m * k, fitted.identity_error)),
                    ],
                    names=names,
                )

    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = _rows(embeddings)
    return rows.mapInArrow(run, schema) if k else embeddings.sparkSession.createDataFrame([], schema)
