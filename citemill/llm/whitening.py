"""Embedding whitening by a block Jacobi-Davidson method.

The covariance is never built. Whatever is asked of it is a product with a thin
block of vectors: every task centres its rows and adds up its share, Spark adds
the shares, and a block of (dimension x at most ``BLOCK``) numbers comes back.

The solver keeps an orthonormal search space. Each round takes the best vectors
out of it (Rayleigh-Ritz), locks those whose residual is at rounding level, in
falling order, and asks for a correction to each of the others: the equation
``(I - QQ')(V - e I)(I - QQ') t = -r``, Q being the locked and the current
vectors, is solved roughly by a few MINRES steps, for all of them at once, so a
step is one distributed product whatever the number of components. Corrections
extend the space, which is cut back to its best part when it gets large.

Entries ``c`` become whole numbers ``floor(1024 c) + 100000``. Sums over them,
means and deviations are exact: a row is centred as ``(n x - S) / n`` with the
numerator in integers, so the large common offset costs no digits.

Defined cases: rows whose vector is null, empty, or holds null or non-finite
entries are dropped, and so are those of another length than the commonest (of
equally common ones the shorter); equal rows are rows each; a null id stays
null; there are no more components than directions in which the rows vary, so
none for a single row or equal rows, and the result is then empty, as for an
empty table; a deviation beyond a long is null; other columns are not read.
Entries are taken to be below 2**40 in size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citemill.llm.common import small_batches, tidy
from citemill.shared import materialise

COMPONENTS = 8
STEP, OFFSET = 1024, 100_000
# Vectors sought besides the wanted ones at the start; MINRES steps a round.
GUARDS = 4
BLOCK = COMPONENTS + GUARDS
# A few steps do: better corrections cost as many products as further rounds. If
# rounds get many, each takes more.
INNER_STEPS = 3
ROUNDS_PER_STEP = 10
INNER_TOLERANCE = 1e-2
# The search space is cut back to KEPT blocks when it has SPACE blocks.
SPACE, KEPT = 6, 2
MAX_ROUNDS = 200
FEW_TASKS = 32
EPS = np.finfo(np.float64).eps
# A residual of so many units in the last place of the largest eigenvalue is rounding.
RESIDUAL_ULPS = 32

Product = Callable[[np.ndarray], np.ndarray]


def whole_numbers(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, size, x``: rows with finite vectors, entries as 64-bit integers in bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pa.compute.list_value_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False)
            sizes = sizes.astype(np.int64)
            flat = batch.column(1).flatten()
            values = flat.fill_null(np.nan).to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
            kept = np.flatnonzero((sizes > 0) & (bad[ends] == bad[ends - sizes]))
            x = np.floor(STEP * np.nan_to_num(values, posinf=0.0, neginf=0.0)).astype(np.int64) + OFFSET
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(kept)),
                    pa.array(sizes[kept]),
                    pa.array([x[ends[i] - sizes[i] : ends[i]].tobytes() for i in kept], type=pa.binary()),
                ],
                names=["vec_id", "size", "x"],
            )

    small_batches(vectors.sparkSession)
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")
    )
    return rows.mapInArrow(tidy(run), "vec_id long, size long, x binary")


def matrix(column: pa.Array, d: int) -> np.ndarray:
    """A column of equally long byte vectors as a matrix of integers."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.int64).reshape(-1, d)


def sum_by_place(
    rows: DataFrame, partial: Callable[[Iterator[pa.RecordBatch]], np.ndarray], kind: str, tasks: int
) -> np.ndarray:
    """One array per task, added up place by place; its length does not depend on the rows.

    The shares of up to ``FEW_TASKS`` tasks are added here; those of more are
    added by a shuffle, so this process gets one array whatever the table's size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = partial(batches)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], names=["place", "value"])

    shares = rows.select("x").mapInArrow(tidy(run), f"place long, value {kind}")
    if tasks > FEW_TASKS:
        shares = shares.groupBy("place").agg(F.sum("value").alias("value"))
    found = shares.toArrow()
    place, value = found.column("place").to_numpy(), found.column("value").to_numpy()
    out = np.zeros(int(place.max(initial=-1)) + 1, dtype=value.dtype)
    np.add.at(out, place, value)
    return out


@dataclass
class Fit:
    """The rows whose covariance is meant: how many, and their sums per dimension."""

    rows: DataFrame
    tasks: int
    n: int
    sums: np.ndarray

    @staticmethod
    def of(rows: DataFrame, d: int) -> Fit:
        def partial(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            out = np.zeros(d + 1, dtype=np.int64)
            for batch in batches:
                x = matrix(batch.column(0), d)
                out[:d] += x.sum(axis=0)
                out[d] += len(x)
            return out

        tasks = rows.rdd.getNumPartitions()
        found = sum_by_place(rows, partial, "long", tasks)
        return Fit(rows, tasks, int(found[d]), found[:d])

    def product(self, block: np.ndarray) -> np.ndarray:
        """Covariance times ``block``."""
        n, sums, (d, b) = self.n, self.sums, block.shape

        def partial(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            out = np.zeros((d, b))
            for batch in batches:
                centred = (n * matrix(batch.column(0), d) - sums) / n
                out += centred.T @ (centred @ block)
            return out.ravel()

        return sum_by_place(self.rows, partial, "double", self.tasks).reshape(d, b) / n

    def trace(self) -> float:
        n, sums = self.n, self.sums

        def partial(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            out = np.zeros(1)
            for batch in batches:
                out += (((n * matrix(batch.column(0), len(sums)) - sums) / n) ** 2).sum()
            return out

        return float(sum_by_place(self.rows, partial, "double", self.tasks)[0]) / n

    def covariance_of(self, projection: np.ndarray) -> np.ndarray:
        """Covariance of the centred rows times ``projection`` (dimension x few)."""
        n, sums, k = self.n, self.sums, projection.shape[1]

        def partial(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            out = np.zeros((k + 1, k))
            for batch in batches:
                w = ((n * matrix(batch.column(0), len(sums)) - sums) / n) @ projection
                out[:k] += w.T @ w
                out[k] += w.sum(axis=0)
            return out.ravel()

        out = sum_by_place(self.rows, partial, "double", self.tasks).reshape(k + 1, k) / n
        return out[:k] - np.outer(out[k], out[k])


def fit(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> Fit | None:
    """The usable rows, stored, with count and sums; None if there are none."""
    rows = materialise(whole_numbers(vectors, id_col, vector_col), "whole-vectors")
    common = rows.groupBy("size").count().orderBy(F.desc("count"), "size").first()
    if common is None:
        return None
    return Fit.of(rows.filter(F.col("size") == common["size"]), common["size"])


def minres(product: Product, rhs: np.ndarray, steps: int, tolerance: float) -> np.ndarray:
    """Rough solutions of symmetric systems that share a product, one per column of ``rhs``.

    The columns run side by side; one that has reached the tolerance, relative
    to its right side, no longer moves.
    """
    x, w, w_before, v_before = (np.zeros_like(rhs) for _ in range(4))
    beta = np.linalg.norm(rhs, axis=0)
    active = beta > 0
    v = rhs / np.where(active, beta, 1)
    eta, goal = beta.copy(), tolerance * beta
    c, c_before = np.ones_like(beta), np.ones_like(beta)
    s, s_before = np.zeros_like(beta), np.zeros_like(beta)
    for _ in range(steps):
        u = product(v)
        alpha = (v * u).sum(axis=0)
        u = u - alpha * v - beta * v_before
        beta_next = np.linalg.norm(u, axis=0)
        delta = c * alpha - c_before * s * beta
        rho1 = np.hypot(delta, beta_next)
        rho2 = s * alpha + c_before * c * beta
        rho3 = s_before * beta
        active &= rho1 > 0
        safe = np.where(rho1 > 0, rho1, 1)
        w_before, w = w, (v - rho3 * w_before - rho2 * w) / safe
        c_before, c = c, delta / safe
        s_before, s = s, beta_next / safe
        x = np.where(active, x + c * eta * w, x)
        eta = -s * eta
        active &= (np.abs(eta) > goal) & (beta_next > 0)
        if not active.any():
            break
        v_before, v, beta = v, u / np.where(beta_next > 0, beta_next, 1), beta_next
    return x


def without(block: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """``block`` made orthogonal to orthonormal bases, twice for the digits' sake."""
    for _ in range(2):
        for basis in bases:
            block = block - basis @ (basis.T @ block)
    return block


def new_directions(block: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``block`` adds to the bases; what is as good as inside is left out."""
    size = np.linalg.norm(block, axis=0)
    block = without(block[:, size > 0] / size[size > 0], *bases)
    if not block.shape[1]:
        return block
    u, kept, _ = np.linalg.svd(block, full_matrices=False)
    u = without(u[:, kept > 1e-8], *bases)
    return np.linalg.qr(u)[0]


def largest_eigenpairs(product: Product, d: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and unit eigenvectors of a symmetric operator."""
    k = min(k, d)
    space = np.linalg.qr(np.random.default_rng(0).standard_normal((d, min(k + GUARDS, d))))[0]
    image = product(space)
    locked, values, scale = np.zeros((d, 0)), [], 0.0
    for done in range(MAX_ROUNDS):
        small = space.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        space, image, theta = space @ turn[:, ::-1], image @ turn[:, ::-1], theta[::-1]
        scale = max(scale, float(np.abs(theta).max(initial=0.0)))
        wanted = k - len(values)
        residual = without(image[:, :wanted] - space[:, :wanted] * theta[:wanted], locked)
        # With the whole space searched nothing better can be found.
        full = space.shape[1] + locked.shape[1] >= d
        small_enough = np.linalg.norm(residual, axis=0) <= RESIDUAL_ULPS * EPS * scale
        n = wanted if full else int(np.argmin(np.append(small_enough, False)))
        locked = np.hstack((locked, space[:, :n]))
        values += theta[:n].tolist()
        if len(values) == k:
            break
        space, image, theta, residual = space[:, n:], image[:, n:], theta[n:], residual[:, n:]
        wanted -= n
        current = np.hstack((locked, space[:, :wanted]))
        shift = theta[:wanted]

        def corrected(v: np.ndarray) -> np.ndarray:
            v = without(v, current)
            return without(product(v) - v * shift, current)

        step = minres(corrected, -without(residual, current), INNER_STEPS + done // ROUNDS_PER_STEP, INNER_TOLERANCE)
        if space.shape[1] + step.shape[1] > SPACE * (k + GUARDS):
            kept = KEPT * (k + GUARDS)
            space, image = space[:, :kept], image[:, :kept]
        more = new_directions(step, locked, space)
        if not more.shape[1]:
            more = new_directions(np.random.default_rng(len(values)).standard_normal((d, 1)), locked, space)
        space, image = np.hstack((space, more)), np.hstack((image, product(more)))
    else:
        raise ArithmeticError(f"{len(values)} of {k} eigenvectors after {MAX_ROUNDS} rounds")
    # Once more among themselves, which also orders them.
    basis = np.linalg.qr(locked)[0]
    small = basis.T @ product(basis)
    theta, turn = np.linalg.eigh((small + small.T) / 2)
    return theta[::-1], basis @ turn[:, ::-1]


@dataclass
class Whitening:
    """A fitted transformation: ``projection`` takes a centred row to its whitened components."""

    fit: Fit
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    @property
    def projection(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def train(fitted: Fit, components: int = COMPONENTS) -> Whitening | None:
    """None when the rows do not vary."""
    trace = fitted.trace()
    if trace <= 0:
        return None
    d = len(fitted.sums)
    values, vectors = largest_eigenpairs(fitted.product, d, components)
    kept = values > d * EPS * values[0]
    values, vectors = values[kept], vectors[:, kept]
    # Either sign is right; the largest entry is made positive.
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])
    found = fitted.covariance_of(vectors / np.sqrt(values))
    error = float(np.abs(found - np.eye(len(values))).max())
    return Whitening(fitted, values, vectors, trace, error)


def deviations(numerators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums of squares per row, and which of them are beyond a long."""
    largest = int(np.abs(numerators).max(initial=0))
    if largest * largest * numerators.shape[1] < 1 << 63:
        return (numerators * numerators).sum(axis=1), np.zeros(len(numerators), dtype=bool)
    exact = [sum(v * v for v in row) for row in numerators.tolist()]
    beyond = np.array([v >= 1 << 63 for v in exact])
    return np.array([0 if b else v for v, b in zip(exact, beyond)], dtype=np.int64), beyond


SCHEMA = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The contract's columns: one row per usable vector and component."""
    fitted = fit(vectors, id_col, vector_col)
    model = train(fitted) if fitted else None
    if model is None:
        return vectors.sparkSession.createDataFrame([], SCHEMA)
    n, sums, projection = fitted.n, fitted.sums, model.projection
    explained, error, k = model.values / model.trace, model.identity_error, len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numerators = n * matrix(batch.column(1), len(sums)) - sums
            rows = len(numerators)
            deviation, beyond = deviations(numerators)
            each = np.repeat(np.arange(rows), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, n)),
                    pa.array(deviation[each], mask=beyond[each]),
                    pa.array(((numerators / n) @ projection).ravel()),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * k, error)),
                ],
                names=[c.split()[0] for c in SCHEMA.split(", ")],
            )

    return fitted.rows.select("vec_id", "x").mapInArrow(tidy(run), SCHEMA)
