"""Embedding whitening: leading eigenvectors of a covariance that is never formed, by block Jacobi-Davidson.

Vectors are integers x = floor(scale * c) + shift, so their number n and sums S are exact, and so is each centred row
n * x - S. A product of the covariance with a block of columns W is one distributed pass: every task adds up
(x - S/n) ((x - S/n)^T W) over its rows, and the tasks' sums meet in a tree, ``FAN`` at a time. The driver holds blocks
of a few columns as long as a vector, never rows and no matrix of the vectors' size squared.

Jacobi-Davidson: Rayleigh-Ritz in an orthonormal basis gives Ritz pairs (theta, u); their residuals A u - theta u are
taken from a new product. Pairs whose residual is under ``RESIDUAL`` (times the root of the length) of the largest
eigenvalue, which is rounding in double precision, are locked. Tasks add up with compensation, so that rounding doesn't
grow with the rows. For the others the projected correction equation (I - QQ^T)(A - theta I)(I - QQ^T) t = -r, with Q
the locked and the present vectors, is solved by a few steps of MINRES; all columns step together, so a step is one
pass. The corrections widen the basis, which is cut back to its leading Ritz vectors when it is full. A few guard
vectors beyond those wanted show whether a larger eigenvalue was missed: the search ends when all wanted pairs are locked
and no other can be larger.

Defined cases: vectors that are null or hold null or non-finite components take no part; null vec_ids and repeated rows
do, each by itself; shorter vectors count as filled up with zeros; ties of eigenvalues give any orthonormal vectors of
their space; directions without variance (under ``RANK`` of the largest) can't be whitened and are no components; equal
rows only, or an empty table, give no rows; other columns are not read. A deviation beyond a long is an error, as is a
search without convergence.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, read_table

FAN = 32  # partial sums that meet in one task, or in the driver
GUARD = 4
INNER = 8  # MINRES steps for each correction
RESIDUAL = 8 * np.finfo(float).eps  # times the root of a vector's length
RANK = 1e-12
MOST = 300  # outer steps
SLICE = 2048  # rows multiplied at a time


def shifted_vectors(table: DataFrame, scale: float = 64.0, shift: int = 1_000_000) -> DataFrame:
    """vec_id, x (array<long>): usable rows, all equally long."""
    fine = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = table.where("embedding is not null").where(fine).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform("embedding", lambda c: F.floor(F.lit(scale) * c.cast("double")) + F.lit(shift)).alias("x"))
    sizes = rows.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if sizes[0] != sizes[1]:
        rows = rows.withColumn("x", F.concat("x", F.array_repeat(F.lit(shift).cast("long"), F.lit(sizes[1]) - F.size("x"))))
    return rows


# ---------------------------------------------------------------- sums over all rows

def _matrix(column: pa.Array) -> np.ndarray:
    """An array<long> column as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def tree_sum(rows: DataFrame, partitions: int, shape: tuple, kind: str,
             partial: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all batches of ``partial`` of a batch's matrix x: added up by task, then ``FAN`` tasks at a time."""
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, lost = np.zeros(shape, kind), np.zeros(shape, kind)
        for batch in batches:
            x = _matrix(batch.column(0))
            for at in range(0, len(x), SLICE):
                more = partial(x[at: at + SLICE])
                total = out + more
                back = total - out
                lost += (out - (total - back)) + (more - back)  # what rounding took (nothing in whole numbers)
                out = total
        yield _partial(TaskContext.get().partitionId(), out + lost)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            for at, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums.setdefault(at // FAN, []).append((at, data))
        for group, parts in sums.items():
            yield _partial(group, _added(parts, shape, kind))

    parts = rows.select("x").mapInArrow(first, "at long, data binary")
    while partitions > FAN:
        partitions = math.ceil(partitions / FAN)
        parts = parts.repartition(partitions, F.floor(F.col("at") / FAN)).mapInArrow(add, "at long, data binary")
    return _added([(r.at, r.data) for r in parts.collect()], shape, kind)


def _partial(at: int, out: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"at": pa.array([at], pa.int64()), "data": pa.array([out.tobytes()], pa.binary())})


def _added(parts: list, shape: tuple, kind: str) -> np.ndarray:
    """Always in the same order, so that a repeated pass gives the same sum."""
    out = np.zeros(shape, kind)
    for _, data in sorted(parts, key=lambda r: r[0]):
        out += np.frombuffer(data, kind).reshape(shape)
    return out


@dataclass
class Centre:
    """Number and sums of the rows; rows are centred in whole numbers before anything is multiplied."""

    n: int
    sums: np.ndarray

    def whole(self, x: np.ndarray) -> np.ndarray:
        return self.n * x - self.sums

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.whole(x) / float(self.n)

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """Exact squared distances n**2 |x - S/n|**2."""
        d = self.whole(x)
        if int(np.abs(d).max(initial=0)) ** 2 * d.shape[1] < 2**63:
            return (d * d).sum(axis=1)
        return np.array([sum(int(v) ** 2 for v in row) for row in d], dtype=np.int64)  # an error beyond a long


# ---------------------------------------------------------------- eigenvectors

def orthonormal(block: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``block`` adds to ``basis``."""
    for _ in range(3):
        if not block.shape[1] or basis.shape[1] >= len(basis):
            return block[:, :0]
        size = np.linalg.norm(block, axis=0)
        block = block[:, size > 0] / size[size > 0]
        block = block - basis @ (basis.T @ block)
        u, s, _ = np.linalg.svd(block, full_matrices=False)
        block = u[:, s > 1e-10 * math.sqrt(len(basis))][:, : len(basis) - basis.shape[1]]
    return block


def minres(apply: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int, share: float) -> np.ndarray:
    """Approximate solutions, column by column, of symmetric systems; each step applies the operators to one block."""
    beta = np.linalg.norm(right, axis=0)
    start = beta.copy()
    safe = lambda a: np.where(a > 0, a, 1.0)
    v, before = right / safe(beta), np.zeros_like(right)
    x, d, d_before = np.zeros_like(right), np.zeros_like(right), np.zeros_like(right)
    c = c_before = np.ones_like(beta)
    s = s_before = np.zeros_like(beta)
    rest = beta.copy()
    for _ in range(steps):
        w = apply(v) - beta * before
        alpha = (v * w).sum(axis=0)
        w -= alpha * v
        following = np.linalg.norm(w, axis=0)
        following[following <= 1e-14 * start] = 0.0
        low = c * alpha - c_before * s * beta
        rho, rho2, rho3 = np.hypot(low, following), s * alpha + c_before * c * beta, s_before * beta
        usable = rho > 0
        d, d_before = np.where(usable, (v - rho3 * d_before - rho2 * d) / safe(rho), 0.0), d
        c_before, s_before = c, s
        c, s = np.where(usable, low / safe(rho), 1.0), np.where(usable, following / safe(rho), 0.0)
        x += c * rest * d
        rest = -s * rest
        if (np.abs(rest) <= share * start).all():
            break
        before, v, beta = v, w / safe(following), following
    return x


def leading_pairs(product: Callable[[np.ndarray], np.ndarray], size: int, wanted: int, inner: int = INNER,
                  residual: float = RESIDUAL, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and unit eigenvectors (columns) of a symmetric positive operator."""
    wanted = min(wanted, size)
    full = 3 * (wanted + GUARD)
    locked, values = np.zeros((size, 0)), np.zeros(0)
    basis = orthonormal(np.random.default_rng(seed).standard_normal((size, min(size, wanted + GUARD))), locked)
    image = product(basis)
    scale = 0.0
    for _ in range(MOST):
        # Rayleigh-Ritz; the residuals come from a product of the Ritz vectors themselves
        h = basis.T @ image
        theta, z = np.linalg.eigh((h + h.T) / 2)
        theta, z = theta[::-1], z[:, ::-1]
        basis, image = basis @ z, image @ z
        count = min(basis.shape[1], wanted - len(values) + GUARD)
        ritz = basis[:, :count]
        image[:, :count] = product(ritz)
        theta[:count] = (ritz * image[:, :count]).sum(axis=0)
        r = image[:, :count] - ritz * theta[:count]
        r -= locked @ (locked.T @ r)
        error = np.linalg.norm(r, axis=0)
        scale = max(scale, np.abs(theta[:count]).max(initial=0.0), values.max(initial=0.0))
        close = error <= residual * math.sqrt(size) * scale
        locked, values = np.hstack([locked, ritz[:, close]]), np.concatenate([values, theta[:count][close]])
        open_ = np.concatenate([~close, np.ones(basis.shape[1] - count, bool)])
        left, r = theta[:count][~close], r[:, ~close]
        basis, image, theta, ritz = basis[:, open_], image[:, open_], theta[open_], ritz[:, ~close]
        best = np.sort(values)[::-1]
        if len(best) >= wanted and (not len(left) or best[wanted - 1] >= (left + error[~close]).max()):
            order = np.argsort(-values, kind="stable")[:wanted]
            return values[order], locked[:, order]
        if locked.shape[1] == size:
            break
        if basis.shape[1] + len(left) > full:
            keep = len(left) + GUARD
            basis, image = basis[:, :keep], image[:, :keep]
        # correction equations, all columns in one pass a step
        q = np.hstack([locked, ritz])
        away = lambda a: a - q @ (q.T @ a)
        more = np.zeros((size, 0))
        if q.shape[1] < size and len(left):
            more = minres(lambda a: away(product(a) - a * left), away(-r), inner, 0.05)
        more = orthonormal(more, np.hstack([locked, basis]))
        if not more.shape[1]:  # the space is used up: a fresh start in it, against rounding errors
            free = size - locked.shape[1] - basis.shape[1]
            more = orthonormal(np.random.default_rng(seed + 1).standard_normal((size, min(free, wanted))),
                               np.hstack([locked, basis])) if free else more
            basis = orthonormal(basis, locked)
            image = product(basis)
        if more.shape[1]:
            basis, image = np.hstack([basis, more]), np.hstack([image, product(more)])
    raise RuntimeError(f"{len(values)} of {wanted} eigenpairs converged")


# ---------------------------------------------------------------- whitening

@dataclass
class Whitening:
    centre: Centre
    values: np.ndarray
    directions: np.ndarray  # columns over the square roots of the values
    explained: np.ndarray
    identity_error: float


def fit(vectors: DataFrame, components: int) -> Whitening | None:
    """The whitening of all rows of ``vectors`` (written table of vec_id, x); None where there is nothing to whiten."""
    first = vectors.select(F.size("x")).first()
    size = first[0] if first else 0
    if size < 1:
        return None
    parts = vectors.rdd.getNumPartitions()
    tally = tree_sum(vectors, parts, (size + 1,), "int64", lambda x: np.append(x.sum(axis=0), len(x)))
    centre = Centre(int(tally[-1]), tally[:-1])
    n = centre.n

    def product(w: np.ndarray) -> np.ndarray:
        w = np.ascontiguousarray(w)

        def partial(x: np.ndarray) -> np.ndarray:
            d = centre(x)
            return d.T @ (d @ w)
        return tree_sum(vectors, parts, w.shape, "float64", partial) / n

    trace = float(tree_sum(vectors, parts, (1,), "float64", lambda x: np.array([np.square(centre(x)).sum()]))[0]) / n
    if trace == 0:
        return None
    values, axes = leading_pairs(product, size, components)
    fine = values > RANK * values[0]
    values, axes = values[fine], axes[:, fine]
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(len(values))] < 0, -1.0, 1.0)
    directions = axes / np.sqrt(values)
    k = len(values)
    mean = tree_sum(vectors, parts, (k,), "float64", lambda x: (centre(x) @ directions).sum(axis=0)) / n

    def squares(x: np.ndarray) -> np.ndarray:
        w = centre(x) @ directions - mean
        return w.T @ w
    spread = tree_sum(vectors, parts, (k, k), "float64", squares) / n
    return Whitening(centre, values, directions, values / trace, float(np.abs(spread - np.eye(k)).max()))


def whiten(vectors: DataFrame, components: int = 32) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each vector and component."""
    schema = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    vectors = materialize(vectors.select("vec_id", "x"), "vectors")
    fitted = fit(vectors, components)
    if fitted is None:
        return vectors.sparkSession.createDataFrame([], schema)
    k = len(fitted.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                x = _matrix(part.column(1))
                ids = part.column(0).take(pa.array(np.repeat(np.arange(len(x)), k)))
                yield pa.RecordBatch.from_pydict({
                    "vec_id": ids, "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    "n": pa.array(np.full(len(x) * k, fitted.centre.n)),
                    "deviation": pa.array(np.repeat(fitted.centre.deviations(x), k)),
                    "whitened": pa.array((fitted.centre(x) @ fitted.directions).ravel()),
                    "explained": pa.array(np.tile(fitted.explained, len(x))),
                    "identity_error": pa.array(np.full(len(x) * k, fitted.identity_error))})

    return vectors.mapInArrow(run, schema)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(shifted_vectors(read_table(spark, sf_dir, "embeddings")), 32)
