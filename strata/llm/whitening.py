"""Whitening of embeddings by block Jacobi-Davidson.

A vector's entries c become whole numbers x = floor(64 * c) + 1000000. The
covariance V of x is never formed: every product V B with a block B of vectors
is one distributed pass that centres each row before multiplying,
``sum(y' (y @ B)) / n`` with y = x - S/n, where whole numbers are subtracted from
whole numbers before the fraction of S/n. The largest eigenpairs come from a search space (Rayleigh-Ritz, thick
restart). Each unlocked Ritz pair (t, u) asks for a correction from

    (I - QQ') (V - t I) (I - QQ') z = -r,    Q: locked and wanted Ritz vectors,

which MINRES solves roughly, all pairs side by side, so that an inner step is
one pass whatever the number of pairs. A pair is locked once its residual is at
double precision (``TOLERANCE`` of the largest eigenvalue), in falling order.

Partial sums are per task, added up by at most ``FOLDS`` tasks, so the driver
gets at most FOLDS blocks of (dimensions x components) numbers a pass. Vectors
stay in tables written to the scratch folder; a lost executor repeats its tasks
of one pass.

Rows: vectors that are null, or hold null or non-finite entries, or entries
whose x is beyond 2^53, drop out, and so do empty ones and ones of another
length than most rows have (the smaller length, if two are as frequent); all
others are fitted and returned, repeated rows and null ids as often as they
stand. ``deviation`` is exact; one beyond the largest long is null. Components
whose eigenvalue is zero to double precision cannot be whitened and are left
out, so equal vectors, a single one, or an empty table give no rows. Eigenvalues
that are equal have any orthonormal basis. Columns besides vec_id and embedding
are not read; rows are taken an Arrow batch at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import arrow_schema, materialize, to_batch

COMPONENTS = 32
TOLERANCE = 2e-14
FOLDS = 64
INNER = 8
MAX_OUTER = 60
LARGEST_X = float(2**53)
HALF = 26


class NotConvergedError(RuntimeError):
    """A residual did not reach double precision."""


def whole_vectors(spark: SparkSession, rows: DataFrame) -> tuple[DataFrame, int]:
    """Written table (vec_id, x array<long>) of the rows that take part, and their length."""
    rows = rows.select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    scaled = F.transform("e", lambda c: F.floor(F.lit(64.0) * c) + 1000000)
    finite = F.forall("e", lambda c: F.coalesce(F.abs(c) * 64 < LARGEST_X, F.lit(False)))
    good = rows.where(F.coalesce(finite, F.lit(False)) & (F.size("e") > 0))
    table = materialize(spark, good.select("vec_id", scaled.alias("x")), "whitening-x")
    usual = table.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if usual is None:
        return table, 0
    return table.where(F.size("x") == usual.d), usual.d


def _matrix(column: pa.ListArray, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)


class Sums:
    """Sums over all rows of what ``fn`` makes of each batch's matrix."""

    def __init__(self, table: DataFrame, d: int):
        self.table, self.d = table.select("x"), d
        self.parts = self.table.rdd.getNumPartitions()

    def __call__(self, fn, shape: tuple[int, ...], dtype) -> np.ndarray:
        d, folds = self.d, FOLDS
        arrow = arrow_schema(self.table.sparkSession, "task long, part binary")

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            total = np.zeros(shape, dtype)
            for batch in batches:
                total += fn(_matrix(batch.column(0), d))
            task = TaskContext.get().partitionId()
            yield to_batch({"task": [task], "part": [total.tobytes()]}, arrow)

        def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, first = np.zeros(shape, dtype), None
            for batch in batches:
                for task, part in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    total += np.frombuffer(part.as_buffer(), dtype).reshape(shape)
                    first = task if first is None else min(first, task)
            if first is not None:
                yield to_batch({"task": [first], "part": [total.tobytes()]}, arrow)

        sums = self.table.mapInArrow(partial, "task long, part binary")
        if self.parts > folds:
            dealt = sums.repartition(folds, F.col("task")).sortWithinPartitions("task")
            sums = dealt.mapInArrow(folded, "task long, part binary")
        total = np.zeros(shape, dtype)
        for row in sorted(sums.collect(), key=lambda r: r.task):
            total += np.frombuffer(row.part, dtype).reshape(shape)
        return total


def _halves(x: np.ndarray) -> np.ndarray:
    """Sums of the upper and the lower bits (neither can overflow), and the rows."""
    return np.concatenate([(x >> HALF).sum(axis=0), (x & ((1 << HALF) - 1)).sum(axis=0), [len(x)]])


class Centre:
    """The mean S/n as a whole number and the rest of S."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n for s in sums], np.int64)

    def subtracted(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of the squares of n * x - S for each row, exact; None beyond the largest long."""
        offset = x - self.whole
        most = (int(np.abs(offset).max(initial=0)) + 1) * self.n
        if most**2 * x.shape[1] < 2**63:
            return ((self.n * offset - self.rest) ** 2).sum(axis=1).tolist()
        rest = self.rest.tolist()
        sums = [sum((self.n * v - r) ** 2 for v, r in zip(row, rest, strict=True)) for row in offset.tolist()]
        return [v if v < 2**63 else None for v in sums]


class Covariance:
    """V as an operator: ``matmul`` is a pass over the rows."""

    def __init__(self, table: DataFrame, d: int):
        self.sums, self.d, self.passes = Sums(table, d), d, 0
        halves = self.sums(_halves, (2 * d + 1,), np.int64).tolist()
        self.n = halves[-1]
        self.centre = Centre(self.n, [(a << HALF) + b for a, b in zip(halves[:d], halves[d:-1], strict=True)])
        centre = self.centre
        squares = self.sums(lambda x: (centre.subtracted(x) ** 2).sum(axis=0), (d,), np.float64)
        self.trace = float(squares.sum()) / self.n

    def matmul(self, block: np.ndarray) -> np.ndarray:
        centre = self.centre
        self.passes += 1

        def product(x: np.ndarray) -> np.ndarray:
            centred = centre.subtracted(x)
            return centred.T @ (centred @ block)

        return self.sums(product, block.shape, np.float64) / self.n


def _orthonormal(block: np.ndarray, against: np.ndarray) -> np.ndarray:
    """Orthonormal basis of what ``block`` adds to the span of ``against``."""
    kept = []
    for v in block.T:
        size = np.linalg.norm(v)
        if size == 0 or not np.isfinite(size):
            continue
        v = v / size
        basis = np.column_stack([against, *kept]) if kept else against
        for _ in range(3):
            v = v - basis @ (basis.T @ v)
            left = np.linalg.norm(v)
            if left < 1e-10:
                break
            v = v / left
        else:
            kept.append(v)
    return np.column_stack(kept) if kept else np.zeros((len(block), 0))


def corrections(matmul, shifts: np.ndarray, residuals: np.ndarray, basis: np.ndarray, steps: int, reduce: float) -> np.ndarray:
    """MINRES on every column's projected correction equation at once; stops
    after ``steps`` passes or when all residuals fell to ``reduce`` of their start."""

    def project(v: np.ndarray) -> np.ndarray:
        v = v - basis @ (basis.T @ v)
        return v - basis @ (basis.T @ v)

    right = project(-residuals)
    start = np.linalg.norm(right, axis=0)
    live = start > 0
    safe = np.where(live, start, 1.0)
    v, v_old = right / safe, np.zeros_like(right)
    beta = np.zeros(len(start))
    w, w_old = np.zeros_like(right), np.zeros_like(right)
    c, c_old, s, s_old = np.ones(len(start)), np.ones(len(start)), np.zeros(len(start)), np.zeros(len(start))
    eta, z = start.copy(), np.zeros_like(right)
    for _ in range(steps):
        if not live.any():
            break
        p = project(matmul(v) - v * shifts)
        alpha = (v * p).sum(axis=0)
        p = p - alpha * v - beta * v_old
        beta_new = np.linalg.norm(p, axis=0)
        # the new column of the tridiagonal matrix through the last two rotations, and its own
        delta = c * alpha - c_old * s * beta
        above, far = s * alpha + c_old * c * beta, s_old * beta
        rho = np.hypot(delta, beta_new)
        live &= rho > 1e-300
        rho = np.where(live, rho, 1.0)
        c_old, s_old, c, s = c, s, delta / rho, beta_new / rho
        w, w_old = (v - far * w_old - above * w) / rho, w
        z = np.where(live, z + c * eta * w, z)
        eta = -s * eta
        live &= (np.abs(eta) > reduce * start) & (beta_new > 1e-14 * start)
        v, v_old, beta = np.where(beta_new > 0, p / np.where(beta_new > 0, beta_new, 1.0), 0.0), v, beta_new
    return project(z)


def leading(matmul, d: int, k: int, *, seed: int = 13, inner: int = INNER) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit eigenvectors."""
    k = min(k, d)
    space = _orthonormal(np.random.default_rng(seed).standard_normal((d, k)), np.zeros((d, 0)))
    image = matmul(space)
    locked, values = np.zeros((d, 0)), []
    locked_image = np.zeros((d, 0))
    largest = min(d, 3 * k + 8)
    for outer in range(MAX_OUTER):
        small = space.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(-theta)
        theta, turn = theta[order], turn[:, order]
        ritz, ritz_image = space @ turn, image @ turn
        wanted = k - len(values)
        residual = ritz_image[:, :wanted] - ritz[:, :wanted] * theta[:wanted]
        scale = max([*values[:1], theta[0], 0.0])
        # what is not orthogonal to the locked vectors is their error, not this pair's
        residual -= locked @ (locked.T @ residual)
        done = np.linalg.norm(residual, axis=0) <= TOLERANCE * scale
        n_done = int(np.argmin(done)) if not done.all() else len(done)
        if n_done:
            locked = np.column_stack([locked, ritz[:, :n_done]])
            locked_image = np.column_stack([locked_image, ritz_image[:, :n_done]])
            values += theta[:n_done].tolist()
        if len(values) >= k:
            break
        open_ = wanted - n_done
        theta, ritz, ritz_image = theta[n_done:], ritz[:, n_done:], ritz_image[:, n_done:]
        residual, basis = residual[:, n_done:], np.column_stack([locked, ritz[:, :open_]])
        new = corrections(matmul, theta[:open_], residual, basis, inner, 0.1 ** min(outer + 1, 6))
        keep = ritz.shape[1] if ritz.shape[1] + open_ + locked.shape[1] <= largest else open_
        space, image = ritz[:, :keep], ritz_image[:, :keep]
        added = _orthonormal(np.column_stack([new, residual]), np.column_stack([locked, space]))
        added = added[:, : min(open_, d - locked.shape[1] - keep)]
        if not added.shape[1]:  # the space is whole: its pairs are as exact as they get, once it is cleaned of rounding
            space = _orthonormal(space, locked)
            image = matmul(space)
            continue
        space, image = np.column_stack([space, added]), np.column_stack([image, matmul(added)])
    else:
        raise NotConvergedError(f"{k - len(values)} of {k} eigenpairs left after {MAX_OUTER} rounds")
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], locked[:, order]


def whiten(spark: SparkSession, rows: DataFrame, *, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error)
    of each row that takes part and each component."""
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double"
    table, d = whole_vectors(spark, rows)
    if not d:
        return spark.createDataFrame([], schema + ", identity_error double")
    covariance = Covariance(table, d)
    n, centre = covariance.n, covariance.centre
    values, vectors = leading(covariance.matmul, d, components) if covariance.trace > 0 else (np.zeros(0), np.zeros((d, 0)))
    real = int((values > d * 2.3e-16 * values[0]).sum()) if len(values) else 0
    values, vectors = values[:real], vectors[:, :real]
    turn, explained = vectors / np.sqrt(values), values / covariance.trace if real else values
    arrow = arrow_schema(spark, schema)

    def whitened(x: np.ndarray) -> np.ndarray:
        return centre.subtracted(x) @ turn

    error = 0.0
    if real:
        sums = covariance.sums
        mean = sums(lambda x: whitened(x).sum(axis=0), (real,), np.float64) / n

        def products(x: np.ndarray) -> np.ndarray:
            centred = whitened(x) - mean
            return centred.T @ centred

        error = float(np.abs(sums(products, (real, real), np.float64) / n - np.eye(real)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), d)
            rows_, at = len(x), np.repeat(np.arange(len(x)), real)
            yield to_batch(
                {
                    "vec_id": batch.column(0).take(pa.array(at)),
                    "component": np.tile(np.arange(1, real + 1, dtype=np.int32), rows_),
                    "n": np.full(rows_ * real, n, np.int64),
                    "deviation": pa.array(centre.deviations(x), pa.int64()).take(pa.array(at)),
                    "whitened": whitened(x).reshape(-1),
                    "explained": np.tile(explained, rows_),
                },
                arrow,
            )

    out = table.select("vec_id", "x").mapInArrow(run, schema)
    return out.withColumn("identity_error", F.lit(error))
