"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation of their centred rows.

Every step multiplies the centred matrix X with a direction v (one number a row, which stays with the
rows) and Xᵀ with the result (one number a dimension, summed by Spark), in one job. Left vectors are
never stored: each is X times a short vector that the driver knows, so a task that is lost works them
out again from its rows. Both sides are fully reorthogonalised: the products with all earlier left
vectors come from the same job, and the right vectors are short. The singular values and vectors of
the small bidiagonal matrix give deviations and components; steps go on until the wanted ones no
longer change, or there is no further direction.

Entries are fixed-point numbers, floor(64 c) + 1000000, so that counts, sums and the deviation of a
row are exact. The driver and every task hold `dimensions x steps` numbers, whatever the rows are.

Defined results: rows whose vector is null or has a null or non-finite entry are dropped, and so are
rows of any other length than the most frequent one (the longest of several). Products 64 c beyond
2**52 count as that bound. A direction without variance is no component, so a table of equal rows or
of one row has none and gives no rows; a deviation beyond a long is null. Repeated rows count each.
Of components with equal deviations any basis of their space is right. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairprep.sources.scratch import stage

COMPONENTS = 32
SCALE = 64
SHIFT = 1_000_000
BOUND = float(1 << 52)
LIMB = 26
# Of the largest singular value: what counts as no further direction, and as converged.
NOTHING = 1e-12
SETTLED = 1e-15
SEED = 42


@dataclass(frozen=True)
class Whitening:
    """Row count, sums of the dimensions, unit components by column, and their shares."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    variances: np.ndarray
    total_variance: float

    @property
    def explained(self) -> list[float]:
        return [float(v / self.total_variance) for v in self.variances]


def fixed_point(vector: Column) -> Column:
    """Array of longs, null for a vector that is to be dropped."""
    usable = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    bounded = lambda c: F.greatest(F.least(c * SCALE, F.lit(BOUND)), F.lit(-BOUND))
    values = vector.cast("array<double>")
    whole = F.transform(values, lambda c: F.floor(bounded(c)).cast("long") + SHIFT)
    return F.when(vector.isNotNull() & F.forall(values, usable), whole)


def usable_rows(rows: DataFrame, vector: str) -> DataFrame:
    """(row, x) of the rows that remain, as a written table."""
    ready = stage(
        rows.select(F.struct("*").alias("row"), fixed_point(F.col(vector)).alias("x")).where("x IS NOT NULL"), "vectors"
    )
    sizes = ready.groupBy(F.size("x").alias("size")).agg(F.count("*").alias("n"))
    most = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    return ready.where(F.size("x") == (most.size if most else 0))


def _matrix(lists: pa.Array) -> np.ndarray:
    values = np.asarray(lists.flatten(), dtype=np.int64)
    return values.reshape(len(lists), -1)


def _offsets(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """n x - sums, exact; as Python integers where 64 bits could overflow."""
    largest = max((abs(s) for s in sums), default=0) + n * int(np.abs(x).max(initial=0))
    if largest < 1 << 62:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    return _offsets(x, n, sums).astype(np.float64) / n


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Sum of (n x - sums)**2 of every row, exact; null where it is no long."""
    offsets = _offsets(x, n, sums)
    largest = int(np.abs(offsets).max(initial=0))
    if largest * largest * x.shape[1] >= 1 << 63:
        offsets = offsets.astype(object)
    found = [int(v) for v in (offsets * offsets).sum(axis=1)]
    return [v if v < 1 << 63 else None for v in found]


def _summed(vectors: DataFrame, partial: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray:
    """Sum over all rows of what `partial` makes of a block of rows; Spark adds the tasks' parts up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = partial(_matrix(batch.column(0)))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["i", "value"])

    parts = vectors.select("x").mapInArrow(run, f"i long, value {kind}")
    rows = parts.groupBy("i").agg(F.sum("value").alias("value")).collect()
    return np.array([r.value for r in sorted(rows)])


def moments(vectors: DataFrame) -> tuple[int, tuple[int, ...]]:
    """Rows and exact sums of the dimensions; each sum is added up in two halves."""

    def partial(x: np.ndarray) -> np.ndarray:
        return np.concatenate(([len(x)], (x >> LIMB).sum(axis=0), (x & ((1 << LIMB) - 1)).sum(axis=0)))

    found = [int(v) for v in _summed(vectors, partial, "long")]
    size = len(found) // 2
    return (found[0] if found else 0), tuple((high << LIMB) + low for high, low in zip(found[1 : size + 1], found[size + 1 :]))


def _orthogonal(v: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """v without its parts along the basis, taken off twice."""
    if basis:
        q = np.stack(basis, axis=1)
        for _ in range(2):
            v = v - q @ (q.T @ v)
    return v


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Components of the covariance (divisor n) of the column x, by falling variance."""
    n, sums = moments(vectors)
    size = len(sums)
    context = vectors.sparkSession.sparkContext
    chance = np.random.default_rng(SEED)

    def products(v: np.ndarray, beta: float, lefts: np.ndarray) -> tuple[float, float, np.ndarray, np.ndarray]:
        """For u = X v - beta * (last left vector): |X|², |u|², Xᵀu, and u times all left vectors."""
        shared = context.broadcast((v, beta, lefts))

        def partial(x: np.ndarray) -> np.ndarray:
            v, beta, lefts = shared.value
            rows = centred(x, n, sums)
            before = rows @ lefts
            u = rows @ v
            if before.shape[1]:
                u = u - beta * before[:, -1]
            return np.concatenate(([np.sum(rows * rows), u @ u], rows.T @ u, before.T @ u))

        found = _summed(vectors, partial, "double")
        shared.unpersist()
        return found[0], found[1], found[2 : size + 2], found[size + 2 :]

    def fresh(rights: list[np.ndarray]) -> np.ndarray:
        v = _orthogonal(chance.standard_normal(size), rights)
        return v / np.linalg.norm(v)

    rights: list[np.ndarray] = []
    lefts, images = np.empty((size, 0)), np.empty((size, 0))  # left vectors are X @ lefts, images their Xᵀ products
    alphas: list[float] = []
    betas: list[float] = []
    beta, largest, total = 0.0, 0.0, 0.0
    v = fresh(rights) if size else None
    while n and len(rights) < size:
        total, square, image, along = products(v, beta, lefts)
        largest = largest or np.sqrt(total)
        # What is left along earlier left vectors is taken off in terms of their short vectors.
        short = v - beta * lefts[:, -1] - lefts @ along if rights else v
        image = image - images @ along
        alpha = float(np.sqrt(max(square - along @ along, 0.0)))
        rights.append(v)
        if alpha <= NOTHING * largest:  # v leads nowhere new: a zero left vector fits
            alpha, short, image = 0.0, np.zeros(size), np.zeros(size)
        else:
            short, image = short / alpha, image / alpha
        alphas.append(alpha)
        lefts, images = np.column_stack((lefts, short)), np.column_stack((images, image))
        following = _orthogonal(image - alpha * v, rights)
        beta = float(np.linalg.norm(following))
        if _settled(alphas, betas, beta, components):
            break
        if len(rights) < size:
            broken = beta <= NOTHING * largest
            beta, v = (0.0, fresh(rights)) if broken else (beta, following / beta)
            betas.append(beta)
    return _whitening(n, sums, total, rights, alphas, betas, components)


def _bidiagonal(alphas: list[float], betas: list[float]) -> np.ndarray:
    return np.diag(alphas) + np.diag(betas[: len(alphas) - 1], 1)


def _settled(alphas: list[float], betas: list[float], beta: float, components: int) -> bool:
    """Whether the next step changes none of the wanted singular vectors."""
    if len(alphas) <= components:
        return False
    left, values, _ = np.linalg.svd(_bidiagonal(alphas, betas))
    return bool(np.all(beta * np.abs(left[-1, :components]) <= SETTLED * values[0]))


def _whitening(n, sums, total, rights, alphas, betas, components) -> Whitening:
    if not alphas:
        return Whitening(n, sums, np.empty((len(sums), 0)), np.empty(0), 0.0)
    _, values, across = np.linalg.svd(_bidiagonal(alphas, betas))
    kept = [i for i in range(min(components, len(values))) if values[i] > NOTHING * values[0]]
    directions = np.stack(rights, axis=1) @ across.T[:, kept]
    directions = directions / np.linalg.norm(directions, axis=0)
    return Whitening(n, sums, directions, values[kept] ** 2 / n, total / n)


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, over all rows."""
    k = len(model.variances)
    if not k:
        return 0.0
    n, sums, turn = model.n, model.sums, model.components / np.sqrt(model.variances)

    def partial(x: np.ndarray) -> np.ndarray:
        rows = centred(x, n, sums) @ turn
        return np.concatenate((rows.sum(axis=0), (rows.T @ rows).ravel()))

    found = _summed(vectors, partial, "double")
    mean = found[:k] / n
    return float(np.abs(found[k:].reshape(k, k) / n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(vectors: DataFrame, model: Whitening) -> DataFrame:
    """`usable_rows` with deviation and whitened, an array with a number for each component."""
    n, sums, turn = model.n, model.sums, model.components / np.sqrt(model.variances)

    @F.arrow_udf("struct<deviation: bigint, whitened: array<double>>")
    def turned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import pyarrow as pa

        for lists in batches:
            x = _matrix(lists)
            values = centred(x, n, sums) @ turn
            ends = np.arange(len(x) + 1, dtype=np.int32) * turn.shape[1]
            arrays = [
                pa.array(deviations(x, n, sums), pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel())),
            ]
            yield pa.StructArray.from_arrays(arrays, ["deviation", "whitened"])

    return vectors.select("row", F.inline(F.array(turned("x"))))


def op13_whitening(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    vectors = usable_rows(rows, "embedding")
    model = fit(vectors)
    error = identity_error(vectors, model)
    explained = F.array(*[F.lit(e) for e in model.explained]).cast("array<double>")
    spread = whiten(vectors, model).select("row.vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return spread.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
