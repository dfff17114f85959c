"""Whitening of vectors by Golub-Kahan-Lanczos bidiagonalisation.

X is the matrix of the centred vectors, one row each, never held in one place.
From a start vector v the method goes on by products with X and its transpose,

    a_k u_k     = X v_k - b_(k-1) u_(k-1)
    b_k v_(k+1) = X'u_k - a_k v_k

so that X V = U B with orthonormal U and V and an upper bidiagonal B.  The
singular values of the small B give the deviations along the components, and V
times its right singular vectors the components.

Every u_k is X p_k for a vector p_k as short as the v are.  So a step is one
pass: from p, each task forms Xp for its rows, the products of Xp with the
earlier u (which are X p_j, formed beside it) and X'Xp.  The first take the
earlier u out of the new one, with what X' makes of them, and nothing as long
as the table is ever kept.  V is reorthogonalised where it lies, twice.

A step that comes to a halt, because what it has spans its space, goes on from
a new vector at right angles to V.  All dimensions are gone through, as many
passes as a vector has entries, so components of equal or nearly equal
deviation are told apart too; the halt of a new vector that X makes nothing of
ends it early.

Rows are packed to blocks of integers and stored, since each pass reads them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callmeter.llm.common import fresh_name
from callmeter.sources.stored import stored

# Entries are taken as whole numbers floor(SCALE * c) + SHIFT.
SCALE = 1024
SHIFT = 100_000

# Entries up to this keep the sums of a block within 64 bits.
LARGEST = float(2**40)

ROWS_IN_BLOCK = 2048

# Below this share of the largest length met, a vector is the work of rounding.
NOTHING = 1e-12
# Components with a smaller share of the largest deviation are left out.
LEAST_DEVIATION = 1e-9


@dataclass(frozen=True)
class Whitening:
    """What was fitted; ``components`` has a row each, by falling eigenvalue."""

    rows: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    total: float  # trace of the covariance
    steps: int

    @property
    def explained(self) -> np.ndarray:
        return self.eigenvalues / self.total if self.total else self.eigenvalues


def _fit_to_use(entries: Column) -> Column:
    whole = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    return F.coalesce(whole & (F.size(entries) > 0), F.lit(False))


def usable(table: DataFrame, column: str) -> DataFrame:
    """The rows that take part, with an array of doubles added under a fresh name, the last column.

    A row goes if its vector is null or empty, holds null or a number that is
    not finite or not below 2**40, or has another number of entries than most
    rows have (of equally frequent numbers the largest counts).
    """
    name = fresh_name(table, "entries")
    rows = table.withColumn(name, F.col(f"`{column}`").cast("array<double>")).filter(_fit_to_use(F.col(name)))
    width = F.size(name).alias("width")
    most = rows.groupBy(width).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("width")).first()
    return rows.filter(F.size(name) == (most.width if most else 0))


def whole_numbers(entries: pa.Array, width: int) -> np.ndarray:
    values = entries.flatten().to_numpy(zero_copy_only=False)
    return np.floor(values * SCALE).astype(np.int64).reshape(-1, width) + SHIFT


@dataclass(frozen=True)
class Blocks:
    """The whole numbers of up to ROWS_IN_BLOCK rows in one binary value each, stored."""

    table: DataFrame
    width: int


def packed(rows: DataFrame) -> Blocks | None:
    """Rows from usable() as blocks; None without rows."""
    first = rows.select(F.size(rows.columns[-1]).alias("width")).first()
    if first is None:
        return None
    width = first.width

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = whole_numbers(batch.column(0), width)
            cuts = range(0, len(x), ROWS_IN_BLOCK)
            values = [x[low : low + ROWS_IN_BLOCK].tobytes() for low in cuts]
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.binary())], names=["block"])

    table = rows.select(F.col(rows.columns[-1])).mapInArrow(of_batches, "block binary")
    return Blocks(stored(table, "vectors"), width)


def _summed(blocks: Blocks, of_block, kind: str = "double") -> list:
    """Sum over all blocks of the array that of_block makes of one.

    A task adds up its own blocks, so that it sends one row for each place of
    the array, which is as long as a few vectors.  Whole numbers are added up
    without rounding, as decimals.
    """
    width, exact = blocks.width, kind != "double"

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for value in batch.column(0):
                one = of_block(np.frombuffer(value.as_buffer(), np.int64).reshape(-1, width))
                one = one.astype(object) if exact else one
                total = one if total is None else total + one
        if total is not None:
            values = pa.array([str(v) for v in total]) if exact else pa.array(total, pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), values], names=["place", "value"])

    parts = blocks.table.mapInArrow(of_batches, f"place bigint, value {'string' if exact else 'double'}")
    sums = parts.groupBy("place").agg(F.sum(F.col("value").cast(kind)).alias("value")).collect()
    return [row.value for row in sorted(sums)]


def _wrapped(number: int) -> int:
    """The number of 64 bits that sums of 64 bits come to, also where they pass their limits on the way."""
    return (number + 2**63) % 2**64 - 2**63


def _centring(rows: int, sums: tuple[int, ...]):
    """Centres whole numbers: the whole part of the mean is taken off before anything is rounded."""
    whole = np.array([total // rows for total in sums], np.int64)
    rest = np.array([(total % rows) / rows for total in sums])
    return lambda x: (x - whole) - rest


class _Unit:
    """New directions at right angles to the rows of a matrix."""

    def __init__(self, width: int):
        self.width, self.random = width, np.random.default_rng(20)

    def next(self, found: np.ndarray) -> np.ndarray:
        v = self.random.standard_normal(self.width)
        for _ in range(3):
            v = v - found.T @ (found @ v)
            v = v / np.linalg.norm(v)
        return v


def bidiagonalise(product, width: int) -> tuple[np.ndarray, np.ndarray, int]:
    """V as rows, and B, from product(P, p) = (|Xp|², the products of Xp with the XP', X'Xp)."""
    unit = _Unit(width)
    v = np.empty((0, width))
    p = np.empty((0, width))
    images = np.empty((0, width))  # X'u for each u
    alphas: list[float] = []
    betas: list[float] = []
    nxt, beta, restarted, largest = unit.next(v), 0.0, True, 0.0
    while True:
        v = np.vstack([v, nxt])
        new = nxt - beta * p[-1] if len(p) else nxt
        square, overlap, image = product(p, new)
        new, image = new - p.T @ overlap, image - images.T @ overlap
        alpha = float(np.sqrt(max(square - overlap @ overlap, 0.0)))
        if alpha <= NOTHING * largest or alpha == 0.0:
            # u would be the work of rounding: X v lies among the earlier u.
            alpha, new, image = 0.0, np.zeros(width), np.zeros(width)
        else:
            new, image = new / alpha, image / alpha
        p, images = np.vstack([p, new]), np.vstack([images, image])
        alphas.append(alpha)
        largest = max(largest, alpha, beta)
        if len(v) == width or (restarted and alpha == 0.0):
            break  # all dimensions are spanned, or X makes nothing of the rest
        nxt = image - alpha * v[-1]
        for _ in range(2):
            nxt = nxt - v.T @ (v @ nxt)
        beta = float(np.linalg.norm(nxt))
        restarted = beta <= NOTHING * largest
        if restarted:
            nxt, beta = unit.next(v), 0.0
        else:
            nxt = nxt / beta
        betas.append(beta)
    return v, np.diag(alphas) + np.diag(betas, 1), len(alphas)


def fit(blocks: Blocks, most: int = 8) -> Whitening:
    """Fits up to ``most`` components to packed rows."""
    width = blocks.width
    counts = _summed(blocks, lambda x: np.append(x.sum(axis=0), len(x)), "decimal(38,0)")
    n, sums = int(counts[width]), tuple(int(value) for value in counts[:width])
    centred = _centring(n, sums)

    def product(earlier: np.ndarray, p: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        k = len(earlier)

        def of_block(x: np.ndarray) -> np.ndarray:
            x = centred(x)
            u = x @ p
            return np.concatenate([[u @ u], (x @ earlier.T).T @ u, x.T @ u])

        found = np.array(_summed(blocks, of_block))
        return float(found[0]), found[1 : k + 1], found[k + 1 :]

    total = _summed(blocks, lambda x: np.array([np.square(centred(x)).sum()]))[0]
    v, b, steps = bidiagonalise(product, width)
    deviations, turned = np.linalg.svd(b)[1:]
    count = int((deviations[:most] > LEAST_DEVIATION * deviations[0]).sum())
    components = turned[:count] @ v
    return Whitening(n, sums, components, deviations[:count] ** 2 / n, total / n, steps)


def whiten(rows: DataFrame, model: Whitening) -> DataFrame:
    """Rows from usable() with ``deviation`` and ``whitened`` added, their names made fresh.

    ``deviation`` is the sum over the dimensions of (n * x - S)², exact, null
    where it is beyond 64 bits; ``whitened`` the vector along the components
    over the deviation of each.
    """
    names = [fresh_name(rows, name) for name in ("deviation", "whitened")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    n, sums = model.rows, np.array([_wrapped(total) for total in model.sums], np.int64)
    centred = _centring(model.rows, model.sums)
    over = model.components.T / np.sqrt(model.eigenvalues)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = whole_numbers(batch.column(batch.num_columns - 1), len(sums))
            away = centred(x)
            small = np.square(away).sum(axis=1) * float(n) ** 2 < 2.0**62
            exact = np.zeros(len(x), np.int64)
            exact[small] = np.square(n * x[small] - sums).sum(axis=1)
            deviation = pa.array(exact, mask=~small)
            flat = pa.array((away @ over).reshape(-1))
            offsets = np.arange(len(x) + 1, dtype=np.int32) * over.shape[1]
            whitened = pa.ListArray.from_arrays(pa.array(offsets), flat)
            columns = [*batch.columns, deviation, whitened]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *names])

    return rows.mapInArrow(of_batches, f"{schema}, `{names[0]}` bigint, `{names[1]}` array<double>")


def identity_error(blocks: Blocks, model: Whitening) -> float:
    """The largest absolute entry of the covariance of the whitened rows minus the identity."""
    count = len(model.components)
    centred = _centring(model.rows, model.sums)
    over = model.components.T / np.sqrt(model.eigenvalues)

    def of_block(x: np.ndarray) -> np.ndarray:
        w = centred(x) @ over
        return np.concatenate([(w.T @ w).reshape(-1), w.sum(axis=0)])

    sums = np.array(_summed(blocks, of_block)) / model.rows
    mean = sums[count * count :]
    covariance = sums[: count * count].reshape(count, count) - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(count)).max())


def whitened_components(table: DataFrame, column: str = "embedding", most: int = 8) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per usable row and component.

    Equal rows and null vec_ids are kept as they are, columns beyond vec_id and
    the vector are not read.  Without usable rows, or if all of them are equal,
    there is no component and so no row.
    """
    spark = table.sparkSession
    rows = usable(table.select("vec_id", F.col(f"`{column}`").alias("vector")), "vector").drop("vector")
    blocks = packed(rows)
    model = fit(blocks, most) if blocks else None
    if model is None or not len(model.components):
        return spark.createDataFrame(
            [],
            "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double,"
            " identity_error double",
        )
    error = identity_error(blocks, model)
    explained = F.array(*[F.lit(float(share)) for share in model.explained])
    along = F.posexplode("whitened").alias("place", "value")
    return whiten(rows, model).select("vec_id", "deviation", along).select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        (F.col("place") + 1).alias("component"),
        F.lit(model.rows).cast("bigint").alias("n"),
        "deviation",
        F.col("value").alias("whitened"),
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
