"""Whitening of vectors by their principal components, from a matrix-free block Jacobi-Davidson iteration.

The covariance is never formed: each step asks the cluster for its product with a few columns, one pass over the stored
vectors that returns as many numbers as the block has. Everything else is small dense algebra of the dimension.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from eventloom.llm.common import stage

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000
# Columns iterated beside the wanted ones, steps of the inner solver, and the share of the residual it leaves.
GUARD, INNER_STEPS, INNER_TOLERANCE = 4, 12, 1e-3
# Residuals, relative to the largest eigenvalue, that count as double precision, and the rounds allowed to get there.
TOLERANCE, MAX_ROUNDS = 64 * np.finfo(float).eps, 60
_LARGEST = 2.0 ** 52


def grid(vector: Column, scale: int = SCALE, offset: int = OFFSET) -> Column:
    """Entries as whole numbers: floor(scale * entry as double) + offset."""
    return F.transform(vector, lambda c: F.floor(F.lit(scale) * c.cast("double")) + F.lit(offset))


def usable(vector: Column) -> Column:
    """Not null or empty, and every entry finite."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) >= _LARGEST / SCALE))
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def _orthonormal(block: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the block adds to the (orthonormal) others; directions lost to rounding are left out."""
    size = np.linalg.norm(block, axis=0)
    block = block[:, size > 0] / size[size > 0]
    for _ in range(3):
        for other in against:
            block = block - other @ (other.T @ block)
        left, values, _ = np.linalg.svd(block, full_matrices=False)
        block = left[:, values > 1e-10]
    return block


def minres(product: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int, tolerance: float) -> np.ndarray:
    """Solves product(x) = right for every column at once, each with a symmetric (perhaps indefinite) operator of its own."""
    x, size = np.zeros_like(right), np.linalg.norm(right, axis=0)
    live = size > 0
    if not live.any():
        return x
    safe = np.where(live, size, 1)
    before, v, beta = np.zeros_like(right), right / safe, np.zeros_like(size)
    phi, cos, sin, rest, over = size.copy(), -np.ones_like(size), np.zeros_like(size), np.zeros_like(size), np.zeros_like(size)
    w1, w2 = np.zeros_like(right), np.zeros_like(right)
    for _ in range(steps):
        y = product(v) - beta * before
        alpha = (v * y).sum(0)
        y = y - alpha * v
        next_beta = np.linalg.norm(y, axis=0)
        old_over, delta, bar = over, cos * rest + sin * alpha, sin * rest - cos * alpha
        over, rest = sin * next_beta, -cos * next_beta
        gamma = np.maximum(np.hypot(bar, next_beta), np.finfo(float).tiny)
        cos, sin = bar / gamma, next_beta / gamma
        w1, w2 = w2, (v - old_over * w1 - delta * w2) / gamma
        x = x + np.where(live, cos * phi, 0) * w2
        phi = sin * phi
        live &= (phi > tolerance * size) & (next_beta > 1e-14 * safe)
        if not live.any():
            break
        before, v, beta = v, y / np.where(next_beta > 0, next_beta, 1), next_beta
    return x


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], dimension: int, wanted: int, seed: int = 1,
                    max_rounds: int = MAX_ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues (falling) and unit eigenvectors of a symmetric operator that is known by its products only.

    Rayleigh-Ritz in a growing subspace; leading pairs whose residual is at double precision are locked, the others
    give correction equations, projected against what is known and solved by MINRES with all columns in step. The
    subspace starts anew from its best vectors at four times the block. Raises if residuals stop short of 1e-12 of the largest.
    """
    wanted = min(wanted, dimension)
    block = min(dimension, wanted + GUARD)
    locked, values = np.zeros((dimension, 0)), np.zeros(0)
    space = _orthonormal(np.random.default_rng(seed).standard_normal((dimension, block)))
    image = product(space)
    best, stalled = np.inf, 0
    for _ in range(max_rounds):
        h = space.T @ image
        theta, turn = np.linalg.eigh((h + h.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        space, image = space @ turn, image @ turn
        rest = image - space * theta
        rest -= locked @ (locked.T @ rest)
        size = np.linalg.norm(rest, axis=0)
        largest = max([abs(theta[0]) if len(theta) else 0.0, *np.abs(values[:1])])
        need = wanted - len(values)
        worst = size[:need].max(initial=0.0)
        best, stalled = (worst, 0) if worst < 0.5 * best else (best, stalled + 1)
        # Residuals that no longer fall, far below single precision, are at the rounding of the sums.
        reached = TOLERANCE * largest if stalled < 3 else max(TOLERANCE, 1e-12) * largest
        done = int(np.argmin(np.append(size[:need] <= reached, False)))
        if done:
            locked, values = np.hstack([locked, space[:, :done]]), np.append(values, theta[:done])
            space, image, theta, rest, need = space[:, done:], image[:, done:], theta[done:], rest[:, done:], need - done
            best, stalled = np.inf, 0
        if not need:
            order = np.argsort(-values, kind="stable")
            return values[order], locked[:, order]
        if space.shape[1] > 3 * block:
            space, image = space[:, :block], image[:, :block]
        active = space[:, :need]
        known = np.hstack([locked, active])
        shift = theta[:need]

        def projected(x: np.ndarray) -> np.ndarray:
            x = x - known @ (known.T @ x)  # noqa: B023
            y = product(x) - x * shift  # noqa: B023
            return y - known @ (known.T @ y)  # noqa: B023

        right = -rest[:, :need]
        new = _orthonormal(minres(projected, right - known @ (known.T @ right), INNER_STEPS, INNER_TOLERANCE), locked, space)
        if new.shape[1]:
            space, image = np.hstack([space, new]), np.hstack([image, product(new)])
        else:  # nothing to add: what is left is the rounding of the images
            space = _orthonormal(space, locked)
            image = product(space)
    raise RuntimeError(f"residuals did not reach double precision in {max_rounds} rounds")


def _rows(batch: pa.RecordBatch, column: str) -> np.ndarray:
    lists = batch.column(column)
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


@dataclass(frozen=True)
class Grid:
    """Whole-number vectors of one length: their number, sums and largest size."""

    n: int
    sums: tuple[int, ...]
    largest: int

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: as long integers where they must fit, else as Python's."""
        kind = np.int64 if 2 * self.n * self.largest < 2 ** 62 else object
        return x.astype(kind) * self.n - np.array(self.sums, kind)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.deviations(x) / self.n).astype(np.float64)


def _measure(vectors: DataFrame) -> Grid:
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n, largest = 0, 0, 0
        for batch in batches:
            if batch.num_rows:
                x = _rows(batch, "x")
                for part in np.array_split(x, -(-len(x) // 1024)):  # entries are below 2^53: the sum of so many fits
                    total = total + part.sum(axis=0).astype(object)
                n, largest = n + len(x), max(largest, int(np.abs(x).max()))
        if n:
            yield pa.RecordBatch.from_pydict({"at": list(range(len(total))), "total": [str(v) for v in total], "n": [n] * len(total),
                                              "largest": [largest] * len(total)})

    found = (vectors.select("x").mapInArrow(sums, "at long, total string, n long, largest long").groupBy("at")
             .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"), F.max("largest").alias("largest"))
             .orderBy("at").collect())
    return Grid(found[0]["n"], tuple(int(r["total"]) for r in found), max(r["largest"] for r in found))


def _summed(vectors: DataFrame, per_rows: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int], of: Grid) -> np.ndarray:
    """The sum over all centred rows of what a function gives for a batch of them, a matrix of that shape."""
    high, wide = shape

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(shape), False
        for batch in batches:
            if batch.num_rows:
                total, seen = total + per_rows(of.centred(_rows(batch, "x"))), True
        if seen:
            yield pa.RecordBatch.from_pydict({"at": list(range(high)), "row": total.tolist()})

    added = F.array(*[F.sum(F.get("row", F.lit(j))) for j in range(wide)])
    found = vectors.select("x").mapInArrow(partial, "at long, row array<double>").groupBy("at").agg(added.alias("row")).collect()
    out = np.zeros(shape)
    for r in found:
        out[r["at"]] = r["row"]
    return out


@dataclass(frozen=True)
class Whitening:
    """Components of a fit list: eigenvalues, unit vectors (as columns), share of the trace, and the whitened covariance's error."""

    of: Grid
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Learns from a stored table of whole-number vectors ``x`` of one length; None if it is empty."""
    if vectors.isEmpty():
        return None
    of = _measure(vectors)
    n, d = of.n, len(of.sums)
    trace = float(_summed(vectors, lambda x: (x * x).sum(0)[:, None], (d, 1), of).sum()) / n
    values, basis = jacobi_davidson(lambda v: _summed(vectors, lambda x: x.T @ (x @ v), v.shape, of) / n, d, components)
    # No variance is left where the eigenvalue is rounding.
    real = values > d * np.finfo(float).eps * max(values[0], 0)
    turn = basis[:, real] / np.sqrt(values[real])
    error, k = 0.0, turn.shape[1]
    if k:
        middle = _summed(vectors, lambda x: (x @ turn).sum(0)[:, None], (k, 1), of)[:, 0] / n
        spread = _summed(vectors, lambda x: (x @ turn - middle).T @ (x @ turn - middle), (k, k), of) / n
        error = float(np.abs(spread - np.eye(k)).max())
    return Whitening(of, np.where(real, values, 0.0), basis, values / trace if trace > 0 else np.zeros(len(values)), error)


def whiten(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE,
           offset: int = OFFSET) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for every usable row and component.

    Vectors are put on a whole-number grid, so means and ``deviation`` (sum of (n*x - S)^2; null beyond a long) are exact. The fit list
    is every row whose vector has no null or non-finite entry; repeated rows and null ids count and are returned like others.
    Entries whose grid value is not below 2^52 in size count as not finite. One covariance needs one length: vectors
    of another length than most (ties: the shorter) take no part. ``whitened`` is null and ``explained`` 0 where a component has no variance,
    which holds for all of a single vector. An empty table gives no rows; other columns are ignored.
    """
    made = StructType([StructField("vec_id", rows.schema[vec_id].dataType), StructField("deviation", LongType()),
                       StructField("white", ArrayType(DoubleType()))])
    clean = rows.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("v")).filter(usable(F.col("v")))
    all_rows = stage(clean.select("vec_id", grid(F.col("v"), scale, offset).alias("x")), "grid")
    most = all_rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if most is None:
        return clean.selectExpr("vec_id", "1 AS component", "0L AS n", "0L AS deviation", "0D AS whitened", "0D AS explained", "0D AS identity_error").limit(0)
    table = all_rows.filter(F.size("x") == most["d"])
    model = fit(table, components)
    of, k = model.of, len(model.values)
    size = np.sqrt(np.where(model.values > 0, model.values, np.inf))
    none = model.values <= 0

    def turned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _rows(batch, "x")
            away = of.deviations(x)
            if away.dtype != object and float(np.abs(away).max()) ** 2 * away.shape[1] >= 2.0 ** 62:
                away = away.astype(object)
            squares = [int(v) if v < 2 ** 63 else None for v in (away * away).sum(axis=1)]
            white = (away / of.n).astype(np.float64) @ model.vectors / size
            mask = np.broadcast_to(none, white.shape).ravel()
            values = pa.array(white.ravel(), pa.float64(), mask=mask)
            lists = pa.ListArray.from_arrays(np.arange(0, len(x) * k + 1, k, dtype=np.int32), values)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(squares, pa.int64()), lists], ["vec_id", "deviation", "white"])

    explained = F.array(*[F.lit(float(e)) for e in model.explained])
    return (table.mapInArrow(turned, made)
            .select("vec_id", "deviation", F.posexplode("white").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).alias("component"), F.lit(of.n).cast("long").alias("n"), "deviation", "whitened",
                    F.get(explained, F.col("at")).alias("explained"), F.lit(model.identity_error).alias("identity_error")))
