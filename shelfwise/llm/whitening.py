"""Whitened embeddings by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

The rows X stay where they are. A step is one pass over them: each task multiplies
its rows by the new right vector and its part of the result back by the rows, and
only sums as long as a row return. A left vector has a value per row of the table
and is never stored: it is X times a short vector of coefficients, which is what the
driver keeps of it. Its scalar products with all earlier ones come from the same
pass, so left and right vectors are both orthogonalised against all before them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import Work

COMPONENTS = 32
#: entries are counted in steps of 1 / STEPS and moved by SHIFT
STEPS, SHIFT = 64, 1_000_000
#: what is shorter than this share of the whole matrix has no direction of its own
NOTHING = 1e-12
SEED = 7


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


class Centred:
    """The rows of a kept table (id, x) minus their mean, as a matrix that tasks multiply.

    The mean is base + rest / n in whole numbers, so that no digit is lost before
    the subtraction.
    """

    def __init__(self, rows: DataFrame, width: int) -> None:
        self.rows, self.width = rows, width

        def sums(x: np.ndarray) -> np.ndarray:
            return np.concatenate([[len(x)], x.sum(axis=0)])

        n, *total = self._add(sums, width + 1, "long")
        self.n, self.total = int(n), np.array(total, dtype=np.int64)
        self.base = self.total // max(self.n, 1)
        self.rest = self.total - self.base * self.n
        self.squares = self.sum(lambda c: np.array([np.vdot(c, c)]), 1)[0]

    def _add(self, part: Callable[[np.ndarray], np.ndarray], length: int, kind: str = "double") -> np.ndarray:
        """Sums over all rows of what part makes of a block; a task returns one row per place."""
        width, dtype = self.width, np.int64 if kind == "long" else np.float64

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(length, dtype)
            for batch in batches:
                if batch.num_rows:
                    total += part(_matrix(batch, width))
            yield pa.RecordBatch.from_pydict({"place": np.arange(length, dtype=np.int32), "value": total})

        parts = self.rows.select("x").mapInArrow(run, f"place int, value {kind}")
        found = np.zeros(length, dtype)
        for place, value in parts.groupBy("place").agg(F.sum("value")).collect():
            found[place] = value
        return found

    def centre(self) -> Callable[[np.ndarray], np.ndarray]:
        base, mean = self.base, self.rest / max(self.n, 1)
        return lambda x: (x - base) - mean

    def sum(self, part: Callable[[np.ndarray], np.ndarray], length: int) -> np.ndarray:
        centre = self.centre()
        return self._add(lambda x: part(centre(x)), length)

    def products(self, directions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For u = X y, y the last of the directions: the products of all X directions with u, and Xᵀ u."""
        width, k = directions.shape

        def part(c: np.ndarray) -> np.ndarray:
            left = c @ directions
            return np.concatenate([left.T @ left[:, -1], left[:, -1] @ c])

        found = self.sum(part, k + width)
        return found[:k], found[k:]


def bidiagonal(x: Centred) -> tuple[np.ndarray, np.ndarray]:
    """Singular values of x, falling, and its right singular vectors as columns.

    As many steps as there are dimensions, so that equal and small values are found
    as well; where the Krylov space ends early, a new direction begins another.
    """
    width, scale = x.width, np.sqrt(x.squares)
    rng = np.random.default_rng(SEED)
    right = np.zeros((width, 0))  # columns v
    coefficients, images = np.zeros((width, 0)), np.zeros((width, 0))  # columns y with u = X y, and Xᵀ u
    upper = np.zeros((width, width))

    def cleaned(z: np.ndarray) -> np.ndarray:
        for _ in range(2):
            z = z - right @ (right.T @ z)
        return z

    v, beta = rng.standard_normal(width), 0.0
    for j in range(width):
        v = cleaned(v / np.linalg.norm(v))
        v /= np.linalg.norm(v)
        right = np.column_stack([right, v])
        y = v - beta * coefficients[:, -1] if j else v
        dots, image = x.products(np.column_stack([coefficients, y]))
        known = dots[:-1]
        y, image = y - coefficients @ known, image - images @ known
        alpha = np.sqrt(max(dots[-1] - known @ known, 0.0))
        if alpha <= NOTHING * scale:
            alpha, y, image = 0.0, np.zeros(width), np.zeros(width)
        else:
            y, image = y / alpha, image / alpha
        coefficients, images = np.column_stack([coefficients, y]), np.column_stack([images, image])
        upper[j, j] = alpha
        if j + 1 < width:
            v = cleaned(image - alpha * right[:, j])
            beta = np.linalg.norm(v)
            if beta <= NOTHING * scale:
                v, beta = cleaned(rng.standard_normal(width)), 0.0
            upper[j, j + 1] = beta
    _, values, small = np.linalg.svd(upper)
    return values, right @ small.T


def vectors(table: DataFrame, key: str, vector: str) -> DataFrame:
    """Keys and whole-number vectors of the rows that count.

    Rows go whose vector is null, empty or holds null or non-finite entries, and those
    whose length is not the commonest one (of equally common ones the largest).
    """
    entries = F.col("v")
    fine = F.size(entries) > 0
    fine &= F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    rows = table.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.filter(entries.isNotNull() & F.coalesce(fine, F.lit(False)))
    sizes = rows.groupBy(F.size("v").alias("width")).count().orderBy(F.desc("count"), F.desc("width"))
    width = next((r["width"] for r in sizes.limit(1).collect()), 0)
    whole = F.transform("v", lambda c: F.floor(STEPS * c).cast("long") + F.lit(SHIFT).cast("long"))
    return rows.filter(F.size("v") == width).select("id", whole.alias("x"))


def whitened(
    table: DataFrame, work: Work, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """A row per vector and leading component: the vector's place on it in units of its deviation.

    Returns the key, component (from 1), n (vectors), deviation (the sum over the
    dimensions of (n x - sum)², a long: larger ones are an error), whitened, explained
    (the component's share of the variance) and identity_error (the largest entry of
    the whitened covariance minus the identity, measured by two more passes).
    Components without variance are left out, as nothing can be divided by it; so one
    vector, equal vectors and empty tables return no rows. Null keys and repeated rows
    are rows like others, and other columns are not read. Which vectors count: see
    ``vectors``. Directions of equal variance are any that span their space.
    """
    kept = work.keep(vectors(table, key, vector))
    width = next((len(r["x"]) for r in kept.select("x").limit(1).collect()), 0)
    kind = table.schema[key].dataType.simpleString()
    schema = (
        f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    if not width:
        return table.sparkSession.createDataFrame([], schema).withColumnRenamed("id", key)
    x = Centred(kept, width)
    values, axes = bidiagonal(x)
    count = int((values[:components] > 1e-10 * values[0]).sum()) if values[0] > 0 else 0
    if not count:
        return table.sparkSession.createDataFrame([], schema).withColumnRenamed("id", key)
    axes, variance = axes[:, :count], values[:count] ** 2 / x.n
    to_unit = axes / np.sqrt(variance)
    middle = x.sum(lambda c: (c @ to_unit).sum(axis=0), count) / x.n

    def spread(c: np.ndarray) -> np.ndarray:
        w = c @ to_unit - middle
        return (w.T @ w).ravel()

    covariance = x.sum(spread, count * count).reshape(count, count) / x.n
    error = float(np.abs(covariance - np.eye(count)).max())
    explained = variance / (x.squares / x.n)
    n, base, rest, centre = x.n, x.base, x.rest, x.centre()

    def deviations(whole: np.ndarray) -> np.ndarray:
        far = n * float(np.abs(whole - base).max()) + n
        exact = whole if far * far * width < 2.0**62 else whole.astype(object)
        return ((n * (exact - base) - rest) ** 2).sum(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                whole = _matrix(part, width)
                rows = len(whole)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id").take(pa.array(np.repeat(np.arange(rows), count))),
                        pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), rows)),
                        pa.array(np.full(rows * count, n)),
                        pa.array(np.repeat(deviations(whole), count), pa.int64()),
                        pa.array((centre(whole) @ to_unit).ravel()),
                        pa.array(np.tile(explained, rows)),
                        pa.array(np.full(rows * count, error)),
                    ],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return kept.mapInArrow(run, schema).withColumnRenamed("id", key)
