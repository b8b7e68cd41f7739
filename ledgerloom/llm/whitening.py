"""Embedding whitening by Chebyshev-filtered subspace iteration.

The leading eigenvectors of the covariance are found without building it. A block of ``BLOCK`` vectors Q is filtered:
a Chebyshev polynomial of V, applied by its recurrence, is small on the unwanted spectrum and grows fast above it.
Every step of the recurrence is one distributed pass that multiplies the centred rows X by Q and the result by X',
and adds up d rows of sums. After a cycle Q is made orthonormal (QR), the Rayleigh-Ritz values and vectors are taken
from the same product that starts the next cycle, and the residuals |VQ - Qe| certify them: by their ratio to the
gap to the next value (``ANGLE``), or, where values are equal or nearly so, by having reached rounding level
(``ROUNDING``) without getting smaller. One more column of every pass runs a Lanczos recurrence, which gives the lower
end of the unwanted spectrum; its upper end is the least Ritz value of the block. The degree of a cycle is kept so
low that the largest value does not drown the last wanted one (``MOST_GROWTH``).

Components are whole numbers and the covariance is over the distinct vectors, so counts, sums and squares are exact.
Driver and tasks hold d x (BLOCK + 1) numbers, whatever the number of rows.

* rows whose vector is null or holds null or non-finite components are dropped; a null vec_id stays null;
* each vector length is fitted for itself, one after the other; repeated rows weigh once but all get results;
* components whose eigenvalue is zero (to rounding) cannot be scaled and are left out: constant, single and zero
  vectors get no rows; nor do empty vectors; fewer than four dimensions give fewer components;
* a deviation beyond long is null; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import Scratch
from ledgerloom.llm.whole_vectors import LONG, finite, largest, matrix, whole_numbers

COMPONENTS = 4
BLOCK = 24
DEGREE = 12
MOST_GROWTH = 1e10
ANGLE = 1e-12
ROUNDING = 1e-13
ZERO = 1e-12  # of the trace: below it an eigenvalue is rounding
MOST_PASSES = 5000
SEED = 12
SHAPE = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


class NotCertified(ArithmeticError):
    """The passes allowed did not bring the residuals down."""


@dataclass(frozen=True)
class Fit:
    """Exact counts and sums, and the leading eigenvectors as columns; ``passes`` over the rows were made."""

    n: int
    sums: np.ndarray
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    passes: int

    @property
    def centre(self) -> np.ndarray:
        return np.array([int(one) / self.n for one in self.sums])


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum and sum of squares of every component, as exact decimals in text."""
    sums, squares = 0, 0
    for batch in batches:
        rows = matrix(batch.column("x"))
        if len(rows):
            whole = rows if largest(rows) ** 2 * len(rows) < 1 << 63 else rows.astype(object)
            sums = sums + whole.sum(axis=0).astype(object)
            squares = squares + (whole * whole).sum(axis=0).astype(object)
    if not isinstance(sums, int):
        columns = [pa.array(range(len(sums)), pa.int32()), pa.array(map(str, sums), pa.string()), pa.array(map(str, squares), pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["place", "total", "square"])


def moments(fitted: DataFrame) -> tuple[int, np.ndarray, float]:
    """Number of rows, exact sums per component, and the trace of the covariance."""
    n = fitted.count()
    parts = fitted.select("x").mapInArrow(_moments, "place int, total string, square string")
    exact = [F.sum(F.col(name).cast("decimal(38,0)")).alias(name) for name in ("total", "square")]
    rows = sorted(parts.groupBy("place").agg(*exact).collect())  # a row per component
    sums = np.array([int(row["total"]) for row in rows], object)
    trace = sum(n * int(row["square"]) - int(row["total"]) ** 2 for row in rows) / (n * n)
    return n, sums, trace


def _product(centre: np.ndarray, block: np.ndarray):
    """Sums of X'(XQ) over the centred rows X of a task: one row per component."""

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(block.shape)
        for batch in batches:
            rows = matrix(batch.column("x")) - centre if batch.num_rows else None
            if rows is not None:
                total += rows.T @ (rows @ block)
        names = ["place", *[f"c{k}" for k in range(block.shape[1])]]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), *map(pa.array, total.T.copy())], names)

    return multiplied


def covariance_times(fitted: DataFrame, n: int, centre: np.ndarray, block: np.ndarray) -> np.ndarray:
    """V Q in one pass: d rows of sums come back."""
    names = [f"c{k}" for k in range(block.shape[1])]
    shape = ", ".join(["place int", *[f"{name} double" for name in names]])
    parts = fitted.select("x").mapInArrow(_product(centre, np.ascontiguousarray(block)), shape)
    rows = parts.groupBy("place").agg(*[F.sum(name).alias(name) for name in names]).collect()
    total = np.zeros(block.shape)
    for row in rows:
        total[row["place"]] = row[1:]
    return total / n


class Lanczos:
    """Estimates of both ends of the spectrum from one vector, a step with every pass."""

    def __init__(self, start: np.ndarray):
        self.basis, self.alphas, self.betas, self.done = [start / np.linalg.norm(start)], [], [], False

    @property
    def ask(self) -> np.ndarray:
        return self.basis[len(self.alphas)] if not self.done else self.basis[0]

    def take(self, product: np.ndarray) -> None:
        if self.done:
            return
        basis = np.array(self.basis)
        self.alphas.append(float(self.basis[-1] @ product))
        rest = product - basis.T @ (basis @ product)
        rest -= basis.T @ (basis @ rest)
        size = float(np.linalg.norm(rest))
        self.betas.append(size)
        if size <= 1e-10 * abs(self.alphas[0]) or len(self.basis) == len(rest):
            self.done = True
        else:
            self.basis.append(rest / size)

    def least(self) -> float:
        """Below the spectrum, up to what the steps so far can tell."""
        if not self.alphas:
            return 0.0
        steps = np.diag(self.alphas) + np.diag(self.betas[:-1], 1) + np.diag(self.betas[:-1], -1)
        values, vectors = np.linalg.eigh(steps)
        return max(0.0, float(values[0] - abs(self.betas[-1] * vectors[-1, 0])))


def certified(values: np.ndarray, residuals: np.ndarray, before: np.ndarray | None, count: int) -> bool:
    """Whether the first ``count`` Ritz pairs are right: by their gaps, or at rounding level and at rest."""
    for place in range(count):
        others = np.delete(values, place)
        gap = np.abs(others - values[place]).min(initial=np.inf)
        if residuals[place] <= ANGLE * gap:
            continue
        at_rest = before is not None and residuals[place] > before[place] / 2
        if not (residuals[place] <= ROUNDING * values[0] and at_rest) and residuals[place] > 0:
            return False
    return True


def fit(fitted: DataFrame, count: int = COMPONENTS) -> Fit:
    """Leading eigenvectors of the covariance of the distinct rows ``fitted`` (column x), all of one length."""
    n, sums, trace = moments(fitted)
    centre = np.array([int(one) / n for one in sums])
    size, passes = len(sums), 0
    count, width = min(count, size), min(size, max(BLOCK, 2 * count))
    nothing = Fit(n, sums, trace, np.zeros(0), np.zeros((size, 0)), np.zeros(0), 0)
    if trace <= 0:
        return nothing
    random = np.random.default_rng([SEED, size])
    block = np.linalg.qr(random.standard_normal((size, width)))[0]
    lanczos = Lanczos(random.standard_normal(size))

    def times(columns: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        if passes > MOST_PASSES:
            raise NotCertified(f"{passes - 1} passes: residuals {residuals} of values {values}")
        product = covariance_times(fitted, n, centre, np.hstack([columns, lanczos.ask[:, None]]))
        lanczos.take(product[:, -1])
        return product[:, :-1]

    before, seen, values, residuals = None, math.inf, None, None
    while True:
        product = times(block)
        inner = block.T @ product
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        block, product = block @ turn, product @ turn
        residuals = np.linalg.norm(product - block * values, axis=0)
        # values that are zero get no component; a block that spans the whole space is exact
        wanted = int((values[:count] > ZERO * trace).sum())
        if width == size or certified(values, residuals, before, wanted):
            break
        before = residuals
        # the unwanted spectrum; a Ritz value below it shows that its lower end was set too high
        seen = min(seen, float(values[-1]))
        high, low = max(float(values[-1]), 0.0), max(min(seen, lanczos.least()), 0.0)
        middle, half = (high + low) / 2, max((high - low) / 2, 1e-6 * high, ZERO * trace)
        growth = [math.acosh(max(1.0, (float(value) - middle) / half)) for value in (values[0], values[wanted - 1])]
        degree = max(1, min(DEGREE, int(math.log(MOST_GROWTH) / max(growth[0] - growth[1], 1e-9))))
        earlier, now = block, (product - middle * block) / half
        for _ in range(degree - 1):
            later = 2 * (times(now) - middle * now) / half - earlier
            scale = np.linalg.norm(later, axis=0)
            earlier, now = now / scale, later / scale
        block = np.linalg.qr(now)[0]
    kept = [place for place in range(count) if values[place] > ZERO * trace]
    return Fit(n, sums, trace, values[kept], block[:, kept], residuals[kept], passes)


def whitened(rows: np.ndarray, found: Fit) -> np.ndarray:
    """Centred rows on the components, each scaled to variance one."""
    return (rows - found.centre) @ found.vectors / np.sqrt(found.values)


def identity_error(fitted: DataFrame, found: Fit) -> float:
    """Largest absolute entry of (covariance of the whitened rows - identity), centred in a pass of its own."""
    count = len(found.values)

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(count)
        for batch in batches:
            if batch.num_rows:
                total += whitened(matrix(batch.column("x")), found).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(count)), pa.array(total)], ["place", "value"])

    shape = "place long, value double"
    added = fitted.select("x").mapInArrow(totals, shape).groupBy("place").agg(F.sum("value").alias("value")).collect()
    mean = np.zeros(count)
    for row in added:
        mean[row["place"]] = row["value"] / found.n

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((count, count))
        for batch in batches:
            if batch.num_rows:
                off = whitened(matrix(batch.column("x")), found) - mean
                total += off.T @ off
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(count**2)), pa.array(total.ravel())], ["place", "value"])

    added = fitted.select("x").mapInArrow(squares, shape).groupBy("place").agg(F.sum("value").alias("value")).collect()
    covariance = np.zeros(count**2)
    for row in added:
        covariance[row["place"]] = row["value"] / found.n
    return float(np.abs(covariance.reshape(count, count) - np.eye(count)).max())


def deviations(rows: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Exact squared distance of every row from the centre, times n squared; None beyond long."""
    most = n * largest(rows) + max(abs(int(one)) for one in sums)
    if most**2 * rows.shape[1] < 1 << 63:
        off = n * rows - sums.astype(np.int64)
        return (off * off).sum(axis=1).tolist()
    off = n * rows.astype(object) - sums
    return [one if one <= LONG.max else None for one in (off * off).sum(axis=1)]


def _projected(found: Fit, error: float):
    """A row per input row and component."""

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, names = len(found.values), [part.split()[0] for part in SHAPE.split(", ")]
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = matrix(batch.column("x"))
            total = len(rows) * count
            far = np.repeat(np.array(deviations(rows, found.n, found.sums), object), count)
            columns = [
                batch.column("vec_id").take(pa.array(np.repeat(np.arange(len(rows)), count))),
                pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(rows))),
                pa.array(np.full(total, found.n)),
                pa.array(far.tolist(), pa.int64()),
                pa.array(whitened(rows, found).ravel()),
                pa.array(np.tile(found.values / found.trace, len(rows))),
                pa.array(np.full(total, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    return projected


def whiten(vectors: DataFrame, count: int = COMPONENTS) -> DataFrame:
    """One row per row of ``vectors`` and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    rows = vectors.where(finite(vectors["embedding"])).select(
        vectors["vec_id"].cast("long").alias("vec_id"), whole_numbers(vectors["embedding"]).alias("x")
    )
    rows = scratch.store(rows.where(F.size("x") > 0), "rows")
    distinct = scratch.store(rows.select("x").distinct(), "distinct")
    sizes = [row["size"] for row in distinct.select(F.size("x").alias("size")).distinct().orderBy("size").collect()]  # lengths
    results = spark.createDataFrame([], SHAPE)
    for size in sizes:
        fitted, own = (one.where(F.size("x") == size) if len(sizes) > 1 else one for one in (distinct, rows))
        found = fit(fitted, count)
        if len(found.values):
            results = results.unionByName(own.mapInArrow(_projected(found, identity_error(fitted, found)), SHAPE))
    return results
