"""Embedding whitening by Chebyshev-filtered subspace iteration.

The leading eigenvectors of the covariance are found without forming it: a pass over the
stored vectors gives X'XQ of the centred vectors for a block Q, as a sum of one small matrix
per task. A Chebyshev recurrence over such passes damps the spectrum below the block; then
QR and Rayleigh-Ritz on the driver, whose matrices have (dimension x block) entries,
until the residuals certify the wanted pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpolicy.functions.session import stored
from stockpolicy.llm.common import send_package

SCALE, SHIFT = 1024, 100_000
LARGEST = 2.0**40  # entries above it do not fit the exact sums
GUARD = 24  # directions carried beside the wanted ones
DEGREE = 256  # of a filter at most
GAIN = 1e6  # that a filter is to give the last direction wanted over the unwanted ones
CONTRAST = 1e9  # most that a filter may raise the first direction over the last one wanted
CERTIFIED = 2e-13  # residual over the largest eigenvalue
ROUNDS = 60
ROWS = 1024  # vectors in a stored block


def usable(vector: Column) -> Column:
    """Neither null nor holding null, infinite or NaN entries."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def fixed_point(vector: Column) -> Column:
    """Entries as whole numbers: floor(1024 c) + 100000; an entry beyond 2^40 is an error."""

    def whole(c: Column) -> Column:
        c = c.cast("double")
        too_large = F.raise_error(F.lit("an entry of an embedding exceeds 2^40")).cast("long")
        return F.when(F.abs(c) > LARGEST, too_large).otherwise(F.floor(c * SCALE).cast("long") + SHIFT)

    return F.transform(vector, whole)


def whole_numbers(vectors: DataFrame, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(key, x) of the usable vectors."""
    kept = vectors.filter(usable(F.col(column)))
    return kept.select(F.col(key).alias("key"), fixed_point(F.col(column)).alias("x"))


def _blocks(rows: DataFrame, dim: int) -> DataFrame:
    """(n, x): up to 1024 vectors as one binary of long integers. Their order has no meaning."""

    def pack(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            parts = [x[i : i + ROWS] for i in range(0, len(x), ROWS)]
            yield pa.RecordBatch.from_pydict(
                {"n": pa.array([len(p) for p in parts], pa.int64()), "x": pa.array([p.tobytes() for p in parts], pa.binary())}
            )

    return rows.select("x").mapInArrow(pack, "n long, x binary")


def _summed(blocks: DataFrame, part: Callable[[np.ndarray], np.ndarray], dim: int) -> np.ndarray:
    """Sum over all vectors of a matrix-valued function of a block. Runs a job.

    Each task adds its blocks up and sends one matrix; entries are added by a
    group-by over their numbers, so the driver gets one matrix whatever the number of tasks.
    """

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in it:
            for raw in batch.column("x").to_pylist():
                value = part(np.frombuffer(raw, np.int64).reshape(-1, dim))
                total = value if total is None else total + value
        if total is not None:
            flat = np.ascontiguousarray(total, float).ravel()
            yield pa.RecordBatch.from_pydict({"at": np.arange(len(flat)), "value": flat})

    entries = blocks.mapInArrow(run, "at long, value double")
    rows = entries.groupBy("at").agg(F.sum("value").alias("value")).toArrow().sort_by("at")
    return rows["value"].to_numpy()


@dataclass
class Moments:
    """Exact sums over all vectors: n, S per dimension, and the sum of squares per dimension."""

    n: int
    sums: list[int]
    squares: list[int]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n of whole vectors, from the exact integer n x - S."""
        return self.moved(x) / float(self.n)

    def moved(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact; Python integers where long ones would not do."""
        sums = np.array(self.sums, object)
        largest = max(map(abs, self.sums), default=0)
        if self.n * int(np.abs(x).max(initial=0)) + largest < 2**62:
            return self.n * x - sums.astype(np.int64)
        return self.n * x.astype(object) - sums

    @property
    def trace(self) -> float:
        """Trace of the covariance, from exact sums."""
        n = self.n
        return sum(n * q - s * s for s, q in zip(self.sums, self.squares)) / (n * n) if n else 0.0


def moments(rows: DataFrame) -> Moments:
    """Exact sums of `rows` (x), one row per dimension to the driver. Runs a job."""
    value = F.col("value").cast("decimal(20,0)")
    per_dim = (
        rows.select(F.posexplode("x").alias("at", "value"))
        .groupBy("at")
        .agg(F.count("*").alias("n"), F.sum("value").alias("s"), F.sum(value * value).alias("q"))
        .orderBy("at")
        .collect()
    )
    if not per_dim:
        return Moments(0, [], [])
    return Moments(per_dim[0]["n"], [int(r["s"]) for r in per_dim], [int(r["q"]) for r in per_dim])


@dataclass
class Components:
    """Unit eigenvectors (columns) of the covariance by falling eigenvalue, and how they were found."""

    vectors: np.ndarray
    values: np.ndarray
    residuals: np.ndarray  # norms of V q - e q
    passes: int


def filter_degree(first: float, last: float, low: float, high: float, most: int = DEGREE) -> int:
    """Degree that raises the eigenvalue `last` by GAIN over those in [low, high].

    At most the one whose contrast between `first` and `last` stays bounded: beyond that the
    columns would turn into copies of the first direction.
    """
    mid, half = (high + low) / 2, (high - low) / 2
    first, last = (np.arccosh(max((v - mid) / half, 1.0)) for v in (first, last))
    bounded = np.log(CONTRAST) / max(first - last, 1e-9)
    return int(np.clip(min(np.arccosh(GAIN) / max(last, 1e-9), bounded), 1, most))


def chebyshev_filter(
    apply: Callable[[np.ndarray], np.ndarray], q: np.ndarray, vq: np.ndarray, degree: int, low: float, high: float, top: float
) -> np.ndarray:
    """The scaled Chebyshev polynomial of V on the block q: small on [low, high], growing above it.

    `vq` is V q, known from the Rayleigh-Ritz step; each further degree is one pass.
    """
    mid, half = (high + low) / 2, (high - low) / 2
    first = half / (top - mid)
    sigma, before, now = first, q, (vq - mid * q) * (first / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - sigma)
        after = (apply(now) - mid * now) * (2 * following / half) - before * (sigma * following)
        before, now, sigma = now, after, following
    return now


def leading(apply: Callable[[np.ndarray], np.ndarray], dim: int, wanted: int, seed: int = 0) -> Components:
    """The `wanted` leading eigenpairs of the operator `apply`, certified by their residuals.

    Pairs that are certified already are locked: the filter runs on the others, with the locked directions
    taken out of the operator, so a few large eigenvalues do not hide the rest. Not settling
    within ROUNDS raises. Directions whose eigenvalue is zero to double precision are left
    out, so a covariance of low rank gives fewer.
    """
    width = min(dim, wanted + GUARD)
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, width)))[0]
    passes, best = 0, np.inf

    def counted(block: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        return apply(block)

    for i in range(ROUNDS):
        vq = counted(q)
        small = q.T @ vq
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        top = values[0]
        if not top > 0:
            return Components(np.zeros((dim, 0)), np.zeros(0), np.zeros(0), passes)
        positive = int((values[:wanted] > 1e-12 * top).sum())
        residuals = np.linalg.norm(vq - q * values, axis=0)[:positive]
        good = residuals <= CERTIFIED * top
        if good.all():
            return Components(q[:, :positive], values[:positive], residuals, passes)
        best = min(best, residuals.max())
        locked = int(np.argmin(good))
        if width == dim:  # the block spans the space: Rayleigh-Ritz alone settles it
            q = np.linalg.qr(q)[0]
            continue
        kept = q[:, :locked]

        def deflated(block: np.ndarray) -> np.ndarray:
            image = counted(block - kept @ (kept.T @ block))
            return image - kept @ (kept.T @ image)

        # Unwanted: from zero (a covariance has nothing below) to the block's last value.
        high = max(values[-1], 1e-14 * top)
        degree = filter_degree(values[locked], values[positive - 1], 0.0, high, min(DEGREE, 8 << i))
        rest = chebyshev_filter(deflated, q[:, locked:], vq[:, locked:], degree, 0.0, high, values[locked])
        q = np.linalg.qr(np.hstack([kept, rest]))[0]
    raise RuntimeError(f"eigenvectors not certified: residual {best / top:.1e} of the largest eigenvalue")


@dataclass
class Whitening:
    """A fitted transform: projection of x - S/n on the components over the roots of their eigenvalues."""

    moments: Moments
    components: Components
    identity_error: float

    @property
    def explained(self) -> list[float]:
        return [float(v / self.moments.trace) for v in self.components.values]

    def project(self, x: np.ndarray) -> np.ndarray:
        c = self.components
        return (self.moments.centred(x).astype(float) @ c.vectors) / np.sqrt(c.values)


def fit(rows: DataFrame, wanted: int = 8, seed: int = 0) -> Whitening:
    """Fits on all of `rows` (x), which must be stored: every pass reads them again. Runs jobs."""
    send_package(rows.sparkSession)
    sums = moments(rows)
    n, dim = sums.n, len(sums.sums)
    if not n or not dim:
        return Whitening(sums, Components(np.zeros((dim, 0)), np.zeros(0), np.zeros(0), 0), 0.0)
    blocks = stored(_blocks(rows, dim), "blocks")

    def apply(q: np.ndarray) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            y = sums.centred(x).astype(float)
            return y.T @ (y @ q)

        return _summed(blocks, part, dim).reshape(q.shape) / n

    found = leading(apply, dim, min(wanted, dim), seed)
    made = Whitening(sums, found, 0.0)
    k = len(found.values)
    if k:
        # The whitened rows' sums and products in one matrix: the last row holds the sums.
        def second(x: np.ndarray) -> np.ndarray:
            w = made.project(x)
            return np.vstack([w.T @ w, w.sum(0)])

        both = _summed(blocks, second, dim).reshape(k + 1, k) / n
        covariance = both[:k] - np.outer(both[k], both[k])
        made.identity_error = float(np.abs(covariance - np.eye(k)).max())
    return made


SCHEMA = (
    "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
)


def transform(rows: DataFrame, fitted: Whitening) -> DataFrame:
    """One row per vector of `rows` (key, x) and component."""
    send_package(rows.sparkSession)
    dim, k = len(fitted.moments.sums), len(fitted.components.values)
    n, explained = fitted.moments.n, fitted.explained if k else []

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            m = batch.num_rows
            if not m or not k:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            moved = fitted.moments.moved(x)
            if int(np.abs(moved).max()) ** 2 * dim < 2**62:
                deviation = (moved * moved).sum(1).tolist()
            else:
                exact = moved.astype(object)
                deviation = (exact * exact).sum(1).tolist()
            keys = batch.column("key").take(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [
                    keys,
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n)),
                    pa.array([int(d) for d in deviation], pa.decimal128(38, 0)).take(np.repeat(np.arange(m), k)),
                    pa.array(fitted.project(x).ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, fitted.identity_error)),
                ],
                names=[c.split()[0] for c in SCHEMA.split(", ")],
            )

    return rows.select("key", "x").mapInArrow(run, SCHEMA)


def whitened(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", wanted: int = 8) -> DataFrame:
    """Whitened coordinates of every usable vector: (vec_id, component, n, deviation, ...). Runs jobs.

    Null vectors and those with null or non-finite entries are left out, and so are vectors
    without entries or of another length than most (the longest of equally many). Repeated
    rows count as often as they occur. Components of no variance are left out, so equal
    vectors, one vector or an empty table give no rows. A null key is kept. `deviation` is
    exact, as a decimal. Only the two columns named are read.
    """
    rows = stored(whole_numbers(vectors, key, column), "vectors")
    lengths = rows.groupBy(F.size("x").alias("dim")).count().filter("dim > 0")
    most = lengths.orderBy(F.desc("count"), F.desc("dim")).first()
    rows = rows.filter(F.size("x") == (most["dim"] if most else 0))
    return transform(rows, fit(rows, wanted))
