"""Whitening of embeddings on their leading principal components.

The components are found by Chebyshev-filtered subspace iteration. A block of directions
is multiplied by the covariance in distributed passes: each task computes XᵀXQ for its
blocks of centred vectors, and only sums of the width of the block come back. A Chebyshev
polynomial of the covariance, built by its three-term recurrence, damps the part of the
spectrum below the block and blows up the part above. QR and a Rayleigh-Ritz step turn the
filtered block into approximate eigenvectors, until the residuals of the wanted ones
certify them. The covariance itself, whose size is the square of the dimension, is never
made.

Vectors are fitted as whole numbers, each distinct one once. They are written as dense
blocks of the narrowest whole-number type, which tasks read without touching single rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from olapflow.llm.base import stored

#: Components returned, fixed-point steps of one, directions of the filtered block and of
#: the small one that looks for the low end of the spectrum, degree of the polynomial.
COMPONENTS, STEPS, BLOCK, LOW_BLOCK, DEGREE = 4, 256, 32, 4, 8

#: Residual, relative to the largest eigenvalue, at which a component is certified; what is
#: accepted when rounding stops further progress; rounds after which fitting gives up.
CERTIFIED, STALLED, ROUNDS = 2e-13, 1e-10, 200

#: Bytes of 64-bit entries in one block of the fit table.
_BLOCK_BYTES = 4 << 20
_LIMIT = 2.0**63 - 1024  # the largest double below 2^63
_KINDS = ("<i2", "<i4", "<i8")


@dataclass
class Components:
    """A fit: ``n`` distinct vectors with exact sums ``sums``; unit eigenvectors (columns)
    by falling ``values``; ``trace`` of the covariance; relative ``residuals``; passes over
    the fit table."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    residuals: np.ndarray = field(default_factory=lambda: np.zeros(0))
    passes: int = 0

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def scales(self) -> np.ndarray:
        """1 over the deviation along each component; NaN without variance."""
        flat = self.values <= 1e-14 * max(self.trace, 0.0)
        return 1.0 / np.sqrt(np.where(flat, np.nan, self.values))


def _valid(vector: str):
    """Vectors without nulls and non-finite entries."""
    def usable(c):
        value = c.cast("double")
        return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))

    return F.col(vector).isNotNull() & F.forall(vector, usable)


def _whole(vectors: pa.Array, dims: int, steps: int) -> np.ndarray:
    """Rows of floor(steps * entry), short vectors filled up with zeros. Values beyond 64
    bits become the nearest one that a double holds."""
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = np.floor(vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False) * float(steps))
    flat = np.clip(flat, -_LIMIT, _LIMIT).astype(np.int64)
    if (sizes == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(sizes), dims), np.int64)
    out[np.arange(dims) < sizes[:, None]] = flat
    return out


def _width(rows: np.ndarray) -> np.ndarray:
    """Index of the narrowest type that holds each row."""
    low, high = rows.min(axis=1, initial=0), rows.max(axis=1, initial=0)
    narrow = [(low >= np.iinfo(k).min) & (high <= np.iinfo(k).max) for k in _KINDS[:2]]
    return np.where(narrow[0], 0, np.where(narrow[1], 1, 2))


def fit_table(vectors: DataFrame, vector: str, dims: int, steps: int = STEPS) -> DataFrame:
    """Distinct whole-number vectors in dense blocks, with exact sums of each block. The
    vectors are compared as bytes, so one shuffle of the narrow form removes the repeats."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _whole(batch.column(0), dims, steps)
            width = _width(rows)
            packed = [r.astype(_KINDS[w]).tobytes() for r, w in zip(rows, width.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()), pa.array(width, pa.int32())], ["x", "width"])

    limit = max(1, _BLOCK_BYTES // (8 * max(dims, 1)))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[bytes]] = [[] for _ in _KINDS]

        def emit(w: int) -> pa.RecordBatch:
            rows = np.frombuffer(b"".join(held[w]), _KINDS[w]).reshape(len(held[w]), dims).astype(np.int64)
            high, low = rows >> 32, rows & 0xFFFFFFFF  # halves, whose sums fit 64 bits
            out = pa.RecordBatch.from_arrays(
                [pa.array([w], pa.int32()), pa.array([len(held[w])], pa.int64()), pa.array([b"".join(held[w])], pa.binary()),
                 pa.array([high.sum(axis=0).tolist()], pa.list_(pa.int64())), pa.array([low.sum(axis=0).tolist()], pa.list_(pa.int64()))],
                ["width", "n", "data", "high", "low"],
            )
            held[w].clear()
            return out

        for batch in batches:
            for x, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held[w].append(x)
                if len(held[w]) == limit:
                    yield emit(w)
        for w in range(len(_KINDS)):
            if held[w]:
                yield emit(w)

    distinct = vectors.select(vector).mapInArrow(encode, "x binary, width int").distinct()
    made = distinct.mapInArrow(blocks, "width int, n long, data binary, high array<long>, low array<long>")
    return stored(made, "whitening")


def _exact_sums(table: DataFrame, dims: int) -> tuple[int, list[int]]:
    n = table.agg(F.sum("n")).first()[0] or 0
    halves = table.select(F.posexplode(F.arrays_zip("high", "low")).alias("i", "s")).groupBy("i").agg(
        *[F.sum(F.col(f"s.{h}").cast("decimal(38,0)")).alias(h) for h in ("high", "low")]
    )
    sums = [0] * dims
    for row in halves.collect():
        sums[row.i] = (int(row.high) << 32) + int(row.low)
    return n, sums


def summed(table: DataFrame, mean: np.ndarray, make: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """Sum over the blocks of a small matrix made from each centred block: one pass. Tasks
    add up their own blocks, Spark the tasks' rows."""
    rows, columns = shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            for width, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                whole = np.frombuffer(data, _KINDS[width]).reshape(-1, len(mean))
                total += make(whole - mean)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(rows), pa.int32()), *[pa.array(total[:, c]) for c in range(columns)]],
            ["i", *[f"c{c}" for c in range(columns)]],
        )

    names = [f"c{c}" for c in range(columns)]
    schema = T.StructType([T.StructField("i", T.IntegerType()), *[T.StructField(c, T.DoubleType()) for c in names]])
    parts = table.select("width", "data").mapInArrow(run, schema)
    out = np.zeros(shape)
    for row in parts.groupBy("i").agg(*[F.sum(c).alias(c) for c in names]).collect():
        out[row[0]] = row[1:]
    return out


def _ritz(basis: np.ndarray, image: np.ndarray):
    """Ritz values (falling) and vectors of an orthonormal basis, with their images."""
    small = basis.T @ image
    values, turn = np.linalg.eigh((small + small.T) / 2)
    turn = turn[:, ::-1]
    return values[::-1], basis @ turn, image @ turn


def fit(
    vectors: DataFrame, vector: str, components: int = COMPONENTS, steps: int = STEPS, block: int = BLOCK,
    degree: int = DEGREE, seed: int = 11,
) -> tuple[Components, DataFrame | None]:
    """Leading components of the covariance of the distinct whole-number vectors, and the
    fit table. Rows without a usable vector must be gone.

    Certified means that every wanted component's residual is below ``CERTIFIED`` times the
    largest eigenvalue (or, once rounding lets it fall no more, below ``STALLED``). The
    last direction of the block is drawn anew in every round, so that a component the
    first draw missed comes up as well.
    """
    found = vectors.agg(F.max(F.size(vector)), F.count(vector)).first()
    dims, rows = found[0] or 0, found[1]
    if not rows or not dims:
        return Components(0, [0] * dims, np.zeros((dims, 0)), np.zeros(0), 0.0), None
    table = fit_table(vectors, vector, dims, steps)
    n, sums = _exact_sums(table, dims)
    mean = np.array([s / n for s in sums])
    wanted, size = min(components, dims), min(block, dims)
    low_size = min(LOW_BLOCK, dims)
    passes = 0

    def times(basis: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        return summed(table, mean, lambda x: x.T @ (x @ basis), basis.shape) / n

    trace = float(summed(table, mean, lambda x: np.array([[np.vdot(x, x)]]), (1, 1))[0, 0]) / n
    rng = np.random.default_rng(seed)
    basis = np.linalg.qr(rng.standard_normal((dims, size)))[0]
    low = np.linalg.qr(rng.standard_normal((dims, low_size)))[0]
    best = math.inf
    for _ in range(ROUNDS):
        image = times(np.hstack([basis, low]))
        image, low_image = image[:, :size], image[:, size:]
        values, basis, image = _ritz(basis, image)
        top = max(values[0], 0.0)
        residuals = np.linalg.norm(image[:, :wanted] - basis[:, :wanted] * values[:wanted], axis=0)
        worst = float(residuals.max()) / top if top > 0 else 0.0
        if worst <= CERTIFIED or size == dims or (worst <= STALLED and worst > best / 2):
            break
        best = min(best, worst)
        # the spectrum to damp: from the low end found so far up to the block's last value
        low_values, low, low_image = _ritz(low, low_image)
        slack = float(np.linalg.norm(low_image[:, -1] - low[:, -1] * low_values[-1]))
        floor, upto = max(0.0, low_values[-1] - slack), max(values[-1], 1e-12 * top)
        floor = min(floor, 0.95 * upto)
        centre, half = (floor + upto) / 2, (upto - floor) / 2
        sigma = first = half / (top - centre)
        before, now = basis, (image - centre * basis) * (first / half)
        # powers of the reversed spectrum, for the low end, ride on the same passes
        low = np.linalg.qr(1.01 * top * low - low_image)[0]
        for _ in range(degree - 1):
            image = times(np.hstack([now, low]))
            following = 1.0 / (2.0 / first - sigma)
            before, now = now, 2.0 * following / half * (image[:, :size] - centre * now) - sigma * following * before
            sigma = following
            low = np.linalg.qr(1.01 * top * low - image[:, size:])[0]
        fresh = rng.standard_normal((dims, 1))
        basis = np.linalg.qr(np.hstack([now[:, :-1], fresh]))[0]
    else:
        raise RuntimeError(f"components not certified after {passes} passes: residuals {residuals}")
    fitted = Components(n, sums, basis[:, :wanted], np.maximum(values[:wanted], 0.0), trace, residuals / (top or 1.0), passes)
    return fitted, table


def identity_error(fitted: Components, table: DataFrame) -> float | None:
    """Largest entry of the whitened fit list's covariance minus the identity, over the
    components that have variance; null if none has."""
    scales = fitted.scales
    usable = np.flatnonzero(~np.isnan(scales))
    if not len(usable):
        return None
    project = fitted.vectors[:, usable] * scales[usable]
    gram = summed(table, fitted.mean, lambda x: (x @ project).T @ (x @ project), (len(usable), len(usable))) / fitted.n
    return float(np.abs(gram - np.eye(len(usable))).max())


def _deviations(rows: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over the dimensions of (n * x - S)^2, exactly; None beyond 64 bits."""
    reach = float(np.abs(rows.astype(np.float64)).max(initial=0)) * n + max((abs(s) for s in sums), default=0)
    if reach * reach * max(rows.shape[1], 1) < 2.0**62:
        away = rows * n - np.array(sums, np.int64)
        return (away * away).sum(axis=1).tolist()
    exact = [sum((n * x - s) ** 2 for x, s in zip(row, sums, strict=True)) for row in rows.tolist()]
    return [d if d < 1 << 63 else None for d in exact]


def whiten(
    embeddings: DataFrame, vector: str = "embedding", components: int = COMPONENTS, steps: int = STEPS, block: int = BLOCK,
    degree: int = DEGREE,
) -> DataFrame:
    """Rows of ``embeddings`` with a usable vector, once per component, with ``component``
    (from 1), ``n``, ``deviation``, ``whitened``, ``explained`` and ``identity_error``.

    A vector that is null or holds null or non-finite entries drops its row. Entries
    become x = floor(steps * entry), beyond 64 bits the nearest double's value. Vectors
    shorter than the longest are filled up with zeros. ``n`` distinct x vectors are
    fitted. There are as many components as dimensions if those are fewer. A component
    without variance (vectors in a subspace, or all alike) has a null ``whitened``; without
    any variance ``explained`` is null too. ``deviation`` is exact, and null where it
    exceeds 64 bits. Components of equal eigenvalues are one of many valid choices. Repeated
    rows come out as often as they come in; an empty table, or one without usable vectors
    or dimensions, gives an empty result. Input columns with the names of added ones are
    replaced.
    """
    added = [
        T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
        T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()),
        T.StructField("identity_error", T.DoubleType()),
    ]
    names = [c for c in embeddings.columns if c not in {f.name for f in added}]
    if vector not in names:
        raise ValueError(f"the vector column cannot be called {vector}")
    usable = embeddings.where(_valid(vector)).select(*names)
    fitted, table = fit(usable, vector, components, steps, block, degree)
    schema = T.StructType([*usable.schema.fields, *added])
    if table is None:
        return usable.limit(0).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in added])
    error = identity_error(fitted, table)
    project = fitted.vectors * fitted.scales
    count, dims = fitted.vectors.shape[1], len(fitted.sums)
    explained = [float(v) / fitted.trace if fitted.trace > 0 else None for v in fitted.values]
    n, sums, mean, at = fitted.n, fitted.sums, fitted.mean, names.index(vector)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _whole(batch.column(at), dims, steps)
            white = (rows - mean) @ project
            again = pa.array(np.repeat(np.arange(len(rows)), count))
            own = [batch.column(i).take(again) for i in range(batch.num_columns)]
            values = pa.array(white.reshape(-1), mask=np.isnan(white).reshape(-1))
            deviations = pa.array(_deviations(rows, n, sums), pa.int64()).take(again)
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(np.tile(np.arange(1, count + 1), len(rows)), pa.int32()), pa.array([n] * len(again), pa.int64()),
                 deviations, values, pa.array(explained * len(rows), pa.float64()), pa.array([error] * len(again), pa.float64())],
                schema.names,
            )

    return usable.mapInArrow(run, schema)
