"""Whitened leading components of an embedding table.

Vectors become integers, so their sums are exact. One pass sums them; a second one
centres every vector before it multiplies and adds up the covariance by matrix row;
the driver, which holds one matrix of the vectors' dimension, finds the leading
eigenpairs; further passes project with a broadcast matrix of that dimension.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.llm import eigen

# Entries become floor(SCALE * c) + SHIFT.
SCALE = 1024
SHIFT = 100_000
# Sums of tasks are added up in so many places before the driver adds those.
LANES = 64
_LARGEST = 2.0**40


@dataclass(frozen=True)
class Whitening:
    """What a projection needs: number of vectors, their sums, components as columns."""

    n: int
    sums: list[int]
    values: np.ndarray
    trace: float
    projection: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x`` minus its mean, from exact differences."""
        return self.apart(x).astype(float) / self.n

    def apart(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sums`` without rounding."""
        if self.n * (int(np.abs(x).max(initial=0)) + 1) < 2**61:
            return self.n * x - np.array(self.sums, dtype=np.int64)
        return self.n * x.astype(object) - np.array(self.sums, dtype=object)


def _complete(vector: Column) -> Column:
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False))


def complete_vectors(table: DataFrame) -> DataFrame:
    """``(vec_id, embedding)`` of rows whose vector is finite throughout and of the usual length.

    The usual length is that of most such vectors (of equally frequent ones, the longest).
    """
    vector = F.col("embedding").cast("array<double>")
    read = table.select(F.col("vec_id").cast("long"), vector.alias("embedding")).where(_complete(F.col("embedding")))
    length = F.size("embedding")
    usual = read.groupBy(length.alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    return read.where(length == (usual.length if usual else 0))


def _integers(column: pa.Array, length: int) -> np.ndarray:
    entries = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)
    if len(entries) and np.abs(entries).max() >= _LARGEST:
        raise ValueError(f"entries of {_LARGEST:g} or more have no exact sums")
    return np.floor(SCALE * entries).astype(np.int64) + SHIFT


def _added(partials: DataFrame, kind: str) -> DataFrame:
    """Sums of ``(key, part)`` arrays by key; a task holds the sums of its own keys only."""
    schema = pa.schema([("key", pa.int32()), ("part", pa.list_(pa.int64() if kind == "long" else pa.float64()))])

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for key, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = part.values.to_numpy()
                held[key] = held[key] + values if key in held else values.copy()
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array(held, type=pa.int32()), pa.array(list(held.values()), type=schema.field("part").type)],
                schema=schema,
            )

    return partials.repartition("key").mapInArrow(summed, f"key int, part array<{kind}>")


def _partials(vectors: DataFrame, length: int, made: Callable[[np.ndarray], np.ndarray], kind: str) -> DataFrame:
    """The rows of the matrices that ``made`` gives, added up within each task."""
    parts = pa.list_(pa.int64() if kind == "long" else pa.float64())
    schema = pa.schema([("key", pa.int32()), ("part", parts)])

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                matrix = made(_integers(batch.column(0), length))
                total = matrix if total is None else total + matrix
        for key, row in enumerate(() if total is None else total):
            yield pa.RecordBatch.from_arrays([pa.array([key], type=pa.int32()), pa.array([row], type=parts)], schema=schema)

    return vectors.select("embedding").mapInArrow(summed, f"key int, part array<{kind}>")


def _sums(vectors: DataFrame, length: int) -> tuple[int, list[int]]:
    """Number of vectors and sums by dimension, both exact."""

    def made(x: np.ndarray) -> np.ndarray:
        return np.append(x.sum(axis=0), len(x))[None, :]

    partials = _partials(vectors, length, made, "long").withColumn(
        "key", F.pmod(F.spark_partition_id(), F.lit(LANES)).cast("int")
    )
    lanes = [np.array(row.part, dtype=object) for row in _added(partials, "long").collect()]
    total = sum(lanes) if lanes else np.zeros(length + 1, dtype=object)
    return int(total[-1]), [int(v) for v in total[:-1]]


def _matrix(vectors: DataFrame, length: int, made: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    rows = _added(_partials(vectors, length, made, "double"), "double").collect()
    return np.array([row.part for row in sorted(rows, key=lambda row: row.key)])


def fit(vectors: DataFrame, length: int, components: int = 8) -> Whitening | None:
    """The whitening of all ``vectors``, which ``complete_vectors`` gave; None without any."""
    n, sums = _sums(vectors, length)
    if not n:
        return None
    centre = Whitening(n, sums, np.empty(0), 0.0, np.empty((length, 0)))
    sent = vectors.sparkSession.sparkContext.broadcast(centre)

    def squared(x: np.ndarray) -> np.ndarray:
        z = sent.value.centred(x)
        return z.T @ z

    covariance = _matrix(vectors, length, squared) / n
    trace = float(np.trace(covariance))
    values, rows = eigen.leading(covariance, components)
    # A direction in which nothing but rounding varies cannot be scaled to one.
    varies = values > trace * length * np.finfo(float).eps
    scaled = np.where(varies, values, np.nan)
    with np.errstate(invalid="ignore"):
        projection = rows.T / np.sqrt(scaled)
    return Whitening(n, sums, np.maximum(values, 0.0), trace, projection)


def identity_error(vectors: DataFrame, length: int, fitted: Whitening) -> float | None:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""
    varies = ~np.isnan(fitted.projection).any(axis=0)
    if not varies.any():
        return None
    sent = vectors.sparkSession.sparkContext.broadcast(fitted)

    def squared(x: np.ndarray) -> np.ndarray:
        own = sent.value
        w = own.centred(x) @ own.projection[:, varies]
        return np.vstack([w.T @ w, w.sum(axis=0)])

    total = _matrix(vectors, length, squared) / fitted.n
    # The vectors are centred already; what is left of their mean is rounding.
    covariance = total[:-1] - np.outer(total[-1], total[-1])
    return float(np.abs(covariance - np.eye(int(varies.sum()))).max())


_RESULT = (
    "vec_id long, component int, n long, deviation decimal(38,0), whitened double, "
    "explained double, identity_error double"
)


def whitened(table: DataFrame, components: int = 8) -> DataFrame:
    """A row for each complete vector and each of its first ``components`` components.

    table: ``vec_id`` and ``embedding``. Left out are null and empty vectors, those
    with a null, infinite or undefined entry, and those of another length than most.
    ``deviation`` is the sum over dimensions of ``(n * x - sum)^2``, exact as a
    decimal. ``whitened`` is null for components without variance (one vector only,
    equal vectors, fewer independent vectors than components); ``explained`` is then 0,
    and ``identity_error`` is null if no component varies. Repeated rows and rows
    without id count and return each for itself. An empty table gives no rows. Entries
    of 2^40 or more are an error, as their sums would not be exact. Other columns are
    ignored.
    """
    spark = table.sparkSession
    vectors = complete_vectors(table)
    first = vectors.select(F.size("embedding").alias("length")).first()
    length = first.length if first else 0
    fitted = fit(vectors, length, components) if length else None
    if fitted is None:
        return spark.createDataFrame([], _RESULT)
    error = identity_error(vectors, length, fitted)
    shares = fitted.values / fitted.trace if fitted.trace > 0 else np.zeros(len(fitted.values))
    sent = spark.sparkContext.broadcast(fitted)
    schema = pa.schema(
        [
            ("vec_id", pa.int64()),
            ("component", pa.int32()),
            ("n", pa.int64()),
            ("deviation", pa.decimal128(38, 0)),
            ("whitened", pa.float64()),
            ("explained", pa.float64()),
            ("identity_error", pa.float64()),
        ]
    )

    def projected(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        count = own.projection.shape[1]
        for batch in batches:
            x = _integers(batch.column(1), length)
            if not len(x):
                continue
            w = (own.centred(x) @ own.projection).ravel()
            rows = len(x)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(np.arange(rows), count))),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * count, own.n)),
                    _squares(own.apart(x)).take(pa.array(np.repeat(np.arange(rows), count))),
                    pa.array(w, mask=np.isnan(w)),
                    pa.array(np.tile(shares, rows)),
                    pa.array([error] * (rows * count), type=pa.float64()),
                ],
                schema=schema,
            )

    return vectors.mapInArrow(projected, _RESULT)


def _squares(apart: np.ndarray) -> pa.Array:
    """Row sums of squares, exact."""
    most = int(np.abs(apart).max(initial=0))
    if apart.dtype != object and most * most * apart.shape[1] < 2**63:
        return pa.array((apart * apart).sum(axis=1)).cast(pa.decimal128(38, 0))
    exact = (apart.astype(object) ** 2).sum(axis=1)
    return pa.array([Decimal(int(v)) for v in exact], type=pa.decimal128(38, 0))
