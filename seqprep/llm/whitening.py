"""Embedding whitening by Chebyshev-filtered subspace iteration.

Entries become integers (``floor(256 * c)``). Each distinct vector once is the
fit list: it is written to the shared folder and every pass reads it there. A
pass multiplies a block Q of trial vectors by the covariance without ever
forming it: each task sums its part of ``Xc^T (Xc Q)``, Xc centred, and only
those matrices (dimension x block) meet. A Chebyshev polynomial of the
covariance, made by its three-term recurrence with one pass per degree, damps
the spectrum below the block's smallest Ritz value; QR and Rayleigh-Ritz follow.
That goes on until the residuals ``|V q - e q|`` of the wanted pairs are at the
rounding error, which certifies them.

Bounds: the driver and each task hold matrices of dimension x (components +
``GUARD``) numbers and one batch of vectors. Equal vectors are combined before the
shuffle, so a vector that makes up a third of the rows costs one row per task. A
lost executor costs the tasks of one pass.

Defined results: rows whose vector is null, empty, or holds null or non-finite
entries are dropped, and rows whose length is not the most frequent one among the
distinct vectors (ties: the longest). Repeated rows are returned each, rows
without id too. There are at most as many components as the fit list has
directions that vary: one distinct vector, or none, gives no row. Entries beyond
64 bits are held at the bounds, and so is ``deviation``. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from seqprep.session import write_shared

#: Trial vectors beyond the wanted ones, highest degree of a filter, cycles before giving up.
GUARD, DEGREE, MOST_CYCLES = 28, 12, 200
#: Residual, relative to the largest eigenvalue, that certifies a pair; what is taken when it gets no better.
CERTIFIED, STALLED = 2e-15, 1e-11
#: Directions below this share of the largest eigenvalue do not vary.
LEAST = 1e-12
#: Tasks that add up the matrices of all partitions, rows of a batch worked on at a time.
ADDERS, ROWS = 16, 8192

LOWEST, HIGHEST = -(2.0**63), 2.0**63 - 1024


def integers(vectors: pa.Array, scale: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which rows have a usable vector, their lengths, and all entries of these rows as integers, end to end."""
    lengths = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # null becomes NaN
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    ends = np.cumsum(lengths)
    usable = (lengths > 0) & (bad[ends] == bad[ends - lengths])
    with np.errstate(over="ignore"):
        x = np.floor(scale * flat[np.repeat(usable, lengths)])
    return usable, lengths, np.clip(x, LOWEST, HIGHEST).astype(np.int64)


def fit_list(vectors: DataFrame, scale: float) -> tuple[DataFrame, int]:
    """The distinct integer vectors as bytes (``x``), and their length."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            usable, lengths, x = integers(batch.column(0), scale)
            sizes = lengths[usable]
            ends = np.concatenate([[0], np.cumsum(sizes)]) * 8
            packed = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(x.tobytes())])
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int32()), packed.cast(pa.binary())], ["size", "x"])

    distinct = write_shared(vectors.mapInArrow(encode, "size int, x binary").distinct(), "fit-list")
    most = distinct.groupBy("size").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    size = most["size"] if most else 0
    return distinct.filter(F.col("size") == size).select("x"), size


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """The vectors of a batch, one per row."""
    if not len(column):
        return np.zeros((0, size), np.int64)
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(np.int64).reshape(-1, size)


def sums_and_count(fit: DataFrame, size: int) -> tuple[list[int], int]:
    """Exact sum of each dimension, and the number of vectors."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = [0] * size, 0
        for batch in batches:
            x = matrix(batch.column(0), size)
            if not len(x):
                continue
            wide = int(np.abs(x.astype(float)).max()) >= 2**40
            total = [a + int(b) for a, b in zip(total, x.astype(object).sum(axis=0) if wide else x.sum(axis=0))]
            n += len(x)
        if n:
            own = pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), own, pa.array([n] * size, pa.int64())], ["i", "s", "n"])

    parts = fit.mapInArrow(add, "i int, s decimal(38,0), n long").groupBy("i").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    rows = sorted(parts.collect())  # one row per dimension
    return [int(r["s"]) for r in rows], rows[0]["n"] if rows else 0


def summed(fit: DataFrame, size: int, mean: np.ndarray, part: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """Sum of ``part(Xc)`` over all rows: one matrix per partition, added up by a few tasks."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_rows = np.zeros(shape), False
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                total += part(matrix(batch.column(0).slice(lo, ROWS), size) - mean)
                any_rows = True
        if any_rows:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_rows = np.zeros(shape), False
        for batch in batches:
            for value in batch.column(0):
                total += np.frombuffer(value.as_buffer(), float).reshape(shape)
                any_rows = True
        if any_rows:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    parts = fit.mapInArrow(own, "sums binary").withColumn("adder", F.spark_partition_id() % ADDERS)
    added = parts.repartition(ADDERS, "adder").select("sums").mapInArrow(add, "sums binary")
    total = np.zeros(shape)
    for row in added.collect():  # at most one matrix per adder
        total += np.frombuffer(row["sums"], float).reshape(shape)
    return total


def leading_pairs(apply: Callable[[np.ndarray], np.ndarray], size: int, wanted: int, guard: int = GUARD, seed: int = 5) -> tuple[np.ndarray, np.ndarray, float]:
    """The ``wanted`` largest eigenvalues of a symmetric positive operator, falling, their unit vectors, and the largest residual."""
    width = min(size, wanted + guard)
    wanted = min(size, wanted)
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, width)))[0]
    before = np.inf
    for _ in range(MOST_CYCLES):
        # Rayleigh-Ritz
        y = apply(q)
        small = q.T @ y
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, y = q @ turn, y @ turn
        top = max(values[0], 0.0)
        residual = float(np.linalg.norm(y - q * values, axis=0)[:wanted].max())
        if width == size or residual <= CERTIFIED * np.sqrt(size) * top or (residual <= STALLED * top and residual > before / 2):
            return values[:wanted], q[:, :wanted], residual
        before = residual
        # Filter: a polynomial that is small on [0, cut] and grows fastest beyond.
        cut = max(values[-1], 1e-6 * top)
        centre = half = cut / 2
        scale = half / (top - centre)
        last, now = q, (y - centre * q) * (scale / half)
        for _ in range(DEGREE - 1):
            next_scale = 1 / (2 * (top - centre) / half - scale)
            after = (apply(now) - centre * now) * (2 * next_scale / half) - last * (scale * next_scale)
            last, now, scale = now, after, next_scale
        q = np.linalg.qr(now)[0]
    raise ArithmeticError(f"no certified eigenvectors after {MOST_CYCLES} filters: residual {residual:.1e} of {top:.1e}")


RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(
    vectors: DataFrame, components: int = 4, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 256.0
) -> DataFrame:
    """One row per usable vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    fit, size = fit_list(rows.select("vector"), scale)
    total, n = sums_and_count(fit, size) if size else ([], 0)
    if not n:
        return spark.createDataFrame([], RESULT)
    mean = np.array([s / n for s in total])
    width = min(size, components + GUARD)
    spread = []  # the trace comes with the first pass

    def apply(q: np.ndarray) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            return np.concatenate([x.T @ (x @ q), np.full((1, q.shape[1]), np.square(x).sum())])

        made = summed(fit, size, mean, part, (size + 1, width)) / n
        spread.append(made[-1, 0])
        return made[:-1]

    values, q, _ = leading_pairs(apply, size, components)
    varying = values > LEAST * max(spread[0], 0.0)
    values, q = values[varying], q[:, varying]
    if not len(values):
        return spark.createDataFrame([], RESULT)
    q = q * np.where(q[np.abs(q).argmax(axis=0), np.arange(len(values))] >= 0, 1.0, -1.0)
    turned = q / np.sqrt(values)
    explained = (values / spread[0]).tolist()
    k = len(values)
    covariance = summed(fit, size, mean, lambda x: (x @ turned).T @ (x @ turned), (k, k)) / n
    error = float(np.abs(covariance - np.eye(k)).max())
    exact = np.array(total, dtype=object)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                usable, lengths, flat = integers(part.column(1), scale)
                wanted = usable & (lengths == size)
                x = flat[np.repeat(lengths[usable] == size, lengths[usable])].reshape(-1, size)
                if not len(x):
                    continue
                least = n * float(np.abs(x.astype(float)).max()) + float(max(map(abs, total)))
                if size * least**2 < 2.0**62:
                    deviation = np.square(n * x - exact.astype(np.int64)).sum(axis=1)
                else:
                    deviation = np.array([min(int(d), 2**63 - 1) for d in ((n * x.astype(object) - exact) ** 2).sum(axis=1)])
                points = (x - mean) @ turned
                ids = part.column(0).filter(pa.array(wanted))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(np.repeat(np.arange(len(x)), k))),
                        pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                        pa.array(np.full(len(x) * k, n), pa.int64()),
                        pa.array(np.repeat(deviation, k), pa.int64()),
                        pa.array(points.reshape(-1)),
                        pa.array(np.tile(explained, len(x))),
                        pa.array(np.full(len(x) * k, error)),
                    ],
                    [c.split()[0] for c in RESULT.split(", ")],
                )

    return rows.mapInArrow(project, RESULT)
