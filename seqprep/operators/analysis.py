"""Embedding and parameter tables: similarity, equality, PCA, magnitudes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from seqprep.functions import arrays as A

VECTOR = "embedding"


def embedding_similarity(
    src: DataFrame, tgt: DataFrame, tokens: DataFrame | None = None, key: str = "token_id"
) -> DataFrame:
    """Cosine similarity of the two vectors of each token.

    Tokens that either table lacks drop out; ``tokens`` (with the key column)
    restricts the result. A zero vector has no direction: NULL.
    """
    if tokens is not None:
        src = src.join(tokens, key)
    pair = src.withColumnRenamed(VECTOR, "_a").join(tgt.select(key, F.col(VECTOR).alias("_b")), key)
    a, b = F.col("_a"), F.col("_b")
    norm = F.sqrt(A.dot(a, a)) * F.sqrt(A.dot(b, b))
    return pair.withColumn("similarity", F.try_divide(A.dot(a, b), norm)).drop("_a", "_b")


def tables_close(
    src: DataFrame, tgt: DataFrame, rtol: float = 1e-5, atol: float = 1e-8, key: str = "token_id"
) -> DataFrame:
    """One row: are both tables equal, element by element, within tolerance?

    The bound is ``atol + rtol * |target|``. A token only one side has, or
    vectors of different length, make the tables different; so does NaN. Equal
    infinities are equal.
    """
    left = src.select(key, F.col(VECTOR).alias("_a"))
    right = tgt.select(key, F.col(VECTOR).alias("_b"))
    both = left.join(right, key, "full")
    # zip_with pads the shorter vector with NULL, which is not close.
    close = F.zip_with(
        "_a",
        "_b",
        lambda x, y: F.coalesce(
            ((x == y) | (F.abs(x.cast("double") - y.cast("double")) <= atol + rtol * F.abs(y.cast("double"))) & (F.abs(y) < float("inf")))
            & ~F.isnan(x)
            & ~F.isnan(y),
            F.lit(False),
        ),
    )
    same = F.coalesce(F.forall(close, lambda ok: ok), F.lit(False))
    return both.agg(F.coalesce(F.bool_and(same), F.lit(True)).alias("is_shared"))


# --- parameters -----------------------------------------------------------


def param_counts(df: DataFrame) -> DataFrame:
    """Number of parameters, all and trainable."""
    count = F.size("values").cast("long")
    return df.agg(
        F.coalesce(F.sum(count), F.lit(0)).alias("total_params"),
        F.coalesce(F.sum(F.when(F.col("trainable"), count)), F.lit(0)).alias("trainable_params"),
    )


def param_magnitudes(df: DataFrame) -> DataFrame:
    """Mean and maximum absolute value of each trainable tensor.

    A tensor may lie in many chunk rows. Values are combined in each task
    before the shuffle, so one huge tensor does not end in one task.
    """
    values = df.filter("trainable").select("tensor", F.explode("values").alias("v"))
    size = F.abs(F.col("v").cast("double"))
    return values.groupBy("tensor").agg(F.avg(size).alias("mean_abs"), F.max(size).alias("max_abs"))


# --- PCA ------------------------------------------------------------------

#: Directions followed beyond the wanted ones, rounds before giving up, tasks that add up partial sums.
GUARD, MOST_ROUNDS, ADDERS = 62, 1000, 16
#: Residual of a component, relative to the largest eigenvalue.
TOLERANCE = 1e-13


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """The vectors that have ``width`` finite entries, one per row."""
    lengths = pc.fill_null(vectors.value_lengths(), 0).to_numpy(zero_copy_only=False)
    rows = vectors.filter(pa.array(lengths == width)).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return rows[np.isfinite(rows).all(axis=1)]


def vector_sum(vectors: DataFrame, width: int, part: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
    """Sum of ``part(rows)`` over a column of vectors: one array per task, added up by a few tasks."""

    def total_of(arrays: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
        total = None
        for array in arrays:
            total = array if total is None else total + array
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from total_of(part(_matrix(batch.column(0), width)).astype(float).reshape(shape) for batch in batches)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from total_of(np.frombuffer(v.as_buffer(), float).reshape(shape) for batch in batches for v in batch.column(0))

    parts = vectors.mapInArrow(own, "sums binary").withColumn("_adder", F.spark_partition_id() % ADDERS)
    added = parts.repartition(ADDERS, "_adder").select("sums").mapInArrow(add, "sums binary")
    total = np.zeros(shape)
    for row in added.collect():  # one array per adder at most
        total += np.frombuffer(row["sums"], float).reshape(shape)
    return total


@dataclass(frozen=True)
class Projection:
    """Fitted PCA: the mean, one unit axis per column, and the share of the variance of each.

    The sign of an axis is fixed: its largest loading is positive.
    """

    mean: np.ndarray
    axes: np.ndarray
    explained_variance: list[float]

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``pc1..pck``, NULL for a vector of another length or with entries that are not finite."""
        mean, axes = self.mean, self.axes

        @F.arrow_udf("array<double>")
        def points(vectors: pa.Array) -> pa.Array:
            lengths = pc.fill_null(vectors.value_lengths(), 0).to_numpy(zero_copy_only=False)
            fits = lengths == len(mean)
            rows = vectors.filter(pa.array(fits)).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(mean))
            made = np.full((len(vectors), axes.shape[1]), np.nan)
            made[fits] = (rows - mean) @ axes
            usable = np.isfinite(made).all(axis=1)
            ends = np.arange(0, made.size + 1, axes.shape[1])
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(made.reshape(-1)), mask=pa.array(~usable))

        placed = df.withColumn("_p", points(F.col(VECTOR).cast("array<double>")))
        return placed.withColumns({f"pc{i + 1}": F.get("_p", F.lit(i)) for i in range(axes.shape[1])}).drop("_p")


def fit_pca(df: DataFrame, k: int = 2) -> Projection:
    """Fit PCA on all vectors by subspace iteration.

    A pass multiplies a block of trial axes by the covariance, which is never
    formed: each task sums its share of ``X^T (X Q)``, X centred. So driver and
    tasks hold matrices of dimension x (k + ``GUARD``) numbers, however wide the
    vectors are. QR and Rayleigh-Ritz follow each pass, until the residuals of
    the wanted axes vanish. Vectors of another length than the longest, or with
    entries that are not finite, take no part.
    """
    vectors = df.select(F.col(VECTOR).cast("array<double>").alias(VECTOR))
    width = vectors.agg(F.max(F.size(VECTOR)).alias("width")).head()["width"] or 0
    if width < 1:
        raise ValueError("PCA needs vectors")
    sums = vector_sum(vectors, width, lambda x: np.append(x.sum(axis=0), len(x)), (width + 1,))
    if not sums[-1]:
        raise ValueError("PCA needs vectors with finite entries")
    mean, n = sums[:-1] / sums[-1], sums[-1]
    k = min(k, width)
    block = min(width, k + GUARD)
    trial = np.linalg.qr(np.random.default_rng(1).normal(size=(width, block)))[0]
    for _ in range(MOST_ROUNDS):

        def part(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            return np.vstack([centred.T @ (centred @ trial), np.full((1, block), np.square(centred).sum())])

        made = vector_sum(vectors, width, part, (width + 1, block)) / n
        image, spread = made[:-1], made[-1, 0]
        small = trial.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        axes = trial @ turn[:, :k]
        residual = np.linalg.norm(image @ turn[:, :k] - axes * values[:k], axis=0).max()
        if block == width or residual <= TOLERANCE * abs(values[0]):
            break
        trial = np.linalg.qr(image @ turn)[0]
    else:
        raise ArithmeticError(f"PCA has not converged: residual {residual:.1e} of {values[0]:.1e}")
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(k)] >= 0, 1.0, -1.0)
    shares = [float(v / spread) if spread > 0 else 0.0 for v in values[:k]]
    return Projection(mean, axes, shares)


def pca_project(df: DataFrame, k: int = 2) -> DataFrame:
    """Every vector with its ``k`` principal coordinates."""
    return fit_pca(df, k).transform(df).drop(VECTOR)


def labelled_projection(df: DataFrame, labels: DataFrame, k: int = 2, on: tuple[str, ...] = ("id", "pos")) -> DataFrame:
    """Projected points with the token label of their position."""
    return pca_project(df, k).join(labels, list(on))


def explained_variance(df: DataFrame, k: int = 2) -> DataFrame:
    """One row per component: its share of the variance."""
    shares = fit_pca(df, k).explained_variance
    return df.sparkSession.createDataFrame(
        [(i + 1, share) for i, share in enumerate(shares)], "component int, ratio double"
    )
